"""Schema registry: canonical columns, label patterns, dtypes, drift policy (A4).

The registry is configuration (a few dozen entries), loaded on the driver and used as
literal expressions in the plans; it never touches row data on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# The published activity-sheet registry (schema version 2024.01).
# canonical name, label pattern (regex searched in the lower-cased, space-collapsed
# compound label), dtype, required.
DEFAULT_COLUMNS = [
    ("org_code", "^code$", "text", True),
    ("org_name", "^name$", "text", True),
    ("attendances_type1", "a&e attendances :: type 1", "integer", True),
    ("attendances_type2", "a&e attendances :: type 2", "integer", False),
    ("attendances_type3", "a&e attendances :: type 3", "integer", False),
    ("attendances_total", "a&e attendances :: total attendances", "integer", False),
    ("breaches_type1", "greater than 4 hours.*:: type 1", "integer", False),
    ("breaches_total", "greater than 4 hours.*total attendances > 4", "integer", False),
    ("performance_all_pct", "percentage in 4 hours or less [(]all[)]", "percent", False),
    ("emergency_admissions_type1", "emergency admissions via type 1", "integer", False),
    ("emergency_admissions_via_ae", "total emergency admissions via", "integer", False),
    ("emergency_admissions_other", "other emergency admissions", "integer", False),
    ("emergency_admissions_total", "total emergency admissions$", "integer", False),
    ("dta_breaches_4hr", ">4 hours from decision", "integer", False),
    ("dta_breaches_12hr", ">12 hours from decision", "integer", False),
]
DEFAULT_SCHEMA_VERSION = "2024.01"
DEFAULT_ANCHOR = "Code"
DEFAULT_PREFERRED_SHEETS = ["provider", "activity", "data"]
DEFAULT_POLICY = {
    "on_missing_required_column": "halt",
    "on_unexpected_new_column": "warn_and_continue",
    "on_renamed_column": "fuzzy_match_then_alert",
}
HEADER_SEARCH_ROWS = 40           # the header row lies within the first 40 rows
METADATA_ROWS = 14                # the 'Period:' cell lies within the first 14 rows
FUZZY_THRESHOLD = 0.8             # label similarity needed to accept a renamed column
IDENTITY_LABELS = ("code", "region", "name")
ALLOWED_DTYPES = ("text", "integer", "percent")


@dataclass(frozen=True)
class ColumnSpec:
    canonical: str
    patterns: tuple[str, ...]
    dtype: str = "text"
    required: bool = False


@dataclass(frozen=True)
class Registry:
    schema_version: str
    anchor: str
    preferred_sheets: tuple[str, ...]
    policy: dict = field(default_factory=dict)
    columns: tuple[ColumnSpec, ...] = ()

    @property
    def canonical(self) -> list[str]:
        return [c.canonical for c in self.columns]

    def dtype(self, name: str) -> str:
        return next(c.dtype for c in self.columns if c.canonical == name)


def default_registry() -> Registry:
    return Registry(DEFAULT_SCHEMA_VERSION, DEFAULT_ANCHOR, tuple(DEFAULT_PREFERRED_SHEETS), dict(DEFAULT_POLICY),
                    tuple(ColumnSpec(n, (p,), d, r) for n, p, d, r in DEFAULT_COLUMNS))


def registry_from_dict(raw: dict) -> Registry:
    """Build a registry from its YAML structure. Patterns may be a list or one string;
    an unknown dtype is rejected here rather than passed through silently."""
    cols = []
    for c in raw["columns"]:
        pats = c.get("patterns", c.get("source_label_contains"))
        pats = tuple(pats) if isinstance(pats, list) else (str(pats),)
        dtype = c.get("dtype", "text")
        if dtype not in ALLOWED_DTYPES:
            raise ValueError(f"unsupported dtype {dtype!r} for {c['maps_to']}")
        cols.append(ColumnSpec(c["maps_to"], pats, dtype, bool(c.get("required", False))))
    preferred = raw.get("preferred_sheet_name_contains", raw.get("preferred_sheet_contains", []))
    return Registry(str(raw.get("schema_version", "unknown")), str(raw.get("sheet_anchor_column", "Code")),
                    tuple(s.lower() for s in preferred), dict(raw.get("drift_policy", {})), tuple(cols))


def load_registry(path: str | None = None) -> Registry:
    if path is None:
        return default_registry()
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover - PyYAML is optional
        raise RuntimeError("PyYAML is needed to read a registry file") from exc
    with open(path, encoding="utf-8") as f:
        return registry_from_dict(yaml.safe_load(f))
