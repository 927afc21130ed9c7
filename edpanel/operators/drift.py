"""Schema drift (D10–D14): missing, unexpected and renamed columns, the drift log and
the policy decision. All inputs are per-sheet header data (bounded by sheet width)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import grid
from edpanel.sources.registry import FUZZY_THRESHOLD, ColumnSpec, Registry

KEY = grid.SHEET_KEY
ACTIONS = {"halt": "halted", "warn_and_continue": "warned", "fuzzy_match_then_alert": "fuzzy_mapped"}


def _action(registry: Registry, policy_key: str, default: str) -> str:
    return ACTIONS.get(registry.policy.get(policy_key, default), "warned")


def fuzzy_renames(labels: DataFrame, mapping: DataFrame, missing: DataFrame, threshold: float = FUZZY_THRESHOLD) -> DataFrame:
    """Renamed columns (D12): the missing registry columns and the unmapped labels of a sheet are
    matched one to one, best pair first (1 - levenshtein / longer length, ties to the earlier
    registry column, then the left label), kept when >= threshold. A column that loses its best label to a better
    pair takes its next one. The pairs of a sheet, bounded by its width, are one fold that carries the labels and
    columns already taken."""
    unmapped = (labels.where(F.col("compound") != "").join(mapping.select(*KEY, "col"), [*KEY, "col"], "left_anti")
                .select(*KEY, "col", "compound", F.lower(F.col("compound")).alias("norm")))
    cand = unmapped.join(missing, KEY)
    n, e = F.col("norm"), F.lower(F.col("expected_label"))
    sim = 1 - F.levenshtein(n, e) / F.greatest(F.length(n), F.length(e))
    cand = cand.withColumn("similarity", sim).where(F.col("similarity") >= threshold)
    pair = F.struct((-F.col("similarity")).alias("unlike"), "spec_order", "col", "canonical", "compound")
    sheets = cand.groupBy(*KEY).agg(F.array_sort(F.collect_list(pair)).alias("pairs"))
    taken = F.filter("pairs", lambda p: F.lit(False))

    def take(kept: Column, p: Column) -> Column:
        clash = F.exists(kept, lambda k: (k["col"] == p["col"]) | (k["canonical"] == p["canonical"]))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(p)))

    best = sheets.select(*KEY, F.explode(F.aggregate("pairs", taken, take)).alias("p"))
    return best.select(*KEY, "p.canonical", "p.spec_order", "p.col", "p.compound", F.round(-F.col("p.unlike"), 3).alias("similarity"))


def apply_renames(mapping: DataFrame, renames: DataFrame, registry: Registry) -> DataFrame:
    """Add fuzzy-matched columns to the mapping when the policy allows it."""
    if registry.policy.get("on_renamed_column", "fuzzy_match_then_alert") != "fuzzy_match_then_alert":
        return mapping
    return mapping.unionByName(renames.select(*KEY, "canonical", "spec_order", "col", "compound"))


def drift_missing(missing: DataFrame, renames: DataFrame, registry: Registry) -> DataFrame:
    """Required registry columns with no source column and no accepted rename."""
    m = missing.where(F.col("required")).join(renames.select(*KEY, "canonical"), [*KEY, "canonical"], "left_anti")
    return m.select(*KEY, F.lit("missing_required").alias("drift_type"), F.col("canonical").alias("column_detail"),
                    F.lit(_action(registry, "on_missing_required_column", "halt")).alias("action_taken"))


def drift_unexpected(labels: DataFrame, mapping: DataFrame, registry: Registry) -> DataFrame:
    """Source columns that map to nothing (D11); kept as drift rows and as ``_unmapped``."""
    u = (labels.where(F.col("compound") != "").join(mapping.select(*KEY, "col"), [*KEY, "col"], "left_anti"))
    return u.select(*KEY, F.lit("new_column").alias("drift_type"), F.col("compound").alias("column_detail"),
                    F.lit(_action(registry, "on_unexpected_new_column", "warn_and_continue")).alias("action_taken"))


def drift_renamed(renames: DataFrame, registry: Registry) -> DataFrame:
    return renames.select(*KEY, F.lit("renamed").alias("drift_type"),
                          F.concat(F.col("compound"), F.lit(" -> "), F.col("canonical")).alias("column_detail"),
                          F.lit(_action(registry, "on_renamed_column", "fuzzy_match_then_alert")).alias("action_taken"))


def drift_no_header(missing_headers: DataFrame) -> DataFrame:
    return missing_headers.select(*KEY, F.lit("no_header").alias("drift_type"),
                                  F.lit("anchor not found in the first 40 rows").alias("column_detail"),
                                  F.lit("halted").alias("action_taken"))


def drift_no_period(sheets: DataFrame, periods: DataFrame) -> DataFrame:
    """Data sheets whose reporting month could not be read: the load stops."""
    return sheets.select(*KEY).join(periods.where(F.col("period_date").isNotNull()), KEY, "left_anti").select(
        *KEY, F.lit("no_period").alias("drift_type"), F.lit("no readable period in the metadata rows").alias("column_detail"),
        F.lit("halted").alias("action_taken"))


def drift_log(*parts: DataFrame) -> DataFrame:
    """Union of drift rows."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unmapped_columns(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """The columns that map to nothing (file, sheet, col, name). Of those that share a label the left one keeps
    it, the others get ``#2``, ``#3`` and so on behind it."""
    um = labels.where(F.col("compound") != "").join(mapping.select(*KEY, "col"), [*KEY, "col"], "left_anti")
    nth = F.row_number().over(Window.partitionBy(*KEY, "compound").orderBy("col"))          # bounded by the sheet's width
    return um.select(*KEY, "col", "compound", nth.alias("nth")).select(
        *KEY, "col", F.when(F.col("nth") == 1, F.col("compound")).otherwise(F.concat_ws(" #", "compound", "nth")).alias("name"))


def unmapped_capture(cells: DataFrame, headers: DataFrame, labels: DataFrame, mapping: DataFrame,
                     keep: grid.Keep = grid.as_planned) -> DataFrame:
    """``_unmapped``: per body row, a VARIANT object name -> raw value of the :func:`unmapped_columns` (D11). ``keep``
    may write those before the cells meet them."""
    um = keep(unmapped_columns(labels, mapping))
    body = cells.join(headers, KEY).where(F.col("row") > F.col("header_row")).join(um, [*KEY, "col"])
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value"))))
    return body.groupBy("row", *KEY).agg(F.parse_json(F.to_json(pairs)).alias("_unmapped"))


def captured(unmapped: Column, spec: ColumnSpec) -> Column:
    """The raw value that a row's ``_unmapped`` holds for a column of a later schema version: of the labels
    that match its patterns the first in text order; NULL where there is none."""
    return _first_match(_labelled(unmapped), spec)


def _labelled(unmapped: Column) -> Column:
    """What a row's ``_unmapped`` holds as (key, value, norm), norm being the label as patterns see it."""
    return F.transform(F.map_entries(unmapped.cast("map<string,string>")), lambda e: F.struct(
        e["key"].alias("key"), e["value"].alias("value"), F.lower(C.collapse_ws(e["key"])).alias("norm")))


def _first_match(labelled: Column, spec: ColumnSpec) -> Column:
    held = F.array_sort(F.filter(labelled, lambda e: grid.label_matches(e["norm"], spec.patterns)))
    return F.get(held, F.lit(0))["value"]


def read_across_versions(staged: DataFrame, specs: Sequence[ColumnSpec], unmapped: str = "_unmapped") -> DataFrame:
    """Rows staged under an earlier schema version with the columns of a later one: a column that the
    staging table has is kept where it is not NULL, else it is read from the captured values and coerced.
    Percentages come back as published, without the scale of their workbook."""
    coerce = {"integer": C.coerce_int, "percent": C.coerce_pct_raw, "text": C.coerce_text}
    out = staged.withColumn("_labelled", _labelled(F.col(unmapped)))  # read once, however many the columns
    for s in specs:
        value = coerce[s.dtype](_first_match(F.col("_labelled"), s))
        out = out.withColumn(s.canonical, F.coalesce(F.col(s.canonical), value) if s.canonical in staged.columns else value)
    return out.drop("_labelled")


def should_halt(log: DataFrame) -> bool:
    """Policy gate (D14): any halted drift row stops the load before anything is written.
    Only one boolean reaches the driver."""
    return log.where(F.col("action_taken") == "halted").limit(1).count() > 0
