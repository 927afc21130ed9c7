"""Grid ingest plan: cells -> data sheet -> header -> labels -> mapping (+ renames) ->
wide rows -> footnote filter -> typed rows -> period -> staging layout.

The analogue entry point renders the revised release of the analogue star as monthly
workbooks, so this plan runs end to end on data Spark derives from the driver tables,
and its output must equal the staged rows computed straight from ``lineitem``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edpanel import session
from edpanel.operators import drift, grid, sinks
from edpanel.plans import analogue, quality
from edpanel.sources import grid as grid_src
from edpanel.sources import seeds
from edpanel.sources.registry import HEADER_SEARCH_ROWS, METADATA_ROWS, ColumnSpec, Registry, default_registry


@dataclass
class IngestResult:
    """What a parse gives. The frames of the sheets' heads are made by the parse; those of the body's rows
    when they are first asked for, so a caller of the drift log alone pivots nothing."""
    registry: Registry
    keep: grid.Keep
    cells: DataFrame
    sheets: DataFrame
    headers: DataFrame
    labels: DataFrame
    mapping: DataFrame
    renames: DataFrame
    missing: DataFrame
    periods: DataFrame
    drift_log: DataFrame
    rows: DataFrame | None = None      # the rows of values that the cells come from, where each holds all its cells

    @cached_property
    def wide(self) -> DataFrame:
        """Read twice, for the percentages' scale and for the rows, so the pivot is kept; what is cut from rows of values is
        kept as typed."""
        if self.rows is not None:
            return grid.rows_to_wide(self.rows, self.headers, self.mapping, self.registry)
        return self.keep(grid.cells_to_wide(self.cells, self.headers, self.mapping, self.registry))

    @cached_property
    def typed(self) -> DataFrame:
        return grid.coerce_types(grid.drop_footnotes(self.wide), self.registry, keep=self.keep,
                                 keep_rows=grid.as_planned if self.rows is None else self.keep)

    @cached_property
    def staged(self) -> DataFrame:
        return sinks.conform_staging(self.typed.join(self.periods, grid.SHEET_KEY, "left"))

    @cached_property
    def unmapped(self) -> DataFrame:
        return drift.unmapped_capture(self.cells, self.headers, self.labels, self.mapping, self.keep)


def parse_cells(cells: DataFrame, registry: Registry | None = None, materialize: bool = True,
                order: DataFrame | None = None, until_blank_row: bool = False, stored: bool = False) -> IngestResult:
    """Run the grid parse. ``order`` gives the workbooks' sheets in their order (C1); with ``until_blank_row``
    the body of a sheet ends before its first blank row (C8). With ``materialize`` the cells and the per-sheet header frames
    (a sheet's width of rows each) are written once, so every output below plans
    from written data instead of re-deriving the whole lineage per branch; ``stored`` tells that the cells are a written table
    already. All cells are read once for the profile of their columns, once for the rows that can hold
    a header or the period, and once for each frame of body rows."""
    reg = registry or default_registry()
    keep = session.store if materialize else grid.as_planned
    cells = cells if stored else keep(cells)
    return _parsed(cells, *_profiled(cells, keep), reg, keep, order, until_blank_row)


def parse_texts(texts: DataFrame, registry: Registry | None = None) -> IngestResult:
    """:func:`parse_cells` of the cells of CSV texts held in rows (file, sheet, first_row, text). The texts are read for the profile of
    their columns, their first parts for the headers and periods, and all once more for the rows, which are cut from their lines:
    the cells are neither written nor shuffled. Where the parts of a sheet overlap its rows do not hold all their cells, and the cells are parsed."""
    if grid_src.parts_overlap(texts):
        return parse_cells(grid_src.cells_of_text(texts), registry)
    rows = grid_src.rows_of_text(texts)
    cells = grid_src.cells_of_rows(rows)
    head = grid_src.cells_of_text(texts.where(F.col("first_row") < SEARCHED_ROWS)).where(F.col("row") < SEARCHED_ROWS)
    return _parsed(cells, session.store(grid.profile_of_rows(rows)), session.store(head), registry or default_registry(), session.store, rows=rows)


def _parsed(cells: DataFrame, profile: DataFrame, head: DataFrame, reg: Registry, keep: grid.Keep, order: DataFrame | None = None,
            until_blank_row: bool = False, rows: DataFrame | None = None) -> IngestResult:
    """The parse from the column profile and the searched rows on."""
    sheets = keep(grid.pick_sheet(cells, reg, order, profile))
    headers = keep(grid.header_rows(head, sheets, reg))
    if until_blank_row:
        cells = keep(grid.stop_at_blank_row(cells.join(sheets, grid.SHEET_KEY, "left_semi"), headers))
        profile, head = _profiled(cells, keep)
    labels = keep(grid.header_labels(head, headers, profile))
    mapping0 = grid.map_columns(labels, reg)
    missing = grid.missing_specs(headers, mapping0, reg)
    renames = drift.fuzzy_renames(labels, mapping0, missing)
    mapping = keep(drift.apply_renames(mapping0, renames, reg))
    periods = keep(grid.extract_period(head, sheets))
    log = drift.drift_log(
        drift.drift_missing(missing, renames, reg),
        drift.drift_unexpected(labels, mapping, reg),
        drift.drift_renamed(renames, reg),
        drift.drift_no_header(grid.missing_headers(sheets, headers)),
        drift.drift_no_period(sheets, periods))
    return IngestResult(reg, keep, cells, sheets, headers, labels, mapping, renames, missing, periods, log, rows)


SEARCHED_ROWS = max(HEADER_SEARCH_ROWS, METADATA_ROWS)


def _profiled(cells: DataFrame, keep: grid.Keep) -> tuple[DataFrame, DataFrame]:
    """The column profile of the cells, and the cells of the rows that are searched for headers and periods."""
    return keep(grid.column_profile(cells)), keep(cells.where(F.col("row") < SEARCHED_ROWS))


def staged_with_unmapped(result: IngestResult) -> DataFrame:
    """The staged rows, each with what its unmapped columns held."""
    rows = result.typed.join(result.periods, grid.SHEET_KEY, "left").join(result.unmapped, ["row", *grid.SHEET_KEY], "left")
    return sinks.conform_staging(rows, keep=("file", "_unmapped"))


class LoadHaltedError(RuntimeError):
    pass


HASHED = ("period_date", "org_code", "org_name", "attendances_type1", "attendances_type2", "attendances_type3",
          "attendances_total", "breaches_type1", "breaches_total", "emergency_admissions_type1",
          "emergency_admissions_via_ae", "emergency_admissions_other", "emergency_admissions_total",
          "dta_breaches_4hr", "dta_breaches_12hr")


def load_staging(result: IngestResult, path: str, origins: DataFrame, ingested_at: str) -> None:
    """Write the parsed rows with all audit columns, replacing their periods; ``origins`` has a row a file
    (file, sha256, source_url, published_at). Nothing is written when
    the drift policy halts the load (required column, header or period missing) or the layout
    is not the staging layout."""
    rows = result.staged.drop("file")
    wrong = quality.shape_mismatches(rows, sinks.STAGING_SCHEMA)
    if wrong:
        raise LoadHaltedError(f"staging layout: {wrong}")
    if drift.should_halt(result.drift_log):
        raise LoadHaltedError("drift policy halted the load")
    sinks.replace_periods(sinks.add_load_columns(result.staged, origins, ingested_at, HASHED), path)


LATE_LINE = 7                      # the line of an order that the first release lacks


def published_rows(spark: SparkSession, sf_dir: str, release: str = "revised", months: Column | None = None) -> DataFrame:
    """A release of the analogue with every activity column, the provider names and the ICB, or
    those of its months that the condition ``months`` on period_date holds for. The providers' names and ICBs are written
    first: by the size of that table the planner broadcasts it or not."""
    lines = analogue.activity_lines(spark, sf_dir, LATE_LINE - 1 if release == "first" else None)
    if months is not None:
        lines = lines.where(months)
    prov = analogue.build_dim_provider(spark, sf_dir)
    regions = prov.select(F.col("trust_code").alias("org_code"), "icb_name")
    named = prov.select("provider_key", F.col("trust_code").alias("org_code"), F.col("trust_name").alias("org_name"))
    named = session.store(named.join(regions, "org_code", "left"))
    return analogue.fact_from_lines(lines).join(named, "provider_key").select(
        "period_date", "org_code", "org_name", "icb_name", *analogue.MEASURES)


def analogue_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release_cells(spark, sf_dir, "revised")


def release_cells(spark: SparkSession, sf_dir: str, release: str, months: Column | None = None) -> DataFrame:
    """The workbooks of a release (of the ``months`` of :func:`published_rows`) as cells, laid out from its rows as written once."""
    return grid_src.render_activity_grid(session.store(published_rows(spark, sf_dir, release, months)))


def release_texts(spark: SparkSession, sf_dir: str, release: str) -> DataFrame:
    """The workbooks of a release as CSV texts (file, sheet, first_row, text)."""
    number = grid_src.provider_number(F.col("trust_code"))
    shared = analogue.build_dim_provider(spark, sf_dir).groupBy(number.alias("number")).count().where("count > 1").select("number")
    return grid_src.render_activity_texts(session.store(published_rows(spark, sf_dir, release)), session.store(shared))


def analogue_ingest(spark: SparkSession, sf_dir: str) -> IngestResult:
    return parse_cells(analogue_cells(spark, sf_dir))


# ----------------------------------------------------------------- registered queries
LOST_COLUMN = 3                    # the type 1 attendances: banner and label (fixed values of the render)
DIRTY_COLUMN, DIRTY_EVERY = 4, 7
LOST_LABELS = (grid_src.BANNER_ATT, "Type 1 Departments - Major A&E")
STAGED_OUT = HASHED


def q_grid_cells(spark, sf_dir):
    """A2: the rendered workbooks written as CSV sheets to the shared folder and scanned again."""
    folder = session.scratch_path(spark, f"sheets/{uuid.uuid4().hex}")
    grid_src.write_sheets(analogue_cells(spark, sf_dir), folder)
    return grid_src.read_sheets(spark, folder)


def q_grid_profile(spark, sf_dir):
    return grid.grid_profile(analogue_cells(spark, sf_dir))


def q_pick_sheet(spark, sf_dir):
    return grid.pick_sheet(analogue_cells(spark, sf_dir), default_registry())


def q_header_row(spark, sf_dir):
    cells = analogue_cells(spark, sf_dir)
    reg = default_registry()
    return grid.header_rows(cells, grid.pick_sheet(cells, reg), reg)


def q_map_columns(spark, sf_dir):
    r = analogue_ingest(spark, sf_dir)
    return r.mapping.select("file", "sheet", "canonical", "col", "compound")


def q_extract_period(spark, sf_dir):
    cells = analogue_cells(spark, sf_dir)
    return grid.extract_period(cells, grid.pick_sheet(cells, default_registry()))


def q_cells_to_wide(spark, sf_dir):
    """End to end: the rows recovered from the rendered workbooks (staging layout)."""
    return analogue_ingest(spark, sf_dir).staged.select(*STAGED_OUT)


def q_drift_missing(spark, sf_dir):
    """D10 over the workbooks as published without the label of a required column every March."""
    cells = analogue_cells(spark, sf_dir)
    lost = F.col("file").contains("-03.xls") & F.col("value").isin(*LOST_LABELS) & (F.col("col") == LOST_COLUMN)
    r = parse_cells(cells.where(~lost))
    return drift.drift_missing(r.missing, r.renames, default_registry())


def q_drift_unexpected(spark, sf_dir):
    r = analogue_ingest(spark, sf_dir)
    return drift.drift_unexpected(r.labels, r.mapping, default_registry())


# Columns that a later schema version adds to the registry (fixed values of the render).
LATER_COLUMNS = (ColumnSpec("region_name", ("^region$",), "text"),
                 ColumnSpec("booked_type1", ("appointments :: booked type 1",), "integer"),
                 ColumnSpec("breaches_type2", ("greater than 4 hours.*:: type 2",), "integer"))


def q_unmapped_capture(spark, sf_dir):
    """The rows staged with their unmapped columns as a written table, read under a later schema
    version that knows three of them, one of which is published from 2001 on only."""
    path = session.scratch_path(spark, f"staging/{uuid.uuid4().hex}")
    rows = staged_with_unmapped(analogue_ingest(spark, sf_dir))
    sinks.replace_periods(rows, path)
    later = drift.read_across_versions(spark.read.schema(rows.schema).parquet(path), LATER_COLUMNS)
    return later.select("period_date", "org_code", "attendances_type1", *[c.canonical for c in LATER_COLUMNS])


def q_stop_at_blank_row(spark, sf_dir):
    """The cells of the data sheets before the first blank row under their header."""
    cells = session.store(analogue_cells(spark, sf_dir))
    reg = default_registry()
    sheets = session.store(grid.pick_sheet(cells, reg))
    headers = session.store(grid.header_rows(cells, sheets, reg))
    kept = grid.stop_at_blank_row(cells.join(sheets, grid.SHEET_KEY, "left_semi"), headers)
    return kept.select("file", "sheet", "row", "col", "value")


UNADJUSTED_SHEET = "Unadjusted Provider Data"
FIRST_EVERY, LAST_EVERY = 4, 2     # the unadjusted sheet lies first in months divisible by 4, last in other even ones


def q_sheet_order(spark, sf_dir):
    """C1 with the workbook's order: in even months a workbook also holds the first release as a sheet of its
    own, before or after the revised one. Both names hold the preferred fragment, so the first of them is parsed."""
    revised = analogue_cells(spark, sf_dir)
    month = F.regexp_extract("file", r"-(\d\d)\.xls$", 1).cast("int")
    unadjusted = release_cells(spark, sf_dir, "first", F.month("period_date") % LAST_EVERY == 0).where(F.col("sheet") == grid_src.DATA_SHEET)
    cells = session.store(revised.unionByName(unadjusted.withColumn("sheet", F.lit(UNADJUSTED_SHEET))))
    place = F.when(F.col("sheet") == grid_src.DATA_SHEET, 1).when(F.col("sheet") == grid_src.NOTES_SHEET, 2)
    place = F.coalesce(place, F.when(month % FIRST_EVERY == 0, 0).otherwise(3))
    path = session.scratch_path(spark, f"seeds/{uuid.uuid4().hex}")
    seeds.write_seed(cells.select("file", "sheet").distinct().withColumn("sheet_index", place), path)
    return parse_cells(cells, order=grid_src.sheet_order(spark, path), stored=True).staged.select(*STAGED_OUT)


def q_parse_until_blank(spark, sf_dir):
    """C8 as part of the parse: the rows of each workbook before its first blank row."""
    return parse_cells(analogue_cells(spark, sf_dir), until_blank_row=True).staged.select(*STAGED_OUT)


REPUBLISHED = "-06.xls"            # the workbooks that the revised release brings in q_staging_audit
LOADED_FIRST, LOADED_AGAIN = "2001-12-13 08:00:00", "2002-01-10 08:00:00"


def q_staging_audit(spark, sf_dir):
    """The first release loaded, then the revised June workbooks; the staging rows with their
    audit columns, of which the second load replaced those of June."""
    path = session.scratch_path(spark, f"staging/{uuid.uuid4().hex}")
    for release, published, loaded in (("first", "2001-12-10", LOADED_FIRST), ("revised", "2002-01-08", LOADED_AGAIN)):
        months = None if release == "first" else grid_src.workbook_name(F.col("period_date")).endswith(REPUBLISHED)
        result = parse_cells(release_cells(spark, sf_dir, release, months))
        origins = result.sheets.select("file", F.sha2(F.concat(F.lit(release + "/"), "file"), 256).alias("sha256"),
                                       F.concat(F.lit(f"https://files.example/{release}/"), "file").alias("source_url"),
                                       F.lit(published).cast("date").alias("published_at"))
        load_staging(result, path, origins, loaded)
    staged = spark.read.parquet(path)
    return staged.select("period_date", "org_code", "attendances_total", *sinks.AUDIT_COLUMNS[:-1],
                         F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), *sinks.LOAD_COLUMNS[4:])


def q_drift_rename(spark, sf_dir):
    return analogue_ingest(spark, sf_dir).renames.select("file", "sheet", "canonical", "col", "compound", "similarity")


def q_drift_log(spark, sf_dir):
    return analogue_ingest(spark, sf_dir).drift_log


def q_dq_coerce_rejects(spark, sf_dir):
    """H12 over the workbooks with the type 2 attendances of every seventh row unreadable."""
    dirty = (F.col("col") == DIRTY_COLUMN) & (F.col("row") % DIRTY_EVERY == 0) & F.col("value").rlike("^[0-9]+$")
    cells = analogue_cells(spark, sf_dir).withColumn("value", F.when(dirty, F.lit("n/a")).otherwise(F.col("value")))
    r = parse_cells(cells)
    return grid.coerce_rejects(grid.drop_footnotes(r.wide), default_registry())


def q_recompute_vs_source(spark, sf_dir):
    """The percentage published in the sheet against the one recomputed from counts."""
    from edpanel.functions import columns as C
    s = analogue_ingest(spark, sf_dir).staged
    recomputed = C.pct(F.col("attendances_total") - F.col("breaches_total"), F.col("attendances_total"))
    src = F.col("performance_all_pct").cast("double")
    return s.select("period_date", "org_code", src.alias("source_pct"), recomputed.alias("recomputed_pct"),
                    F.coalesce(F.abs(F.col("performance_all_pct") - recomputed) <= F.lit(0.05), F.lit(False))
                    .alias("consistent"))
