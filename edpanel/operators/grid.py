"""Grid shaping over the cells table.

Everything is a set operation over ``(file, sheet, row, col, value)``: per-sheet
aggregates are joined back on ``(file, sheet)``; the only windows run over one header
row (bounded by the sheet width) or over the sheets of one workbook. The registry
enters as literal expressions, never as a driver loop over data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.sources.registry import (HEADER_SEARCH_ROWS, IDENTITY_LABELS, METADATA_ROWS, Registry)

SHEET_KEY = ["file", "sheet"]
# Footnote / aggregate row patterns (fixed values).
FOOTNOTE_CODE_PATTERN = r"(?i)note|source|total|england"
FOOTNOTE_NAME_PATTERN = r"(?i)^england$|^total|^note"
PERIOD_ANCHOR = "period"
UNLISTED = 2**31 - 1               # place of a sheet that the workbook order lacks
Keep = Callable[[DataFrame], DataFrame]


def as_planned(df: DataFrame) -> DataFrame:
    return df


# ----------------------------------------------------------------- C15 / C1
def grid_profile(cells: DataFrame) -> DataFrame:
    """Sheet count and shape per workbook."""
    return (cells.groupBy(*SHEET_KEY)
            .agg((F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"),
                 F.count("value").alias("non_blank_cells")))


def inspect_rows(cells: DataFrame, max_rows: int = 25) -> DataFrame:
    """First rows of every sheet (the inspect view)."""
    return cells.where(F.col("row") < max_rows)


def column_profile(cells: DataFrame) -> DataFrame:
    """Per column of a sheet its first and last row and its non-blank cells: one pass over the cells, whose result
    is as long as the sheets are wide."""
    return cells.groupBy("col", *SHEET_KEY).agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"),
                                                F.count("value").alias("non_blank"))


def profile_of_rows(rows: DataFrame) -> DataFrame:
    """:func:`column_profile` of rows of values (file, sheet, row, values): rows with cells in the same columns are counted as one
    before their columns are told apart, so no cell is a row of its own."""
    held = F.transform("values", lambda v: F.coalesce(F.trim(v) != "", F.lit(False)))
    shapes = rows.select(*SHEET_KEY, "row", held.alias("held")).groupBy("held", *SHEET_KEY).agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.count(F.lit(1)).alias("n"))
    columns = shapes.select(*SHEET_KEY, "first_row", "last_row", "n", F.posexplode("held").alias("col", "is_held")).where("is_held")
    return columns.groupBy("col", *SHEET_KEY).agg(F.min("first_row").alias("first_row"), F.max("last_row").alias("last_row"), F.sum("n").alias("non_blank"))


def sheet_directory(cells: DataFrame, order: DataFrame | None = None, profile: DataFrame | None = None) -> DataFrame:
    """One row per sheet: its place in the workbook, used range, non-blank cells.

    ``order`` (file, sheet, sheet_index) gives the workbook order, as :func:`edpanel.sources.grid.sheet_order` reads
    it; a sheet that it lacks comes after those it has, by name. The listed sheets without a cell are kept, with no
    range. A directory is as long as the sheets are many, not the cells. ``profile`` is the cells' column profile, where
    the caller has it."""
    used = (profile or column_profile(cells)).groupBy(*SHEET_KEY).agg(
        F.min("first_row").alias("first_row"), F.max("last_row").alias("last_row"), F.min("col").alias("first_col"),
        F.max("col").alias("last_col"), F.sum("non_blank").alias("non_blank"))
    if order is None:
        return used.select(*SHEET_KEY, F.lit(None).cast("int").alias("sheet_index"), "first_row", "last_row", "first_col", "last_col", "non_blank")
    listed = order.groupBy(*SHEET_KEY).agg(F.min("sheet_index").cast("int").alias("sheet_index"))
    return listed.join(used, SHEET_KEY, "full").select(
        *SHEET_KEY, "sheet_index", "first_row", "last_row", "first_col", "last_col", F.coalesce("non_blank", F.lit(0)).alias("non_blank"))


def pick_sheet(cells: DataFrame, registry: Registry, order: DataFrame | None = None, profile: DataFrame | None = None) -> DataFrame:
    """One data sheet per workbook (C1): the first preferred fragment contained in the lower-cased
    sheet name wins (fragments in priority order), and of the sheets that contain it the first
    of the workbook; where no sheet contains one, the sheet with the most non-blank cells, again the first of
    equal ones. Without ``order`` sheets of one fragment rank by non-blank cells, then by name."""
    prio: Column = F.lit(None).cast("int")
    for i, frag in reversed(list(enumerate(registry.preferred_sheets))):
        prio = F.when(F.lower("sheet").contains(frag.lower()), F.lit(i)).otherwise(prio)
    by_size = F.lit(True) if order is None else prio.isNull()
    rank = F.struct(F.coalesce(prio, F.lit(len(registry.preferred_sheets))), F.when(by_size, -F.col("non_blank")),
                    F.coalesce("sheet_index", F.lit(UNLISTED)), F.col("sheet"))
    return sheet_directory(cells, order, profile).groupBy("file").agg(F.min_by("sheet", rank).alias("sheet"))


# ----------------------------------------------------------------- C2–C4
def header_rows(cells: DataFrame, sheets: DataFrame, registry: Registry) -> DataFrame:
    """First row (< 40) with a cell equal to or containing the anchor, case-insensitive.
    Sheets without one are absent here and reported by :func:`missing_headers`."""
    anchor = registry.anchor.strip().lower()
    c = cells.join(sheets, SHEET_KEY, "left_semi").where(
        (F.col("row") < HEADER_SEARCH_ROWS) & F.lower(F.trim("value")).contains(anchor))
    return c.groupBy(*SHEET_KEY).agg(F.min("row").alias("header_row"))


def missing_headers(sheets: DataFrame, headers: DataFrame) -> DataFrame:
    return sheets.join(headers, SHEET_KEY, "left_anti")


def header_labels(cells: DataFrame, headers: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Compound column labels (C3, C4): the banner row above the label row is forward
    filled left to right (merged cells), whitespace collapsed, and ``banner :: label``
    built unless the label is an identity column. A header on row 0 has no banner. Blank cells
    are not stored, so the columns are those of the header, the banner and the body: a column whose
    label is blank under a merged banner takes the banner. With ``profile``, the column profile of all cells, ``cells`` may
    be those of the header search rows alone."""
    h = cells.join(headers, SHEET_KEY)
    label = h.where(F.col("row") == F.col("header_row")).select(*SHEET_KEY, "col", C.collapse_ws("value").alias("label"))
    banner = h.where(F.col("row") == F.col("header_row") - 1).select(
        *SHEET_KEY, "col", C.collapse_ws("value").alias("banner_raw"))
    body = (profile or column_profile(cells)).join(headers, SHEET_KEY).where(F.col("last_row") > F.col("header_row")).select(*SHEET_KEY, "col")
    both = label.join(banner, [*SHEET_KEY, "col"], "full").join(body, [*SHEET_KEY, "col"], "full")
    w = Window.partitionBy(*SHEET_KEY).orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(F.when(F.col("banner_raw") != "", F.col("banner_raw")), ignorenulls=True).over(w),
                        F.lit(""))
    both = both.withColumn("banner", filled).withColumn("label", F.coalesce("label", F.lit("")))
    return both.select(*SHEET_KEY, "col", "banner", "label",
                       compound_label(F.col("banner"), F.col("label")).alias("compound"))


def compound_label(banner: Column, label: Column) -> Column:
    """``banner :: label`` when both are non-empty and the label is not an identity column;
    otherwise the label, else the banner (C4)."""
    b = F.coalesce(C.collapse_ws(banner), F.lit(""))
    lab = F.coalesce(C.collapse_ws(label), F.lit(""))
    return (F.when((lab != "") & (b != "") & ~F.lower(lab).isin(*IDENTITY_LABELS), F.concat(b, F.lit(" :: "), lab))
            .when(lab != "", lab).otherwise(b))


def forward_fill(df: DataFrame, key_cols: list[str], order_cols: list[str], value_col: str, out_col: str,
                 bucket: Column) -> DataFrame:
    """``last_value(value IGNORE NULLS)`` per key in ``order_cols`` order (C3), without
    putting a whole key in one task: rows are filled within (key, bucket) windows, each
    bucket's last non-NULL value is carried forward over the per-bucket aggregate (one
    row per key and bucket), and the carry is joined back for rows that found nothing in
    their own bucket. ``bucket`` must be monotone in ``order_cols`` (e.g. the hour)."""
    order = F.struct(*order_cols)
    b = df.withColumn("_bucket", bucket)
    w_local = Window.partitionBy(*key_cols, "_bucket").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumn("_local", F.last(value_col, ignorenulls=True).over(w_local))
    per_bucket = b.groupBy(*key_cols, "_bucket").agg(
        F.max_by(F.col(value_col), F.when(F.col(value_col).isNotNull(), order)).alias("_bucket_last"))
    w_carry = Window.partitionBy(*key_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*key_cols, "_bucket", F.last("_bucket_last", ignorenulls=True).over(w_carry).alias("_carry"))
    out = local.join(carry, [*key_cols, "_bucket"], "left")
    return out.withColumn(out_col, F.coalesce("_local", "_carry")).drop("_bucket", "_local", "_carry")


# ----------------------------------------------------------------- C5 mapping
def label_matches(norm: Column, patterns: tuple[str, ...]) -> Column:
    """Whether a lower-cased, space-collapsed label matches any of a registry column's patterns."""
    m = F.lit(False)
    for p in patterns:
        m = m | norm.rlike("(?i)" + p)
    return m


def map_columns(labels: DataFrame, registry: Registry) -> DataFrame:
    """Greedy one-to-one mapping (C5): for each registry column in order, the first
    (leftmost) unused source column whose normalised label matches any pattern.

    Per sheet, the matching column indexes of each spec are gathered (bounded by the
    sheet width) and the sequential greedy choice is one ``aggregate`` fold over the
    registry order, carrying the set of used columns: no driver loop, no pandas, and an
    expression whose size is linear in the registry. Mapping by column index means two
    identical labels cannot both take a canonical name.
    """
    norm = F.lower(C.collapse_ws("compound"))
    specs = registry.columns
    lab = labels.where(F.col("compound") != "").select(*SHEET_KEY, "col", norm.alias("norm"))
    aggs = [F.array_sort(F.collect_list(F.when(label_matches(F.col("norm"), s.patterns), F.col("col")))).alias(f"_m{i}")
            for i, s in enumerate(specs)]
    per_sheet = lab.groupBy(*SHEET_KEY).agg(*aggs)
    matches = F.array(*[F.col(f"_m{i}") for i in range(len(specs))])
    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<int>").alias("chosen"))

    def step(acc: Column, m: Column) -> Column:
        pick = F.array_min(F.array_except(m, acc["used"]))
        return F.struct(F.array_union(acc["used"], F.array(F.coalesce(pick, F.lit(-1)))).alias("used"),
                        F.concat(acc["chosen"], F.array(pick)).alias("chosen"))

    folded = per_sheet.select(*SHEET_KEY, F.aggregate(matches, start, step)["chosen"].alias("chosen"))
    names = F.array(*[F.lit(s.canonical) for s in specs])
    m = folded.select(*SHEET_KEY, F.posexplode("chosen").alias("spec_order", "col")).select(
        *SHEET_KEY, F.element_at(names, F.col("spec_order") + 1).alias("canonical"), "spec_order", "col")
    return m.where(F.col("col").isNotNull()).join(labels.select(*SHEET_KEY, "col", "compound"), [*SHEET_KEY, "col"])


def missing_specs(headers: DataFrame, mapping: DataFrame, registry: Registry) -> DataFrame:
    """Registry columns with no source column, per sheet."""
    specs = F.array(*[F.struct(F.lit(s.canonical).alias("canonical"), F.lit(i).alias("spec_order"),
                               F.lit(s.required).alias("required"),
                               F.lit(_pattern_text(s.patterns[0])).alias("expected_label"))
                      for i, s in enumerate(registry.columns)])
    allspecs = headers.select(*SHEET_KEY, F.explode(specs).alias("s")).select(*SHEET_KEY, "s.*")
    return allspecs.join(mapping.select(*SHEET_KEY, "canonical"), [*SHEET_KEY, "canonical"], "left_anti")


def _pattern_text(p: str) -> str:
    """A pattern as plain text, for similarity scoring of renamed columns."""
    out = p.replace("[(]", "(").replace("[)]", ")").replace(".*", " ")
    return out.strip("^$").strip()


# ----------------------------------------------------------------- C6–C8
def cells_to_wide(cells: DataFrame, headers: DataFrame, mapping: DataFrame, registry: Registry) -> DataFrame:
    """Body cells below the header, pivoted to one column per canonical name.
    Unmapped columns are dropped; the pivot list is fixed, so no extra pass is planned. A cell's column is known
    by its place in the registry, one number to compare, not a name for each column."""
    names = F.array(*[F.lit(c) for c in registry.canonical])
    places = mapping.select(*SHEET_KEY, "col", F.array_position(names, F.col("canonical")).alias("place"))
    body = cells.join(headers, SHEET_KEY).where(F.col("row") > F.col("header_row")).join(places, [*SHEET_KEY, "col"])
    # The row leads the key: texts have no hash aggregate, and a sort by workbook names compares their common beginning.
    wide = body.groupBy("row", *SHEET_KEY).agg(*[
        F.first(F.when(F.col("place") == i, F.col("value")), ignorenulls=True).alias(c) for i, c in enumerate(registry.canonical, 1)])
    return wide.select(*SHEET_KEY, "row", *registry.canonical)


def rows_to_wide(rows: DataFrame, headers: DataFrame, mapping: DataFrame, registry: Registry) -> DataFrame:
    """:func:`cells_to_wide` for rows that hold all their values (file, sheet, row, values), each row once: a mapped column is taken
    from its place, so no cell is shuffled. Blank values come as they are, and so do rows without any other: the coercions
    (C9-C11) make both NULL, and a row without a code goes with them."""
    at = [F.min(F.when(F.col("canonical") == c, F.col("col"))).alias(f"_at_{c}") for c in registry.canonical]
    body = rows.join(headers.join(mapping.groupBy(*SHEET_KEY).agg(*at), SHEET_KEY), SHEET_KEY).where(F.col("row") > F.col("header_row"))
    return body.select(*SHEET_KEY, "row", *[F.get("values", F.col(f"_at_{c}")).alias(c) for c in registry.canonical])


def stop_at_blank_row(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Keep the rows before the first entirely blank row after the header (C8); sheets without a
    header keep all. Blank cells are not stored, so a blank row is one without cells: the row after the
    first row, header included, that has no successor. Rows meet their predecessor in an aggregate by row number,
    so no window holds a whole sheet."""
    rows = cells.join(headers, SHEET_KEY).where(F.col("row") >= F.col("header_row")).select(*SHEET_KEY, "row").distinct()
    # Each row stands for itself and, one below, for the row before it.
    at = rows.select(*SHEET_KEY, F.explode(F.array(F.struct("row", F.lit(True).alias("held")),
                                                   F.struct((F.col("row") + 1).alias("row"), F.lit(False).alias("held")))).alias("x"))
    blank = at.groupBy(*SHEET_KEY, "x.row").agg(F.bool_or("x.held").alias("held")).where(~F.col("held"))
    cut = blank.groupBy(*SHEET_KEY).agg(F.min("row").alias("_blank"))
    return (cells.join(cut, SHEET_KEY, "left")
            .where(F.col("_blank").isNull() | (F.col("row") < F.col("_blank"))).drop("_blank"))


def drop_footnotes(wide: DataFrame, code_pattern: str = FOOTNOTE_CODE_PATTERN,
                   name_pattern: str = FOOTNOTE_NAME_PATTERN) -> DataFrame:
    """Drop rows with no code, the '-' aggregate code, codes mentioning note / source /
    total / England, and names equal to England or starting with Total / Note (C7).
    A NULL name is kept."""
    code, name = F.col("org_code"), F.col("org_name")
    return wide.where(code.isNotNull() & (F.trim(code) != "-") & ~code.rlike(code_pattern)
                      & F.coalesce(~name.rlike(name_pattern), F.lit(True)))


PERCENT_SALTS = 64


def normalise_percent(df: DataFrame, group_cols: list[str], pct_cols: list[str], keep: Keep = as_planned) -> DataFrame:
    """Put percent columns on a 0–100 scale (C10): a column is multiplied by 100 within a
    group (a workbook) when every value of it in that group lies within [-1, 1]. The
    per-group maxima are one partial/final aggregate joined back on the group key and a
    salt of the row, so a workbook with a third of all rows is spread over tasks. ``keep`` may write them, so that few
    groups are known to be few."""
    if not pct_cols:
        return df
    scale = df.groupBy(*group_cols).agg(*[F.max(F.abs(c)).alias(f"_max_{c}") for c in pct_cols])
    scale = keep(scale).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(PERCENT_SALTS - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(PERCENT_SALTS)).cast("int"))
    out = salted.join(scale, [*group_cols, "_salt"], "left").drop("_salt")
    for c in pct_cols:
        factor = F.when(F.col(f"_max_{c}") <= 1, F.lit(100)).otherwise(F.lit(1))
        out = out.withColumn(c, (F.col(c) * factor).cast("decimal(18,6)")).drop(f"_max_{c}")
    return out


# ----------------------------------------------------------------- C9–C11
def coerce_types(wide: DataFrame, registry: Registry, normalise: bool = True, keep: Keep = as_planned, keep_rows: Keep = as_planned) -> DataFrame:
    """Registry dtypes (C9–C11). Percent columns are put on a 0–100 scale per workbook and
    column when every value of that column in the workbook lies within [-1, 1] (C10). ``keep_rows`` may write the coerced rows,
    which that scale and the result are read from."""
    pct_cols = [s.canonical for s in registry.columns if s.dtype == "percent"]
    int_cols = [s.canonical for s in registry.columns if s.dtype == "integer"]
    # The integers as one array: one expression for all of them, where one each makes a method too long to be compiled.
    ints = F.transform(F.array(*int_cols), C.coerce_int) if int_cols else F.lit(None)
    coerced = {c: F.col("_ints")[i] for i, c in enumerate(int_cols)} | {c: C.coerce_pct_raw(c) for c in pct_cols}
    out = wide.withColumn("_ints", ints).withColumns(
        {s.canonical: coerced.get(s.canonical, C.coerce_text(s.canonical)) for s in registry.columns}).drop("_ints")
    out = keep_rows(out)
    if normalise:
        out = normalise_percent(out, ["file"], pct_cols, keep)
    return out.where(F.col("org_code").isNotNull())


def coerce_rejects(wide: DataFrame, registry: Registry) -> DataFrame:
    """Raw non-blank values that did not survive coercion, per workbook and column."""
    aggs = []
    for s in registry.columns:
        if s.dtype == "integer":
            bad = C.coerce_int_rejected(s.canonical)
        elif s.dtype == "percent":
            bad = C.coerce_text(s.canonical).isNotNull() & C.coerce_pct_raw(s.canonical).isNull()
        else:
            continue
        aggs.append(F.struct(F.lit(s.canonical).alias("canonical"), F.count_if(bad).alias("rejected"),
                             F.count(C.coerce_text(s.canonical)).alias("non_blank")))
    g = wide.groupBy("file").agg(F.array(*aggs).alias("a"))
    return g.select("file", F.explode("a").alias("r")).select("file", "r.canonical", "r.rejected", "r.non_blank")


# ----------------------------------------------------------------- C12–C14
def parse_month_text(v: Column) -> Column:
    """Month text -> first of month (C12, C13): a month word with a 2- or 4-digit year
    ('May 26', 'June 2015', "Sept '24", 'Jun-15'), an ISO date, or a spreadsheet day
    serial of five digits (a bare year is no period). Two-digit years below 70 are 20xx, others 19xx."""
    s = F.trim(v)
    word = F.lower(F.regexp_extract(s, C.PERIOD_TEXT_PATTERN, 1))
    yy = F.regexp_extract(s, C.PERIOD_TEXT_PATTERN, 2)
    month = F.array_position(F.array(*[F.lit(m) for m in C.MONTH_WORDS]), word)
    year = (F.when(F.length(yy) == 4, yy.cast("int"))
            .when(F.length(yy) == 2, F.when(yy.cast("int") < 70, 2000 + yy.cast("int")).otherwise(1900 + yy.cast("int"))))
    from_words = F.when((word != "") & (month > 0), F.make_date(year, month.cast("int"), F.lit(1)))
    iso = F.trunc(F.try_to_date(F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd"), "month")
    serial_txt = F.regexp_extract(s, r"^(\d{5})(\.0+)?$", 1)
    serial = F.when(serial_txt != "", F.trunc(F.date_add(F.lit("1899-12-30").cast("date"), serial_txt.cast("int")), "month"))
    return F.coalesce(from_words, iso, serial)


def extract_period(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """The reporting month from the metadata block (C12): within the first 14 rows, the
    first cell starting with 'period'; the first non-blank cell to its right that parses."""
    c = cells.join(sheets, SHEET_KEY, "left_semi").where(F.col("row") < METADATA_ROWS)
    anchors = c.where(F.lower(F.trim("value")).startswith(PERIOD_ANCHOR)).select(
        *SHEET_KEY, "row", F.col("col").alias("anchor_col"))
    cand = (c.join(anchors, [*SHEET_KEY, "row"]).where(F.col("col") > F.col("anchor_col"))
            .withColumn("period_date", parse_month_text(F.col("value"))).where(F.col("period_date").isNotNull()))
    first = cand.groupBy(*SHEET_KEY).agg(F.min(F.struct("row", "anchor_col", "col", "period_date")).alias("m"))
    return first.select(*SHEET_KEY, F.col("m.period_date").alias("period_date"))
