"""Grid sources: spreadsheets as a long cells table ``(file, sheet, row, col, value)`` (A2).

Two producers:

- :func:`read_grid_csv` reads sheets exported as CSV text (one file per sheet, named
  ``<workbook>__<sheet>.csv``), :func:`read_sheets` those that :func:`write_sheets` wrote in
  parts. Files are read by lines in Spark's own splits, so a sheet may be far larger than a task's memory.
- :func:`render_activity_grid` lays the analogue's staged rows out as published monthly
  workbooks (branding rows, merged banner, two-row header, England total, footnotes,
  a notes sheet, column renames and additions over time), so the grid parser runs on
  data Spark derives from the driver tables.

Blank cells are not stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edpanel import session
from edpanel.functions import columns as C
from edpanel.sources import seeds

CELL_COLUMNS = ("file", "sheet", "row", "col", "value")
# Separators put in place of line breaks and commas outside quotes; spreadsheet text cannot hold them.
ROW_MARK, FIELD_MARK = "\x1e", "\x1f"
PART_ROWS = 10_000                # rows of a sheet per written file


def rows_of_text(sheets: DataFrame) -> DataFrame:
    """CSV texts held in rows (file, sheet, text, first_row) -> the rows of the sheets (file, sheet, row, values)."""
    rows = sheets.select("file", "sheet", "first_row", F.posexplode(text_rows(F.col("text"))).alias("at", "line"))
    # Generated, not projected: else every later filter on a value would cut the line anew.
    return rows.select("file", "sheet", (F.col("first_row") + F.col("at")).cast("int").alias("row"), F.explode(F.array(line_values(F.col("line")))).alias("values"))


def cells_of_text(sheets: DataFrame) -> DataFrame:
    """CSV texts held in rows (file, sheet, text, first_row) -> cells."""
    return cells_of_rows(rows_of_text(sheets))


def parts_overlap(sheets: DataFrame) -> bool:
    """Whether the texts of some sheet hold a row twice, as the parts of a sheet should not."""
    text = F.col("text")
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    end = F.col("first_row") + F.when(F.contains(text, F.lit('"')), F.size(text_rows(text))).otherwise(breaks + 1)
    after = F.lead("first_row").over(Window.partitionBy("file", "sheet").orderBy("first_row"))         # a sheet's parts
    parts = sheets.select("file", "sheet", "first_row", end.alias("end"))
    return not parts.where(F.col("end").isNotNull()).withColumn("after", after).where(F.col("after") < F.col("end")).isEmpty()


def text_rows(text: F.Column) -> F.Column:
    """A CSV text cut into its rows at the line breaks outside quotes (in the even ones of the pieces between quotes);
    a text without quotes at all its line breaks."""
    text = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    pieces = F.transform(F.split(text, '"'), lambda x, i: F.when(i % 2 == 0, F.replace(x, F.lit("\n"), F.lit(ROW_MARK))).otherwise(x))
    return F.when(F.contains(text, F.lit('"')), F.split(F.array_join(pieces, '"'), ROW_MARK)).otherwise(F.split(text, "\n"))


def line_values(line: F.Column) -> F.Column:
    """The values of a row of CSV text. A line is cut at its quotes, and only the pieces outside them (the even ones)
    have their commas marked; one without quotes is cut at its commas."""
    pieces = F.transform(F.split(line, '"'), lambda x, i: F.when(i % 2 == 0, F.replace(x, F.lit(","), F.lit(FIELD_MARK))).otherwise(x))
    values = F.transform(F.split(F.array_join(pieces, '"'), FIELD_MARK),
                         lambda x: F.replace(F.regexp_replace(x, r'(?s)^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))
    return F.when(F.contains(line, F.lit('"')), values).otherwise(F.split(line, ","))


def cells_of_rows(rows: DataFrame) -> DataFrame:
    """Rows of values (file, sheet, row, values) -> cells."""
    cells = rows.select("file", "sheet", F.col("row").cast("int").alias("row"), F.posexplode("values").alias("col", "value"))
    return cells.select("file", "sheet", "row", "col", "value").where(F.trim("value") != "")


def cells_of_lines(lines: DataFrame) -> DataFrame:
    """Lines of CSV sheets (file, sheet, first_row, path, block, at, line) -> cells.

    Quotes may enclose commas, doubled quotes and line breaks, so a line begins a row only where an even number
    of quotes of its file lie before it. ``at`` orders the lines of a block (a split of a file), ``block`` those of
    a file: each block gives its quote count and its row starts for both parities on entry; a prefix sum over
    the blocks of a file tells every block how it begins and the row it begins with. Windows over lines hold one
    block. Lines that are a whole row go straight to cells; only the lines of rows that span several meet again.
    A quote that is never closed makes the rest of its file one cell. ``\r\n`` counts as ``\n``."""
    split = ["file", "sheet", "first_row", "path", "block"]
    text = F.regexp_replace("line", "\r$", "")
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    within = Window.partitionBy("path", "block").orderBy("at")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = lines.select(*split, "at", text.alias("line"), quotes.alias("quotes")).withColumn(
        "odd", (F.sum("quotes").over(upto) - F.col("quotes")) % 2)          # parity inside the block, before the line
    n = n.withColumn("starts", F.struct(F.sum(1 - F.col("odd")).over(upto).alias("even"), F.sum("odd").over(upto).alias("odd")))
    blocks = n.groupBy("path", "block").agg((F.sum("quotes") % 2).alias("parity"), F.count_if(F.col("odd") == 0).alias("even"),
                                            F.count_if(F.col("odd") == 1).alias("odds"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entry = blocks.withColumn("entry", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    entry = entry.withColumn("rows_before", F.coalesce(F.sum(F.when(F.col("entry") == 0, F.col("even")).otherwise(F.col("odds")))
                                                       .over(earlier), F.lit(0)))
    n = n.join(entry.select("path", "block", "entry", "rows_before"), ["path", "block"])
    begun = F.when(F.col("entry") == 0, F.col("starts.even")).otherwise(F.col("starts.odd"))
    inside = (F.col("odd") + F.col("entry")) % 2 == 1                        # the line begins inside quotes
    # Written once: the whole rows and the parts of rows are read from it, not each by windows of their own.
    n = session.store(n.select("file", "sheet", "path", "block", "at", "line", (inside | (F.col("quotes") % 2 == 1)).alias("spans"),
                               (F.col("first_row") + F.col("rows_before") + begun - 1).alias("row")))
    whole = n.where(~F.col("spans")).select("file", "sheet", "row", "line")
    parts = n.where("spans").groupBy("file", "sheet", "path", "row").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("lines"))
    joined = parts.select("file", "sheet", "row", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("line"))
    return cells_of_rows(whole.unionByName(joined).select("file", "sheet", "row", line_values(F.col("line")).alias("values")))


def _lines(scan: DataFrame, file: F.Column, sheet: F.Column, first_row: F.Column) -> DataFrame:
    """Lines of a text scan with their place: the file, the offset of its split, and the order inside the task."""
    return scan.select(file.alias("file"), sheet.alias("sheet"), first_row.alias("first_row"), F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
                       F.col("value").alias("line"))


def read_grid_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV-exported sheets ``<workbook>__<sheet>.csv`` -> cells. ``path`` may be a folder or a glob."""
    base = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    parts = F.split(base, "__", 2)
    scan = spark.read.option("lineSep", "\n").text(path)
    return cells_of_lines(_lines(scan, parts[0], F.coalesce(F.get(parts, F.lit(1)), F.lit("Sheet1")), F.lit(0)))


SHEET_ORDER_SCHEMA = "file string, sheet string, sheet_index int"


def sheet_order(spark: SparkSession, path: str) -> DataFrame:
    """The sheets of each workbook in their order, of a CSV beside the exported sheets
    (file, sheet, sheet_index): a folder of CSV files does not keep it."""
    return seeds.read_seed(spark, path, SHEET_ORDER_SCHEMA)


def _joined(items: F.Column, at: str, text: str, mark: str) -> F.Column:
    """Texts of sorted structs joined by as many marks as their positions lie apart."""
    def item(x, i):
        before = F.when(i == 0, F.lit(0)).otherwise(F.get(items, i - 1)[at])
        return F.concat(F.repeat(F.lit(mark), x[at] - before), x[text])
    return F.array_join(F.transform(items, item), "")


def _quoted(value: F.Column) -> F.Column:
    return F.when(value.rlike('[",\r\n]'), F.concat(F.lit('"'), F.regexp_replace(value, '"', '""'), F.lit('"'))).otherwise(value)


def sheet_lines(cells: DataFrame) -> DataFrame:
    """Cells -> the sheets' rows as lines of CSV text (file, sheet, row, line)."""
    # The row leads the key: a sort by workbook names compares their common beginning.
    lines = cells.groupBy("row", "file", "sheet").agg(F.sort_array(F.collect_list(F.struct("col", _quoted(F.col("value")).alias("field")))).alias("cells"))
    return lines.select("file", "sheet", "row", _joined(F.col("cells"), "col", "field", ",").alias("line"))


def texts_of_lines(lines: DataFrame) -> DataFrame:
    """Lines (file, sheet, row, line) -> CSV text (file, sheet, first_row, text). A text holds PART_ROWS rows of a sheet at
    most, so no task gathers a whole long sheet. The lines meet before they are gathered, so none is gathered twice."""
    first = (F.col("row") - F.col("row") % PART_ROWS).alias("first_row")
    rows = lines.select("file", "sheet", first, F.struct((F.col("row") % PART_ROWS).alias("at"), "line").alias("row"))
    texts = rows.repartition("first_row", "file", "sheet").groupBy("first_row", "file", "sheet").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return texts.select("file", "sheet", "first_row", _joined(F.col("rows"), "at", "line", "\n").alias("text"))


def sheet_texts(cells: DataFrame) -> DataFrame:
    """Cells -> CSV text (file, sheet, first_row, text), in parts as :func:`texts_of_lines` makes them."""
    return texts_of_lines(sheet_lines(cells))


def write_sheets(cells: DataFrame, folder: str) -> None:
    """The sheets' CSV text under ``file=/sheet=/first_row=`` folders."""
    sheet_texts(cells).write.partitionBy("file", "sheet", "first_row").text(folder)


def read_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the sheets written by :func:`write_sheets`."""
    schema = "value string, file string, sheet string, first_row int"
    scan = spark.read.schema(schema).option("lineSep", "\n").text(folder)
    return cells_of_lines(_lines(scan, F.col("file"), F.col("sheet"), F.col("first_row")))


# ----------------------------------------------------------------- analogue render
# Fixed layout of the analogue workbook: (column, banner, label, staged source column).
BANNER_ATT = "A&E attendances"
BANNER_BREACH = "A&E attendances greater than 4 hours from arrival to admission, transfer or discharge"
BANNER_ADM = "Emergency Admissions"
LAYOUT = [
    (0, None, "Code", "org_code"),
    (1, None, "Region", "icb_name"),
    (2, None, "Name", "org_name"),
    (3, BANNER_ATT, "Type 1 Departments - Major A&E", "attendances_type1"),
    (4, None, "Type 2 Departments - Single Specialty", "attendances_type2"),
    (5, None, "Type 3 Departments - Other A&E/Minor Injury Unit", "attendances_type3"),
    (6, None, "Total attendances", "attendances_total"),
    (7, BANNER_BREACH, "Type 1 Departments - Major A&E", "breaches_type1"),
    (8, None, "Type 2 Departments - Single Specialty", "breaches_type2"),
    (9, None, "Type 3 Departments - Other A&E/Minor Injury Unit", "breaches_type3"),
    (10, None, "Total Attendances > 4 hours", "breaches_total"),
    (11, None, "Percentage in 4 hours or less (all)", "performance_text"),
    (12, BANNER_ADM, "Emergency Admissions via Type 1 A&E", "emergency_admissions_type1"),
    (13, None, "Emergency Admissions via Type 2 A&E", "emergency_admissions_type2"),
    (14, None, "Emergency Admissions via Type 3 and 4 A&E", "emergency_admissions_type3"),
    (15, None, "Total Emergency Admissions via A&E", "emergency_admissions_via_ae"),
    (16, None, "Other Emergency admissions (i.e not via A&E)", "emergency_admissions_other"),
    (17, None, "Total Emergency Admissions", "emergency_admissions_total"),
    (18, None, "Number of patients spending >4 hours from decision to admit to admission", "dta_breaches_4hr"),
    (19, None, "Number of patients spending >12 hours from decision to admit to admission", "dta_breaches_12hr"),
]
TEXT_COLUMNS = 3                               # the first columns hold texts, the others numbers, which need no quotes
RENAMED_TOTAL_LABEL = "Total Attendance"      # label used before RENAME_UNTIL
RENAME_UNTIL = "1996-01-01"
EXTRA_FROM = "2001-01-01"                      # an extra column appears from this month
EXTRA_COLUMN = (20, "Appointments", "Booked Type 1 appointments", "attendances_type1")
DATA_SHEET, NOTES_SHEET = "Provider Level Data", "Notes"
TITLE = "A&E Attendances and Emergency Admissions"
PERIOD_FORMATS = ("MMMM yyyy", "MMM yyyy", "MMM-yyyy")


def workbook_name(period: F.Column) -> F.Column:
    return F.concat(F.lit("ae-activity-"), F.date_format(period, "yyyy-MM"), F.lit(".xls"))


def branding_rows(period: F.Column) -> F.Column:
    """Number of rows above the banner: 2, 5, 8 or 11 depending on the month."""
    return (F.pmod(F.month(period), F.lit(4)) * 3 + 2).cast("int")


def _period_text(period: F.Column) -> F.Column:
    k = F.pmod(F.month(period), F.lit(3))
    return (F.when(k == 0, F.date_format(period, PERIOD_FORMATS[0]))
            .when(k == 1, F.date_format(period, PERIOD_FORMATS[1]))
            .otherwise(F.date_format(period, PERIOD_FORMATS[2])))


def _int_text(c: F.Column) -> F.Column:
    return c.cast("string")


def _performance_text(within: F.Column, total: F.Column, as_fraction: F.Column) -> F.Column:
    """Source percentage as published: a 0–1 fraction (3 dp) in even years, 0–100 (1 dp)
    in odd years, rounded half up from the integer counts."""
    safe_t = F.when(total == 0, F.lit(1)).otherwise(total)
    milli = C.int_div(F.lit(2000) * within + safe_t, F.lit(2) * safe_t)
    tenths = C.pct_tenths(within, total)
    frac = F.concat(C.int_div(milli, F.lit(1000)).cast("string"), F.lit("."),
                    F.lpad(F.pmod(milli, F.lit(1000)).cast("string"), 3, "0"))
    pct = F.concat(C.int_div(tenths, F.lit(10)).cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"))
    return F.when(total > 0, F.when(as_fraction, frac).otherwise(pct))


def provider_number(org_code: F.Column) -> F.Column:
    """The place of a provider's row in the body of a workbook."""
    return F.regexp_extract(org_code, r"(\d+)", 1).cast("int")


def _body(rows: DataFrame) -> DataFrame:
    """The body of the workbooks: the staged rows with the place and the texts of their cells."""
    p = F.col("period_date")
    performance = _performance_text(F.col("attendances_total") - F.col("breaches_total"), F.col("attendances_total"), F.pmod(F.year(p), F.lit(2)) == 0)
    return rows.select(workbook_name(p).alias("file"), F.lit(DATA_SHEET).alias("sheet"),
                       (branding_rows(p) + 3 + provider_number(F.col("org_code"))).alias("row"), "*", performance.alias("performance_text"))


def _body_values() -> list[F.Column]:
    """The texts of a body row in the order of their columns, NULL where it has no cell."""
    extra = F.when(F.col("period_date") >= F.lit(EXTRA_FROM).cast("date"), _int_text(F.col(EXTRA_COLUMN[3])))
    return [*(_int_text(F.col(src)) for _, _, _, src in LAYOUT), extra]


def render_activity_grid(rows: DataFrame) -> DataFrame:
    """Lay staged rows out as one workbook per month.

    ``rows``: period_date, org_code, org_name, icb_name + activity counts (including type 2/3
    breaches and admissions). They are read twice, for the months and for the body: give a written table.
    """
    return _body_cells(_body(rows)).unionByName(_frame_cells(rows))


def _body_cells(body: DataFrame) -> DataFrame:
    structs = [F.struct(F.lit(c).alias("col"), v.alias("value")) for c, v in enumerate(_body_values())]
    cells = body.select("file", "sheet", "row", F.explode(F.array(*structs)).alias("c"))
    return cells.select("file", "sheet", "row", "c.col", "c.value").where(F.col("value").isNotNull())


def render_activity_texts(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """What :func:`sheet_texts` gives for :func:`render_activity_grid`, with a body row's line made where the row
    is laid out: its cells are not shuffled. ``shared`` has the provider numbers (number) that several providers hold, whose rows
    meet in one line of a workbook; they and the rows without a month go through their cells."""
    number = provider_number(F.col("org_code"))
    # Rows with a total end with a number, so the commas behind it stand for no cell.
    plain = F.col("period_date").isNotNull() & F.col("org_code").isNotNull() & F.col("attendances_total").isNotNull()
    alone = rows.where(plain).join(shared, number == F.col("number"), "left_anti")
    values = _body_values()
    # The texts as one array: a function over it also keeps the many columns out of one method too long to be compiled.
    texts = F.transform(F.array(*values[:TEXT_COLUMNS]), _quoted)
    line = F.rtrim(F.array_join(F.concat(texts, F.array(*values[TEXT_COLUMNS:])), ",", ""), F.lit(","))
    lines = _body(alone).select("file", "sheet", "row", line.alias("line"))
    others = rows.where(~plain).unionByName(rows.where(plain).join(shared, number == F.col("number"), "left_semi"))
    return texts_of_lines(lines.unionByName(sheet_lines(_body_cells(_body(others)).unionByName(_frame_cells(rows)))))


def _frame_cells(rows: DataFrame) -> DataFrame:
    """The cells of the workbooks around their bodies: branding, header, totals, notes."""
    p = F.col("period_date")
    b = branding_rows(p)
    row = b + 3 + provider_number(F.col("org_code"))
    extra_c = EXTRA_COLUMN[0]
    # One row a month, from which all but the body is laid out.
    periods = session.store(rows.groupBy("period_date").agg(
        F.max(row).alias("last_row"), F.sum("attendances_total").cast("bigint").alias("t"), F.sum("breaches_total").cast("bigint").alias("br")))
    header_structs = []
    for c, banner, label, _ in LAYOUT:
        if banner:
            header_structs.append(F.struct(F.lit(-1).alias("dr"), F.lit(c).alias("col"), F.lit(banner).alias("value")))
        lab = F.lit(label)
        if label == "Total attendances":
            lab = F.when(p < F.lit(RENAME_UNTIL).cast("date"), F.lit(RENAMED_TOTAL_LABEL)).otherwise(lab)
        header_structs.append(F.struct(F.lit(0).alias("dr"), F.lit(c).alias("col"), lab.alias("value")))
    _, xb, xl, _ = EXTRA_COLUMN
    is_extra = p >= F.lit(EXTRA_FROM).cast("date")
    header_structs += [F.struct(F.lit(-1).alias("dr"), F.lit(extra_c).alias("col"), F.when(is_extra, F.lit(xb)).alias("value")),
                       F.struct(F.lit(0).alias("dr"), F.lit(extra_c).alias("col"), F.when(is_extra, F.lit(xl)).alias("value"))]
    meta_structs = [F.struct(F.lit(0).alias("r"), F.lit(0).alias("col"), F.lit(TITLE).alias("value")),
                    F.struct(F.lit(1).alias("r"), F.lit(0).alias("col"), F.lit("Period:").alias("value")),
                    F.struct(F.lit(1).alias("r"), F.lit(2).alias("col"), _period_text(p).alias("value"))]
    header = periods.select(workbook_name(p).alias("file"), F.lit(DATA_SHEET).alias("sheet"),
                            (b + 1).alias("label_row"), F.explode(F.array(*header_structs)).alias("h"))
    header_cells = header.select("file", "sheet", (F.col("label_row") + F.col("h.dr")).alias("row"),
                                 "h.col", "h.value")
    meta_cells = periods.select(workbook_name(p).alias("file"), F.lit(DATA_SHEET).alias("sheet"),
                                F.explode(F.array(*meta_structs)).alias("m")).select(
        "file", "sheet", F.col("m.r").alias("row"), "m.col", "m.value")
    source_rows = periods.select(workbook_name(p).alias("file"), F.lit(DATA_SHEET).alias("sheet"),
                                 F.explode(F.when(b > 2, F.sequence(F.lit(2), b - 1))).alias("row")).select(
        "file", "sheet", "row", F.lit(0).alias("col"),
        F.concat(F.lit("Source: monthly situation report, release line "), F.col("row").cast("string")).alias("value"))

    # England total row right under the header, footnotes after the last provider.
    total_cells = periods.select(workbook_name(p).alias("file"), F.lit(DATA_SHEET).alias("sheet"),
                                (b + 2).alias("row"),
                                F.explode(F.array(F.struct(F.lit(0).alias("col"), F.lit("-").alias("value")),
                                                  F.struct(F.lit(2).alias("col"), F.lit("England").alias("value")),
                                                  F.struct(F.lit(6).alias("col"), F.col("t").cast("string").alias("value")),
                                                  F.struct(F.lit(10).alias("col"), F.col("br").cast("string").alias("value"))))
                                .alias("c")).select("file", "sheet", "row", "c.col", "c.value")
    notes_rows = periods.select(workbook_name(p).alias("file"), F.lit(DATA_SHEET).alias("sheet"), F.explode(F.array(
        F.struct((F.col("last_row") + 2).alias("row"), F.lit(0).alias("col"),
                 F.lit("Note: figures for the latest month are provisional").alias("value")),
        F.struct((F.col("last_row") + 3).alias("row"), F.lit(0).alias("col"),
                 F.lit("Total for England includes independent sector providers").alias("value")))).alias("n")).select(
        "file", "sheet", "n.row", "n.col", "n.value")
    notes_sheet = periods.select(workbook_name(p).alias("file"), F.lit(NOTES_SHEET).alias("sheet"), F.explode(F.array(
        F.struct(F.lit(0).alias("row"), F.lit("Notes").alias("value")),
        F.struct(F.lit(1).alias("row"), F.lit("Figures are provisional and subject to revision").alias("value")),
        F.struct(F.lit(2).alias("row"), F.lit("Type 1: consultant-led 24-hour service").alias("value")))).alias("n")).select(
        "file", "sheet", "n.row", F.lit(0).alias("col"), "n.value")

    allc = (header_cells.unionByName(meta_cells).unionByName(source_rows)
            .unionByName(total_cells).unionByName(notes_rows).unionByName(notes_sheet))
    return allc.where(F.col("value").isNotNull()).select(
        "file", "sheet", F.col("row").cast("int"), F.col("col").cast("int"), F.col("value").cast("string"))
