"""The whole load as one incremental run (J1 over A1–H12): every availableNow run takes the
workbooks that landed since the last one through skip, parse, drift policy, quality gate, version
merge, staging replace, catalog and audit.

Exactly-once over several sinks: a batch only reads the state that earlier batches left (catalog
rows, versions), all its times come from the data, and every sink is keyed by the batch: appends go
to the batch's own folder, the version table to the batch's own version, staging replaces periods.
A sink that ended has a row in the ledger and is not written again; one that was cut off is
written again with the same content. So a batch that is replayed after a crash at any point leaves
what an uninterrupted one leaves.

Write, audit, publish: parsed rows are written once to the batch's pending folder and measured by
``observe`` in that same write. Only when the measures pass are they published; otherwise the run is
recorded as failed and all tables stay as they were.

Landing layout: Parquet rows (source_name, file_name, source_url, published_at, sheet, first_row,
text), a sheet's CSV text in parts; a workbook's rows lie in one Parquet file, so in one batch. A batch may hold
several workbooks of one name (a file that lands again beside its revision): the Parquet file tells them apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from edpanel.operators import changes, sinks
from edpanel.plans import ingest, quality
from edpanel.session import path_exists
from edpanel.sources.registry import Registry

LANDING = ("source_name string, file_name string, source_url string, published_at timestamp_ntz, "
           "sheet string, first_row int, text string")
LANDED = "landed"                  # the Parquet file that a row landed in
FRESH = "source_name string, sha256 string, file_name string, source_url string, published_at timestamp_ntz, landed string, workbook long"
CATALOG = ("source_name string, sha256 string, file_name string, source_url string, published_at timestamp_ntz, "
           "data_month date, row_count long, batch_id long")
AUDIT = "run_id string, event_ts timestamp_ntz, status string, rows_loaded long, notes string, batch_id long"
DRIFT = "file string, sheet string, drift_type string, column_detail string, action_taken string, batch_id long"
KEY = ("period_date", "org_code")
COUNTS = ("attendances_type1", "attendances_type2", "attendances_type3", "attendances_total", "breaches_type1", "breaches_total",
          "emergency_admissions_type1", "emergency_admissions_via_ae", "emergency_admissions_other", "emergency_admissions_total",
          "dta_breaches_4hr", "dta_breaches_12hr")
HASHED = ("period_date", "org_code", "org_name", *COUNTS)
VERSIONS = ("period_date date, org_code string, org_name string, " + "".join(f"{c} long, " for c in COUNTS)
            + "row_hash string, source_version string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
RUNNING, LOADED, SKIPPED, FAILED = "running", "success", "skipped", "failed"

Hook = Callable[[int, str], None]


@dataclass(frozen=True)
class Warehouse:
    """The run's tables under one root in the shared folder."""
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def earlier(self, name: str, schema: str, batch_id: int | None = None) -> DataFrame:
        """An append table's rows, of batches before ``batch_id`` only."""
        if not path_exists(self.spark, self.path(name)):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.path(name))
        return rows if batch_id is None else rows.where(F.col("batch_id") < batch_id)

    def versions_path(self, batch_id: int) -> str:
        return f"{self.path('versions')}/version={batch_id + 1}"

    def versions(self, before: int | None = None) -> DataFrame | None:
        """The newest version written by a batch before ``before`` (any, where not given)."""
        table = sinks.VersionedTable(self.spark, self.path("versions"))
        held = [v for v in table.versions() if before is None or v <= before]
        return table.read(held[-1], VERSIONS) if held else None

    def staging(self) -> DataFrame | None:
        path = self.path("staging")
        return self.spark.read.parquet(path) if path_exists(self.spark, path) else None

    def done(self, batch_id: int, sink: str) -> bool:
        return path_exists(self.spark, f"{self.path('ledger')}/batch_id={batch_id}/sink={sink}/_SUCCESS")

    def commit(self, batch_id: int, sink: str, write: Callable[[], None], after: Hook) -> None:
        """Write one sink of a batch unless the ledger has it, then enter it."""
        if self.done(batch_id, sink):
            return
        write()
        after(batch_id, f"{sink} written")
        entry = self.spark.createDataFrame([(sink,)], "entry string")
        entry.write.mode("overwrite").parquet(f"{self.path('ledger')}/batch_id={batch_id}/sink={sink}")
        after(batch_id, f"{sink} entered")

    def append(self, name: str, rows: DataFrame, batch_id: int) -> None:
        """The batch's own folder of an append table, replaced as a whole by a replay."""
        rows.drop("batch_id").write.mode("overwrite").parquet(f"{self.path(name)}/batch_id={batch_id}")


def landed_files(parts: DataFrame) -> DataFrame:
    """One row per landed workbook with the hash of its content: the digest of its parts' digests in
    order, so no task gathers a workbook's text."""
    part = F.struct("sheet", "first_row", F.sha2("text", 256).alias("sha"))
    return (parts.groupBy("source_name", "file_name", LANDED)
            .agg(F.array_sort(F.collect_list(part)).alias("p"), F.max("source_url").alias("source_url"), F.max("published_at").alias("published_at"))
            .select("source_name", "file_name", LANDED, "source_url", "published_at", F.sha2(F.to_json("p"), 256).alias("sha256")))


def fresh_files(files: DataFrame, seen: DataFrame) -> DataFrame:
    """The landed workbooks whose content the catalog (source_name, sha256) lacks, each content once, with a number
    that tells them apart: their names may be equal."""
    first = F.struct("file_name", "published_at", "source_url", LANDED)
    return (files.join(seen, ["source_name", "sha256"], "left_anti").groupBy("source_name", "sha256").agg(F.min(first).alias("f"))
            .select("source_name", "sha256", "f.*", F.monotonically_increasing_id().alias("workbook")))


def gate_measures() -> dict[str, F.Column]:
    """Measures of the pending rows; all but the row count must be zero to publish."""
    negative = F.lit(False)
    for c in COUNTS:
        negative = negative | F.coalesce(F.col(c) < 0, F.lit(False))
    pct = F.col("performance_all_pct")
    return {"rows": F.count(F.lit(1)), "null_key": F.count_if(F.col("period_date").isNull() | F.col("org_code").isNull()),
            "negative_count": F.count_if(negative), "breaches_exceed_attendances": F.count_if(F.col("breaches_total") > F.col("attendances_total")),
            "performance_outside_0_100": F.count_if((pct < 0) | (pct > 100))}


def process_batch(house: Warehouse, parts: DataFrame, batch_id: int, registry: Registry | None = None, after: Hook = lambda b, s: None) -> str:
    """One batch; returns its status."""
    spark = house.spark
    files = landed_files(parts)
    seen = house.earlier("catalog", CATALOG, batch_id).select("source_name", "sha256")
    fresh = fresh_files(files, seen)
    fresh_path = f"{house.path('fresh')}/batch_id={batch_id}"
    house.commit(batch_id, "fresh", lambda: fresh.write.mode("overwrite").parquet(fresh_path), after)
    fresh = spark.read.schema(FRESH).parquet(fresh_path)
    facts = files.agg(F.max("published_at").alias("at"), F.count(F.lit(1)).alias("n")).first()
    if facts["at"] is None:
        return SKIPPED
    at, run_id = str(facts["at"]), f"batch-{batch_id}"

    def record(status: str, rows: int, notes: str) -> None:
        event = spark.createDataFrame([(run_id, status, rows, notes)], "run_id string, status string, rows_loaded long, notes string")
        event = event.select("run_id", changes.ts_literal(at).alias("event_ts"), "status", "rows_loaded", "notes")
        house.commit(batch_id, f"audit_{status}", lambda: event.write.mode("overwrite").parquet(
            f"{house.path('audit')}/batch_id={batch_id}/status_part={status}"), after)

    record(RUNNING, 0, f"{facts['n']} files landed")
    if fresh.isEmpty():
        record(SKIPPED, 0, "all content is catalogued")
        return SKIPPED
    # The parse knows a workbook by its number.
    mine = (parts.join(fresh.select("source_name", "file_name", LANDED, "workbook"), ["source_name", "file_name", LANDED])
            .select(F.col("workbook").cast("string").alias("file"), "sheet", "first_row", "text"))
    pending_path, gate_path = f"{house.path('pending')}/batch_id={batch_id}", f"{house.path('gate')}/batch_id={batch_id}"

    def halted() -> DataFrame:
        """The batch's drift rows of workbooks that the policy stops."""
        return spark.read.schema(f"workbook string, {DRIFT}").parquet(f"{house.path('drift')}/batch_id={batch_id}").where("action_taken = 'halted'")

    def parse() -> None:
        """Parsed rows of the files that the drift policy lets pass, the drift log, and the measures."""
        parsed = ingest.parse_texts(mine, registry)
        log = parsed.drift_log.withColumnRenamed("file", "workbook")
        house.append("drift", log.join(fresh.select(F.col("workbook").cast("string"), F.col("file_name").alias("file")), "workbook"), batch_id)
        stopped = halted().select(F.col("workbook").alias("file")).distinct()
        wrong = quality.shape_mismatches(parsed.staged.drop("file"), sinks.STAGING_SCHEMA)
        if wrong:
            raise ingest.LoadHaltedError(f"staging layout: {wrong}")
        origin = fresh.select(F.col("workbook").cast("string").alias("file"), F.col("file_name").alias("_name"), F.col("source_url").alias("_url"), F.col("sha256").alias("_sha"), "published_at")
        measures = Observation()
        rows = parsed.staged.join(stopped, "file", "left_anti").observe(measures, *(c.alias(n) for n, c in gate_measures().items()))
        rows = changes.with_row_hash(rows, HASHED).join(origin, "file")
        rows = sinks.add_audit_columns(rows, F.col("_name"), F.col("_sha"), F.col("_url"), at)
        rows.drop("_name", "_url", "_sha").write.mode("overwrite").parquet(pending_path)
        found = measures.get
        spark.createDataFrame([(n, int(found[n])) for n in gate_measures()], "measure string, found long").write.mode("overwrite").parquet(gate_path)

    house.commit(batch_id, "pending", parse, after)
    pending = spark.read.parquet(pending_path)
    found = {r.measure: r.found for r in spark.read.schema("measure string, found long").parquet(gate_path).collect()}  # one row a measure
    broken = [f"{n}: {v}" for n, v in sorted(found.items()) if n != "rows" and v]
    stopped = halted().agg(F.countDistinct("workbook")).first()[0]
    if broken or not found["rows"]:
        record(FAILED, 0, "; ".join(broken) or f"{stopped} files halted")
        return FAILED
    before = house.versions(batch_id)
    base = changes.empty_versions(pending, KEY, HASHED[2:]) if before is None else before

    def merge() -> None:
        next_version = changes.scd2_merge(base, pending, KEY, at, run_id, HASHED[2:], "published_at")
        next_version.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("is_current").parquet(house.versions_path(batch_id))

    house.commit(batch_id, "versions", merge, after)
    opened = house.versions(batch_id + 1).where((F.col("source_version") == run_id) & F.col("is_current"))
    changed = opened.count()

    def replace() -> None:
        """The changed periods (D5), of the version now current, with the row's audit columns."""
        periods = opened.select("period_date").distinct()
        current = house.versions(batch_id + 1).where("is_current").join(periods, "period_date", "left_semi")
        current = current.select(*HASHED, "row_hash", F.col("source_version"), F.col("valid_from").alias("publication_date"), "is_current")
        sinks.replace_periods(current, house.path("staging"))

    house.commit(batch_id, "staging", replace, after)
    loaded = pending.groupBy(F.col("file").cast("long").alias("workbook")).agg(F.max("period_date").alias("data_month"), F.count(F.lit(1)).alias("row_count"))
    catalogued = fresh.join(loaded, "workbook").select("source_name", "sha256", "file_name", "source_url", "published_at", "data_month", "row_count")
    house.commit(batch_id, "catalog", lambda: house.append("catalog", catalogued, batch_id), after)
    record(LOADED, found["rows"], f"{changed} rows changed; {stopped} files halted")
    return LOADED


def run_available(spark: SparkSession, landing: str, root: str, registry: Registry | None = None, after: Hook = lambda b, s: None,
                  max_files_per_trigger: int = 1000) -> Warehouse:
    """Load everything that landed since the last run; the stream's offsets live under ``root``."""
    house = Warehouse(spark, root)
    stream = spark.readStream.schema(LANDING).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)
    stream = stream.select("*", F.col("_metadata.file_path").alias(LANDED))

    def process(batch: DataFrame, batch_id: int) -> None:
        process_batch(Warehouse(batch.sparkSession, root), batch, batch_id, registry, after)

    (stream.writeStream.foreachBatch(process).option("checkpointLocation", house.path("stream")).trigger(availableNow=True).start().awaitTermination())
    return house
