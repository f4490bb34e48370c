"""Landing to bronze for one directory: delta, arrival, checksums, gate, landing, ledger."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.functions import names
from coverlake.operators import arrival, audit, checksum, gate, ledger
from coverlake.plans.layout import Lake
from coverlake.plans.together import run_together
from coverlake.session import scratch_dir
from coverlake.sinks.landing import bronze_uri, dead_letter_uri, file_tags
from coverlake.sources.landing import (
    NOT_UTF8,
    copy_files,
    file_digests,
    list_directory,
    read_headers,
    read_sidecars,
)
from coverlake.sources.manifest import manifest_table
from coverlake.sources.raw_csv import PATH, RESERVED, read_csv_files, text_traits
from coverlake.specs import REGISTRY

# Within a directory a file is known by its name, whatever form its path takes in different scans.
FILE_NAME = "_file_name"
UNKNOWN = "unknown"
SKIPPED = "skipped"


@dataclass
class IngestResult:
    dir_id: str
    first_run: bool
    new_files: int
    landed: int
    rejected: int
    outcomes: DataFrame


def folder_of(lake: Lake, entry: dict) -> str:
    return f"{lake.landing}/{entry['remote_dir'].strip('/')}"


def check_arrival(
    manifest: DataFrame, entry: dict, day: date, new: DataFrame, processed: DataFrame, allowed_missing: int
) -> None:
    """The date's files must be among the new or the already processed ones; extra files are tolerated."""
    spark = manifest.sparkSession
    own = manifest.where(F.col("dir_id") == entry["dir_id"])
    dates = spark.range(1).select(F.lit(day).cast("date").alias("business_date"))
    expected = arrival.expected_files(own, dates)
    seen = arrival.with_encrypted_names(new.select("dir_id", "file_name"), own)
    known = processed.select("dir_id", "file_name").join(expected.select("dir_id", "file_name"), ["dir_id", "file_name"], "left_semi")
    actual = seen.unionByName(known).withColumn("business_date", F.lit(day).cast("date"))
    arrival.require_complete(expected, actual, allowed_missing)


def check_digests(spark: SparkSession, lake: Lake, entry: dict, new: DataFrame) -> None:
    """Digests of the new sidecars' data files, no others; nothing to do where a directory has no sidecars."""
    if not entry["use_checksum"]:
        return
    folder = folder_of(lake, entry)
    fresh = new.where(names.is_sidecar(F.col("file_name"))).select(
        names.strip_suffix(F.col("file_name"), names.SIDECAR_SUFFIX).alias("file_name")
    )
    sidecars = read_sidecars(spark, folder).join(fresh, "file_name", "left_semi")
    digests = file_digests(fresh.select(F.concat(F.lit(f"{folder}/"), "file_name").alias("path")))
    checksum.require_checksums(checksum.checksum_report(sidecars, digests))


def _outcomes(files: DataFrame, outcome: str) -> DataFrame:
    """Outcomes of files without rows to count; `files` has dir_id, file_name and uri."""
    none = F.lit(None)
    return files.select(
        "dir_id",
        "file_name",
        "uri",
        F.lit(outcome).alias("outcome"),
        none.cast("string").alias("file_type"),
        none.cast("bigint").alias("rows_valid"),
        none.cast("bigint").alias("rows_dropped"),
        none.cast("map<string, string>").alias("tags"),
    )


def _gate_entity(
    spark: SparkSession, lake: Lake, entry: dict, entity: str, files: DataFrame, day: date, run_id: str
) -> DataFrame:
    """Gate the new files of one entity and copy them where they belong; returns their outcomes.

    A file that cannot be read is a rejected file like others: its fault is a violation and its bytes go to the dead
    letter.
    """
    dir_id = entry["dir_id"]
    spec = REGISTRY[entity]
    source = names.base_name(F.col("path")).alias("source_file")
    headers_path = lake.quality("headers", run_id, dir_id, entity)
    read_headers(files, RESERVED).withColumn("source_file", source).write.mode("overwrite").parquet(headers_path)
    headers = spark.read.parquet(headers_path)
    readable = [r.path for r in headers.where("columns IS NOT NULL").select("path").orderBy("path").collect()]
    faults = headers.where("fault IS NOT NULL").select("source_file", "fault")
    if readable:
        broken = text_traits(spark, readable).where("NOT is_utf8")
        faults = faults.unionByName(broken.select(source, F.lit(f"{NOT_UTF8}: rows").alias("fault")))
    faults_path = lake.quality("faults", run_id, dir_id, entity)
    faults.write.mode("overwrite").parquet(faults_path)
    faults = spark.read.parquet(faults_path)
    sound = headers.join(faults, "source_file", "left_anti")

    # The text is parsed once. Verdict and violations read the staged columns.
    staging = scratch_dir(spark, f"staging-{dir_id}-{entity}")
    read_csv_files(spark, sound).withColumn(FILE_NAME, names.base_name(F.col(PATH))).write.parquet(staging)
    rows = spark.read.parquet(staging)
    for name in spec.required:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))

    # The verdict is read by the copies, the ledger and the audit, so it is written once as a table. Failures are only
    # listed for files it rejects: on a clean day the rows are tested once.
    stats_path = lake.quality("file_stats", run_id, dir_id, entity)
    stats = gate.file_stats(rows, spec, FILE_NAME, sound.select("source_file", "columns"))
    stats.unionByName(gate.fault_stats(faults, spec)).write.mode("overwrite").parquet(stats_path)
    stats = spark.read.parquet(stats_path)
    rejected = stats.where("NOT accepted").select("source_file")
    violations_path = lake.quality("violations", run_id, dir_id, entity)
    found = gate.fault_violations(faults)
    if not rejected.isEmpty():
        bad_rows = rows.join(rejected.withColumnRenamed("source_file", FILE_NAME), FILE_NAME, "left_semi")
        bad_headers = sound.join(rejected, "source_file", "left_semi").select("source_file", "columns")
        found = found.unionByName(gate.violations(bad_rows, spec, FILE_NAME, bad_headers))
    found.write.mode("overwrite").parquet(violations_path)

    own = entity in [f["entity"] for f in entry["files"]]
    name = F.col("source_file")
    landed_uri = bronze_uri(lake.root, F.lit(entry["gcs_prefix"]), F.lit(entity), F.lit(day).cast("date"), name)
    dead_uri = dead_letter_uri(lake.root, F.lit(dir_id), F.lit(entity), F.lit(day).cast("date"), name)
    outcome = F.when(~F.col("accepted"), ledger.REJECTED).when(F.lit(own), ledger.LANDED).otherwise(SKIPPED)
    outcomes = stats.select(
        F.lit(dir_id).alias("dir_id"),
        name.alias("file_name"),
        F.when(~F.col("accepted"), dead_uri).when(F.lit(own), landed_uri).alias("uri"),
        outcome.alias("outcome"),
        "file_type",
        "rows_valid",
        "rows_dropped",
        F.when(F.col("accepted") & F.lit(own), file_tags(dir_id, entity, day)).alias("tags"),
    )
    targets = outcomes.where("uri IS NOT NULL").select(F.col("file_name").alias("source_file"), F.col("uri").alias("target"))
    copy_files(headers.join(targets, "source_file"))
    return outcomes


def process_files(
    spark: SparkSession, lake: Lake, entry: dict, new: DataFrame, day: date, run_id: str
) -> DataFrame:
    """Gate, land and route a set of new files of one directory; every one of them gets an outcome.

    Work is split by entity only, never by file or date. Files that are neither data nor sidecars are ignored.
    """
    manifest = manifest_table(spark, [entry])
    is_data, is_sidecar = names.is_data_file(F.col("file_name")), names.is_sidecar(F.col("file_name"))
    data = arrival.infer_entities(new.where(is_data), manifest)
    present = {r.entity for r in data.select("entity").distinct().collect()}
    others = new.where(~is_data).withColumn("uri", F.lit(None).cast("string"))
    outcomes = _outcomes(others.where(is_sidecar), ledger.SIDECAR)
    outcomes = outcomes.unionByName(_outcomes(others.where(~is_sidecar), ledger.IGNORED))
    gated = {
        entity: partial(
            _gate_entity, spark, lake, entry, entity, data.where(F.col("entity") == entity), day, run_id
        )
        for entity in REGISTRY
        if entity in present
    }
    for gate_outcomes in run_together(gated).values():
        outcomes = outcomes.unionByName(gate_outcomes)
    if None in present:
        uri = dead_letter_uri(lake.root, F.col("dir_id"), F.lit(UNKNOWN), F.lit(day).cast("date"), F.col("file_name"))
        strays = data.where(F.col("entity").isNull()).withColumn("uri", uri)
        copy_files(strays.withColumnRenamed("uri", "target"))
        outcomes = outcomes.unionByName(_outcomes(strays, ledger.REJECTED))
    return outcomes


def ingest_directory(
    spark: SparkSession,
    lake: Lake,
    entry: dict,
    day: date,
    run_id: str | None = None,
    allowed_missing: int = 0,
    lookback_from: date | None = None,
) -> IngestResult:
    """One directory for one business date. The ledger is written last, so a failed run is simply repeated.

    With `lookback_from`, only the ledger months from `LOOKBACK_MONTHS` before that day are read, and only files that
    changed since then are looked at, so that files of older months are not taken for new ones.
    """
    run_id = run_id or audit.new_run_id()
    manifest = manifest_table(spark, [entry])
    book = ledger.FileLedger(spark, lake.file_ledger)
    listing = list_directory(spark, folder_of(lake, entry), entry["dir_id"])
    processed = book.processed(lookback_from).where(F.col("dir_id") == entry["dir_id"])
    first_run = processed.isEmpty()
    if lookback_from:
        listing = ledger.within_lookback(listing, lookback_from)
    # Read by every step below, so the folder is listed once.
    new_path = lake.quality("new_files", run_id, entry["dir_id"], "all")
    arrival.new_files(listing, processed).write.mode("overwrite").parquet(new_path)
    new = spark.read.parquet(new_path)
    new_count = new.count()
    if new_count:
        check_arrival(manifest, entry, day, new, processed, allowed_missing)
        check_digests(spark, lake, entry, new)

    outcomes_path = lake.quality("outcomes", run_id, entry["dir_id"], "all")
    process_files(spark, lake, entry, new, day, run_id).write.mode("overwrite").parquet(outcomes_path)
    outcomes = spark.read.parquet(outcomes_path)
    entries = outcomes.withColumn("business_date", F.lit(day).cast("date"))
    if new_count:
        book.record(entry["dir_id"], arrival.with_encrypted_names(entries, manifest))
    counts = {r.outcome: r["count"] for r in outcomes.groupBy("outcome").count().collect()}
    return IngestResult(
        entry["dir_id"], first_run, new_count, counts.get(ledger.LANDED, 0), counts.get(ledger.REJECTED, 0), outcomes
    )
