"""Registered queries: every operator over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.checks import inputs
from coverlake.functions import cells, names
from coverlake.functions.exact import grouped_sums
from coverlake.operators import arrival, audit, checksum, gate, gold, ledger, silver
from coverlake.plans.ingest import folder_of, ingest_directory
from coverlake.plans.layout import Lake
from coverlake.plans.gold import load_gold
from coverlake.plans.silver import silver_all, silver_backfill, silver_for_date
from coverlake.session import scratch_dir
from coverlake.sinks.landing import bronze_uri, expired_partitions
from coverlake.sinks.tables import replace_listed, truncate_load
from coverlake.sources.landing import copy_files, expected_digest, file_digests, read_sidecars, write_files
from coverlake.sources.manifest import DIRECTORIES, manifest_entities, manifest_table
from coverlake.sources.raw_csv import BLOCK_START, PATH, SOURCE_FILE
from coverlake.sources.raw_csv import bronze_dates as list_bronze_dates
from coverlake.sources.raw_csv import read_bronze, read_csv_files
from coverlake.sources.samples import SAMPLE_DATE, SAMPLE_ORDER, raw_sample, table
from coverlake.specs import REGISTRY
from coverlake.streaming.incremental import stream_silver

Query = Callable[[SparkSession, str], DataFrame]

LOOKBACK_FROM = date(1998, 1, 15)
RETENTION_AS_OF = date(1998, 6, 1)
RUN_ID = "sample-run"


def silver_sample(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return silver.to_silver(raw_sample(spark, sf_dir, entity), REGISTRY[entity], SAMPLE_DATE, SAMPLE_ORDER)


def silver_query(entity: str) -> Query:
    return lambda spark, sf_dir: silver_sample(spark, sf_dir, entity).drop("_ingested_at", *SAMPLE_ORDER)


def dim_query(entity: str, build: Callable) -> Query:
    return lambda spark, sf_dir: build(silver_sample(spark, sf_dir, entity), SAMPLE_DATE, SAMPLE_ORDER)


def fact_query(entity: str, build: Callable) -> Query:
    return lambda spark, sf_dir: build(silver_sample(spark, sf_dir, entity))


def agg_query(entity: str, build: Callable) -> Query:
    return lambda spark, sf_dir: build(silver_sample(spark, sf_dir, entity), SAMPLE_DATE)


def violations_query(entity: str) -> Query:
    return lambda spark, sf_dir: gate.violations(raw_sample(spark, sf_dir, entity), REGISTRY[entity])


def _per_entity(build: Callable[[DataFrame, object], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = None
        for entity, spec in REGISTRY.items():
            part = build(raw_sample(spark, sf_dir, entity), spec)
            result = part if result is None else result.unionByName(part)
        return result

    return run


file_stats = _per_entity(
    lambda rows, spec: gate.file_stats(rows, spec).withColumn("columns", F.array_join("columns", ","))
)

duplicate_keys = _per_entity(gate.duplicate_keys)
parse_failures = _per_entity(silver.parse_failures)
dedup_dropped = _per_entity(silver.dedup_dropped)


def gate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        file_stats(spark, sf_dir)
        .groupBy("file_type")
        .agg(
            F.count_if("accepted").alias("accepted_files"),
            F.count_if(~F.col("accepted")).alias("rejected_files"),
            F.sum(F.when(F.col("accepted"), F.col("rows_raw")).otherwise(0)).alias("accepted_rows"),
        )
    )


def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_sample(spark, sf_dir, "claims")
    accepted, rejected = gate.split_by_verdict(rows, gate.file_stats(rows, REGISTRY["claims"]))
    columns = ["claim_id", F.col("_source_file").alias("source_file")]
    return accepted.select(*columns, F.lit("bronze").alias("route")).unionByName(
        rejected.select(*columns, F.lit("dead_letter").alias("route"))
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(inputs.LISTING, events=table(spark, sf_dir, "events"))


def visible_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = listing(spark, sf_dir).where(names.is_visible(F.col("file_name")))
    return shown.select("dir_id", "business_date", "file_name").distinct()


def expected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = listing(spark, sf_dir).select("business_date").distinct()
    return arrival.expected_files(manifest_table(spark), dates)


def arrival_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrival.arrival_report(expected_files(spark, sf_dir), visible_files(spark, sf_dir), allowed_missing=0)


def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrival.missing_files(expected_files(spark, sf_dir), visible_files(spark, sf_dir))


def unexpected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrival.unexpected_files(expected_files(spark, sf_dir), visible_files(spark, sf_dir))


def entity_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = visible_files(spark, sf_dir).select("dir_id", "file_name")
    manifest = manifest_table(spark)
    inferred = arrival.infer_entities(files, manifest)
    return arrival.directory_entities(inferred.withColumnRenamed("entity", "inferred"), manifest).select(
        "dir_id", "file_name", F.col("inferred").alias("entity"), F.col("entity").alias("directory_entity")
    )


def files_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = manifest_table(spark)
    counted = arrival.infer_entities(visible_files(spark, sf_dir), manifest).groupBy("entity").count()
    return manifest_entities(manifest).join(counted, "entity", "left").select("entity", F.col("count").alias("files"))


def file_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("file_name")
    kind = (
        F.when(~names.is_visible(name), "hidden")
        .when(names.is_sidecar(name), "sidecar")
        .when(names.is_encrypted(name), "encrypted")
        .when(names.is_data_file(name), "data")
        .otherwise("other")
    )
    plain = names.strip_suffix(names.strip_suffix(name, names.ENCRYPTED_SUFFIX), names.SIDECAR_SUFFIX)
    return (
        listing(spark, sf_dir)
        .groupBy("dir_id", kind.alias("kind"))
        .agg(F.count(F.lit(1)).alias("files"), F.count_distinct(plain).alias("data_names"))
    )


def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files listed by odd events that no even event had listed before."""
    seen = listing(spark, sf_dir)
    files = seen.where("event_id % 2 = 1").select("dir_id", "file_name").distinct()
    return arrival.new_files(files, seen.where("event_id % 2 = 0"))


def landed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = visible_files(spark, sf_dir).select("dir_id", "file_name")
    return arrival.with_encrypted_names(files, manifest_table(spark))


def ledger_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(inputs.LEDGER, orders=table(spark, sf_dir, "orders"))


def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.current_files(ledger_entries(spark, sf_dir))


def ledger_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.current_files(ledger.lookback(ledger_entries(spark, sf_dir), LOOKBACK_FROM))


def ledger_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state from a snapshot of two thirds of the entries and a log of two thirds, so that one third is in both."""
    entries = ledger_entries(spark, sf_dir)
    snapshot = ledger.folded(entries.where("recorded_at % 3 < 2"))
    return ledger.current_files(snapshot.unionByName(entries.where("recorded_at % 3 > 0")))


def ledger_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ledger_entries(spark, sf_dir)
    return ledger.ledger_summary(entries, "dir_id", ledger.current_files(entries))


def pending_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates of each directory without a landed entry."""
    entries = ledger_entries(spark, sf_dir).withColumnRenamed("dir_id", "scope")
    done = ledger.current_dates(entries.where("outcome <> 'rejected'"))
    return ledger.pending_dates(entries, done)


def forced_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ledger_entries(spark, sf_dir).withColumnRenamed("dir_id", "scope")
    return ledger.pending_dates(entries, ledger.current_dates(entries), force=True)


def expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    partitions = spark.sql(inputs.LAYER_PARTITIONS, orders=table(spark, sf_dir, "orders"))
    return expired_partitions(partitions, RETENTION_AS_OF)


def checksum_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of whole documents against their sidecars; every 19th file is missing, every 13th has no sidecar."""
    text = inputs.SIDECARS.replace("digest_of_altered", "sha2(concat(text, '!'), 256)").replace(
        "digest_of_text", "sha2(text, 256)"
    )
    files = spark.sql(text, documents=table(spark, sf_dir, "documents"))
    sidecars = files.where("doc_id % 13 <> 0").select(
        "file_name", expected_digest(F.col("sidecar_text")).alias("expected")
    )
    digests = files.where("doc_id % 19 <> 0").select("file_name", F.sha2("text", 256).alias("actual"))
    return checksum.checksum_report(sidecars, digests)


def large_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts from 1e-6 to beyond 1e25 in one group; of even events the large ones cancel out."""
    amounts = table(spark, sf_dir, "events").selectExpr(
        "event_type", "event_id % 2 AS odd", "CAST(CAST(value AS DECIMAL(12, 2)) * 100 AS BIGINT) AS cents"
    ).selectExpr(
        "event_type", "odd",
        "explode(array(cents * 1e20D, CASE WHEN odd = 0 THEN cents * -1e20D END, CAST(CAST(cents AS DECIMAL(20, 0)) / 1000000 AS DOUBLE)))"
        " AS amount",
    )
    return grouped_sums(amounts, ["event_type", "odd"], {"total": "amount"}, {"amounts": F.count("amount")})


def _claim_verdicts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stats = gate.file_stats(raw_sample(spark, sf_dir, "claims"), REGISTRY["claims"]).withColumnRenamed(
        "source_file", "file_name"
    )
    uri = bronze_uri(
        "gs://lake", F.lit("bronze/inbound"), F.col("file_type"), F.lit(SAMPLE_DATE).cast("date"), F.col("file_name")
    )
    return stats, stats.where("accepted").select("file_name", uri.alias("uri"))


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats, landed = _claim_verdicts(spark, sf_dir)
    return audit.audit_rows(landed, stats, RUN_ID, SAMPLE_DATE).drop("ingested_at")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(F.col("accepted"), "ok")
        .when(F.col("rows_valid") > 0, F.concat(F.lit("error: "), F.col("rows_dropped").cast("string")))
        .otherwise("skipped")
    )
    return audit.run_summary(file_stats(spark, sf_dir).select("source_file", status.alias("status")))


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats, landed = _claim_verdicts(spark, sf_dir)
    results = stats.select(F.when(F.col("accepted"), "ok").otherwise("error: rejected").alias("status"))
    return audit.run_report(manifest_table(spark), landed, results, results)


def directory_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = visible_files(spark, sf_dir).select("dir_id", "file_name").distinct()
    fresh = new_files(spark, sf_dir)
    landed = arrival.infer_entities(fresh, manifest_table(spark)).where("entity IS NOT NULL")
    known = listing(spark, sf_dir).where("event_id % 2 = 0 AND dir_id = 'inbound'")
    return audit.directory_report(files, fresh, landed, known)


def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every claim date, reload the even days with a marker and the days divisible by nine with nothing."""
    path = scratch_dir(spark, "partition-replace")
    facts = gold.fact_claims(silver_sample(spark, sf_dir, "claims"))
    columns = facts.select("claim_id", "claim_type", "claimed_amount", "ingestion_date", F.lit(1).alias("load_no"))
    replace_listed(columns, path, ["ingestion_date"], [], ["claim_type"])
    reload_days = F.dayofmonth("ingestion_date")
    days = columns.select("ingestion_date").where((reload_days % 2 == 0) | (reload_days % 9 == 0)).distinct()
    folders = [f"ingestion_date={r.ingestion_date}" for r in days.collect()]
    again = columns.where((reload_days % 2 == 0) & (reload_days % 9 != 0)).withColumn("load_no", F.lit(2))
    replace_listed(again, path, ["ingestion_date"], folders, ["claim_type"])
    return spark.read.parquet(path)


def truncated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension loaded twice keeps only the second load."""
    path = scratch_dir(spark, "truncate-load")
    dimension = gold.dim_policy(silver_sample(spark, sf_dir, "policies"), SAMPLE_DATE, SAMPLE_ORDER)
    truncate_load(dimension, path, ["coverage_type", "status"])
    truncate_load(dimension.where("is_active"), path, ["coverage_type", "status"])
    return spark.read.parquet(path)


#: Rows of one file written to bronze; a gzip file is one split.
BRONZE_FILE_ROWS = 100_000


def _write_bronze(rows: DataFrame, lake: Lake, directory: str, entity: str) -> None:
    """Raw rows as CSV in the bronze layout. Files are numbered in the order of the ranges they hold, so that file and
    row order together are the sample's order. They are gzip files of so many rows as a task sorts without spilling."""
    parts = names.date_partition_columns(F.col("_business_date"))
    order = [*parts, "_ord"]
    (
        rows.withColumns(parts)
        .drop("_business_date", "_source_file")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_ord")
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", BRONZE_FILE_ROWS)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy(*parts)
        .csv(f"{lake.bronze}/{directory}/{entity}")
    )


def _monthly_premiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc(F.col("due_date").cast("date"), "month")
    return raw_sample(spark, sf_dir, "premiums").withColumn("_business_date", month)


def _without_run_columns(rows: DataFrame) -> DataFrame:
    return rows.drop("_ingested_at", "_source_file", "_block_start", "_row_id", "year", "month", "day")


def backfill_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly premium files: one month on its own, then every pending month as one job."""
    lake = Lake(scratch_dir(spark, "backfill"))
    _write_bronze(_monthly_premiums(spark, sf_dir), lake, "reports", "premiums")
    first = list_bronze_dates(spark, lake.bronze, "premiums").first().business_date
    silver_for_date(spark, lake, "premiums", first, as_of=SAMPLE_DATE)
    silver_backfill(spark, lake, "premiums", as_of=SAMPLE_DATE)
    return _without_run_columns(spark.read.parquet(f"{lake.silver}/premiums"))


#: What is added up of each gold table.
GOLD_TOTALS = {
    "dim_policy": "annual_premium_eur", "dim_claimant": "claimant_sk", "dim_reinsurer": "length(reinsurer_name)",
    "fact_premiums": "amount_due", "fact_claims": "claimed_amount", "fact_reinsurance": "ceded_premium",
    "agg_daily_premium_summary": "premium_count", "agg_claim_by_status": "claim_count", "agg_reinsurer_exposure": "cession_count",
}


def gold_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four feeds of one date through bronze files, silver of the date and two gold loads; the second skips facts."""
    lake = Lake(scratch_dir(spark, "gold"))
    for entity, directory in (("reinsurance", "reports"), ("premiums", "reports"), ("policies", "inbound"), ("claims", "inbound")):
        rows = raw_sample(spark, sf_dir, entity).withColumn("_business_date", F.lit(SAMPLE_DATE).cast("date"))
        _write_bronze(rows, lake, directory, entity)
    written = silver_all(spark, lake, SAMPLE_DATE, as_of=SAMPLE_DATE)
    if failed := [s for s in written.values() if s.startswith("error")]:
        raise RuntimeError(failed[0])
    load_gold(spark, lake, SAMPLE_DATE)
    again = load_gold(spark, lake, SAMPLE_DATE)
    result = None
    for name, amount in GOLD_TOTALS.items():
        part = spark.read.parquet(f"{lake.gold}/{name}").selectExpr(f"CAST({amount} AS DOUBLE) AS amount").selectExpr(
            f"'{name}' AS table_name", "count(*) AS n_rows", f"{cells.exact_sum('amount')} AS total",
            f"'{again[name]}' AS second_status",
        )
        result = part if result is None else result.unionByName(part)
    return result


def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files with sidecars beside them, both read back from the folder: every 17th digest is wrong, every
    19th file is missing, every 13th has no sidecar."""
    lake = Lake(scratch_dir(spark, "checksums"))
    folder = f"{lake.landing}/inbound"
    whole = table(spark, sf_dir, "documents").selectExpr(
        "concat('doc_', CAST(doc_id AS STRING), '.csv') AS file_name", "doc_id AS n", "text AS content"
    )
    sidecars = whole.where("n % 13 <> 0").selectExpr(
        "concat(file_name, '.sha256') AS file_name",
        "concat(upper(sha2(concat(content, CASE WHEN n % 17 = 0 THEN '!' ELSE '' END), 256)), '  ', file_name) AS content",
    )
    write_files(whole.where("n % 19 <> 0").select("file_name", "content").unionByName(sidecars), folder)
    stated = read_sidecars(spark, folder)
    digests = file_digests(stated.select(F.concat(F.lit(f"{folder}/"), "file_name").alias("path")))
    return checksum.checksum_report(stated, digests)


def silver_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse failures and dropped rows counted while all claim dates are written, beside no scan of their own."""
    lake = Lake(scratch_dir(spark, "metrics"))
    rows = raw_sample(spark, sf_dir, "claims").withColumn("claimed_amount", F.expr("CASE WHEN claimed_amount LIKE '%7' THEN 'x' ELSE claimed_amount END"))
    twice = rows.unionByName(rows.where("status = 'OPEN'").withColumn("_ord", F.concat("_ord", F.lit("a"))))
    _write_bronze(twice, lake, "inbound", "claims")
    silver_backfill(spark, lake, "claims", as_of=SAMPLE_DATE)
    counted = spark.read.parquet(lake.silver_metrics)
    return counted.groupBy("metric", "column_name").agg(F.sum("value").alias("value"))


def stream_incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily claim files arriving as a stream in several batches."""
    lake = Lake(scratch_dir(spark, "stream"))
    _write_bronze(raw_sample(spark, sf_dir, "claims"), lake, "inbound", "claims")
    query = stream_silver(spark, lake, "claims", f"{lake.root}/checkpoint", SAMPLE_DATE, files_per_batch=16)
    query.awaitTermination()
    return _without_run_columns(spark.read.parquet(f"{lake.silver}/claims"))


LANDED_CELLS = ["claim_id", "claimant_name", "adjuster_id", "status", "claimed_amount", "approved_amount", "_note"]


def landed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly claim files with padded and blank cells through the real landing, read back at their recorded address.

    Every file counts, landed or rejected: both keep the cells as delivered.
    """
    lake = Lake(scratch_dir(spark, "landed"))
    entry = DIRECTORIES[0]
    month = F.date_format("_business_date", "yyyyMM")
    rows = raw_sample(spark, sf_dir, "claims").withColumns(
        {"month": month, "claimant_name": F.concat(F.lit("  "), "claimant_name", F.lit(" ")), "_note": F.lit("   ")}
    )
    written = f"{lake.root}/outbox"
    (
        rows.drop("_business_date", "_source_file", "_ord")
        .hint("rebalance", "month")
        .write.partitionBy("month")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(written)
    )
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(written)
    name = F.concat(
        F.lit(f"{folder_of(lake, entry)}/claims_"), F.regexp_extract("path", "month=([0-9]+)", 1), F.lit("_"),
        F.regexp_extract("path", "part-([0-9]+)", 1), F.lit(".csv"),
    )
    copy_files(parts.select("path", name.alias("target")))
    n_expected = len(entry["files"]) * 2
    outcomes = ingest_directory(spark, lake, entry, SAMPLE_DATE, allowed_missing=n_expected).outcomes
    files = outcomes.select(F.col("uri").alias("path"), F.lit(0).cast("bigint").alias("length")).where("path IS NOT NULL")
    month_of = F.regexp_extract("_source_file", "claims_([0-9]+)_", 1).alias("month")
    return read_csv_files(spark, files).select(*LANDED_CELLS, month_of)


#: Room for the places within one part of a file, in bytes.
PART_ROOM = 1 << 40


def violation_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of monthly claim files, each with the position of its row in the file.

    A month is written in parts by as many tasks as its rows need, in the order of the ranges they hold. The parts stand
    one after the other: a split's place in the month is its part first, then its place in the part.
    """
    written = scratch_dir(spark, "positions")
    month = F.date_format("_business_date", "yyyyMM")
    (
        raw_sample(spark, sf_dir, "claims")
        .withColumn("month", month)
        .drop("_business_date", "_source_file")
        .repartitionByRange("month", "_ord")
        .sortWithinPartitions("month", "_ord")
        .drop("_ord")
        .write.partitionBy("month")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(written)
    )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(written)
    part = F.regexp_extract(PATH, "/part-([0-9]+)[^/]*$", 1).cast("bigint")
    rows = read_csv_files(spark, files.select("path", "length")).withColumns(
        {SOURCE_FILE: F.regexp_extract(PATH, "month=([0-9]+)", 1), BLOCK_START: part * PART_ROOM + F.col(BLOCK_START)}
    )
    return gate.violations(rows, REGISTRY["claims"])


def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw claims through the CSV layer: dates found and rows read back per date."""
    lake = Lake(scratch_dir(spark, "bronze"))
    _write_bronze(raw_sample(spark, sf_dir, "claims"), lake, "inbound", "claims")
    rows = read_bronze(spark, lake.bronze, "claims")
    counts = rows.groupBy("_business_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("claim_id").alias("n_ids"), F.count("adjuster_id").alias("n_adjusters")
    )
    dates = list_bronze_dates(spark, lake.bronze, "claims")
    return dates.join(counts, dates.business_date == counts["_business_date"], "left").drop("_business_date")


QUERIES: dict[str, Query] = {
    **{f"silver_{e}": silver_query(e) for e in REGISTRY},
    "dim_policy": dim_query("policies", gold.dim_policy),
    "dim_claimant": dim_query("claims", gold.dim_claimant),
    "dim_reinsurer": dim_query("reinsurance", gold.dim_reinsurer),
    "fact_premiums": fact_query("premiums", gold.fact_premiums),
    "fact_claims": fact_query("claims", gold.fact_claims),
    "fact_reinsurance": fact_query("reinsurance", gold.fact_reinsurance),
    "agg_daily_premium_summary": agg_query("premiums", gold.agg_daily_premium_summary),
    "agg_claim_by_status": agg_query("claims", gold.agg_claim_by_status),
    "agg_reinsurer_exposure": agg_query("reinsurance", gold.agg_reinsurer_exposure),
    **{f"violations_{e}": violations_query(e) for e in REGISTRY},
    "file_stats": file_stats,
    "duplicate_keys": duplicate_keys,
    "gate_files": gate_files,
    "routed_rows": routed_rows,
    "large_sums": large_sums,
    "parse_failures": parse_failures,
    "dedup_dropped": dedup_dropped,
    "expected_files": expected_files,
    "arrival_report": arrival_report,
    "missing_files": missing_files,
    "unexpected_files": unexpected_files,
    "entity_inference": entity_inference,
    "files_per_entity": files_per_entity,
    "file_kinds": file_kinds,
    "new_files": new_files,
    "landed_names": landed_names,
    "pending_dates": pending_dates,
    "forced_dates": forced_dates,
    "ledger_state": ledger_state,
    "ledger_lookback": ledger_lookback,
    "ledger_snapshot": ledger_snapshot,
    "ledger_summary": ledger_totals,
    "expired_partitions": expired,
    "checksum_report": checksum_report,
    "audit_rows": audit_rows,
    "run_summary": run_summary,
    "run_report": run_report,
    "directory_report": directory_report,
    "partition_replace": partition_replace,
    "truncate_load": truncated_load,
    "backfill_silver": backfill_silver,
    "violation_positions": violation_positions,
    "bronze_partitions": bronze_partitions,
    "landed_cells": landed_cells,
    "silver_metrics": silver_metrics,
    "gold_load": gold_load,
    "file_checksums": file_checksums,
    "stream_incremental_silver": stream_incremental_silver,
}
