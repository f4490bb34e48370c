"""Audit rows per landed file and the counts a run reports."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlake.functions import names

AUDIT_TYPE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("gcs_uri", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("rows_valid", T.LongType()),
        T.StructField("rows_dropped", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("dir_id", T.StringType()),
        T.StructField("gcs_prefix", T.StringType()),
    ]
)


def new_run_id() -> str:
    return str(uuid.uuid4())


def audit_rows(landed: DataFrame, stats: DataFrame, run_id: str, day: date, dir_id: str | None = None) -> DataFrame:
    """One row per landed file with its statistics, matched by file name.

    `landed` has file_name and uri; `stats` has file_name, file_type, rows_valid and rows_dropped. Without a directory
    given it is the files' own, or else read from the URI.
    """
    by_directory = "dir_id" in landed.columns and "dir_id" in stats.columns
    keys = ["dir_id", "file_name"] if by_directory else ["file_name"]
    figures = stats.select(*keys, "file_type", "rows_valid", "rows_dropped")
    paired = landed.select(*keys, "uri").join(figures, keys, "left")
    if dir_id is not None:
        directory = F.lit(dir_id)
    else:
        directory = F.col("dir_id") if by_directory else names.uri_directory(F.col("uri"))
    return paired.select(
        F.lit(run_id).alias("run_id"),
        F.lit(day).cast("date").alias("business_date"),
        F.col("uri").alias("gcs_uri"),
        F.coalesce("file_type", F.lit("")).alias("file_type"),
        F.coalesce("rows_valid", F.lit(0)).cast("bigint").alias("rows_valid"),
        F.coalesce("rows_dropped", F.lit(0)).cast("bigint").alias("rows_dropped"),
        F.current_timestamp().alias("ingested_at"),
        directory.alias("dir_id"),
        names.uri_prefix(F.col("uri")).alias("gcs_prefix"),
    )


def write_audit(rows: DataFrame, path: str) -> bool:
    """Append the rows of a run; nothing is written for a run without files."""
    if rows.isEmpty():
        return False
    rows.write.mode("append").partitionBy("business_date").parquet(path)
    return True


def run_summary(results: DataFrame) -> DataFrame:
    """Count of ok, skipped and failed steps; `results` has one `status` per step."""
    status = F.when(F.col("status").startswith("error"), "error").otherwise(F.col("status"))
    return results.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("steps"))


def run_report(
    manifest: DataFrame, landed: DataFrame, silver_results: DataFrame, gold_results: DataFrame
) -> DataFrame:
    """The four counts of a finished run: directories, bronze files, silver entities, gold tables."""
    not_written = ["skipped", "no_bronze", "error"]
    written = ~F.greatest(*[F.col("status").startswith(s) for s in not_written])
    parts = [
        manifest.agg(F.count(F.lit(1)).alias("n")).select(F.lit("directories").alias("item"), "n"),
        landed.agg(F.count(F.lit(1)).alias("n")).select(F.lit("bronze_files").alias("item"), "n"),
        silver_results.where(written).agg(F.count(F.lit(1)).alias("n")).select(F.lit("silver_entities").alias("item"), "n"),
        gold_results.where(F.col("status") == "ok").agg(F.count(F.lit(1)).alias("n")).select(F.lit("gold_tables").alias("item"), "n"),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def directory_report(listing: DataFrame, new: DataFrame, landed: DataFrame, processed: DataFrame) -> DataFrame:
    """Per directory: files seen, new and uploaded, and whether the load was full or incremental."""

    def count(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy("dir_id").agg(F.count(F.lit(1)).alias(name))

    joined = count(listing, "listed_files")
    for frame, name in ((new, "new_files"), (landed, "uploaded_files"), (processed, "known_files")):
        joined = joined.join(count(frame, name), "dir_id", "left")
    filled = joined.na.fill(0, ["listed_files", "new_files", "uploaded_files", "known_files"])
    mode = F.when(F.col("known_files") == 0, "FULL LOAD").otherwise("INCREMENTAL")
    return filled.select("dir_id", "listed_files", "new_files", "uploaded_files", mode.alias("mode"))
