"""Checkpointed streams that take the place of the file and silver ledgers' deltas.

Both streams watch file paths only. What a batch does is a function of the files themselves, and every write replaces
whole files or whole dates, so a batch that runs twice after a lost driver leaves the same tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from coverlake.functions import names
from coverlake.operators import arrival, audit, ledger
from coverlake.plans.ingest import check_digests, folder_of, process_files
from coverlake.plans.layout import Lake
from coverlake.plans.silver import merge_files
from coverlake.sources.manifest import manifest_table
from coverlake.sources.raw_csv import BRONZE_FILES
from coverlake.sources.tables import read_or_empty

# The columns of Spark's binary file source.
FILE_TYPE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def watch_files(spark: SparkSession, folder: str, pattern: str = "*", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder tree as a stream of (path, length, modified_at); contents are not read."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_TYPE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path", "length", F.col("modificationTime").alias("modified_at"))


def stream_silver(
    spark: SparkSession,
    lake: Lake,
    entity: str,
    checkpoint: str,
    as_of: date | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Bronze files as they appear; each batch brings its own files into the dates they belong to.

    A late file meets the rows already there: the last row of a key wins across old and new files. A batch that runs
    twice finds its own rows stored and changes nothing.
    """

    def derive(batch: DataFrame, batch_id: int) -> None:
        merge_files(batch.sparkSession, lake, entity, batch.select("path", "length"), as_of)

    return (
        watch_files(spark, f"{lake.bronze}/*/{entity}", BRONZE_FILES, files_per_batch)
        .writeStream.foreachBatch(derive)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_ingest(
    spark: SparkSession,
    lake: Lake,
    entry: dict,
    day: date,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Landing files of one directory as they appear: checksums, gate, bronze or dead letter, audit, ledger.

    The ledger comes last, as in a batch run, so that a batch run after the stream finds nothing new. A batch that runs
    twice writes its audit rows once.
    """

    def gate_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        new = batch.select(
            F.lit(entry["dir_id"]).alias("dir_id"),
            names.base_name(F.col("path")).alias("file_name"),
            "path",
            "length",
            "modified_at",
        ).where(names.is_visible(F.col("file_name")))
        check_digests(session, lake, entry, new)
        run_id = f"stream-{entry['dir_id']}-{day.isoformat()}-{batch_id}"
        outcomes_path = lake.quality("outcomes", run_id, entry["dir_id"], "all")
        process_files(session, lake, entry, new, day, run_id).write.mode("overwrite").parquet(outcomes_path)
        outcomes = session.read.parquet(outcomes_path)
        if read_or_empty(session, lake.audit, audit.AUDIT_TYPE).where(F.col("run_id") == run_id).isEmpty():
            landed = outcomes.where(F.col("outcome") == ledger.LANDED)
            audit.write_audit(audit.audit_rows(landed, outcomes, run_id, day), lake.audit)
        entries = outcomes.withColumn("business_date", F.lit(day).cast("date"))
        entries = arrival.with_encrypted_names(entries, manifest_table(session, [entry]))
        ledger.FileLedger(session, lake.file_ledger).record(entry["dir_id"], entries)

    return (
        watch_files(spark, folder_of(lake, entry), "*", files_per_batch)
        .writeStream.foreachBatch(gate_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


