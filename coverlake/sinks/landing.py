"""Bronze landing, dead letters and retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlake.functions import names
from coverlake.sources.landing import delete_files, path_exists
from coverlake.sources.local import empty_frame, struct

# Days each layer keeps its files.
RETENTION_DAYS = {"bronze": 90, "dead_letter": 30}

# Fixed value: the tag that says how a landed file came in.
SOURCE_TAG = "sftp_ingestion"

def _folders(day: Column) -> list[Column]:
    return [F.concat(F.lit(f"{k}="), v) for k, v in names.date_partition_columns(day).items()]


def bronze_uri(root: str, prefix: Column, entity: Column, day: Column, file_name: Column) -> Column:
    """Address of a landed file: `{root}/{prefix}/{entity}/year=/month=/day=/{name}`, zero-padded."""
    return F.concat_ws("/", F.lit(root), prefix, entity, *_folders(day), file_name)


def dead_letter_uri(root: str, dir_id: Column, entity: Column, day: Column, file_name: Column) -> Column:
    """Address of a rejected file; files of no known entity go to `unknown`."""
    known = F.coalesce(entity, F.lit("unknown"))
    return F.concat_ws("/", F.lit(f"{root}/dead_letter"), dir_id, known, *_folders(day), file_name)


def file_tags(dir_id: str, entity: str, day: date) -> Column:
    """Tags of a landed file: how it came in, its directory, its entity and the date it was landed for."""
    tags = {"source": SOURCE_TAG, "dir_id": dir_id, "entity": entity, "business_date": day.isoformat()}
    return F.create_map(*[F.lit(x) for pair in tags.items() for x in pair])


def expired_partitions(partitions: DataFrame, as_of: date, days: dict[str, int] = RETENTION_DAYS) -> DataFrame:
    """Partitions (layer, partition_date) older than their layer keeps; other layers never expire."""
    keep = F.create_map(*[v for layer, n in days.items() for v in (F.lit(layer), F.lit(n))])
    limit = F.try_element_at(keep, F.col("layer"))
    return partitions.where(F.datediff(F.lit(as_of).cast("date"), F.col("partition_date")) > limit)


def layer_files(spark: SparkSession, root: str, layers: list[str]) -> DataFrame:
    """Files of layers below their date folders: layer, partition_date, path. Contents are not read."""
    found = empty_frame(spark, struct(layer=T.StringType(), partition_date=T.DateType(), path=T.StringType()))
    for layer in layers:
        if not path_exists(spark, f"{root}/{layer}"):
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/{layer}")
        dated = files.select(F.lit(layer).alias("layer"), names.path_date(F.col("path")).alias("partition_date"), "path")
        found = found.unionByName(dated.where("partition_date IS NOT NULL"))
    return found


def expire_layers(spark: SparkSession, root: str, as_of: date, days: dict[str, int] = RETENTION_DAYS) -> int:
    """Delete the files of partitions older than their layer keeps; returns how many. Files without bytes and files
    outside a date folder stay, as file scans do not show the former and the latter have no age."""
    return delete_files(expired_partitions(layer_files(spark, root, list(days)), as_of, days))
