"""Raw CSV scans: every column text, mapped by header name, with the position of each row."""

from __future__ import annotations

import re
from collections import defaultdict
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlake.functions import names
from coverlake.sources.landing import NOT_UTF8, path_exists, read_headers
from coverlake.sources.local import empty_frame, struct

# Provenance every raw frame carries. ROW_ORDER gives file order: rows of one file sort by block, then row.
# `_path` is where the row was read, `_source_file` the file it first arrived in.
COLUMNS = "_columns"
OVERFLOW = "_overflow"
SOURCE_FILE = "_source_file"
BLOCK_START = "_block_start"
ROW_ID = "_row_id"
ROW_ORDER = [SOURCE_FILE, BLOCK_START, ROW_ID]
PATH = "_path"

# Bronze holds files as they were delivered, or packed one by one.
BRONZE_FILES = "*.{csv,csv.gz}"

# Bytes of text that a byte of a gzip file is taken for, where jobs are sized. The feeds pack to a fourth or fifth.
GZIP_RATIO = 5

# Names a delivered file may not use, in any case.
RESERVED = frozenset([COLUMNS, OVERFLOW, SOURCE_FILE, BLOCK_START, ROW_ID, PATH, "_business_date", "_file_name"])

_EMPTY_TYPE = T.StructType(
    [
        T.StructField(COLUMNS, T.ArrayType(T.StringType())),
        T.StructField(OVERFLOW, T.StringType()),
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(BLOCK_START, T.LongType()),
        T.StructField(ROW_ID, T.LongType()),
        T.StructField(PATH, T.StringType()),
    ]
)


def empty_raw(spark: SparkSession) -> DataFrame:
    return empty_frame(spark, _EMPTY_TYPE)


def bare_path(path: str) -> str:
    """A path without scheme and host, as listings and scans write those in different forms."""
    return re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def text_traits(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Of each file with lines: whether a line holds an odd number of quotes, so a record may span lines, and whether
    all bytes are UTF-8. One pass over the raw lines, reduced per file in the map tasks."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    return (
        lines.select(
            names.plain_path(F.col("_metadata.file_path")).alias("path"),
            (F.coalesce(quotes, F.lit(0)) % 2 == 1).alias("odd"),
            F.is_valid_utf8("value").alias("valid"),
        )
        .groupBy("path")
        .agg(F.expr("bool_or(odd)").alias("spans_lines"), F.expr("bool_and(valid)").alias("is_utf8"))
    )


def _scan(spark: SparkSession, paths: list[str], header: list[str], multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, OVERFLOW]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .csv(paths)
    )
    return rows.select(
        *[F.col(f"`{c}`") for c in [*header, OVERFLOW]],
        names.plain_path(F.col("_metadata.file_path")).alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(BLOCK_START),
        F.monotonically_increasing_id().alias(ROW_ID),
        F.lit(header).cast("array<string>").alias(COLUMNS),
        names.plain_path(F.col("_metadata.file_path")).alias(PATH),
    )


class UnreadableFiles(RuntimeError):
    """Files that should have been read and cannot be."""


def read_csv_files(
    spark: SparkSession, files: DataFrame, whole_folders: bool = False, strict: bool = False
) -> DataFrame:
    """Rows of the listed CSV files as text, columns matched by name.

    Files with the same header form one scan, so an ordinary day is one scan. A file is read in splits, whatever its
    length, unless some line holds an odd number of quotes; then its records may span lines and it is read whole.
    Cells beyond the header land in `_overflow`. Files with a faulty header are left out, or, if strict, stop the job
    before it reads on, as bytes that are not UTF-8 do. Paths pass through the driver, as they do in Spark's own file index; with `whole_folders`, a folder whose files are all listed and alike
    is passed as one path.
    """
    headers = read_headers(files, RESERVED).where("columns IS NOT NULL OR fault IS NOT NULL")
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    if whole_folders:
        kinds = headers.groupBy(folder.alias("folder")).agg(
            F.collect_set("columns").alias("kinds"),
            F.collect_list(F.struct("path", "columns", "fault")).alias("members"),
            F.bool_or(F.col("fault").isNotNull()).alias("faulty"),
        )
        alike = (F.size("kinds") == 1) & ~F.col("faulty")
        together = F.struct(F.col("folder").alias("path"), F.col("kinds")[0].alias("columns"), F.lit(None).cast("string").alias("fault"))
        targets = kinds.select(
            F.explode(
                F.when(alike, F.array(together)).otherwise(F.col("members"))
            ).alias("t")
        ).select("t.path", "t.columns", "t.fault")
    else:
        targets = headers.select("path", "columns", "fault")
    listed = targets.orderBy("path").collect()
    if strict and (faulty := [f"{r.path}: {r.fault}" for r in listed if r.fault]):
        raise UnreadableFiles("; ".join(faulty[:10]))
    found = [r for r in listed if not r.fault]
    if not found:
        return empty_raw(spark)
    traits = text_traits(spark, [r.path for r in found]).where("spans_lines OR NOT is_utf8").collect()
    if strict and (faulty := [r.path for r in traits if not r.is_utf8]):
        raise UnreadableFiles(f"{NOT_UTF8}: {'; '.join(faulty[:10])}")
    spanning = {bare_path(r.path) for r in traits if r.spans_lines}
    spanning_folders = {path.rpartition("/")[0] for path in spanning}
    groups: dict[tuple, list[str]] = defaultdict(list)
    for row in found:
        bare = bare_path(row.path)
        groups[tuple(row["columns"]), bare in spanning or bare in spanning_folders].append(row.path)
    result = empty_raw(spark)
    for (header, multi_line), paths in groups.items():
        scan = _scan(spark, paths, list(header), multi_line)
        result = result.unionByName(scan, allowMissingColumns=True)
    return result


def bronze_files(
    spark: SparkSession, bronze_root: str, entity: str, dates: list[date] | None = None
) -> DataFrame:
    """CSV files of an entity, plain or gzip, over all directories with their partition date; malformed paths are left out.

    The layout is `{bronze}/{directory}/{entity}/year=/month=/day=`. With dates given, only their folders are listed.
    A gzip file is read by one task.
    """
    schema = struct(path=T.StringType(), length=T.LongType(), business_date=T.DateType())
    folder = f"{bronze_root}/*/{entity}"
    if dates is not None:
        if not dates:
            return empty_frame(spark, schema)
        folder += "/{" + ",".join(names.date_path(d) for d in sorted(set(dates))) + "}"
    if not path_exists(spark, folder):
        return empty_frame(spark, schema)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", BRONZE_FILES)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    day = names.path_date(F.col("path")).alias("business_date")
    return files.select("path", "length", day).where(F.col("business_date").isNotNull())


def bronze_dates(
    spark: SparkSession, bronze_root: str, entity: str, dates: list[date] | None = None
) -> DataFrame:
    """Distinct partition dates of an entity over all directories, sorted; with dates given, only those are listed."""
    return bronze_files(spark, bronze_root, entity, dates).select("business_date").distinct().orderBy("business_date")


def bronze_sizes(spark: SparkSession, bronze_root: str, entity: str) -> dict[date, int]:
    """Bytes of text, about, of each partition date of an entity over all directories, by date."""
    text = F.col("length") * F.when(F.col("path").endswith(".gz"), GZIP_RATIO).otherwise(1)
    sizes = bronze_files(spark, bronze_root, entity).groupBy("business_date").agg(F.sum(text).alias("bytes"))
    return {r.business_date: r.bytes for r in sizes.orderBy("business_date").collect()}


def read_bronze(spark: SparkSession, bronze_root: str, entity: str, dates: list[date] | None = None) -> DataFrame:
    """Raw rows of an entity for the given dates (all when none are named), with `_business_date`."""
    files = bronze_files(spark, bronze_root, entity, dates)
    rows = read_csv_files(spark, files, whole_folders=True, strict=True)
    return rows.withColumn("_business_date", names.path_date(F.col(PATH))).drop(PATH)
