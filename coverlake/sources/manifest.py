"""The directory manifest as a nested table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlake.sources.local import local_frame

FILE_TYPE = T.StructType(
    [T.StructField(n, T.StringType(), False) for n in ("entity", "pattern", "checksum")]
)

MANIFEST_TYPE = T.StructType(
    [
        T.StructField("dir_id", T.StringType(), False),
        T.StructField("remote_dir", T.StringType(), False),
        T.StructField("use_pgp", T.BooleanType(), False),
        T.StructField("use_checksum", T.BooleanType(), False),
        T.StructField("gcs_prefix", T.StringType(), False),
        T.StructField("files", T.ArrayType(FILE_TYPE, False), False),
    ]
)

# The two partner directories and the files each delivers per day.
DIRECTORIES = [
    {
        "dir_id": "inbound",
        "remote_dir": "/inbound/",
        "use_pgp": True,
        "use_checksum": True,
        "gcs_prefix": "bronze/inbound",
        "files": [
            {
                "entity": "policies",
                "pattern": "policies_%Y%m%d.csv.gpg",
                "checksum": "policies_%Y%m%d.csv.sha256",
            },
            {
                "entity": "claims",
                "pattern": "claims_%Y%m%d.csv.gpg",
                "checksum": "claims_%Y%m%d.csv.sha256",
            },
        ],
    },
    {
        "dir_id": "reports",
        "remote_dir": "/reports/",
        "use_pgp": False,
        "use_checksum": False,
        "gcs_prefix": "bronze/reports",
        "files": [
            {"entity": "premiums", "pattern": "premiums_%Y%m%d.csv", "checksum": ""},
            {"entity": "reinsurance", "pattern": "reinsurance_%Y%m%d.csv", "checksum": ""},
        ],
    },
]


def manifest_table(spark: SparkSession, directories: list[dict] = DIRECTORIES) -> DataFrame:
    """One row per directory, in manifest order (`dir_pos`)."""
    schema = T.StructType([T.StructField("dir_pos", T.IntegerType(), False), *MANIFEST_TYPE.fields])
    rows = [{"dir_pos": pos, **{name: d[name] for name in MANIFEST_TYPE.names}} for pos, d in enumerate(directories)]
    return local_frame(spark, rows, schema)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest kept as JSON lines, one directory per line in manifest order."""
    rows = spark.read.schema(MANIFEST_TYPE).json(path)
    order = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    ranked = rows.select("*", order.alias("_order")).orderBy("_order").drop("_order")
    return manifest_table(spark, [r.asDict(recursive=True) for r in ranked.collect()])


def directory(manifest: DataFrame, dir_id: str) -> dict:
    """The entry of one directory; an unknown id is an error that names the known ones."""
    rows = manifest.where(F.col("dir_id") == dir_id).limit(1).collect()
    if not rows:
        known = [r.dir_id for r in manifest.select("dir_id", "dir_pos").orderBy("dir_pos").collect()]
        raise KeyError(f"The manifest has no directory {dir_id!r}, only {known}")
    return rows[0].asDict(recursive=True)


def manifest_files(manifest: DataFrame) -> DataFrame:
    """One row per file entry, with the directory's flags and both positions."""
    return manifest.select(
        "dir_pos", "dir_id", "use_pgp", "use_checksum", "gcs_prefix",
        F.posexplode("files").alias("file_pos", "file"),
    ).select("*", "file.*").drop("file")


def manifest_entities(manifest: DataFrame) -> DataFrame:
    """Distinct entities in manifest order (first mention counts)."""
    return (
        manifest_files(manifest)
        .groupBy("entity")
        .agg(F.min(F.struct("dir_pos", "file_pos")).alias("first_seen"))
        .orderBy("first_seen")
        .select("entity")
    )
