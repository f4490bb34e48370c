"""Small driver-side tables whose size the optimizer knows, so joins with them need no hint."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Configuration or status rows as a local relation."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(schema)), schema)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, in a form the optimizer removes from unions and joins."""
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
