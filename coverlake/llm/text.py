"""Expressions and small helpers that several text operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coverlake.session import scratch_dir

#: Word separators: space and the control characters 9 to 13.
SPACES = r"[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_sql(column: str) -> str:
    """The words of a text as an array; a null text has none."""
    return f"array_remove(split(coalesce({column}, ''), '{SPACES}'), '')"


def lower_ascii_sql(column: str) -> str:
    """A-Z lower-cased, every other letter as it is."""
    return f"translate({column}, '{UPPER}', '{UPPER.lower()}')"


def literal(text: str) -> str:
    """A text as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back: later reads neither recompute nor reshuffle it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from the frame's columns."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found
