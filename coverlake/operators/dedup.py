"""One row per key, kept by row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(rows: DataFrame, keys: list[str], order: list[str], keep: str = "last") -> DataFrame:
    """The last (or first) row of each key in `order`; null keys count as one key.

    The rank filter sits directly on the window, so Spark keeps one row per key in every map task before the shuffle.
    A key that holds a third of all rows then sends at most one row per task.
    """
    ranking = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in order]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def dropped_counts(rows: DataFrame, group: list[str], key: str, source: str) -> DataFrame:
    """Rows lost to deduplication, split into repeats within one file and repeats across files.

    Counted in three levels, each with map-side partial counts, so no key or file is gathered in one task.
    """
    per_file = rows.groupBy(*group, key, source).agg(F.count(F.lit(1)).alias("n"))
    per_key = per_file.groupBy(*group, key).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("files"))
    return per_key.groupBy(*group).agg(
        F.sum("n").alias("rows_in"),
        (F.sum("n") - F.sum("files")).alias("dropped_within_file"),
        (F.sum("files") - F.count(F.lit(1))).alias("dropped_across_files"),
        F.count(F.lit(1)).alias("rows_kept"),
    )
