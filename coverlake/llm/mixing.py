"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.text import materialise, words_sql

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_COPIES = 2
SEED = 20240607


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most_copies: int = MOST_COPIES,
) -> DataFrame:
    """Targets of each source from rows (source, source_size).

    Sources by code point, null last, take the weights in turn. A target stops at `most_copies` times its source's
    size and the excess is shared anew by weight. In order of cap / weight that has a closed form: a source is capped
    if its cap is at most its weight times what is left, divided by the weights left. One row per source.
    """
    listed = ", ".join(str(w) for w in weights)
    spark_sql = sizes.selectExpr(
        "source",
        "source_size",
        f"element_at(array({listed}), CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(weights)}"
        " AS INT) + 1) AS weight",
        f"{most_copies} * source_size AS cap",
        f"sum(source_size) OVER () * {share_percent} AS percent_total",
    )
    order = "ORDER BY CAST(cap AS DOUBLE) / weight, source IS NULL, source"
    left = spark_sql.selectExpr(
        "*",
        f"percent_total - 100 * coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        " AS percent_left",
        f"sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left",
    ).selectExpr("*", "100 * cap * weight_left <= weight * percent_left AS capped")
    level = left.selectExpr(
        "*",
        "min(CASE WHEN NOT capped THEN struct(CAST(cap AS DOUBLE) / weight AS at, source IS NULL AS missing, source AS"
        " name, percent_left, weight_left) END) OVER () AS level",
    )
    return level.selectExpr(
        "source",
        "source_size",
        "CASE WHEN capped THEN CAST(cap AS DOUBLE)"
        " ELSE CAST(weight * level.percent_left AS DOUBLE) / CAST(100 * level.weight_left AS DOUBLE) END AS target",
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most_copies: int = MOST_COPIES,
    seed: int = SEED,
    whole: bool = True,
) -> DataFrame:
    """How often each document is taken: doc_id, source, size, source_size, target, copies, taken, document.

    A document of a source is expected target / source_size times. Within a source the documents stand in the order
    of size, id and text; expected copies are summed along it, one offset from the seed is added, and a document is
    taken once for each integer its interval crosses. Since neighbours have like sizes, the words taken stay near the
    target. Ranks come from a range sort written once to the shared folder: rows before a range are counted per
    range and source, so neither a source nor a size has to fit into one task.

    Null text: size 0. Null source: a source of its own. Documents of size 0 and sources of size 0 take no words.
    Rows with the same id are different documents. `document` is the whole row of `docs`, so that copies need no join
    back; without `whole` it is left out and columns other than doc_id, text and source are not read. Empty input: no
    rows.
    """
    rows = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document")] if whole else []
    sized = docs.select(
        "doc_id", "source", F.expr(f"CAST(size({words_sql('text')}) AS BIGINT)").alias("size"),
        F.expr("xxhash64(text)").alias("text_hash"), *rows,
    )
    order = ["source", "size", "doc_id", "text_hash"]
    # a row's number holds its range in the upper bits and its place in the sorted range in the lower 33
    ordered = materialise(
        sized.repartitionByRange(*order).sortWithinPartitions(*order).drop("text_hash")
        .select("*", F.monotonically_increasing_id().alias("row_no")).selectExpr("*", "shiftright(row_no, 33) AS part"),
        "mix-order",
    )
    parts = ordered.groupBy("source", "part").agg(
        F.sum("size").alias("size"), F.count("*").alias("n"), F.min("row_no").alias("first_no")
    )
    offsets = parts.selectExpr(
        "source",
        "part",
        "first_no",
        "coalesce(sum(n) OVER (PARTITION BY source ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        " AS before",
    )
    targets = source_targets(
        parts.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share_percent, most_copies
    ).selectExpr("source AS target_source", "source_size", "target")
    plan = offsets.join(targets, offsets.source.eqNullSafe(targets.target_source)).selectExpr(
        "source AS plan_source", "part AS plan_part", "first_no", "before", "source_size", "target"
    )
    placed = ordered.join(
        plan, ordered.source.eqNullSafe(plan.plan_source) & (ordered.part == plan.plan_part)
    )
    offset = f"CAST(conv(substr(md5(concat('{seed}:', coalesce(source, ''))), 1, 8), 16, 10) AS DOUBLE) / 4294967296.0D"
    rate = "CASE WHEN source_size = 0 THEN 0.0D ELSE target / CAST(source_size AS DOUBLE) END"
    return (
        placed.selectExpr(
            "*", f"{rate} AS rate", f"{offset} AS offset", "before + row_no - first_no + 1 AS position"
        )
        .selectExpr(
            "*",
            "CAST(floor(position * rate + offset) - floor((position - 1) * rate + offset) AS BIGINT) AS copies",
        )
        .selectExpr(
            "doc_id", "source", "size", "source_size", "target", "copies", "copies * size AS taken",
            *(["document"] if whole else []),
        )
    )


def mixed_documents(docs: DataFrame, mixture: DataFrame) -> DataFrame:
    """The mix itself: every document as often as `mix` takes it, numbered by `copy_no` from 1.

    The rows come whole from the mixture of `docs`, so that rows that share an id, or have none, are each taken as
    often as they are. A column copy_no of `docs` is replaced.
    """
    if "document" not in mixture.columns:
        raise ValueError("the mixture has no documents: mix() has to be asked for whole rows")
    columns = [c for c in docs.columns if c.lower() != "copy_no"]
    taken = mixture.where("copies > 0").select("copies", "document")
    return taken.select(
        *(F.col("document").getField(c).alias(c) for c in columns),
        F.explode(F.expr("sequence(1, CAST(copies AS INT))")).alias("copy_no"),
    )
