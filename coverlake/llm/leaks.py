"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, weighted-shingle verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverlake.llm.text import materialise, unused

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
#: Bits of the 64 in which fingerprints of a window and an item may differ. Two sets of weight similarity 0.8 differ in
#: 9.7 bits on average with a deviation of 2.9; the binomial tail beyond 24 is 3 in a million such pairs.
RADIUS = 24
#: Tables up to this many rows, of at most 32 bytes each, are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its row count allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def normal_words_sql(column: str) -> str:
    """Lower-cased runs of letters and digits."""
    return rf"array_remove(split(lower(coalesce({column}, '')), '[^\\p{{L}}\\p{{N}}]+'), '')"


def _words_at(words: str, i: str) -> list[str]:
    return [f"{words}[{i} + {k}]" for k in range(SHINGLE_WORDS)]


def shingles_sql(words: str) -> str:
    """Hash and weight, its letters and digits, of each shingle of an array of words, in order."""
    hashed = f"xxhash64({', '.join(_words_at(words, 'i'))})"
    weight = " + ".join(f"length({w})" for w in _words_at(words, "i"))
    return (
        f"CASE WHEN size({words}) < {SHINGLE_WORDS} THEN CAST(array() AS ARRAY<STRUCT<h: BIGINT, w: INT>>)"
        f" ELSE transform(sequence(0, size({words}) - {SHINGLE_WORDS}), i -> named_struct('h', {hashed}, 'w', {weight})) END"
    )


def simhash_sql(shingles: str) -> str:
    """64 bits, each the sign of the weights of the shingles with that bit set less those without."""
    vote = f"aggregate({shingles}, 0, (s, x) -> s + CASE WHEN shiftright(x.h, b) & 1 = 1 THEN x.w ELSE -x.w END)"
    return f"aggregate(transform(sequence(0, 63), b -> CASE WHEN {vote} > 0 THEN shiftleft(1L, b) ELSE 0L END), 0L, (s, x) -> s | x)"


def blocks_sql(fingerprint: str, radius: int) -> str:
    """The fingerprint's radius + 1 blocks as (number, value): fingerprints within the radius agree in one of them."""
    count = radius + 1
    edges = [64 * k // count for k in range(count + 1)]
    blocks = (
        f"named_struct('block', {k}, 'value', shiftrightunsigned({fingerprint}, {a}) & {(1 << (b - a)) - 1}L)"
        for k, (a, b) in enumerate(zip(edges, edges[1:]))
    )
    return f"array({', '.join(blocks)})"


def _fingerprinted(df: DataFrame) -> DataFrame:
    """Adds shingles and fingerprint to rows with `words`."""
    return (
        df.withColumn("shingles", F.expr(f"array_distinct({shingles_sql('words')})"))
        .drop("words")
        .withColumn("fingerprint", F.expr(simhash_sql("shingles")))
    )


def _grams_sql(words: str, size: int) -> str:
    """Hashes of every run of `size` words of an array, in order."""
    at = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return (
        f"CASE WHEN size({words}) < {size} THEN CAST(array() AS ARRAY<BIGINT>)"
        f" ELSE transform(sequence(0, size({words}) - {size}), i -> xxhash64({at})) END"
    )


def _windows(worded: DataFrame, items: DataFrame, threshold_percent: int) -> DataFrame:
    """Item-sized windows whose common shingles with items of that size may weigh enough: n_words and start.

    A shingle of a text that is one of an item lies in the windows that start from `n_words - 5` words before it up to
    it. Every such shingle adds its weight where these windows begin and takes it away where they end; the running sum
    is each window's weight of item shingles, counted at least once each. As the similarity is at most the common
    weight over the item's, windows with less than the threshold's share of the lightest item cannot match.
    """
    anchors = materialise(
        items.selectExpr("n_words", "inline(shingles) AS (h, w)")
        .distinct()
        .join(
            items.groupBy("n_words").agg(F.expr("min(aggregate(shingles, 0L, (s, x) -> s + x.w)) AS lightest")),
            "n_words",
        ),
        "anchors",
    )
    hits = (
        worded.selectExpr(
            "doc_id", "text_hash", "size(words) AS n_text", f"posexplode({_grams_sql('words', SHINGLE_WORDS)}) AS (place, h)"
        )
        .join(small(anchors), "h")
        .selectExpr(
            "doc_id", "text_hash", "n_words", "lightest", "w",
            f"greatest(0, place - n_words + {SHINGLE_WORDS}) AS low",
            "least(place, greatest(0, n_text - n_words)) AS high",
            "place",
        )
        .distinct()
    )
    steps = (
        hits.selectExpr(
            "doc_id", "text_hash", "n_words", "lightest",
            "inline(array(named_struct('start', low, 'step', CAST(w AS BIGINT)),"
            " named_struct('start', high + 1, 'step', -CAST(w AS BIGINT))))",
        )
        .groupBy("doc_id", "text_hash", "n_words", "lightest", "start")
        .agg(F.sum("step").alias("step"))
    )
    order = Window.partitionBy("doc_id", "text_hash", "n_words").orderBy("start")
    runs = steps.select(
        "doc_id", "text_hash", "n_words", "lightest", "start",
        F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("weight"),
        F.lead("start").over(order).alias("next"),
    )
    return runs.where(f"100 * weight >= {threshold_percent} * lightest AND next IS NOT NULL").selectExpr(
        "doc_id", "text_hash", "n_words", "explode(sequence(start, next - 1)) AS start"
    )


def _short_items(worded: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items of one to four words in documents, where all their words stand one after the other."""
    items = benchmark.where("text IS NOT NULL").selectExpr("item_id", f"{normal_words_sql('text')} AS words")
    items = items.where(f"size(words) BETWEEN 1 AND {SHINGLE_WORDS - 1}")
    sizes = sorted(r.n for r in items.select(F.size("words").alias("n")).distinct().collect())
    grams = [f"transform({_grams_sql('words', n)}, (h, i) -> named_struct('n_words', {n}, 'start', i, 'h', h))" for n in sizes]
    nothing = "CAST(array() AS ARRAY<STRUCT<n_words: INT, start: INT, h: BIGINT>>)"
    listed = materialise(
        items.selectExpr(
            "item_id", "size(words) AS size",
            "CASE size(words) " + " ".join(
                f"WHEN {n} THEN xxhash64({', '.join(f'words[{k}]' for k in range(n))})" for n in range(1, SHINGLE_WORDS)
            ) + " END AS item_hash",
        ),
        "short-items",
    )
    return (
        worded.selectExpr("doc_id", "text_hash", f"inline({f'concat({chr(44).join(grams)})' if grams else nothing})")
        .join(small(listed), F.expr("n_words = size AND h = item_hash"))
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.min("start").alias("start"), F.first("n_words").alias("n_words"))
        .withColumn("similarity", F.lit(1.0))
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold_percent: int = THRESHOLD_PERCENT,
    radius: int = RADIUS,
) -> DataFrame:
    """Benchmark items found in documents: doc_id, text_hash, item_id, start, n_words, similarity.

    A window has as many words as an item. Every window start is considered at which the shingles common with items of
    that size may weigh enough for the threshold (`_windows`), so none is lost; each such window is fingerprinted once.
    Windows meet the items of their size through the blocks of their fingerprints; pairs within the radius are verified
    by the weight of common shingles over the weight of all, a shingle weighing its letters. The best window of each
    item is returned, `start` counted in words from 0; of equally good ones the first.

    Words are lower-cased runs of letters and digits. An item of one to four words is found where all its words stand
    one after the other, with similarity 1. Null items and items without words match nothing; null and empty texts hold
    nothing. A text shorter than an item is compared as a whole. Equal items are all reported. Rows with the same id and
    text are one document; other columns are ignored.
    """
    worded = docs.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS text_hash", f"{normal_words_sql('text')} AS words")
    items = benchmark.where("text IS NOT NULL").selectExpr("item_id", f"{normal_words_sql('text')} AS words")
    items = materialise(
        _fingerprinted(items.where(f"size(words) >= {SHINGLE_WORDS}").selectExpr("item_id", "size(words) AS n_words", "words")),
        "items",
    )
    windows = materialise(_windows(worded, items, threshold_percent), "windows")
    by_text = windows.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n_words")).alias("windows"))
    if windows.count() <= BROADCAST_ROWS:
        by_text = F.broadcast(by_text)
    by_text = by_text.withColumnsRenamed({"doc_id": "d", "text_hash": "t"})
    cut = (
        worded.join(by_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")))
        .selectExpr(
            "doc_id", "text_hash",
            "explode(transform(windows, w -> named_struct('start', w.start, 'n_words', w.n_words,"
            " 'words', slice(words, w.start + 1, w.n_words)))) AS w",
        )
        .selectExpr("doc_id", "text_hash", "w.start AS start", "w.n_words AS n_words", "w.words AS words")
        .dropDuplicates(["doc_id", "text_hash", "start", "n_words"])
    )
    marked = materialise(_fingerprinted(cut), "fingerprints")
    blocked = marked.selectExpr("doc_id", "text_hash", "start", "n_words", "fingerprint", f"inline({blocks_sql('fingerprint', radius)})")
    listed = items.selectExpr("item_id", "n_words", "fingerprint AS item_print", f"inline({blocks_sql('fingerprint', radius)})")
    candidates = (
        blocked.join(listed, ["n_words", "block", "value"])
        .where(f"bit_count(fingerprint ^ item_print) <= {radius}")
        .select("doc_id", "text_hash", "start", "n_words", "item_id")
        .distinct()
    )
    named = ["doc_id", "text_hash", "start", "n_words"]
    left = marked.selectExpr("doc_id AS d", "text_hash AS t", "start AS s", "n_words AS n", "shingles AS found")
    right = items.selectExpr("item_id AS i", "shingles AS wanted")
    total = "aggregate({0}, 0L, (s, x) -> s + x.w)".format
    scored = (
        candidates.join(
            left,
            F.col("doc_id").eqNullSafe(F.col("d")) & F.expr("text_hash = t AND start = s AND n_words = n"),
        )
        .join(right, F.col("item_id").eqNullSafe(F.col("i")))
        .selectExpr(
            *named, "item_id",
            f"{total('filter(found, x -> array_contains(transform(wanted, y -> y.h), x.h))')} AS both",
            f"{total('found')} + {total('wanted')} AS sum",
        )
        .where(f"100 * both >= {threshold_percent} * (sum - both)")
        .selectExpr(*named, "item_id", "CAST(both AS DOUBLE) / (sum - both) AS similarity")
    )
    best = scored.groupBy("doc_id", "text_hash", "item_id").agg(
        F.expr("min(struct(-similarity AS cost, start, n_words))").alias("best")
    )
    long_items = best.selectExpr(
        "doc_id", "text_hash", "item_id", "best.start AS start", "best.n_words AS n_words", "-best.cost AS similarity"
    )
    return long_items.unionByName(_short_items(worded, benchmark))


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """`docs` without the documents in which a benchmark item was found."""
    found_id, found_hash, own_hash = unused(docs, "found_id", "found_hash", "own_hash")
    found = leaks.selectExpr(f"doc_id AS {found_id}", f"text_hash AS {found_hash}").distinct()
    hashed = docs.withColumn(own_hash, F.expr("xxhash64(coalesce(text, ''))"))
    return hashed.join(
        found, hashed.doc_id.eqNullSafe(found[found_id]) & (hashed[own_hash] == found[found_hash]), "left_anti"
    ).drop(own_hash)
