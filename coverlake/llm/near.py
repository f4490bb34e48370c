"""N-gram Jaccard join: MinHash bands find candidates, full shingle sets verify them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.arrays import mix, shingles_of, slices
from coverlake.llm.graph import components
from coverlake.llm.text import materialise, unused

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Share of pairs at the threshold that have to become candidates.
TARGET_RECALL = 0.99999
ROWS = 4
#: A bucket is verified in blocks of about so many texts and shingles; every pair of blocks is one group of work.
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 400_000
SEED = 7


def bands_for(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = TARGET_RECALL) -> int:
    """The fewest bands of `rows` hashes that make a pair at the threshold a candidate with the target recall."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))


def _signatures(n: int, bands: int, rows: int):
    randoms = np.random.default_rng(SEED)
    factors = randoms.integers(0, 1 << 63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = randoms.integers(0, 1 << 63, size=bands * rows, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, counts = shingles_of(part.column("text"), n)
                found = np.flatnonzero(counts)
                out = np.zeros((len(counts), bands), np.uint64)
                if len(found):
                    starts = np.concatenate([[0], np.cumsum(counts[found])[:-1]])
                    least = np.empty((len(found), rows), np.uint64)
                    for band in range(bands):
                        for row in range(rows):
                            k = band * rows + row
                            least[:, row] = np.minimum.reduceat((values ^ masks[k]) * factors[k], starts)
                        joined = np.full(len(found), band, np.uint64)
                        for row in range(rows):
                            joined = mix(joined + least[:, row])
                        out[found, band] = joined
                packed = [out[i].tobytes() if counts[i] else None for i in range(len(counts))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "bands"],
                )

    return run


def _shingle_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, counts = shingles_of(part.column("text"), n)
                ends = np.cumsum(counts)
                packed = [np.unique(values[e - c : e]).tobytes() for e, c in zip(ends, counts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("text_key"), pa.array(packed, pa.binary())], names=["text_key", "shingles"]
                )

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets have in common; memory is bounded by the sets and one strip of columns."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owners = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(first) - 1
    often = np.bincount(column)[column] > 1
    owners, column = owners[often], column[often]
    if not len(column):
        return np.zeros((n, n), np.int64)
    column = np.cumsum(np.concatenate([[0], (np.diff(column) != 0).astype(np.int64)]))
    shared = np.zeros((n, n), np.float64)
    width = 4096
    for low in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, [low, low + width])
        strip = np.zeros((n, min(width, int(column[-1]) + 1 - low)), np.float32)
        strip[owners[a:b], column[a:b] - low] = 1
        shared += strip @ strip.T
    return shared.astype(np.int64)


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the links, as many as join the same members."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[y] = x
            kept.append((a, b))
    return kept


def _verify(threshold: float):
    def links(band: int, low: int, high: int, rows: list[dict]) -> Iterator[tuple]:
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        bands = np.array([np.frombuffer(r["bands"], np.uint64) for r in rows])
        block = np.array([r["block"] for r in rows])
        sizes = np.array([len(s) for s in sets])
        shared = shared_counts(sets)
        # integers, so that a pair exactly at the threshold counts
        per_mille = round(threshold * 1000)
        close = 1000 * shared >= per_mille * (sizes[:, None] + sizes[None, :] - shared)
        close = np.triu(close, 1)
        if low != high:
            close &= block[:, None] != block[None, :]
        left, right = np.nonzero(close)
        # a pair belongs to the first band it has in common
        if len(left):
            earlier = (bands[left, :band] == bands[right, :band]).any(axis=1) if band else np.zeros(len(left), bool)
            left, right = left[~earlier], right[~earlier]
        degree = np.bincount(left, minlength=len(rows)) + np.bincount(right, minlength=len(rows))
        for i in np.flatnonzero(degree):
            yield rows[i]["text_key"], None, int(degree[i])
        for a, b in _forest(len(rows), left, right):
            yield rows[a]["text_key"], rows[b]["text_key"], 0

    def flush(group: tuple, rows: list[dict]) -> list[tuple]:
        return list(links(group[0], group[2], group[3], rows)) if len(rows) > 1 else []

    def packed(found: list[tuple]) -> pa.RecordBatch:
        a, b, n = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], names=["a", "b", "n_links"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, found = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["band"], row["bucket"], row["low"], row["high"])
                if key != group:
                    found += flush(group, rows) if rows else []
                    group, rows = key, []
                    if len(found) > 10_000:
                        yield packed(found)
                        found = []
                rows.append(row)
        found += flush(group, rows) if rows else []
        yield packed(found)

    return run


#: A text as a key; null counts as empty.
TEXT_KEY = "unhex(md5(CAST(coalesce(text, '') AS BINARY)))"


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    n: int = SHINGLE_WORDS,
    rows: int = ROWS,
    recall: float = TARGET_RECALL,
) -> DataFrame:
    """Each row's class among near-duplicate texts: doc_id, class_id, text_id, n_copies, n_links.

    `text_id` is the smallest id among exact copies and `n_copies` their number; `n_links` counts the other texts
    whose sets of n-word shingles have a Jaccard similarity of the threshold or more; `class_id` is the smallest id
    that links lead to. Only one of the exact copies is compared.

    Texts that share a band meet in its bucket. Buckets with the same members are kept once, large ones are cut into
    blocks by hash, and each pair of blocks is verified on full shingle sets as one group of bounded size, which
    returns degrees and a spanning forest rather than pairs. A pair counts in the first band it shares, so no pair is
    counted twice. Links are exact; a pair at the threshold is found with the recall asked for, closer ones more often.

    Null texts count as empty. Texts without words are only copies of each other if they are equal; texts of fewer
    than n words are one shingle. A null id is a document like others; other columns are ignored.
    """
    signed, by_text = _texts(docs, threshold, n, rows, recall)
    return (
        signed.select("doc_id", "text_key")
        .join(by_text, "text_key")
        .select("doc_id", "class_id", "text_id", "n_copies", "n_links")
    )


def _texts(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    n: int = SHINGLE_WORDS,
    rows: int = ROWS,
    recall: float = TARGET_RECALL,
) -> tuple[DataFrame, DataFrame]:
    """Each row's text key, and of each text: text_key, text_id, n_copies, n_links, class_id, root.

    `root` is one text key of the class; it is null for a text that has no links.
    """
    bands = bands_for(threshold, rows, recall)
    keyed = docs.selectExpr("doc_id", "coalesce(text, '') AS text").selectExpr(
        "doc_id", "text", f"{TEXT_KEY} AS text_key"
    )
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    signed = materialise(
        keyed.mapInArrow(
            _signatures(n, bands, rows), f"doc_id {id_type}, text_key binary, n_shingles bigint, bands binary"
        ),
        "signatures",
    )
    texts = materialise(
        signed.groupBy("text_key").agg(
            F.min("doc_id").alias("text_id"),
            F.count("*").alias("n_copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        ),
        "texts",
    )
    exploded = texts.where("n_shingles > 0").selectExpr(
        "text_key",
        "n_shingles",
        f"posexplode(transform(sequence(1, {8 * bands}, 8), i -> substring(bands, i, 8))) AS (band, bucket)",
    )
    buckets = (
        exploded.groupBy("band", "bucket")
        .agg(
            F.count("*").alias("n_texts"),
            F.sum("n_shingles").alias("n_shingles"),
            F.expr("bit_xor(xxhash64(text_key))").alias("mark"),
            F.expr("bit_xor(xxhash64(1, text_key))").alias("mark2"),
        )
        .where("n_texts > 1")
        .groupBy("n_texts", "n_shingles", "mark", "mark2")
        .agg(F.expr("min(struct(band, bucket)) AS first"))
        .selectExpr(
            "first.band AS band",
            "first.bucket AS bucket",
            f"CAST(greatest(ceil(n_texts / {BLOCK_TEXTS}), ceil(n_shingles / {BLOCK_SHINGLES})) AS INT) AS n_blocks",
        )
    )
    members = materialise(
        exploded.join(buckets, ["band", "bucket"]).select("band", "bucket", "text_key", "n_blocks"), "members"
    )
    wanted = members.select("text_key").distinct().join(texts.select("text_key", "text_id", "bands"), "text_key")
    sources = keyed.join(
        wanted.selectExpr("text_key AS k", "text_id"),
        (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("text_id")),
        "left_semi",
    ).select("text_key", "text")
    sets = (
        sources.mapInArrow(_shingle_sets(n), "text_key binary, shingles binary")
        .groupBy("text_key")
        .agg(F.first("shingles").alias("shingles"))
        .join(wanted.select("text_key", "bands"), "text_key")
    )
    work = (
        members.selectExpr("*", "CAST(pmod(xxhash64(text_key), n_blocks) AS INT) AS block")
        .selectExpr("*", "explode(sequence(0, n_blocks - 1)) AS other")
        .selectExpr("band", "bucket", "text_key", "block", "least(block, other) AS low", "greatest(block, other) AS high")
    )
    groups = ["band", "bucket", "low", "high"]
    verified = materialise(
        work.join(sets, "text_key")
        .repartition(*groups)
        .sortWithinPartitions(*groups)
        .mapInArrow(_verify(threshold), "a binary, b binary, n_links bigint"),
        "links",
    )
    degrees = verified.where("b IS NULL").groupBy("a").agg(F.sum("n_links").alias("n_links"))
    linked = components(verified.where("b IS NOT NULL").select("a", "b"))
    roots = linked.join(texts.select("text_key", "text_id"), linked.node == F.col("text_key"))
    classes = roots.groupBy("root").agg(F.min("text_id").alias("class_id"))
    by_text = (
        texts.select("text_key", "text_id", "n_copies")
        .join(degrees.withColumnRenamed("a", "text_key"), "text_key", "left")
        .join(linked.withColumnRenamed("node", "text_key"), "text_key", "left")
        .join(classes, "root", "left")
        .selectExpr(
            "text_key", "text_id", "n_copies", "coalesce(n_links, 0L) AS n_links",
            "CASE WHEN root IS NULL THEN text_id ELSE class_id END AS class_id", "root",
        )
    )
    return signed, by_text


def one_of_each_class(docs: DataFrame, **settings) -> DataFrame:
    """`docs` with one row of each class: of its smallest id, or without one if none of its rows has an id.

    Of several texts with that id, one stays. Repeated rows with that id and text are one document.
    """
    winner, winner_key, own_key = unused(docs, "winner", "winner_key", "own_key")
    _, texts = _texts(docs, **settings)
    winners = (
        texts.groupBy(F.expr("coalesce(root, text_key) AS class"))
        .agg(F.expr("min(struct(text_id IS NULL AS missing, text_id, text_key)) AS best"))
        .selectExpr(f"best.text_id AS {winner}", f"best.text_key AS {winner_key}")
    )
    keyed = docs.withColumn(own_key, F.expr(TEXT_KEY))
    kept = keyed.join(
        winners, (keyed[own_key] == winners[winner_key]) & keyed.doc_id.eqNullSafe(winners[winner]), "left_semi"
    )
    return kept.dropDuplicates(["doc_id", own_key]).drop(own_key)
