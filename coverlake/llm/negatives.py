"""Hard-negative mining: segment summaries bound inner products, refined level by level before exact scoring."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverlake.llm.text import materialise

SCALE = 256
ANCHOR_EVERY = 50
RELABEL_EVERY = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
#: A negative's score is from LOW_PERCENT to HIGH_PERCENT of its positive's.
LOW_PERCENT, HIGH_PERCENT = 50, 95
#: Segments a vector is cut into, from one level of the bounds to the next.
LEVELS = (1, 4, 16)
#: Anchors that are compared with all vectors by the same tasks, and the tasks that share the vectors out.
ANCHOR_BLOCK = 1024
SLICES = 8

VECTOR = "row bigint, vec_id bigint, label bigint, v array<bigint>, means array<double>, deviations array<double>"
FOUND = "anchor bigint, place int, found bigint, vec_id bigint, score bigint"


def segment_edges(size: int, segments: int) -> np.ndarray:
    return np.unique(np.linspace(0, size, segments + 1).astype(int))


def summary(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every segment of every level, the levels one after the other."""
    means, deviations = [], []
    for segments in LEVELS:
        edges = segment_edges(vectors.shape[1], segments)
        length = np.diff(edges)
        mean = np.add.reduceat(vectors, edges[:-1], axis=1) / length
        apart = vectors - np.repeat(mean, length, axis=1)
        means.append(mean)
        deviations.append(np.sqrt(np.add.reduceat(apart * apart, edges[:-1], axis=1) / length))
    return np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summaries(size: int):
    """Vectors as whole numbers, filled up with zeros to the longest one's length, with their summaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("embedding")
            lengths = np.diff(raw.offsets.to_numpy())
            row = np.repeat(np.arange(len(lengths)), lengths)
            at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            whole = np.zeros((len(lengths), size), np.int64)
            whole[row, at] = np.floor(SCALE * raw.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
            means, deviations = summary(whole.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "vec_id", "label")),
                    _lists(whole, pa.int64()), _lists(means, pa.float64()), _lists(deviations, pa.float64()),
                ],
                names=["row", "vec_id", "label", "v", "means", "deviations"],
            )

    return run


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: row (a number of its own), vec_id, label, v, means and deviations.

    Rows with a null label, a null vector, or a null or non-finite component take no part; an empty vector scores 0. Where
    vec_id is divisible by 7 the label is replaced by the next one. Components become floor(256 x).
    """
    rows = embeddings.where(
        "label IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x)"
        " AND abs(CAST(x AS DOUBLE)) < double('Infinity'))"
    ).selectExpr(
        "CAST(vec_id AS BIGINT) AS vec_id",
        f"CAST(CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (CAST(label AS BIGINT) + 1) % {LABELS} ELSE label END AS BIGINT) AS label",
        "CAST(embedding AS ARRAY<DOUBLE>) AS embedding",
    )
    numbered = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "embeddings")
    size, largest = numbered.agg(
        F.max(F.size("embedding")), F.expr(f"max({SCALE} * array_max(transform(embedding, x -> abs(x))))")
    ).first()
    size, largest = max(size or 1, 1), (largest or 0.0) + 1
    if size * largest * largest * 100 >= 2.0**63:
        raise ValueError(f"components of {largest / SCALE:.3g} give inner products beyond 64 bits")
    return materialise(numbered.mapInArrow(_summaries(size), VECTOR), "vectors")


def bounds(anchor: tuple, means: np.ndarray, deviations: np.ndarray, level: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product with the anchor that the summaries of one level allow.

    Of a segment, the products of the parts off the means sum to no more than its length times both deviations.
    """
    edges = [len(segment_edges(size, n)) - 1 for n in LEVELS]
    span = slice(sum(edges[:level]), sum(edges[: level + 1]))
    length = np.diff(segment_edges(size, LEVELS[level]))
    middle = means[:, span] @ (anchor[0][span] * length)
    reach = deviations[:, span] @ (anchor[1][span] * length)
    slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
    return middle - reach - slack, middle + reach + slack


class Best:
    """The best rows seen so far: highest score first, then smallest id, null ids last."""

    def __init__(self, size: int):
        self.size = size
        self.columns = [np.empty(0, np.int64) for _ in range(4)]  # score, id, whether it is null, row

    @property
    def least(self) -> int | None:
        """The score a row needs to get in, if there are enough already."""
        return int(self.columns[0][-1]) if len(self.columns[0]) == self.size else None

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray, rows: np.ndarray) -> None:
        if self.least is not None:
            keep = score >= self.least
            score, ids, null, rows = score[keep], ids[keep], null[keep], rows[keep]
        if len(score):
            merged = [np.concatenate(pair) for pair in zip(self.columns, (score, ids, null.astype(np.int64), rows))]
            order = np.lexsort((merged[3], merged[1], merged[2], -merged[0]))[: self.size]
            self.columns = [c[order] for c in merged]


class _Anchors:
    """A block of anchors and what has been found for each."""

    def __init__(self, batch: pa.RecordBatch):
        self.rows, self.labels = batch.column("row").to_numpy(), batch.column("label").to_numpy()
        self.v, self.means, self.deviations = (_matrix(batch.column(c)) for c in ("v", "means", "deviations"))
        self.positive_scores = [x or [] for x in batch.column("scores").to_pylist()]

    def more(self, batch: pa.RecordBatch) -> None:
        other = _Anchors(batch)
        for name in ("rows", "labels", "v", "means", "deviations"):
            setattr(self, name, np.concatenate([getattr(self, name), getattr(other, name)]))
        self.positive_scores += other.positive_scores


def _positives(anchors: _Anchors, best: dict, rows, ids, null, labels, v, means, deviations) -> None:
    size = v.shape[1]
    for i in range(len(anchors.rows)):
        own = best.setdefault((i, 0), Best(POSITIVES))
        some = np.flatnonzero((labels == anchors.labels[i]) & (rows != anchors.rows[i]))
        for level in range(len(LEVELS)):
            if own.least is None or not len(some):
                break
            _, high = bounds((anchors.means[i], anchors.deviations[i]), means[some], deviations[some], level, size)
            some = some[high >= own.least]
        own.add(v[some] @ anchors.v[i], ids[some], null[some], rows[some])


def _negatives(anchors: _Anchors, best: dict, rows, ids, null, labels, v, means, deviations) -> None:
    size = v.shape[1]
    for i, scores in enumerate(anchors.positive_scores):
        # whole scores of the admitted interval of each positive; that of a negative score is empty
        intervals = [(k, -(-LOW_PERCENT * s // 100), HIGH_PERCENT * s // 100) for k, s in enumerate(scores)]
        intervals = [(best.setdefault((i, k), Best(NEGATIVES)), low, high) for k, low, high in intervals if low <= high]
        if not intervals:
            continue
        some = np.flatnonzero(labels != anchors.labels[i])
        for level in range(len(LEVELS)):
            low, high = bounds((anchors.means[i], anchors.deviations[i]), means[some], deviations[some], level, size)
            useful = np.zeros(len(some), bool)
            for own, least, most in intervals:
                useful |= (low <= most) & (high >= (least if own.least is None else max(least, own.least)))
            some = some[useful]
        score = v[some] @ anchors.v[i]
        for own, least, most in intervals:
            fits = (score >= least) & (score <= most)
            own.add(score[fits], ids[some[fits]], null[some[fits]], rows[some[fits]])


def _search(compare):
    """Each group's anchors come first, then its vectors, batch by batch; what was found goes out at the group's end."""

    def results(anchors: _Anchors | None, best: dict) -> pa.RecordBatch:
        found = []
        for (i, k), own in best.items():
            for score, vec_id, null, row in zip(*(c.tolist() for c in own.columns)):
                found.append((int(anchors.rows[i]), k, row, None if null else vec_id, score))
        columns = list(zip(*found)) if found else [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "place", "found", "vec_id", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, anchors, best = None, None, {}
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "slice", "kind")])
            edges = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if low == high:
                    continue
                part, own = batch.slice(low, high - low), tuple(keys[:2, low])
                if own != group:
                    yield results(anchors, best)
                    group, anchors, best = own, None, {}
                if keys[2, low] == 0 and anchors is not None:
                    anchors.more(part)
                elif keys[2, low] == 0:
                    anchors = _Anchors(part)
                elif anchors is not None:
                    ids = part.column("vec_id")
                    null = ids.is_null().to_numpy(zero_copy_only=False)
                    compare(
                        anchors, best, part.column("row").to_numpy(), ids.fill_null(0).to_numpy(), null,
                        part.column("label").to_numpy(), *(_matrix(part.column(c)) for c in ("v", "means", "deviations")),
                    )
        yield results(anchors, best)

    return run


def _compared(anchors: DataFrame, vectors: DataFrame, n_blocks: int, compare) -> DataFrame:
    """All vectors against all anchors, in blocks of anchors; each slice of the vectors keeps its own best ones.

    `anchors` has the columns of a vector and `scores`. A vector is sent once for every block of anchors.
    """
    wanted = anchors.selectExpr(
        f"CAST(pmod(xxhash64(row), {n_blocks}) AS INT) AS block", f"explode(sequence(0, {SLICES - 1})) AS slice", "0 AS kind",
        "row", "vec_id", "label", "v", "means", "deviations", "scores",
    )
    offered = vectors.selectExpr(
        f"explode(sequence(0, {n_blocks - 1})) AS block", f"CAST(pmod(xxhash64(row), {SLICES}) AS INT) AS slice", "1 AS kind",
        "row", "vec_id", "label", "v", "means", "deviations", "CAST(NULL AS ARRAY<BIGINT>) AS scores",
    )
    return (
        wanted.unionByName(offered)
        .repartition("block", "slice")
        .sortWithinPartitions("block", "slice", "kind")
        .mapInArrow(_search(compare), FOUND)
    )


def _first(found: DataFrame, group: list[str], size: int) -> DataFrame:
    """The best rows of each group over all slices, numbered from 1."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {size}")


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor's positives.

    Anchors are the rows whose vec_id is divisible by 50. A score is the inner product of whole-numbered vectors; higher
    ones come first, ties by smaller vec_id, null ids last. Positives are the first 5 other rows with the anchor's label;
    a positive's negatives are the first 3 rows of other labels with half to 95 hundredths of its score. All anchors meet
    all vectors, in blocks. A vector's segment means and deviations bound its score: one that cannot be among the
    best, or not within the admitted scores, is dropped level by level; the rest is scored exactly, so nothing is lost.

    A row without an id is no anchor but may be found; repeated rows are rows of their own, as anchors too. Vectors of
    other lengths count as filled up with zeros. Other columns are ignored; an empty table gives no rows. Components so
    large that scores might pass 64 bits (beyond about 140,000 for 64 of them) are refused before anything is compared.
    """
    vectors = usable_vectors(embeddings)
    anchors = materialise(vectors.where(f"vec_id % {ANCHOR_EVERY} = 0"), "anchors")
    n_blocks = -(-anchors.count() // ANCHOR_BLOCK) or 1
    unscored = anchors.withColumn("scores", F.lit(None).cast("array<bigint>"))
    positives = materialise(
        _first(_compared(unscored, vectors, n_blocks, _positives), ["anchor"], POSITIVES).selectExpr(
            "anchor", "rank - 1 AS place", "vec_id AS positive_id", "score AS positive_score"
        ),
        "positives",
    )
    scores = positives.groupBy("anchor").agg(
        F.expr("transform(sort_array(collect_list(struct(place, positive_score))), x -> x.positive_score) AS scores")
    )
    scored = anchors.join(scores, anchors.row == scores.anchor).drop("anchor")
    negatives = _first(_compared(scored, vectors, n_blocks, _negatives), ["anchor", "place"], NEGATIVES).selectExpr(
        "anchor", "place", "rank", "vec_id AS negative_id", "score AS negative_score"
    )
    return (
        negatives.join(positives, ["anchor", "place"])
        .join(anchors.selectExpr("row AS anchor", "vec_id AS anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
