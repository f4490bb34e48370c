"""Language-model scoring: deleted interpolation of n-gram estimates, mixed by context frequency."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.arrays import ODD, hashes_of, mix, words_of
from coverlake.llm.text import materialise

#: Documents are dealt into chunks of about so many bytes of text; a chunk's n-grams are counted together.
CHUNK_BYTES = 8 << 20
FOLDS = 7
TEST_FOLD = 2
#: The training fold whose counts are held out to learn the mixture weights.
HELD_OUT_FOLD = 0
EM_ROUNDS = 40
#: Steps to a doubling in which held-out probabilities are counted for EM.
STEPS = 8
#: A document's end, which is also the context of its first word.
END = np.uint64(0x1D8E4E27C47D124F)


def _tokens(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and one end, and how many each text has."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    words, lengths = words_of(texts, lower=True)
    return np.insert(hashes_of(words), np.cumsum(lengths), END), lengths + 1


def _distinct(texts: pa.ChunkedArray) -> tuple:
    """Tokens and pairs of a chunk: (distinct, place of each occurrence) for both, and the texts' lengths."""
    tokens, lengths = _tokens(texts)
    contexts = np.concatenate([[END], tokens[:-1]]).astype(np.uint64)
    return (
        np.unique(tokens, return_inverse=True),
        np.unique(mix(contexts * ODD + tokens), return_inverse=True),
        lengths,
    )


def _cells(distinct: np.ndarray, n_cells: int) -> np.ndarray:
    """Where each cell of the hash range begins in the sorted hashes, and the end."""
    cell = ((distinct >> np.uint64(32)) * np.uint64(n_cells)) >> np.uint64(32)
    return np.searchsorted(cell, np.arange(n_cells + 1))


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs."""
    raw = values.astype(np.uint64)
    width = max(1, (int(raw.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(raw.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    body = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, width)
    wide = np.zeros((len(body), 8), np.uint8)
    wide[:, :width] = body
    return wide.view(np.uint64).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending hashes: the first as it is, then the steps."""
    return int(values[0]).to_bytes(8, "little") + pack(np.diff(values))


def unpack_sorted(packed: bytes) -> np.ndarray:
    first = np.frombuffer(packed, np.uint64, count=1)  # as it is: a Python integer would turn the hashes into floats
    return np.cumsum(np.concatenate([first, unpack(packed[8:])]), dtype=np.uint64)


def _ask(n_cells: int):
    """Of a chunk: its distinct tokens and pairs, with how often its training documents have each, cell by cell."""

    def run(key, docs):
        one, two, lengths = _distinct(docs.column("text"))
        learned = np.repeat(docs.column("fold").to_numpy() != TEST_FOLD, lengths)
        rows = []
        for kind, (distinct, place) in enumerate((one, two)):
            counts = np.bincount(place, weights=learned, minlength=len(distinct)).astype(np.uint64)
            edges = _cells(distinct, n_cells)
            for cell in np.flatnonzero(np.diff(edges)):
                low, high = edges[cell], edges[cell + 1]
                rows.append((kind * n_cells + int(cell), pack_sorted(distinct[low:high]), pack(counts[low:high])))
        cell, hashes, counts = zip(*rows) if rows else ((), (), ())
        return pa.table(
            {
                "cell": pa.array(cell, pa.int32()),
                "chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "hashes": pa.array(hashes, pa.binary()),
                "counts": pa.array(counts, pa.binary()),
            }
        )

    return run


def _answer(n_cells: int, first_held_out: int):
    """Of a cell: for every chunk, the corpus counts of what it asked for, in its order; and the cell's totals."""

    def run(asked):
        chunks = asked.column("chunk").to_numpy()
        hashes = [unpack_sorted(x) for x in asked.column("hashes").to_pylist()]
        counts = [unpack(x) for x in asked.column("counts").to_pylist()]
        cell = asked.column("cell")[0].as_py()
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        held = np.repeat(chunks >= first_held_out, [len(h) for h in hashes])
        n = np.concatenate(counts).astype(np.float64)
        total = np.bincount(place, weights=n, minlength=len(distinct)).astype(np.uint64)
        rest = total - np.bincount(place, weights=n * held, minlength=len(distinct)).astype(np.uint64)
        ends = np.cumsum([len(h) for h in hashes])
        out_total, out_rest = [], []
        for chunk, h, end in zip(chunks, hashes, ends):
            own = place[end - len(h) : end]
            out_total.append(pack(total[own]))
            out_rest.append(pack(rest[own]) if chunk >= first_held_out else None)
        words = cell < n_cells
        sums = [int(total.sum()), int((total > 0).sum()), int(rest.sum()), int((rest > 0).sum())] if words else [0] * 4
        rows = len(chunks) + 1
        return pa.table(
            {
                "cell": pa.array([cell] * rows, pa.int32()),
                "chunk": pa.array([*chunks.tolist(), -1], pa.int32()),
                "total": pa.array([*out_total, None], pa.binary()),
                "rest": pa.array([*out_rest, None], pa.binary()),
                **{
                    name: pa.array([0] * (rows - 1) + [value], pa.int64())
                    for name, value in zip(("n_total", "v_total", "n_rest", "v_rest"), sums)
                },
            }
        )

    return run


def _counts(docs: pa.Table, answers: pa.Table, n_cells: int, column: str) -> tuple:
    """Corpus counts of each token, of its context and of both, in text order."""
    one, two, lengths = _distinct(docs.column("text"))
    cells = answers.column("cell").to_numpy()
    order = np.argsort(cells, kind="stable")
    packed = answers.column(column).to_pylist()
    split = int((cells < n_cells).sum())
    ones = np.concatenate([unpack(packed[i]) for i in order[:split]])
    twos = np.concatenate([unpack(packed[i]) for i in order[split:]])
    end_place = np.searchsorted(one[0], END)
    context_place = np.concatenate([[end_place], one[1][:-1]])
    return ones[one[1]].astype(float), ones[context_place].astype(float), twos[two[1]].astype(float), lengths


def bucket_of(context_count: np.ndarray) -> np.ndarray:
    """Buckets by context frequency: 0 for unseen ones, then one for each doubling."""
    return np.frexp(context_count)[1]


def _held_out_events(n_cells: int, n_rest: int, v_rest: int):
    """Of a held-out chunk: its tokens counted by bucket and by how far both estimates stand above the uniform one."""

    def run(docs, answers):
        if not docs.num_rows:
            cells = counts = np.empty((0, 3), np.int64)[:, 0]
            steps = (cells, cells)
        else:
            single, context, pair, _ = _counts(docs, answers, n_cells, "rest")
            steps = []
            for p in (pair / np.maximum(context, 1), single / max(n_rest, 1)):
                with np.errstate(divide="ignore"):
                    steps.append(np.where(p > 0, np.rint(STEPS * np.log2(p * (v_rest + 1))), -9999).astype(np.int64))
            keyed = np.stack([bucket_of(context), *steps])
            (cells, *steps), counts = np.unique(keyed, axis=1, return_counts=True)
        return pa.table(
            {
                "bucket": pa.array(cells, pa.int32()),
                "step2": pa.array(steps[0], pa.int32()),
                "step1": pa.array(steps[1], pa.int32()),
                "n": pa.array(counts, pa.int64()),
            }
        )

    return run


def learn_weights(events: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Mixture weights (pair, word, uniform) of each bucket by expectation-maximisation.

    `events` has rows bucket, step of the pair estimate, step of the word estimate, count. Each weight starts with one
    imagined event, so none gets zero; a bucket without events takes the weights of all events together.
    """
    weights = np.full((65, 3), 1 / 3)
    if not len(events):
        weights[:] = (0.0, 0.5, 0.5)
        return weights
    bucket, n = events[:, 0].astype(int), events[:, 3].astype(float)
    odds = [np.where(events[:, k] > -9999, 2.0 ** (events[:, k] / STEPS), 0.0) for k in (1, 2)]
    p = np.stack([*odds, np.ones(len(events))], axis=1)
    shared = np.full(3, 1 / 3)
    for _ in range(rounds):
        part = shared * p
        gained = (part / part.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) + 1
        shared = gained / gained.sum()
        part = weights[bucket] * p
        part = part / part.sum(axis=1, keepdims=True) * n[:, None]
        gained = np.ones_like(weights)
        np.add.at(gained, bucket, part)
        weights = gained / gained.sum(axis=1, keepdims=True)
    weights[np.setdiff1d(np.arange(65), bucket)] = shared
    weights[0] = np.array([0.0, *weights[0][1:]]) / weights[0][1:].sum()
    return weights


def _score(n_cells: int, n_total: int, v_total: int, weights: np.ndarray):
    def run(docs, answers):
        single, context, pair, lengths = _counts(docs, answers, n_cells, "total")
        mixed = weights[bucket_of(context)]
        p = (
            mixed[:, 0] * pair / np.maximum(context, 1)
            + mixed[:, 1] * single / max(n_total, 1)
            + mixed[:, 2] / (v_total + 1)
        )
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        base = np.log10((single + 1) / (n_total + v_total + 1))
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "fold": docs.column("fold"),
                "n_tokens": pa.array(lengths, pa.int64()),
                "n_known": pa.array(np.add.reduceat((single > 0).astype(np.int64), starts), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, starts), pa.float64()),
                "score": pa.array(np.add.reduceat(np.log10(p), starts), pa.float64()),
            }
        )

    return run


def score_texts(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each text's log10 probability: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words with A-Z lower-cased, then one end. p(word | previous) mixes the pair's and the word's
    relative frequency and a uniform share; the weights depend on how often the previous word was seen and are learned
    on counts held out from training (fold HELD_OUT_FOLD against the other training folds). Documents of fold
    TEST_FOLD (crc32 of the id as text, modulo FOLDS) train nothing. `base_score` is the add-one unigram score.

    Nothing of the corpus is broadcast: documents are dealt into chunks by hash; a chunk asks for its distinct n-grams,
    packed by ranges of their hashes; each range adds up all chunks and answers every chunk in its own order. Only the
    vocabulary's totals and a table of bucketed held-out events, bounded by its bins, reach the driver.

    A null text is empty and has its end as only token; a null id counts as the empty text. Repeated rows are
    documents of their own; other columns are ignored. N-grams are told apart by 64-bit hashes.
    """
    folded = docs.selectExpr(
        "doc_id",
        "coalesce(text, '') AS text",
        f"CAST(crc32(CAST(coalesce(CAST(doc_id AS STRING), '') AS BINARY)) % {FOLDS} AS INT) AS fold",
    )
    id_type = folded.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.sum(F.expr("octet_length(text) + 64"))).first()[0] or 0
    n_chunks = -(-size // chunk_bytes) or 1
    n_held_out = -(-n_chunks // FOLDS)
    n_cells = 2 * n_chunks
    dealt = folded.selectExpr(
        "*",
        f"CAST(CASE WHEN fold = {HELD_OUT_FOLD} THEN {n_chunks} + pmod(xxhash64(doc_id, length(text)), {n_held_out})"
        f" ELSE pmod(xxhash64(doc_id, length(text)), {n_chunks}) END AS INT) AS chunk",
    )
    asked = dealt.groupBy("chunk").applyInArrow(
        _ask(n_cells), "cell int, chunk int, hashes binary, counts binary"
    )
    answers = materialise(
        asked.groupBy("cell").applyInArrow(
            _answer(n_cells, n_chunks),
            "cell int, chunk int, total binary, rest binary, n_total long, v_total long, n_rest long, v_rest long",
        ),
        "ngrams",
    )
    sums = answers.where("chunk = -1").agg(*(F.sum(c).alias(c) for c in ("n_total", "v_total", "n_rest", "v_rest"))).first()
    n_total, v_total, n_rest, v_rest = (x or 0 for x in sums)
    events = (
        dealt.where(F.col("fold") == HELD_OUT_FOLD)
        .groupBy("chunk")
        .cogroup(answers.where(F.col("chunk") >= n_chunks).select("chunk", "cell", "rest").groupBy("chunk"))
        .applyInArrow(
            _held_out_events(n_cells, n_rest, v_rest),
            "bucket int, step2 int, step1 int, n long",
        )
        .groupBy("bucket", "step2", "step1")
        .agg(F.sum("n").alias("n"))
        .orderBy("bucket", "step2", "step1")
    )
    weights = learn_weights(np.array([tuple(r) for r in events.collect()], dtype=float).reshape(-1, 4))
    scored = (
        dealt.groupBy("chunk")
        .cogroup(answers.where("chunk >= 0").select("chunk", "cell", "total").groupBy("chunk"))
        .applyInArrow(
            _score(n_cells, n_total, v_total, weights),
            f"doc_id {id_type}, fold int, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.selectExpr(
        "doc_id", f"fold = {TEST_FOLD} AS held_out", "n_tokens", "n_known", f"{n_total}L AS train_tokens",
        "base_score", "score",
    )
