"""SimHash near-dedup: a pivot distance table finds the fingerprints within a few bits of each other."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.graph import components
from coverlake.llm.text import materialise

SHINGLE_WORDS = 3
SEED = 42
#: Bits in which linked fingerprints may differ.
RADIUS = 3
#: Reference fingerprints whose distances make up the table.
PIVOTS = 16
PIVOT_SEED = 11
#: Shingles hashed and counted at a time.
PIECE = 1 << 16
#: A cell is compared in parts of about so many fingerprints; every pair of parts is one group of work.
PART = 1024
#: Cells with more than one part up to this many are looked up by broadcast, at 16 bytes each; more are joined by shuffle.
BROADCAST_CELLS = 1_000_000


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """64 bits, each 1 if set in over half of the hashes of the text's n-word shingles, repeats included."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z, and the separators space and 9 to 13
    if not words:
        return 0
    if len(words) < n:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    count = len(words) - n + 1
    ones = np.zeros(64, np.int64)
    for low in range(0, count, PIECE):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), SEED) for i in range(low, min(low + PIECE, count))),
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), n) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"]
            )

    return run


def block_masks(blocks: int) -> list[int]:
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [((1 << (high - low)) - 1) << low for low, high in zip(edges, edges[1:])]


def pivots(count: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(PIVOT_SEED).integers(0, 1 << 64, size=count, dtype=np.uint64)


def pivot_table(prints: np.ndarray, blocks: int, count: int = PIVOTS) -> np.ndarray:
    """Distances of fingerprints to the pivots, block by block: [fingerprint, block, pivot]."""
    apart = prints[:, None] ^ pivots(count)[None, :]
    return np.stack([np.bitwise_count(apart & np.uint64(m)) for m in block_masks(blocks)], axis=1)


def _table(radius: int):
    """Of each fingerprint: its distances to the pivots, and the cells in which it can meet others.

    The bits are cut into radius + 2 blocks, of which a linked pair differs in at most `radius`; in the other two all
    block distances agree. A cell is the block distances of one choice of two blocks.
    """
    chosen = list(combinations(range(radius + 2), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fingerprint").to_numpy().view(np.uint64)
            table = pivot_table(prints, radius + 2)
            distances = table.sum(axis=1, dtype=np.uint8)
            cells = [
                [xxhash.xxh64_intdigest(row, k) for k, row in enumerate(rows)]
                for rows in zip(*(map(bytes, table[:, list(c)].reshape(len(prints), -1)) for c in chosen))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("fingerprint"),
                    pa.array([d.tobytes() for d in distances], pa.binary()),
                    pa.array(np.array(cells, np.uint64).reshape(len(prints), -1).view(np.int64).tolist(), pa.list_(pa.int64())),
                ],
                names=["fingerprint", "distances", "cells"],
            )

    return run


def close_pairs(prints: np.ndarray, distances: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs are within the radius: the largest coordinate difference discards, the bits decide.

    By the triangle inequality no distance to a pivot differs by more than the pair's own distance.
    """
    kept = np.arange(len(left))
    for pivot in range(distances.shape[1]):
        a, b = distances[left[kept], pivot].astype(np.int16), distances[right[kept], pivot].astype(np.int16)
        kept = kept[np.abs(a - b) <= radius]
        if not len(kept):
            return kept
    return kept[np.bitwise_count(prints[left[kept]] ^ prints[right[kept]]) <= radius]


def star_of(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member that links lead to, of each of n members."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, before[left], low)
        np.minimum.at(root, before[right], low)
        root = root[root]
        if (root == before).all():
            return root


def _links(radius: int):
    """Links of each group of work, as stars that join the same fingerprints."""

    def pairs(part: np.ndarray, start: np.ndarray, size: np.ndarray, own: np.ndarray) -> Iterator[tuple]:
        """Pairs (left, right) of the rows of each group, some ten thousands at a time.

        `own` marks groups of one part; in others only rows of different parts meet.
        """
        for n in np.unique(size[(size > 1) & (size <= 32)]):
            i, j = np.triu_indices(n, 1)
            groups = np.flatnonzero(size == n)
            for low in range(0, len(groups), 4096):
                some = groups[low : low + 4096]
                left = (start[some][:, None] + i[None, :]).ravel()
                right = (start[some][:, None] + j[None, :]).ravel()
                apart = np.repeat(own[some], len(i)) | (part[left] != part[right])
                yield left[apart], right[apart]
        for g in np.flatnonzero(size > 32):
            rows = np.arange(start[g], start[g] + size[g])
            for k in range(0, len(rows), 64):
                left, right = np.meshgrid(rows[k : k + 64], rows[k + 1 :], indexing="ij")
                left, right = left.ravel(), right.ravel()
                apart = (left < right) & (own[g] | (part[left] != part[right]))
                yield left[apart], right[apart]

    def linked(columns: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        _, low, high, part, prints, distances = columns
        members, place = np.unique(prints, return_inverse=True)
        found = [np.empty((2, 0), np.int64)]
        for left, right in pairs(part, starts, ends - starts, low[starts] == high[starts]):
            close = close_pairs(prints, distances, left, right, radius)
            if len(close):
                found.append(np.unique(np.stack([place[left[close]], place[right[close]]]), axis=1))
        left, right = np.concatenate(found, axis=1)
        root = star_of(len(members), left, right)
        others = np.flatnonzero(root != np.arange(len(members)))
        return pa.RecordBatch.from_arrays(
            [pa.array(members[others].view(np.int64)), pa.array(members[root[others]].view(np.int64))], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy() for c in ("cell", "low", "high", "part")]
            now.append(batch.column("fingerprint").to_numpy().view(np.uint64))
            now.append(np.frombuffer(b"".join(batch.column("distances").to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            held = now if held is None else [np.concatenate(pair) for pair in zip(held, now)]
            cell, low, high = held[:3]
            new = np.flatnonzero((cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            if len(new):  # the last group may go on in the next batch
                done = [c[: new[-1]] for c in held]
                yield linked(done, np.concatenate([[0], new[:-1]]), new)
                held = [c[new[-1] :] for c in held]
        if held is not None:
            yield linked(held, np.array([0]), np.array([len(held[0])]))

    return run


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """Links (a, b) that join all fingerprints within the radius of each other; `prints` has distinct fingerprints.

    Every fingerprint stands in ten cells (for a radius of 3) of the pivot table. Cells are told apart by 64-bit hashes
    of their block distances; those that meet by chance are verified like others. A cell of more than `part`
    fingerprints is cut into parts by hash, and each pair of parts is a group of work of its own, so a large group of
    near copies is spread over tasks; of its links, a group returns no more than join its members.
    """
    table = materialise(
        prints.select("fingerprint").mapInArrow(
            _table(radius), "fingerprint bigint, distances binary, cells array<bigint>"
        ),
        "pivots",
    )
    members = table.selectExpr("explode(cells) AS cell", "fingerprint", "distances")
    crowded = materialise(
        table.selectExpr("explode(cells) AS cell").groupBy("cell").agg(F.count("*").alias("n")).where(f"n > {part}")
        .selectExpr("cell AS crowded", f"CAST(ceil(n / {part}) AS INT) AS n_parts"),
        "crowded",
    )
    if crowded.count() <= BROADCAST_CELLS:
        crowded = F.broadcast(crowded)
    groups = ["cell", "low", "high"]
    work = (
        members.join(crowded, members.cell == crowded.crowded, "left")
        .selectExpr("cell", "fingerprint", "distances", "coalesce(n_parts, 1) AS n_parts")
        .selectExpr("*", "CAST(pmod(xxhash64(fingerprint), n_parts) AS INT) AS part")
        .selectExpr("*", "explode(sequence(0, n_parts - 1)) AS other")
        .selectExpr(
            "cell", "least(part, other) AS low", "greatest(part, other) AS high", "part", "fingerprint", "distances"
        )
    )
    return (
        work.repartition(*groups)
        .sortWithinPartitions(*groups)
        .mapInArrow(_links(radius), "a bigint, b bigint")
        .distinct()
    )


def simhash_components(docs: DataFrame, radius: int = RADIUS, n: int = SHINGLE_WORDS) -> DataFrame:
    """Each row's fingerprint and group: doc_id, fingerprint (16 hex digits), component_id.

    A-Z are lower-cased; the words' n-word shingles, repeats included, are joined by spaces and hashed by XXH64 with
    seed 42. A text of fewer words is one shingle; one without words, also a null or empty one, has fingerprint zero,
    which is linked like any other. Fingerprints that differ in at most `radius` bits are linked; `component_id` is the
    smallest doc_id that links lead to, null only if no row of the component has an id. Each different fingerprint is
    compared once, so copies of a text cost nothing but their fingerprint. Repeated rows and null ids are documents like
    others; other columns are ignored; an empty table gives no rows.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    printed = materialise(
        docs.select("doc_id", "text").mapInArrow(_fingerprints(n), f"doc_id {id_type}, fingerprint bigint"), "prints"
    )
    prints = materialise(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(fingerprint_links(prints, radius))
    rooted = prints.join(roots, prints.fingerprint == roots.node, "left").selectExpr(
        "fingerprint", "first", "coalesce(root, fingerprint) AS root"
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialise(rooted.join(least, "root").select("fingerprint", "component_id"), "classes")
    return printed.join(classes, "fingerprint").selectExpr(
        "doc_id", "lower(lpad(hex(fingerprint), 16, '0')) AS fingerprint", "component_id"
    )
