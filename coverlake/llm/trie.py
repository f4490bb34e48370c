"""Conversation prefix trie: sorted turn-id matrices, change masks, one reduceat per depth, shards joined at their edges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.arrays import ODD, mix
from coverlake.llm.text import materialise, words_sql

GROUP = 20
SHARED_TURNS = 4
#: A matrix has at most about so many turns, padding included; a shard is worked off matrix by matrix.
MATRIX_TURNS = 500_000
#: So many neighbouring shards are joined by one task in a round.
FAN_IN = 128
#: Edge nodes up to this many are looked up by broadcast, at 48 bytes each; more are joined by shuffle.
BROADCAST_NODES = 500_000
PAD = -1
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
    " saved_tokens bigint, ends_sha256 string, key1 bigint, key2 bigint, parent1 bigint, parent2 bigint"
)
EDGE = (
    "shard bigint, is_last boolean, depth bigint, key1 bigint, key2 bigint, conv_id bigint, n_convs bigint, words bigint,"
    " n_children bigint, n_leaves bigint, saved_tokens bigint, shared boolean"
)
PIECE = "key1 bigint, key2 bigint, shard bigint, piece bigint, ids string"


def rebuilt_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (h1, h2, words) of every conversation with the first turns of its group's first one.

    The first h turns come from conversation c - c % 20 (the remainder has the sign of c), h = crc32(c) % 4; the
    conversation's own turns follow after its first h. A turn is known by 127 bits of hashes of role and text. Turns stand in the order of turn, role and text,
    nulls first; a repeated row is a turn of its own. Rows without conv_id belong to no conversation.
    """
    rows = conversations.where("conv_id IS NOT NULL").selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text"
    )
    placed = rows.selectExpr(
        "conv_id",
        "row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place",
        "shiftrightunsigned(xxhash64(role, text), 1) AS h1",
        "xxhash64(text, 1, role) AS h2",
        f"CAST(size({words_sql('text')}) AS BIGINT) AS words",
    )
    whole = materialise(
        placed.groupBy("conv_id").agg(
            F.expr("transform(sort_array(collect_list(struct(place, h1, h2, words))), t -> struct(t.h1, t.h2, t.words)) AS turns")
        ),
        "conversations",
    )
    first = whole.where(f"conv_id % {GROUP} = 0").selectExpr(
        "conv_id AS first_id", f"slice(turns, 1, {SHARED_TURNS - 1}) AS first_turns"
    )
    shared = f"CAST(crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % {SHARED_TURNS} AS INT)"
    return (
        whole.selectExpr("*", f"conv_id - conv_id % {GROUP} AS group_id", f"{shared} AS h")
        .join(first, F.col("group_id") == F.col("first_id"), "left")
        .selectExpr(
            "conv_id",
            "concat(slice(coalesce(first_turns, slice(turns, 1, 0)), 1, h),"
            " slice(turns, h + 1, greatest(0, size(turns) - h))) AS turns",
        )
    )


@dataclass
class Node:
    """A node on the edge of a shard: what is known of it without the nodes below that are edge nodes too."""

    key: tuple[int, int]
    conv_id: int
    n_convs: int
    words: int
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0

    def absorb(self, other: Node) -> None:
        self.conv_id = min(self.conv_id, other.conv_id)
        for name in ("n_convs", "n_children", "n_leaves", "saved"):
            setattr(self, name, getattr(self, name) + getattr(other, name))


@dataclass
class Edges:
    """The nodes that hold a range's first conversation and those that hold its last, by depth; common ones are one."""

    first: list[Node]
    last: list[Node]


def close(path: list[Node], keep: int, out: list[tuple], still: list[Node] | None = None) -> None:
    """Nodes of a path from depth `keep` on get no more members: each is added to its parent and put out.

    Nodes that also stand in `still` wait there; they lie above the others.
    """
    for depth in range(len(path) - 1, keep - 1, -1):
        node = path[depth]
        if still is not None and depth < len(still) and still[depth] is node:
            return
        leaves = node.n_leaves + (node.n_children == 0)
        saved = node.saved + (node.n_convs - 1) * node.words
        parent = path[depth - 1].key if depth else None
        if depth:
            path[depth - 1].n_children += 1
            path[depth - 1].n_leaves += leaves
            path[depth - 1].saved += saved
        out.append((node.conv_id, depth, node.n_convs, node.n_children, leaves, saved, node.key, parent))


def joined(left: Edges | None, right: Edges, out: list[tuple]) -> Edges:
    """The edges of two neighbouring ranges as one; nodes that end between them are put out."""
    if left is None:
        return right
    same = 0
    while same < min(len(left.last), len(right.first)) and left.last[same].key == right.first[same].key:
        same += 1
    close(left.last, same, out, left.first)
    # below the common nodes, the right range's first path ends on the left and, unless it is its last path, on the right
    close(right.first, same, out, right.last)
    last = list(right.last)
    for depth in range(same - 1, -1, -1):
        mine, other = left.last[depth], right.first[depth]
        mine.absorb(other)
        if depth < len(last) and last[depth] is other:
            last[depth] = mine
    for depth in range(same - 1, -1, -1):
        ended = not (depth < len(last) and last[depth] is left.last[depth])
        if not ended:
            break
        waiting = depth < len(left.first) and left.first[depth] is left.last[depth]
        if not waiting:
            close(left.last[: depth + 1], depth, out)
    return Edges(left.first, last)


def finished(edges: Edges, out: list[tuple]) -> None:
    close(edges.last, 0, out, edges.first)
    close(edges.first, 0, out)


def matrix_nodes(ids: np.ndarray, words: np.ndarray, lengths: np.ndarray, convs: np.ndarray) -> tuple[list, Edges, dict]:
    """Nodes of sorted conversations: columns of those inside, the edges, and the ends of edge nodes by key.

    `ids` has two numbers a turn, padded with PAD below zero, so that a shorter conversation sorts before its longer
    ones. A row starts a node at a depth if any column up to it differs from the row before.
    """
    n, depth = words.shape
    order = np.lexsort((convs, *(ids[:, d, k] for d in range(depth - 1, -1, -1) for k in (1, 0))))
    ids, words, lengths, convs = ids[order], words[order], lengths[order], convs[order]
    change = np.ones((n, depth), bool)
    np.logical_or.accumulate((ids[1:] != ids[:-1]).any(axis=2), axis=1, out=change[1:])
    # keys of all prefixes: two chains of mixed hashes
    keys = np.zeros((n, depth + 1, 2), np.uint64)
    for d in range(depth):
        for k in (0, 1):
            turn = mix(ids[:, d, k].view(np.uint64) + np.uint64(k))
            keys[:, d + 1, k] = mix(keys[:, d, k] * ODD + turn)
    keys = keys.view(np.int64)
    children, leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    ids_text = convs.astype(str)
    inside, levels, pieces = [], [], {}
    for d in range(depth, -1, -1):  # of depth d: the segments of rows that agree in d turns
        starts = np.flatnonzero(change[:, d - 1]) if d else np.zeros(1, np.int64)
        ends = np.append(starts[1:], n)
        real = lengths[starts] >= d
        starts, ends = starts[real], ends[real]
        if not len(starts):
            children[:], leaves[:], saved[:] = 0, 0, 0
            levels.append(None)
            continue
        # padded rows between the nodes hold nothing at this depth, so sums up to the next start are sums of the node
        count = ends - starts
        least = np.minimum.reduceat(np.where(lengths >= d, convs, np.iinfo(np.int64).max), starts)
        n_children, below, sums = (np.add.reduceat(x, starts) for x in (children, leaves, saved))
        edge = (starts == 0) | (ends == n)
        spoken = words[starts, d - 1] if d else np.zeros(1, np.int64)
        own_leaves = below + (n_children == 0)
        own_saved = sums + (count - 1) * spoken
        levels.append((starts, ends, least, count, spoken, n_children, below, sums))
        at_end = lengths == d
        for i in np.flatnonzero(edge):
            rows = np.flatnonzero(at_end[starts[i] : ends[i]]) + starts[i]
            if len(rows):
                pieces[tuple(keys[starts[i], d])] = ",".join(ids_text[rows])
        kept = np.flatnonzero(~edge)
        if len(kept):
            hashes = []
            last = np.add.reduceat(at_end.astype(np.int64), starts)[kept]
            for i, n_last in zip(kept, last):
                ended = ids_text[starts[i] : starts[i] + n_last]  # the shortest of a node come first
                hashes.append(hashlib.sha256(",".join(ended).encode()).hexdigest() if n_last else NO_ENDS)
            inside.append(
                [d, starts[kept], least[kept], count[kept], n_children[kept], own_leaves[kept], own_saved[kept], hashes, keys[starts[kept], d - 1]]
            )
        children[:], leaves[:], saved[:] = 0, 0, 0
        children[starts[kept]], leaves[starts[kept]], saved[starts[kept]] = 1, own_leaves[kept], own_saved[kept]
    levels.reverse()
    # the smallest member of each inside node's parent, or none where that is an edge node
    columns = []
    for d, starts, *rest in inside:
        p_starts, p_ends, p_least = levels[d - 1][:3]
        place = np.searchsorted(p_starts, starts, side="right") - 1
        open_ = (p_starts[place] == 0) | (p_ends[place] == n)
        columns.append((d, np.where(open_, 0, p_least[place]), open_, *rest))

    def path(row: int) -> list[Node]:
        found = []
        for d in range(int(lengths[row]) + 1):
            starts, _, least, count, spoken, n_children, below, sums = levels[d]
            i = int(np.searchsorted(starts, row, side="right")) - 1
            found.append(
                Node(tuple(keys[starts[i], d].tolist()), *(int(x[i]) for x in (least, count, spoken, n_children, below, sums)))
            )
        return found

    first, last = path(0), path(n - 1)
    for d in range(min(len(first), len(last))):
        if first[d].key != last[d].key:
            break
        last[d] = first[d]
    return columns, Edges(first, last), pieces


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The sorted rows in matrices of bounded size: ids, words, lengths, conv ids."""
    for batch in batches:
        turns, convs = batch.column("turns"), batch.column("conv_id").to_numpy()
        offsets = turns.offsets.to_numpy()
        flat = turns.values
        parts = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
        lengths = np.diff(offsets)
        low = 0
        while low < len(lengths):
            # as many rows as the widest of them allows
            widest = np.maximum.accumulate(lengths[low:])
            fits = int(np.searchsorted(widest * np.arange(1, len(widest) + 1), MATRIX_TURNS, side="right"))
            high = low + max(1, fits)
            size = lengths[low:high]
            depth = max(1, int(size.max()))
            ids = np.full((high - low, depth, 2), PAD, np.int64)
            words = np.zeros((high - low, depth), np.int64)
            row = np.repeat(np.arange(high - low), size)
            at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            span = slice(offsets[low], offsets[high])
            ids[row, at, 0], ids[row, at, 1] = parts[0][span], parts[1][span]
            words[row, at] = parts[2][span]
            yield ids, words, size, convs[low:high]
            low = high


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields]
    )


def _closed(out: list[tuple]) -> list[tuple]:
    """Former edge nodes as output rows; their ends are hashed and their parents looked up later."""
    return [
        (conv, depth, None, n, n_children, leaves, saved, None, *key, *(parent or (None, None)))
        for conv, depth, n, n_children, leaves, saved, key, parent in out
    ]


def _edge_rows(shard: int, edges: Edges) -> list[tuple]:
    rows = []
    for is_last, nodes in ((False, edges.first), (True, edges.last)):
        for depth, x in enumerate(nodes):
            shared = depth < len(edges.first) and depth < len(edges.last) and edges.first[depth] is edges.last[depth]
            rows.append((shard, is_last, depth, *x.key, x.conv_id, x.n_convs, x.words, x.n_children, x.n_leaves, x.saved, shared))
    return rows


# Both kinds of rows in one: a task returns nodes, edges and pieces, told apart by `kind`.
_ALL = ", ".join(
    ["kind bigint"] + [f"{p}_{c}" for p, schema in (("n", NODE), ("e", EDGE), ("p", PIECE)) for c in schema.split(", ")]
)
_WIDTHS = [len(schema.split(", ")) for schema in (NODE, EDGE, PIECE)]


def _mixed(kind: int, rows: list[tuple]) -> list[tuple]:
    before, after = (None,) * sum(_WIDTHS[:kind]), (None,) * sum(_WIDTHS[kind + 1 :])
    return [(kind, *before, *row, *after) for row in rows]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All nodes inside a shard, and the shard's edges."""
    shard, edges, piece = TaskContext.get().partitionId(), None, 0
    for ids, words, lengths, convs in _matrices(batches):
        columns, own, pieces = matrix_nodes(ids, words, lengths, convs)
        for d, parent, open_, least, count, n_children, leaves, saved, hashes, keys in columns:
            size = len(least)
            whole = {
                "conv_id": (least, None), "depth": (np.full(size, d), None), "parent_conv_id": (parent, open_),
                "n_convs": (count, None), "n_children": (n_children, None), "n_leaves": (leaves, None),
                "saved_tokens": (saved, None), "parent1": (keys[:, 0], ~open_), "parent2": (keys[:, 1], ~open_),
            }
            arrays, names = [pa.array(np.zeros(size, np.int64))], ["kind"]
            for prefix, schema in (("n", NODE), ("e", EDGE), ("p", PIECE)):
                for field in schema.split(", "):
                    name, kind = field.split()
                    names.append(f"{prefix}_{name}")
                    if prefix == "n" and name in whole:
                        values, missing = whole[name]
                        arrays.append(pa.array(np.ascontiguousarray(values).astype(np.int64), mask=missing))
                    elif prefix == "n" and name == "ends_sha256":
                        arrays.append(pa.array(hashes, pa.string()))
                    else:
                        arrays.append(pa.nulls(size, {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[kind]))
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        out: list[tuple] = []
        edges = joined(edges, own, out)
        rows = _mixed(0, _closed(out))
        rows += _mixed(2, [(*key, shard, piece, text) for key, text in pieces.items()])
        piece += 1
        yield _batch(_ALL, rows)
    if edges is not None:
        yield _batch(_ALL, _mixed(1, _edge_rows(shard, edges)))


def _join_shards(fan_in: int, last_round: bool):
    """Neighbouring shards, which stand in order, joined to one; in the last round every node ends."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Edges]]:
        shard, paths, shared = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    if shard is not None:
                        yield shard, Edges(*paths)
                    shard, paths = r["shard"], ([], [])
                if r["is_last"] and r["shared"]:
                    paths[1].append(paths[0][r["depth"]])
                    continue
                names = ("conv_id", "n_convs", "words", "n_children", "n_leaves", "saved_tokens")
                paths[r["is_last"]].append(Node((r["key1"], r["key2"]), *(r[c] for c in names)))
        if shard is not None:
            yield shard, Edges(*paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, edges = None, None
        for shard, own in ranges(batches):
            out: list[tuple] = []
            if group is not None and shard // fan_in != group:
                yield _batch(_ALL, _mixed(1, _edge_rows(group, edges)))
                edges = None
            group = shard // fan_in
            edges = joined(edges, own, out)
            yield _batch(_ALL, _mixed(0, _closed(out)))
        if edges is not None and last_round:
            out = []
            finished(edges, out)
            yield _batch(_ALL, _mixed(0, _closed(out)))
        elif edges is not None:
            yield _batch(_ALL, _mixed(1, _edge_rows(group, edges)))

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each edge node's pieces, which stand in order and are read one at a time."""
    key, digest = None, None
    for batch in batches:
        rows = []
        for k1, k2, ids in zip(*(batch.column(c) for c in ("key1", "key2", "ids"))):
            own = (k1.as_py(), k2.as_py())
            if own != key:
                if key is not None:
                    rows.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(ids.as_py().encode())
            else:
                digest.update(b"," + ids.as_py().encode())
        yield _batch("k1 bigint, k2 bigint, ends string", rows)
    if key is not None:
        yield _batch("k1 bigint, k2 bigint, ends string", [(*key, digest.hexdigest())])


def _part(rows: DataFrame, kind: int, prefix: str, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.where(f"kind = {kind}").selectExpr(*(f"{prefix}_{c} AS {c}" for c in names))


def prefix_trie(conversations: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The nodes of all prefixes of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 (see `trie_of`)."""
    return trie_of(rebuilt_conversations(conversations), fan_in)


def trie_of(sequences: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The prefix trie of conversations given as conv_id and turns, an array of (h1 >= 0, h2, words).

    Conversations are sorted by their turns and then their id, and dealt into shards by range; equal ones may lie in
    several. A shard is worked off in padded matrices of turn ids: a row starts a node where a column up to it changes,
    and one reduceat a depth sums up members, children, leaves and saved tokens. Nodes that hold a matrix's first or last
    conversation may go on next door: they are carried as two paths, joined with the neighbour's, and put out once they
    end; shards are joined in rounds of `fan_in`. A path is as long as a conversation; nothing else is held in memory.
    The ids that end at such nodes travel as pieces, which one task reads in order, as their digest asks for.

    A conversation without turns ends at the root. Without any conversation there is no node. conv_ids are distinct.
    """
    sequences = materialise(sequences, "sequences")
    sharded = sequences.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    everything = materialise(sharded.mapInArrow(_shard, _ALL), "shards")
    pieces = _part(everything, 2, "p", PIECE)
    nodes = _part(everything, 0, "n", NODE)
    edges = _part(everything, 1, "e", EDGE)
    n_shards = (edges.agg(F.max("shard")).first()[0] or 0) + 1
    while True:
        last_round = n_shards <= fan_in
        grouped = edges.repartition(F.expr(f"shard DIV {fan_in}")).sortWithinPartitions(
            F.expr(f"shard DIV {fan_in}"), "shard", "is_last", "depth"
        )
        everything = materialise(grouped.mapInArrow(_join_shards(fan_in, last_round), _ALL), "joined")
        nodes = nodes.unionByName(_part(everything, 0, "n", NODE))
        if last_round:
            break
        edges, n_shards = _part(everything, 1, "e", EDGE), -(-n_shards // fan_in)
    digests = (
        pieces.repartition("key1", "key2")
        .sortWithinPartitions("key1", "key2", "shard", "piece")
        .mapInArrow(_hashed, "k1 bigint, k2 bigint, ends string")
    )
    known = materialise(
        nodes.where("key1 IS NOT NULL")
        .join(digests, F.expr("key1 = k1 AND key2 = k2"), "left")
        .selectExpr("key1 AS k1", "key2 AS k2", "conv_id AS known_id", f"coalesce(ends, '{NO_ENDS}') AS ends"),
        "edges",
    )
    if known.count() <= BROADCAST_NODES:
        known = F.broadcast(known)
    parents = known.selectExpr("k1 AS p1", "k2 AS p2", "known_id AS parent_id")
    return (
        nodes.join(known.drop("known_id"), F.expr("key1 = k1 AND key2 = k2"), "left")
        .join(parents, F.expr("parent1 = p1 AND parent2 = p2"), "left")
        .selectExpr(
            "conv_id", "depth", "coalesce(parent_conv_id, parent_id) AS parent_conv_id", "n_convs", "n_children",
            "n_leaves", "saved_tokens", "coalesce(ends_sha256, ends) AS ends_sha256",
        )
    )
