"""SimHash groups, conversation tries and hard negatives against brute force and on awkward tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from coverlake.llm import negatives, simhash, trie

DOC = "doc_id bigint, text string, fingerprint string, root string"
TURN = "conv_id bigint, turn bigint, role string, text string, words string, h int"
VEC = "vec_id bigint, embedding array<float>, label int, row string, score string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def plain_fingerprint(t):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(t)]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, ids, radius=3):
    """The smallest id of each print's component."""
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    least = defaultdict(list)
    for p, i in zip(prints, ids):
        if i is not None:
            least[find(p)].append(i)
    return [min(least[find(p)], default=None) for p in prints]


def test_fingerprints_and_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 7)
    r = random.Random(3)
    vocabulary = ["".join(r.choice("aBcdeÉ") for _ in range(r.randint(1, 5))) for _ in range(40)]
    base = [[r.choice(vocabulary) for _ in range(r.randint(1, 120))] for _ in range(30)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "Only two"), (7, "only TWO"), (5, "ÀB c d"), (5, "ÀB c d")]
    for i in range(200):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((r.choice((i + 10, i + 10, None)), r.choice((" ", "\n", "\x0b ")).join(w)))
    rows.append((900, " ".join(r.choice(vocabulary) for _ in range(30_000))))
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], DOC)
    got = simhash.simhash_components(docs).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    wanted = sorted(zip(((i or -1) for i, _ in rows), (f"{p:016x}" for p in prints), groups_of(prints, [i for i, _ in rows])), key=str)
    assert sorted(((x.doc_id or -1, x.fingerprint, x.component_id) for x in got), key=str) == wanted
    assert len({c for *_, c in wanted}) < len(set(prints))
    assert simhash.simhash_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("part", [4, 1024])
def test_links_of_crowded_cells_are_whole(spark, part):
    """Many fingerprints within few bits of each other, a chain, and strangers; each linked pair ends in one component."""
    r = random.Random(part)
    centre = r.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(400)}
    chain = [r.getrandbits(64)]
    for k in range(30):
        chain.append(chain[-1] ^ (7 << (2 * k)))
    prints |= set(chain) | {r.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1, 7, 15}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    links = [(x.a % 2**64, x.b % 2**64) for x in simhash.fingerprint_links(table, part=part).collect()]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        root[find(a)] = find(b)
    ordered = sorted(prints)
    wanted = groups_of(ordered, ordered)
    seen = defaultdict(set)
    for p, w in zip(ordered, wanted):
        seen[find(p)].add(w)
    assert all(len(s) == 1 for s in seen.values()) and len(seen) == len(set(wanted))


def test_pivot_bound_never_exceeds_the_distance():
    r = np.random.default_rng(2)
    prints = r.integers(0, 1 << 64, size=300, dtype=np.uint64)
    prints[150:] = prints[:150] ^ np.uint64(0b1011)
    table = simhash.pivot_table(prints, 5)
    assert (table.sum(axis=1)[:, 0] == np.bitwise_count(prints ^ simhash.pivots()[0])).all()
    left, right = np.triu_indices(300, 1)
    kept = simhash.close_pairs(prints, table.sum(axis=1, dtype=np.uint8), left, right, 3)
    assert set(kept) == set(np.flatnonzero(np.bitwise_count(prints[left] ^ prints[right]) <= 3)) and len(kept) >= 150


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    own = {c: [(t[3], t[5]) for t in sorted(turns)] for c, turns in own.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        path = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]  # the remainder has the sign of c, as in SQL
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        return [p, *itertools.chain.from_iterable(below(c) for c in children[p])]

    out = []
    for p, members in nodes.items():
        tree = below(p)
        saved = sum((len(nodes[x]) - 1) * len(words(x[-1][1])) for x in tree if x)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
        parent = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), parent, len(members), len(children[p]), sum(not children[x] for x in tree), saved, digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, matrix, shards, fan_in", [(1, 500_000, 4, 128), (2, 1, 7, 2), (3, 13, 23, 3)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, matrix, shards, fan_in):
    monkeypatch.setattr(trie, "MATRIX_TURNS", matrix)
    r = random.Random(seed)
    rows = []
    for c in range(0, 260):
        if c % 20 == 0 and r.random() < 0.3:
            continue
        if r.random() < 0.3:  # a very common conversation
            turns = [("user", "hi there you"), ("assistant", "hello"), ("user", "same words again")]
        else:
            turns = [(r.choice(("user", "assistant")), r.choice(("a", "b c", "", "d e f"))) for _ in range(r.choice((0, 1, 2, 5, 9)))]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(300, k, "user", f"turn {k}") for k in range(200)] + [(-7, 0, None, None), (-7, 0, None, None), (-20, None, "user", "x")]
    rows += [(None, 1, "user", "lost"), (301, None, "b", "tie"), (301, None, "a", "tie"), (301, 0, None, "z")]
    r.shuffle(rows)
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], TURN)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(shards))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = trie.prefix_trie(df, fan_in).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got), key=str) == plain_trie(rows)


def test_trie_of_turnless_and_no_conversations(spark):
    turns = "array<struct<h1: bigint, h2: bigint, words: bigint>>"
    df = spark.createDataFrame([(3, []), (12, []), (5, [(4, 1, 2)])], f"conv_id bigint, turns {turns}")
    got = {r.depth: r for r in trie.trie_of(df).collect()}
    assert got[0].n_convs == 3 and got[0].n_leaves == 1 and got[0].n_children == 1 and got[0].parent_conv_id is None
    assert got[0].ends_sha256 == hashlib.sha256(b"3,12").hexdigest() and got[1].parent_conv_id == 3
    assert trie.trie_of(df.limit(0)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([], TURN)).count() == 0


def plain_negatives(rows):
    kept = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        kept.append((k, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, whole))
    out = []
    for k, i, label, v in kept:
        if i is None or i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m == label, j) for q, j, m, w in kept if q != k]
        scored.sort(key=lambda x: x[:3])
        for s, _, _, _, positive in [x for x in scored if x[3]][:5]:
            fits = [x for x in scored if not x[3] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, positive, n + 1, x[4], -s, -x[0]) for n, x in enumerate(fits)]
    return sorted(out, key=str)


@pytest.mark.parametrize("anchor_block", [2, 1024])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, anchor_block):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", anchor_block)
    r = random.Random(anchor_block)
    centres = [[r.gauss(0, 0.3) for _ in range(19)] for _ in range(4)]
    rows = []
    for i in range(600):
        size = 19 if i % 40 else r.choice((0, 3, 19))
        v = [x + r.gauss(0, 0.2) for x in r.choice(centres)[:size]]
        rows.append((i, v, r.choice((0, 1, 1, 1, 9))))
    rows += [rows[100], rows[50], (None, rows[50][1], 1), (None, rows[50][1], 0), (650, None, 1), (700, [0.1, None], 1)]
    rows += [(750, [0.1] * 19, None), (800, [float("nan")] * 19, 1), (850, [float("inf")] * 19, 1), (900, [0.0] * 19, 5)]
    rows += [(1000 + k, [0.25] * 19, k % 2) for k in range(60)]  # ties
    df = spark.createDataFrame([(*x, "clash", None) for x in rows], VEC)
    got = negatives.hard_negatives(df).collect()
    assert sorted(map(tuple, got), key=str) == plain_negatives(rows)
    assert negatives.hard_negatives(df.limit(0)).count() == 0


def test_segment_bounds_hold_and_tighten():
    r = np.random.default_rng(5)
    v = np.floor(r.normal(0, 40, (200, 64)) + np.repeat(r.normal(0, 60, (200, 8)), 8, axis=1))
    means, deviations = negatives.summary(v)
    exact, before = v @ v[0], None
    for level in range(len(negatives.LEVELS)):
        low, high = negatives.bounds((means[0], deviations[0]), means, deviations, level, 64)
        assert (low <= exact).all() and (exact <= high).all()
        if before is not None:
            assert (high - low).mean() < before
        before = (high - low).mean()


def test_components_too_large_for_whole_scores_are_refused(spark):
    df = spark.createDataFrame([(50, [1e30], 1, None, None), (51, [1.0], 1, None, None)], VEC)
    with pytest.raises(ValueError, match="64 bits"):
        negatives.hard_negatives(df)
