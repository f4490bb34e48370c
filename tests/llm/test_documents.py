"""The document operators against brute force and on awkward tables."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from coverlake.llm import arrays, graph, leaks, licenses, lines, lm, mixing, near, quality, text, toxicity

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside.
CLASH = ["line", "h1", "size", "copies", "winner", "own_hash", "gone", "score", "text_hash", "words", "removed_lines"]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def prose_of(seed):
    """Random sentences that leave the shared fixture's generator as it is."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeilnorstu") for _ in range(r.randint(2, 8))) for _ in range(400)]
    return lambda n: " ".join(r.choice(vocabulary) for _ in range(n))


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOC)


@pytest.fixture(scope="module")
def prose():
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdeilnorstu") for _ in range(r.randint(2, 8))) for _ in range(400)]

    def sentence(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    return r, sentence


@pytest.fixture(scope="module")
def awkward(spark, prose):
    """Nulls in every column, empty and blank texts, ties, repeated rows, one long text, clashing columns."""
    _, sentence = prose
    long_text = "\n".join(sentence(60) for _ in range(400))
    shared = sentence(70)
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (None, shared, "b"), (5, shared, "b"), (5, shared, "b"),
        (6, long_text, None), (7, "short", "a"), (8, shared + "\n" + sentence(9), "c"), (9, "é" * 30, "c"),
    ]
    df = make(spark, rows)
    for name in CLASH:
        df = df.selectExpr("*", f"CAST(NULL AS STRING) AS {name}")
    return df, rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


def test_every_operator_takes_awkward_and_empty_tables(spark, awkward, empty, no_labels):
    df, rows = awkward
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (None, rows[4][1])], "item_id bigint, text string")
    for docs, n in ((df, len(rows)), (empty, 0)):
        assert mixing.mix(docs).count() == n
        assert quality.ledger(docs).count() == n
        assert near.near_duplicates(docs).count() == n
        assert lm.score_texts(docs).count() == n
        assert toxicity.score_toxicity(docs, no_labels).count() == n
        assert licenses.scan_licenses(docs).count() == 0
        found = {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, bench).collect()}
        assert found == ({(None, None), (5, None), (8, None)} if n else set())
        assert leaks.find_leaks(docs, bench.limit(0)).count() == 0
        kept = lines.without_lines(docs, lines.dedup_lines(docs))
        assert kept.columns == docs.columns
        # the null id stands first and keeps the shared line; both rows with id 5 lose it and go
        assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == ([0, 1, 2, 3, 6, 7, 8, 9] if n else [])
        assert leaks.without_leaks(docs, leaks.find_leaks(docs, bench)).columns == docs.columns
        assert toxicity.without_toxic(docs, no_labels).columns == docs.columns
        one = near.one_of_each_class(docs)
        # 2 is a copy of 1, the null id one of 5, and 8 is near 5
        assert one.columns == docs.columns
        assert sorted(r.doc_id for r in one.select("doc_id").collect()) == ([1, 3, 5, 6, 7, 9] if n else [])
        assert mixing.mixed_documents(docs.dropDuplicates(["doc_id"]), mixing.mix(docs.dropDuplicates(["doc_id"]))).columns == [
            *docs.columns, "copy_no",
        ]


def test_mixing_meets_targets_and_reshares_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 90)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # 1650 words: a (weight 3) and the null source (2) stop at 20 and 180, b takes the rest
    assert got == {"a": 20.0, None: 180.0, "b": 1450.0}
    r = random.Random(1)
    rows = [(i, " ".join(["w"] * r.randint(1, 40)), r.choice("aaab") if i % 9 else None) for i in range(3000)]
    docs = make(spark, rows)
    first = sorted(map(tuple, mixing.mix(docs).select("doc_id", "copies", "size", "source_size", "target").collect()))
    again = sorted(map(tuple, mixing.mix(docs.repartition(7)).select("doc_id", "copies", "size", "source_size", "target").collect()))
    assert first == again
    taken = defaultdict(int)
    for _, copies, size, source_size, target in first:
        assert 0 <= copies <= 2
        taken[source_size, target] += copies * size
    for (_, target), n in taken.items():
        assert abs(n - target) <= 100
    mixed = mixing.mixed_documents(docs, mixing.mix(docs))
    assert mixed.count() == sum(c for _, c, *_ in first)


def test_rows_that_share_an_id_are_mixed_each_on_its_own(spark):
    r = random.Random(2)
    rows = [(None if i % 3 else 7, f"text{i} " + "w " * r.randint(0, 5), r.choice("ab")) for i in range(90)]
    rows += [(None, "same words", "a")] * 5
    docs = make(spark, rows)
    mixture = mixing.mix(docs).persist()
    wanted = Counter()
    for row in mixture.collect():
        assert 0 <= row.copies <= 2
        wanted[row.doc_id, row.document.text, row.source] += row.copies
    mixed = mixing.mixed_documents(docs, mixture)
    assert mixed.columns == [*docs.columns, "copy_no"]
    got = Counter((row.doc_id, row.text, row.source) for row in mixed.collect())
    assert got == +wanted and sum(got.values()) > 90
    assert set(got) <= set(rows)
    clash = mixing.mixed_documents(d := docs.selectExpr("*", "1 AS copies", "2 AS document", "3 AS copy_no"), mixing.mix(d))
    assert clash.columns == [*docs.columns, "copies", "document", "copy_no"]
    assert Counter((row.doc_id, row.text, row.source) for row in clash.where("copies = 1 AND document = 2").collect()) == got
    with pytest.raises(ValueError):
        mixing.mixed_documents(docs, mixing.mix(docs, whole=False))


def test_one_of_each_class_tells_rows_of_one_id_apart(spark):
    sentence = prose_of(5)
    a, b, c = (sentence(60) for _ in range(3))
    # near copies without an id, near copies that share an id with another class's smallest, and a class of only nulls
    rows = [(1, a), (None, a + " end"), (3, b), (4, c), (3, c + " end"), (None, "x " + c), (9, a + " stop")]
    rows += [(None, d := sentence(60)), (None, d + " end"), (None, d)]
    kept = near.one_of_each_class(make(spark, [(i, t, "s") for i, t in rows])).collect()
    got = sorted(((r.doc_id or 0, r.text) for r in kept))
    assert [i for i, _ in got] == [0, 1, 3, 3]
    assert got[0][1] in (d, d + " end") and got[1:] == sorted([(1, a), (3, b), (3, c + " end")])


def test_quality_measurements_ledger_and_ablations(spark):
    t = "a b c x a b c\n# <\nline here\nline here\n\n"
    row = quality.ledger(make(spark, [(1, t, "s")])).first()
    w = words(t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
        len(w), sum(map(len, w)), 2, 1, len(covered),
    )
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    rows = [(1, good, "s"), (2, good.upper(), "s"), (3, "too short", "s"), (4, "SHORT", "s")]
    entries = quality.ledger(make(spark, rows))
    kept = {r.doc_id: r.kept for r in quality.verdicts(entries, quality.STANDARD).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False}
    cost = {(r.policy, r.rule): r for r in quality.ablations(entries).collect()}
    assert cost["standard", "few_words"].n_failed == 2 and cost["standard", "few_words"].n_failed_alone == 1
    assert cost["standard", "shouting"].n_kept == 1 and cost["standard", "shouting"].n_kept_without == 2
    with pytest.raises(ValueError):
        quality.mask(quality.Policy("p", 1, ("unknown",)))


def test_license_notices_are_found_by_dice(spark):
    text_ = "intro words here\nLicensed under the Apache License, version 2.0!\nreleased  under the MIT license\nother"
    got = {r.license: (r.dice, r.n_places, r.first_word) for r in licenses.scan_licenses(make(spark, [(1, text_, "s")])).collect()}
    assert got == {"Apache-2.0": (1.0, 1, 3), "MIT": (1.0, 1, 11)}
    changed = "This work is licensed under the GNU General Public License, version 2."
    rows = licenses.scan_licenses(make(spark, [(1, changed, "s"), (2, "License", "s"), (3, "nothing of that kind here", "s")]))
    row = rows.collect()
    # the run ends before the changed word: 10 of its 10 and of the template's 11 bigrams
    assert len(row) == 1 and row[0].license == "GPL-3.0" and abs(row[0].dice - 2 * 10 / 21) < 1e-9


def test_whole_licenses_are_found_alone_wrapped_and_inside_documents(spark):
    filler = "some other words that stand before and after ".split()
    rows, want = [], {}
    for k, (name, notice) in enumerate(licenses.TEMPLATES):
        words = notice.split()
        wrapped = "\n * ".join(" ".join(words[i : i + 7]) for i in range(0, len(words), 7))
        inside = " ".join(filler * 30 + words + filler * 30)
        for j, text_ in enumerate((notice, wrapped, inside)):
            rows.append((10 * k + j, text_, "s"))
            want[10 * k + j] = name
    rows += [(None, rows[0][1], "s"), (None, rows[0][1], "s"), (7001, None, "s"), (7002, "", "s"), (7003, "word " * 50_000, "s")]
    docs = make(spark, rows).selectExpr("*", "1 AS pair", "2 AS first", "'x' AS license", "3 AS template")
    got = {}
    for r in licenses.scan_licenses(docs).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.dice, r.n_places))
    for doc_id, name in want.items():
        assert (name, 1.0, 1) in got.pop(doc_id)
    assert got == {None: [("Apache-2.0", 1.0, 1)]}


def plain_license_places(text_, templates, t):
    words = re.findall(r"[^\W_]+", (text_ or "").lower())
    pairs = list(zip(words, words[1:]))
    runs = []
    for name, notice in templates:
        known = re.findall(r"[^\W_]+", notice.lower())
        wanted = Counter(zip(known, known[1:]))
        n = len(known) - 1
        at = [i for i, p in enumerate(pairs) if p in wanted]
        for x, i in enumerate(at):
            ends = [(-(y - x + 1) / (n + j - i + 1), j) for y, j in enumerate(at) if y >= x and j - i < n * (200 - t) // t]
            ends = [(s, j) for s, j in ends if -200 * s >= t - 1e-9]
            if ends:
                j = min(ends)[1]
                shared = sum((Counter(pairs[i : j + 1]) & wanted).values())
                if 200 * shared >= t * (n + j - i + 1):
                    runs.append((i, j, -2 * shared / (n + j - i + 1), -n, name))
    places, reached = [], -1
    for i, j, cost, shorter, name in sorted(runs, key=lambda r: r[:2]):
        if i > reached:
            places.append([])
        places[-1].append((cost, shorter, name, i))
        reached = max(reached, j)
    return [min(p) for p in places]


def test_license_places_equal_brute_force(spark):
    rng = random.Random(8)
    vocabulary = "the license of this work under terms is a copy".split()
    texts = []
    for k in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, len(words) // 6)):
                i = rng.randrange(len(words))
                change = rng.randrange(3)
                words[i : i + (change > 0)] = [rng.choice(vocabulary)] if change < 2 else []
            parts += words * rng.choice((1, 1, 1, 2)) + rng.choices(vocabulary, k=rng.randint(0, 9))
        texts.append(rng.choice((" ", "\n")).join(parts))
    got = {(r.doc_id, r.license): (round(r.dice, 9), r.n_places, r.first_word)
           for r in licenses.scan_licenses(make(spark, [(k, x, "s") for k, x in enumerate(texts)])).collect()}
    want = {}
    for k, text_ in enumerate(texts):
        for cost, _, name, first in plain_license_places(text_, licenses.TEMPLATES, licenses.THRESHOLD_PERCENT):
            best, n, begin = want.get((k, name), (0, 0, first))
            want[k, name] = (max(best, round(-cost, 9)), n + 1, min(begin, first))
    assert got == want and len(want) > 60


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance_equals_the_table(spark, edits):
    r = random.Random(edits)
    pairs = []
    for _ in range(150):
        a = "".join(r.choice("ab😀") for _ in range(r.randint(1, 12)))
        b = list(a)
        for _ in range(r.randint(0, edits + 1)):
            place = r.randint(0, len(b))
            if r.random() < 0.4:
                b.insert(place, r.choice("ab😀"))
            elif b and r.random() < 0.5:
                b.pop(place % len(b))
            elif b:
                b[place % len(b)] = "c"
        if b:
            pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").selectExpr(
        "a AS x", "b AS y", "regexp_extract_all(a, '(?s).', 0) AS a", "regexp_extract_all(b, '(?s).', 0) AS b"
    )
    for row in df.selectExpr("x", "y", f"{lines.within_edits_sql('a', 'b', edits)} AS within").collect():
        assert row.within == (distance(row.x, row.y) <= edits), (row.x, row.y)


def test_line_links_are_complete(spark, prose):
    r, sentence = prose
    base = [sentence(6)[:60] for _ in range(25)]
    rows, k = [], 0
    for line in base:
        for _ in range(6):
            edited = list(line)
            for _ in range(r.randint(0, 3)):
                place = r.randrange(len(edited))
                r.choice((lambda: edited.insert(place, "z"), lambda: edited.pop(place), lambda: edited.__setitem__(place, "q")))()
            rows.append((k, "".join(edited), "s"))
            k += 1
    found = lines.dedup_lines(make(spark, rows)).collect()
    first = {}
    for i, t, _ in rows:
        first.setdefault(t.strip(), i)
    for row in found:
        line = rows[row.doc_id][1].strip()
        earlier = [i for t, i in first.items() if i < first[line] and len(t) >= 20 and distance(t, line) <= 2]
        assert row.n_near == int(bool(earlier) and len(line) >= 20)
        assert row.n_exact == int(not earlier and first[line] != row.doc_id and len(line) >= 20)
        if earlier:
            assert row.first_docs == [min(earlier)]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_few_windows_of_a_line_find_all_lines_within_the_edits(spark, edits):
    """Of lengths around the bounds of the classes; a line shows no more than two classes' windows, not fifteen keys."""
    r = random.Random(edits)
    given = []
    for n in [20, 21, 23, 24, 25, 31, 32, 33, 47, 63, 64, 65, 66, 79, 80, 81, 95, 96, 97, 98, 127, 128, 129, 143, 144, 145] * 3:
        line = [r.choice("abcd") for _ in range(n)]
        given.append("".join(line))
        for _ in range(4):
            edited = list(line)
            # edits in one place, at the ends and spread out
            places = [r.choice([0, n // 2, n - 1, r.randrange(n)]) for _ in range(edits)]
            for place in places:
                what = r.randrange(3)
                if what == 0:
                    edited.insert(min(place, len(edited)), r.choice("ab😀"))
                elif what == 1:
                    edited.pop(min(place, len(edited) - 1))
                else:
                    edited[min(place, len(edited) - 1)] = r.choice("cdé")
            given.append("".join(edited))
    docs = make(spark, [(i, t, "s") for i, t in enumerate(given)]).repartition(4)
    at = {r.h1: r.line for r in lines.line_rows(docs).where("h1 IS NOT NULL").collect()}
    got = {frozenset((at[r.a1], at[r.b1])) for r in lines.line_links(docs, edits).collect()}
    long_enough = sorted(set(at.values()), key=len)
    wanted = set()
    for k, a in enumerate(long_enough):
        for b in itertools.takewhile(lambda b, a=a: len(b) <= len(a) + edits, long_enough[k + 1 :]):
            if sum((Counter(a) - Counter(b)).values()) <= edits and distance(a, b) <= edits:
                wanted.add(frozenset((a, b)))
    assert got == wanted and len(wanted) > 300
    shown = Counter(r.h1 for r in lines.line_windows(docs, edits).collect())
    assert max(shown.values()) <= 2 * len(lines.window_keys(edits))
    assert len(lines.window_keys(2)) == 4


def test_lines_are_trimmed_of_form_feeds_and_keep_their_outer_f(spark):
    least = "one line of the roof"  # just as long as needed
    other = "from here to the roof of it"
    given = [least, least, other, other[1:] + "z!", "\x0c\x0b " + other + "\x0c", "ffrom here to the roofff", "rom here to the roo, yes"]
    rows = lines.line_rows(make(spark, [(i, t, "s") for i, t in enumerate(given)])).collect()
    assert {r.doc_id: r.line for r in rows} == {i: t.strip() for i, t in enumerate(given)}
    got = {r.doc_id: (r.n_exact, r.n_near) for r in lines.dedup_lines(make(spark, [(i, t, "s") for i, t in enumerate(given)])).collect()}
    # the second line of just 20 characters is a copy; the fourth is three edits from the third
    assert got == {0: (0, 0), 1: (1, 0), 2: (0, 0), 3: (0, 0), 4: (1, 0), 5: (0, 0), 6: (0, 0)}


def shingles(t, n=5):
    w = words(t)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_near_duplicates_equal_brute_force_with_a_large_group(spark, prose, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_TEXTS", 8)  # many blocks
    r, sentence = prose
    rows = [(i, sentence(r.randint(1, 80)), "s") for i in range(60)]
    base = words(sentence(120))
    for i in range(60, 140):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w), "s"))
    rows += [(i + 200, t, s) for i, t, s in rows[:20]]
    got = {row.doc_id: row for row in near.near_duplicates(make(spark, rows)).collect()}
    ids = defaultdict(list)
    for i, t, _ in rows:
        ids[t].append(i)
    sets = {t: shingles(t) for t in ids}
    links = defaultdict(set)
    for a, b in itertools.combinations(ids, 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    for t, members in ids.items():
        group, todo = {t}, [t]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        for i in members:
            assert (got[i].text_id, got[i].n_copies, got[i].n_links, got[i].class_id) == (
                min(members), len(members), len(links[t]), min(min(ids[g]) for g in group),
            )


def test_bands_follow_the_recall_asked_for():
    for recall in (0.9, 0.999):
        bands = near.bands_for(0.8, 4, recall)
        assert 1 - (1 - 0.8**4) ** bands >= recall > 1 - (1 - 0.8**4) ** (bands - 1)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}}


def test_shared_counts_and_shingles():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 50, size=n).astype(np.uint64)) for n in (3, 40, 60, 1)]
    shared = near.shared_counts(sets)
    for i, j in itertools.combinations(range(4), 2):
        assert shared[i, j] == len(np.intersect1d(sets[i], sets[j]))
    values, counts = arrays.shingles_of(pa.array(["a b c d e f", None, "a b", "a b c d e"]), 5)
    assert counts.tolist() == [2, 0, 1, 1] and values[0] == values[3] and len(set(values.tolist())) == 3


def test_packed_numbers_come_back():
    r = np.random.default_rng(1)
    for top in (1, 255, 256, 2**40):
        values = r.integers(0, top, size=50, dtype=np.uint64)
        assert (lm.unpack(lm.pack(values)) == values).all()
    hashes = np.unique(r.integers(0, 2**63, size=99, dtype=np.uint64) * np.uint64(2))
    assert (lm.unpack_sorted(lm.pack_sorted(hashes)) == hashes).all()
    assert (lm.unpack_sorted(lm.pack_sorted(hashes[:1])) == hashes[:1]).all()


def test_language_model_equals_a_plain_one(spark, prose):
    _, sentence = prose
    rows = [(i, sentence(30) + (" Unseen%d" % i if i % 5 == 0 else ""), "s") for i in range(300)]
    got = {r.doc_id: r for r in lm.score_texts(make(spark, rows), chunk_bytes=4000).collect()}
    one_chunk = {r.doc_id: r for r in lm.score_texts(make(spark, rows), chunk_bytes=1 << 30).collect()}
    tokens = {i: [w.lower() for w in words(t)] + ["</s>"] for i, t, _ in rows}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in tokens}
    single, pair = Counter(), Counter()
    for i, w in tokens.items():
        if fold[i] != 2:
            single.update(w)
            pair.update(zip(["</s>", *w], w))
    n, v = sum(single.values()), len(single)
    for i, w in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[i] == 2, len(w), sum(single[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert math.isclose(r.score, one_chunk[i].score, rel_tol=1e-9)
    # the mixture, put together from the learned weights, on one text
    held = [i for i in tokens if fold[i] == lm.HELD_OUT_FOLD]
    rest1, rest2 = single.copy(), pair.copy()
    for i in held:
        rest1.subtract(tokens[i])
        rest2.subtract(zip(["</s>", *tokens[i]], tokens[i]))
    n_rest, v_rest = sum(rest1.values()), sum(c > 0 for c in rest1.values())
    events = Counter()
    for i in held:
        for a, b in zip(["</s>", *tokens[i]], tokens[i]):
            step = lambda p: round(lm.STEPS * math.log2(p * (v_rest + 1))) if p > 0 else -9999
            p2 = rest2[a, b] / rest1[a] if rest1[a] else 0
            events[int(lm.bucket_of(np.array(float(rest1[a])))), step(p2), step(rest1[b] / n_rest)] += 1
    weights = lm.learn_weights(np.array([(*k, c) for k, c in sorted(events.items())], float))
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0
    i = next(iter(held))
    score = 0.0
    for a, b in zip(["</s>", *tokens[i]], tokens[i]):
        w = weights[int(lm.bucket_of(np.array(float(single[a]))))]
        score += math.log10(w[0] * (pair[a, b] / single[a] if single[a] else 0) + w[1] * single[b] / n + w[2] / (v + 1))
    assert math.isclose(got[i].score, score, rel_tol=1e-6)


def test_grammar_composes_its_transducers():
    model = toxicity.Model()

    def found(sentence_):
        tagged = [model.tag(t) for t in sentence_.split()]
        return toxicity.clause_score([t for t, _ in tagged], [w for _, w in tagged])

    plain, aimed, excused, threat = found("you are an idiot")
    assert plain and aimed and not excused and not threat
    assert found("not an idiot")[2] and not found("not an idiot")[0]
    assert found("she said that man is a moron")[2]
    assert found("we will kill you")[3] and not found("we never kill you")[3] and not found("kill time")[3]
    assert not found("a calm sentence of no harm").any()
    assert found("such scum are you")[1]


def plain_clause_score(tags, weights):
    """The grammar's rules, read off the clause word by word."""
    out = [0.0] * 4
    free = lambda i: toxicity.NEGATION not in tags[max(0, i - 3) : i] and toxicity.REPORT not in tags[:i]
    for i, tag in enumerate(tags):
        near_ = range(max(0, i - 3), i)
        if tag == toxicity.INSULT:
            out[0 if free(i) else 2] += weights[i]
            out[1] += weights[i] * (free(i) and any(tags[j] == toxicity.TARGET for j in near_))
        if tag == toxicity.TARGET:
            insults = [j for j in near_ if tags[j] == toxicity.INSULT and free(j)]
            out[1] += weights[insults[-1]] if insults else 0
            out[3] += toxicity.SEED_WEIGHT * any(tags[j] == toxicity.THREAT and free(j) for j in near_)
    return out


def test_grammar_equals_its_rules_on_random_clauses():
    r = random.Random(8)
    for _ in range(3000):
        tags = [r.choice(toxicity.TAGS) for _ in range(r.randint(0, 12))]
        weights = [r.randint(1, 9) if t == toxicity.INSULT else 0.0 for t in tags]
        assert toxicity.clause_score(tags, weights).tolist() == plain_clause_score(tags, weights), tags
    model = toxicity.Model()

    def found(sentence_):
        tagged = [model.tag(t) for t in sentence_.split()]
        return toxicity.clause_score([t for t, _ in tagged], [w for _, w in tagged])

    assert not found("not an idiot are you")[:2].any() and not found("he wrote that scum like you")[:2].any()
    assert not found("she said he will kill you").any() and found("never mind but we will soon kill you")[3]


def test_toxicity_takes_null_repeated_and_contradictory_labels(spark, prose):
    _, sentence = prose
    rows = [(i, sentence(20) + (" zorgl zorgl" if i % 4 == 0 else ""), "s") for i in range(200)]
    docs = make(spark, rows + [(None, sentence(9), "s")] + [(8, sentence(9) + f" {k}", "s") for k in range(300)])
    labels = [(i, 1, int(i % 4 == 0)) for i in range(200)] + [(i, None, None) for i in range(9)] + [(None, 1, 1)]
    labels += [(4, 1, 0), (4, 1, 0), (8, 0, 1)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = toxicity.score_toxicity(docs, table).collect()
    assert len(got) == 501 and all(0 <= r.score <= 1 for r in got)
    toxic = {i for i in range(200) if i % 4 == 0} - {8}
    assert all(r.predicted == (r.doc_id in toxic) for r in got if r.doc_id is not None and r.doc_id != 8)
    # one text of an id is learned from, however many rows it has
    assert toxicity.train(docs, table, sample_rows=50).words.keys() <= {"zorgl"}


def test_toxicity_learns_unknown_words_and_leaves_clean_texts(spark, prose):
    r, sentence = prose
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        w = words(sentence(60))
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), "zorgl" + r.choice(["a", "emt", "ix"]))
        rows.append((i, " ".join(w), "s"))
        labels.append((i, 1, int(toxic)))
    docs = make(spark, rows)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {row.doc_id: row for row in toxicity.score_toxicity(docs, table).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3) for row in got.values())
    held = [i for i in got if got[i].held_out]
    assert sum(got[i].predicted == (i % 6 == 0) for i in held) >= 0.97 * len(held)
    # labels of the test fold are not read
    flipped = spark.createDataFrame(
        [(i, q, 1 - x if zlib.crc32(str(i).encode()) % 4 == 2 else x) for i, q, x in labels], table.schema
    )
    again = {row.doc_id: row.score for row in toxicity.score_toxicity(docs, flipped).collect()}
    assert all(math.isclose(again[i], got[i].score, rel_tol=1e-9) for i in got)
    kept = {row.doc_id for row in toxicity.without_toxic(docs, table).collect()}
    assert kept == {i for i in got if got[i].score < 0.3}


def test_leaks_equal_brute_force(spark, prose):
    r, sentence = prose
    items = [(k, sentence(r.randint(12, 40))) for k in range(12)]
    rows = []
    for i in range(80):
        w = words(sentence(r.randint(20, 120)))
        if i % 3 == 0:
            passage = words(items[i % 12][1])
            if i % 2:
                passage[r.randrange(len(passage))] = "changed"
            place = r.randrange(len(w))
            w[place:place] = passage
        rows.append((i, " ".join(w).capitalize() + ".", "s"))
    found = leaks.find_leaks(make(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(row.doc_id, row.item_id): row.similarity for row in found.collect()}
    normal = lambda t: re.findall(r"[^\W_]+", t.lower())
    weigh = lambda s: sum(len("".join(x)) for x in s)
    expected = {}
    for i, t, _ in rows:
        w = normal(t)
        for k, item in items:
            want, n = shingles(" ".join(normal(item))), len(normal(item))
            for start in range(max(1, len(w) - n + 1)):
                have = shingles(" ".join(w[start : start + n]))
                s = weigh(have & want) / weigh(have | want)
                if s >= 0.8:
                    expected[i, k] = max(s, expected.get((i, k), 0))
    assert got.keys() == expected.keys() and all(math.isclose(got[k], expected[k]) for k in got)
    assert len(got) >= 13


def test_changed_leaks_short_items_and_equal_items_equal_brute_force(spark):
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdeilnorstu") for _ in range(r.randint(2, 8))) for _ in range(60)]
    sentence = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(k, sentence(r.randint(5, 40))) for k in range(60)] + [(100 + k, sentence(k)) for k in (1, 2, 3, 4)]
    items += [(200, items[7][1]), (201, items[62][1])]
    rows = []
    for i in range(240):
        passage = list(items[i % 60][1])
        for _ in range(r.choice((0, 1, 1, 2))):
            place = r.randrange(len(passage))
            passage[place : place + r.randint(0, 1)] = r.choice(([], ["new"], ["two", "new"]))
        cut = r.randint(0, 3)
        w = sentence(r.randint(0, 30)) + passage[cut:] + sentence(r.randint(0, 30))
        rows.append((i, " ".join(w), "s"))
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id bigint, text string")
    got = {(x.doc_id, x.item_id): (x.start, x.similarity) for x in leaks.find_leaks(make(spark, rows), table).collect()}
    weigh = lambda s: sum(len("".join(x)) for x in s)
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    expected = {}
    for i, t, _ in rows:
        w = words(t)
        for k, item in items:
            n, size = len(item), min(5, len(item))
            want = grams(item, size)
            for start in range(max(1, len(w) - n + 1)):
                have = grams(w[start : start + n], size)
                s = weigh(have & want) / max(weigh(have | want), 1)
                if s >= (0.8 if n > 4 else 1) and s > expected.get((i, k), (0, 0))[1]:
                    expected[i, k] = (start, s)
    assert got.keys() == expected.keys() and len(got) > 240
    assert all(got[k][0] == expected[k][0] and math.isclose(got[k][1], expected[k][1]) for k in got)


def test_leak_radius_leaves_out_no_more_than_one_pair_in_100_000_at_the_threshold():
    p = 9.7 / 64
    assert sum(math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(leaks.RADIUS + 1, 65)) < 1e-5


def test_materialise_and_free_names(spark):
    df = text.materialise(spark.range(5), "t")
    assert df.count() == 5 and text.unused(df, "id", "other") == ["_id", "other"]
