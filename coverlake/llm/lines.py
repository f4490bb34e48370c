"""Line dedup: equal lines by hash, lines within a few edits by a join on windows of which they share one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.text import materialise, unused

#: Lines shorter than this say too little to be called copies.
LEAST_CHARS = 20
#: Edits (insert, delete, replace a character) up to which two lines are copies.
EDITS = 2
#: Characters counted, modulo 16, for a bound on the distance that needs no text.
COUNTED = "etanoirshdlbwgu,"
#: Candidate lines up to this many are looked up by broadcast, at 16 bytes each; more are joined by shuffle.
BROADCAST_LINES = 1_000_000


def line_rows(docs: DataFrame) -> DataFrame:
    """All lines of all documents: doc_id, text_hash, line_no from 0, line without outer blanks, h1 and h2.

    The hashes together tell lines apart; they are null for lines that are too short. A null text is one empty line.
    """
    split = docs.selectExpr("doc_id", "coalesce(text, '') AS text").selectExpr(
        "doc_id", "xxhash64(text) AS text_hash", r"posexplode(split(text, '\n')) AS (line_no, raw)"
    )
    trimmed = split.selectExpr(
        "doc_id", "text_hash", "line_no", r"trim(BOTH ' \t\n\u000b\u000c\r' FROM raw) AS line"
    ).selectExpr("*", f"length(line) >= {LEAST_CHARS} AS long_enough")
    return trimmed.selectExpr(
        "doc_id", "text_hash", "line_no", "line",
        "CASE WHEN long_enough THEN xxhash64(line) END AS h1",
        "CASE WHEN long_enough THEN xxhash64(17, line) END AS h2",
    )


def least_length_sql(length: str, edits: int) -> str:
    """The least length, in SQL, of the class that a line of that length is in: classes get wider as lines get longer."""
    unit = max(1, edits)
    length = f"greatest(0, {length})"
    return f"({length} - {length} % CASE WHEN {length} < {32 * unit} THEN {2 * unit} ELSE {8 * unit} END)"


def window_keys(edits: int) -> list[tuple[str, bool]]:
    """What a line of n characters shows in a class of least length `least`: hashes, in SQL, and whether each is moved.

    The class lays out edits + 1 zones, the first half of them counted from the line's start, the others from its end.
    Of two lines within `edits` edits, some zone i of the one stands unchanged in the other with no more than i edits
    before and edits - i behind it, so moved by `room` at most, the lesser of the two. A zone is a window and its room:
    moved either way, the window at the zone's start in one of the lines is the window so much further in the other.
    """
    rooms = [min(i, edits - i) for i in range(edits + 1)]
    size = f"greatest(0, (least - {sum(rooms)}) DIV {edits + 1})"
    keys = []
    for i, room in enumerate(rooms):
        if 2 * i <= edits:
            start = f"1 + {i} * {size} + {sum(rooms[:i])}"
        else:
            start = f"1 + n - {edits + 1 - i} * {size} - {sum(rooms[i:])}"
        keys += [(f"xxhash64({i}, least, substr(line, {start} + {by}, {size}))", by > 0) for by in range(room + 1)]
    return keys


def line_windows(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """What different lines are found by, never their text: h1, n (characters), sketch, key, moved.

    Lines of lengths up to `edits` apart meet in a class: each is in its own and in that of a line so much shorter,
    which is the same one for most.
    """
    rows = line_rows(docs).where("h1 IS NOT NULL").selectExpr(
        "h1", "line", "length(line) AS n", f"{sketch_sql()} AS sketch"
    )
    classes = f"array({least_length_sql('n', edits)}, {least_length_sql(f'n - {edits}', edits)})"
    shown = window_keys(edits)
    classed = rows.selectExpr("*", f"explode(array_distinct({classes})) AS least").selectExpr(
        "h1", "n", "sketch", *(f"{key} AS key{k}" for k, (key, _) in enumerate(shown))
    )
    windows = ", ".join(
        f"struct(key{k} AS key, {'true' if moved else 'false'} AS moved)" for k, (_, moved) in enumerate(shown)
    )
    return classed.distinct().selectExpr("h1", "n", "sketch", f"inline(array({windows}))")


def sketch_sql() -> str:
    """Counts of sixteen characters, four bits each."""
    return " | ".join(
        f"shiftleft(CAST((octet_length(line) - octet_length(replace(line, '{c}', ''))) % 16 AS BIGINT), {4 * k})"
        for k, c in enumerate(COUNTED)
    )


def sketches_within_sql(a: str, b: str, edits: int) -> str:
    """Whether the counts leave room for the lines to be within `edits` edits: each raises and lowers at most one."""
    gaps = [f"(((shiftright({a}, {4 * k}) & 15) - (shiftright({b}, {4 * k}) & 15)) & 15)" for k in range(len(COUNTED))]
    up = " + ".join(f"CASE WHEN {g} < 8 THEN {g} ELSE 0 END" for g in gaps)
    down = " + ".join(f"CASE WHEN {g} > 8 THEN 16 - {g} ELSE 0 END" for g in gaps)
    return f"({up}) <= {edits} AND ({down}) <= {edits}"


def within_edits_sql(a: str, b: str, edits: int) -> str:
    """Whether two arrays of characters are within `edits` edits, by a bit-parallel walk along the band.

    After j characters of b, bit o of mask d says that the first j + o - edits characters of a can be turned into
    them by at most d edits. All 2 * edits + 1 cells of the band move in one step: a match keeps a cell, and of the
    cells with one edit less a replacement keeps the place, an extra character of b moves one down, one of a one up.
    """
    width = (1 << (2 * edits + 1)) - 1
    match = " + ".join(
        f"CASE WHEN coalesce(get({a}, j - 1 + {o - edits}) = get({b}, j - 1), false) THEN {1 << o} ELSE 0 END"
        for o in range(2 * edits + 1)
    )
    steps = ["(s.r0 & x)"]
    for d in range(1, edits + 1):
        steps.append(
            f"(((s.r{d} & x) | s.r{d - 1} | shiftright(s.r{d - 1}, 1) | shiftleft({steps[-1]}, 1)) & {width})"
        )
    start = ", ".join(f"'r{d}', {sum(1 << (edits + o) for o in range(d + 1))}" for d in range(edits + 1))
    step = ", ".join(f"'r{d}', {s}" for d, s in enumerate(steps))
    # the transform over one element binds the match mask once
    return (
        f"abs(size({a}) - size({b})) <= {edits} AND aggregate(sequence(1, size({b})), named_struct({start}),"
        f" (s, j) -> transform(array({match}), x -> named_struct({step}))[0],"
        f" s -> (shiftright(s.r{edits}, size({a}) - size({b}) + {edits}) & 1) = 1)"
    )


def first_lines(rows: DataFrame) -> DataFrame:
    """Where each different line stands first: h1, h2, first (doc_id, line_no, text_hash)."""
    long_enough = rows.where("h1 IS NOT NULL")
    return long_enough.groupBy("h1", "h2").agg(F.expr("min(struct(doc_id, line_no, text_hash)) AS first"))


def line_links(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Pairs of different lines within `edits` edits of each other, by their hashes: a1, a2, b1, b2.

    Each different line is exploded into the hashes of a few windows, and these are joined with themselves. Within the
    join, lengths and character counts drop pairs that are surely further apart, so the rows it makes follow the links
    rather than the square of the lines that share a window. What is left is verified on whole lines. Only one hash
    travels with the keys; lines that share it by chance are told apart there. All links are found.
    """
    rows = line_rows(docs).where("h1 IS NOT NULL")
    windows = line_windows(docs, edits)
    left, right = (
        windows.selectExpr(*(f"{c} AS {side}_{c}" for c in windows.columns)) for side in ("a", "b")
    )
    close = sketches_within_sql("a_sketch", "b_sketch", edits)
    pairs = left.join(
        right,
        (left.a_key == right.b_key)
        & F.expr(f"a_h1 < b_h1 AND NOT (a_moved AND b_moved) AND abs(a_n - b_n) <= {edits} AND {close}"),
    ).selectExpr("a_h1 AS a1", "b_h1 AS b1")
    pairs = materialise(pairs.distinct(), "line-pairs")
    ends = materialise(pairs.selectExpr("a1 AS h1").union(pairs.selectExpr("b1 AS h1")).distinct(), "line-ends")
    if ends.count() <= BROADCAST_LINES:
        ends = F.broadcast(ends)
    texts = materialise(
        rows.join(ends, "h1").groupBy("h1", "h2").agg(F.first("line").alias("line")), "line-texts"
    ).selectExpr("h1", "h2", "regexp_extract_all(line, '(?s).', 0) AS chars")
    left = texts.selectExpr("h1 AS a1", "h2 AS a2", "chars AS a")
    right = texts.selectExpr("h1 AS b1", "h2 AS b2", "chars AS b")
    return (
        pairs.join(left, "a1").join(right, "b1")
        .where(within_edits_sql("a", "b", edits))
        .select("a1", "a2", "b1", "b2")
    )


def dedup_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """What line dedup removes from each document: doc_id, text_hash, n_lines, n_exact, n_near, removed_lines, first_docs.

    Lines stand in the order of doc_id and line number, null ids first. A line of LEAST_CHARS characters or more is
    removed if an equal line stands before it, or if it is within `edits` edits of a line that first stands before it.
    The first line of each such group always stays. `removed_lines` are line numbers from 0, `first_docs` the
    documents of the lines that are kept instead. One row for each different (doc_id, text); repeated rows are one
    document. Null and empty texts are one short line; columns other than doc_id and text are ignored.
    """
    rows = materialise(line_rows(docs).drop("line"), "lines")
    firsts = materialise(first_lines(rows), "line-firsts")
    both = materialise(line_links(docs, edits), "line-links").selectExpr(
        "inline(array(struct(a1, a2, b1, b2), struct(b1 AS a1, b2 AS a2, a1 AS b1, a2 AS b2)))"
    )
    partners = both.join(firsts.selectExpr("h1 AS b1", "h2 AS b2", "first"), ["b1", "b2"]).groupBy("a1", "a2").agg(
        F.min("first").alias("near_first")
    )
    known = firsts.join(partners.selectExpr("a1 AS h1", "a2 AS h2", "near_first"), ["h1", "h2"], "left").selectExpr(
        "h1 AS k1", "h2 AS k2", "first", "CASE WHEN near_first < first THEN near_first END AS near_first"
    )
    judged = rows.join(known, (rows.h1 == F.col("k1")) & (rows.h2 == F.col("k2")), "left").selectExpr(
        "doc_id", "text_hash", "line_no",
        "near_first IS NOT NULL AS near",
        "near_first IS NULL AND first < struct(doc_id, line_no, text_hash) AS exact",
        "coalesce(near_first, first).doc_id AS first_doc",
    )
    return judged.groupBy("doc_id", "text_hash").agg(
        F.expr("CAST(max(line_no) + 1 AS BIGINT)").alias("n_lines"),
        F.expr("CAST(size(collect_set(CASE WHEN exact THEN line_no END)) AS BIGINT)").alias("n_exact"),
        F.expr("CAST(size(collect_set(CASE WHEN near THEN line_no END)) AS BIGINT)").alias("n_near"),
        F.expr("sort_array(collect_set(CASE WHEN exact OR near THEN line_no END))").alias("removed_lines"),
        F.expr("sort_array(collect_set(CASE WHEN exact OR near THEN first_doc END))").alias("first_docs"),
    )


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """`docs` without the removed lines and with n_chars, if it has one, set anew.

    A document that had words and has none left goes. Places that stay come from a hashed set difference, so long
    documents cost no more a line than short ones.
    """
    gone_id, gone_hash, own_hash, gone, parts = unused(docs, "gone_id", "gone_hash", "own_hash", "gone", "parts")
    found = removed.where("size(removed_lines) > 0").selectExpr(
        f"doc_id AS {gone_id}", f"text_hash AS {gone_hash}", f"removed_lines AS {gone}"
    )
    hashed = docs.withColumn(own_hash, F.expr("xxhash64(coalesce(text, ''))"))
    joined = hashed.join(
        found, hashed.doc_id.eqNullSafe(found[gone_id]) & (hashed[own_hash] == found[gone_hash]), "left"
    )
    split = joined.withColumn(parts, F.expr(rf"CASE WHEN {gone} IS NOT NULL THEN split(text, '\n') END"))
    left = (
        f"array_join(transform(array_except(sequence(0, size({parts}) - 1), {gone}), i -> {parts}[i]), '\\n')"
    )
    kept = split.withColumn("text", F.expr(f"CASE WHEN {gone} IS NULL THEN text ELSE {left} END")).where(
        rf"{gone} IS NULL OR text RLIKE '[^\\x20\\x09-\\x0D]'"
    )
    if "n_chars" in docs.columns:
        kept = kept.withColumn(
            "n_chars", F.expr(f"CASE WHEN {gone} IS NULL THEN n_chars ELSE CAST(length(text) AS BIGINT) END")
        )
    return kept.select(*docs.columns)
