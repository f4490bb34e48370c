"""Chat formatting: reply trees, ranked branches, one training text per chosen path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.text import literal, materialise

# The control strings of the template.
START = "<|im_start|>"
END = "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape_sql(column: str) -> str:
    """Texts in which no control string is left: a backslash is doubled, `<|` gets one inside."""
    return rf"replace(replace({column}, '\\', '\\\\'), '<|', '<\\|')"


def unescape_sql(column: str) -> str:
    return rf"regexp_replace({column}, '\\\\([\\\\|])', '$1')"


def escape_role_sql(column: str) -> str:
    """Roles end at the first line break of a turn, so theirs are written as `\\n`."""
    return rf"replace({escape_sql(column)}, '\n', '\\n')"


def unescape_role_sql(column: str) -> str:
    """Break marks back first; the pair of backslashes before an `n` is not one."""
    return rf"regexp_replace(regexp_replace({column}, '(?<!\\\\)((?:\\\\\\\\)*)\\\\n', '$1\n'), '\\\\([\\\\|])', '$1')"


def linear_tree(conversations: DataFrame) -> DataFrame:
    """Rows by turn as reply trees that do not branch: tree_id, node, parent, score, role, text.

    Turns stand in the order of turn, role and text, nulls first; a repeated turn is a turn of its own.
    """
    placed = conversations.selectExpr(
        "conv_id AS tree_id",
        "CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS BIGINT) AS node",
        "role",
        "text",
    )
    return placed.selectExpr(
        "tree_id", "node", "CASE WHEN node > 1 THEN node - 1 END AS parent", "0.0D AS score", "role", "text"
    )


def branch_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The nodes of the best branches of each tree: tree_id, branch (1 is best), leaf, node, depth, path_score.

    A branch is the path from a root to a leaf; its score is the sum of its nodes' scores, ties go to the smaller leaf.
    Self-joins double the distance a pointer looks up, so a tree of depth d takes log2(d) of them: the first ones sum
    the scores above each node, the later ones walk from the chosen leaves to their roots. A node that has reached its
    root is not joined again. Every round is written to the shared folder. A node whose parent is missing is a root; nodes on a cycle have no leaf below them and are left
    out. Node ids are unique within a tree.
    """
    jumps = [
        materialise(nodes.selectExpr("tree_id", "node", "parent AS up", "coalesce(score, 0.0D) AS total", "1L AS steps"), "tree")
    ]
    here = jumps[0].alias("h")
    known = jumps[0].selectExpr("tree_id AS t", "node AS n")
    pointers = (
        here.join(known, F.col("h.tree_id").eqNullSafe(F.col("t")) & (F.col("h.up") == F.col("n")), "left")
        .selectExpr("h.tree_id AS tree_id", "h.node AS node", "n AS up", "total", "steps")
    )
    jumps = [materialise(pointers, "tree")]
    finished = jumps[0].where("up IS NULL")
    active = jumps[0].where("up IS NOT NULL")
    n_nodes = None
    while not active.isEmpty():
        n_nodes = n_nodes or jumps[0].count()
        if 2 ** len(jumps) > 2 * n_nodes:  # deeper than there are nodes: only cycles are left
            break
        far = active.unionByName(finished).selectExpr("tree_id AS t", "node AS n", "up AS up2", "total AS total2", "steps AS steps2")
        doubled = active.join(far, active.tree_id.eqNullSafe(far.t) & (active.up == far.n)).selectExpr(
            "tree_id", "node", "up2 AS up", "total + total2 AS total", "steps + steps2 AS steps"
        )
        jumps.append(materialise(doubled, "tree"))
        finished = finished.unionByName(jumps[-1].where("up IS NULL"))
        active = jumps[-1].where("up IS NOT NULL")
    done = finished
    parents = jumps[0].where("up IS NOT NULL").selectExpr("tree_id AS t", "up AS n").distinct()
    leaves = done.join(parents, done.tree_id.eqNullSafe(parents.t) & (done.node == parents.n), "left_anti")
    chosen = leaves.selectExpr(
        "tree_id", "node", "total AS path_score", "steps AS length",
        "row_number() OVER (PARTITION BY tree_id ORDER BY total DESC, node) AS branch",
    ).where(F.col("branch") <= branches)
    walk = chosen.selectExpr("tree_id", "branch", "node AS leaf", "node", "length AS depth", "path_score")
    for k in reversed(range(len(jumps) - 1)):
        step = jumps[k].where("up IS NOT NULL").selectExpr("tree_id AS t", "node AS n", "up")
        above = walk.join(step, walk.tree_id.eqNullSafe(step.t) & (walk.node == step.n)).selectExpr(
            "tree_id", "branch", "leaf", "up AS node", f"depth - {2**k}L AS depth", "path_score"
        )
        walk = materialise(walk.unionByName(above), "walk")
    return walk


def format_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """One training text per chosen path: tree_id, branch, path_score, formatted, loss_spans.

    A turn is written `<|im_start|>role\\ntext<|im_end|>\\n` with role and text escaped. `loss_spans` holds start
    (from 1) and length, in characters of `formatted`, of each text by the assistant. Null roles and texts are empty.
    """
    own = nodes.selectExpr("tree_id AS t", "node AS n", "coalesce(role, '') AS role", "coalesce(text, '') AS text")
    turns = paths.join(own, paths.tree_id.eqNullSafe(own.t) & (paths.node == own.n))
    head, tail = literal(START), literal(END + "\n")
    turns = turns.selectExpr(
        "tree_id", "branch", "path_score", "depth",
        rf"concat({head}, {escape_role_sql('role')}, '\n') AS opening",
        f"{escape_sql('text')} AS body",
        f"role = {literal(LEARNED_ROLE)} AS learned",
    )
    gathered = turns.groupBy("tree_id", "branch").agg(
        F.max("path_score").alias("path_score"),
        F.sort_array(F.collect_list(F.struct("depth", "opening", "body", "learned"))).alias("turns"),
    )
    pieces = gathered.selectExpr(
        "tree_id", "branch", "path_score",
        f"array_join(transform(turns, t -> concat(t.opening, t.body, {tail})), '') AS formatted",
        "aggregate(turns, named_struct('place', 1, 'spans', CAST(array() AS ARRAY<STRUCT<start: INT, length: INT>>)),"
        " (s, t) -> named_struct("
        f"'place', s.place + length(t.opening) + length(t.body) + {len(END) + 1},"
        " 'spans', CASE WHEN t.learned THEN array_append(s.spans, named_struct('start', s.place + length(t.opening),"
        " 'length', length(t.body))) ELSE s.spans END), s -> s.spans) AS loss_spans",
    )
    return pieces


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns and the learned text, parsed from `formatted` and `loss_spans` alone."""
    end, start = literal(END + "\n").replace("|", "\\\\|"), len(START) + 1
    turns = formatted.selectExpr("*", f"filter(split(formatted, {end}), x -> x <> '') AS pieces").selectExpr(
        "*",
        r"transform(pieces, p -> named_struct('role', "
        + unescape_role_sql(rf"substr(p, {start}, instr(p, '\n') - {start})")
        + r", 'text', "
        + unescape_sql(r"substr(p, instr(p, '\n') + 1)")
        + ")) AS turns",
        "transform(loss_spans, s -> "
        + unescape_sql("substr(formatted, s.start, s.length)")
        + ") AS learned",
    )
    return turns.drop("pieces")


def format_conversations(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The best branches of every reply tree as training texts; see `branch_paths` and `format_paths`."""
    stored = materialise(nodes.select("tree_id", "node", "parent", "score", "role", "text"), "nodes")
    return format_paths(stored, branch_paths(stored, branches))
