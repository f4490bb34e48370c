"""Quality rules: a ledger of failure bits and measurements, read by versioned policies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.text import words_sql

#: Words in a window.
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """Fails where the SQL condition over the measurements holds; its place in the list is its bit."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails one of the named rules."""

    name: str
    version: int
    rules: tuple[str, ...]


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 6 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("shouting", "2 * n_upper > n_letters AND n_letters > 0"),
    Rule("few_letters", "10 * n_letters < 6 * word_chars"),
)
BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))
POLICIES = (BASE, STANDARD)


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    names = [r.name for r in rules]
    if missing := set(policy.rules) - set(names):
        raise ValueError(f"Policy {policy.name} names rules that are not in the ledger: {sorted(missing)}")
    return sum(1 << names.index(r) for r in policy.rules)


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id and what the rules look at, for every row of `docs`.

    All counts are taken inside the row, so no document is split or shuffled. Windows of three words are compared by
    64-bit hashes; only a document that repeats one sorts them. Null and empty texts measure 0 everywhere.
    """
    letters = r"[^\\p{L}]+"
    parts = docs.selectExpr(
        "doc_id",
        f"{words_sql('text')} AS words",
        "coalesce(text, '') AS text",
        r"filter(split(coalesce(text, ''), '\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]') AS lines",
        f"regexp_replace(coalesce(text, ''), '{letters}', '') AS letters",
    )
    counted = parts.selectExpr(
        "doc_id",
        "CAST(size(words) AS BIGINT) AS n_words",
        "CAST(length(array_join(words, '')) AS BIGINT) AS word_chars",
        "CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '')) AS BIGINT) AS n_symbols",
        "CAST(size(lines) AS BIGINT) AS n_lines",
        "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines",
        "CAST(length(letters) AS BIGINT) AS n_letters",
        r"CAST(length(regexp_replace(letters, '[^\\p{Lu}]+', '')) AS BIGINT) AS n_upper",
        f"CASE WHEN size(words) < {WINDOW} THEN array() ELSE transform(sequence(0, size(words) - {WINDOW}),"
        " i -> xxhash64(words[i], words[i + 1], words[i + 2])) END AS windows",
    )
    in_order = counted.selectExpr(
        "* EXCEPT (windows)",
        "CASE WHEN size(array_distinct(windows)) < size(windows)"
        " THEN sort_array(transform(windows, (x, i) -> struct(x, i))) END AS by_window",
    )
    repeated = in_order.selectExpr(
        "* EXCEPT (by_window)",
        "filter(by_window, (e, k) -> coalesce(get(by_window, k - 1).x = e.x, false)"
        " OR coalesce(get(by_window, k + 1).x = e.x, false)) AS found",
    )
    spread = ", ".join(f"e.i + {k}" for k in range(WINDOW))
    return repeated.selectExpr(
        "* EXCEPT (found)",
        f"CAST(coalesce(size(array_distinct(flatten(transform(found, e -> array({spread}))))), 0) AS BIGINT)"
        " AS n_repeat_words",
    )


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measurements and `failed_bits`: bit k is set where rule k fails. Each rule is evaluated once per row.

    One row per row of `docs`, repeated rows included; columns other than doc_id and text are ignored.
    """
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << k}L ELSE 0L END" for k, r in enumerate(rules))
    return measurements(docs).selectExpr("*", f"{bits} AS failed_bits")


def verdicts(entries: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES, column: str = "kept") -> DataFrame:
    """The ledger with a policy's verdict; no text is read again."""
    return entries.withColumn(column, F.expr(f"failed_bits & {mask(policy, rules)}L = 0"))


def ablations(entries: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule costs under each policy: documents it fails, fails alone, and what is kept with and without it.

    Documents are first counted by their bits, so policies and rules meet a table of at most 2 ** rules rows.
    """
    patterns = entries.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cells = [
        f"('{p.name}', {p.version}, {mask(p, rules)}L, '{r.name}', {1 << k}L)"
        for p in policies
        for k, r in enumerate(rules)
        if r.name in p.rules
    ]
    listed = f"array({', '.join(f'struct{c}' for c in cells)})"
    return (
        patterns.selectExpr("*", f"explode({listed}) AS c")
        .selectExpr("failed_bits", "n", "c.col1 AS policy", "c.col2 AS version", "c.col3 AS m", "c.col4 AS rule", "c.col5 AS b")
        .groupBy("policy", "version", "rule")
        .agg(
            F.expr("sum(CASE WHEN failed_bits & b <> 0 THEN n ELSE 0 END)").alias("n_failed"),
            F.expr("sum(CASE WHEN failed_bits & m = b THEN n ELSE 0 END)").alias("n_failed_alone"),
            F.expr("sum(CASE WHEN failed_bits & m = 0 THEN n ELSE 0 END)").alias("n_kept"),
            F.expr("sum(CASE WHEN failed_bits & (m & ~b) = 0 THEN n ELSE 0 END)").alias("n_kept_without"),
        )
    )
