"""Licence scans: Dice coefficient over word bigrams against templates, for runs of words anywhere in a text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.license_texts import TEMPLATES
from coverlake.llm.text import literal, materialise

THRESHOLD_PERCENT = 80
#: Below one, by which the last place of a run still counts in spite of rounding in the window's order.
SLACK = 1e-6


def normal_sql(column: str) -> str:
    """Lower case; whatever is no letter or digit is one space."""
    return rf"trim(regexp_replace(lower(coalesce({column}, '')), '[^\\p{{L}}\\p{{N}}]+', ' '))"


def bigrams_sql(words: str) -> str:
    """Hashes of the pairs of neighbouring words."""
    return (
        f"zip_with(slice({words}, 1, size({words}) - 1), slice({words}, 2, size({words}) - 1), (a, b) -> xxhash64(a, b))"
    )


def least_shared_sql(n: str, t: int) -> str:
    """Of a template of n bigrams, how many a run needs for Dice t: 2s >= t(n + m) and m >= s."""
    return f"CAST(ceil({n} * {t}D / {200 - t}) AS INT)"


def reach_sql(n: str, t: int) -> str:
    """How many bigrams a run can have at Dice t with a template of n: 2n >= 2s >= t(n + m)."""
    return f"CAST(floor({n} * {200 - t}D / {t}) AS INT)"


def anchor_words(templates: Sequence[tuple[str, str]], threshold_percent: int) -> list[str]:
    """Words of which every run that reaches the threshold has at least one.

    A run shares at least n * t / (2 - t) of a template's n bigrams, so it shares one of any larger rest. A template's
    words are taken, long ones first, until they touch so many bigrams.
    """
    found = set()
    for _, text in templates:
        words = re.findall(r"[^\W_]+", text.lower())
        n = len(words) - 1
        touched: set[int] = set()
        for word in sorted(set(words), key=lambda w: (w not in found, -len(w), w)):
            if (n - len(touched)) * (200 - threshold_percent) < n * threshold_percent:
                break
            found.add(word)
            touched |= {i for i in range(n) if word in words[i : i + 2]}
    return sorted(found)


def template_table(spark, templates: Sequence[tuple[str, str]], threshold_percent: int) -> DataFrame:
    """Bigrams of the templates, a parameter of the scan and so of known size: template, license, pair, wanted, n, reach."""
    rows = ", ".join(f"({k}, {literal(name)}, {literal(text)})" for k, (name, text) in enumerate(templates))
    words = spark.sql(f"SELECT * FROM VALUES {rows} AS t(template, license, text)").selectExpr(
        "template", "license", f"split({normal_sql('text')}, ' ') AS words"
    )
    pairs = words.selectExpr("template", "license", "size(words) - 1 AS n", f"explode({bigrams_sql('words')}) AS pair")
    return pairs.groupBy("template", "license", "n", "pair").agg(F.expr("CAST(count(*) AS INT)").alias("wanted")).selectExpr(
        "*", f"{reach_sql('n', threshold_percent)} AS reach"
    )


def template_hits(docs: DataFrame, templates: Sequence[tuple[str, str]], threshold_percent: int) -> DataFrame:
    """Where a document has a bigram of a template, once for each different (doc_id, text).

    Texts without any anchor word are left out before they are normalised or split.
    """
    spark = docs.sparkSession
    anchors = anchor_words(templates, threshold_percent)
    has_anchor = " OR ".join(f"contains(plain, {literal(word)})" for word in anchors) or "false"
    words = (
        docs.selectExpr("doc_id", "text", "lower(text) AS plain")
        .where(has_anchor)
        .selectExpr("doc_id", "xxhash64(text) AS text_hash", f"split({normal_sql('text')}, ' ') AS words")
    )
    pairs = words.selectExpr("doc_id", "text_hash", f"posexplode({bigrams_sql('words')}) AS (pos, pair)")
    wanted = F.broadcast(template_table(spark, templates, threshold_percent))
    return pairs.join(wanted, "pair").distinct()


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold_percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """Licences each document carries: doc_id, license, dice, n_places, first_word.

    Texts are compared in lower case, with whatever is no letter or digit, line breaks included, as one space; so a
    notice is found alone, wrapped over lines and inside longer paragraphs. A run goes from one bigram of a template to
    another; at a Dice coefficient of t, a template of n bigrams can only match runs of n * t / (2 - t) to
    n * (2 - t) / t bigrams. For each start whose surroundings hold enough of them, the end is taken at which the share
    of the template's bigrams is largest, the earlier of equals, and the run is then compared as a multiset. Runs that
    overlap are one place, which counts for the template with the highest coefficient, then the longer one, then the
    first by name. `dice` is the best of a licence's places, `first_word` the number, from 0, of the word at which the
    first of them begins.

    Texts of one word and null texts match nothing; rows with the same id are counted together, equal rows once;
    columns other than doc_id and text are ignored. Bigrams are told apart by 64-bit hashes.
    """
    t = threshold_percent
    key = "doc_id, text_hash, template"
    frame = f"OVER (PARTITION BY {key} ORDER BY at RANGE BETWEEN CURRENT ROW AND {1 - SLACK}D FOLLOWING)"
    hits = materialise(
        template_hits(docs, templates, t)
        .selectExpr("*", "pos / CAST(reach AS DOUBLE) AS at")
        .selectExpr(
            "doc_id", "text_hash", "template", "license", "pos", "pair", "wanted", "n", "reach",
            f"row_number() OVER (PARTITION BY {key} ORDER BY at) AS place",
            f"count(*) {frame} AS ahead",
            "pos DIV reach AS block",
        ),
        "license-hits",
    )

    def within(runs: DataFrame) -> DataFrame:
        """Runs with all hits in their reach; each run is looked up in the two blocks it may lie in."""
        asked = runs.selectExpr("*", "explode(array(first DIV reach, first DIV reach + 1)) AS in_block")
        found = hits.selectExpr(
            "doc_id AS d", "text_hash AS h", "template AS k", "block", "pos", "pair", "wanted", "place"
        )
        return asked.join(
            found,
            asked.doc_id.eqNullSafe(found.d) & (asked.text_hash == found.h) & (asked.template == found.k)
            & (asked.in_block == found.block) & F.expr("pos BETWEEN first AND last"),
        )

    starts = hits.where(f"ahead >= {least_shared_sql('n', t)}").selectExpr(
        "doc_id", "text_hash", "template", "license", "n", "reach",
        "pos AS first", "pos + reach - 1 AS last", "place AS first_place",
    )
    run = ["doc_id", "text_hash", "template", "license", "n", "reach", "first"]
    runs = (
        within(starts)
        .selectExpr(*run, "pos", "place - first_place + 1 AS shared", "pos - first + 1 AS m")
        .where(f"200 * shared >= {t} * (n + m)")
        .groupBy(*run)
        .agg(F.expr("-max(struct(shared / CAST(n + m AS DOUBLE) AS share, -pos AS before)).before").alias("last"))
    )
    scored = (
        within(runs)
        .groupBy(*run, "last", "pair")
        .agg(F.expr("least(count(*), any_value(wanted))").alias("shared"))
        .groupBy(*run, "last")
        .agg(F.sum("shared").alias("shared"))
        .selectExpr("*", "2.0D * shared / (n + last - first + 1) AS dice")
        .where(f"200 * shared >= {t} * (n + last - first + 1)")
    )
    document = "PARTITION BY doc_id, text_hash"
    placed = scored.selectExpr(
        "*",
        f"max(last) OVER ({document} ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached",
    ).selectExpr(
        "*",
        f"sum(CASE WHEN reached >= first THEN 0 ELSE 1 END) OVER ({document} ORDER BY first, last"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island",
    )
    best = placed.groupBy("doc_id", "text_hash", "island").agg(
        F.expr("min(struct(-dice AS cost, -n AS shorter, license, first))").alias("best")
    )
    return best.groupBy("doc_id", F.col("best.license").alias("license")).agg(
        F.max(-F.col("best.cost")).alias("dice"),
        F.count("*").alias("n_places"),
        F.min("best.first").alias("first_word"),
    )
