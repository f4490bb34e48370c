"""URL filters: host and path rules, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.llm.text import literal, lower_ascii_sql

#: Length of the hashed n-grams and size of the hash space.
GRAM = 4
FEATURES = 1 << 17
#: At most so many distinct labelled urls are used for training, the first by hash.
TRAINING_URLS = 5000
BLOCK_FROM = 0.5

# Words of the labelled url table.
UNWANTED = (
    "ads", "track", "adult", "xxx", "porn", "sex", "escort", "casino", "win", "poker", "slots", "bets", "free",
    "jackpot", "lottery", "betting", "pills", "cheap", "viagra", "pharma", "spam", "farm", "clicks", "banner", "popup",
    "replica", "warez", "crack", "keygen", "torrent", "malware", "phish", "prize", "payday", "loans", "dating", "hot",
    "bonus", "hack", "fake", "deals", "pixel", "adserver", "tracker",
)
WANTED = (
    "news", "docs", "wiki", "school", "library", "museum", "weather", "recipes", "garden", "history", "science",
    "physics", "maths", "music", "travel", "sports", "health", "city", "council", "open", "data", "python", "linux",
    "forum", "support", "help", "research", "journal", "press", "radio", "films", "books", "poems", "nature", "birds",
    "maps", "trains", "energy", "climate", "law", "court", "tax", "jobs", "house", "bank", "shop", "photo", "design",
    "theatre", "opera", "ocean", "river", "stone", "metal", "wood", "paper", "bread", "cheese", "tea", "coffee",
    "paint", "plant", "content", "parent", "event", "student", "agent", "month", "north", "truth", "width", "tenth",
    "earth", "growth", "weight", "light", "bright", "theory", "leather", "river-end", "handout", "worship", "shore",
    "whale", "stream", "ready", "ribbon", "ocean-side", "the", "thread", "throne", "theme",
    "other", "station", "nation", "there", "thing", "another", "together", "table", "inside", "writer",
)
HOST_SHAPES = ("{}.example.com", "www.{}.example.org", "m.{}.example.net", "blog.{}.example.com")
PATH_SHAPES = ("/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/en/{}.html", "/en/{}/", "/de/{}", "/{}", "")


@dataclass(frozen=True)
class UrlRule:
    """Holds for a host with its subdomains and for paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with host and path. A null url, or one without `://`, has neither and gets empty strings."""
    rest = f"substr({url}, instr({url}, '://') + 3)"
    found = f"coalesce(instr({url}, '://'), 0) > 0"
    return pages.withColumn(
        "host", F.expr(f"CASE WHEN {found} THEN {lower_ascii_sql(f'''regexp_extract({rest}, '^[^/?#]*', 0)''')} ELSE '' END")
    ).withColumn("path", F.expr(f"CASE WHEN {found} THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END"))


def match_rules(places: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """The longest rule of each (host, path): host, path, rule, rule_verdict.

    Each host is listed with the domains above it and joined on the rule's host, so work does not grow with the number
    of rules. Of rules of one length the first by name wins.
    """
    rows = ", ".join(f"({literal(r.host)}, {literal(r.path)}, {literal(r.name)}, {literal(r.verdict)})" for r in rules)
    listed = places.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(rule_host, rule_path, rule, rule_verdict)")
    labels = r"split(host, '\\.')"
    domains = places.select("host", "path").distinct().selectExpr(
        "host", "path",
        f"explode(transform(sequence(1, size({labels})), i -> array_join(slice({labels}, i, size({labels})), '.')))"
        " AS rule_host",
    )
    return (
        domains.join(listed, "rule_host")
        .where("startswith(path, rule_path)")
        .groupBy("host", "path")
        .agg(F.expr("min(struct(-length(rule) AS shortness, rule, rule_verdict)) AS best"))
        .selectExpr("host", "path", "best.rule AS rule", "best.rule_verdict AS rule_verdict")
    )


def grams_sql() -> str:
    """Character n-grams of the marked host and path; the marks tell a host's start and end from a path's, numbers
    in paths are all alike."""
    marked = "concat('^', host, '|', regexp_replace(path, '[0-9]+', '0'), '$')"
    return f"transform(sequence(1, greatest(length({marked}) - {GRAM - 1}, 1)), i -> substr({marked}, i, {GRAM}))"


def _vectors(places: DataFrame) -> DataFrame:
    hashed = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    return hashed.transform(places.withColumn("grams", F.expr(grams_sql()))).drop("grams")


def labelled_table(spark: SparkSession) -> DataFrame:
    """The labelled urls as host, path and label, 1 for unwanted: each word, or it and its neighbour, in each shape."""
    rows = []
    for label, words in ((1.0, UNWANTED), (0.0, WANTED)):
        for k, word in enumerate(words):
            for j, shape in enumerate(HOST_SHAPES):
                name = word if (j + k) % 2 else f"{word}-{words[(k + 1) % len(words)]}"
                path = PATH_SHAPES[(k + 2 * j) % len(PATH_SHAPES)]
                rows.append(f"('{shape.format(name)}', '{path.format(100 + 37 * k + j)}', {label}D)")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(host, path, label)")


def train(labelled: DataFrame, most_urls: int = TRAINING_URLS) -> LogisticRegressionModel | float:
    """A model from rows (host, path, label), label 1 to block; a constant where only one label is there.

    Repeated places count once with their mean label; the table is cut to `most_urls` places by hash.
    """
    places = labelled.groupBy("host", "path").agg(F.avg("label").alias("share"))
    bounded = (
        places.selectExpr("host", "path", "CASE WHEN share >= 0.5D THEN 1.0D ELSE 0.0D END AS label")
        .orderBy(F.xxhash64("host", "path"), "host", "path")
        .limit(most_urls)
    )
    bounded = _vectors(bounded).coalesce(1).cache()
    low, high, n = bounded.agg(F.min("label"), F.max("label"), F.count("*")).first()
    if not n or low == high:
        return float(low or 0.0)
    model = LogisticRegression(maxIter=40, regParam=0.001).fit(bounded)
    bounded.unpersist()
    return model


def judge(places: DataFrame, model: LogisticRegressionModel | float) -> DataFrame:
    """The distinct (host, path) with the model's probability to block."""
    distinct = places.select("host", "path").distinct()
    if isinstance(model, float):
        return distinct.withColumn("block_score", F.lit(model))
    scored = model.transform(_vectors(distinct))
    return scored.select("host", "path", vector_to_array("probability")[1].alias("block_score"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule] = RULES,
    labelled: DataFrame | None = None,
    block_from: float = BLOCK_FROM,
) -> DataFrame:
    """A verdict on every url: page_id, host, path, rule, verdict, block_score.

    Rules come first, the longest of those that fit; the regression decides the rest. `labelled` (host, path, label)
    is its training table, by default `labelled_table`. Distinct places are judged once. Rows with a null url are judged as an empty place; repeated rows stay.
    """
    parsed = host_and_path(pages.select("page_id", "url"))
    places = parsed.select("host", "path").distinct()
    ruled = match_rules(places, rules)
    scores = judge(places, train(labelled_table(pages.sparkSession) if labelled is None else labelled))
    facts = scores.join(ruled, ["host", "path"], "left")
    return parsed.join(facts, ["host", "path"]).selectExpr(
        "page_id", "host", "path", "rule",
        f"coalesce(rule_verdict, CASE WHEN block_score >= {block_from}D THEN 'block' ELSE 'allow' END) AS verdict",
        "block_score",
    )
