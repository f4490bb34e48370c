"""Parsing, bounds, hashes and rounding on single cells."""

import math
import random
from datetime import date
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from coverlake.functions import cells, exact, keys, names


def evaluate(spark, expression, values):
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in frame.select(F.expr(expression)).collect()]


@pytest.mark.parametrize(
    "build, cases",
    [
        (cells.to_double, {
            "12.5": 12.5, " 7 ": 7.0, "\t-1e3\n": -1000.0, ".5": 0.5, "5.": 5.0, "+2": 2.0, "": None, "nan": None,
            "NaN": None, "1d": None, "1_000": None, "inf": None, "abc": None, "0x10": None, " 3 ": 3.0, None: None,
        }),
        (cells.to_int, {"3": 3, " 4 ": 4, "3.0": 3, "1e1": 10, "2.5": None, "x": None, "99999999999": None, None: None}),
        (cells.to_date, {
            "2024-02-29": date(2024, 2, 29), "2024-02-30": None, "15/06/2023": None, "2024-1-5": None,
            "2024-01-05 10:00": date(2024, 1, 5), "2024-01-05T10:00:01.5": date(2024, 1, 5), "2024-01-05 25:00": None,
            "9999-12-31": date(9999, 12, 31), "1677-09-22": date(1677, 9, 22), "": None, None: None,
        }),
        (cells.to_bool, {
            "True": True, "1": True, "YES": True, "false": False, "0": False, "No": False, "y": None, " true": None,
            "": None, None: None,
        }),
        (cells.null_tokens, {"": None, "None": None, "nan": None, "NaN": None, "NULL": None, "null": "null", "  ": "  "}),
        (cells.upper_strip, {" pol-1 ": "POL-1", "\tab\n": "AB", " x　": "X", "ok": "OK", "": "", "é ": "É", None: None}),
    ],
)
def test_cell_functions(spark, build, cases):
    assert dict(zip(cases, evaluate(spark, build("x"), list(cases)))) == cases


def test_clip_keeps_null(spark):
    rows = spark.sql(f"SELECT {cells.clip('v', 0, 1)} FROM VALUES (-1D), (0.5D), (2D), (CAST(NULL AS DOUBLE)) AS t(v)")
    assert [r[0] for r in rows.collect()] == [0.0, 0.5, 1.0, None]


def test_ratio_needs_a_positive_denominator(spark):
    rows = spark.sql(f"SELECT {cells.bounded_ratio('a', 'b')} FROM VALUES (1D, 2D), (3D, 2D), (1D, 0D), (1D, -1D), (NULL, 1D) AS t(a, b)")
    assert [r[0] for r in rows.collect()] == [0.5, 1.0, None, None, None]


def test_hash_and_surrogate_key(spark):
    row = spark.sql(
        f"SELECT {keys.row_hash('a')} AS h, {keys.row_hash('n')} AS hn, {keys.surrogate_key('a', 'b')} AS sk, "
        f"{keys.surrogate_key('a', 'n')} AS none FROM VALUES ('POL-00000001', 'Alice', CAST(NULL AS STRING)) AS t(a, b, n)"
    ).first()
    assert row.h == "6dd2fb82d553dfd164ec67377dfef470cb5844e8bd8e3e83caf40c2450c6a42a"
    assert row.hn == spark.sql("SELECT sha2('None', 256)").first()[0]
    assert row.sk == 140388181 and row.none is None


def test_sums_are_whole_and_repeatable(spark):
    rows = spark.sql(f"SELECT g, {cells.exact_sum('v')} AS s FROM VALUES ('a', 0.1D), ('a', 0.2D), ('b', CAST(NULL AS DOUBLE)), ('c', 1e30D), ('c', 1D) AS t(g, v) GROUP BY g")
    assert {r.g: r.s for r in rows.collect()} == {"a": 0.3, "b": 0.0, "c": 1e30 + 1}
    assert spark.sql("SELECT bround(2.25D, 1)").first()[0] == 2.2


def test_sums_of_any_size_are_rounded_once_whatever_the_order(spark):
    r = random.Random(1)
    rows = [(None, None), (99, None), (98, float("inf")), (98, 1.0), (97, float("inf")), (97, float("-inf"))]
    for g in range(60):
        for _ in range(r.randint(1, 30)):
            v = (
                r.choice((-1, 1)) * r.random() * 10.0 ** r.randint(-300, 307) if g % 3 == 0
                else round(r.uniform(-1e6, 1e6), r.randint(0, 8)) if g % 3 == 1
                else r.uniform(-1, 1) * 10.0 ** r.randint(10, 40)
            )
            rows += [(g, v), (g, -v)] if r.random() < 0.3 else [(g, v)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    got = {x.g: x for x in exact.grouped_sums(df, ["g"], {"s": "v"}, {"n": F.count("v")}).collect()}
    alone = {x.g: x.s for x in df.groupBy("g").agg(F.expr(cells.exact_sum("v")).alias("s")).collect()}
    for g in range(60):
        amounts = [Decimal(repr(v)) for k, v in rows if k == g]
        whole = sum(Fraction(a if abs(a) >= 10**15 else a.quantize(Decimal("1e-8"), "ROUND_HALF_UP")) for a in amounts)
        assert got[g].s == float(whole) == alone[g] and got[g].n == len(amounts)
    assert (got[None].s, got[99].s, got[99].n, got[98].s) == (0.0, 0.0, 0, float("inf")) and math.isnan(got[97].s)


def test_names_and_paths(spark):
    row = spark.sql("SELECT DATE '2026-05-04' AS d, 'lake/bronze/in/p/year=2026/month=05/day=04/f.csv' AS p").select(
        names.expected_name(F.lit("policies_%Y%m%d.csv.gpg"), F.col("d")).alias("name"),
        names.path_date(F.col("p")).alias("day"),
        names.path_date(F.lit("x/year=2026/month=13/day=40/f.csv")).alias("bad"),
        names.path_date(F.lit("x/year=2026/month=01/f.csv")).alias("short"),
        names.uri_directory(F.lit("gs://bucket/bronze/inbound/f.csv")).alias("dir"),
        names.uri_prefix(F.lit("gs://bucket/bronze/inbound/f.csv")).alias("prefix"),
        names.plain_path(F.lit("file:/a%20b+c")).alias("plain"),
        names.compact_date(F.col("d")).alias("compact"),
        names.iso_date(F.col("d")).alias("iso"),
    ).first()
    assert tuple(row) == (
        "policies_20260504.csv.gpg", date(2026, 5, 4), None, None, "inbound", "bucket/bronze/inbound", "file:/a b+c",
        "20260504", "2026-05-04",
    )
