"""The gate: one bad value rejects the file, every failure is listed."""

import csv

import pytest
from pyspark.sql import functions as F

from conftest import CLAIMS, POLICIES, PREMIUMS, REINSURANCE, ROWS
from coverlake.checks import queries
from coverlake.operators import gate
from coverlake.sources.raw_csv import read_csv_files
from coverlake.specs import REGISTRY

BAD = [
    ("policies", dict(POLICIES[0], policy_id="INVALID-001"), "policy_id"),
    ("policies", dict(POLICIES[0], premium_amount="-500"), "premium_amount"),
    ("policies", dict(POLICIES[0], coverage_type="EXOTIC"), "coverage_type"),
    ("policies", dict(POLICIES[0], risk_score="1.5"), "risk_score"),
    ("policies", dict(POLICIES[0], insured_name="N/A"), "insured_name"),
    ("policies", dict(POLICIES[0], policy_start_date="1999-12-31"), "policy_start_date"),
    ("claims", dict(CLAIMS[0], claim_id="C-001"), "claim_id"),
    ("claims", dict(CLAIMS[0], status="UNKNOWN_STATUS"), "status"),
    ("claims", dict(CLAIMS[0], claimed_amount="50000000"), "claimed_amount"),
    ("premiums", dict(PREMIUMS[0], amount_due="0"), "amount_due"),
    ("premiums", dict(PREMIUMS[0], currency="EURO"), "currency"),
    ("premiums", dict(PREMIUMS[0], instalment_number="2.0"), "instalment_number"),
    ("premiums", dict(PREMIUMS[0], instalment_total="13"), "instalment_total"),
    ("premiums", dict(PREMIUMS[0], due_date="soon"), "due_date"),
    ("reinsurance", dict(REINSURANCE[0], cession_percentage="110"), "cession_percentage"),
    ("reinsurance", dict(REINSURANCE[0], treaty_type="PROPORTIONAL"), "treaty_type"),
    ("reinsurance", dict(REINSURANCE[0], reinsurer_id="RNS-mun001"), "reinsurer_id"),
]


def test_every_bad_value_is_listed_and_rejects_its_file(raw):
    for entity in REGISTRY:
        cases = [(row, column) for e, row, column in BAD if e == entity]
        frame = raw(entity, source="good.csv")
        for n, (row, _) in enumerate(cases):
            frame = frame.unionByName(raw(entity, [row], f"bad{n}.csv"))
        found = sorted((r.source_file, r.column_name) for r in gate.violations(frame, REGISTRY[entity]).collect())
        assert found == sorted((f"bad{n}.csv", column) for n, (_, column) in enumerate(cases))
        verdicts = {r.source_file: r.accepted for r in gate.file_stats(frame, REGISTRY[entity]).collect()}
        assert verdicts == {"good.csv": True, **{f"bad{n}.csv": False for n in range(len(cases))}}


def test_optional_directory_column(raw):
    for entity, rows in ROWS.items():
        for value in ("inbound", ""):
            frame = raw(entity, [dict(r, dir_id=value) for r in rows])
            stats = gate.file_stats(frame, REGISTRY[entity]).first()
            assert stats.accepted and stats.rows_valid == len(rows) and "dir_id" in stats["columns"]


def test_stats_add_up_and_bad_rows_count_once(raw):
    rows = [PREMIUMS[0], dict(PREMIUMS[0], amount_due="0", currency="EURO"), PREMIUMS[1], dict(PREMIUMS[1], premium_id="")]
    stats = gate.file_stats(raw("premiums", rows), REGISTRY["premiums"]).first()
    assert (stats.rows_raw, stats.rows_valid, stats.rows_dropped) == (4, 1, 3)
    assert stats.rows_valid + stats.rows_dropped == stats.rows_raw


def test_a_missing_column_in_the_frame_rejects(raw):
    frame = raw("policies").drop("status")
    assert not gate.file_stats(frame, REGISTRY["policies"]).first().accepted


@pytest.mark.parametrize("copies", [2, 25001])
def test_repeated_keys_are_listed_once_per_row(spark, raw, copies):
    frame = raw("claims", [CLAIMS[0]]).drop("_row_id").crossJoin(spark.range(copies).withColumnRenamed("id", "_row_id"))
    other = raw("claims", [CLAIMS[0]], "other.csv")
    found = gate.violations(frame.unionByName(other), REGISTRY["claims"])
    summary = found.groupBy("source_file", "row_key", "column_name", "check_name").agg(F.count("*").alias("n")).collect()
    assert [tuple(r) for r in summary] == [("claims_20260514.csv", "CLM-20260001", "claim_id", "field_uniqueness", copies)]
    accepted, rejected = gate.split_by_verdict(frame.unionByName(other), gate.file_stats(frame.unionByName(other), REGISTRY["claims"]))
    assert (accepted.count(), rejected.count()) == (1, copies)


def test_failures_carry_the_position_a_plain_reader_counts(spark, tmp_path):
    """Files of many splits, with blank lines and quoted line breaks, rows without a key and repeated keys."""
    wanted = []
    for name, break_lines in (("claims_a.csv", False), ("claims_b.csv", True)):
        lines = [",".join(CLAIMS[0])]
        for i in range(900):
            row = dict(CLAIMS[0], claim_id=f"CLM-{i:08d}")
            if i % 97 == 5:
                row["claim_id"] = ""
            if i % 101 == 7:
                row["status"] = "NOWHERE"
            if i in (300, 800):
                row["claim_id"] = "CLM-99999999"
            if break_lines and i % 50 == 0:
                row["claimant_name"] = '"two\nlines"'
            lines.append(",".join(row.values()))
            if i % 40 == 0:
                lines.append("")
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        with open(tmp_path / name, newline="") as handle:
            plain = [r for r in csv.DictReader(handle)]
        for n, r in enumerate(plain):
            if not r["claim_id"]:
                wanted.append((name, n, None, "not_nullable"))
            if r["status"] == "NOWHERE":
                wanted.append((name, n, r["claim_id"] or None, "isin"))
            if r["claim_id"] == "CLM-99999999":
                wanted.append((name, n, r["claim_id"], "field_uniqueness"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
        files = spark.createDataFrame([(f"file:{tmp_path}/{n}", 0) for n in ("claims_a.csv", "claims_b.csv")], "path string, length long")
        rows = read_csv_files(spark, files)
        assert rows.select("_source_file", "_block_start").distinct().count() > 10
        found = gate.violations(rows, REGISTRY["claims"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = [(r.source_file.rpartition("/")[2], r.row_number, r.row_key, r.check_name.split("(")[0]) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_positions_in_a_month_that_many_tasks_write(spark, tmp_path, monkeypatch):
    events = spark.range(3000).selectExpr(
        "id AS event_id", "TIMESTAMP '2021-03-05 10:00:00' AS ts", "CASE WHEN id = 2500 THEN 7 ELSE id END AS user_id",
        "'view' AS event_type", "CASE WHEN id IN (3, 1701, 2999) THEN -1D ELSE 5D END AS value",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: str(tmp_path / label))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = queries.violation_positions(spark, str(tmp_path)).where("column_name = 'claimed_amount'")
        assert sorted((r.source_file, r.row_number, r.row_key) for r in found.collect()) == [
            ("202103", n, f"CLM-{n:08d}") for n in (3, 1701, 2999)
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "positions" / "month=202103").glob("*.csv"))) > 1
