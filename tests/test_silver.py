"""Silver: order of files and rows, null keys, extras, skew."""

import pytest
from pyspark.sql import functions as F

from conftest import CLAIMS, DAY, POLICIES, PREMIUMS
from coverlake.operators import gold, silver
from coverlake.specs import REGISTRY, EntitySpec, Field, get_spec, register


def test_last_row_of_the_last_file_wins(raw):
    early = raw("claims", [dict(CLAIMS[0], claimed_amount="1"), dict(CLAIMS[0], claim_id=" clm-20260001 ", claimed_amount="2")], "a.csv")
    late = raw("claims", [dict(CLAIMS[0], claimed_amount="3")], "b.csv")
    kept = silver.to_silver(late.unionByName(early), REGISTRY["claims"], DAY).collect()
    assert [(r.claim_id, r.claimed_amount, r._source_file) for r in kept] == [("CLM-20260001", 3.0, "b.csv")]
    counts = silver.dedup_dropped(late.unionByName(early), REGISTRY["claims"]).first()
    assert (counts.rows_in, counts.dropped_within_file, counts.dropped_across_files, counts.rows_kept) == (3, 1, 1, 1)


def test_null_keys_are_one_key(raw):
    rows = [dict(POLICIES[0], policy_id=""), dict(POLICIES[0], policy_id="NULL", insured_name="Last")]
    kept = silver.to_silver(raw("policies", rows), REGISTRY["policies"], DAY).collect()
    assert [(r.policy_id, r.insured_name) for r in kept] == [(None, "Last")]


def test_overdue_days_use_the_normalised_status(raw):
    rows = [dict(PREMIUMS[0], status=" overdue", due_date="2026-05-01"), dict(PREMIUMS[1])]
    kept = silver.to_silver(raw("premiums", rows), REGISTRY["premiums"], DAY).orderBy("premium_id").collect()
    assert [(r.status, r.days_overdue) for r in kept] == [("OVERDUE", 13), ("PENDING", None)]


def test_extra_columns_stay_and_missing_ones_are_named(raw):
    rows = raw("policies", [dict(POLICIES[0], region="nan"), dict(POLICIES[1], region=" North ")])
    kept = silver.to_silver(rows, REGISTRY["policies"], DAY).orderBy("policy_id").collect()
    assert [r.region for r in kept] == [None, " North "]
    with pytest.raises(ValueError, match="status"):
        silver.to_silver(rows.drop("status"), REGISTRY["policies"], DAY)


def test_parse_failures_count_non_empty_cells_only(raw):
    rows = raw("policies", [dict(POLICIES[0], premium_amount="n/a"), dict(POLICIES[1], premium_amount="nan", policy_end_date="2024-02-30")])
    found = {r.column_name: r.bad_values for r in silver.parse_failures(rows, REGISTRY["policies"]).collect()}
    assert found == {"policy_start_date": 0, "policy_end_date": 1, "premium_amount": 1, "risk_score": 0}


def test_a_heavy_key_shrinks_before_the_shuffle(spark, raw):
    rows = raw("claims", [CLAIMS[0]])
    heavy = rows.drop("_row_id").crossJoin(spark.range(20000).withColumnRenamed("id", "_row_id"))
    plan = silver.to_silver(heavy, REGISTRY["claims"], DAY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert [r._row_id for r in plan.collect()] == [19999]


def test_unknown_and_new_entities():
    with pytest.raises(ValueError, match="No contract"):
        get_spec("invoices")
    try:
        register(EntitySpec("brokers", "broker_id", (Field("broker_id"),), upper=("broker_id",)))
        assert get_spec("brokers").required == ["broker_id"]
    finally:
        REGISTRY.pop("brokers")


def test_dimensions_keep_the_first_row_and_flags_are_never_null(raw):
    rows = raw("claims", [dict(CLAIMS[0], adjuster_id="A1", fraud_flag=""), dict(CLAIMS[0], claim_id="CLM-20260003", adjuster_id="A2")])
    typed = silver.to_silver(rows, REGISTRY["claims"], DAY)
    assert [r.adjuster_id for r in gold.dim_claimant(typed, DAY).collect()] == ["A1"]
    assert sorted((r.claim_id, r.is_fraud) for r in gold.fact_claims(typed).collect()) == [
        ("CLM-20260001", False), ("CLM-20260003", False),
    ]
    premiums = silver.to_silver(raw("premiums", [dict(PREMIUMS[0], status="")]), REGISTRY["premiums"], DAY)
    assert [(r.status, r.is_paid, r.is_overdue) for r in gold.fact_premiums(premiums).collect()] == [(None, False, False)]


def test_aggregates_accept_text_input(spark, raw):
    rows = raw("premiums", [dict(PREMIUMS[0], amount_due="x"), PREMIUMS[1]])
    found = gold.agg_daily_premium_summary(rows, DAY).orderBy("status").collect()
    assert [(r.status, r.total_amount_due, r.collection_rate) for r in found] == [("PAID", 0.0, None), ("PENDING", 191.67, 0.0)]
    claims = raw("claims").withColumn("days_to_report", F.lit("3"))
    assert [r.fraud_count for r in gold.agg_claim_by_status(claims, DAY).collect()] == [0, 0]


def test_metrics_are_counted_on_the_write_without_a_second_scan(raw, tmp_path):
    rows = raw("claims", [*CLAIMS, dict(CLAIMS[0], claimed_amount="x", reported_date="soon")])
    metrics = silver.SilverMetrics(REGISTRY["claims"])
    table = silver.to_silver(rows, REGISTRY["claims"], DAY, metrics=metrics)
    assert table._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1
    table.write.parquet(str(tmp_path / "t"))
    got = {(r["metric"], r["column_name"]): r["value"] for r in metrics.rows()}
    asked = {("bad_values", r.column_name): r.bad_values for r in silver.parse_failures(rows, REGISTRY["claims"]).collect()}
    assert got == {**asked, ("rows_in", None): 3, ("rows_kept", None): 2, ("rows_dropped", None): 1}
    assert asked["bad_values", "claimed_amount"] == asked["bad_values", "reported_date"] == 1
