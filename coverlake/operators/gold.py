"""Star schema: dimensions, facts and aggregates of one or many business dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.functions import cells, keys
from coverlake.functions.exact import grouped_sums
from coverlake.operators.dedup import one_per_key
from coverlake.operators.silver import BUSINESS_DATE
from coverlake.sources.raw_csv import ROW_ORDER

# The columns of each gold table that come from silver as they are.
DIM_POLICY_COLUMNS = [
    "policy_id", "insured_name", "coverage_type", "status", "policy_start_date", "policy_end_date",
    "policy_duration_days", "annual_premium_eur", "risk_score", "broker_id",
]
DIM_CLAIMANT_COLUMNS = ["policy_id", "claimant_name", "adjuster_id"]
DIM_REINSURER_COLUMNS = ["reinsurer_id", "reinsurer_name"]
FACT_PREMIUMS_COLUMNS = [
    "premium_id", "policy_id", "due_date", "payment_date", "amount_due", "amount_paid", "late_fee",
    "payment_variance", "days_overdue", "instalment_number", "instalment_total", "payment_method", "currency",
    "status", "_business_date", "_row_hash",
]
FACT_CLAIMS_COLUMNS = [
    "claim_id", "policy_id", "incident_date", "reported_date", "claim_type", "status", "claimed_amount",
    "approved_amount", "deductible_applied", "days_to_report", "approval_rate", "fraud_flag", "adjuster_id",
    "_business_date", "_row_hash",
]
FACT_REINSURANCE_COLUMNS = [
    "ri_record_id", "policy_id", "claim_id", "reinsurer_id", "treaty_id", "treaty_type", "cession_date",
    "cession_percentage", "ceded_premium", "ceded_liability", "recovered_amount", "retained_liability",
    "recovery_ratio", "currency", "status", "_business_date", "_row_hash",
]


def _first_per_key(rows: DataFrame, columns: list[str], key: list[str], order: list[str]) -> DataFrame:
    needed = list(dict.fromkeys([*columns, *order]))
    return one_per_key(rows.select(*needed), key, order, keep="first")


def dim_policy(policies: DataFrame, day: date, order: list[str] = ROW_ORDER) -> DataFrame:
    return _first_per_key(policies, DIM_POLICY_COLUMNS, ["policy_id"], order).selectExpr(
        *DIM_POLICY_COLUMNS, f"{cells.is_value('status', 'ACTIVE')} AS is_active", f"DATE '{day}' AS load_date"
    )


def dim_claimant(claims: DataFrame, day: date, order: list[str] = ROW_ORDER) -> DataFrame:
    return _first_per_key(claims, DIM_CLAIMANT_COLUMNS, ["policy_id", "claimant_name"], order).selectExpr(
        *DIM_CLAIMANT_COLUMNS,
        f"{keys.surrogate_key('policy_id', 'claimant_name')} AS claimant_sk",
        f"DATE '{day}' AS load_date",
    )


def dim_reinsurer(reinsurance: DataFrame, day: date, order: list[str] = ROW_ORDER) -> DataFrame:
    return _first_per_key(reinsurance, DIM_REINSURER_COLUMNS, ["reinsurer_id"], order).selectExpr(
        *DIM_REINSURER_COLUMNS, f"DATE '{day}' AS load_date"
    )


INGESTION_DATE = f"CAST({BUSINESS_DATE} AS DATE) AS ingestion_date"


def fact_premiums(premiums: DataFrame) -> DataFrame:
    return premiums.selectExpr(
        *FACT_PREMIUMS_COLUMNS,
        INGESTION_DATE,
        f"{cells.is_value('status', 'PAID')} AS is_paid",
        f"{cells.is_value('status', 'OVERDUE')} AS is_overdue",
    )


def fact_claims(claims: DataFrame) -> DataFrame:
    return claims.selectExpr(
        *FACT_CLAIMS_COLUMNS,
        INGESTION_DATE,
        "coalesce(fraud_flag, false) AS is_fraud",
        f"{cells.zero_if_null('approved_amount')} - {cells.zero_if_null('deductible_applied')} AS net_claim_cost",
    )


def fact_reinsurance(reinsurance: DataFrame) -> DataFrame:
    return reinsurance.selectExpr(*FACT_REINSURANCE_COLUMNS, INGESTION_DATE)


def numbers(rows: DataFrame, *columns: str) -> DataFrame:
    """Input of an aggregate that may still hold text: numbers where they parse, null elsewhere."""
    types = dict(rows.dtypes)
    return rows.withColumns(
        {c: F.expr(cells.to_double(c) if types[c] == "string" else f"CAST({c} AS DOUBLE)") for c in columns}
    )


def agg_daily_premium_summary(premiums: DataFrame, day: date) -> DataFrame:
    """By status and currency; null codes are groups of their own.

    The distinct count makes Spark group by (status, currency, policy) first, so the few large groups are spread by
    policy before the last small step.
    """
    grouped = grouped_sums(
        numbers(premiums, "amount_due", "amount_paid").select("status", "currency", "policy_id", "premium_id", "amount_due", "amount_paid"),
        ["status", "currency"],
        {"total_amount_due": "amount_due", "total_amount_paid": "amount_paid"},
        {"policy_count": F.count_distinct("policy_id"), "premium_count": F.count("premium_id")},
    )
    return grouped.selectExpr(
        "*",
        f"{cells.collection_rate('total_amount_paid', 'total_amount_due')} AS collection_rate",
        f"DATE '{day}' AS business_date",
        f"CASE WHEN {cells.is_value('status', 'OVERDUE')} THEN premium_count ELSE 0L END AS overdue_count",
    )


def agg_claim_by_status(claims: DataFrame, day: date) -> DataFrame:
    is_text = dict(claims.dtypes)["fraud_flag"] == "string"
    fraud = "lower(fraud_flag) = 'true'" if is_text else "fraud_flag"
    columns = ["claim_type", "status", "claim_id", "claimed_amount", "approved_amount", "days_to_report", "fraud_flag"]
    return grouped_sums(
        numbers(claims, "claimed_amount", "approved_amount", "days_to_report").select(*columns),
        ["claim_type", "status"],
        {"total_claimed_eur": "claimed_amount", "total_approved_eur": "approved_amount"},
        {
            "claim_count": F.count("claim_id"),
            "avg_days_to_report": F.expr("bround(avg(days_to_report), 1)"),
            "fraud_count": F.expr(f"count_if({fraud})"),
        },
    ).selectExpr("*", f"DATE '{day}' AS business_date")


def agg_reinsurer_exposure(reinsurance: DataFrame, day: date) -> DataFrame:
    money = ["ceded_premium", "ceded_liability", "retained_liability", "recovered_amount", "recovery_ratio"]
    keys_ = ["reinsurer_id", "reinsurer_name", "treaty_type", "currency"]
    return grouped_sums(
        numbers(reinsurance, *money).select(*keys_, "ri_record_id", *money),
        keys_,
        {
            "total_ceded_premium_eur": "ceded_premium",
            "total_ceded_liability_eur": "ceded_liability",
            "total_retained_liability": "retained_liability",
            "total_recovered_eur": "recovered_amount",
        },
        {"cession_count": F.count("ri_record_id"), "avg_recovery_ratio": F.expr(cells.exact_mean("recovery_ratio", 4))},
    ).selectExpr("*", f"DATE '{day}' AS business_date")
