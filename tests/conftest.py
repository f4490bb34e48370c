import csv
import hashlib
from datetime import date
from pathlib import Path

import pytest

from coverlake.session import build_session

DAY = date(2026, 5, 14)

POLICIES = [
    dict(policy_id="POL-20260001", insured_name="Alice Martin", policy_start_date="2024-01-01",
         policy_end_date="2025-01-01", premium_amount="1500.0", coverage_type="LIFE", risk_score="0.25",
         broker_id="BRK-001", status="ACTIVE"),
    dict(policy_id="POL-20260002", insured_name="Bob Dupont", policy_start_date="2023-06-15",
         policy_end_date="2024-06-15", premium_amount="2300.0", coverage_type="HEALTH", risk_score="0.65",
         broker_id="", status="ACTIVE"),
]
CLAIMS = [
    dict(claim_id="CLM-20260001", policy_id="POL-20260001", claimant_name="Alice Martin", incident_date="2025-03-10",
         reported_date="2025-03-15", claim_type="MEDICAL", claimed_amount="5000.0", approved_amount="4500.0",
         status="APPROVED", adjuster_id="ADJ-001", deductible_applied="500.0", fraud_flag="False"),
    dict(claim_id="CLM-20260002", policy_id="POL-20260002", claimant_name="Bob Dupont", incident_date="2025-07-22",
         reported_date="2025-07-25", claim_type="ACCIDENT", claimed_amount="12000.0", approved_amount="",
         status="IN_REVIEW", adjuster_id="ADJ-002", deductible_applied="", fraud_flag="False"),
]
PREMIUMS = [
    dict(premium_id="PRM-20260001", policy_id="POL-20260001", payment_date="2026-01-01", due_date="2026-01-01",
         amount_due="125.0", amount_paid="125.0", payment_method="BANK_TRANSFER", currency="EUR",
         instalment_number="1", instalment_total="12", status="PAID", late_fee="0.0"),
    dict(premium_id="PRM-20260002", policy_id="POL-20260002", payment_date="", due_date="2026-02-01",
         amount_due="191.67", amount_paid="", payment_method="", currency="EUR", instalment_number="2",
         instalment_total="12", status="PENDING", late_fee=""),
]
REINSURANCE = [
    dict(ri_record_id="RI-20260001", policy_id="POL-20260001", claim_id="", reinsurer_id="RNS-MUN001",
         reinsurer_name="Munich Re", treaty_id="TRT-2026-001", treaty_type="QUOTA_SHARE", cession_date="2026-01-01",
         cession_percentage="30.0", ceded_premium="450.0", ceded_liability="450000.0", recovered_amount="",
         status="ACTIVE", currency="EUR"),
]
ROWS = {"policies": POLICIES, "claims": CLAIMS, "premiums": PREMIUMS, "reinsurance": REINSURANCE}
FOLDERS = {"policies": "inbound", "claims": "inbound", "premiums": "reports", "reinsurance": "reports"}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "coverlake-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def write_csv(path: Path, rows: list[dict], columns: list[str] | None = None) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as handle:
        writer = csv.DictWriter(handle, columns or list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)
    return path


def write_sidecar(path: Path, digest: str | None = None) -> Path:
    digest = digest or hashlib.sha256(path.read_bytes()).hexdigest()
    sidecar = path.with_name(path.name + ".sha256")
    sidecar.write_text(f"{digest.upper()}  {path.name}\n")
    return sidecar


def land_day(root: Path, day: date = DAY, rows: dict[str, list[dict]] | None = None) -> None:
    """The four files of a date in the landing folders, with sidecars for the inbound ones."""
    for entity, content in {**ROWS, **(rows or {})}.items():
        path = write_csv(root / "landing" / FOLDERS[entity] / f"{entity}_{day:%Y%m%d}.csv", content)
        if FOLDERS[entity] == "inbound":
            write_sidecar(path)


@pytest.fixture
def raw(spark):
    """Raw frames of the fixture rows with provenance, as the CSV scan gives them."""

    def build(entity: str, rows: list[dict] | None = None, source: str | None = None):
        rows = ROWS[entity] if rows is None else rows
        columns = list(rows[0])
        schema = ", ".join(f"{c} string" for c in columns)
        schema += ", _source_file string, _block_start bigint, _row_id bigint, _business_date date"
        source = source or f"{entity}_20260514.csv"
        values = [
            tuple(None if r[c] == "" else r[c] for c in columns) + (source, 0, i, DAY) for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(values, schema)

    return build
