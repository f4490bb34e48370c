"""The whole day on fixture files: goldens, idempotence and recovery."""

import gzip
import os
import threading
from datetime import date, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import CLAIMS, DAY, PREMIUMS, land_day, write_csv, write_sidecar
from coverlake.functions import names
from coverlake.operators.arrival import ArrivalIncomplete
from coverlake.operators.checksum import ChecksumFailed
from coverlake.operators.ledger import DateLedger, FileLedger
from coverlake.plans import daily
from coverlake.plans import gold as gold_plan
from coverlake.plans import silver as silver_plan
from coverlake.plans.daily import run_day
from coverlake.plans.gold import load_gold
from coverlake.plans.ingest import ingest_directory
from coverlake.plans.layout import Lake
from coverlake.plans.silver import silver_backfill, silver_for_date
from coverlake.plans.together import run_together, statuses
from coverlake.sinks import tables
from coverlake.sources.manifest import DIRECTORIES
from coverlake.sources.tables import read_silver

INBOUND, REPORTS = DIRECTORIES


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_run_day_gives_the_goldens(spark, tmp_path):
    land_day(tmp_path)
    lake = Lake(str(tmp_path))
    result = run_day(spark, str(tmp_path), DAY, as_of=DAY)
    assert set(result.gold.values()) == {"ok"}
    assert {r.item: r.n for r in result.report.collect()} == {
        "directories": 2, "bronze_files": 4, "silver_entities": 4, "gold_tables": 9,
    }

    policies = read_silver(spark, lake.silver, "policies", DAY)
    assert rows_of(policies, "policy_id", "policy_duration_days", "annual_premium_eur", "broker_id") == [
        ("POL-20260001", 366, 1500.0, "BRK-001"), ("POL-20260002", 366, 2300.0, None),
    ]
    claims = read_silver(spark, lake.silver, "claims", DAY)
    assert rows_of(claims, "claim_id", "days_to_report", "approval_rate") == [
        ("CLM-20260001", 5, 0.9), ("CLM-20260002", 3, None),
    ]
    premiums = read_silver(spark, lake.silver, "premiums", DAY)
    assert rows_of(premiums, "premium_id", "payment_variance", "days_overdue") == [
        ("PRM-20260001", 0.0, None), ("PRM-20260002", None, None),
    ]
    reinsurance = read_silver(spark, lake.silver, "reinsurance", DAY)
    assert rows_of(reinsurance, "retained_liability", "recovery_ratio") == [(315000.0, None)]
    assert [r._source_file.endswith("bronze/reports/reinsurance/year=2026/month=05/day=14/reinsurance_20260514.csv")
            for r in reinsurance.collect()] == [True]

    gold = lambda table: spark.read.parquet(f"{lake.gold}/{table}")
    assert rows_of(gold("dim_policy"), "policy_id", "is_active") == [("POL-20260001", True), ("POL-20260002", True)]
    assert rows_of(gold("fact_claims"), "claim_id", "is_fraud", "net_claim_cost") == [
        ("CLM-20260001", False, 4000.0), ("CLM-20260002", False, 0.0),
    ]
    assert rows_of(gold("fact_premiums"), "premium_id", "is_paid", "is_overdue") == [
        ("PRM-20260001", True, False), ("PRM-20260002", False, False),
    ]
    assert rows_of(
        gold("agg_daily_premium_summary"), "status", "currency", "policy_count", "premium_count", "total_amount_due",
        "total_amount_paid", "collection_rate", "overdue_count",
    ) == [("PAID", "EUR", 1, 1, 125.0, 125.0, 1.0, 0), ("PENDING", "EUR", 1, 1, 191.67, 0.0, 0.0, 0)]
    assert rows_of(
        gold("agg_claim_by_status"), "claim_type", "status", "claim_count", "total_claimed_eur", "total_approved_eur",
        "avg_days_to_report", "fraud_count",
    ) == [("ACCIDENT", "IN_REVIEW", 1, 12000.0, 0.0, 3.0, 0), ("MEDICAL", "APPROVED", 1, 5000.0, 4500.0, 5.0, 0)]
    assert rows_of(
        gold("agg_reinsurer_exposure"), "reinsurer_id", "reinsurer_name", "treaty_type", "currency", "cession_count",
        "total_ceded_premium_eur", "total_ceded_liability_eur", "total_retained_liability", "total_recovered_eur",
        "avg_recovery_ratio",
    ) == [("RNS-MUN001", "Munich Re", "QUOTA_SHARE", "EUR", 1, 450.0, 450000.0, 315000.0, 0.0, None)]

    audit = spark.read.parquet(lake.audit)
    assert rows_of(audit, "dir_id", "file_type", "rows_valid", "rows_dropped") == [
        ("inbound", "claims", 2, 0), ("inbound", "policies", 2, 0),
        ("reports", "premiums", 2, 0), ("reports", "reinsurance", 1, 0),
    ]
    ledger = FileLedger(spark, lake.file_ledger).processed()
    assert rows_of(ledger.where("dir_id = 'inbound'"), "file_name", "outcome") == [
        ("claims_20260514.csv", "landed"), ("claims_20260514.csv.gpg", "landed"),
        ("claims_20260514.csv.sha256", "sidecar"), ("policies_20260514.csv", "landed"),
        ("policies_20260514.csv.gpg", "landed"), ("policies_20260514.csv.sha256", "sidecar"),
    ]

    before = {t: rows_of(gold(t), *[c for c in gold(t).columns]) for t in ("fact_premiums", "dim_policy")}
    again = run_day(spark, str(tmp_path), DAY, as_of=DAY)
    assert [i.new_files for i in again.ingests] == [0, 0]
    assert set(again.silver.values()) == {"skipped"}
    assert {t for t, s in again.gold.items() if s == "skipped"} == {"fact_premiums", "fact_claims", "fact_reinsurance"}
    forced = load_gold(spark, lake, DAY, force=True)
    assert set(forced.values()) == {"ok"}
    after = {t: rows_of(gold(t), *[c for c in gold(t).columns]) for t in ("fact_premiums", "dim_policy")}
    assert before == after


def test_bad_file_goes_to_dead_letter_and_the_rest_lands(spark, tmp_path):
    bad = [dict(PREMIUMS[0]), dict(PREMIUMS[1], amount_due="0")]
    land_day(tmp_path, rows={"premiums": bad})
    lake = Lake(str(tmp_path))
    result = ingest_directory(spark, lake, REPORTS, DAY)
    assert (result.landed, result.rejected) == (1, 1)
    address = {r.file_name: r.uri for r in result.outcomes.collect()}["premiums_20260514.csv"]
    assert address.startswith(f"{lake.root}/dead_letter/reports/premiums/")
    assert Path(address).read_bytes() == (tmp_path / "landing/reports/premiums_20260514.csv").read_bytes()
    found = spark.read.parquet(f"{lake.root}/quality/violations")
    assert rows_of(found, "column_name", "check_name", "failure_value") == [("amount_due", "greater_than(0)", "0")]
    assert silver_for_date(spark, lake, "premiums", DAY) == "no_bronze"
    with pytest.raises(RuntimeError, match="silver not ready"):
        load_gold(spark, lake, DAY)


def test_missing_file_and_wrong_digest_stop_the_directory(spark, tmp_path):
    land_day(tmp_path)
    lake = Lake(str(tmp_path))
    landing = tmp_path / "landing" / "inbound"
    with pytest.raises(ArrivalIncomplete, match="claims_20260515.csv.gpg"):
        ingest_directory(spark, lake, INBOUND, DAY + timedelta(days=1))
    assert ingest_directory(spark, lake, INBOUND, DAY + timedelta(days=1), allowed_missing=4).landed == 2
    fresh = Lake(str(tmp_path / "second"))
    land_day(tmp_path / "second")
    write_sidecar(tmp_path / "second" / "landing" / "inbound" / "claims_20260514.csv", "0" * 64)
    with pytest.raises(ChecksumFailed, match="claims_20260514.csv"):
        ingest_directory(spark, fresh, INBOUND, DAY)
    assert FileLedger(spark, fresh.file_ledger).is_first_run("inbound")
    assert landing.exists()


def test_headers_may_differ_and_missing_columns_reject(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land_day(tmp_path)
    folder = tmp_path / "landing" / "reports"
    reordered = list(reversed(list(PREMIUMS[0]))) + ["note"]
    write_csv(folder / "premiums_b.csv", [dict(PREMIUMS[0], premium_id="PRM-20260009", note="line one\nline \"two\"")], reordered)
    short = [{k: v for k, v in PREMIUMS[0].items() if k != "currency"}]
    write_csv(folder / "premiums_c.csv", short)
    (folder / "premiums_d.csv").write_text("")
    write_csv(folder / "premiums_e.csv", [dict(PREMIUMS[0])])
    (folder / "premiums_e.csv").write_text(",".join(PREMIUMS[0]) + "\n")
    (folder / "premiums_f.csv").write_text(",".join(PREMIUMS[0]) + "\n" + ",".join(PREMIUMS[0].values()) + ",extra\n")
    (folder / "invoices_20260514.csv").write_text("a,b\n1,2\n")
    (folder / ".hidden.csv").write_text("a,b\n1,2\n")
    result = ingest_directory(spark, lake, REPORTS, DAY)
    outcome = {r.file_name: r.outcome for r in result.outcomes.collect()}
    assert outcome == {
        "premiums_20260514.csv": "landed", "premiums_b.csv": "landed", "premiums_c.csv": "rejected",
        "premiums_d.csv": "rejected", "premiums_e.csv": "landed", "premiums_f.csv": "rejected",
        "reinsurance_20260514.csv": "landed", "invoices_20260514.csv": "rejected",
    }
    found = spark.read.parquet(f"{lake.root}/quality/violations")
    assert rows_of(found, "column_name", "check_name") == [
        ("_overflow", "too_many_cells"), ("currency", "column_in_dataframe"),
    ]
    silver_for_date(spark, lake, "premiums", DAY)
    silver = read_silver(spark, lake.silver, "premiums", DAY)
    assert rows_of(silver, "premium_id", "amount_due", "note") == [
        ("PRM-20260001", 125.0, None), ("PRM-20260002", 191.67, None),
        ("PRM-20260009", 125.0, 'line one\nline "two"'),
    ]


def test_every_file_has_an_outcome_and_keeps_its_bytes(spark, tmp_path):
    land_day(tmp_path)
    lake = Lake(str(tmp_path))
    folder = tmp_path / "landing" / "reports"
    header, row = ",".join(PREMIUMS[0]), ",".join(PREMIUMS[0].values())
    padded = dict(PREMIUMS[0], premium_id=" PRM-20260010 ", _note=" kept ")
    write_csv(folder / "premiums_padded.csv", [dict(padded, premium_id="PRM-20260010")])
    write_csv(folder / "premiums_refused.csv", [padded])
    (folder / "premiums_twice.csv").write_text(header + ",Status\n" + row + ",x\n")
    (folder / "premiums_taken.csv").write_text(header + ",_overflow\n" + row + ",x\n")
    (folder / "premiums_latin_near.csv").write_bytes((header + ",é\n" + row + ",x\n").encode("latin-1"))
    (folder / "premiums_latin_far.csv").write_bytes((header + ",n\n" + (row + ",x\n") * 3000 + row + ",é\n").encode("latin-1"))
    (folder / "premiums_empty.csv").write_text("")
    (folder / "premiums_bare.csv").write_text(header + "\n")
    (folder / "premiums_overfull.csv").write_text(header + "\n" + row + ",one,two\n")
    (folder / "invoices_empty.csv").write_text("")
    (folder / "notes.txt").write_text("hello")
    (folder / "claims_20260514.csv.gpg").write_bytes(b"\x00\xff")
    result = ingest_directory(spark, lake, REPORTS, DAY)
    outcomes = {r.file_name: r for r in result.outcomes.collect()}
    assert {n: r.outcome for n, r in outcomes.items()} == {
        "premiums_20260514.csv": "landed", "reinsurance_20260514.csv": "landed", "premiums_padded.csv": "landed",
        "premiums_bare.csv": "landed", "premiums_refused.csv": "rejected", "premiums_twice.csv": "rejected",
        "premiums_taken.csv": "rejected", "premiums_latin_near.csv": "rejected", "premiums_latin_far.csv": "rejected",
        "premiums_empty.csv": "rejected", "premiums_overfull.csv": "rejected", "invoices_empty.csv": "rejected",
        "notes.txt": "ignored", "claims_20260514.csv.gpg": "ignored",
    }
    for name, r in outcomes.items():
        if r.outcome in ("landed", "rejected"):
            assert Path(r.uri).read_bytes() == (folder / name).read_bytes()
            assert (r.tags is not None) == (r.outcome == "landed")
    assert outcomes["premiums_padded.csv"].tags == {
        "source": "sftp_ingestion", "dir_id": "reports", "entity": "premiums", "business_date": "2026-05-14",
    }
    found = spark.read.parquet(f"{lake.root}/quality/violations").collect()
    checks = {(r.source_file, r.check_name) for r in found}
    assert {
        ("premiums_twice.csv", "repeated_column"), ("premiums_taken.csv", "reserved_column"),
        ("premiums_latin_near.csv", "not_utf8"), ("premiums_latin_far.csv", "not_utf8"),
        ("premiums_overfull.csv", "too_many_cells"),
    } <= checks
    assert {r.row_key for r in found if r.source_file == "premiums_refused.csv"} == {" PRM-20260010 "}
    assert ingest_directory(spark, lake, REPORTS, DAY).new_files == 0
    silver_for_date(spark, lake, "premiums", DAY, as_of=DAY)
    kept = read_silver(spark, lake.silver, "premiums", DAY).where("premium_id = 'PRM-20260010'").collect()
    assert [r._note for r in kept] == [" kept "]
    assert all(Path(r._source_file.removeprefix("file:")).is_file() for r in kept)


def test_lookback_bounds_ledger_and_listing(spark, tmp_path):
    land_day(tmp_path)
    lake = Lake(str(tmp_path))
    old = write_csv(tmp_path / "landing/reports/premiums_old.csv", [dict(PREMIUMS[0])])
    os.utime(old, (0, 0))
    assert ingest_directory(spark, lake, REPORTS, DAY, lookback_from=date.today()).new_files == 2
    assert ingest_directory(spark, lake, REPORTS, DAY).new_files == 1


def test_a_failed_silver_entity_stops_gold(spark, tmp_path, monkeypatch):
    land_day(tmp_path)
    monkeypatch.setattr(daily, "silver_all", lambda *a: {"claims": "error: no space"})
    with pytest.raises(RuntimeError, match="claims"):
        run_day(spark, str(tmp_path), DAY, as_of=DAY)


def test_backfill_is_one_job_over_pending_dates_and_late_files_win(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for offset in range(3):
        day = DAY + timedelta(days=offset)
        rows = [dict(c, claimed_amount=str(1000.0 + offset)) for c in CLAIMS]
        write_csv(tmp_path / f"bronze/inbound/claims/year={day.year}/month={day.month:02d}/day={day.day:02d}/claims_{day:%Y%m%d}.csv", rows)
    write_csv(tmp_path / "bronze/inbound/claims/year=2026/month=13/day=40/claims_x.csv", CLAIMS)
    write_csv(tmp_path / "bronze/inbound/claims/loose.csv", CLAIMS)
    assert silver_for_date(spark, lake, "claims", DAY) .endswith("2026-05-14")
    pending = silver_backfill(spark, lake, "claims")
    assert pending == {date(2026, 5, 15): "ok", date(2026, 5, 16): "ok"}
    assert silver_backfill(spark, lake, "claims") == {}
    assert len(silver_backfill(spark, lake, "claims", force=True)) == 3
    table = spark.read.parquet(f"{lake.silver}/claims")
    assert rows_of(table.groupBy("day").agg(F.count("*").alias("n"), F.max("claimed_amount").alias("m")), "day", "n", "m") == [
        (14, 2, 1000.0), (15, 2, 1001.0), (16, 2, 1002.0),
    ]
    assert (tmp_path / "silver/claims/year=2026/month=05/day=14").is_dir()
    late = [dict(CLAIMS[0], claimed_amount="7.0")]
    write_csv(tmp_path / "bronze/reports/claims/year=2026/month=05/day=14/claims_late.csv", late)
    assert silver_for_date(spark, lake, "claims", DAY) == "skipped"
    silver_for_date(spark, lake, "claims", DAY, force=True)
    assert rows_of(read_silver(spark, lake.silver, "claims", DAY), "claim_id", "claimed_amount") == [
        ("CLM-20260001", 7.0), ("CLM-20260002", 1000.0),
    ]
    book = DateLedger(spark, lake.silver_ledger)
    book.reset("claims")
    assert book.is_first_run("claims") and len(silver_backfill(spark, lake, "claims")) == 3


def bronze_claims(root, days, **cells):
    for day in days:
        folder = root / f"bronze/inbound/claims/year={day.year}/month={day.month:02d}/day={day.day:02d}"
        write_csv(folder / f"claims_{day:%Y%m%d}.csv", [dict(c, **cells) for c in CLAIMS])


def test_one_corrupt_file_costs_its_own_date(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    days = [DAY + timedelta(days=k) for k in range(12)]
    bronze_claims(tmp_path, days)
    bad = tmp_path / f"bronze/inbound/claims/year=2026/month=05/day={days[4].day:02d}/claims_bad.csv"
    bad.write_bytes(b"claim_id,policy_\xff\xfeid\n1,2\n")
    jobs = []
    rebuild = silver_plan.rebuild_dates
    monkeypatch.setattr(silver_plan, "rebuild_dates", lambda *a: (jobs.append(len(a[3])), rebuild(*a))[1])
    got = silver_backfill(spark, lake, "claims")
    assert {d: s[:5] for d, s in got.items()} == {d: "error" if d == days[4] else "ok" for d in days}
    assert "claims_bad.csv" in got[days[4]] and jobs[0] == 12 and len(jobs) <= 2 * 4 + 1
    assert spark.read.parquet(f"{lake.silver}/claims").select("day").distinct().count() == 11
    bad.unlink()
    assert silver_backfill(spark, lake, "claims") == {days[4]: "ok"}


RECORD = DateLedger.record


def gone_when_done(self, scope, dates, outcome="done"):
    if outcome == "done":
        raise OSError("the driver is gone")
    RECORD(self, scope, dates, outcome)


def test_a_write_that_broke_off_is_redone(spark, tmp_path, monkeypatch):
    """Between write and ledger, and with files of a partition lost halfway, also for a date done before."""
    lake, whole = Lake(str(tmp_path / "a")), Lake(str(tmp_path / "b"))
    for name in ("a", "b"):
        bronze_claims(tmp_path / name, [DAY])
    silver_backfill(spark, whole, "claims", as_of=DAY)
    silver_backfill(spark, lake, "claims", as_of=DAY)

    def content(of):
        table = read_silver(spark, of.silver, "claims", DAY).drop("_ingested_at", "_source_file", "_row_id")
        return sorted(map(str, table.collect()))

    def broken_write(rows, path, *args):
        for part in (tmp_path / "a/silver/claims").rglob("*.parquet"):
            part.unlink()
        raise OSError("the driver is gone")

    monkeypatch.setattr(silver_plan, "write_dates", broken_write)
    with pytest.raises(OSError):
        silver_for_date(spark, lake, "claims", DAY, force=True, as_of=DAY)
    monkeypatch.undo()
    assert silver_plan.unfinished_dates(spark, lake, "claims") == [DAY]
    assert silver_for_date(spark, lake, "claims", DAY, as_of=DAY) != "skipped"
    assert content(lake) == content(whole) and silver_plan.unfinished_dates(spark, lake, "claims") == []
    assert silver_for_date(spark, lake, "claims", DAY, as_of=DAY) == "skipped"
    # after the write, before the ledger: a merge that meets the open date rebuilds it from bronze
    monkeypatch.setattr(DateLedger, "record", gone_when_done)
    with pytest.raises(OSError):
        silver_for_date(spark, lake, "claims", DAY, force=True, as_of=DAY)
    monkeypatch.undo()
    assert silver_backfill(spark, lake, "claims", as_of=DAY) == {DAY: "ok"} and content(lake) == content(whole)


def test_a_silver_write_deals_out_rows_without_derived_columns(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    write_csv(tmp_path / f"bronze/inbound/claims/{names.date_path(DAY)}/c.csv", CLAIMS)
    dealt, whole = [], tables.clustered
    monkeypatch.setattr(tables, "clustered", lambda rows, *a: (dealt.append(rows.columns), whole(rows, *a))[1])
    assert silver_backfill(spark, lake, "claims", as_of=DAY) == {DAY: "ok"}
    stored = read_silver(spark, lake.silver, "claims", DAY)
    made = {"days_to_report", "approval_rate", "_row_hash", "_ingested_at"}
    assert made <= set(stored.columns) and stored.where("_row_hash IS NULL").isEmpty()
    assert not made & set(dealt[0])


def packed(path):
    """The file in gzip form, in its place."""
    with gzip.open(f"{path}.gz", "wb") as handle:
        handle.write(path.read_bytes())
    path.unlink()


def test_bronze_may_be_packed(spark, tmp_path):
    """Plain and gzip files of a date together, with a record over two lines; the later file's row wins."""
    folder = tmp_path / f"bronze/inbound/claims/{names.date_path(DAY)}"
    write_csv(folder / "a.csv", CLAIMS)
    packed(write_csv(folder / "b.csv", [dict(CLAIMS[0], claimant_name="two\nlines", claimed_amount="7.0")]))
    lake = Lake(str(tmp_path))
    assert silver_backfill(spark, lake, "claims", as_of=DAY) == {DAY: "ok"}
    assert rows_of(read_silver(spark, lake.silver, "claims", DAY), "claim_id", "claimant_name", "claimed_amount") == [
        ("CLM-20260001", "two\nlines", 7.0), ("CLM-20260002", "Bob Dupont", 12000.0),
    ]


def test_layer_tables_are_packed_well(spark, tmp_path):
    lake = Lake(str(tmp_path))
    bronze_claims(tmp_path, [DAY])
    silver_backfill(spark, lake, "claims", as_of=DAY)
    codecs = {pq.read_metadata(f).row_group(0).column(0).compression for f in tmp_path.glob("silver/claims/**/*.parquet")}
    assert codecs == {"ZSTD"}


def test_rows_of_one_date_are_shuffled_once(spark, tmp_path, monkeypatch):
    """By the key; those of several dates are dealt out by date as well."""
    lake, whole, plans = Lake(str(tmp_path)), tables.clustered, []

    def seen(rows, *a):
        dealt = whole(rows, *a)
        plans.append(dealt._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return dealt

    monkeypatch.setattr(tables, "clustered", seen)
    days = [DAY, DAY + timedelta(days=1)]
    bronze_claims(tmp_path, days)
    silver_for_date(spark, lake, "claims", DAY, as_of=DAY)
    silver_backfill(spark, lake, "claims", force=True, as_of=DAY)
    assert plans == [1, 2]
    assert rows_of(read_silver(spark, lake.silver, "claims", days[1]), "claim_id") == [("CLM-20260001",), ("CLM-20260002",)]


def test_large_jobs_run_alone():
    lock, running, seen = threading.Lock(), set(), {}

    def job(name):
        with lock:
            running.add(name)
            seen[name] = set(running)
        threading.Event().wait(0.05)
        with lock:
            running.discard(name)
        if name == "c":
            raise ValueError(name)
        return name

    jobs = {n: (lambda n=n: job(n)) for n in "abcd"}
    assert list(statuses(jobs, ["d", "c"]).items()) == [("a", "a"), ("b", "b"), ("c", "error: c"), ("d", "d")]
    assert list(seen)[:2] == ["d", "c"] and seen["d"] == {"d"} and seen["c"] == {"c"}
    with pytest.raises(ValueError):
        run_together(jobs, ["c"])


def test_a_fact_loaded_in_parts_is_the_whole_fact(spark, tmp_path, monkeypatch):
    land_day(tmp_path, rows={"claims": [dict(CLAIMS[k % 2], claim_id=f"CLM-{k:08d}") for k in range(60)]})
    lake = Lake(str(tmp_path))
    run_day(spark, str(tmp_path), DAY, as_of=DAY)
    stored = read_silver(spark, lake.silver, "claims", DAY)
    stored.repartition(5).write.parquet(str(tmp_path / "five"))
    folder = Path(f"{lake.silver}/claims/{names.date_path(DAY)}")
    for old in folder.glob("*.parquet"):
        old.unlink()
    for new in (tmp_path / "five").glob("*.parquet"):
        (folder / new.name).write_bytes(new.read_bytes())
    fact = lambda: rows_of(spark.read.parquet(f"{lake.gold}/fact_claims"), "claim_id", "_row_hash", "ingestion_date", "net_claim_cost")
    whole, appended, append = fact(), [], gold_plan.append_date
    monkeypatch.setattr(gold_plan, "PART_BYTES", 1)
    monkeypatch.setattr(gold_plan, "LARGE_BYTES", 1)
    monkeypatch.setattr(gold_plan, "append_date", lambda rows, path, *a: (appended.append(path), append(rows, path, *a)))
    assert set(load_gold(spark, lake, DAY, force=True).values()) == {"ok"}
    assert len(whole) == 60 and fact() == whole
    assert appended.count(f"{lake.gold}/fact_claims") == 4
    assert load_gold(spark, lake, DAY)["fact_claims"] == "skipped" and fact() == whole


def test_a_backfill_of_many_bytes_is_several_jobs(spark, tmp_path, monkeypatch):
    """As many dates together as keep within the bound; gzip files count as the text they hold."""
    lake, days, jobs = Lake(str(tmp_path)), [DAY + timedelta(days=k) for k in range(5)], []
    bronze_claims(tmp_path, days)
    length = os.path.getsize(tmp_path / f"bronze/inbound/claims/{names.date_path(DAY)}/claims_{DAY:%Y%m%d}.csv")
    packed(write_csv(tmp_path / f"bronze/reports/claims/{names.date_path(days[3])}/more.csv", [dict(CLAIMS[0], claim_id="CLM-9")]))
    rebuild = silver_plan.rebuild_dates
    monkeypatch.setattr(silver_plan, "BATCH_BYTES", 2 * length)
    monkeypatch.setattr(silver_plan, "rebuild_dates", lambda *a: (jobs.append(a[3]), rebuild(*a))[1])
    assert silver_backfill(spark, lake, "claims", as_of=DAY) == dict.fromkeys(days, "ok")
    assert jobs == [days[:2], days[2:3], days[3:4], days[4:]]
    stored = spark.read.parquet(f"{lake.silver}/claims")
    assert {r["day"]: r["count"] for r in stored.groupBy("day").count().collect()} == {d.day: 2 + (d == days[3]) for d in days}
    assert silver_backfill(spark, lake, "claims", as_of=DAY) == {} and silver_backfill(spark, lake, "policies") == {}
