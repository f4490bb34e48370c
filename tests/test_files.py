"""Arrival, inference, checksums, ledgers, audit and sinks."""

import os
import time
from datetime import date, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import DAY, write_csv, write_sidecar
from coverlake.operators import arrival, audit, checksum, ledger
from coverlake.session import SETTINGS, apply_settings
from coverlake.sinks.landing import expire_layers, expired_partitions
from coverlake.sinks.tables import replace_date, replace_partitions, truncate_load
from coverlake.sources import landing
from coverlake.sources.landing import file_digests, list_directory, read_sidecars
from coverlake.sources.manifest import DIRECTORIES, directory, manifest_entities, manifest_table, read_manifest
from coverlake.sources.raw_csv import read_csv_files
from coverlake.sources.samples import padded


def listed(spark, *files, day=DAY):
    return spark.createDataFrame([(d, day, f) for d, f in files], "dir_id string, business_date date, file_name string")


EXPECTED = {
    ("inbound", "policies_20260514.csv.gpg"), ("inbound", "claims_20260514.csv.gpg"),
    ("inbound", "policies_20260514.csv.sha256"), ("inbound", "claims_20260514.csv.sha256"),
    ("reports", "premiums_20260514.csv"), ("reports", "reinsurance_20260514.csv"),
}


def test_manifest(spark, tmp_path):
    manifest = manifest_table(spark)
    assert [r.entity for r in manifest_entities(manifest).collect()] == ["policies", "claims", "premiums", "reinsurance"]
    assert directory(manifest, "reports")["use_pgp"] is False
    with pytest.raises(KeyError, match="inbound"):
        directory(manifest, "nowhere")
    manifest.drop("dir_pos").coalesce(1).write.json(str(tmp_path / "manifest"))
    assert [r.dir_id for r in read_manifest(spark, str(tmp_path / "manifest")).orderBy("dir_pos").collect()] == ["inbound", "reports"]


def test_expected_names_and_arrival(spark):
    manifest = manifest_table(spark)
    dates = arrival.calendar(manifest, DAY, DAY)
    expected = arrival.expected_files(manifest, dates)
    assert {(r.dir_id, r.file_name) for r in expected.collect()} == EXPECTED
    assert arrival.expected_files(manifest, arrival.calendar(manifest, DAY, DAY + timedelta(days=6))).count() == 42
    everything = listed(spark, *EXPECTED, ("inbound", "surprise.csv"))
    arrival.require_complete(expected, everything)
    report = {r.dir_id: r for r in arrival.arrival_report(expected, everything).collect()}
    assert report["inbound"].unexpected_files == 1 and report["inbound"].is_complete
    short = listed(spark, *sorted(EXPECTED)[1:])
    with pytest.raises(arrival.ArrivalIncomplete, match="claims_20260514.csv.gpg"):
        arrival.require_complete(expected, short)
    arrival.require_complete(expected, short, allowed_missing=1)
    report = {r.dir_id: r.is_complete for r in arrival.arrival_report(expected, short).collect()}
    assert report == {"inbound": False, "reports": True}


def test_entity_inference(spark):
    files = listed(spark, ("inbound", "POLICIES_20260514.CSV"), ("inbound", "premiums_20260514.csv"), ("reports", "invoices_1.csv"), ("nowhere", "claims_1.csv"))
    manifest = manifest_table(spark)
    found = {r.file_name: r.entity for r in arrival.infer_entities(files, manifest).collect()}
    assert found == {"POLICIES_20260514.CSV": "policies", "premiums_20260514.csv": "premiums", "invoices_1.csv": None, "claims_1.csv": "claims"}
    own = {r.file_name: r.entity for r in arrival.directory_entities(files, manifest).collect()}
    assert own["premiums_20260514.csv"] is None and own["POLICIES_20260514.CSV"] == "policies"
    assert arrival.infer_entity("Claims_1.csv") == "claims"
    with pytest.raises(ValueError, match="invoices"):
        arrival.infer_entity("invoices_1.csv")
    names = {r.file_name for r in arrival.with_encrypted_names(files, manifest).collect()}
    assert "premiums_20260514.csv.gpg" in names and "claims_1.csv.gpg" not in names


@pytest.mark.parametrize("chunk_bytes", [1, 1 << 20])
def test_checksums(spark, tmp_path, chunk_bytes, monkeypatch):
    monkeypatch.setattr(landing, "CHUNK_BYTES", chunk_bytes)
    good = write_csv(tmp_path / "a b+1.csv", [{"x": "1"}])
    wrong = write_csv(tmp_path / "wrong.csv", [{"x": "2"}])
    write_csv(tmp_path / "unchecked.csv", [{"x": "3"}])
    write_sidecar(good), write_sidecar(wrong, "0" * 64)
    (tmp_path / "gone.csv.sha256").write_text("ab  gone.csv")
    folder = str(tmp_path)
    report = checksum.checksum_report(read_sidecars(spark, folder), file_digests(list_directory(spark, folder, "d")))
    assert {r.file_name: r.ok for r in report.collect()} == {"a b+1.csv": True, "wrong.csv": False, "gone.csv": False}
    with pytest.raises(checksum.ChecksumFailed, match="gone.csv.*wrong.csv"):
        checksum.require_checksums(report)
    assert read_sidecars(spark, folder + "/none").isEmpty()
    gone = spark.createDataFrame([(folder + "/none.csv",)], "path string")
    assert [tuple(r) for r in file_digests(gone).collect()] == [("none.csv", None)]


def test_listing_skips_dot_files_and_keeps_empty_ones(spark, tmp_path):
    for name in ("a.csv", "_b.csv", ".c.csv"):
        (tmp_path / name).write_text("")
    (tmp_path / "processed").mkdir()
    assert {r.file_name for r in list_directory(spark, str(tmp_path), "d").collect()} == {"a.csv", "_b.csv"}
    assert list_directory(spark, str(tmp_path / "none"), "d").isEmpty()


@pytest.mark.parametrize("split_bytes", [4, 1 << 20])
def test_files_of_all_lengths_are_read_alike(spark, tmp_path, split_bytes):
    (tmp_path / "cr.csv").write_bytes(b"a,b\n1,x\ry\n2,z\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        rows = read_csv_files(spark, list_directory(spark, str(tmp_path), "d")).select("a", "b").collect()
        assert sorted((r.a, r.b or "") for r in rows) == [("1", "x"), ("2", "z"), ("y", "")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ids_of_many_digits_stay_whole(spark):
    got = spark.sql(f"SELECT {padded('x', 8)} AS p FROM VALUES (7), (12345678), (123456789012) AS t(x)").collect()
    assert [r.p for r in got] == ["00000007", "12345678", "123456789012"]


def test_long_files_are_read_in_splits_unless_records_span_lines(spark, tmp_path):
    rows = [{"id": str(n), "text": f"row {n}"} for n in range(500)]
    write_csv(tmp_path / "plain.csv", rows)
    write_csv(tmp_path / "broken.csv", [dict(r, text='two\nlines, "quoted"') for r in rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        files = list_directory(spark, str(tmp_path), "d")
        found = read_csv_files(spark, files)
        counts = found.groupBy(F.regexp_extract("_path", "([^/]+)$", 1).alias("f")).agg(
            F.count("*").alias("n"), F.count_distinct("_block_start").alias("blocks"), F.count_distinct("id").alias("ids"),
            F.max("text").alias("t"),
        )
        got = {r.f: r for r in counts.collect()}
        assert (got["plain.csv"].n, got["plain.csv"].ids, got["broken.csv"].n) == (500, 500, 500)
        assert got["plain.csv"].blocks > 1 and got["broken.csv"].blocks == 1
        assert got["broken.csv"].t == 'two\nlines, "quoted"'
        ordered = [r.id for r in found.where("_path LIKE '%plain.csv'").orderBy("_source_file", "_block_start", "_row_id").collect()]
        assert ordered == [str(n) for n in range(500)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_file_ledger(spark, tmp_path):
    book = ledger.FileLedger(spark, str(tmp_path / "files"))
    assert book.is_first_run("inbound")
    entries = lambda name, day: spark.createDataFrame(
        [("inbound", name, day, "u", ledger.LANDED)], "dir_id string, file_name string, business_date date, uri string, outcome string"
    )
    book.record("inbound", entries("old.csv", date(2025, 1, 1)))
    book.record("inbound", entries("new.csv", DAY))
    book.record("inbound", entries("new.csv", DAY))
    assert sorted(r.file_name for r in book.processed().collect()) == ["new.csv", "old.csv"]
    assert [r.file_name for r in book.processed(as_of=DAY).collect()] == ["new.csv"]
    scan = book.entries(as_of=DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in scan
    fresh = arrival.new_files(listed(spark, ("inbound", "new.csv"), ("inbound", "next.csv")), book.processed())
    assert [r.file_name for r in fresh.collect()] == ["next.csv"]
    book.reset("inbound", DAY)
    assert book.is_first_run("inbound") and book.summary().first().is_first_run
    book.record("inbound", entries("new.csv", DAY))
    assert [tuple(r)[:3] for r in book.summary().collect()] == [("inbound", 1, False)]


def test_a_ledger_snapshot_reads_as_the_log_does(spark, tmp_path):
    path = str(tmp_path / "files")
    book = ledger.FileLedger(spark, path)
    schema = "file_name string, business_date date, uri string, outcome string"

    def record(dir_id, *names, day=DAY, outcome=ledger.LANDED):
        book.record(dir_id, spark.createDataFrame([(n, day, "u", outcome) for n in names], schema))

    def log_files():
        return {Path(f).name for f in book.entries().inputFiles() if f"{path}/" in f.replace("file://", "")}

    def state(entries):
        return sorted((r.dir_id, r.file_name, r.outcome) for r in ledger.current_files(entries).collect())

    assert not book.compact(1)
    record("inbound", "gone.csv")
    book.reset("inbound", DAY)
    record("inbound", "old.csv", day=date(2020, 1, 1))
    record("inbound", "twice.csv", outcome=ledger.REJECTED)
    record("reports", "r.csv")
    assert not book.compact(100) and book.newest_snapshot() is None
    for f in (tmp_path / "files").rglob("*.parquet"):
        os.utime(f, (1_700_000_000, 1_700_000_000))
    assert book.compact(1) and state(book.entries()) == state(book.tail(None))
    # what the snapshot has is not opened again, and nothing is left out however old it is
    assert not log_files() and not book.compact(1)
    record("inbound", "twice.csv", "new.csv")
    want = [("inbound", "new.csv", "landed"), ("inbound", "old.csv", "landed"), ("inbound", "twice.csv", "landed"),
            ("reports", "r.csv", "landed")]
    assert state(book.entries()) == state(book.tail(None)) == want and 0 < len(log_files()) <= 2
    # a snapshot whose write broke off is no snapshot, and entries of the overlap count once
    broken = tmp_path / "files_snapshots/folded_at=29990101T000000000000/dir_id=inbound"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"torn")
    assert state(book.entries()) == want and book.compact(1) and state(book.entries()) == want
    before = [tuple(r) for r in ledger.ledger_summary(book.tail(None), "dir_id", ledger.current_files(book.tail(None))).orderBy("dir_id").collect()]
    assert [tuple(r) for r in book.summary().orderBy("dir_id").collect()] == before
    # a reset after the snapshot empties what the snapshot holds, and the next snapshot remembers it
    book.reset("inbound", DAY)
    assert book.is_first_run("inbound") and book.compact(1) and book.is_first_run("inbound")
    assert state(book.entries()) == [("reports", "r.csv", "landed")]


def test_date_ledger(spark, tmp_path):
    book = ledger.DateLedger(spark, str(tmp_path / "dates"))
    days = [DAY + timedelta(days=n) for n in range(3)]
    candidates = spark.createDataFrame([("claims", d) for d in days], "scope string, business_date date")
    assert ledger.ledger_dates(book.pending(candidates)) == days
    book.record("claims", days[:1]), book.record("claims", days[:1])
    assert not book.needs("claims", days[0]) and book.needs("claims", days[0], force=True) and book.needs("claims", days[1])
    assert ledger.ledger_dates(book.pending(candidates)) == days[1:]
    assert ledger.ledger_dates(book.pending(candidates, force=True)) == days
    assert book.done().count() == 1 and not book.is_first_run("claims") and book.is_first_run("policies")


def test_audit_pairs_by_name_and_skips_empty_runs(spark, tmp_path):
    landed = spark.createDataFrame([("b.csv", "gs://k/bronze/reports/b.csv"), ("a.csv", "gs://k/bronze/inbound/a.csv")], "file_name string, uri string")
    stats = spark.createDataFrame([("a.csv", "claims", 2, 0), ("c.csv", "claims", 9, 9), ("b.csv", "premiums", 3, 0)], "file_name string, file_type string, rows_valid bigint, rows_dropped bigint")
    rows = audit.audit_rows(landed, stats, audit.new_run_id(), DAY)
    assert sorted((r.dir_id, r.file_type, r.rows_valid, r.gcs_prefix) for r in rows.collect()) == [
        ("inbound", "claims", 2, "k/bronze/inbound"), ("reports", "premiums", 3, "k/bronze/reports"),
    ]
    path = str(tmp_path / "audit")
    assert audit.write_audit(rows, path) and not audit.write_audit(rows.limit(0), path)
    assert spark.read.parquet(path).count() == 2


def test_partition_replace_and_truncate(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = lambda n, day: spark.range(n).select("id", F.lit(day).cast("date").alias("ingestion_date"))
    other = DAY + timedelta(days=1)
    replace_date(rows(3, DAY), path, "ingestion_date", DAY)
    replace_date(rows(4, other), path, "ingestion_date", other)
    replace_date(rows(2, DAY), path, "ingestion_date", DAY)
    count = lambda: {r.ingestion_date: r["count"] for r in spark.read.parquet(path).groupBy("ingestion_date").count().collect()}
    assert count() == {DAY: 2, other: 4}
    replace_date(rows(0, DAY), path, "ingestion_date", DAY)
    assert count() == {other: 4}
    table = str(tmp_path / "dim")
    truncate_load(rows(5, DAY), table, ["id"]), truncate_load(rows(1, DAY), table, ["id"])
    assert spark.read.parquet(table).count() == 1


def test_retention(spark):
    rows = [(layer, DAY - timedelta(days=n)) for layer in ("bronze", "dead_letter", "silver") for n in (30, 31, 90, 91)]
    found = expired_partitions(spark.createDataFrame(rows, "layer string, partition_date date"), DAY)
    assert sorted((r.layer, (DAY - r.partition_date).days) for r in found.collect()) == [
        ("bronze", 91), ("dead_letter", 31), ("dead_letter", 90), ("dead_letter", 91),
    ]


def test_expired_files_are_deleted(spark, tmp_path):
    for layer, age in (("bronze", 90), ("bronze", 91), ("dead_letter", 31), ("silver", 500)):
        day = DAY - timedelta(days=age)
        write_csv(tmp_path / f"{layer}/d/e/year={day.year}/month={day.month:02d}/day={day.day:02d}/{layer}{age}.csv", [{"a": "1"}])
    write_csv(tmp_path / "bronze/d/e/loose.csv", [{"a": "1"}])
    assert expire_layers(spark, str(tmp_path), DAY) == 2
    assert sorted(p.name for p in tmp_path.rglob("*.csv")) == ["bronze90.csv", "loose.csv", "silver500.csv"]
    assert expire_layers(spark, str(tmp_path), DAY) == 0


def test_directories_are_whole():
    assert [d["dir_id"] for d in DIRECTORIES] == ["inbound", "reports"]


def test_clustered_files_hold_ranges_of_their_own(spark, tmp_path):
    """Footers show separate ranges of the cluster column; a value with a third of the rows lies in several files."""
    rows = spark.range(30_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'POL-00005000' ELSE concat('POL-', lpad(CAST((id * 7919) % 10000 AS STRING), 8, '0')) END AS policy_id",
        "IF(id % 2 = 0, 'PAID', 'OVERDUE') AS status", "DATE '2026-05-14' AS ingestion_date",
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        replace_partitions(rows, str(tmp_path / "t"), ["ingestion_date"], ["policy_id", "status"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    ranges = []
    for path in (tmp_path / "t").rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        column = next(i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == "policy_id")
        stats = [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
    ranges.sort()
    assert sum(n for *_, n in ranges) == 30_000 and 8 <= len(ranges) <= 12
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(low == high == "POL-00005000" for low, high, _ in ranges) >= 2
    assert max(n for *_, n in ranges) < 6_000


def test_sidecars_are_read_in_a_fixed_number_of_tasks(spark, tmp_path):
    for n in range(300):
        (tmp_path / f"{n:03d} +%41.csv.sha256").write_text(f"\n AB{n:02d}  x.csv\n")
    for name in (".hidden.csv.sha256", "_hidden.csv.sha256", "other.csv"):
        (tmp_path / name).write_text("ff")
    (tmp_path / "empty.csv.sha256").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        read = read_sidecars(spark, str(tmp_path))
        assert {(r.file_name, r.expected) for r in read.collect()} == {(f"{n:03d} +%41.csv", f"ab{n:02d}") for n in range(300)}
        assert read.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", SETTINGS["spark.sql.files.maxPartitionBytes"])


def test_scans_deal_tables_out_in_splits_a_task_can_sort(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert apply_settings(spark).conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_shuffle_files_go_when_their_job_ends(spark, tmp_path):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")}

    before = shuffled()
    truncate_load(apply_settings(spark).range(100_000).withColumn("k", F.col("id") % 1000), str(tmp_path / "t"), ["k"])
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
