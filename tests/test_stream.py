"""Streams give what batch runs give, whatever the arrival order."""

from datetime import timedelta

from conftest import CLAIMS, DAY, PREMIUMS, land_day, write_csv
from coverlake.plans.ingest import ingest_directory
from coverlake.plans.layout import Lake
from coverlake.plans.silver import merge_files, silver_backfill
from coverlake.sources.manifest import DIRECTORIES
from coverlake.streaming.incremental import stream_ingest, stream_silver


def bronze_file(root, day, name, rows, directory="inbound"):
    folder = root / f"bronze/{directory}/claims/year={day.year}/month={day.month:02d}/day={day.day:02d}"
    return write_csv(folder / name, rows)


def contents(spark, lake):
    table = spark.read.option("mergeSchema", True).parquet(f"{lake.silver}/claims").drop("_ingested_at", "_source_file", "_block_start", "_row_id")
    return sorted(tuple(map(str, r)) for r in table.select(*sorted(table.columns)).collect())


def test_stream_equals_batch_with_a_late_file(spark, tmp_path):
    streamed, batch = Lake(str(tmp_path / "a")), Lake(str(tmp_path / "b"))
    checkpoint = str(tmp_path / "checkpoint")

    def both(*args):
        for lake in (streamed, batch):
            bronze_file(tmp_path / lake.root.rsplit("/", 1)[-1], *args)

    both(DAY, "claims_1.csv", CLAIMS)
    both(DAY + timedelta(days=1), "claims_2.csv", CLAIMS)
    stream_silver(spark, streamed, "claims", checkpoint, DAY, files_per_batch=1).awaitTermination()
    first = contents(spark, streamed)
    stream_silver(spark, streamed, "claims", checkpoint, DAY).awaitTermination()
    assert contents(spark, streamed) == first
    both(DAY, "claims_3.csv", [dict(CLAIMS[0], claimed_amount="1.0"), dict(CLAIMS[0], claim_id="CLM-20260007")])
    stream_silver(spark, streamed, "claims", checkpoint, DAY).awaitTermination()
    silver_backfill(spark, batch, "claims", as_of=DAY)
    assert contents(spark, streamed) == contents(spark, batch) and len(contents(spark, streamed)) == 5


def test_a_batch_reads_its_own_files_only_and_equals_a_rebuild(spark, tmp_path):
    """Files of earlier batches are gone when the late and the repeated ones come."""
    streamed, batch = Lake(str(tmp_path / "a")), Lake(str(tmp_path / "b"))
    checkpoint = str(tmp_path / "checkpoint")
    later = DAY + timedelta(days=1)
    deliveries = [
        [(DAY, "claims_2.csv", CLAIMS), (later, "claims_1.csv", CLAIMS[:1])],
        # stands before the stored file, so its row loses; a new column; another key
        [(DAY, "claims_1.csv", [dict(CLAIMS[0], claimed_amount="1.0", note="x"), dict(CLAIMS[1], claim_id="CLM-20260009", note="y")])],
        [(DAY, "claims_3.csv", [dict(CLAIMS[1], claimed_amount="3.0"), dict(CLAIMS[1], claimed_amount="4.0")]), (later, "claims_2.csv", CLAIMS)],
    ]
    for files in deliveries:
        for day, name, rows in files:
            for root in ("a", "b"):
                bronze_file(tmp_path / root, day, name, rows)
        stream_silver(spark, streamed, "claims", checkpoint, DAY).awaitTermination()
        for day, name, _ in files:
            (tmp_path / f"a/bronze/inbound/claims/year={day.year}/month={day.month:02d}/day={day.day:02d}/{name}").unlink()
    silver_backfill(spark, batch, "claims", as_of=DAY)
    assert contents(spark, streamed) == contents(spark, batch) and len(contents(spark, batch)) == 5
    # the last batch once more, as after a lost driver
    for name, rows in (("claims_3.csv", deliveries[2][0][2]),):
        path = bronze_file(tmp_path / "a", DAY, name, rows)
        files = spark.createDataFrame([(f"file:{path}", path.stat().st_size)], "path string, length long")
        merge_files(spark, streamed, "claims", files, DAY)
    assert contents(spark, streamed) == contents(spark, batch)


def test_ingest_stream_lands_each_file_once(spark, tmp_path):
    land_day(tmp_path)
    lake, checkpoint = Lake(str(tmp_path)), str(tmp_path / "checkpoint")
    reports = DIRECTORIES[1]
    stream_ingest(spark, lake, reports, DAY, checkpoint).awaitTermination()
    bad = [dict(PREMIUMS[0], currency="EURO")]
    write_csv(tmp_path / "landing/reports/premiums_late.csv", bad)
    stream_ingest(spark, lake, reports, DAY, checkpoint).awaitTermination()
    landed = spark.read.option("recursiveFileLookup", True).option("header", True).csv(f"{lake.bronze}/reports/premiums")
    assert landed.count() == 2 and {f.rsplit("/", 1)[-1] for f in landed.inputFiles()} == {"premiums_20260514.csv"}
    dead = spark.read.option("recursiveFileLookup", True).text(f"{lake.root}/dead_letter/reports/premiums")
    assert [f.rsplit("/", 1)[-1] for f in dead.inputFiles()] == ["premiums_late.csv"]
    assert ingest_directory(spark, lake, reports, DAY).new_files == 0
    audit = spark.read.parquet(lake.audit)
    assert sorted(r.file_type for r in audit.collect()) == ["premiums", "reinsurance"]
