"""The whole day: ingest every directory, silver, gold, audit and the run report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlake.operators import audit, ledger
from coverlake.plans.gold import load_gold
from coverlake.plans.ingest import IngestResult, ingest_directory
from coverlake.plans.layout import Lake
from coverlake.plans.silver import silver_all
from coverlake.plans.together import run_together
from coverlake.sources.local import local_frame, struct
from coverlake.sources.manifest import DIRECTORIES, manifest_table


@dataclass
class DayResult:
    run_id: str
    ingests: list[IngestResult]
    silver: dict[str, str]
    gold: dict[str, str]
    report: DataFrame


def status_table(spark: SparkSession, statuses: dict[str, str]) -> DataFrame:
    rows = [{"step": step, "status": status} for step, status in statuses.items()]
    return local_frame(spark, rows, struct(step=T.StringType(), status=T.StringType()))


def run_day(
    spark: SparkSession,
    lake_root: str,
    day: date,
    directories: list[dict] = DIRECTORIES,
    allowed_missing: int = 0,
    force: bool = False,
    as_of: date | None = None,
    lookback_from: date | None = None,
) -> DayResult:
    """Run every step for a business date; a second run of the same date changes nothing.

    `lookback_from`, usually the day the run takes place, bounds the ledger months and files that are read.
    """
    lake = Lake(lake_root)
    run_id = audit.new_run_id()
    jobs = {
        d["dir_id"]: partial(ingest_directory, spark, lake, d, day, run_id, allowed_missing, lookback_from)
        for d in directories
    }
    ingests = list(run_together(jobs).values())
    ledger.FileLedger(spark, lake.file_ledger).compact()
    silver = silver_all(spark, lake, day, force, as_of)
    if failed := {e: s for e, s in silver.items() if s.startswith("error: ")}:
        raise RuntimeError(f"No gold load, as silver was not written for {failed}")
    gold = load_gold(spark, lake, day, force)

    outcomes = ingests[0].outcomes
    for result in ingests[1:]:
        outcomes = outcomes.unionByName(result.outcomes)
    landed = outcomes.where(F.col("outcome") == ledger.LANDED)
    audit.write_audit(audit.audit_rows(landed, outcomes, run_id, day), lake.audit)
    report = audit.run_report(
        manifest_table(spark, directories), landed, status_table(spark, silver), status_table(spark, gold)
    )
    return DayResult(run_id, ingests, silver, gold, report)
