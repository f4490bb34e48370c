"""Ledgers of processed files, silver dates and gold dates: append-only tables read as their latest state.

A reset is a marker row. Only entries after the last marker of a scope count.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlake.sinks.tables import clustered
from coverlake.sources.landing import paths_like
from coverlake.sources.local import local_frame, struct
from coverlake.sources.tables import read_or_empty

FILE_LEDGER_TYPE = T.StructType(
    [
        T.StructField("dir_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("uri", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("month", T.StringType()),
    ]
)

DATE_LEDGER_TYPE = T.StructType(
    [
        T.StructField("scope", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)

RESET = "reset"
LANDED = "landed"
REJECTED = "rejected"
SIDECAR = "sidecar"
IGNORED = "ignored"
DONE = "done"

LOOKBACK_MONTHS = 3
#: Log files after the last snapshot from which on a new snapshot is worth its write.
COMPACT_FILES = 200
#: Log files changed so long before a snapshot are read beside it: covers slow commits and clocks that differ.
OVERLAP = timedelta(days=1)
SNAPSHOT_TIME = "%Y%m%dT%H%M%S%f"


def lookback(entries: DataFrame, as_of: date, months: int = LOOKBACK_MONTHS) -> DataFrame:
    """Only the current month and the given number before it, by the month partition column."""
    first = F.date_format(F.add_months(F.lit(as_of).cast("date"), -months), "yyyy-MM")
    return entries.where(F.col("month") >= first)


def within_lookback(listing: DataFrame, as_of: date, months: int = LOOKBACK_MONTHS) -> DataFrame:
    """Files of a listing that changed in the months that `lookback` reads."""
    first = F.trunc(F.add_months(F.lit(as_of).cast("date"), -months), "month")
    return listing.where(F.col("modified_at") >= first.cast("timestamp"))


def after_reset(entries: DataFrame, scope: str) -> DataFrame:
    """Entries recorded after the last reset marker of their scope. There is one reset time per scope, found by a
    pre-aggregated maximum."""
    resets = (
        entries.where(F.col("outcome") == RESET).groupBy(scope).agg(F.max("recorded_at").alias("_reset_at"))
    )
    return (
        entries.where(F.col("outcome") != RESET)
        .join(resets, scope, "left")
        .where(F.col("_reset_at").isNull() | (F.col("recorded_at") > F.col("_reset_at")))
        .drop("_reset_at")
    )


def current_files(entries: DataFrame) -> DataFrame:
    """The latest entry per file since the last reset."""
    details = F.struct("business_date", "uri", "outcome", "recorded_at")
    return (
        after_reset(entries, "dir_id")
        .groupBy("dir_id", "file_name")
        .agg(F.max_by(details, F.col("recorded_at")).alias("entry"))
        .select("dir_id", "file_name", "entry.*")
    )


def folded(entries: DataFrame) -> DataFrame:
    """What later reads need of the entries: the latest one per file, and each directory's last reset marker.

    Entries that are folded twice, or are read beside their snapshot, change nothing: the latest still wins.
    """
    markers = (
        entries.where(F.col("outcome") == RESET)
        .groupBy("dir_id")
        .agg(F.max_by(F.struct("business_date", "recorded_at"), F.col("recorded_at")).alias("marker"))
        .select(
            "dir_id", F.lit(None).cast("string").alias("file_name"), "marker.business_date",
            F.lit(None).cast("string").alias("uri"), F.lit(RESET).alias("outcome"), "marker.recorded_at",
        )
    )
    return current_files(entries).unionByName(markers).withColumn("month", F.date_format("business_date", "yyyy-MM"))


def current_dates(entries: DataFrame) -> DataFrame:
    """Distinct (scope, date) since the last reset; recording a date twice changes nothing."""
    return (
        after_reset(entries, "scope")
        .groupBy("scope", "business_date")
        .agg(F.max("recorded_at").alias("recorded_at"))
    )


def pending_dates(candidates: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Candidate (scope, business_date) rows not yet done; all of them when forced."""
    wanted = candidates.select("scope", "business_date").distinct()
    if force:
        return wanted
    return wanted.join(done.select("scope", "business_date"), ["scope", "business_date"], "left_anti")


def ledger_summary(entries: DataFrame, scope: str, current: DataFrame) -> DataFrame:
    """Per scope that was ever written: entries that count now, first-run flag, time of the last write."""
    written = entries.groupBy(scope).agg(F.max("recorded_at").alias("last_updated"))
    held = current.groupBy(scope).agg(F.count(F.lit(1)).alias("processed"))
    return (
        written.join(held, scope, "left")
        .na.fill(0, ["processed"])
        .select(scope, "processed", (F.col("processed") == 0).alias("is_first_run"), "last_updated")
    )


class FileLedger:
    """Files seen, as a log of entries with a snapshot of its older part.

    The log is partitioned by directory and month and only ever grows. A snapshot has one row per file; readers take the
    newest finished one with the log files changed since, so neither the age of the lake nor the number of its runs
    makes them open more log files.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.snapshots = f"{path}_snapshots"

    def newest_snapshot(self) -> tuple[str, datetime] | None:
        """Folder of the newest snapshot whose write has ended, and when it was begun."""
        finished = sorted(p.rsplit("/", 1)[0] for p in paths_like(self.spark, f"{self.snapshots}/folded_at=*/_SUCCESS"))
        if not finished:
            return None
        begun = datetime.strptime(finished[-1].rsplit("=", 1)[1], SNAPSHOT_TIME)
        return finished[-1], begun.replace(tzinfo=timezone.utc)

    def tail(self, since: datetime | None) -> DataFrame:
        """The log, or its files changed after a time, less the overlap."""
        if since is None:
            return read_or_empty(self.spark, self.path, FILE_LEDGER_TYPE)
        after = f"{since - OVERLAP:%Y-%m-%dT%H:%M:%S}"
        reader = self.spark.read.schema(FILE_LEDGER_TYPE).option("timeZone", "UTC").option("modifiedAfter", after)
        return reader.parquet(self.path)

    def entries(self, as_of: date | None = None, months: int = LOOKBACK_MONTHS) -> DataFrame:
        """Snapshot and later entries; with `as_of`, the log's entries of the lookback alone."""
        if as_of is not None:
            return lookback(self.tail(None), as_of, months)
        snapshot = self.newest_snapshot()
        if snapshot is None:
            return self.tail(None)
        folder, begun = snapshot
        return self.spark.read.schema(FILE_LEDGER_TYPE).parquet(folder).unionByName(self.tail(begun))

    def compact(self, least_files: int = COMPACT_FILES) -> bool:
        """Write a snapshot if so many log files lie after the last one; whether one was written.

        It is made of the last snapshot and what came since. Nothing else is touched: a write that breaks off leaves a
        folder that no reader takes.
        """
        snapshot = self.newest_snapshot()
        if len(self.tail(snapshot and snapshot[1]).inputFiles()) < least_files:
            return False
        begun = datetime.now(timezone.utc)
        rows = clustered(folded(self.entries()), ["dir_id"], ["file_name"])
        rows.write.mode("overwrite").partitionBy("dir_id").parquet(f"{self.snapshots}/folded_at={begun:{SNAPSHOT_TIME}}")
        return True

    def processed(self, as_of: date | None = None, months: int = LOOKBACK_MONTHS) -> DataFrame:
        return current_files(self.entries(as_of, months))

    def is_first_run(self, dir_id: str) -> bool:
        return self.processed().where(F.col("dir_id") == dir_id).isEmpty()

    def record(self, dir_id: str, files: DataFrame) -> None:
        """Append entries of one directory; `files` has file_name, business_date, uri and outcome.

        Each directory appends to its own folder, so directories that finish together do not share a commit.
        """
        stamped = files.select(
            "file_name", "business_date", "uri", "outcome", F.current_timestamp().alias("recorded_at"),
            F.date_format("business_date", "yyyy-MM").alias("month"),
        )
        stamped.write.mode("append").partitionBy("month").parquet(f"{self.path}/dir_id={dir_id}")

    def reset(self, dir_id: str, as_of: date) -> None:
        marker = self.spark.range(1).select(
            F.lit(None).cast("string").alias("file_name"),
            F.lit(as_of).cast("date").alias("business_date"),
            F.lit(None).cast("string").alias("uri"),
            F.lit(RESET).alias("outcome"),
        )
        self.record(dir_id, marker)

    def summary(self) -> DataFrame:
        return ledger_summary(self.entries(), "dir_id", self.processed())


class DateLedger:
    """Dates done, partitioned by scope: an entity for silver, a fact table for gold."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def entries(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, DATE_LEDGER_TYPE)

    def done(self) -> DataFrame:
        return current_dates(self.entries())

    def is_done(self, scope: str, day: date) -> bool:
        return not self.done().where((F.col("scope") == scope) & (F.col("business_date") == F.lit(day))).isEmpty()

    def needs(self, scope: str, day: date, force: bool = False) -> bool:
        return force or not self.is_done(scope, day)

    def is_first_run(self, scope: str) -> bool:
        return self.done().where(F.col("scope") == scope).isEmpty()

    def pending(self, candidates: DataFrame, force: bool = False) -> DataFrame:
        return pending_dates(candidates, self.done(), force)

    def record(self, scope: str, dates: list[date], outcome: str = DONE) -> None:
        """Append dates of one scope, in the scope's own folder."""
        if not dates:
            return
        schema = struct(business_date=T.DateType(), outcome=T.StringType())
        rows = local_frame(self.spark, [{"business_date": d, "outcome": outcome} for d in dates], schema)
        stamped = rows.withColumn("recorded_at", F.current_timestamp()).coalesce(1)
        stamped.write.mode("append").parquet(f"{self.path}/scope={scope}")

    def reset(self, scope: str) -> None:
        self.record(scope, [date(1970, 1, 1)], RESET)

    def summary(self) -> DataFrame:
        return ledger_summary(self.entries(), "scope", self.done())


OPEN = "open"
CLOSED = "closed"


class IntentJournal:
    """What a run is about to replace: an entry before each write and one after it.

    A run that dies in between leaves its dates open. Whether the write happened in part or not at all, they are redone
    at the next start from what they are derived from, also where the ledger has them from an earlier run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.book = DateLedger(spark, path)

    @contextmanager
    def during(self, scope: str, dates: list[date]) -> Iterator[None]:
        """The dates are open from here until the block has ended well."""
        self.book.record(scope, dates, OPEN)
        yield
        self.book.record(scope, dates, CLOSED)

    def unfinished(self, scope: str) -> list[date]:
        """Dates whose latest entry is open."""
        latest = (
            self.book.entries()
            .where(F.col("scope") == scope)
            .groupBy("business_date")
            .agg(F.max_by(F.col("outcome"), F.struct("recorded_at", F.col("outcome") == CLOSED)).alias("outcome"))
        )
        return ledger_dates(latest.where(F.col("outcome") == OPEN))


def ledger_dates(frame: DataFrame) -> list[date]:
    """Sorted distinct dates of a small ledger frame; at most one per calendar day."""
    return [r.business_date for r in frame.select("business_date").distinct().orderBy("business_date").collect()]
