"""Expected files, arrival checks, name-to-entity inference and new-file deltas."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.functions import names
from coverlake.sources.manifest import manifest_files
from coverlake.specs import REGISTRY


class ArrivalIncomplete(RuntimeError):
    """More expected files are missing than the allowance."""


def expected_files(manifest: DataFrame, dates: DataFrame) -> DataFrame:
    """(dir_id, business_date, entity, kind, file_name) of each file due on the given dates.

    The manifest is small configuration, carried as one array value next to each date, so no join is needed. `dates`
    has one column `business_date`.
    """
    entries = manifest_files(manifest).collect()
    wanted = F.array(
        *[
            F.struct(
                F.lit(e.dir_id).alias("dir_id"),
                F.lit(e.entity).alias("entity"),
                F.lit(kind).alias("kind"),
                F.lit(pattern).alias("pattern"),
            )
            for e in entries
            for kind, pattern in (("data", e.pattern), ("checksum", e.checksum))
            if kind == "data" or (e.use_checksum and pattern)
        ]
    )
    due = dates.select("business_date", F.explode(wanted).alias("due"))
    return due.select(
        "due.dir_id",
        "business_date",
        "due.entity",
        "due.kind",
        names.expected_name(F.col("due.pattern"), F.col("business_date")).alias("file_name"),
    )


def calendar(manifest: DataFrame, first: date, last: date) -> DataFrame:
    """Every date of a range as `business_date`."""
    spark = manifest.sparkSession
    days = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return spark.range(1).select(days.alias("business_date"))


def arrivals(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Each file of a directory and date with whether it was expected and whether it is there."""
    keys = ["dir_id", "business_date", "file_name"]
    due = expected.select(*keys).distinct().withColumn("expected", F.lit(True))
    there = actual.select(*keys).distinct().withColumn("actual", F.lit(True))
    return due.join(there, keys, "full_outer").na.fill(False, ["expected", "actual"])


def arrival_report(expected: DataFrame, actual: DataFrame, allowed_missing: int = 0) -> DataFrame:
    """Per directory and date: expected, actual, missing and unexpected counts and whether it is complete."""
    missing = F.count_if(F.col("expected") & ~F.col("actual"))
    return (
        arrivals(expected, actual)
        .groupBy("dir_id", "business_date")
        .agg(
            F.count_if("expected").alias("expected_files"),
            F.count_if("actual").alias("actual_files"),
            missing.alias("missing_files"),
            F.count_if(F.col("actual") & ~F.col("expected")).alias("unexpected_files"),
            (missing <= allowed_missing).alias("is_complete"),
        )
    )


def missing_files(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return (
        arrivals(expected, actual)
        .where(F.col("expected") & ~F.col("actual"))
        .select("dir_id", "business_date", "file_name")
        .orderBy("dir_id", "business_date", "file_name")
    )


def unexpected_files(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return (
        arrivals(expected, actual)
        .where(F.col("actual") & ~F.col("expected"))
        .select("dir_id", "business_date", "file_name")
        .orderBy("dir_id", "business_date", "file_name")
    )


def require_complete(expected: DataFrame, actual: DataFrame, allowed_missing: int = 0) -> None:
    """Raise with the missing names when a directory and date is short of files."""
    incomplete = arrival_report(expected, actual, allowed_missing).where(~F.col("is_complete"))
    short = missing_files(expected, actual).join(incomplete.select("dir_id", "business_date"), ["dir_id", "business_date"])
    names_per_dir: dict[str, list[str]] = {}
    for row in short.orderBy("dir_id", "file_name").collect():
        names_per_dir.setdefault(row.dir_id, []).append(row.file_name)
    if names_per_dir:
        raise ArrivalIncomplete(f"Arrival check FAILED. Missing: {names_per_dir}")


def with_encrypted_names(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add the name a decrypted file had when it arrived: `x.csv` of an encrypted directory is also `x.csv.gpg`."""
    flags = manifest.select("dir_id", "use_pgp")
    plain_data = names.is_data_file(F.col("file_name")) & F.coalesce("use_pgp", F.lit(False))
    both = F.array_compact(
        F.array("file_name", F.when(plain_data, F.concat("file_name", F.lit(names.ENCRYPTED_SUFFIX))))
    )
    return files.join(flags, "dir_id", "left").withColumn("file_name", F.explode(both)).drop("use_pgp")


def infer_entities(files: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Add the `entity` a file name starts with, any case; null when none matches.

    The directory's own entries are tried first, then every registered entity; within each the first match wins. The
    entries come as one array per directory by an equality join, so no pair of file and entity is ever formed.
    """
    lowered = F.lower("file_name")
    known = F.array(*[F.lit(e) for e in REGISTRY])

    def first_match(entities):
        return F.get(F.filter(entities, lambda e: lowered.startswith(e)), F.lit(0))

    if manifest is None:
        return files.withColumn("entity", first_match(known))
    own = manifest.select("dir_id", F.transform("files", lambda f: f["entity"]).alias("_own"))
    matched = F.coalesce(first_match(F.coalesce("_own", F.array().cast("array<string>"))), first_match(known))
    return files.join(own, "dir_id", "left").withColumn("entity", matched).drop("_own")


def directory_entities(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """As `infer_entities`, but only the directory's own entries count (used where files are landed)."""
    lowered = F.lower("file_name")
    own = manifest.select("dir_id", F.transform("files", lambda f: f["entity"]).alias("_own"))
    matched = F.get(F.filter("_own", lambda e: lowered.startswith(e)), F.lit(0))
    return files.join(own, "dir_id", "left").withColumn("entity", matched).drop("_own")


def infer_entity(file_name: str, own_entities: list[str] | None = None) -> str:
    """The entity of one name; an error when nothing matches."""
    for entity in [*(own_entities or []), *REGISTRY]:
        if file_name.lower().startswith(entity):
            return entity
    raise ValueError(f"Cannot determine file type of {file_name!r}; it starts with none of {list(REGISTRY)}")


def new_files(listing: DataFrame, processed: DataFrame) -> DataFrame:
    """Listed files the ledger does not hold; everything on a first run."""
    return listing.join(processed.select("dir_id", "file_name"), ["dir_id", "file_name"], "left_anti")
