"""Data files against their SHA-256 sidecars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ChecksumFailed(RuntimeError):
    """A sidecar's data file is missing or has another digest."""


def checksum_report(sidecars: DataFrame, digests: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(file_name, expected, actual, ok) per sidecar. A file without a sidecar is not checked; a sidecar without a file
    fails."""
    keys = keys or ["file_name"]
    return sidecars.join(digests, keys, "left").select(
        *keys, "expected", "actual", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)).alias("ok")
    )


def require_checksums(report: DataFrame) -> None:
    failed = sorted(r.file_name for r in report.where(~F.col("ok")).select("file_name").collect())
    if failed:
        raise ChecksumFailed(f"Checksum validation FAILED for: {failed}")
