"""File names, patterns, partition paths and the predicates on them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDECAR_SUFFIX = ".sha256"
ENCRYPTED_SUFFIX = ".gpg"
DATA_SUFFIX = ".csv"

# The strftime directives a file pattern may use, with their Spark date formats.
DATE_DIRECTIVES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%y": "yy", "%H": "HH", "%M": "mm", "%S": "ss", "%j": "DDD"}


def expected_name(pattern: Column, day: Column) -> Column:
    """Fill a strftime pattern such as `claims_%Y%m%d.csv` with a date."""
    name = pattern
    stamp = day.cast("timestamp")
    for directive, spark_format in DATE_DIRECTIVES.items():
        name = F.replace(name, F.lit(directive), F.date_format(stamp, spark_format))
    return name


def compact_date(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def plain_path(uri: Column) -> Column:
    """The readable form of a URL-encoded path as the hidden file metadata gives it (a plus sign is literal there)."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def is_data_file(name: Column) -> Column:
    return name.endswith(DATA_SUFFIX)


def is_sidecar(name: Column, suffix: str = SIDECAR_SUFFIX) -> Column:
    return name.endswith(suffix)


def is_encrypted(name: Column) -> Column:
    return name.endswith(ENCRYPTED_SUFFIX)


def is_visible(name: Column) -> Column:
    return ~name.startswith(".")


def strip_suffix(name: Column, suffix: str) -> Column:
    return F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)


def partition_date(year: Column, month: Column, day: Column) -> Column:
    """Date of a year/month/day partition; null for impossible values."""
    parts = [F.lpad(c.cast("string"), n, "0") for c, n in ((year, 4), (month, 2), (day, 2))]
    return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2]).try_cast("date")


def path_date(path: Column) -> Column:
    """Date of a `.../year=2026/month=05/day=14/...` path; null when a part is missing or malformed."""
    parts = [F.nullif(F.regexp_extract(path, rf"/{p}=([0-9]+)/", 1), F.lit("")) for p in ("year", "month", "day")]
    return partition_date(*parts)


def date_path(day: date) -> str:
    return f"year={day.year}/month={day.month:02d}/day={day.day:02d}"


def date_partition_columns(day: Column) -> dict[str, Column]:
    """Partition values written as text, so month and day keep their leading zero."""
    return {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }


def without_scheme(uri: Column) -> Column:
    return F.regexp_replace(uri, "^[a-z0-9]+://", "")


def uri_directory(uri: Column) -> Column:
    """Directory id of `bucket/bronze/{dir_id}/...`; empty text for other paths."""
    parts = F.split(without_scheme(uri), "/")
    return F.when((F.size(parts) >= 3) & (F.get(parts, F.lit(1)) == "bronze"), F.get(parts, F.lit(2))).otherwise("")


def uri_prefix(uri: Column) -> Column:
    """The URI without scheme and file name."""
    parts = F.split(without_scheme(uri), "/")
    return F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/")
