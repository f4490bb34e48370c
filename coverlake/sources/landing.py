"""What lies in the landing folders: listing, sidecars, digests and CSV headers."""

from __future__ import annotations

import csv
import hashlib
import io
import itertools
import os
import sys
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlake.functions import names
from coverlake.sources.local import empty_frame, struct

# The file helpers below travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING_TYPE = T.StructType(
    [
        T.StructField("dir_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
    ]
)

CHUNK_BYTES = 1024 * 1024

# What can be wrong with a file before its rows are looked at.
UNREADABLE = "unreadable_header"
NOT_UTF8 = "not_utf8"
REPEATED_COLUMN = "repeated_column"
RESERVED_COLUMN = "reserved_column"
LISTING_BATCH = 10_000


def paths_like(spark: SparkSession, path: str) -> list[str]:
    """What a path or pattern stands for, asked of the filesystem rather than found out by a failed query."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found or ()]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern stands for anything."""
    return bool(paths_like(spark, path))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files a path or pattern stands for, folders with all that is in them."""
    places = [spark._jvm.org.apache.hadoop.fs.Path(found) for found in paths_like(spark, path)]
    conf = spark._jsc.hadoopConfiguration()
    return sum(place.getFileSystem(conf).getContentSummary(place).getLength() for place in places)


def _filesystem(path: str):
    """Filesystem and inner path for a path as Spark writes it (not URL-encoded)."""
    from pyarrow import fs

    scheme, found, rest = path.partition(":")
    if not found or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if found else path).lstrip("/")
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


def open_stream(path: str):
    """A sequential byte stream, opened on the executor."""
    filesystem, inner = _filesystem(path)
    return filesystem.open_input_stream(inner)


def _listing_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        for folder in batch["folder"]:
            filesystem, inner = _filesystem(folder)
            found = filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True))
            files = [f for f in found if f.type == fs.FileType.File]
            for start in range(0, len(files), LISTING_BATCH):
                part = files[start : start + LISTING_BATCH]
                yield pd.DataFrame(
                    {
                        "file_name": [f.base_name for f in part],
                        "path": [f"{folder.rstrip('/')}/{f.base_name}" for f in part],
                        "length": [f.size for f in part],
                        "modified_at": pd.to_datetime([f.mtime_ns // 1000 for f in part], unit="us", utc=True),
                    }
                )


def list_directory(spark: SparkSession, path: str, dir_id: str) -> DataFrame:
    """Files directly in a folder, dot-files left out; an absent folder lists as empty.

    A file scan would leave out empty files, which here count as arrived and fail the gate, so one task per folder asks
    the filesystem.
    """
    schema = "file_name string, path string, length long, modified_at timestamp"
    files = spark.range(1).select(F.lit(path).alias("folder")).mapInPandas(_listing_batches, schema)
    return files.where(names.is_visible(F.col("file_name"))).select(F.lit(dir_id).alias("dir_id"), "*")


def expected_digest(text: Column) -> Column:
    """First word of a sidecar (`<hex>` or `<hex>  <file name>`), lower-cased."""
    return F.lower(F.element_at(F.split(F.regexp_replace(text, r"^\s+", ""), r"\s+"), 1))


def _names_in(folder: str) -> Iterator[str]:
    """Names of the files directly in a folder, streamed where the filesystem can."""
    from pyarrow import fs

    filesystem, inner = _filesystem(folder)
    if isinstance(filesystem, fs.LocalFileSystem):
        with os.scandir(inner) as entries:
            yield from (entry.name for entry in entries if entry.is_file())
    else:
        yield from (f.base_name for f in filesystem.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File)


def _visible_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for folder in batch["folder"]:
            shown = (name for name in _names_in(folder) if not name.startswith((".", "_")))
            while part := list(itertools.islice(shown, LISTING_BATCH)):
                yield pd.DataFrame({"name": part})


def _content_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        contents = []
        for path in batch["path"]:
            with open_stream(path) as stream:
                contents.append(stream.read())
        read = batch.assign(content=contents)[["name", "content"]]
        yield read[[len(content) > 0 for content in contents]]


def read_sidecars(spark: SparkSession, path: str, suffix: str = names.SIDECAR_SUFFIX) -> DataFrame:
    """(file_name, expected) of each sidecar in a folder; the name is that of the data file it speaks for.

    Sidecars are many and tiny. A file scan packs them by what it takes an open to cost, a task for a few files, and keeps
    the status of every file of the folder in the driver; here one task streams the names and a fixed number of tasks
    open the files. Hidden and empty files are left out, as scans do.
    """
    schema = struct(file_name=T.StringType(), expected=T.StringType())
    if not path_exists(spark, path):
        return empty_frame(spark, schema)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = spark.range(1).select(F.lit(path).alias("folder")).mapInPandas(_visible_names, "name string")
    dealt = listed.where(names.is_sidecar(F.col("name"), suffix)).repartition(tasks, "name")
    paths = dealt.select("name", F.concat(F.lit(f"{path.rstrip('/')}/"), "name").alias("path"))
    return paths.mapInPandas(_content_batches, "name string, content binary").select(
        names.strip_suffix(F.col("name"), suffix).alias("file_name"),
        expected_digest(F.col("content").cast("string")).alias("expected"),
    )


def _digest(path: str) -> str | None:
    digest = hashlib.sha256()
    try:
        with open_stream(path) as stream:
            while chunk := stream.read(CHUNK_BYTES):
                digest.update(chunk)
    except FileNotFoundError:
        return None
    return digest.hexdigest()


def _digest_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(actual=[_digest(path) for path in batch["path"]])


def file_digests(files: DataFrame) -> DataFrame:
    """(file_name, actual) SHA-256 of the listed files (path), read in chunks whatever their size.

    Only the files named are opened; one that does not exist has no digest.
    """
    hashed = files.select("path").mapInPandas(_digest_batches, "path string, actual string")
    return hashed.select(names.base_name(F.col("path")).alias("file_name"), "actual")


def _copy_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, target in zip(batch["path"], batch["target"]):
            filesystem, inner = _filesystem(target)
            filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
            with open_stream(path) as source, filesystem.open_output_stream(inner) as sink:
                while chunk := source.read(CHUNK_BYTES):
                    sink.write(chunk)
        yield batch


def copy_files(files: DataFrame) -> None:
    """Copy each `path` to its `target` byte for byte. A repeated run writes the same bytes to the same place."""
    spread = files.select("path", "target").repartition("path")
    spread.mapInPandas(_copy_batches, "path string, target string").write.format("noop").mode("overwrite").save()


def write_files(files: DataFrame, folder: str) -> None:
    """One file of a folder for each row (file_name, content), written by tasks."""

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, inner = _filesystem(folder)
        filesystem.create_dir(inner, recursive=True)
        for part in parts:
            for name, content in zip(part["file_name"], part["content"]):
                with filesystem.open_output_stream(f"{inner}/{name}") as sink:
                    sink.write(content.encode())
            yield part[["file_name"]]

    files.select("file_name", "content").mapInPandas(batches, "file_name string").write.format("noop").mode("overwrite").save()


def _delete_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            filesystem, inner = _filesystem(path)
            try:
                filesystem.delete_file(inner)
            except FileNotFoundError:  # a repeated task
                pass
        yield batch


def delete_files(files: DataFrame) -> int:
    """Delete the listed files (path) from tasks; returns how many were listed."""
    return files.select("path").mapInPandas(_delete_batches, "path string").count()


def unique_header(cells: list[str]) -> list[str]:
    """Repeated column names get `.1`, `.2`, ... as the pandas reader does."""
    seen: dict[str, int] = {}
    result = []
    for cell in cells:
        count = seen.get(cell, 0)
        seen[cell] = count + 1
        result.append(f"{cell}.{count}" if count else cell)
    return result


def _first_record(path: str, reserved: frozenset[str]) -> tuple[list[str] | None, str | None]:
    """Cells of the first CSV record (none for a file without one), or what is wrong with them.

    Bytes that are not UTF-8 are carried through here, so only those in the header count.
    """
    try:
        with open_stream(path) as stream:
            text = io.TextIOWrapper(
                io.BufferedReader(_RawStream(stream)), encoding="utf-8-sig", errors="surrogateescape", newline=""
            )
            record = next((r for r in csv.reader(text) if r), None)
    except (csv.Error, OSError) as error:
        return None, f"{UNREADABLE}: {error}"
    if record is None:
        return None, None
    header = unique_header(record)
    if any("\udc80" <= letter <= "\udcff" for cell in header for letter in cell):
        return None, f"{NOT_UTF8}: header"
    lowered = [cell.lower() for cell in header]
    if repeated := sorted({c for c in lowered if lowered.count(c) > 1}):
        return None, f"{REPEATED_COLUMN}: {', '.join(repeated)}"
    if taken := sorted(reserved.intersection(lowered)):
        return None, f"{RESERVED_COLUMN}: {', '.join(taken)}"
    return header, None


class _RawStream(io.RawIOBase):
    """Adapter that lets the text layer read a filesystem stream in blocks."""

    def __init__(self, stream):
        self._stream = stream

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self._stream.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def read_headers(files: DataFrame, reserved: frozenset[str] = frozenset()) -> DataFrame:
    """(path, length, columns, fault) of each listed file. Without columns, a fault says what is wrong with the header;
    neither means an empty file. Only the first block of a file is read, and no file's fault stops the others.
    """

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [_first_record(path, reserved) for path in part["path"]]
            yield part.assign(columns=[c for c, _ in found], fault=[f for _, f in found])

    return files.select("path", "length").mapInPandas(
        batches, "path string, length long, columns array<string>, fault string"
    )
