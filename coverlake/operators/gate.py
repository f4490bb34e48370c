"""The validation gate: every failure of a file, and the verdict per file.

A file passes as a whole or not at all. Values are read with the validation scan's null tokens and strict types; a null
is only subject to the not-null test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverlake.functions import cells
from coverlake.sources.raw_csv import BLOCK_START, COLUMNS, OVERFLOW, ROW_ID, SOURCE_FILE
from coverlake.specs import EntitySpec

MISSING_COLUMN = "column_in_dataframe"
NOT_NULL = "not_nullable"
COERCION = "coerce_dtype"
UNIQUE = "field_uniqueness"
TOO_MANY_CELLS = "too_many_cells"

VIOLATION_COLUMNS = ["source_file", "row_number", "row_key", "column_name", "check_name", "failure_value"]
# Where a row was read: the start of its split and its number among the rows read.
PLACE = [BLOCK_START, ROW_ID]


def strict_int(text: str) -> str:
    trimmed = cells.strip(text)
    return (
        f"CASE WHEN {text} RLIKE '{cells.WHOLE_PATTERN}' THEN try_cast({text} AS BIGINT) "
        f"WHEN {trimmed} RLIKE '{cells.WHOLE_PATTERN}' THEN try_cast({trimmed} AS BIGINT) END"
    )


# The boolean column takes any text, so it has no parser and cannot fail.
STRICT_PARSERS = {"date": cells.to_date, "double": cells.to_double, "int": strict_int}


def _text(name: str) -> str:
    return cells.null_tokens(cells.column(name), cells.GATE_NULL_TOKENS)


def gate_view(rows: DataFrame, spec: EntitySpec, carry: list[str]) -> DataFrame:
    """Text and typed value of each contract column, with the columns to carry along."""
    present = [f for f in spec.fields if f.name in rows.columns]
    texts = rows.selectExpr(*[f"{_text(f.name)} AS {f.name}" for f in present], *carry)
    typed = [f"{STRICT_PARSERS[f.kind](f.name)} AS _typed_{f.name}" for f in present if f.kind in STRICT_PARSERS]
    return texts.selectExpr("*", *typed)


def row_tests(spec: EntitySpec, columns: list[str]) -> list[tuple[str, str, str]]:
    """(column, check, failing condition) of every test on one row of the gate view."""
    tests = []
    for field in spec.fields:
        name = field.name
        if name not in columns:
            continue
        parsed = field.kind in STRICT_PARSERS
        value = f"_typed_{name}" if parsed else name
        if not field.nullable:
            in_header = f" AND array_contains({COLUMNS}, '{name}')" if COLUMNS in columns else ""
            tests.append((name, NOT_NULL, f"{name} IS NULL{in_header}"))
        if parsed:
            tests.append((name, COERCION, f"{name} IS NOT NULL AND {value} IS NULL"))
        for rule in field.rules:
            tests.append((name, rule.name, f"{value} IS NOT NULL AND NOT ({rule.passes(value)})"))
    if OVERFLOW in columns:
        tests.append((OVERFLOW, TOO_MANY_CELLS, f"{OVERFLOW} IS NOT NULL"))
    return tests


def _any_failing(tests: list[tuple[str, str, str]]) -> str:
    return " OR ".join(f"({failing})" for _, _, failing in tests)


def _carried(rows: DataFrame, source: str) -> list[str]:
    return [source] + [c for c in (COLUMNS, OVERFLOW) if c in rows.columns]


def split_starts(rows: DataFrame, source: str = SOURCE_FILE) -> DataFrame:
    """Of each split of each file: its first row's number, and how many rows of the file stand before it.

    A split knows no row numbers of its file, but its rows are read in order. They are counted per split, and a running
    sum over the few splits of a file gives every split its start; a record over several lines is one row.
    """
    splits = rows.groupBy(F.col(source).alias("split_file"), F.col(BLOCK_START).alias("split_start")).agg(
        F.min(ROW_ID).alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy("split_file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(
        "split_file", "split_start", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before")
    )


def _with_row_numbers(found: DataFrame, rows: DataFrame, source: str) -> DataFrame:
    """Failures with the position of their row in its file, from 0; only failing rows meet the table of splits."""
    if BLOCK_START not in found.columns:
        return found.withColumn("row_number", F.lit(None).cast("bigint")).select(*VIOLATION_COLUMNS)
    starts = split_starts(rows, source)
    on_split = found.source_file.eqNullSafe(starts.split_file) & found[BLOCK_START].eqNullSafe(starts.split_start)
    number = F.col(ROW_ID) - F.col("first_id") + F.col("rows_before")
    return found.join(starts, on_split, "left").withColumn("row_number", number).select(*VIOLATION_COLUMNS)


def _places(rows: DataFrame) -> list[str]:
    return PLACE if all(c in rows.columns for c in PLACE) else []


def value_violations(rows: DataFrame, spec: EntitySpec, source: str = SOURCE_FILE) -> DataFrame:
    """One row per failed test of a row, with the row's position in its file where the scan has given its place.

    Only failing rows build the list of failures. The outer explode keeps the test on its result: a filter below it
    would be pushed through the projections and repeat every parse.
    """
    places = _places(rows)
    view = gate_view(rows, spec, _carried(rows, source) + places)
    tests = row_tests(spec, view.columns)
    failures = ", ".join(
        f"CASE WHEN {failing} THEN named_struct('column_name', '{name}', 'check_name', {cells.quoted(check)}, "
        f"'failure_value', {name}) END"
        for name, check, failing in tests
    )
    found = (
        view.selectExpr(
            f"{source} AS source_file",
            *places,
            f"{spec.key} AS row_key",
            f"CASE WHEN {_any_failing(tests)} THEN array_compact(array({failures})) END AS failures",
        )
        .select("source_file", *places, "row_key", F.explode_outer("failures").alias("failure"))
        .where("failure IS NOT NULL")
        .select("source_file", *places, "row_key", "failure.*")
    )
    return _with_row_numbers(found, rows, source)


def duplicate_keys(rows: DataFrame, spec: EntitySpec, source: str = SOURCE_FILE) -> DataFrame:
    """Keys that occur more than once within a file, with their count."""
    return (
        rows.selectExpr(f"{source} AS source_file", f"{_text(spec.key)} AS key_value")
        .where("key_value IS NOT NULL")
        .groupBy("source_file", "key_value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def uniqueness_violations(rows: DataFrame, spec: EntitySpec, source: str = SOURCE_FILE) -> DataFrame:
    """One row per row whose key repeats in its file.

    The repeated keys come from pre-aggregated counts; their rows are then found by a join, which AQE does by broadcast
    or splits where one key fills a large part of a file.
    """
    repeated = duplicate_keys(rows, spec, source).select(
        F.col("source_file").alias("file"), F.col("key_value").alias("repeated")
    )
    keyed = rows.selectExpr(f"{source} AS source_file", *_places(rows), f"{_text(spec.key)} AS row_key")
    same = keyed.source_file.eqNullSafe(repeated.file) & (keyed.row_key == repeated.repeated)
    found = keyed.join(repeated, same, "left_semi").withColumns(
        {"column_name": F.lit(spec.key), "check_name": F.lit(UNIQUE), "failure_value": F.col("row_key")}
    )
    return _with_row_numbers(found, rows, source)


def missing_columns(headers: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per required column a file's header lacks; `headers` has source_file and columns."""
    lacking = F.array_except(F.expr(f"array({cells.listed(spec.required)})"), F.col("columns"))
    return headers.where(F.col("columns").isNotNull()).select(
        "source_file",
        F.lit(None).cast("bigint").alias("row_number"),
        F.lit(None).cast("string").alias("row_key"),
        F.explode(lacking).alias("column_name"),
        F.lit(MISSING_COLUMN).alias("check_name"),
        F.lit(None).cast("string").alias("failure_value"),
    )


def fault_violations(faults: DataFrame) -> DataFrame:
    """One row per file that could not be read; `faults` has source_file and fault (`check: detail`)."""
    return faults.select(
        "source_file",
        F.lit(None).cast("bigint").alias("row_number"),
        F.lit(None).cast("string").alias("row_key"),
        F.lit(None).cast("string").alias("column_name"),
        F.substring_index("fault", ":", 1).alias("check_name"),
        F.ltrim(F.regexp_replace("fault", "^[^:]*:", "")).alias("failure_value"),
    )


def fault_stats(faults: DataFrame, spec: EntitySpec) -> DataFrame:
    """The rejecting verdict on files that could not be read, in the form of `file_stats`."""
    none = F.lit(0).cast("bigint")
    return faults.select(
        "source_file",
        F.lit(spec.name).alias("file_type"),
        none.alias("rows_raw"),
        none.alias("rows_valid"),
        none.alias("rows_dropped"),
        F.lit(None).cast("array<string>").alias("columns"),
        F.lit(False).alias("accepted"),
    )


def violations(
    rows: DataFrame, spec: EntitySpec, source: str = SOURCE_FILE, headers: DataFrame | None = None
) -> DataFrame:
    """Every failure of every file: values, repeated keys and, where headers are given, missing columns."""
    found = value_violations(rows, spec, source).unionByName(uniqueness_violations(rows, spec, source))
    if headers is not None:
        found = found.unionByName(missing_columns(headers, spec))
    return found


def row_counts(rows: DataFrame, spec: EntitySpec, source: str = SOURCE_FILE) -> DataFrame:
    """Per file: rows and bad rows (a failed test or a repeated key).

    Counted per (file, key) first, so a file or key with a large share of the rows is reduced in the map tasks.
    """
    view = gate_view(rows, spec, _carried(rows, source))
    tests = row_tests(spec, view.columns)
    per_key = view.groupBy(F.col(source).alias("source_file"), F.col(spec.key).alias("key_value")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"count_if({_any_failing(tests)})").alias("failing")
    )
    repeated = F.col("key_value").isNotNull() & (F.col("n") > 1)
    return per_key.groupBy("source_file").agg(
        F.sum("n").alias("rows_raw"),
        F.sum(F.when(repeated, F.col("n")).otherwise(F.col("failing"))).alias("rows_bad"),
    )


def file_stats(
    rows: DataFrame, spec: EntitySpec, source: str = SOURCE_FILE, headers: DataFrame | None = None
) -> DataFrame:
    """Per file: rows read, valid and dropped, its columns and whether it is accepted.

    With headers given, files without rows take part too: a bare header is accepted, an empty file or one that lacks a
    required column is not.
    """
    counts = row_counts(rows, spec, source)
    if headers is None:
        present = [c for c in rows.columns if not c.startswith("_") and c != source]
        missing = [c for c in spec.required if c not in rows.columns]
        files = counts.withColumn("columns", F.expr(f"array({cells.listed(present)})"))
        complete = F.lit(not missing)
    else:
        files = headers.select("source_file", "columns").join(counts, "source_file", "left")
        files = files.na.fill(0, ["rows_raw", "rows_bad"])
        required = F.expr(f"array({cells.listed(spec.required)})")
        complete = F.coalesce(F.size(F.array_except(required, F.col("columns"))) == 0, F.lit(False))
    return files.select(
        "source_file",
        F.lit(spec.name).alias("file_type"),
        "rows_raw",
        (F.col("rows_raw") - F.col("rows_bad")).alias("rows_valid"),
        F.col("rows_bad").alias("rows_dropped"),
        "columns",
        (complete & (F.col("rows_bad") == 0)).alias("accepted"),
    )


def split_by_verdict(
    rows: DataFrame, stats: DataFrame, source: str = SOURCE_FILE
) -> tuple[DataFrame, DataFrame]:
    """Rows of accepted and of rejected files. The verdict table has one row per file; AQE broadcasts it only when its
    measured size allows and otherwise splits heavy files in the sort-merge join."""
    rejected = stats.where(~F.col("accepted")).select(F.col("source_file").alias(source))
    return rows.join(rejected, source, "left_anti"), rows.join(rejected, source, "left_semi")
