"""Raw text rows to typed, deduplicated, derived silver rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from coverlake.functions import cells, keys
from coverlake.operators.dedup import dropped_counts, one_per_key
from coverlake.sources.raw_csv import COLUMNS, OVERFLOW, PATH, ROW_ORDER, SOURCE_FILE
from coverlake.specs import EntitySpec

BUSINESS_DATE = "_business_date"
UNPARSED = "_unparsed"
ROWS_IN, ROWS_KEPT = "rows_in", "rows_kept"

PARSERS = {"date": cells.to_date, "double": cells.to_double, "int": cells.to_int, "bool": cells.to_bool}


def _check_columns(rows: DataFrame, spec: EntitySpec) -> None:
    missing = [c for c in spec.required if c not in rows.columns]
    if missing:
        raise ValueError(f"{spec.name} rows lack columns {missing}")


def _parsed(spec: EntitySpec, name: str, kind: str) -> str:
    cell = cells.column(name)
    if kind in PARSERS:
        # No null token is a date, number or boolean word, so the parser alone turns tokens into null.
        return PARSERS[kind](cell)
    cell = cells.null_tokens(cell)
    return cells.upper_strip(cell) if name in spec.upper else cell


def _parsed_columns(rows: DataFrame, spec: EntitySpec) -> dict[str, str]:
    """Columns that are parsed from text, with their kind."""
    return {f.name: f.kind for f in spec.fields if f.kind in ("date", "double", "int") and f.name in rows.columns}


def _unparsed(name: str, kind: str) -> str:
    """Whether a cell holds something that did not parse. The parse stands first, so that Spark shares it with the
    column itself."""
    cell = cells.column(name)
    return f"({PARSERS[kind](cell)}) IS NULL AND {cells.null_tokens(cell)} IS NOT NULL"


def normalise(rows: DataFrame, spec: EntitySpec, flagged: bool = False) -> DataFrame:
    """Null tokens, trimmed upper-case codes and typed values in one projection; extra columns stay text.

    When flagged, `_unparsed` has a bit set for each parsed column whose cell did not parse.
    """
    _check_columns(rows, spec)
    kinds = {f.name: f.kind for f in spec.fields}
    extras = [c for c in rows.columns if not c.startswith("_") and c not in kinds]
    ordered = [c for c in spec.columns if c in rows.columns] + extras
    carried = [c for c in rows.columns if c.startswith("_") and c not in (COLUMNS, OVERFLOW, PATH)]
    typed = [f"{_parsed(spec, c, kinds.get(c, 'text'))} AS {cells.column(c)}" for c in ordered]
    flags = [f"CASE WHEN {_unparsed(c, kind)} THEN {1 << k}L ELSE 0L END" for k, (c, kind) in enumerate(_parsed_columns(rows, spec).items())]
    flag = [f"{' | '.join(flags)} AS {UNPARSED}"] if flagged else []
    return rows.selectExpr(*typed, *[cells.column(c) for c in carried], *flag)


def derive(rows: DataFrame, spec: EntitySpec, as_of: date) -> DataFrame:
    """Bounds, derived columns, row hash and ingestion time."""
    bounded = rows.withColumns(
        {name: F.expr(cells.clip(cells.column(name), low, high)) for name, (low, high) in spec.clipped.items()}
    )
    columns = {n: F.expr(sql.replace("{as_of}", f"DATE '{as_of}'")) for n, sql in spec.derived.items()}
    columns["_row_hash"] = F.expr(keys.row_hash(spec.key))
    columns["_ingested_at"] = F.current_timestamp()
    return bounded.withColumns(columns)


@dataclass
class SilverMetrics:
    """What a silver write sees on its way: cells that did not parse, rows read and rows kept. Known once it has run.

    Tasks that run twice after a lost executor count twice.
    """

    spec: EntitySpec
    read: Observation = field(default_factory=Observation)
    kept: Observation = field(default_factory=Observation)

    def rows(self) -> list[dict]:
        """(metric, column_name, value); what a job without rows has not observed is 0."""
        counts = {**self.read.get, **self.kept.get}
        parsed = [f.name for f in self.spec.fields if f"{UNPARSED}_{f.name}" in counts]
        rows = [{"metric": "bad_values", "column_name": c, "value": counts[f"{UNPARSED}_{c}"] or 0} for c in parsed]
        rows_in, rows_kept = counts.get(ROWS_IN) or 0, counts.get(ROWS_KEPT) or 0
        whole = {ROWS_IN: rows_in, ROWS_KEPT: rows_kept, "rows_dropped": rows_in - rows_kept}
        return rows + [{"metric": name, "column_name": None, "value": value} for name, value in whole.items()]


def deduplicated(
    rows: DataFrame,
    spec: EntitySpec,
    order: list[str] = ROW_ORDER,
    metrics: SilverMetrics | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Typed rows, one per key and date, without the columns `derive` makes: what a write shuffles before it derives.

    Raw rows carry `_business_date` and the order columns; the last row of a key within a date wins. With `metrics`,
    failures and rows are counted as they pass. `stored` silver rows of the same dates compete by the order columns they
    have kept, so that new files need not be read together with the old ones.
    """
    typed = normalise(rows, spec, flagged=metrics is not None)
    if metrics:
        bad = [F.expr(f"count_if({UNPARSED} & {1 << k}L <> 0)").alias(f"{UNPARSED}_{c}") for k, c in enumerate(_parsed_columns(rows, spec))]
        typed = typed.observe(metrics.read, F.count(F.lit(1)).alias(ROWS_IN), *bad).drop(UNPARSED)
    if stored is not None:
        made = {*spec.derived, "_row_hash", "_ingested_at"}
        typed = typed.unionByName(stored.drop(*made), allowMissingColumns=True)
    kept = one_per_key(typed, [BUSINESS_DATE, spec.key], order, keep="last")
    return kept.observe(metrics.kept, F.count(F.lit(1)).alias(ROWS_KEPT)) if metrics else kept


def to_silver(
    rows: DataFrame,
    spec: EntitySpec,
    as_of: date,
    order: list[str] = ROW_ORDER,
    metrics: SilverMetrics | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Silver rows of any number of files and dates: one narrow projection, one shuffle, one narrow projection."""
    return derive(deduplicated(rows, spec, order, metrics, stored), spec, as_of)


def parse_failures(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """Per date or number column: how many non-empty cells did not parse."""
    typed = _parsed_columns(rows, spec)
    counts = rows.agg(*[F.expr(f"count_if({_unparsed(c, kind)})").alias(c) for c, kind in typed.items()])
    return counts.unpivot([], list(typed), "column_name", "bad_values").select(
        F.lit(spec.name).alias("entity"), "column_name", "bad_values"
    )


def dedup_dropped(rows: DataFrame, spec: EntitySpec, source: str = SOURCE_FILE) -> DataFrame:
    """Per business date: rows in, repeats dropped within and across files, rows kept."""
    typed = normalise(rows, spec).select(BUSINESS_DATE, spec.key, source)
    return dropped_counts(typed, [BUSINESS_DATE], spec.key, source).withColumn("entity", F.lit(spec.name))
