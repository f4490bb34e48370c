"""Cell clean-up, parsing and bounded arithmetic as SQL expressions over built-in functions.

Every function takes and returns SQL text, so that a projection over many columns is one call to the JVM instead of
hundreds. Use the result with `F.expr` or `selectExpr`.
"""

from __future__ import annotations

from coverlake.functions import exact

# Whole-cell tokens that silver turns into null (case-sensitive, untrimmed).
SILVER_NULL_TOKENS = ["", "None", "nan", "NaN", "NULL"]

# The default missing-value tokens of the pandas CSV reader, used by the validation scan.
GATE_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The characters Python's str.strip() removes.
STRIP_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Accepted spellings of a boolean cell, any case.
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]

NUMBER_PATTERN = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
WHOLE_PATTERN = "^[+-]?[0-9]+$"
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DATE_TIME_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?$"


def quoted(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def listed(values: list[str]) -> str:
    return ", ".join(quoted(v) for v in values)


def double(value: float) -> str:
    return f"{float(value)!r}D"


def column(name: str) -> str:
    return f"`{name}`"


def null_tokens(cell: str, tokens: list[str] = SILVER_NULL_TOKENS) -> str:
    return f"CASE WHEN {cell} NOT IN ({listed(tokens)}) THEN {cell} END"


def strip(cell: str) -> str:
    return f"btrim({cell}, '{STRIP_CHARS}')"


def upper_strip(cell: str) -> str:
    """Upper case without surrounding white space. Cells that begin and end with a visible ASCII character, nearly all,
    skip the costly trim."""
    clean = " AND ".join(f"substr({cell}, {at}, 1) BETWEEN '!' AND '~'" for at in (1, -1))
    return f"CASE WHEN {clean} THEN upper({cell}) ELSE {strip(f'upper({cell})')} END"


def to_date(cell: str) -> str:
    """ISO dates, or ISO date-times of which the day counts; anything else, including impossible days, is null."""
    return (
        f"CASE WHEN {cell} RLIKE '{DATE_PATTERN}' THEN try_cast({cell} AS DATE) "
        f"WHEN {cell} RLIKE '{DATE_TIME_PATTERN}' THEN CAST(try_cast({cell} AS TIMESTAMP_NTZ) AS DATE) END"
    )


def to_double(cell: str) -> str:
    """Plain decimal or exponent notation; the pattern keeps out what the SQL cast takes beyond it (`1d`, `nan`)."""
    padded = NUMBER_PATTERN.replace("^", f"^[{STRIP_CHARS}]*").replace("$", f"[{STRIP_CHARS}]*$")
    return (
        f"CASE WHEN {cell} RLIKE '{NUMBER_PATTERN}' THEN try_cast({cell} AS DOUBLE) "
        f"WHEN {cell} RLIKE '{padded}' THEN try_cast({strip(cell)} AS DOUBLE) END"
    )


def to_int(cell: str) -> str:
    """Whole numbers, also written as `3.0`; fractions and out-of-range values are null."""
    number = to_double(cell)
    written_otherwise = f"CASE WHEN {number} = floor({number}) THEN try_cast({number} AS INT) END"
    return f"CASE WHEN {cell} RLIKE '{WHOLE_PATTERN}' THEN try_cast({cell} AS INT) ELSE {written_otherwise} END"


def to_bool(cell: str) -> str:
    return (
        f"CASE WHEN lower({cell}) IN ({listed(TRUE_WORDS)}) THEN true "
        f"WHEN lower({cell}) IN ({listed(FALSE_WORDS)}) THEN false END"
    )


def clip(value: str, low: float, high: float) -> str:
    """Bound a value and keep null as null (`greatest`/`least` would turn null into the bound)."""
    return (
        f"CASE WHEN {value} < {double(low)} THEN {double(low)} "
        f"WHEN {value} > {double(high)} THEN {double(high)} ELSE {value} END"
    )


def floor_at_zero(value: str) -> str:
    return f"CASE WHEN {value} < 0 THEN 0 ELSE {value} END"


def bounded_ratio(part: str, whole: str) -> str:
    """part / whole in 0..1, null unless the denominator is positive."""
    return f"CASE WHEN {whole} > 0 THEN {clip(f'({part} / {whole})', 0, 1)} END"


def collection_rate(paid: str, due: str) -> str:
    """paid / due in 0..1, null when nothing is due."""
    return clip(f"try_divide({paid}, {due})", 0, 1)


def retained(amount: str, percentage: str) -> str:
    return f"{amount} * (1 - {percentage} / 100)"


def zero_if_null(value: str) -> str:
    return f"coalesce({value}, 0D)"


def is_value(value: str, wanted: str) -> str:
    """Equality that answers false, not null, for a missing value."""
    return f"{value} <=> {quoted(wanted)}"


def exact_sum(value: str) -> str:
    """Order-independent sum of a money column to eight places, 0 for an all-null group; no amount stops it."""
    return exact.exact_sum(value)


def exact_mean(ratio: str, digits: int) -> str:
    """Order-independent mean of a ratio column in 0..1, rounded half-even."""
    return f"bround(try_divide(CAST(sum(CAST({ratio} AS DECIMAL(28, 12))) AS DOUBLE), count({ratio})), {digits})"
