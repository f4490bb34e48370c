"""Row hashes and surrogate keys as SQL expressions."""

from __future__ import annotations

SURROGATE_RANGE = 10**9


def row_hash(*keys: str) -> str:
    """SHA-256 hex of the key columns joined by `|`; a null key takes part as the text `None`."""
    parts = ", ".join(f"coalesce(CAST({k} AS STRING), 'None')" for k in keys)
    return f"sha2(concat_ws('|', {parts}), 256)"


def surrogate_key(*parts: str) -> str:
    """A reproducible number in [0, 1e9) from the joined parts; null when any part is null."""
    text = "concat(" + ", '|', ".join(parts) + ")"
    return f"CAST(conv(substring(sha2({text}, 256), 1, 15), 16, 10) AS BIGINT) % {SURROGATE_RANGE}"
