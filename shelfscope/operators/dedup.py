"""One record per key as ``row_number() = 1``.

Spark plans a WindowGroupLimit on both sides of the exchange: each map task sends
one row per key, so a hot key costs one row per map task, and the rows are not
sorted twice as a sort-based ``max_by`` over structs would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first(df: DataFrame, keys: Sequence[str], ords: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*ords)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   keep: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple (lexicographic).

    ``order`` must be unique within a key for a deterministic result (add a
    tie-break column). Keeps ``keep`` columns (default: all non-key columns).
    """
    keep = [c for c in (keep or df.columns) if c not in keys]
    ords = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    return _first(df, keys, ords).select(*keys, *keep)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  keep: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple."""
    keep = [c for c in (keep or df.columns) if c not in keys]
    ords = [(F.col(o) if isinstance(o, str) else o).asc_nulls_first() for o in order]
    return _first(df, keys, ords).select(*keys, *keep)
