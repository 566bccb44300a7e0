"""Deterministic "one row per key" (D1, D2, D3).

``first_per_key`` is ``row_number() over (partition by key order by ...) = 1``.
Catalyst plans it with a *partial* ``WindowGroupLimit`` before the shuffle and
a final one after it: every map task keeps only its best row per key, so a
key holding a third of all rows is cut down to one row per input partition
before anything moves, instead of being sorted whole inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep, for every distinct ``keys`` value, the first row in a total order.

    The order is ``order`` (ascending, nulls first) and then every remaining
    column, so the kept row does not depend on input order or partitioning.
    Null keys form one group, like ``dropDuplicates``.
    """
    keys, order = list(keys), list(order)
    missing = [c for c in keys + order if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}")
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order + rest])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once (null keys count as equal)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def require_empty(violations: DataFrame, message: str) -> None:
    """Fail fast when a violation frame has any row (reads at most one row)."""
    if violations.take(1):
        raise AssertionError(message)


def require_nonempty(df: DataFrame, message: str) -> None:
    """Fail fast when a frame has no row (reads at most one row)."""
    if not df.take(1):
        raise ValueError(message)
