"""Several models' predictions side by side.

Predictions arrive as one long table ``(model, id, nace2025, codable)``.
``models_wide`` turns it into one row per id with a column pair per model in a
single aggregation over the id: per-model dedup (first row), the key
intersection (inner) and the N-way join all happen in one shuffle with
map-side partial aggregation, instead of N scans and N-1 joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.functions.names import column

JOIN_TYPES = {"inner": "inner", "left": "left", "right": "right", "outer": "full"}


def merge_frames(
    frames: Mapping[str, DataFrame],
    on: str | Sequence[str],
    columns: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """J6 + P5: join named frames on a key, suffixing columns per frame.

    ``rename`` maps a column to a pattern such as ``"nace2025_{key}"``.  Raises
    on an empty mapping.  All joins use the same key, so Spark keeps one hash
    partitioning across the chain.
    """
    if not frames:
        raise ValueError("no frames to merge")
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {sorted(JOIN_TYPES)}")
    on_list = [on] if isinstance(on, str) else list(on)
    prepared = []
    for name, df in frames.items():
        cols = list(columns) if columns is not None else df.columns
        sel = [
            column(c).alias(rename[c].format(key=name)) if rename and c in rename and c not in on_list else column(c)
            for c in cols
        ]
        prepared.append(df.select(*sel))
    return reduce(lambda l, r: l.join(r, on_list, JOIN_TYPES[how]), prepared)


def common_ids(long: DataFrame, models: Sequence[str], id_col: str = K.ID) -> DataFrame:
    """Ids predicted by every one of ``models``."""
    return (
        long.filter(F.col("model").isin(list(models)))
        .groupBy(id_col)
        .agg(F.count_distinct("model").alias("__m"))
        .filter(F.col("__m") == len(models))
        .select(id_col)
    )


def models_wide(
    long: DataFrame,
    models: Sequence[str],
    values: Sequence[str] = ("nace2025", "codable"),
    id_col: str = K.ID,
    how: str = "inner",
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per id, columns ``{value}_{model}``; model names may hold any character.

    Per model one row of an id is kept: the first by ``order`` (such as the run),
    then one with a first value before one without, then by the value columns.  ``how="inner"`` keeps ids every model predicted (Z2), ``"left"``
    ids of the first model, ``"outer"`` every id.
    """
    if how not in ("inner", "left", "outer"):
        raise ValueError("how must be inner, left or outer")
    vals = list(values)
    aggs = []
    kept = [column(v).alias(f"v{i}") for i, v in enumerate(vals)]
    first = [column(c).alias(f"o{i}") for i, c in enumerate(order)]
    for i, m in enumerate(models):
        packed = F.when(F.col("model") == F.lit(m), F.struct(*first, column(vals[0]).isNull().alias("absent"), *kept))
        aggs.append(F.min(packed).alias(f"__{i}"))
    wide = long.filter(F.col("model").isin(list(models))).groupBy(id_col).agg(*aggs)
    present = [F.col(f"__{i}").isNotNull() for i in range(len(models))]
    if how == "inner":
        wide = wide.filter(reduce(lambda a, b: a & b, present))
    elif how == "left":
        wide = wide.filter(present[0])
    out = [F.col(id_col)]
    for i, m in enumerate(models):
        out += [F.col(f"__{i}")[f"v{k}"].alias(f"{v}_{m}") for k, v in enumerate(vals)]
    return wide.select(*out)
