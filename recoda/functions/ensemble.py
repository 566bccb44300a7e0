"""Combining several models' labels per row, with native higher-order functions.

All of these are plain Column expressions (no Python per row): they run inside
whole-stage code generation on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from recoda.functions.names import column


def _valid(cols: Sequence[str]) -> Column:
    return F.filter(F.array(*[column(c) for c in cols]), lambda x: x.isNotNull())


def cascade(cols: Sequence[str], default: str | None = None) -> Column:
    """The first non-null label in model order, else ``default``."""
    return F.coalesce(*[column(c) for c in cols], F.lit(default).cast("string"))


def majority_vote(cols: Sequence[str], default: str | None = None) -> Column:
    """The most frequent non-null label; ties go to the earliest model among the tied."""
    v = _valid(cols)
    best = F.array_max(
        F.transform(
            v,
            lambda x, i: F.struct(
                F.size(F.filter(v, lambda y: y == x)).alias("n"),
                (-i).alias("p"),
                x.alias("v"),
            ),
        )
    )
    return F.when(F.size(v) == 0, F.lit(default).cast("string")).otherwise(best["v"])


def weighted_vote(
    cols: Sequence[str],
    weights: Sequence[float] | None = None,
    default: str | None = None,
    mode: str = "last",
) -> Column:
    """Weighted vote over non-null labels.

    ``mode="last"`` scores a label with the weight of the *last* model that
    gave it (what the original dictionary-based code computes); ``mode="sum"``
    adds the weights of every model that gave it (the documented intent).  The
    label with the highest score wins; on a tie the first model's value is
    returned even when it is null; with no valid label, ``default``.
    """
    if mode not in ("last", "sum"):
        raise ValueError("mode must be 'last' or 'sum'")
    weights = list(weights) if weights is not None else [1.0] * len(cols)
    if len(weights) != len(cols):
        raise ValueError("one weight per model column")
    pairs = F.filter(
        F.array(*[F.struct(column(c).alias("v"), F.lit(float(w)).alias("w")) for c, w in zip(cols, weights)]),
        lambda p: p["v"].isNotNull(),
    )
    labels = F.array_distinct(F.transform(pairs, lambda p: p["v"]))

    def score(x: Column) -> Column:
        same = F.filter(pairs, lambda p: p["v"] == x)
        if mode == "last":
            return F.element_at(same, -1)["w"]
        return F.aggregate(same, F.lit(0.0), lambda s, p: s + p["w"])

    scored = F.transform(labels, lambda x: F.struct(x.alias("v"), score(x).alias("s")))
    top = F.array_max(F.transform(scored, lambda s: s["s"]))
    winners = F.filter(scored, lambda s: s["s"] == top)
    return (
        F.when(F.size(pairs) == 0, F.lit(default).cast("string"))
        .when(F.size(winners) == 1, F.get(winners, 0)["v"])
        .otherwise(column(cols[0]))
    )


def agreement_flags(cols: Sequence[str]) -> dict[str, Column]:
    """Per-row counts of valid / unique labels and the four agreement flags.

    The flags are not exhaustive: (A, A, B) is none of them.
    """
    v = _valid(cols)
    n_valid = F.size(v)
    n_unique = F.size(F.array_distinct(v))
    n = len(cols)
    return {
        "valid_predictions": n_valid,
        "unique_predictions": n_unique,
        "full_agreement": (n_unique == 1) & (n_valid == n),
        "partial_agreement": (n_unique == 1) & (n_valid < n),
        "all_different": (n_unique == n_valid) & (n_valid > 1),
        "all_none": n_valid == 0,
    }
