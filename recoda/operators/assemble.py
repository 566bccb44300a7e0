"""Q10: put the three label sources back onto every declaration.

Sources: unambiguous recodes (J1 output), model labels for the ambiguous work
set, and human labels.  Model and human labels were given to one
representative per activity (D2), so they are propagated back to every
declaration with the same nine attributes (J5).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.operators.dedup import first_per_key
from recoda.session import stored


def anti_join_ids(df: DataFrame, ids: DataFrame, id_col: str = K.ID) -> DataFrame:
    """Rows whose id is not among ``ids`` (a null id is removed by a null id)."""
    other = ids.select(F.col(id_col).alias("__id"))
    return df.join(other, df[id_col].eqNullSafe(other["__id"]), "left_anti")


def enrich(df: DataFrame, declarations: DataFrame, id_col: str = K.ID) -> DataFrame:
    """Add the declaration attributes (one row per id) by a left join on id."""
    return df.join(declarations, id_col, "left")


def attribute_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def hot_keys(targets: DataFrame, attributes: Sequence[str] = K.ATTRIBUTE_COLUMNS, hot_rows: int = 1_000_000) -> dict[int, int]:
    """Attribute combinations (their hash) with over ``hot_rows`` targets, and how many salts spread each.

    One pass with a frequent-items sketch: bounded memory per task, and what reaches
    the driver is at most ``HOT_KEYS`` items.  A combination of over ``hot_rows`` rows
    is never missed while the table has fewer than ``hot_rows`` x ``TRACKED`` / 4 rows;
    estimates may be too high, which only salts a colder key as well.
    """
    sketch = F.expr(f"approx_top_k(__h, {HOT_KEYS}, {TRACKED})")
    found = targets.select(attribute_hash(attributes).alias("__h")).agg(sketch.alias("top")).first()["top"]
    return {r["item"]: -(-r["count"] // hot_rows) for r in found or [] if r["count"] > hot_rows}


HOT_KEYS, TRACKED = 1_000, 10_000


def propagate(labels: DataFrame, targets: DataFrame, attributes: Sequence[str] = K.ATTRIBUTE_COLUMNS,
              id_col: str = K.ID, label_col: str = "nace2025", salts: int | None = None,
              hot_rows: int = 1_000_000, hot: Mapping[int, int] | None = None) -> DataFrame:
    """J5 + F4: give each label to every target declaration with the same attributes.

    The target's id replaces the label row's id; label rows that reach no
    target would get a null id and are dropped (F4), so this is an inner join
    on the nine attributes with nulls matching.  A hot attribute combination
    only grows the target side of one key.  Combinations with more than
    ``hot_rows`` targets are found by a sketch (``hot_keys``; or given as ``hot``,
    hash to salts); their targets spread over salt buckets by id, about ``hot_rows``
    each, and only their label rows are replicated.  ``salts`` fixes the number
    of buckets instead; 0 switches the split off.
    """
    if salts == 0:
        hot = {}
    elif hot is None:
        hot = hot_keys(targets, attributes, hot_rows)
    l = labels.select(F.col(label_col), *[F.col(c) for c in attributes])
    t = targets.select(F.col(id_col), *[F.col(c).alias(f"__t_{c}") for c in attributes])
    cond = reduce(lambda a, b: a & b, [l[c].eqNullSafe(t[f"__t_{c}"]) for c in attributes])
    if hot:
        spark = targets.sparkSession
        spread = spark.createDataFrame([(h, salts or n) for h, n in hot.items()], "__h long, __n int")  # at most HOT_KEYS rows
        spread, buckets = F.broadcast(spread), F.coalesce(F.col("__n"), F.lit(1))
        t = t.withColumn("__h", attribute_hash([f"__t_{c}" for c in attributes])).join(spread, "__h", "left")
        t = t.withColumn("__salt", F.pmod(F.xxhash64(F.col(id_col)), buckets).cast("int")).drop("__h", "__n")
        l = l.withColumn("__h", attribute_hash(attributes)).join(spread, "__h", "left")
        l = l.withColumn("__salt", F.explode(F.sequence(F.lit(0), buckets - 1))).drop("__h", "__n")
        cond = reduce(lambda a, b: a & b, [l[c].eqNullSafe(t[f"__t_{c}"]) for c in attributes]) & (
            l["__salt"] == t["__salt"])
    joined = l.join(t, cond, "inner")
    return joined.filter(F.col(id_col).isNotNull()).select(F.col(id_col), F.col(label_col), *[F.col(c) for c in attributes])


def unmatched_labels(labels: DataFrame, targets: DataFrame, attributes: Sequence[str] = K.ATTRIBUTE_COLUMNS) -> DataFrame:
    """Label rows that reach no target (what F4 drops; reported, not silently lost)."""
    t = targets.select(*[F.col(c).alias(f"__t_{c}") for c in attributes]).distinct()
    cond = reduce(lambda a, b: a & b, [labels[c].eqNullSafe(t[f"__t_{c}"]) for c in attributes])
    return labels.join(t, cond, "left_anti")


def repeated_ids(univ: DataFrame, model: DataFrame, human: DataFrame, targets: DataFrame, attributes: Sequence[str],
                 id_col: str, prefer_human: bool, salts: int | None, hot: Mapping[int, int]) -> DataFrame:
    """C1 over the final table without making it: its ids seen twice or more, and how often.

    An activity with m label rows and t targets is m x t rows of the final table; here
    its label rows are counted first, and the counts propagated, which is t rows.
    """
    counts = model.select(*attributes, F.lit(1).alias("m"), F.lit(0).alias("h")).unionByName(
        human.select(*attributes, F.lit(0).alias("m"), F.lit(1).alias("h")))
    counts = counts.groupBy(*attributes).agg(F.sum("m").alias("m"), F.sum("h").alias("h"))
    n_rows = F.when(F.col("h") > 0, F.col("h")).otherwise(F.col("m")) if prefer_human else F.col("m") + F.col("h")
    reached = propagate(counts.withColumn("n_rows", n_rows), targets, attributes, id_col, "n_rows", salts=salts, hot=hot)
    rows = univ.select(id_col, F.lit(1).cast("long").alias("n_rows")).unionByName(reached.select(id_col, "n_rows"))
    return rows.groupBy(id_col).agg(F.sum("n_rows").alias("n_rows")).filter(F.col("n_rows") > 1)


def assemble(
    extraction: DataFrame,
    univocal: DataFrame,
    model_labels: DataFrame,
    human_labels: DataFrame,
    order: Sequence[str] = (),
    human_order: Sequence[str] = (),
    id_col: str = K.ID,
    attributes: Sequence[str] = K.ATTRIBUTE_COLUMNS,
    prefer_human: bool = False,
    salts: int | None = None,
    hot_rows: int = 1_000_000,
) -> dict[str, DataFrame]:
    """The final labelled table and its parts.

    ``univocal`` and ``model_labels`` are ``(id, nace2025)``; ``human_labels``
    is ``(id, nace2025)`` plus optional order columns.  Returns the parts and
    ``final`` (Z1, union by name) and ``violations`` (C1, ids seen twice).
    Model and human labels are made disjoint by id *before* propagation, so a
    declaration can still be reached from both; by default that shows up in
    ``violations``.  ``prefer_human`` makes the final ids unique: the propagated
    human label wins, and a combination of attributes with several model labels
    gives the one of the smallest id; ``conflicts`` lists such combinations.
    Hot attribute combinations are split in both propagation joins; one sketch over
    the declarations finds them (``salts``, ``hot_rows``: see ``propagate``).  The deduplicated declarations,
    univocal and human labels and the targets are written to the shared checkpoint folder when this is called.
    """
    keep = [id_col, *attributes]
    d1_order = list(order) + [c for c in attributes if c not in order]
    declarations = first_per_key(extraction.select(*keep, *[c for c in order if c not in keep]), [id_col], d1_order)
    # four later steps read the declarations: deduplicate them once, into the shared folder
    declarations = stored(declarations.select(*keep), "declarations")

    # as the later parts each read these several times, they are made once too
    univ = stored(first_per_key(univocal.select(id_col, "nace2025"), [id_col], ["nace2025"]), "univocal")
    human = first_per_key(human_labels, [id_col], list(human_order) + ["nace2025"]).select(id_col, "nace2025")
    human = stored(human, "human")
    model = anti_join_ids(model_labels.select(id_col, "nace2025"), human, id_col)

    univ_full = enrich(univ, declarations, id_col)
    model_full = enrich(model, declarations, id_col)
    per_activity = model_full.groupBy(*attributes).agg(F.collect_set("nace2025").alias("labels"), F.count(F.lit(1)).alias("n"))
    conflicts = per_activity.filter(F.size("labels") > 1)
    if prefer_human:
        model_full = first_per_key(model_full, list(attributes), [id_col, "nace2025"])
    human_full = first_per_key(enrich(human, declarations, id_col), list(attributes), [id_col, "nace2025"])
    human_full = stored(human_full, "human-activities")

    targets = stored(anti_join_ids(declarations, univ, id_col), "targets")
    # the targets are some of the declarations, so a hot key of the targets is hot there too
    hot = {} if salts == 0 else hot_keys(declarations, attributes, hot_rows)
    model_spread = propagate(model_full, targets, attributes, id_col, salts=salts, hot=hot)
    human_spread = propagate(human_full, targets, attributes, id_col, salts=salts, hot=hot)
    if prefer_human:
        model_spread = anti_join_ids(model_spread, human_spread.select(id_col), id_col)

    cols = [id_col, "nace2025", *attributes]
    final = (
        univ_full.select(*cols)
        .unionByName(model_spread.select(*cols), allowMissingColumns=True)
        .unionByName(human_spread.select(*cols), allowMissingColumns=True)
    )
    return {
        "declarations": declarations,
        "univocal": univ_full,
        "model": model_full,
        "human": human_full,
        "targets": targets,
        "model_propagated": model_spread,
        "human_propagated": human_spread,
        "final": final,
        "violations": repeated_ids(univ, model_full, human_full, targets, attributes, id_col, prefer_human, salts, hot),
        "conflicts": conflicts,
        # Label rows that reached no declaration (dropped by F4), reported per source
        "model_unmatched": unmatched_labels(model_full, targets, attributes),
        "human_unmatched": unmatched_labels(human_full, targets, attributes),
    }
