"""Evaluation against human labels, agreement, strategy choice.

Every metric family is computed in one pass: a single ``agg`` of conditional
averages (partial aggregation on every partition, one tiny final merge), then
the one-row result is unpivoted into a long ``(name, value)`` table.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.functions.codes import label_covered, label_position, prefix, quoted_codes_in
from recoda.functions.ensemble import agreement_flags
from recoda.functions.names import column
from recoda.operators.dedup import first_per_key


def level_match(truth, pred, level: int) -> Column:
    """A1 row flag: do the first ``level`` characters agree?  A null never agrees."""
    t = column(truth) if isinstance(truth, str) else truth
    p = column(pred) if isinstance(pred, str) else pred
    return F.coalesce(prefix(t, level) == prefix(p, level), F.lit(False))


def pct(flag: Column, where: Column | None = None, digits: int | None = 2) -> Column:
    """100 x share of true flags (optionally among rows where ``where``), rounded half-even.

    An empty set gives null rather than a division error.
    """
    x = flag.cast("int")
    if where is not None:
        x = F.when(F.coalesce(where, F.lit(False)), x)
    value = F.avg(x) * F.lit(100.0)
    return F.bround(value, digits) if digits is not None else value


def to_long(one_row: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """Unpivot a one-row metrics frame into ``(name, value double)``."""
    cols = one_row.columns
    casted = one_row.select(*[column(c).cast("double").alias(c) for c in cols])
    return casted.unpivot([], [column(c) for c in cols], name, value)


def prompt_coverage(prompts: DataFrame, labels: DataFrame, id_col: str = K.ID, text_col: str = "user_prompt",
                    label_col: str = "apet_manual") -> DataFrame:
    """X13 + X14: is the human label among the prompt's candidates, and where.

    Prompts and labels are joined on the id (never zipped by position).
    """
    p = prompts.select(id_col, quoted_codes_in(F.col(text_col)).alias("__codes"))
    j = labels.select(id_col, label_col).join(p, id_col, "inner")
    return j.select(
        id_col,
        label_covered("__codes", label_col).alias("mapping_ok"),
        label_position("__codes", label_col).cast("int").alias("position"),
    )


def ground_truth_first(ground_truth: DataFrame, order: Sequence[str] = (), id_col: str = K.ID) -> DataFrame:
    """Q12: one human label per id (first by ``order`` then every column)."""
    return first_per_key(ground_truth, [id_col], list(order))


def accuracy_metrics(ev: DataFrame | None = None, truth: str = "apet_manual", pred: str = "nace2025",
                     filters: Sequence[str | None] = (None, "mapping_ok", "codable"),
                     within: Column | None = None) -> dict[str, Column]:
    """A1 + A2 + F3: ``accuracy_{overall|filter}_lvl_{i}`` aggregate expressions (of the rows ``within``)."""
    out = {}
    for f in filters:
        where = within if f is None else F.col(f) if within is None else within & F.col(f)
        for i in K.ACCURACY_LEVELS:
            out[f"accuracy_{f or 'overall'}_lvl_{i}"] = pct(level_match(truth, pred, i), where)
    return out


def evaluate_results(results: DataFrame, ground_truth: DataFrame, prompts: DataFrame,
                     gt_order: Sequence[str] = (), id_col: str = K.ID) -> DataFrame:
    """Q8: accuracy of one model's results at five levels on three subsets, plus sizes.

    ``results``: ``(id, nace2025, codable)``; ``ground_truth``: ``(id,
    apet_manual, ...)``; ``prompts``: ``(id, user_prompt)``.  Returns the long
    metrics table ``(metric, value)``.
    """
    gt = ground_truth_first(ground_truth, gt_order, id_col).select(id_col, "apet_manual")
    labelled = gt.join(results.select(id_col, "nace2025", "codable"), id_col)
    codes = prompts.select(id_col, quoted_codes_in(F.col("user_prompt")).alias("__codes"))
    ev = labelled.join(codes, id_col).select(
        "apet_manual", "nace2025", "codable", label_covered("__codes", "apet_manual").alias("mapping_ok")
    )
    metrics = accuracy_metrics(ev)
    metrics["eval_size"] = F.count(F.lit(1))
    metrics["mapping_ok"] = F.count_if(F.col("mapping_ok"))
    return to_long(ev.agg(*[v.alias(k) for k, v in metrics.items()]))


LABEL_COLUMNS = ("apet_manual", "mapping_ok", "__labelled")


def with_labels(results: DataFrame, ground_truth: DataFrame, prompts: DataFrame,
                gt_order: Sequence[str] = (), id_col: str = K.ID) -> DataFrame:
    """All rows of ``results`` with their human label and its coverage by the prompt (``LABEL_COLUMNS``; null: no label).

    With ``result_metrics`` it measures results while they are written, instead of
    reading them back (``evaluate_results``).
    """
    gt = ground_truth_first(ground_truth, gt_order, id_col).select(id_col, "apet_manual")
    codes = prompts.select(id_col, quoted_codes_in(F.col("user_prompt")).alias("__codes"))
    covered = gt.join(codes, id_col).select(
        id_col, "apet_manual", label_covered("__codes", "apet_manual").alias("mapping_ok"), F.lit(True).alias("__labelled")
    )
    return results.join(covered, id_col, "left")


def result_metrics() -> dict[str, Column]:
    """Q8 + A4 as aggregate expressions over ``with_labels`` rows: accuracies, sizes, coded counts."""
    labelled = F.coalesce(F.col("__labelled"), F.lit(False))
    metrics = accuracy_metrics(within=labelled)
    metrics["eval_size"] = F.count_if(labelled)
    metrics["mapping_ok"] = F.count_if(labelled & F.col("mapping_ok"))
    return {**metrics, **coded_metrics()}


def agreement_rows(wide: DataFrame, cols: Sequence[str], id_col: str = K.ID) -> DataFrame:
    """X20 per row."""
    flags = agreement_flags(cols)
    return wide.select(id_col, *[v.alias(k) for k, v in flags.items()])


def agreement_stats(wide: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A6 + A8: agreement counts, percentages and pairwise agreement, one row.

    Percentages are not rounded; null never agrees with anything.
    """
    flags = agreement_flags(cols)
    total = F.count(F.lit(1))
    counts = {f"{k}_count": F.count_if(flags[k]) for k in ("full_agreement", "partial_agreement", "all_different", "all_none")}
    aggs = [total.alias("total_samples")] + [v.alias(k) for k, v in counts.items()]
    for k in ("full_agreement", "partial_agreement", "all_different", "all_none"):
        aggs.append(F.try_divide(F.count_if(flags[k]) * F.lit(100.0), total).alias(f"{k}_pct"))
    for a, b in combinations(cols, 2):
        aggs.append(pct(F.coalesce(column(a) == column(b), F.lit(False)), digits=None).alias(f"agreement_{a}_vs_{b}"))
    return wide.agg(*aggs)


def accuracy_matrix(ev: DataFrame, models: Sequence[str], ensembles: Sequence[str],
                    truth: str = "apet_manual") -> DataFrame:
    """Accuracy per strategy x level on all rows, per-model codable rows, mapping_ok rows.

    ``ev`` is wide: ``nace2025_{s}`` per strategy, ``codable_{m}`` per base
    model, ``mapping_ok``.  One aggregation computes every cell.
    """
    strategies = list(models) + list(ensembles)
    # agreeing on i characters means agreeing on fewer, so one depth per strategy and row answers every level
    depth = {
        s: sum((level_match(truth, f"nace2025_{s}", i).cast("int") for i in K.ACCURACY_LEVELS), F.lit(0))
        for s in strategies
    }
    rows = ev.select(
        *[d.alias(f"__d{k}") for k, d in enumerate(depth.values())],
        *[column(f"codable_{m}").alias(f"__c{k}") for k, m in enumerate(models)],
        F.col("mapping_ok"),
    )
    cells = {}
    for n, i in enumerate(sorted(K.ACCURACY_LEVELS), 1):
        for k, s in enumerate(strategies):
            reached = F.col(f"__d{k}") >= n
            cells["all", s, i] = pct(reached)
            cells["mapping_ok", s, i] = pct(reached, F.col("mapping_ok"))
            if k < len(models):
                cells["codable", s, i] = pct(reached, F.col(f"__c{k}"))
    one = rows.agg(*[v.cast("double").alias(f"c{k}") for k, v in enumerate(cells.values())])
    named = F.array(*[
        F.struct(F.lit(s).alias("strategy"), F.lit(subset).alias("subset"), F.lit(i).cast("int").alias("level"),
                 F.col(f"c{k}").alias("accuracy"))
        for k, (subset, s, i) in enumerate(cells)
    ])
    return one.select(F.inline(named))


def best_strategy(matrix: DataFrame, order: Sequence[str]) -> DataFrame:
    """The strategy with the highest level-5 accuracy on all rows (after rounding).

    Ties go to the first strategy in ``order``.  One row.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("strategy"))
    return (
        matrix.filter((F.col("subset") == "all") & (F.col("level") == 5))
        .orderBy(F.col("accuracy").desc_nulls_last(), rank.asc())
        .limit(1)
        .select("strategy", "accuracy")
    )


def coded_stats(results: DataFrame) -> DataFrame:
    """A4: coded / not coded counts and the not-coded percentage (half-even, 2 digits)."""
    return results.agg(*[v.alias(k) for k, v in coded_metrics().items()])


def coded_metrics() -> dict[str, Column]:
    n = F.count(F.lit(1))
    coded = F.count_if(F.col("codable"))
    return {
        "num_coded": coded,
        "num_not_coded": n - coded,
        "pct_not_coded": F.bround(F.try_divide((n - coded) * F.lit(100.0), n), 2),
    }


def coverage_pct(coverage: DataFrame) -> DataFrame:
    """A5: share of rows whose label is among the candidates, in percent."""
    return coverage.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("mapping_ok")).alias("n_covered"),
        pct(F.col("mapping_ok"), digits=None).alias("pct_mapping_ok"),
    )
