"""Evaluation aggregates: confusion metrics, exact ROC-AUC and average
precision, log loss, majority class, label cardinality, split report and
per-feature reference statistics.

ROC-AUC and AP are exact step-wise values over descending distinct-score
groups: rows are first pre-aggregated to one row per (group, score) - a
map-side-combined aggregation that absorbs hot scores - and the running sums
over scores come from the distributed ranking primitive, never from a
single-partition window.
"""
from __future__ import annotations

from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null
from .ranking import collect_bounded, join_null_safe, running_totals


def _safe_div(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def _confusion_select(agg: DataFrame, group_by: Sequence[str]) -> DataFrame:
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    return agg.select(
        *group_by,
        _safe_div(F.col("_ok"), F.col("_n")).alias("accuracy"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.col("_n").alias("rows"))


def confusion_metrics(df: DataFrame, label: str, pred: str, group_by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1 (zero division -> 0), one pass."""
    y, p = F.col(label), F.col(pred)
    agg = df.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).alias("_tp"),
        F.sum(F.when((y != 1) & (p == 1), 1).otherwise(0)).alias("_fp"),
        F.sum(F.when((y == 1) & (p != 1), 1).otherwise(0)).alias("_fn"),
        F.sum(F.when(y == p, 1).otherwise(0)).alias("_ok"))
    return _confusion_select(agg, list(group_by))


def _score_counts(df: DataFrame, label: str, score: str, group_by: Sequence[str]) -> DataFrame:
    """One row per (group, score): rows ``_k`` and positives ``_p``."""
    return df.groupBy(*group_by, F.col(score).alias("_s")).agg(
        F.count(F.lit(1)).alias("_k"),
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("_p"))


def ranking_metrics(df: DataFrame, label: str, score: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC (ties count half) and step-wise average precision per
    group; NaN when a group holds only one class."""
    group_by = list(group_by)
    return _ranking_from_scores(_score_counts(df, label, score, group_by), group_by)


def _ranking_from_scores(per_score: DataFrame, group_by: list) -> DataFrame:
    ranked = running_totals(per_score, ["_s"], weights=["_p", "_k"], group_by=group_by,
                            descending=True, count_col=None)
    p, k = F.col("_p"), F.col("_k")
    cum_p, cum_k = F.col("cum__p"), F.col("cum__k")
    pos, rows = F.col("total__p"), F.col("total__k")
    neg = rows - pos
    terms = ranked.select(
        *group_by, pos.alias("_P"), neg.alias("_N"),
        ((k - p) * (cum_p - p + p / 2.0)).alias("_auc_term"),
        (p * (cum_p / cum_k)).alias("_ap_term"))
    agg = terms.groupBy(*group_by).agg(
        F.first("_P").alias("_P"), F.first("_N").alias("_N"),
        F.sum("_auc_term").alias("_auc"), F.sum("_ap_term").alias("_ap"))
    one_class = (F.col("_P") == 0) | (F.col("_N") == 0)
    nan = F.lit(float("nan"))
    return agg.select(
        *group_by,
        F.when(one_class, nan).otherwise(F.col("_auc") / (F.col("_P") * F.col("_N"))).alias("roc_auc"),
        F.when(one_class, nan).otherwise(F.col("_ap") / F.col("_P")).alias("average_precision"))


def binary_metrics(df: DataFrame, label: str, pred: str, score: str,
                   group_by: Sequence[str] = ()) -> DataFrame:
    """The metric set of a scored validation frame (E5 + E6 + E7) from ONE
    scan: a pre-aggregate per (group, score, prediction) carries rows,
    positives, non-positives and correct predictions; the confusion metrics
    and the per-score ranking table are both folded from it."""
    group_by = list(group_by)
    y, pr = F.col(label), F.col(pred)
    counts = (df.groupBy(*group_by, F.col(score).alias("_s"), pr.alias("_pr")).agg(
        F.count(F.lit(1)).alias("_k"),
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("_p"),
        F.sum(F.when(y != 1, 1).otherwise(0)).cast("long").alias("_q"),
        F.sum(F.when(y == pr, 1).otherwise(0)).cast("long").alias("_ok")))
    is_pos = F.col("_pr") == 1
    conf = _confusion_select(counts.groupBy(*group_by).agg(
        F.sum("_k").alias("_n"),
        F.sum(F.when(is_pos, F.col("_p")).otherwise(0)).alias("_tp"),
        F.sum(F.when(is_pos, F.col("_q")).otherwise(0)).alias("_fp"),
        F.sum(F.when(F.col("_pr") != 1, F.col("_p")).otherwise(0)).alias("_fn"),
        F.sum("_ok").alias("_ok")), group_by)
    per_score = counts.groupBy(*group_by, "_s").agg(F.sum("_k").alias("_k"), F.sum("_p").alias("_p"))
    rank = _ranking_from_scores(per_score, group_by)
    if group_by:
        return join_null_safe(conf, rank, group_by, "left")
    return _one_row_join(conf, rank)


def majority_baseline_metrics(df: DataFrame, label: str, carry_min: Sequence[str] = ()) -> DataFrame:
    """The metric set of the majority-class predictor (constant prediction
    and constant score = the majority class) from ONE class-count aggregate:
    with a single score group every metric is a function of the per-class
    counts, so the scored rows are never joined or ranked. Same values (and
    the same arithmetic) as ``binary_metrics`` on the constant columns.
    ``carry_min`` columns come out as their overall minimum."""
    y = F.col(label)
    per = (df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"),
                                              *[F.min(c).alias(c) for c in carry_min]))
    maj = per.filter(y.isNotNull()).agg(F.max_by(y, F.struct(F.col("_n"), -y)).alias("_maj"))
    j = _one_row_join(per, maj)
    agg = j.agg(F.sum("_n").alias("_n"),
                F.sum(F.when(y == 1, F.col("_n")).otherwise(0)).alias("_P"),
                F.sum(F.when(y != 1, F.col("_n")).otherwise(0)).alias("_Q"),
                F.sum(F.when(y == F.col("_maj"), F.col("_n")).otherwise(0)).alias("_ok"),
                F.first("_maj").alias("_maj"),
                *[F.min(c).alias(c) for c in carry_min])
    pos_pred = F.col("_maj") == 1
    conf = agg.select(
        "_n", "_ok", "_P", *carry_min,
        F.when(pos_pred, F.col("_P")).otherwise(0).alias("_tp"),
        F.when(pos_pred, F.col("_Q")).otherwise(0).alias("_fp"),
        F.when(F.col("_maj") != 1, F.col("_P")).otherwise(0).alias("_fn"))
    p, k = F.col("_P"), F.col("rows")
    n_neg = k - p
    one_class = (p == 0) | (n_neg == 0)
    nan = F.lit(float("nan"))
    # One score group: running positives equal the group's positives.
    auc = ((k - p) * (p - p + p / 2.0)) / (p * n_neg)
    ap = (p * (p / k)) / p
    return _confusion_select(conf, [*carry_min, "_P"]).select(
        *carry_min, "accuracy", "precision", "recall", "f1", "rows",
        F.when(one_class, nan).otherwise(auc).alias("roc_auc"),
        F.when(one_class, nan).otherwise(ap).alias("average_precision"))


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two one-row aggregates on a constant key (no cartesian product)."""
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one")


def logloss(df: DataFrame, label: str, prob: str, group_by: Sequence[str] = (),
            eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label)
    return df.groupBy(*group_by).agg(
        (-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("logloss"))


def majority_class(df: DataFrame, target: str) -> DataFrame:
    """Most frequent class; ties go to the smallest class."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.col(target), F.struct(F.col("n"), -F.col(target)))
    return counts.agg(best.alias("majority_class"), F.max("n").alias("majority_count"),
                      F.sum("n").alias("rows"))


def label_cardinality(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.countDistinct(label).alias("distinct_labels"))


# ---------------------------------------------------------------------------
# Reference statistics (drift baseline)
# ---------------------------------------------------------------------------
def value_sql(name: str) -> str:
    """SQL text: the column as double with NaN turned into NULL."""
    q = "`" + name.replace("`", "``") + "`"
    return f"CASE WHEN isnan(CAST({q} AS DOUBLE)) THEN NULL ELSE CAST({q} AS DOUBLE) END"


def long_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(feature, value) pairs; NaN and NULL dropped. One ``stack`` generator
    written as SQL text (a single JVM call however many features)."""
    features = list(features)
    pairs = ", ".join(f"'{f}', {value_sql(f)}" for f in features)
    keep_sql = [("`" + k.replace("`", "``") + "`") for k in keep]
    long = df.selectExpr(*keep_sql, f"stack({len(features)}, {pairs}) AS (feature, value)")
    return long.filter(F.col("value").isNotNull())


def reference_stats(df: DataFrame, features: Sequence[str], key_cols: Sequence[str] = (),
                    sample_size: int = 500, seed: int = 42,
                    with_sample: bool = True) -> DataFrame:
    """Per feature: count, mean, sample std (n-1), min, max and (optionally) up
    to ``sample_size`` values. Features with no value are omitted.

    The sample is the ``sample_size`` smallest values of a seeded hash. To keep
    that bounded per task, rows are pre-filtered by a hash threshold chosen
    from the counts so that each feature keeps about 4x the sample size, then
    the exact top-k is taken on that small remainder (retrying with a wider
    threshold in the rare case the filter kept too few).
    """
    features = list(features)
    stats = long_features(df, features).groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    if not with_sample:
        return stats
    counts = {r["feature"]: int(r["count"]) for r in collect_bounded(stats.select("feature", "count"),
                                                                  len(features), "feature counts")}
    sample = sample_values(df, features, counts, key_cols, sample_size, seed)
    return stats.join(sample, "feature", "left")


def sample_values(df: DataFrame, features: list[str], counts: dict, key_cols: Sequence[str],
                  sample_size: int, seed: int) -> DataFrame:
    from pyspark.sql import Window
    # Without a row key the row's own values are hashed: identical rows are
    # interchangeable in a value sample, and unlike a generated id the hash
    # is the same when a lost partition is recomputed.
    keys = list(key_cols) or list(features)
    h_base = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in features],
                       F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]).alias("_h"))
    long = h_base.unpivot(["_h"], features, "feature", "value").filter(F.col("value").isNotNull())
    # xxhash64 is uniform on [-2^63, 2^63); keep h < threshold(feature).
    factor = 4.0
    while True:
        cond = None
        for f, n in counts.items():
            frac = min(1.0, factor * sample_size / max(n, 1))
            cut = -(2 ** 63) + int(frac * (2 ** 64)) if frac < 1.0 else None
            c = (F.col("feature") == f) if cut is None else ((F.col("feature") == f) & (F.col("_h") < F.lit(cut)))
            cond = c if cond is None else (cond | c)
        kept = long.filter(cond if cond is not None else F.lit(False))
        kept_counts = {r["feature"]: int(r["n"]) for r in
                       kept.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        short = [f for f, n in counts.items() if kept_counts.get(f, 0) < min(n, sample_size)]
        if not short or factor >= 2 ** 20:
            break
        factor *= 8
    w = Window.partitionBy("feature").orderBy("_h", "value")
    top = kept.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= sample_size)
    return top.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_h", "value"))), lambda s: s["value"])
        .alias("values"))
