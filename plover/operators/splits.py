"""Row splits, sampling and delta filters.

Every split returns ONE tagged DataFrame (a ``split`` column with ``train``,
``val``, ``test``); rows that belong nowhere are dropped. Quotas are exact:
the row at each quota boundary is found with the distributed ranking primitive,
and rows are then assigned by comparing their order key with those boundary
tuples. Strata may be any number: their boundaries are a table, written once
and joined by class, which Spark broadcasts while it is small, so wide rows are
not shuffled then.
Membership never depends on ``rand()`` or partition layout: the order inside a
class is ``xxhash64(seed, key)`` then the key.
"""
from __future__ import annotations

import math

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DatasetSpec
from ..functions.exprs import seeded_hash, tuple_lt
from ..session import written
from .ranking import join_null_safe, kth_thresholds, narrow_pass, running_totals
from .schema import SchemaError

SPLIT = "split"
SALT_FROM = 50_000  # classes from which bounds are joined by class and salt
SALTS = 16
SALT = "_split_salt"
HASH_COL = "_split_h"


class SplitError(ValueError):
    pass


def validate_fractions(train_pct: float, test_pct: float) -> None:
    """Every part but the test part must be able to receive rows."""
    shares = {"train": train_pct, "test": test_pct, "val": 1.0 - train_pct - test_pct}
    empty = sorted(name for name, share in shares.items() if share < 0 or (share == 0 and name != "test"))
    if empty or train_pct + test_pct >= 1.0:
        raise SplitError(f"no rows can go to {empty or ['val']} with shares {shares}")


# ---------------------------------------------------------------------------
# Flag split and run-date delta
# ---------------------------------------------------------------------------
@dataclass
class FlagSplit:
    train: DataFrame
    eval: DataFrame
    pipeline_run_date: str | None = None
    source_path: str | None = None


def tag_by_flag(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows whose flag is the train or eval value (others in neither)."""
    col = spec.split_column
    if col not in df.columns:
        raise SchemaError(f"Expected `{col}` column but it's missing. Available: {df.columns}")
    return df.filter(F.col(col).isin(spec.split_train_value, spec.split_eval_value))


def split_by_flag(df: DataFrame, spec: DatasetSpec, capture_run_date: bool = False) -> FlagSplit:
    col = spec.split_column
    if col not in df.columns:
        raise SchemaError(f"Expected `{col}` column but it's missing. Available: {df.columns}")
    run_date = run_date_of(df) if capture_run_date else None
    train = df.filter(F.col(col) == spec.split_train_value).drop(col)
    evl = df.filter(F.col(col) == spec.split_eval_value).drop(col)
    return FlagSplit(train, evl, run_date)


def run_date_of(df: DataFrame, date_col: str = "pipeline_run_date") -> str | None:
    """The run date of a load. Tables have no row order, so this is the
    greatest date present (one aggregate row)."""
    if date_col not in df.columns:
        return None
    value = df.select(F.max(date_col).cast("string")).first()[0]
    return value


def filter_latest_run_date(df: DataFrame, date_col: str = "pipeline_run_date") -> DataFrame:
    """Only rows of the greatest run date (NULL dates never match). The max is
    a scalar subquery, planned once, no join."""
    if date_col not in df.columns:
        return df
    latest = df.select(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == latest)


def scope_train(train: DataFrame, scope: str, date_col: str = "pipeline_run_date") -> DataFrame:
    if scope == "all_train":
        return train
    if scope == "latest_run_only":
        return filter_latest_run_date(train, date_col)
    raise SplitError(f"unknown retrain scope: {scope}")


# ---------------------------------------------------------------------------
# Helpers
# ---------------------------------------------------------------------------
def _class_bounds(narrow: DataFrame, class_cols: Sequence[str], order: Sequence[str], cuts: dict[str, Column]) -> DataFrame:
    """Per class the order key of its row at each cut (a position, from ``total_rows`` and the class columns).

    A cut at or past the end of a class has no row: NULL, everything is below
    it. The table is written, so each class is ranked once; an order key equal
    to the one before it raises, as the cut could not be exact.
    """
    at = F.col("_rk_pos")
    ranked = running_totals(narrow.select(*dict.fromkeys([*class_cols, *order])), order, group_by=class_cols)
    near = F.lit(False)
    for cut in cuts.values():
        near = near | (at == cut) | (at == cut - 1)
    key = F.struct(*order)
    bounds = written(ranked.filter(near).groupBy(*class_cols).agg(
        *[F.max(F.when(at == cut - k, key)).alias(f"{name}{'_before' * k}") for name, cut in cuts.items() for k in (0, 1)]), "bounds")
    tied = F.lit(False)
    for name in cuts:
        tied = tied | (F.col(name) == F.col(f"{name}_before"))
    if not bounds.filter(tied).isEmpty():
        raise ValueError(f"a cut falls between equal order keys {list(order)}; end the order in a unique key")
    return bounds.drop(*[f"{name}_before" for name in cuts])


def _with_bounds(base: DataFrame, bounds: DataFrame, class_cols: Sequence[str], hash_col: str) -> DataFrame:
    """``base`` with the bounds of each row's class.

    Few classes are a small side that Spark broadcasts by its size. With more,
    both sides meet by class and salt, so that a hot class is many tasks.
    """
    if bounds.count() <= SALT_FROM:
        return join_null_safe(base, bounds, class_cols, "left")
    salted = bounds.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return join_null_safe(base.withColumn(SALT, F.pmod(F.col(hash_col), F.lit(SALTS)).cast("int")), salted, [*class_cols, SALT], "left").drop(SALT)


def _below(order: Sequence[str], bound: str) -> Column:
    return F.col(bound).isNull() | (F.struct(*order) < F.col(bound))


# ---------------------------------------------------------------------------
# Time split (2-way / 3-way with a most-recent test tail)
# ---------------------------------------------------------------------------
def cutoff_millis(cutoff: str) -> int:
    ts = datetime.fromisoformat(cutoff)
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=timezone.utc)
    return int(ts.timestamp() * 1000)


def time_split(df: DataFrame, cutoff: str, test_pct: float = 0.0, time_col: str = "time",
               key_cols: Sequence[str] = ("row_id",)) -> DataFrame:
    """train: time < cutoff; post-cutoff rows are val, except the latest
    ``round(test_pct * rows_with_time)`` (half-even, capped at the post count)
    which become test. Rows without a time are in neither."""
    cut = F.lit(cutoff_millis(cutoff))
    t = F.col(time_col)
    has_time = t.isNotNull() & ~F.isnan(t.cast("double"))
    base = df.filter(has_time)
    pre = t < cut
    if test_pct <= 0:
        return base.withColumn(SPLIT, F.when(pre, F.lit("train")).otherwise(F.lit("val")))
    order = [time_col, *key_cols]
    with narrow_pass(base, order) as narrow:
        counts = narrow.agg(F.sum(F.when(pre, 1).otherwise(0)).alias("pre"),
                            F.sum(F.when(pre, 0).otherwise(1)).alias("post")).first()
        n_pre, n_post = int(counts["pre"] or 0), int(counts["post"] or 0)
        n_test = min(int(round(test_pct * (n_pre + n_post))), n_post)
        if n_test <= 0:
            return base.withColumn(SPLIT, F.when(pre, F.lit("train")).otherwise(F.lit("val")))
        k = n_post - n_test
        bounds = kth_thresholds(narrow.filter(~pre), order, {(): [k]})
    tail = bounds[((), k)]
    label = (F.when(pre, F.lit("train"))
             .when(tuple_lt(order, tail), F.lit("val"))
             .otherwise(F.lit("test")))
    return base.withColumn(SPLIT, label)


# ---------------------------------------------------------------------------
# Stratified (percent) split
# ---------------------------------------------------------------------------
def stratified_quotas(n: int, train_pct: float, test_pct: float) -> tuple[int, int, int]:
    """(train, val, test) row counts: train and test take whole rows only, val the remainder."""
    head, tail = (math.floor(n * share) for share in (train_pct, test_pct))
    return head, n - head - tail, tail


def percent_split(df: DataFrame, train_pct: float, test_pct: float, target: str,
                  key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Per class: first ``int(n*train_pct)`` rows (hash order) -> train, next
    -> val, last ``int(n*test_pct)`` -> test. NULL targets are in no class."""
    validate_fractions(train_pct, test_pct)
    base = df.filter(F.col(target).isNotNull()).withColumn(HASH_COL, seeded_hash(seed, *key_cols))
    order = list(dict.fromkeys([HASH_COL, *key_cols]))
    n = F.col("total_rows")
    bounds = _class_bounds(base, [target], order, {"_cut_train": F.floor(n * F.lit(train_pct)), "_cut_val": n - F.floor(n * F.lit(test_pct))})
    label = F.when(_below(order, "_cut_train"), "train").when(_below(order, "_cut_val"), "val").otherwise("test")
    return _with_bounds(base, bounds, [target], HASH_COL).withColumn(SPLIT, label).drop(HASH_COL, "_cut_train", "_cut_val")


def _assign_with_full(order, bounds, plan, counts, group_cols, labels) -> Column:
    expr = None
    for g, cuts in plan.items():
        cond_g = F.lit(True)
        for c, v in zip(group_cols, g):
            cond_g = cond_g & (F.col(c) == F.lit(v))
        inner = None
        for label, cut, bound in zip(labels, cuts, bounds[g]):
            if cut >= counts[g]:
                cond = F.lit(True)  # every remaining row is below this boundary
            elif cut <= 0:
                continue
            else:
                cond = tuple_lt(order, bound)
            inner = F.when(cond, F.lit(label)) if inner is None else inner.when(cond, F.lit(label))
        inner = F.lit(labels[len(cuts)]) if inner is None else inner.otherwise(F.lit(labels[len(cuts)]))
        expr = F.when(cond_g, inner) if expr is None else expr.when(cond_g, inner)
    return expr if expr is not None else F.lit(None).cast("string")


# ---------------------------------------------------------------------------
# Sequential split
# ---------------------------------------------------------------------------
def sequential_split(df: DataFrame, train_pct: float, test_pct: float,
                     order_cols: Sequence[str]) -> DataFrame:
    """First ``int(n*train_pct)`` rows of the order -> train, last
    ``int(n*test_pct)`` -> test, the rest -> val. The order must end in a
    unique key (tables have no file order)."""
    validate_fractions(train_pct, test_pct)
    order = list(order_cols)
    with narrow_pass(df, order) as narrow:
        n = narrow.count()
        n_train, n_val, n_test = stratified_quotas(n, train_pct, test_pct)
        cuts = [n_train, n_train + n_val]
        found = kth_thresholds(narrow, order, {(): [c for c in cuts if c < n]})
    bounds = {(): [found.get(((), c)) for c in cuts]}
    expr = _assign_with_full(order, bounds, {(): cuts}, {(): n}, [], ["train", "val", "test"])
    return df.withColumn(SPLIT, expr)


# ---------------------------------------------------------------------------
# Stratified downsample (optionally per split) and shuffle rank
# ---------------------------------------------------------------------------
def stratified_downsample(df: DataFrame, target: str, max_rows: int, key_cols: Sequence[str],
                          seed: int = 42, by: str | None = None,
                          caps: dict | None = None) -> DataFrame:
    """Unchanged when a frame has ``<= max_rows`` rows; otherwise each class
    keeps ``max(1, int(max_rows * n_class / n_frame))`` rows in hash order.
    ``n_frame`` counts NULL-target rows too, which themselves are dropped.
    With ``by``, each value of that column is a frame with its own cap
    (``caps``; values without a cap pass through unchanged)."""
    groups = [by] if by else []
    classes = list(dict.fromkeys([*groups, target]))
    base = df.withColumn(HASH_COL, seeded_hash(seed, *key_cols))
    order = list(dict.fromkeys([HASH_COL, *key_cols]))
    limits = dict(caps or {}) if by else {None: max_rows}
    frame = (lambda v: F.col(by).eqNullSafe(F.lit(v))) if by else (lambda v: F.lit(True))
    with narrow_pass(base, list(dict.fromkeys([*classes, *order]))) as narrow:
        # One count per frame that has a cap, NULL targets included.
        sizes = narrow.agg(*[F.count(F.when(frame(v), 1)).alias(f"n{k}") for k, v in enumerate(limits)]).first() if limits else []
        capped = {v: n for v, n in zip(limits, sizes) if n > limits[v]}
        if not capped:
            return df
        quota = in_capped = None
        for v, n in capped.items():
            share = F.greatest(F.lit(1), F.floor(F.lit(limits[v]) * F.col("total_rows") / F.lit(n)))
            quota = F.when(frame(v), share) if quota is None else quota.when(frame(v), share)
            in_capped = frame(v) if in_capped is None else in_capped | frame(v)
        bounds = _class_bounds(narrow.filter(in_capped & F.col(target).isNotNull()), classes, order, {"_cut": quota})
    keep = ~in_capped | (F.col(target).isNotNull() & _below(order, "_cut"))
    return _with_bounds(base, bounds, classes, HASH_COL).filter(keep).drop(HASH_COL, "_cut")


def with_shuffle_rank(df: DataFrame, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Tables are unordered; a seeded hash rank gives a reproducible shuffled
    order for writers that need one."""
    return df.withColumn("shuffle_rank", seeded_hash(seed, *key_cols))


def split_frames(tagged: DataFrame) -> dict[str, DataFrame]:
    return {name: tagged.filter(F.col(SPLIT) == name).drop(SPLIT) for name in ("train", "val", "test")}


def split_report(tagged: DataFrame, target: str, split_col: str = SPLIT) -> DataFrame:
    """rows, positives, zeros and positive rate per split (empty splits absent)."""
    y = F.col(target)
    return tagged.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(y).cast("long").alias("positives"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("long").alias("zeros"),
        F.avg(y).alias("positive_rate"))
