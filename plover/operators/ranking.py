"""Exact global order statistics without a single-task window.

``Window.orderBy(x)`` with no partition puts every row in one task. Instead:

1. rows are range-partitioned by the sort keys (Spark samples the bounds and finds
   a row's part by binary search), tagged with their part and written once to the
   shared folder: every later read, also after an executor was lost, sees the
   same parts, and the input is not computed again;
2. per (part, group) totals give the offsets of all earlier parts, as a
   DataFrame: a window over the parts of each group;
3. a window partitioned by part and group gives running sums inside each part;
   adding the offset (joined null-safe) makes them global.

Hot order values cannot pile up in one part as long as the order key ends in a
unique column (callers pass a row key), because bounds are full key tuples.
Callers pre-aggregate ties (e.g. one row per distinct score) first.
"""
from __future__ import annotations

from contextlib import contextmanager
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark import StorageLevel

from ..session import default_partitions, written

PID = "_rk_pid"


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL keys match NULL keys; the key columns of ``left`` stay."""
    other = right.select(*[F.col(c).alias(f"_ns_{c}") if c in on else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & left[c].eqNullSafe(other[f"_ns_{c}"])
    return left.join(other, cond, how).drop(*[f"_ns_{c}" for c in on])


def _sort_exprs(group_by: Sequence[str], order_by: Sequence[str], descending: bool) -> list[Column]:
    exprs = [F.col(g).asc() for g in group_by]
    exprs += [F.col(c).desc() if descending else F.col(c).asc() for c in order_by]
    return exprs


def _in_parts(df: DataFrame, sort: list[Column], parts: int) -> DataFrame:
    """``df`` with ``PID``, the number of its range of the sort order; equal keys share a part."""
    if parts < 2:
        return df.withColumn(PID, F.lit(0))
    return written(df.repartitionByRange(parts, *sort).withColumn(PID, F.spark_partition_id()), "ranges")


def running_totals(df: DataFrame, order_by: Sequence[str], weights: Sequence[str] = (),
                   group_by: Sequence[str] = (), descending: bool = False,
                   partitions: int | None = None, count_col: str | None = "_rk_pos") -> DataFrame:
    """Add inclusive running sums ``cum_<w>`` for each weight column (and a
    0-based position ``count_col``) along ``order_by`` within ``group_by``,
    plus group totals ``total_<w>`` / ``total_rows``."""
    spark = df.sparkSession
    n_parts = partitions or default_partitions(spark)
    group_by, order_by = list(group_by), list(order_by)
    weights = list(weights)
    work = df
    if count_col:
        work = work.withColumn("_rk_one", F.lit(1).cast("long"))
        weights = weights + ["_rk_one"]
    sort = _sort_exprs(group_by, order_by, descending)
    placed = _in_parts(work, sort, n_parts)
    totals = placed.groupBy(PID, *group_by).agg(*[F.sum(w).alias(w) for w in weights])
    earlier = Window.partitionBy(*group_by).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_by)
    offsets = totals.select(
        PID, *group_by,
        *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"_rk_off_{w}") for w in weights],
        *[F.sum(w).over(whole).alias(f"_rk_tot_{w}") for w in weights])
    inside = Window.partitionBy(PID, *group_by).orderBy(*sort) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", *[F.sum(w).over(inside).alias(f"_rk_in_{w}") for w in weights])
    joined = join_null_safe(local, offsets, [PID, *group_by])
    out_cols = [F.col(c) for c in df.columns]
    for w in weights:
        cum = F.col(f"_rk_off_{w}") + F.col(f"_rk_in_{w}")
        tot = F.col(f"_rk_tot_{w}")
        if w == "_rk_one":
            out_cols += [(cum - 1).alias(count_col), tot.alias("total_rows")]
        else:
            out_cols += [cum.alias(f"cum_{w}"), tot.alias(f"total_{w}")]
    return joined.select(*out_cols)


@contextmanager
def narrow_pass(df: DataFrame, columns: Sequence[str]):
    """The few columns a multi-pass boundary search reads (counts, range
    bounds, running totals), persisted for the duration of the search, so
    the upstream plan runs once instead of once per pass. A lost block is
    recomputed from the (deterministic) lineage; the final labelling reads
    the source itself, so the copy is released as soon as the boundaries
    are known. A frame that its caller holds is read as it is."""
    if df.storageLevel != StorageLevel.NONE:
        yield df.select(*columns)
        return
    narrow = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield narrow
    finally:
        narrow.unpersist()


def rows_at_positions(df: DataFrame, order_by: Sequence[str], positions: dict,
                      group_by: Sequence[str] = (), max_rows: int = 100_000) -> list:
    """The rows at given 0-based positions of the order (per group).

    ``positions`` maps a group tuple (``()`` when ungrouped) to positions.
    Returns a list of Rows with group, order columns and ``_rk_pos``; the
    result size is bounded by the number of requested positions.
    """
    wanted = [(tuple(g), int(p)) for g, ps in positions.items() for p in ps]
    if not wanted:
        return []
    if len(wanted) > max_rows:
        raise ValueError("too many requested positions")
    narrow = df.select(*group_by, *order_by)
    ranked = running_totals(narrow, order_by, group_by=group_by)
    spark = df.sparkSession
    schema_fields = [(g, narrow.schema[g].dataType) for g in group_by]
    want_schema = T.StructType([T.StructField(n, t) for n, t in schema_fields]
                               + [T.StructField("_rk_pos", T.LongType())])
    want_df = spark.createDataFrame([(*g, p) for g, p in wanted], want_schema)
    hit = join_null_safe(ranked, F.broadcast(want_df), [*group_by, "_rk_pos"])
    return hit.select(*group_by, *order_by, "_rk_pos").collect()


def kth_thresholds(df: DataFrame, order_by: Sequence[str], positions: dict,
                   group_by: Sequence[str] = ()) -> dict:
    """``{(group, position): order-tuple}`` for the requested positions.

    Callers cut a table by comparing rows with these tuples, so each must differ
    from the row before it. Equal neighbours mean that the order does not end in
    a unique key; the cut could not be exact, and that is an error."""
    with_before = {g: sorted({q for p in ps for q in (p - 1, p) if q >= 0}) for g, ps in positions.items()}
    at = {}
    for r in rows_at_positions(df, order_by, with_before, group_by):
        at[(tuple(r[c] for c in group_by), int(r["_rk_pos"]))] = tuple(r[c] for c in order_by)
    for g, ps in positions.items():
        for p in ps:
            if (g, p) in at and at.get((g, p - 1)) == at[(g, p)]:
                raise ValueError(f"rows {p - 1} and {p} have equal order keys {list(order_by)}; end the order in a unique key")
    return {(g, p): at[(g, p)] for g, ps in positions.items() for p in ps if (g, p) in at}


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a result whose size is bounded by construction; refuse otherwise."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows; refusing to collect")
    return rows
