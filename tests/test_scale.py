"""What tasks read and send as inputs grow."""
import pytest

from plover.operators import newton as N
from plover.plans import tables as T
from pyspark.sql import functions as F


def test_lake_partitions_follow_the_rows(spark, scratch, monkeypatch):
    """A join that is shuffled, and by its bytes one partition, still gives partitions of bounded rows."""
    n = 3000
    spark.range(n).selectExpr("id AS event_id", "timestamp'2024-01-02' AS ts", "id % 7 AS user_id", "'view' AS event_type", "CAST(id AS DOUBLE) AS value",
                              "'{}' AS props").coalesce(1).write.parquet(f"{scratch}/events.parquet")
    spark.range(50).selectExpr("id AS p_partkey", "CAST(id AS INT) AS p_size").coalesce(1).write.parquet(f"{scratch}/part.parquet")
    monkeypatch.setattr(T, "ROWS_A_PART", 100, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = T.lake(spark, scratch)
        held = [r["n"] for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(held) == n and max(held) <= 2 * 100 and rows.distinct().count() == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_histograms_are_one_row_per_task_and_pair(spark):
    """Tasks send packed histograms, not cells, and no more tasks than run at a time do so while their rows are few."""
    rows = spark.range(4000).repartition(16).selectExpr("array(rand(1), rand(2), double(id % 2)) AS x", "double(rand(3) > 0.5) AS y", "0D AS margin")
    s = N.Settings(rounds=1, max_depth=2, max_bins=32)
    edges = N.bin_edges(rows, s.max_bins)
    table = N.written(N._bin_rows(rows, edges, 1.0), "bins").coalesce(4)
    tree = N.Tree()
    active = [tree.add(0.0)]
    sent = N.histograms(table, [], tree, active, 3, s.max_bins, [0, 1, 2], 1, 1.0)
    assert sent.count() <= 4 * 3
    best = N._best_splits(table, [], tree, active, 3, [0, 1, 2], s, 0)
    assert len(best) == 1 and best[0]["b"]["hl"] <= best[0]["h"] == pytest.approx(1000.0)


def test_trials_share_their_binned_rows(spark, scratch, monkeypatch):
    """Fits with other settings on shared binned rows are those on rows of their own; edges are looked for once."""
    rows = spark.range(3000).selectExpr("array(rand(1), rand(2)) AS x", "double(rand(3) > 0.6) AS y", "0D AS margin").localCheckpoint()
    shared = N.FitLog(spark, f"{scratch}/rows").start(rows, N.Settings())
    real, calls = N.bin_edges, []
    monkeypatch.setattr(N, "bin_edges", lambda *a: calls.append(a) or real(*a))
    for k, s in enumerate([N.Settings(rounds=2, max_depth=2), N.Settings(rounds=2, max_depth=3, positive_weight=3.0)]):
        got, edges = N.fit_trees(rows, s, log=N.FitLog(spark, f"{scratch}/t{k}", shared))
        assert not calls and edges == shared[1]
        own, _ = N.fit_trees(rows, s)
        assert [t.feature for t in got] == [t.feature for t in own] and [t.bin for t in got] == [t.bin for t in own]
        assert got[1].value == pytest.approx(own[1].value)
        calls.clear()
