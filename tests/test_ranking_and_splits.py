import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plover.operators import splits as SP
from plover.operators.ranking import kth_thresholds, running_totals


def test_running_totals_matches_window(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", "c"]), rnd.randint(0, 50), rnd.randint(0, 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, g string, s int, w int").repartition(5)
    got = running_totals(df, ["s", "k"], weights=["w"], group_by=["g"], partitions=7)
    w = Window.partitionBy("g").orderBy("s", "k").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", F.sum("w").over(w).alias("cw"), (F.row_number().over(w.rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - 1).alias("pos"))
    bad = got.join(want, "k").filter((F.col("cum_w") != F.col("cw")) | (F.col("_rk_pos") != F.col("pos")))
    assert bad.count() == 0


def test_running_totals_descending_and_positions(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(200)], "k long, s double")
    ths = kth_thresholds(df, ["s", "k"], {(): [0, 199, 57]})
    srt = sorted((float(i % 10), i) for i in range(200))
    assert ths[((), 0)] == srt[0] and ths[((), 199)] == srt[199] and ths[((), 57)] == srt[57]


def keyed(spark, n=1000, pos_every=4, nulls=0):
    rows = [(i, (1 if i % pos_every == 0 else 0) if i >= nulls else None, float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "k long, y int, t double")


def counts(tagged):
    return {(r["split"], r["y"]): r["n"] for r in tagged.groupBy("split", "y").count()
            .withColumnRenamed("count", "n").collect()}


def test_percent_split_exact_quotas_disjoint_deterministic(spark):
    df = keyed(spark)
    a = SP.percent_split(df, 0.7, 0.15, "y", ["k"], seed=42)
    c = counts(a)
    # class 1: 250 rows -> 175 / 38 / 37 ; class 0: 750 -> 525 / 113 / 112
    assert c[("train", 1)] == 175 and c[("test", 1)] == 37 and c[("val", 1)] == 38
    assert c[("train", 0)] == 525 and c[("test", 0)] == 112 and c[("val", 0)] == 113
    assert a.count() == 1000 and a.select("k").distinct().count() == 1000
    b = SP.percent_split(df.repartition(7), 0.7, 0.15, "y", ["k"], seed=42)
    assert a.select("k", "split").subtract(b.select("k", "split")).count() == 0
    c2 = SP.percent_split(df, 0.7, 0.15, "y", ["k"], seed=7)
    assert c2.select("k", "split").subtract(a.select("k", "split")).count() > 0


def test_percent_split_null_targets_vanish_and_empty_test(spark):
    df = keyed(spark, n=20, nulls=5)
    t = SP.percent_split(df, 0.9, 0.01, "y", ["k"])
    assert t.filter(F.col("y").isNull()).count() == 0
    assert t.filter(F.col("split") == "test").count() == 0


def test_validate_fractions():
    for tr, te in [(0.0, 0.1), (1.0, 0.0), (0.8, -0.1), (0.8, 1.0), (0.9, 0.1)]:
        with pytest.raises(SP.SplitError):
            SP.validate_fractions(tr, te)


def test_sequential_split(spark):
    df = spark.createDataFrame([(i,) for i in range(101)], "k long").repartition(3)
    t = SP.sequential_split(df, 0.7, 0.15, ["k"])
    got = {r["split"]: (r["lo"], r["hi"], r["n"]) for r in
           t.groupBy("split").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n")).collect()}
    # n_train = int(101*0.7)=70, n_test = int(101*0.15)=15, val = 16
    assert got == {"train": (0, 69, 70), "val": (70, 85, 16), "test": (86, 100, 15)}


def test_cut_inside_equal_keys_is_an_error(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"))
    with pytest.raises(ValueError, match="unique"):
        SP.sequential_split(df, 0.55, 0.2, ["k"])
    # cuts that fall between different keys are exact even so
    got = {r["split"]: r["count"] for r in SP.sequential_split(df, 0.5, 0.2, ["k"]).groupBy("split").count().collect()}
    assert got == {"train": 50, "val": 30, "test": 20}


def test_time_split_two_and_three_way(spark):
    base = 1704067200000  # 2024-01-01
    day = 86_400_000
    rows = [(i, float(base + i * day)) for i in range(10)] + [(99, None)]
    df = spark.createDataFrame(rows, "k long, t double")
    two = SP.time_split(df, "2024-01-06", 0.0, "t", ["k"])
    assert two.count() == 10 and two.filter(F.col("split") == "train").count() == 5
    three = SP.time_split(df, "2024-01-06", 0.25, "t", ["k"])
    c = {r["split"]: r["count"] for r in three.groupBy("split").count().collect()}
    # round(0.25 * 10) = round(2.5) = 2 (half-even) -> latest 2 rows are test
    assert c == {"train": 5, "val": 3, "test": 2}
    assert sorted(r["k"] for r in three.filter(F.col("split") == "test").collect()) == [8, 9]


def test_time_split_ties_break_on_key(spark):
    rows = [(k, 1.0e12) for k in range(6)]
    t = SP.time_split(spark.createDataFrame(rows, "k long, t double"), "1970-01-01", 0.5, "t", ["k"])
    assert sorted(r["k"] for r in t.filter(F.col("split") == "test").collect()) == [3, 4, 5]


def test_stratified_downsample(spark):
    df = keyed(spark, n=100, nulls=10)  # 10 null targets count in the denominator
    out = SP.stratified_downsample(df, "y", 40, ["k"])
    c = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    n1 = sum(1 for i in range(10, 100) if i % 4 == 0)
    n0 = 90 - n1
    assert c == {1: max(1, int(40 * n1 / 100)), 0: max(1, int(40 * n0 / 100))}
    assert SP.stratified_downsample(df, "y", 100, ["k"]).count() == 100


def test_flag_split_and_latest_delta(spark):
    from plover.config import default_dataset_spec
    rows = [(1, "train", "2024-01-07"), (2, "train", "2024-01-14"), (3, "eval", "2024-01-21"),
            (4, "holdout", "2024-01-21"), (5, "train", None), (6, "train", "2024-01-14")]
    df = spark.createDataFrame(rows, "k int, split string, pipeline_run_date string")
    fs = SP.split_by_flag(df, default_dataset_spec(), capture_run_date=True)
    assert fs.train.count() == 4 and fs.eval.count() == 1 and "split" not in fs.train.columns
    assert fs.pipeline_run_date == "2024-01-21"
    assert sorted(r["k"] for r in SP.scope_train(fs.train, "latest_run_only").collect()) == [2, 6]
    with pytest.raises(Exception):
        SP.split_by_flag(df.drop("split"), default_dataset_spec())


def test_split_filter_is_pushed_to_parquet(spark):
    from plover.config import default_dataset_spec
    from plover.plans.tables import lake
    plan = SP.split_by_flag(lake(spark, "/root/testdata/sf0.001"), default_dataset_spec()).train \
        ._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan or "Scan parquet" in plan


def test_flag_split_pushdown_and_pruning_on_parquet(spark, scratch):
    from plover.config import default_dataset_spec
    from plover.plans.tables import lake
    lake(spark, "/root/testdata/sf0.001").write.mode("overwrite").parquet(scratch + "/lake")
    fs = SP.split_by_flag(spark.read.parquet(scratch + "/lake"), default_dataset_spec())
    plan = fs.train.select("row_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(split,train)" in plan
    assert "ReadSchema: struct<row_id:bigint,split:string>" in plan


def test_ranking_plan_has_no_single_partition_window(spark):
    from plover.operators import metrics as M
    df = spark.createDataFrame([(i % 2, float(i % 17)) for i in range(500)], "y int, s double")
    plan = M.ranking_metrics(df, "y", "s")._jdf.queryExecution().executedPlan().toString()
    # the running sums are computed per part (window input is clustered by the
    # part id, an expression over literal bounds), never in one task over all scores
    assert "Exchange hashpartitioning(_rk_pid" in plan


def test_boundary_searches_release_their_caches(spark):
    jsc = spark.sparkContext._jsc
    before = jsc.getPersistentRDDs().size()
    df = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"),
                                     (F.col("id") * 7919 % 1000).alias("time"))
    for tagged in (SP.percent_split(df, 0.6, 0.2, "y", ["k"]),
                   SP.time_split(df, "1970-01-01T00:00:00.500", 0.1, key_cols=["k"]),
                   SP.sequential_split(df, 0.5, 0.25, ["k"]),
                   SP.stratified_downsample(df, "y", 300, ["k"])):
        tagged.count()
    assert jsc.getPersistentRDDs().size() == before


def test_lazy_auc_is_stable_and_keeps_null_groups(spark):
    from plover.operators import metrics as M
    n = 60_000
    df = spark.range(n).select((F.xxhash64("id") % 1_000_003).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                               F.when(F.col("id") % 2 == 0, "a").alias("g"), "id")
    lazy = M.ranking_metrics(df, "y", "s")
    first = lazy.collect()
    SP.sequential_split(df, 0.5, 0.25, ["id"]).count()
    assert lazy.collect() == first
    pos = running_totals(df, ["s", "id"], partitions=9).agg(
        F.countDistinct("_rk_pos").alias("d"), F.min("_rk_pos").alias("lo"), F.max("_rk_pos").alias("hi")).first()
    assert tuple(pos) == (n, 0, n - 1)
    groups = {r["g"]: r for r in M.ranking_metrics(df, "y", "s", ["g"]).collect()}
    alone = M.ranking_metrics(df.filter("g is null"), "y", "s").first()
    assert set(groups) == {"a", None} and abs(groups[None]["roc_auc"] - alone["roc_auc"]) < 1e-12
    both = {r["g"]: r for r in M.binary_metrics(df.withColumn("p", F.lit(1)), "y", "p", "s", ["g"]).collect()}
    assert abs(both[None]["roc_auc"] - alone["roc_auc"]) < 1e-12


def test_downsample_keeps_null_groups(spark):
    df = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"), F.when(F.col("id") % 3 > 0, "a").alias("g"))
    out = SP.stratified_downsample(df, "y", 10, ["k"], by="g", caps={"a": 10})
    assert out.filter("g is null").count() == 20 and out.filter("g = 'a'").count() == 10


def test_parts_are_fixed_by_the_written_copy(spark):
    """A result read twice, or through other columns, sees the same parts; the input is not computed again."""
    from plover.operators.ranking import running_totals
    rows = spark.range(20000, numPartitions=5).select((F.col("id") * 7919 % 10007).alias("x"), F.col("id").alias("k"), F.rand().alias("r"))
    ranked = running_totals(rows, ["r", "k"], weights=["x"], partitions=50)
    once = {(row["k"], row["_rk_pos"], row["cum_x"]) for row in ranked.collect()}
    assert once == {(row["k"], row["_rk_pos"], row["cum_x"]) for row in ranked.select("cum_x", "_rk_pos", "k").collect()}
    assert sorted(p for _, p, _ in once) == list(range(20000))


def test_running_totals_with_many_parts(spark):
    from plover.operators.ranking import running_totals
    rows = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 1009).alias("x"), F.col("id").alias("k"))
    got = running_totals(rows, ["x", "k"], weights=["x"], group_by=["g"], descending=True, partitions=400).collect()
    want = {}
    for g in range(3):
        total = 0
        for p, (x, k) in enumerate(sorted(((i * 7919 % 1009, i) for i in range(3000) if i % 3 == g), reverse=True)):
            total += x
            want[k] = (p, total)
    assert {r["k"]: (r["_rk_pos"], r["cum_x"]) for r in got} == want


def test_strata_without_a_limit(spark, monkeypatch):
    """More strata than any broadcast-size cut, one of them with half of all rows; quotas exact, salted or not."""
    rows = 24_000
    df = spark.range(rows).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 11_003).cast("string")).alias("y"))
    counts_of = lambda t: {tuple(r[:2]): r[2] for r in t.groupBy("y", "split").count().collect()}
    n_of = {r[0]: r[1] for r in df.groupBy("y").count().collect()}
    plain = SP.percent_split(df, 0.5, 0.25, "y", ["k"])
    want = {}
    for y, n in n_of.items():
        a, b = int(n * 0.5), int(n * 0.25)
        want.update({key: v for key, v in (((y, "train"), a), ((y, "val"), n - a - b), ((y, "test"), b)) if v})
    assert len(n_of) > 10_000 and counts_of(plain) == want
    monkeypatch.setattr(SP, "SALT_FROM", 100)
    salted = SP.percent_split(df, 0.5, 0.25, "y", ["k"])
    assert plain.exceptAll(salted).isEmpty() and salted.count() == rows
    capped = SP.stratified_downsample(df, "y", 6_000, ["k"])
    assert {r[0]: r[1] for r in capped.groupBy("y").count().collect()} == {y: max(1, int(6_000 * n / rows)) for y, n in n_of.items()}


def test_cut_inside_equal_keys_of_a_class_is_an_error(spark):
    df = spark.createDataFrame([(1, "a")] * 6, "k int, y string")
    with pytest.raises(ValueError):
        SP.percent_split(df, 0.5, 0.25, "y", ["k"])
