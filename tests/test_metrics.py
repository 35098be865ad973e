import math
import random

import numpy as np
from pyspark.sql import functions as F

from plover.operators import metrics as M
from plover.operators.preprocess import ImputeScaler, exact_medians


def brute_auc_ap(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    pairs = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    auc = pairs / (len(pos) * len(neg))
    scores = sorted({s for _, s in rows}, reverse=True)
    tp = k = 0
    ap = 0.0
    for s in scores:
        grp = [y for y, x in rows if x == s]
        tp += sum(grp)
        k += len(grp)
        ap += sum(grp) * (tp / k)
    return auc, ap / len(pos)


def test_auc_ap_match_brute_force_with_ties(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 12))) for _ in range(600)]
    df = spark.createDataFrame(rows, "y int, s double").repartition(4)
    r = M.ranking_metrics(df, "y", "s").first()
    auc, ap = brute_auc_ap(rows)
    assert abs(r["roc_auc"] - auc) < 1e-12 and abs(r["average_precision"] - ap) < 1e-12


def test_single_class_is_nan(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.9)], "y int, s double")
    r = M.ranking_metrics(df, "y", "s").first()
    assert math.isnan(r["roc_auc"]) and math.isnan(r["average_precision"])


def test_confusion_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = M.confusion_metrics(df, "y", "p").first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_majority_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "y int")
    assert M.majority_class(df, "y").first()["majority_class"] == 0


def test_logloss(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.2)], "y int, p double")
    assert abs(M.logloss(df, "y", "p").first()["logloss"] - (-math.log(0.8))) < 1e-12


def test_reference_stats_sample(spark):
    rows = [(i, float(i % 97) if i % 11 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, x double")
    st = M.reference_stats(df, ["x"], key_cols=["k"]).first()
    vals = [r[1] for r in rows if r[1] is not None]
    assert st["count"] == len(vals) and len(st["values"]) == 500
    mean = sum(vals) / len(vals)
    std = (sum((v - mean) ** 2 for v in vals) / (len(vals) - 1)) ** 0.5
    assert abs(st["mean"] - mean) < 1e-9 and abs(st["std"] - std) < 1e-9
    again = M.reference_stats(df.repartition(3), ["x"], key_cols=["k"]).first()
    assert again["values"] == st["values"]
    # Brute force on the small fixture: one global sort by (seeded hash, value).
    brute = df.filter(F.col("x").isNotNull()).select(F.xxhash64(F.lit(42), "k").alias("h"), "x") \
        .orderBy("h", "x").limit(500).collect()
    assert st["values"] == [r["x"] for r in brute]


def test_reference_sample_without_key_is_layout_free(spark):
    rows = [(float(i % 613), float(i % 7)) for i in range(2500)]
    df = spark.createDataFrame(rows, "x double, z double")
    a = M.reference_stats(df, ["x", "z"]).orderBy("feature").collect()
    b = M.reference_stats(df.repartition(5), ["x", "z"]).orderBy("feature").collect()
    assert [r["values"] for r in a] == [r["values"] for r in b]
    assert [len(r["values"]) for r in a] == [500, 500]


def test_medians_and_scaling(spark):
    rows = [(1.0,), (2.0,), (4.0,), (10.0,), (None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double").withColumn("c", F.lit(5.0)) \
        .withColumn("e", F.lit(None).cast("double"))
    med = exact_medians(df, ["x", "c", "e"])
    assert med == {"x": 3.0, "c": 5.0, "e": None}
    model = ImputeScaler(inputCols=["x", "c", "e"]).fit(df)
    imputed = [1.0, 2.0, 4.0, 10.0, 3.0, 3.0]
    mu = sum(imputed) / 6
    sd = (sum((v - mu) ** 2 for v in imputed) / 6) ** 0.5
    out = model.transform(df).collect()
    assert abs(out[0]["x"] - (1.0 - mu) / sd) < 1e-12
    assert all(r["c"] == 0.0 for r in out) and all(r["e"] == 0.0 for r in out)
    assert model.getOrDefault(model.dropped) == ["e"]


def test_binary_metrics_one_scan_matches_separate_operators(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        y = rnd.choice([0, 1, 1, None, 2]) if i % 9 else None
        p = rnd.choice([0, 1, None]) if i % 13 else 1
        rows.append((i % 3, y, p, round(rnd.random(), 1)))
    df = spark.createDataFrame(rows, "g int, y int, p int, s double")
    one = {r["g"]: r for r in M.binary_metrics(df, "y", "p", "s", ["g"]).collect()}
    conf = {r["g"]: r for r in M.confusion_metrics(df, "y", "p", ["g"]).collect()}
    rank = {r["g"]: r for r in M.ranking_metrics(df, "y", "s", ["g"]).collect()}
    for g in one:
        for c in ("accuracy", "precision", "recall", "f1", "rows"):
            assert one[g][c] == conf[g][c], (g, c)
        for c in ("roc_auc", "average_precision"):
            assert abs(one[g][c] - rank[g][c]) < 1e-12, (g, c)


def test_majority_baseline_metrics_match_constant_predictor(spark):
    rnd = random.Random(3)
    for labels in ([0, 1, 1, None, 2], [1, 1, None], [0, 0, 1]):
        rows = [(i, rnd.choice(labels)) for i in range(300)]
        df = spark.createDataFrame(rows, "t long, y int")
        got = M.majority_baseline_metrics(df, "y", carry_min=["t"]).first()
        maj = M.majority_class(df, "y").first()["majority_class"]
        const = df.withColumn("pred", F.lit(maj)).withColumn("score", F.lit(maj).cast("double"))
        want = M.binary_metrics(const, "y", "pred", "score").first()
        assert got["t"] == 0
        for c in ("accuracy", "precision", "recall", "f1", "rows", "roc_auc", "average_precision"):
            a, b = got[c], want[c]
            assert (math.isnan(a) and math.isnan(b)) or abs(a - b) < 1e-12, (labels, c, a, b)


def test_medians_of_hard_distributions(spark):
    rng = np.random.default_rng(1)
    n = 5001
    columns = {"wide": np.exp(rng.uniform(-600, 600, n)) * rng.choice([-1, 1], n), "dense": 1 + rng.random(n) * 1e-9,
               "ints": rng.integers(-3, 4, n).astype(float), "tiny": rng.integers(0, 5000, n) * 5e-324,
               "endless": np.where(rng.random(n) < .7, np.inf, 1.0), "two": np.repeat([-2.0, 7.0], [2500, 2501])}
    rows = [tuple(float(c[i]) if i % 11 else (None if i % 2 else float("nan")) for c in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)) \
        .withColumn("it's", F.col("ints") * 2).withColumn("none", F.lit(None).cast("double"))
    got = exact_medians(df, df.columns)
    for k, c in enumerate(columns):
        assert got[c] == np.median([r[k] for r in rows if r[k] is not None and r[k] == r[k]]), c
    assert got["it's"] == 2 * got["ints"] and got["none"] is None
    assert exact_medians(df.limit(0), ["wide"]) == {"wide": None}
    even = spark.createDataFrame([(v,) for v in (-3.0, 10.0, 1e300, -0.0, 0.0, 4.0)], "x double")
    assert exact_medians(even, ["x"]) == {"x": 2.0}
