import datetime as dt

from pyspark.sql import functions as F

from plover.config import GateSpec
from plover.operators import gates as G
from plover.operators import registry as R
from plover.sources.sinks import RUNS_SCHEMA

T0 = dt.datetime(2024, 1, 1)


def run(rid, name, kind, minutes, **metrics):
    return (rid, "exp", T0 + dt.timedelta(minutes=minutes), {"candidate_name": name, "candidate_kind": kind,
            "code_version": "abc"}, {"candidate.kind": kind, "candidate.notes": f"n-{name}"}, metrics)


GATES = GateSpec(hard_minimums={"roc_auc": 0.55, "recall": 0.30}, beat_metric="roc_auc",
                 beat_min_delta=0.25, exempt=["baseline"])


def decisions(spark, rows, gates=GATES):
    runs = spark.createDataFrame(rows, RUNS_SCHEMA)
    out = G.gate_decisions(runs, gates).select(F.col("tags")["candidate_name"].alias("n"), "passed",
                                              "exempt", "failures", "gate_tag", "registered",
                                              "baseline_comparison")
    return {r["n"]: r for r in out.collect()}


def test_gate_rows(spark):
    rows = [
        run("r0", "baseline", "dummy", 0, roc_auc=0.5, recall=1.0),
        run("r1", "good", "xgboost", 1, roc_auc=0.9, recall=0.8),
        run("r2", "low", "xgboost", 2, roc_auc=0.52, recall=0.8),
        run("r3", "missing", "xgboost", 3, roc_auc=0.9),
        run("r4", "nan", "xgboost", 4, roc_auc=float("nan"), recall=0.9),
        run("r5", "at_delta", "xgboost", 5, roc_auc=0.75, recall=0.9),
        run("r6", "under_delta", "xgboost", 6, roc_auc=0.7499, recall=0.9),
    ]
    d = decisions(spark, rows)
    assert d["baseline"]["exempt"] and d["baseline"]["passed"] and d["baseline"]["gate_tag"] == "exempt"
    assert not d["baseline"]["registered"]
    assert d["good"]["passed"] and d["good"]["registered"] and d["good"]["failures"] == []
    assert d["low"]["failures"][0] == "roc_auc=0.5200 below hard minimum 0.55"
    assert d["missing"]["failures"] == ["recall is missing or NaN (threshold 0.3)"]
    # NaN metrics are dropped before gating; the beat gate then skips silently
    assert d["nan"]["failures"] == ["roc_auc is missing or NaN (threshold 0.55)"]
    assert d["nan"]["baseline_comparison"] is None
    assert d["at_delta"]["passed"], d["at_delta"]["failures"]
    assert d["under_delta"]["failures"] == ["roc_auc delta vs baseline +0.2499 < required min_delta=0.25"]


def test_no_baseline_fails(spark):
    d = decisions(spark, [run("r1", "good", "xgboost", 1, roc_auc=0.9, recall=0.8)])
    assert not d["good"]["passed"] and d["good"]["failures"] == [G.NO_BASELINE_MESSAGE]


def test_retrain_decision_nan_rejects(spark):
    df = spark.createDataFrame([(0.7, 0.75), (0.7, float("nan")), (0.7, 0.69)], "o double, n double")
    got = [r[0] for r in df.select(G.retrain_decision(F.col("o"), F.col("n"), 0.0)).collect()]
    assert got == ["keep", "reject", "reject"]


def registry_rows():
    return [
        run("b0", "baseline", "dummy", 0, f1=0.5),
        run("a1", "old", "xgboost", 1, f1=0.8, roc_auc=0.9, precision=0.8, recall=0.8),
        run("a2", "tie_new", "xgboost", 3, f1=0.8, roc_auc=0.9, precision=0.8, recall=0.8),
        run("a3", "weak", "xgboost", 2, f1=0.54, roc_auc=0.9, precision=0.8, recall=0.8),
        run("a4", "nokind", None, 4, f1=0.99, roc_auc=0.99, precision=0.99, recall=0.99),
    ]


def test_registry_gates_best_and_tie(spark):
    runs = spark.createDataFrame(registry_rows(), RUNS_SCHEMA)
    ev = R.threshold_gates(R.recent_candidate_runs(runs, 10), R.baseline_f1(runs))
    got = {r["run_id"]: r["all_passed"] for r in ev.collect()}
    assert got == {"a1": True, "a2": True, "a3": False}  # a4 lacks the kind tag: excluded
    best = R.best_passing_run(ev).first()
    assert best["run_id"] == "a2"  # equal F1: the newer run wins
    tags = {r["run_id"]: r["quality_gate_details"] for r in R.gate_tag_updates(ev).collect()}
    assert tags["a3"] == ('{"f1_minimum": false, "auc_minimum": true, "precision_minimum": true, '
                          '"recall_minimum": true, "beats_baseline": false}')


def test_production_regression_and_next_version(spark):
    runs = spark.createDataFrame(registry_rows() + [run("p1", "prod", "xgboost", -5, f1=0.82)], RUNS_SCHEMA)
    mv = spark.createDataFrame([("M", 1, "Production", "p1", {}), ("M", 2, "Archived", "a1", {})],
                               "name string, version int, stage string, run_id string, tags map<string,string>")
    dec = R.run_quality_gate(runs, mv, "M").first()
    assert dec["register"]  # 0.80 >= 0.82 - 0.02
    nxt = R.next_version(mv, R.run_quality_gate(runs, mv, "M"), "M").first()
    assert nxt["version"] == 3 and nxt["stage"] == "Staging"
    runs2 = spark.createDataFrame(registry_rows() + [run("p1", "prod", "xgboost", -5, f1=0.83)], RUNS_SCHEMA)
    assert not R.run_quality_gate(runs2, mv, "M").first()["register"]


def test_leaderboard_format(spark):
    runs = spark.createDataFrame([run("abcdefghij", "c1", "xgboost", 0, f1=0.5, accuracy=0.123456,
                                      train_seconds=1.005)], RUNS_SCHEMA)
    row = R.leaderboard(runs, "http://ui").first()
    assert row["quality"] == "accuracy=0.1235, f1=0.5000"
    assert row["hyperparams"] == "kind=xgboost"
    assert row["run_link"] == "[abcdefgh](http://ui/#/experiments/0/runs/abcdefghij)"
    assert row["notes"] == "n-c1"


def test_nan_production_score_does_not_block(spark):
    from plover.operators import registry as RG
    best = spark.createDataFrame([(0.5,)], "f1 double")
    for prod, want in ((float("nan"), True), (None, True), (0.9, False), (0.5, True)):
        assert RG.regression_check(best, spark.createDataFrame([(prod,)], "production_f1 double")).first()["register"] is want
