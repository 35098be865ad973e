import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plover.config import CandidateSpec
from plover.operators import models as MD
from plover.operators import search as H
from plover.operators.features import DatasetBundle
from plover.plans.training import retrain, train_candidates


def planted(spark, n=600, offset=0):
    rows = []
    for i in range(offset, offset + n):
        a = float((i * 37) % 100)
        b = float((i * 11) % 7)
        y = 1 if a + 3 * b > 60 else 0
        rows.append((i, a, b, y))
    return spark.createDataFrame(rows, "k long, a double, b double, y int")


@pytest.fixture(scope="module")
def bundle(spark):
    return DatasetBundle(planted(spark), planted(spark, 300, 10_000), ["a", "b"], "y", ["k"])


def test_build_estimator_mapping_and_errors(spark):
    plan = MD.build_estimator("xgboost", {"learning_rate": 0.1, "n_estimators": 7, "max_depth": 3,
                                          "min_child_weight": 2, "reg_lambda": 1.5, "n_jobs": -1,
                                          "scale_pos_weight": 2.0}, "y")
    assert plan.mapped == {"maxIter": 7, "maxDepth": 3, "stepSize": 0.1}
    assert not plan.unsupported and not plan.weight_col
    assert plan.estimator.getOrDefault("settings") == {"rounds": 7, "max_depth": 3, "learning_rate": 0.1, "min_child_weight": 2.0,
                                                       "reg_lambda": 1.5, "positive_weight": 2.0}
    assert MD.build_estimator("xgboost", {"scale_pos_weight": 2.0}, "y").weight_col
    with pytest.raises(MD.ModelConfigError):
        MD.build_estimator("xgboost", {"bogus": 1}, "y")
    with pytest.raises(MD.ModelConfigError):
        MD.build_estimator("svm", {}, "y")
    with pytest.raises(MD.ModelConfigError):
        MD.build_estimator("dummy", {"strategy": "prior"}, "y")


def test_train_candidates_gates_and_failures(spark, bundle, scratch):
    cands = [CandidateSpec("baseline", "dummy", {"strategy": "most_frequent"}),
             CandidateSpec("gbt", "xgboost", {"n_estimators": 5, "max_depth": 3}),
             CandidateSpec("broken", "xgboost", {"bogus": 1})]
    res = train_candidates(spark, bundle, cands, artifact_dir=scratch, with_reference_stats=False)
    d = {r["tags"]["candidate_name"]: r for r in res.decisions.collect()}
    assert d["baseline"]["metrics"]["roc_auc"] == 0.5 and d["baseline"]["gate_tag"] == "exempt"
    assert d["gbt"]["metrics"]["roc_auc"] > 0.9 and d["gbt"]["gate_tag"] == "passed"
    assert d["broken"]["tags"]["status"] == "failed" and d["broken"]["gate_tag"] == "failed"
    assert os.path.isdir(os.path.join(scratch, "gbt")) and os.path.isdir(os.path.join(scratch, "_rejected"))
    loaded = PipelineModel.load(os.path.join(scratch, "gbt"))
    assert MD.expected_columns(loaded) == ["a", "b"] and MD.is_boosting_model(loaded)
    out = MD.scoring_output(MD.score(loaded, bundle.val.withColumn("user_id", F.lit("u"))
                                     .withColumn("gmap_id", F.lit("g"))), "M", "1")
    assert out.columns == ["user_id", "gmap_id", "will_visit_probability", "recommend", "model_name",
                           "model_version"]


def n_trees(model):
    return len(model.stages[-1].trees)


def scores(model, df):
    return [r["score"] for r in MD.score(model, df).select("k", "score").orderBy("k").collect()]


def test_continue_boosting_adds_exactly_n_trees(spark, bundle, scratch):
    plan = MD.build_estimator("xgboost", {"n_estimators": 3, "max_depth": 2}, "y")
    old, _ = MD.fit_pipeline(plan, ["a", "b"], bundle.train, "y")
    new_rows = planted(spark, 400, 20_000)
    cont = MD.continue_boosting(old, new_rows, "y", additional_rounds=4, checkpoint_every=2)
    assert n_trees(cont) == 7 and n_trees(old) == 3
    # with zero extra rounds the continued model reproduces the old probabilities
    same = MD.continue_boosting(old, new_rows, "y", additional_rounds=0)
    assert scores(same, bundle.val) == pytest.approx(scores(old, bundle.val), abs=1e-12)
    path = os.path.join(scratch, "cont")
    cont.write().overwrite().save(path)
    back = PipelineModel.load(path)
    assert n_trees(back) == 7 and scores(back, bundle.val) == pytest.approx(scores(cont, bundle.val), abs=1e-12)
    res = retrain(spark, old, CandidateSpec("gbt", "xgboost", {}), new_rows, bundle.val, "y",
                  additional_rounds=2, threshold=-1.0)
    assert res.decision["decision"] == "keep" and n_trees(res.model) == 5


def test_continued_fit_equals_the_longer_fit(spark, bundle):
    fit = lambda n: MD.fit_pipeline(MD.build_estimator(
        "xgboost", {"n_estimators": n, "max_depth": 2, "learning_rate": 0.3}, "y"), ["a", "b"], bundle.train, "y")[0]
    more = MD.continue_boosting(fit(3), bundle.train, "y", additional_rounds=4)
    assert scores(more, bundle.val) == pytest.approx(scores(fit(7), bundle.val), abs=1e-9)


def test_continued_trees_keep_the_old_parameters(spark, bundle):
    plan = MD.build_estimator("xgboost", {"n_estimators": 2, "max_depth": 3, "subsample": 0.5}, "y")
    plan.estimator.setMinInstancesPerNode(150).setFeatureSubsetStrategy("0.5")
    old, _ = MD.fit_pipeline(plan, ["a", "b"], bundle.train, "y")
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    new_rows = planted(spark, 400, 20_000)
    plain = MD.continue_boosting(old, new_rows, "y", 3)
    # two leaves of 150 rows each are all that 200 sampled rows allow
    assert all(t.numNodes <= 3 for t in plain.stages[-1].trees[2:])
    heavy = MD.continue_boosting(old, new_rows, "y", 3, positive_weight=5.0)
    mean = lambda m: MD.score(m, bundle.val).agg(F.avg("score")).first()[0]
    assert mean(heavy) > mean(plain)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held
    # a further run may use another learning rate: every tree carries its own weight
    again = MD.continue_boosting(plain, new_rows, "y", 1, learning_rate=0.01)
    assert n_trees(again) == 6 and list(again.stages[-1].treeWeights)[:5] == list(plain.stages[-1].treeWeights)


def test_training_leaves_nothing_cached(spark, bundle):
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    train_candidates(spark, bundle, [CandidateSpec("gbt", "xgboost", {"n_estimators": 2, "max_depth": 2})],
                     with_reference_stats=False)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held


def test_refit_needs_old_rows(spark, bundle):
    plan = MD.build_estimator("logistic_regression", {"max_iter": 5}, "y", 600)
    old, _ = MD.fit_pipeline(plan, ["a", "b"], bundle.train, "y")
    with pytest.raises(MD.ModelConfigError):
        retrain(spark, old, CandidateSpec("lr", "logistic_regression", {"max_iter": 5}), bundle.train,
                bundle.val, "y")
    res = retrain(spark, old, CandidateSpec("lr", "logistic_regression", {"max_iter": 5}), bundle.train,
                  bundle.val, "y", old_rows=bundle.train)
    assert res.decision["decision"] in ("keep", "reject")


SPACE = {"d": {"type": "choice", "values": [4, 6]}, "u": {"type": "uniform", "lower": 0.6, "upper": 1.0},
         "l": {"type": "loguniform", "lower": 0.01, "upper": 0.2},
         "r": {"type": "randint", "lower": 1, "upper": 3}}


def test_sampler(spark):
    a = H.sample_search_space(spark, SPACE, 200, seed=1).collect()
    b = H.sample_search_space(spark, SPACE, 200, seed=1).collect()
    assert a == b
    assert {r["d"] for r in a} == {4.0, 6.0} and {r["r"] for r in a} == {1.0, 2.0}
    assert all(0.6 <= r["u"] < 1.0 and 0.01 <= r["l"] <= 0.2 for r in a)
    with pytest.raises(H.SearchSpaceError):
        H.sample_search_space(spark, {"x": {"type": "normal"}}, 2)
    assert H.rung_schedule(25, 100, 2) == [25, 50, 100]


def test_search_grows_surviving_trials_and_keeps_the_best(spark, bundle, scratch):
    from plover.plans.tuning import tune
    space = {"max_depth": {"type": "choice", "values": [1, 2, 3]},
             "learning_rate": {"type": "uniform", "lower": 0.1, "upper": 0.3}}
    path = os.path.join(scratch, "best")
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    reports, best = tune(spark, bundle, space, 3, max_t=4, grace=2, base_params={"max_depth": 9, "subsample": 1.0},
                         best_model_path=path)
    got = reports.collect()
    assert sorted(r["iteration"] for r in got) == [2, 2, 2, 4]
    assert all(r["metrics"]["training_iteration"] == r["iteration"] for r in got)
    assert all({"train_logloss", "validation_logloss", "roc_auc"} <= set(r["metrics"]) for r in got)
    assert all(r["params"]["max_depth"] <= 3 and r["params"]["subsample"] == 1.0 for r in got)
    top = best.first()
    model = PipelineModel.load(path)
    assert n_trees(model) == top["iteration"]
    assert MD.score(model, bundle.val).count() == 300
    # the rung of a survivor equals a fit of that many rounds from zero
    last = next(r for r in got if r["iteration"] == 4)
    again, _ = tune(spark, bundle, space, 3, max_t=4, grace=4)
    same = next(r for r in again.collect() if r["trial_id"] == last["trial_id"])
    assert same["metrics"]["validation_logloss"] == pytest.approx(last["metrics"]["validation_logloss"], abs=1e-9)
    # a resumed search fits nothing that is reported
    resumed, _ = tune(spark, bundle, space, 3, max_t=4, grace=2, reports=reports)
    assert {(r["trial_id"], r["iteration"], r["metrics"]["seconds"]) for r in resumed.collect()} == \
        {(r["trial_id"], r["iteration"], r["metrics"]["seconds"]) for r in got}
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held


def test_text_choices_and_trials_at_once(spark, bundle, tmp_path, monkeypatch):
    import threading
    from plover.operators import newton as N
    from plover.plans.tuning import tune
    space = {"grow_policy": {"type": "choice", "values": ["depthwise", "lossguide"]}, "reg_lambda": {"type": "uniform", "lower": 0.5, "upper": 2.0},
             "max_depth": {"type": "choice", "values": [2, 3]}}
    sampled = H.with_typed(H.sample_search_space(spark, space, 30, seed=3), space).collect()
    assert {r["grow_policy"] for r in sampled} == {"depthwise", "lossguide"}
    assert all(r["typed"].toPython() == {k: r[k] for k in space} and "grow_policy" not in r["params"] for r in sampled)
    for values in ([], ["a", 1], [True, 1.0]):
        with pytest.raises(H.SearchSpaceError):
            H.sample_search_space(spark, {"x": {"type": "choice", "values": values}}, 2)
    real, running, most = N.grow_tree, set(), []
    pools = set()

    def watched(*args):
        running.add(threading.get_ident())
        most.append(len(running))
        pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        try:
            return real(*args)
        finally:
            running.discard(threading.get_ident())

    monkeypatch.setattr(N, "grow_tree", watched)
    figures = lambda got: [(r["trial_id"], r["iteration"], r["typed"].toPython(), {k: v for k, v in r["metrics"].items() if k != "seconds"}) for r in got]
    one, _ = tune(spark, bundle, space, 4, max_t=2, grace=1, seed=3)
    assert max(most) == 1 and pools == {None}
    two, best = tune(spark, bundle, space, 4, max_t=2, grace=1, seed=3, at_once=2)
    assert max(most) == 2 and {"plover-0", "plover-1", "plover-2", "plover-3"} <= pools
    a, b = figures(one.collect()), figures(two.collect())
    assert [x[:3] for x in a] == [x[:3] for x in b]
    for x, y in zip(a, b):
        assert x[3] == pytest.approx(y[3], abs=1e-9)
    two.write.parquet(str(tmp_path / "reports"))
    back = spark.read.parquet(str(tmp_path / "reports"))
    kept = back.select(F.try_variant_get("typed", "$.grow_policy", "string").alias("p"), F.try_variant_get("typed", "$.max_depth", "double").alias("d"))
    assert {r["p"] for r in kept.collect()} == {t["grow_policy"] for _, _, t, _ in b} and kept.filter("d is null").isEmpty()
    assert best.first()["typed"].toPython()["grow_policy"] in ("depthwise", "lossguide")


def test_failed_jobs_side_by_side(spark):
    from plover.session import side_by_side
    seen = []

    def job(k):
        seen.append(spark.range(k).count())
        if k == 2:
            raise ValueError("two")
        return k

    with pytest.raises(ValueError):
        side_by_side(spark, [lambda k=k: job(k) for k in range(5)], 3)
    assert sorted(seen) == [0, 1, 2, 3, 4]
    assert side_by_side(spark, [lambda k=k: k for k in range(5)], 3) == [0, 1, 2, 3, 4]


def test_lost_search_goes_on_and_reports_between_rungs(spark, bundle, scratch, monkeypatch):
    from plover.operators import newton as N
    from plover.plans.tuning import tune
    space = {"max_depth": {"type": "choice", "values": [1, 2]}, "reg_lambda": {"type": "uniform", "lower": 0.5, "upper": 2.0}}
    search = lambda log: tune(spark, bundle, space, 2, max_t=4, grace=2, report_every=1, log_path=f"{scratch}/{log}")[0]
    figures = lambda df: {(r["trial_id"], r["iteration"]): {k: v for k, v in r["metrics"].items() if k != "seconds"} for r in df.collect()}
    whole = figures(search("a"))
    assert sorted(k for _, k in whole) == [1, 1, 2, 2, 3, 4]
    real, grown = N.grow_tree, []

    def lost(*args):
        if len(grown) == 5:
            raise RuntimeError("lost")
        grown.append(args)
        return real(*args)

    monkeypatch.setattr(N, "grow_tree", lost)
    with pytest.raises(RuntimeError):
        search("b")
    grown.clear()
    after = figures(search("b"))
    assert len(grown) == 1 and after.keys() == whole.keys()
    for key, m in whole.items():
        assert after[key] == pytest.approx(m, abs=1e-9)


def test_halving_best_and_resume(spark):
    rows = [(f"t{i}", 25, {"p": float(i)}, {"roc_auc": 0.5 + i / 100}) for i in range(5)]
    rows += [("t3", 50, {"p": 3.0}, {"roc_auc": 0.9}), ("t4", 50, {"p": 4.0}, {"roc_auc": 0.8})]
    rep = spark.createDataFrame(rows, "trial_id string, iteration int, params map<string,double>, "
                                      "metrics map<string,double>")
    assert sorted(r[0] for r in H.survivors(rep, 25, "roc_auc").collect()) == ["t3", "t4"]
    best = H.best_trial(rep, "roc_auc").first()
    assert best["trial_id"] == "t3" and best["iteration"] == 50
    ties = rep.withColumn("metrics", F.create_map(F.lit("roc_auc"), F.lit(0.7)))
    assert all(H.best_trial(ties, "roc_auc", mode).first()["trial_id"] == "t0" for mode in ("max", "min"))
    trials = spark.createDataFrame([("t3",), ("t4",), ("t9",)], "trial_id string")
    assert sorted(r[0] for r in H.pending_trials(trials, rep, 50).collect()) == ["t9"]
    with pytest.raises(H.SearchSpaceError):
        H.require_reports(H.best_trial(rep.limit(0), "roc_auc"), "roc_auc")


def test_candidates_lookup_and_flatten(spark):
    from plover.config import candidates_frame, default_candidates, find_candidate
    cands = default_candidates()
    assert find_candidate(cands, "xgboost_v1").kind == "xgboost"
    with pytest.raises(ValueError):
        find_candidate(cands, "nope")
    long = {(r["candidate"], r["key"]): r["value"] for r in candidates_frame(spark, cands).collect()}
    assert long[("xgboost_v2", "params.subsample")] == "0.85"


def test_top_checkpoints(spark):
    rows = [("a", 1, {}, {"validation_logloss": 0.5}), ("b", 1, {}, {"validation_logloss": 0.3}),
            ("c", 1, {}, {"validation_logloss": float("nan")}), ("d", 2, {}, {"validation_logloss": 0.4})]
    rep = spark.createDataFrame(rows, "trial_id string, iteration int, params map<string,double>, "
                                      "metrics map<string,double>")
    assert [r["trial_id"] for r in H.top_checkpoints(rep, 2).collect()] == ["b", "d"]


def test_training_sinks(spark, bundle, scratch):
    cands = [CandidateSpec("baseline", "dummy", {"strategy": "most_frequent"}),
             CandidateSpec("weak", "logistic_regression", {"max_iter": 1})]
    from plover.config import GateSpec
    gates = GateSpec(hard_minimums={"roc_auc": 0.999}, beat_metric="roc_auc", beat_min_delta=0.5,
                     exempt=["baseline"])
    runs_path = os.path.join(scratch, "runs")
    train_candidates(spark, bundle, cands, gates, artifact_dir=os.path.join(scratch, "art"),
                     runs_path=runs_path, with_reference_stats=False)
    runs = spark.read.parquet(runs_path)
    assert runs.count() == 2
    assert {r[0] for r in runs.select(F.col("tags")["quality_gate"]).collect()} == {"exempt", "failed"}
    side = spark.read.json(os.path.join(scratch, "art", "_rejected", "decisions"))
    assert [r["candidate"] for r in side.collect()] == ["weak"]


def test_logistic_coefficients_equal_plain_newton_steps(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 2)) * [1.0, 3.0]
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.4 + x[:, 0] - 0.5 * x[:, 1])))).astype(float)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol=MD.FEATURES).transform(
        spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, y double"))
    model = MD.build_estimator("logistic_regression", {"C": 0.05, "max_iter": 200}, "y", 400).estimator.fit(rows)
    # 1/2 |w|^2 + C * sum(log loss), the intercept free
    full, w = np.column_stack([x, np.ones(400)]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-full @ w))
        slope = 0.05 * full.T @ (p - y) + w * [1, 1, 0]
        w = w - np.linalg.solve(0.05 * (full.T * (p * (1 - p))) @ full + np.diag([1, 1, 0]), slope)
    assert np.allclose([*model.coefficients, model.intercept], w, atol=1e-3)
