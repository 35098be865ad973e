"""Synchronous successive-halving search over boosted-tree parameters."""
from __future__ import annotations

import json
import time
import uuid
from functools import partial
from numbers import Real

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEARCH_GRACE_PERIOD, SEARCH_MAX_ROUNDS, SEARCH_REDUCTION_FACTOR
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import search as H
from ..operators.features import DatasetBundle
from ..session import ensure_checkpoint_dir, side_by_side, written
from ..operators import newton as N

TRIALS_SCHEMA = "trial_id string, iteration int, params map<string,double>, metrics map<string,double>"


def _reports_frame(spark: SparkSession, rows: list[tuple], trials: dict[str, dict]) -> DataFrame:
    """Reports (one per trial and report) with all parameters of their trial, typed, as the VARIANT object ``typed``."""
    made = [(*r, json.dumps(trials[r[0]])) for r in rows]
    return spark.createDataFrame(made, TRIALS_SCHEMA + ", typed string").withColumn("typed", F.parse_json("typed"))


def _numbers(params: dict) -> dict[str, float]:
    return {k: float(v) for k, v in params.items() if isinstance(v, Real) and not isinstance(v, bool)}


def _gbt_for(params: dict, rounds: int, target: str, seed: int) -> GBTClassifier:
    return GBTClassifier(featuresCol=MD.FEATURES, labelCol=target, maxIter=int(rounds),
                         maxDepth=int(params.get("max_depth", 6)),
                         stepSize=float(params.get("learning_rate", 0.1)),
                         subsamplingRate=float(params.get("subsample", 1.0)), seed=seed)


def _is_regularised(params: dict) -> bool:
    return any(name in params for name in (*MD.REGULARISED, *MD.GROWTH))


def staged_metrics(rows: DataFrame, trees: list, edges: list, every: int, in_bins: bool = False) -> DataFrame:
    """Metric set and log loss after each ``every`` rounds: ``round`` and the metrics, from one
    scoring pass over ``rows``, written once as more than one figure reads it."""
    scored = written(N.staged_scores(rows, trees, edges, every, in_bins), "staged").withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    losses = M.logloss(scored, "y", "score", ["round"])
    return M.binary_metrics(scored, "y", "pred", "score", ["round"]).join(losses, "round")


def newton_rows(df: DataFrame, target: str) -> DataFrame:
    """Assembled rows as :mod:`newton` reads them."""
    return df.select(vector_to_array(MD.FEATURES).alias("x"), F.col(target).cast("double").alias("y"), F.lit(0.0).alias("margin"))


def _metrics_at(model, data: dict[str, DataFrame], target: str) -> dict:
    """Validation metrics and both log losses of a fitted model."""
    scored = {part: MD.score(model, df, threshold=0.5) for part, df in data.items()}
    m = dict(M.binary_metrics(scored["validation"], target, "pred", "score").first().asDict())
    for part, df in scored.items():
        m[f"{part}_logloss"] = M.logloss(df, target, "score").first()["logloss"]
    return {k: float(v) for k, v in m.items() if v is not None}


def tune(spark: SparkSession, bundle: DatasetBundle, space: dict, num_samples: int,
         metric: str = "roc_auc", mode: str = "max", max_t: int = SEARCH_MAX_ROUNDS,
         grace: int = SEARCH_GRACE_PERIOD, reduction: int = SEARCH_REDUCTION_FACTOR,
         seed: int = 42, reports: DataFrame | None = None, base_params: dict | None = None,
         best_model_path: str | None = None, log_path: str | None = None,
         report_every: int | None = None, at_once: int = 1) -> tuple[DataFrame, DataFrame]:
    """Returns (reports, best).

    Trials with regularised trees keep every finished tree under ``log_path``
    (default: the checkpoint folder); a search that is called again with the
    same folder, rows and space grows on from the last tree of each trial. They
    report after every ``report_every`` rounds (default: at the rungs), all
    rounds of a rung scored in one pass. ``at_once`` trials of a rung run at a
    time over the one cached input, in fair scheduler pools; their reports are
    those of a serial run. Choices may be text or booleans; every report has
    all parameters with their types in ``typed``, the numbers also in ``params``.

    A trial that survives a rung grows on from the trees that it has; it is
    fitted from zero only where an earlier, interrupted run left ``reports``
    without a model. What these reports cover is not fitted again. Sampled
    parameters override ``base_params``. Every report holds the validation
    metrics and both log losses. The best trial's model, behind the fitted
    preprocessor, is written to ``best_model_path``."""
    target = bundle.target
    trials = H.with_typed(H.sample_search_space(spark, space, num_samples, seed), space)
    trial_rows = {r["trial_id"]: {**(base_params or {}), **r["typed"].toPython()}
                  for r in trials.select("trial_id", "typed").collect()}
    pre, asm = MD.fit_preprocessor(bundle.train, bundle.feature_columns)
    keep = [*bundle.key_columns, target]
    data = {part: asm.transform(pre.transform(df)).select(*keep, MD.FEATURES) for part, df in (("validation", bundle.val), ("train", bundle.train))}
    only_bins = all(_is_regularised(p) for p in trial_rows.values())
    for part, df in data.items():  # rows that are only put in bins are read once for it, train rows once more for the edges
        if part == "train" or not only_bins:
            df.persist(StorageLevel.MEMORY_AND_DISK)
    train_v = data["train"]

    logs = (log_path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/plover-trials-{uuid.uuid4().hex}").rstrip("/")

    # Trials differ in parameters, not in rows: these are put in bins once for all of them.
    in_bins: dict = {}
    if any(_is_regularised(p) for p in trial_rows.values()):
        rows_of = {part: newton_rows(df, target).filter("y is not null") for part, df in data.items()}
        in_bins["train"], bin_edges = N.FitLog(spark, f"{logs}/_rows").start(rows_of["train"], N.Settings())
        in_bins["validation"] = N.binned(rows_of["validation"], bin_edges) if bin_edges else rows_of["validation"]
        if only_bins:
            train_v.unpersist()

    def newton_trees(tid: str, rounds: int):
        settings = {**MD.newton_settings({"learning_rate": 0.1, "random_state": seed, **trial_rows[tid]}), "rounds": rounds}
        return N.fit_trees(newton_rows(train_v, target), N.Settings(**settings), log=N.FitLog(spark, f"{logs}/{tid}", (in_bins["train"], bin_edges)))

    def newton_reports(tid: str, past: int, rung: int):
        """Reports after ``past`` rounds up to the rung, and the model at the rung."""
        t0 = time.perf_counter()
        trees, edges = newton_trees(tid, rung)
        every = report_every or rung
        of_train = N.staged_scores(in_bins["train"], trees, edges, every, in_bins=True)
        loss = {r["round"]: r["logloss"] for r in M.logloss(of_train, "y", "score", ["round"]).collect()}
        reported = staged_metrics(in_bins["validation"], trees, edges, every, in_bins=True).collect()
        out = []
        for r in sorted(reported, key=lambda r: r["round"]):  # one row per report
            if past < r["round"] <= rung:
                m = {k: float(v) for k, v in r.asDict().items() if v is not None and k not in ("round", "logloss")}
                m.update(validation_logloss=float(r["logloss"]), train_logloss=float(loss[r["round"]]),
                         training_iteration=float(r["round"]), seconds=time.perf_counter() - t0)
                out.append((r["round"], m))
        model = N.as_model(trees, edges, f"newton_{tid}").setFeaturesCol(MD.FEATURES)
        return out, model

    def fitted(p: dict, rounds: int, before):
        spw = float(p.get("scale_pos_weight", 1.0))
        if before is not None:
            return MD.grow_boosting(before, train_v, target, rounds - len(before.trees), positive_weight=spw)
        est, fit_on = _gbt_for(p, rounds, target, seed), train_v
        if spw != 1.0:
            est.setWeightCol(MD.WEIGHT)
            fit_on = train_v.withColumn(MD.WEIGHT, F.when(F.col(target) == 1, F.lit(spw)).otherwise(F.lit(1.0)))
        return est.fit(fit_on)

    done = {}
    if reports is not None:
        # At most one row per trial of this search and rung, whatever else the table holds.
        for r in reports.filter(F.col("trial_id").isin(list(trial_rows))).dropDuplicates(["trial_id", "iteration"]).collect():
            done[(r["trial_id"], int(r["iteration"]))] = (dict(r["params"]), dict(r["metrics"]))
    alive = sorted(trial_rows)
    rows, models = [], {}
    past = 0
    def run_trial(tid: str, rung: int) -> tuple[list[tuple], object]:
        """Reports of one trial after ``past`` rounds up to the rung, and its model (none where reports were there)."""
        p = trial_rows[tid]
        if (tid, rung) in done:
            # Reports between the rungs come back with the rung's own.
            kept = sorted((k, m) for (t, k), (_, m) in done.items() if t == tid and past < k <= rung)
            return [(tid, k, _numbers(p), m) for k, m in kept], models.get(tid)
        if _is_regularised(p):
            staged, model = newton_reports(tid, past, rung)
            return [(tid, k, _numbers(p), m) for k, m in staged], model
        t0 = time.perf_counter()
        model = fitted(p, rung, models.get(tid))
        m = _metrics_at(model, data, target)
        m["seconds"] = time.perf_counter() - t0
        m["training_iteration"] = float(len(model.trees))
        return [(tid, rung, _numbers(p), m)], model

    for rung in H.rung_schedule(grace, max_t, reduction):
        for tid, (made, model) in zip(alive, side_by_side(spark, [partial(run_trial, tid, rung) for tid in alive], at_once)):
            rows += made
            if model is not None:
                models[tid] = model
        rep = _reports_frame(spark, rows, trial_rows)
        if rung == max_t:
            break
        past = rung
        alive = sorted(r["trial_id"] for r in H.survivors(rep, rung, metric, mode, reduction).collect())
    reports_df = _reports_frame(spark, rows, trial_rows)
    best = H.require_reports(H.best_trial(reports_df, metric, mode), metric)
    if best_model_path:
        top = best.first()
        model = models.get(top["trial_id"])
        if model is None or len(model.trees) != top["iteration"]:
            p = trial_rows[top["trial_id"]]
            model = newton_reports(top["trial_id"], 0, top["iteration"])[1] if _is_regularised(p) else fitted(p, top["iteration"], None)
        MD.PipelineModel(stages=[pre, asm, model]).write().overwrite().save(best_model_path)
    for held in data.values():
        held.unpersist()
    return reports_df, H.best_summary(best)
