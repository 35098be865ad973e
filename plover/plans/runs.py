"""``runs`` and ``model_versions`` tables derived from the driver data.

One candidate run per ``events.event_type`` segment, scored on that segment
(label ``value > 40``, tied score), plus one majority-class baseline run over
all events. Metrics come from the metric operators, so the registry queries
grow with the data.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators.ranking import running_totals
from .tables import table


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    score = F.least(F.floor(F.col("value") / 8.0) + (F.col("event_id") * 7) % 5, F.lit(20)) / 20.0
    return e.select(
        "event_id", "event_type", "ts",
        F.when(F.col("value") > 40, 1).otherwise(0).alias("y"),
        score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("pred"),
        (F.col("value") / 500.0 + (F.col("event_id") % 13) / 1000.0).alias("fine_score"))


KIND_BY_SEGMENT = {"click": "xgboost", "view": "xgboost", "purchase": "hist_gradient_boosting",
                   "signup": "random_forest", "error": "logistic_regression"}


def _metrics_map(rows: str = "rows") -> F.Column:
    secs = F.col(rows) / 1000.0
    return F.create_map(
        F.lit("accuracy"), F.col("accuracy"), F.lit("precision"), F.col("precision"),
        F.lit("recall"), F.col("recall"), F.lit("f1"), F.col("f1"),
        F.lit("roc_auc"), F.col("roc_auc"), F.lit("average_precision"), F.col("average_precision"),
        F.lit("train_rows"), F.col(rows).cast("double"), F.lit("val_rows"), F.col(rows).cast("double"),
        F.lit("train_seconds"), secs,
        F.lit("rows_per_second"), F.col(rows) / F.greatest(secs, F.lit(1e-9)))


def derived_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_events(spark, sf_dir)
    seg = M.binary_metrics(s, "y", "pred", "score", ["event_type"]) \
        .join(s.groupBy("event_type").agg(F.max("ts").cast("timestamp").alias("start_time")), "event_type")
    kind = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in KIND_BY_SEGMENT.items()],
                      F.lit("xgboost"))
    seg_runs = seg.select(
        F.concat(F.lit("run-"), F.col("event_type")).alias("run_id"),
        F.lit("will-visit").alias("experiment"),
        "start_time",
        F.create_map(F.lit("candidate_name"), F.col("event_type"), F.lit("candidate_kind"), kind,
                     F.lit("code_version"), F.concat(F.lit("v"), F.length("event_type").cast("string")))
        .alias("tags"),
        F.create_map(F.lit("candidate.kind"), kind,
                     F.lit("candidate.params.max_depth"), (F.col("rows") % 7 + 2).cast("string"),
                     F.lit("candidate.params.learning_rate"), F.lit("0.1"),
                     F.lit("candidate.notes"), F.concat(F.lit("segment "), F.col("event_type")))
        .alias("params"),
        _metrics_map().alias("metrics"))
    # Majority-class baseline over all events (constant prediction and
    # score): every metric follows from one class-count aggregate.
    bm = M.majority_baseline_metrics(s, "y", carry_min=["ts"]) \
        .withColumn("start_time", F.col("ts").cast("timestamp"))
    base_run = bm.select(
        F.lit("run-baseline").alias("run_id"), F.lit("will-visit").alias("experiment"), "start_time",
        F.create_map(F.lit("candidate_name"), F.lit("baseline"), F.lit("candidate_kind"), F.lit("dummy"),
                     F.lit("code_version"), F.lit("v0")).alias("tags"),
        F.create_map(F.lit("candidate.kind"), F.lit("dummy"),
                     F.lit("candidate.params.strategy"), F.lit("most_frequent"),
                     F.lit("candidate.notes"), F.lit("majority class")).alias("params"),
        _metrics_map().alias("metrics"))
    # A registry-scale table (one row per segment) referenced many times by
    # the gate queries: cut its lineage once (reliable checkpoint).
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    runs = seg_runs.unionByName(base_run).checkpoint(eager=True)
    return runs


def derived_model_versions(runs: DataFrame, model_name: str = "WillVisit") -> DataFrame:
    """Every non-baseline run registered once, in start-time order; the oldest
    is in Production, the rest Archived."""
    cand = runs.filter(F.col("tags")["candidate_kind"] != "dummy")
    ranked = running_totals(cand.select("run_id", "start_time"), ["start_time", "run_id"])
    v = ranked.select("run_id", (F.col("_rk_pos") + 1).cast("int").alias("version"))
    return v.select(F.lit(model_name).alias("name"), "version",
                    F.when(F.col("version") == 1, "Production").otherwise("Archived").alias("stage"),
                    "run_id", F.create_map().cast("map<string,string>").alias("tags"))
