"""Hyper-parameter search: seeded space sampling, synchronous successive
halving, best-trial selection and resume.

Trials are a small driver-side list (the number of samples is a config
value); each trial's work - fitting and scoring - is a distributed Spark job
over the cached training data. Sampling never uses ``rand()``: each value
comes from ``xxhash64(seed, trial, parameter)`` mapped to [0, 1).
"""
from __future__ import annotations

import math
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KNOWN_TYPES = ("choice", "uniform", "loguniform", "randint")
MANTISSA = (1 << 53) - 1


class SearchSpaceError(ValueError):
    pass


def _unit(seed: int, trial: F.Column, name: str) -> F.Column:
    h = F.xxhash64(F.lit(int(seed)), trial, F.lit(name))
    return (h.bitwiseAND(F.lit(MANTISSA))).cast("double") / float(1 << 53)


def _choice_values(name: str, values: list) -> list:
    """The values of a choice, which are all numbers (as doubles), all text or all booleans."""
    if values and (all(isinstance(v, bool) for v in values) or all(isinstance(v, str) for v in values)):
        return list(values)
    if values and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values):
        return [float(v) for v in values]
    raise SearchSpaceError(f"{name}: a choice needs values of one kind: numbers, text or booleans")


def sample_search_space(spark: SparkSession, space: dict, num_samples: int, seed: int = 42) -> DataFrame:
    """``num_samples`` trials: one column per parameter (double; text or boolean
    where a choice is of such values) and the numbers as the map ``params``.
    ``randint`` excludes its upper bound."""
    for name, spec in space.items():
        if spec.get("type") not in KNOWN_TYPES:
            raise SearchSpaceError(f"Unknown search space type: {spec.get('type')}")
    trials = spark.range(int(num_samples)).withColumnRenamed("id", "trial_index")
    t = F.col("trial_index")
    cols = []
    for name, spec in space.items():
        u = _unit(seed, t, name)
        kind = spec["type"]
        if kind == "choice":
            values = _choice_values(name, spec["values"])
            idx = F.least(F.floor(u * len(values)).cast("int"), F.lit(len(values) - 1))
            cols.append(F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1).alias(name))
        elif kind == "uniform":
            lo, hi = float(spec["lower"]), float(spec["upper"])
            cols.append((F.lit(lo) + u * (hi - lo)).alias(name))
        elif kind == "loguniform":
            lo, hi = math.log(float(spec["lower"])), math.log(float(spec["upper"]))
            cols.append(F.exp(F.lit(lo) + u * (hi - lo)).alias(name))
        else:
            lo, hi = int(spec["lower"]), int(spec["upper"])
            cols.append(F.floor(F.lit(lo) + u * (hi - lo)).cast("double").alias(name))
    out = trials.select(F.format_string("trial_%05d", t).alias("trial_id"), *cols)
    numbers = [n for n in space if dict(out.dtypes)[n] == "double"]
    pairs = [c for n in numbers for c in (F.lit(n), F.col(n))]
    return out.withColumn("params", (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,double>"))


def with_typed(trials: DataFrame, space: dict) -> DataFrame:
    """Sampled trials with all parameters, of their types, as the VARIANT object ``typed``."""
    return trials.withColumn("typed", F.to_variant_object(F.struct(*space)) if space else F.parse_json(F.lit("{}")))


def rung_schedule(grace: int, max_t: int, reduction: int) -> list[int]:
    rungs, r = [], int(grace)
    while r < max_t:
        rungs.append(r)
        r *= int(reduction)
    rungs.append(int(max_t))
    return rungs


def survivors(reports: DataFrame, iteration: int, metric: str, mode: str = "max",
              reduction: int = 2) -> DataFrame:
    """Trials kept after a rung: the best ``max(1, floor(n / reduction))`` by
    the metric (ties by trial id). Each rung holds one row per trial."""
    at = reports.filter(F.col("iteration") == iteration) \
        .withColumn("_m", F.col("metrics")[metric])
    order = F.col("_m").desc_nulls_last() if mode == "max" else F.col("_m").asc_nulls_last()
    w = Window.partitionBy("iteration").orderBy(order, F.col("trial_id"))
    n = Window.partitionBy("iteration")
    ranked = at.withColumn("_r", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(n))
    keep = F.greatest(F.lit(1), F.floor(F.col("_n") / F.lit(int(reduction))))
    return ranked.filter(F.col("_r") <= keep).select("trial_id")


def _carried(reports: DataFrame) -> list[str]:
    """Columns of a report besides its trial; those with typed parameters keep them."""
    return ["iteration", "params", "metrics", *(["typed"] if "typed" in reports.columns else [])]


def best_trial(reports: DataFrame, metric: str, mode: str = "max") -> DataFrame:
    """Best trial by the metric of its last report (ties: the smallest trial id)."""
    carried = _carried(reports)
    last = reports.groupBy("trial_id").agg(F.max_by(F.struct(*carried), "iteration").alias("r"))
    last = last.select("trial_id", "r.*")
    m = F.col("metrics")[metric]
    valid = last.filter(m.isNotNull() & ~F.isnan(m))
    key = -m if mode == "max" else m
    best = valid.agg(F.min_by(F.struct("trial_id", *carried), F.struct(key, "trial_id")).alias("b"))
    best = best.filter(F.col("b").isNotNull()).select("b.*")
    return best


def require_reports(best: DataFrame, metric: str) -> DataFrame:
    if best.isEmpty():
        raise SearchSpaceError(f"No successful trial reported metric '{metric}'")
    return best


def pending_trials(trials: DataFrame, reports: DataFrame, iteration: int) -> DataFrame:
    """Trials with no report at ``iteration`` yet (resume after a failure)."""
    done = reports.filter(F.col("iteration") == iteration).select("trial_id")
    return trials.join(done, "trial_id", "left_anti")


def best_summary(best: DataFrame) -> DataFrame:
    """One row: trial id, iteration, params and only finite numeric metrics."""
    finite = F.map_filter("metrics", lambda k, v: v.isNotNull() & ~F.isnan(v)).alias("metrics")
    return best.select("trial_id", *[finite if c == "metrics" else c for c in _carried(best)])


def top_checkpoints(reports: DataFrame, k: int = 2, metric: str = "validation_logloss",
                    mode: str = "min") -> DataFrame:
    """The ``k`` best reported checkpoints by a metric (a top-k report: the
    limit is the feature)."""
    m = F.col("metrics")[metric]
    order = m.asc_nulls_last() if mode == "min" else m.desc_nulls_last()
    return reports.filter(m.isNotNull() & ~F.isnan(m)) \
        .orderBy(order, F.col("trial_id"), F.col("iteration")).limit(int(k))
