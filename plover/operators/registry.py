"""Run-registry queries: threshold gates, baseline and production lookups,
best passing run, regression check, version registration, tags and the
leaderboard. Inputs are the ``runs`` and ``model_versions`` tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (BASELINE_F1_MARGIN, LEADERBOARD_COST_KEYS, LEADERBOARD_PARAM_KEYS,
                      LEADERBOARD_QUALITY_KEYS, PRODUCTION_REGRESSION_MARGIN, REGISTRY_GATES)
from ..functions.exprs import fmt_fixed
from .gates import attach_one_row, missing
from .ranking import running_totals


def metric_or_zero(name: str) -> Column:
    return F.coalesce(F.col("metrics")[name], F.lit(0.0))


def baseline_f1(runs: DataFrame) -> DataFrame:
    """One row: F1 of the newest run of kind ``dummy`` (NULL when absent)."""
    dummy = runs.filter(F.col("tags")["candidate_kind"] == "dummy")
    return dummy.agg(F.max_by(F.col("metrics")["f1"], F.struct("start_time", "run_id")).alias("baseline_f1"))


def production_f1(model_versions: DataFrame, runs: DataFrame, model_name: str) -> DataFrame:
    """One row: F1 of the run behind the newest Production version."""
    prod = model_versions.filter((F.col("name") == model_name) & (F.col("stage") == "Production"))
    latest = prod.agg(F.max_by("run_id", "version").alias("run_id")).filter(F.col("run_id").isNotNull())
    return latest.join(runs.select("run_id", F.col("metrics")["f1"].alias("production_f1")),
                       "run_id", "left").select("production_f1")


def threshold_gates(runs: DataFrame, base_f1: DataFrame) -> DataFrame:
    """Per run: one boolean per threshold gate, ``beats_baseline`` and
    ``all_passed``. A missing metric counts as 0.0; NaN never passes."""
    df = attach_one_row(runs, base_f1)
    cols = []
    for gate, metric, thr, op in REGISTRY_GATES:
        v = metric_or_zero(metric)
        cmp = v >= F.lit(thr) if op == ">=" else v > F.lit(thr)
        cols.append((~F.isnan(v) & cmp).alias(gate))
    f1 = metric_or_zero("f1")
    beats = F.when(F.col("baseline_f1").isNull(), F.lit(True)) \
        .otherwise(~F.isnan(f1) & (f1 > F.col("baseline_f1") + F.lit(BASELINE_F1_MARGIN)))
    cols.append(beats.alias("beats_baseline"))
    out = df.select("*", *cols)
    names = [g[0] for g in REGISTRY_GATES] + ["beats_baseline"]
    all_passed = F.lit(True)
    for n in names:
        all_passed = all_passed & F.col(n)
    return out.withColumn("all_passed", all_passed)


def recent_candidate_runs(runs: DataFrame, max_runs: int = 10) -> DataFrame:
    """The newest ``max_runs`` runs whose kind is not ``dummy`` (runs without
    the tag are excluded, as SQL ``<>`` does). A top-N report: the limit is
    the feature."""
    return runs.filter(F.col("tags")["candidate_kind"] != "dummy") \
        .orderBy(F.col("start_time").desc(), F.col("run_id").asc()).limit(max_runs)


def gate_tag_updates(evaluated: DataFrame) -> DataFrame:
    """New tags per run: ``quality_gate.passed`` and JSON gate details (same
    layout as a Python ``json.dumps`` of the ordered gate dict)."""
    names = [g[0] for g in REGISTRY_GATES] + ["beats_baseline"]
    parts = []
    for i, n in enumerate(names):
        parts.append(F.lit(("{" if i == 0 else ", ") + f'"{n}": '))
        parts.append(F.when(F.col(n), F.lit("true")).otherwise(F.lit("false")))
    details = F.concat(*parts, F.lit("}"))
    passed = F.when(F.col("all_passed"), F.lit("True")).otherwise(F.lit("False"))
    return evaluated.select(
        "run_id", passed.alias("quality_gate_passed"), details.alias("quality_gate_details"),
        F.map_concat(F.col("tags"), F.create_map(F.lit("quality_gate.passed"), passed,
                                                 F.lit("quality_gate.details"), details)).alias("tags"))


def best_passing_run(evaluated: DataFrame) -> DataFrame:
    """Highest F1 among runs passing every gate; the newer run wins a tie;
    F1 must exceed -1."""
    f1 = metric_or_zero("f1")
    ok = evaluated.filter(F.col("all_passed") & (f1 > F.lit(-1.0)))
    return ok.orderBy(f1.desc(), F.col("start_time").desc(), F.col("run_id").asc()).limit(1) \
        .select("run_id", F.col("tags")["candidate_name"].alias("candidate_name"),
                f1.alias("f1"), metric_or_zero("roc_auc").alias("roc_auc"))


def regression_check(best: DataFrame, prod: DataFrame) -> DataFrame:
    """Register unless ``best_f1 < production_f1 - margin`` (a NaN production score blocks nothing)."""
    df = attach_one_row(best, prod)
    ok = F.col("production_f1").isNull() | F.isnan("production_f1") | \
        (F.col("f1") >= F.col("production_f1") - F.lit(PRODUCTION_REGRESSION_MARGIN))
    return df.withColumn("register", ok)


def next_version(model_versions: DataFrame, decision: DataFrame, model_name: str, claims: str | None = None) -> DataFrame:
    """The row to append for a registered run: version ``max + 1`` (1 for a
    new name), stage Staging, gate tags. With ``claims``, a shared folder, the
    number is claimed there: writers at the same time get different ones."""
    accepted = decision.filter(F.col("register"))
    top = model_versions.filter(F.col("name") == model_name).agg(
        F.coalesce(F.max("version"), F.lit(0)).alias("_v"))
    if claims is not None and not accepted.isEmpty():
        from ..sources.sinks import claim_version
        spark = decision.sparkSession
        top = top.select(F.lit(claim_version(spark, claims, model_name, top.first()["_v"] + 1) - 1).alias("_v"))
    row = attach_one_row(accepted, top)
    return row.select(
        F.lit(model_name).alias("name"), (F.col("_v") + 1).cast("int").alias("version"),
        F.lit("Staging").alias("stage"), "run_id",
        F.create_map(F.lit("quality_gate.passed"), F.lit("True"),
                     F.lit("quality_gate.f1"), F.col("f1").cast("string"),
                     F.lit("source_candidate"), F.col("candidate_name")).alias("tags"))


def run_quality_gate(runs: DataFrame, model_versions: DataFrame, model_name: str,
                     max_runs: int = 10) -> DataFrame:
    """The whole gate job: recent runs -> threshold gates vs the baseline F1 ->
    best passing -> production regression check. One-row decision (empty when
    nothing passes)."""
    evaluated = threshold_gates(recent_candidate_runs(runs, max_runs), baseline_f1(runs))
    best = best_passing_run(evaluated)
    return regression_check(best, production_f1(model_versions, runs, model_name))


# ---------------------------------------------------------------------------
# Leaderboard
# ---------------------------------------------------------------------------
def _joined(parts: list[Column]) -> Column:
    s = F.concat_ws(", ", *parts)
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("-"))


def leaderboard(runs: DataFrame, ui_base_url: str = "", experiment_id: str = "0") -> DataFrame:
    """One formatted row per run, ranked by F1 (missing last)."""
    params, metrics, tags = F.col("params"), F.col("metrics"), F.col("tags")
    p_parts = [F.when(params[k].isNotNull(), F.concat(F.lit(k.split(".")[-1] + "="), params[k]))
               for k in LEADERBOARD_PARAM_KEYS]
    q_parts = [F.when(metrics[k].isNotNull(), F.concat(F.lit(k + "="), fmt_fixed(metrics[k], 4)))
               for k in LEADERBOARD_QUALITY_KEYS]
    c_parts = [F.when(metrics[k].isNotNull(), F.concat(F.lit(k + "="), fmt_fixed(metrics[k], 2)))
               for k in LEADERBOARD_COST_KEYS]
    link = F.lit("-") if not ui_base_url else F.concat(
        F.lit("["), F.substring("run_id", 1, 8), F.lit(f"]({ui_base_url}/#/experiments/{experiment_id}/runs/"),
        F.col("run_id"), F.lit(")"))
    keyed = runs.withColumn("_neg_f1", F.coalesce(-metrics["f1"], F.lit(float("inf"))))
    ranked = running_totals(keyed, ["_neg_f1", "run_id"])
    params, metrics, tags = F.col("params"), F.col("metrics"), F.col("tags")
    return ranked.select(
        (F.col("_rk_pos") + 1).cast("int").alias("rank"),
        F.coalesce(tags["candidate_name"], F.lit("-")).alias("candidate"),
        link.alias("run_link"),
        F.coalesce(tags["code_version"], F.lit("-")).alias("code_version"),
        _joined(p_parts).alias("hyperparams"),
        _joined(q_parts).alias("quality"),
        _joined(c_parts).alias("cost"),
        F.coalesce(params["candidate.notes"], F.lit("")).alias("notes"))


def leaderboard_markdown(board: DataFrame) -> DataFrame:
    """Markdown table lines (header rows first, then ranked rows)."""
    line = F.concat_ws(" | ", "candidate", "run_link", "code_version", "hyperparams", "quality",
                       "cost", "notes")
    return board.select("rank", F.concat(F.lit("| "), line, F.lit(" |")).alias("line"))
