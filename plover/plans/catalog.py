"""Registered queries: (spark, sf_dir) -> DataFrame, each over whole tables."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEARCH_AT_ONCE, CandidateSpec, default_candidates, default_dataset_spec, default_gate_spec
from ..functions.lists import expand_list, parse_list
from ..operators import gates as G
from ..operators import metrics as M
from ..operators import registry as R
from ..operators import schema as S
from ..operators import splits as SP
from ..operators.features import assemble_bundle, prepare_frame
from ..operators.preprocess import ImputeScaler
from ..session import apply_runtime_defaults
from ..sources import readers as RD
from ..sources import sinks as SK
from . import oracle_sql as O
from .runs import derived_model_versions, derived_runs, scored_events
from .tables import lake, table

Query = Callable[[SparkSession, str], DataFrame]


def q_prepare_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_defaults(spark)
    return prepare_frame(lake(spark, sf_dir), default_dataset_spec(), key_columns=["row_id"])


def q_split_by_flag(spark, sf_dir):
    apply_runtime_defaults(spark)
    return SP.tag_by_flag(lake(spark, sf_dir), default_dataset_spec()).select("row_id", "split", "will_visit")


def q_latest_run_delta(spark, sf_dir):
    apply_runtime_defaults(spark)
    fs = SP.split_by_flag(lake(spark, sf_dir), default_dataset_spec())
    return SP.scope_train(fs.train, "latest_run_only").select("row_id", "pipeline_run_date")


def _events_ms(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("time"))


def q_time_split_2way(spark, sf_dir):
    apply_runtime_defaults(spark)
    return SP.time_split(_events_ms(spark, sf_dir), "2024-01-22", 0.0, key_cols=["event_id"]) \
        .select("event_id", "time", "split")


def q_time_split_3way(spark, sf_dir):
    apply_runtime_defaults(spark)
    return SP.time_split(_events_ms(spark, sf_dir), "2024-01-22", 0.1, key_cols=["event_id"]) \
        .select("event_id", "time", "split")


def q_stratified_split_counts(spark, sf_dir):
    apply_runtime_defaults(spark)
    tagged = SP.percent_split(lake(spark, sf_dir), 0.7, 0.15, "will_visit", ["row_id"], seed=42)
    return SP.split_report(tagged, "will_visit")


def q_strata_split_counts(spark, sf_dir):
    """Percent split of the orders with every customer as a stratum: rows per customer and split."""
    apply_runtime_defaults(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tagged = SP.percent_split(orders, 0.7, 0.15, "o_custkey", ["o_orderkey"], seed=42)
    return tagged.groupBy("o_custkey", "split").agg(F.count(F.lit(1)).alias("rows"))


def q_stratified_downsample_counts(spark, sf_dir):
    apply_runtime_defaults(spark)
    kept = SP.stratified_downsample(table(spark, sf_dir, "labels"), "quality", 150, ["doc_id"], seed=42)
    return kept.filter(F.col("quality").isNotNull()).groupBy("quality") \
        .agg(F.count(F.lit(1)).alias("rows"))


def q_sequential_split(spark, sf_dir):
    apply_runtime_defaults(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return SP.sequential_split(o, 0.7, 0.15, ["o_orderkey"])


CAPS = {"train": 3000, "val": 400}


def q_capped_time_splits(spark, sf_dir):
    apply_runtime_defaults(spark)
    base = lake(spark, sf_dir).select("row_id", "time", "will_visit")
    tagged = SP.time_split(base, "2024-01-22", 0.1, key_cols=["row_id"])
    capped = SP.stratified_downsample(tagged, "will_visit", 0, ["row_id"], seed=42, by="split", caps=CAPS)
    return SP.split_report(capped, "will_visit")


def rounded(df: DataFrame, decimals: int = 10) -> DataFrame:
    """Round double columns so engines that sum in different orders agree."""
    return df.select(*[F.round(F.col(f.name), decimals).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def q_binary_metrics(spark, sf_dir):
    apply_runtime_defaults(spark)
    return rounded(M.binary_metrics(scored_events(spark, sf_dir), "y", "pred", "score", ["event_type"]))


def q_roc_auc(spark, sf_dir):
    apply_runtime_defaults(spark)
    return rounded(M.ranking_metrics(scored_events(spark, sf_dir), "y", "fine_score").select("roc_auc"))


def q_average_precision(spark, sf_dir):
    apply_runtime_defaults(spark)
    return rounded(M.ranking_metrics(scored_events(spark, sf_dir), "y", "fine_score")
                   .select("average_precision"))


def q_logloss(spark, sf_dir):
    apply_runtime_defaults(spark)
    return rounded(M.logloss(scored_events(spark, sf_dir), "y", "score", ["event_type"]))


def q_majority_baseline(spark, sf_dir):
    apply_runtime_defaults(spark)
    return M.majority_class(table(spark, sf_dir, "labels"), "quality")


def q_label_cardinality(spark, sf_dir):
    apply_runtime_defaults(spark)
    return M.label_cardinality(table(spark, sf_dir, "labels"), "quality")


def q_reference_stats(spark, sf_dir):
    apply_runtime_defaults(spark)
    li = table(spark, sf_dir, "lineitem")
    st = M.reference_stats(li, O.REF_FEATURES, with_sample=False)
    return st.select("feature", "count", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"),
                     "min", "max")


def impute_source(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")).alias("v_value"),
        F.when(F.col("event_id") % 5 == 0, F.lit(float("nan")))
         .otherwise(F.col("user_id").cast("double")).alias("v_user"),
        F.lit(3.0).alias("v_const"),
        F.lit(None).cast("double").alias("v_empty"))


def q_impute_scale(spark, sf_dir):
    apply_runtime_defaults(spark)
    src = impute_source(spark, sf_dir)
    model = ImputeScaler(inputCols=O.IMPUTE_FEATURES).fit(src)
    out = model.transform(src)
    return out.select("event_id", *[F.round(c, 8).alias(c) for c in O.IMPUTE_FEATURES])


MODEL_NAME = "WillVisit"


def q_quality_gates(spark, sf_dir):
    apply_runtime_defaults(spark)
    d = G.gate_decisions(derived_runs(spark, sf_dir), default_gate_spec())
    return d.select(F.col("tags")["candidate_name"].alias("candidate_name"), "exempt", "passed", "gate_tag",
                    "registered", F.size("failures").cast("long").alias("n_failures"),
                    F.concat_ws("; ", "failures").alias("failures_text"))


def q_beat_baseline(spark, sf_dir):
    apply_runtime_defaults(spark)
    d = G.gate_decisions(derived_runs(spark, sf_dir), default_gate_spec())
    bc = F.col("baseline_comparison")
    return d.filter(bc.isNotNull()).select(
        F.col("tags")["candidate_name"].alias("candidate_name"), bc["metric"].alias("metric"),
        F.round(bc["candidate"], 10).alias("candidate"), F.round(bc["baseline"], 10).alias("baseline"),
        F.round(bc["delta"], 10).alias("delta"), bc["min_delta"].alias("min_delta"),
        (bc["delta"] >= bc["min_delta"]).alias("meets_min_delta"))


def _registry_evaluated(spark, sf_dir):
    runs = derived_runs(spark, sf_dir)
    return runs, R.threshold_gates(R.recent_candidate_runs(runs, 10), R.baseline_f1(runs))


def q_registry_gates(spark, sf_dir):
    apply_runtime_defaults(spark)
    _, ev = _registry_evaluated(spark, sf_dir)
    return ev.select("run_id", "f1_minimum", "auc_minimum", "precision_minimum", "recall_minimum",
                     "beats_baseline", "all_passed")


def q_gate_tags(spark, sf_dir):
    apply_runtime_defaults(spark)
    _, ev = _registry_evaluated(spark, sf_dir)
    return R.gate_tag_updates(ev).select("run_id", "quality_gate_passed", "quality_gate_details")


def q_quality_gate_best(spark, sf_dir):
    apply_runtime_defaults(spark)
    _, ev = _registry_evaluated(spark, sf_dir)
    return rounded(R.best_passing_run(ev))


def _gate_decision(spark, sf_dir):
    runs = derived_runs(spark, sf_dir)
    mv = derived_model_versions(runs, MODEL_NAME)
    return runs, mv, R.run_quality_gate(runs, mv, MODEL_NAME, 10)


def q_production_regression(spark, sf_dir):
    apply_runtime_defaults(spark)
    _, _, dec = _gate_decision(spark, sf_dir)
    return rounded(dec.select("run_id", "f1", "production_f1", "register"))


def q_registry_append(spark, sf_dir):
    apply_runtime_defaults(spark)
    _, mv, dec = _gate_decision(spark, sf_dir)
    row = R.next_version(mv, dec, MODEL_NAME)
    return row.select("name", "version", "stage", "run_id",
                      F.col("tags")["source_candidate"].alias("source_candidate"))


def q_leaderboard(spark, sf_dir):
    apply_runtime_defaults(spark)
    return R.leaderboard(derived_runs(spark, sf_dir))


def q_retrain_decision(spark, sf_dir):
    apply_runtime_defaults(spark)
    s = scored_events(spark, sf_dir)
    old = M.ranking_metrics(s, "y", "score", ["event_type"]).select("event_type", F.col("roc_auc").alias("o"))
    new = M.ranking_metrics(s, "y", "fine_score", ["event_type"]).select("event_type", F.col("roc_auc").alias("n"))
    j = old.join(new, "event_type")
    delta = F.col("n") - F.col("o")
    return j.select("event_type", F.lit("roc_auc").alias("primary_metric"),
                    F.round("o", 10).alias("old_score"), F.round("n", 10).alias("new_score"),
                    F.round(delta, 10).alias("delta"), F.lit(0.0).alias("threshold"),
                    G.retrain_decision(F.col("o"), F.col("n"), 0.0).alias("decision"))


def q_parse_list_edge_cases(spark, sf_dir):
    apply_runtime_defaults(spark)
    lk = lake(spark, sf_dir)
    staged = lk.select("row_id", parse_list("location_vibe_tags").alias("a"))
    return staged.select("row_id", *expand_list("a", 3, "vt"))


def _embedding_expand(length):
    def run(spark, sf_dir):
        apply_runtime_defaults(spark)
        e = table(spark, sf_dir, "embeddings")
        staged = e.select("vec_id", "label", parse_list("embedding", e.schema["embedding"].dataType).alias("a"))
        return staged.select("vec_id", "label", *expand_list("a", length, "emb"))
    return run


def q_interaction_lexicographic(spark, sf_dir):
    prepared = q_prepare_frame(spark, sf_dir)
    return prepared.select("row_id", *[c for c in prepared.columns if c.startswith("pref_x_vibe_")])


def q_align_features(spark, sf_dir):
    """Bundle assembly: eval aligned to train features (here train keeps a
    subset; eval lacks one of them and has an extra column)."""
    apply_runtime_defaults(spark)
    spec = default_dataset_spec()
    fs = SP.split_by_flag(lake(spark, sf_dir), spec)
    keep = ["avg_rating", "location_popularity", "user_total_visits", "cat_enc_0", "cat_enc_1",
            "cat_enc_2", "cat_enc_3", "vibe_0"]
    train = prepare_frame(fs.train, spec, ["row_id"]).select("row_id", *keep, "will_visit")
    val = prepare_frame(fs.eval, spec, ["row_id"]).drop("cat_enc_3")
    features = S.feature_columns_of(train, "will_visit", exclude=["row_id"])
    return S.align_features(val, features, keep=["row_id", "will_visit"])


def q_old_new_union(spark, sf_dir):
    """Retrain input: OLD and NEW parts aligned to the same columns, unioned by name."""
    apply_runtime_defaults(spark)
    o = table(spark, sf_dir, "orders")
    base = o.select("o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").cast("int").alias("label"),
                    "o_orderdate")
    cut = F.lit("1995-01-01").cast("timestamp_ntz")
    old = base.filter(F.col("o_orderdate") < cut).drop("o_orderdate").withColumn("part", F.lit("old"))
    new = base.filter(F.col("o_orderdate") >= cut).drop("o_orderdate").withColumn("part", F.lit("new"))
    new = S.align_features(new, ["o_orderkey", "o_totalprice", "label", "part"])
    return old.unionByName(new)


ORDERS_CSV_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                     "o_orderpriority string")


def q_csv_roundtrip(spark, sf_dir):
    apply_runtime_defaults(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderpriority")
    path = SK.write_csv(o, SK.scratch_path(spark, "orders-csv"))
    return RD.read_csv(spark, path, ORDERS_CSV_SCHEMA)


def q_split_write_roundtrip(spark, sf_dir):
    apply_runtime_defaults(spark)
    tagged = q_sequential_split(spark, sf_dir)
    path = SK.write_splits(tagged, SK.scratch_path(spark, "orders-splits"))
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def q_shuffled_write(spark, sf_dir):
    """Orders written in a seeded shuffle; every row's position when the files are read in order."""
    apply_runtime_defaults(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rank = F.md5(F.concat(F.lit("42:"), F.col("o_orderkey").cast("string")))
    path = SK.write_shuffled(o, SK.scratch_path(spark, "orders-shuffled"), ["o_orderkey"], rank=rank)
    return SK.read_shuffled(spark, path)


def q_latest_file(spark, sf_dir):
    """Three writes of ``orders`` (by status) into one prefix; the newest
    drop under it (recursive listing) is read back."""
    apply_runtime_defaults(spark)
    o = table(spark, sf_dir, "orders")
    base = SK.scratch_path(spark, "orders-drops")
    for status in ("F", "O", "P"):
        o.filter(F.col("o_orderstatus") == status).write.mode("overwrite").parquet(f"{base}/drop_{status}")
    # The newest write (all of its part-files), not one arbitrary part-file.
    return RD.read_latest_drop(spark, base, recursive=True)


def q_leaderboard_markdown(spark, sf_dir):
    apply_runtime_defaults(spark)
    return R.leaderboard_markdown(R.leaderboard(derived_runs(spark, sf_dir)))


def q_catalog_fallback(spark, sf_dir):
    """Orders through the fallback chain: from a catalog table that exists, and
    from the greatest write under a prefix where the named table does not."""
    apply_runtime_defaults(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    name = f"plover_orders_{uuid.uuid4().hex[:12]}"
    o.filter("o_orderstatus <> 'P'").write.option("path", SK.scratch_path(spark, "orders-table")).saveAsTable(name)
    prefix = SK.scratch_path(spark, "orders-lake")
    for run, rows in (("run_a", o.filter("o_orderstatus = 'F'")), ("run_b", o.filter("o_orderstatus = 'P'"))):
        rows.write.parquet(f"{prefix}/{run}")
    found = RD.load_with_fallback(spark, name, prefix).withColumn("via", F.lit("table"))
    return found.unionByName(RD.load_with_fallback(spark, f"{name}_missing", prefix).withColumn("via", F.lit("prefix")))


def q_source_builders(spark, sf_dir):
    """Training bundles of the same lake rows through both kinds of source, a
    train and validation CSV pair and the newest Parquet write of a folder:
    rows, positives and sums of features per source and part."""
    apply_runtime_defaults(spark)
    spec = default_dataset_spec()
    rows = lake(spark, sf_dir)
    folder = SK.scratch_path(spark, "source")
    fs = SP.split_by_flag(rows, spec)
    csv = RD.choose_source(train_csv=SK.write_csv(fs.train, f"{folder}/train-csv"), val_csv=SK.write_csv(fs.eval, f"{folder}/val-csv"))
    fs.eval.withColumn(spec.split_column, F.lit(spec.split_eval_value)).write.parquet(f"{folder}/lake")  # an older write
    rows.write.mode("append").parquet(f"{folder}/lake")
    drop = RD.choose_source(parquet=f"{folder}/lake")
    bundles = {csv.kind: RD.bundle_from_csv(spark, csv.train_csv, csv.val_csv, spec, fs.train.schema, ("row_id",)),
               drop.kind: RD.bundle_from_parquet(spark, drop.parquet, spec, ("row_id",))}
    sums = [F.sum(F.col(spec.column_rename.get(c, c)).cast("double")).alias(c) for c in NEWTON_FEATURES]
    out = [df.agg(F.lit(kind).alias("source"), F.lit(part).alias("part"), F.count(F.lit(1)).alias("rows"), F.sum(b.target).cast("long").alias("positives"),
                  F.lit(len(b.feature_columns)).alias("features"), *sums)
           for kind, b in bundles.items() for part, df in (("train", b.train), ("validation", b.val))]
    return rounded(reduce(DataFrame.unionByName, out))


def q_run_log(spark, sf_dir):
    """Run records of the event segments appended to a run table in two writes and read back."""
    apply_runtime_defaults(spark)
    runs = derived_runs(spark, sf_dir)
    path = SK.scratch_path(spark, "runs")
    dummy = F.col("tags")["candidate_kind"] == "dummy"
    for part in (runs.filter(dummy), runs.filter(~dummy)):
        SK.append_runs(part, path)
    t, m = F.col("tags"), F.col("metrics")
    return spark.read.parquet(path).select("run_id", t["candidate_name"].alias("candidate_name"), t["candidate_kind"].alias("candidate_kind"),
                                           F.round(m["f1"], 10).alias("f1"), F.round(m["roc_auc"], 10).alias("roc_auc"))


def q_full_refit(spark, sf_dir):
    """A model without rounds to continue is fitted anew on old and new rows:
    majority class of the older runs against that of all runs, kept at one
    threshold and rejected at another. What the run table, the decision
    records and the saved models (current, backup, rejected) hold."""
    apply_runtime_defaults(spark)
    from ..operators import models as MD
    from .training import retrain
    spec = default_dataset_spec()
    fs = SP.split_by_flag(lake(spark, sf_dir), spec)
    last = F.lit(SP.run_date_of(fs.train))
    d = F.col("pipeline_run_date")
    needed = [*NEWTON_FEATURES, "will_visit"]
    older, latest, val = (df.select(*needed) for df in (fs.train.filter(d.isNull() | (d != last)), fs.train.filter(d == last), fs.eval))
    cand = CandidateSpec("baseline", "dummy", {"strategy": "most_frequent"})
    old, _ = MD.fit_pipeline(MD.build_estimator(cand.kind, cand.params, "will_visit"), NEWTON_FEATURES, older, "will_visit")
    out = []
    for threshold in (0.0, 0.001):
        base = SK.scratch_path(spark, "refit")
        retrain(spark, old, cand, latest, val, "will_visit", threshold=threshold, old_rows=older, artifact_dir=base, runs_path=f"{base}/_runs")
        summary = F.from_json("summary", "decision string, saved string, backup string")
        kept = spark.read.json(f"{base}/_decisions").select(summary.alias("s")).select("s.*").first()
        majority = {k: MD.PipelineModel.load(kept[k]).stages[-1] if kept[k] else None for k in ("saved", "backup")}
        run, m = spark.read.parquet(f"{base}/_runs"), F.col("metrics")
        out.append(run.select(
            F.lit(threshold).alias("threshold"), F.col("tags")["decision"].alias("decision"), F.round(m["old.accuracy"], 10).alias("old_accuracy"),
            F.round(m["new.accuracy"], 10).alias("new_accuracy"), m["new_rows"].alias("new_rows"), m["val_rows"].alias("val_rows"),
            F.lit(kept["decision"]).alias("recorded"), F.lit("_rejected/" in kept["saved"]).alias("set_aside"),
            *[F.lit(v.getOrDefault("majority") if v is not None else None).cast("double").alias(f"{k}_majority") for k, v in majority.items()]))
    return reduce(DataFrame.unionByName, out)


MODEL_CANDIDATES = [
    CandidateSpec("baseline", "dummy", {"strategy": "most_frequent"}, "majority class"),
    CandidateSpec("boosted_small", "xgboost", {"learning_rate": 0.3, "max_depth": 4, "n_estimators": 10,
                                                "random_state": 42}, "small boosted trees"),
    CandidateSpec("logistic", "logistic_regression", {"C": 1.0, "max_iter": 50}, "linear baseline"),
]


def _lake_bundle(spark, sf_dir, keys=("row_id",)):
    spec = default_dataset_spec()
    fs = SP.split_by_flag(lake(spark, sf_dir), spec)
    return assemble_bundle(fs.train, fs.eval, spec, list(keys)), fs


def q_train_candidates(spark, sf_dir):
    """Fit, score and gate the configured candidates on the lake split; one
    run row each. The baseline's metrics follow from class counts, those of a
    fitted model are compared with them."""
    apply_runtime_defaults(spark)
    from .training import train_candidates
    bundle, _ = _lake_bundle(spark, sf_dir)
    res = train_candidates(spark, bundle, default_candidates(), with_reference_stats=False, at_once=4)
    m, tag = F.col("metrics"), F.col("tags")
    dummy = tag["candidate_kind"] == "dummy"
    return res.decisions.select(tag["candidate_name"].alias("candidate_name"), tag["status"].alias("status"), "gate_tag",
                                m["train_rows"].alias("train_rows"), m["val_rows"].alias("val_rows"),
                                F.when(dummy, F.round(m["accuracy"], 10)).alias("baseline_accuracy"),
                                F.when(dummy, F.round(m["f1"], 10)).alias("baseline_f1"),
                                (m["roc_auc"] > 0.5).alias("auc_above_baseline"))


NEWTON_FEATURES = ["location_popularity", "user_total_visits", "location_avg_rating"]


def q_newton_tree(spark, sf_dir):
    """One regularised second-order tree of depth 2 on the train rows: every node with its split, gain and leaf weight."""
    apply_runtime_defaults(spark)
    from ..operators import newton as N
    train = lake(spark, sf_dir).filter(F.col("split") == "train")
    rows = train.select(F.array(*[F.col(c).cast("double") for c in NEWTON_FEATURES]).alias("x"), F.col("will_visit").cast("double").alias("y"), F.lit(0.0).alias("margin"))
    s = N.Settings(rounds=1, max_depth=2, max_bins=255, reg_lambda=1.5, reg_alpha=2.0, min_child_weight=2.0)
    trees, edges = N.fit_trees(rows, s)
    t, path = trees[0], {0: "root"}
    for k in range(len(t.feature)):
        if t.feature[k] >= 0:
            path[t.left[k]], path[t.right[k]] = f"{path[k]}.L", f"{path[k]}.R"
    out = [(path[k], NEWTON_FEATURES[f] if f >= 0 else None, float(edges[f][t.bin[k]]) if f >= 0 else None,
            round(t.gain[k], 6) if f >= 0 else None, round(t.value[k], 8)) for k, f in enumerate(t.feature)]
    return spark.createDataFrame(out, "node string, feature string, threshold double, gain double, weight double")


def q_newton_scores(spark, sf_dir):
    """Output contract of the tree of ``newton_tree`` over every eval row, with
    the learned probability; a missing feature goes left, as in the fit."""
    apply_runtime_defaults(spark)
    from pyspark.ml.feature import VectorAssembler
    from ..operators import models as MD
    from ..operators import newton as N
    rows = lake(spark, sf_dir)
    train = rows.filter(F.col("split") == "train").select(
        F.array(*[F.col(c).cast("double") for c in NEWTON_FEATURES]).alias("x"), F.col("will_visit").cast("double").alias("y"), F.lit(0.0).alias("margin"))
    trees, edges = N.fit_trees(train, N.Settings(rounds=1, max_depth=2, max_bins=255, reg_lambda=1.5, reg_alpha=2.0, min_child_weight=2.0))
    filled = rows.filter(F.col("split") == "eval").select(
        "row_id", "user_id", F.col("location_id").alias("gmap_id"), *[F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))).alias(f"_x{k}") for k, c in enumerate(NEWTON_FEATURES)])
    vectors = VectorAssembler(inputCols=[f"_x{k}" for k in range(len(NEWTON_FEATURES))], outputCol=MD.FEATURES, handleInvalid="keep").transform(filled)
    scored = MD.score(N.as_model(trees, edges, "newton_scores").setFeaturesCol(MD.FEATURES), vectors)
    out = MD.scoring_output(scored, "WillVisit", "1", ("row_id", "user_id", "gmap_id"))
    return out.withColumn("will_visit_probability", F.round("will_visit_probability", 8))


def q_batch_score(spark, sf_dir):
    """Score every eval row with a fitted boosted model (output contract): ids,
    model, and whether the probability lies in [0, 1] and decides the label."""
    apply_runtime_defaults(spark)
    from ..operators import models as MD
    # Ids ride along as key columns (never features), so scores need no join back.
    keys = ("row_id", "user_id", "gmap_id")
    bundle, _ = _lake_bundle(spark, sf_dir, keys)
    plan = MD.build_estimator("xgboost", {"learning_rate": 0.3, "max_depth": 4, "n_estimators": 10},
                              "will_visit")
    model, _ = MD.fit_pipeline(plan, bundle.feature_columns, bundle.train, "will_visit")
    out = MD.scoring_output(MD.score(model, bundle.val), "WillVisit", "1", keys)
    p = F.col("will_visit_probability")
    return out.select(*keys, "model_name", "model_version", p.between(0.0, 1.0).alias("probability_in_range"),
                      (F.col("recommend") == (p > 0.5).cast("int")).alias("recommend_follows"))


def q_continue_boosting(spark, sf_dir):
    """Old model on the older train runs; continue 5 rounds on the latest
    run-date delta with the frozen preprocessor; keep/reject on eval AUC. The
    run record of the retrain: rows, trees, and whether the decision follows
    from the difference."""
    apply_runtime_defaults(spark)
    from .training import retrain
    from ..operators import models as MD
    spec = default_dataset_spec()
    fs = SP.split_by_flag(lake(spark, sf_dir), spec)
    # The latest run date once (one aggregate row); the older runs are its
    # complement as a map-only filter (NULL dates are in no run), not an
    # anti-join that shuffles the train rows.
    last = SP.run_date_of(fs.train)
    d = F.col("pipeline_run_date")
    latest = fs.train.filter(d == F.lit(last))
    older = fs.train.filter(d.isNull() | (d != F.lit(last)))
    old_b = assemble_bundle(older, fs.eval, spec, ["row_id"])
    plan = MD.build_estimator("xgboost", {"learning_rate": 0.3, "max_depth": 4, "n_estimators": 10},
                              "will_visit")
    old_model, _ = MD.fit_pipeline(plan, old_b.feature_columns, old_b.train, "will_visit")
    new_rows = prepare_frame(latest, spec, ["row_id"])
    cand = CandidateSpec("boosted_small", "xgboost", {})
    res = retrain(spark, old_model, cand, new_rows, old_b.val, "will_visit", additional_rounds=5)
    m, limit = F.col("metrics"), F.col("params")["retrain.improvement_threshold"].cast("double")
    kept = m["new.roc_auc"] - m["old.roc_auc"] >= limit
    return res.run.select(
        F.col("params")["retrain.primary_metric"].alias("primary_metric"), limit.alias("threshold"),
        m["new_rows"].alias("new_rows"), m["val_rows"].alias("val_rows"),
        m["old.trees"].alias("old_trees"), m["new.trees"].alias("new_trees"),
        (F.least(m["old.roc_auc"], m["new.roc_auc"]) > 0.5).alias("auc_above_baseline"),
        (F.col("tags")["decision"] == F.when(kept, "keep").otherwise("reject")).alias("decision_follows"))


def q_lineitem_ranking(spark, sf_dir):
    """ROC-AUC and AP over every lineitem row (label: returned; tied score)."""
    apply_runtime_defaults(spark)
    li = table(spark, sf_dir, "lineitem")
    scored = li.select(F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
                       (F.floor(F.col("l_discount") * 100.0) / 10.0 + F.floor(F.col("l_quantity") / 10.0))
                       .alias("score"))
    return rounded(M.ranking_metrics(scored, "y", "score"))


def q_reference_sample(spark, sf_dir):
    """Reference statistics with the seeded value sample (at most 500 values
    per feature, hash order on the row key): sample size and range check."""
    apply_runtime_defaults(spark)
    li = table(spark, sf_dir, "lineitem")
    st = M.reference_stats(li, O.REF_FEATURES, key_cols=["l_orderkey", "l_linenumber"])
    vals = F.col("values")
    return st.select("feature", "count", F.size(vals).cast("long").alias("sample_size"),
                     ((F.array_min(vals) >= F.col("min")) & (F.array_max(vals) <= F.col("max")))
                     .alias("sample_in_range"))


WEEK_MS = 7 * 86_400_000
WEEK0_MS = 1704067200000  # 2024-01-01T00:00:00Z


def checkpoint_reports(spark, sf_dir) -> DataFrame:
    """Report rows derived from the events: one per (segment, week) with the
    validation log loss of that week's scores (trial = segment, iteration =
    week)."""
    s = scored_events(spark, sf_dir)
    week = F.floor((F.unix_millis(F.col("ts").cast("timestamp")) - F.lit(WEEK0_MS)) / F.lit(WEEK_MS))
    s = s.withColumn("iteration", week.cast("int"))
    ll = M.logloss(s, "y", "score", ["event_type", "iteration"])
    return ll.select(F.col("event_type").alias("trial_id"), "iteration",
                     F.create_map(F.lit("segment"), F.col("event_type")).alias("params"),
                     F.create_map(F.lit("validation_logloss"), F.col("logloss")).alias("metrics"))


def q_top2_checkpoints(spark, sf_dir):
    """The two best checkpoints by minimum validation log loss (top-k report)."""
    apply_runtime_defaults(spark)
    from ..operators.search import top_checkpoints
    best = top_checkpoints(checkpoint_reports(spark, sf_dir), 2, "validation_logloss", "min")
    return best.select("trial_id", "iteration",
                       F.round(F.col("metrics")["validation_logloss"], 10).alias("validation_logloss"))


def q_best_checkpoint_trial(spark, sf_dir):
    """Best trial by the log loss of its last report (mode min), summarised
    with finite metrics only."""
    apply_runtime_defaults(spark)
    from ..operators.search import best_summary, best_trial
    best = best_summary(best_trial(checkpoint_reports(spark, sf_dir), "validation_logloss", "min"))
    return best.select("trial_id", "iteration",
                       F.round(F.col("metrics")["validation_logloss"], 10).alias("validation_logloss"))


HALVING_RUNG = 2


def q_halving_survivors(spark, sf_dir):
    """Successive-halving rung: trials kept at week ``HALVING_RUNG`` (best
    half by log loss, ties by trial id)."""
    apply_runtime_defaults(spark)
    from ..operators.search import survivors
    return survivors(checkpoint_reports(spark, sf_dir), HALVING_RUNG, "validation_logloss", "min", 2)


def q_load_split_counts(spark, sf_dir):
    """Row and column counts of the load and of each flag split, from one
    aggregate pass (the counts are opt-in: they cost a job)."""
    apply_runtime_defaults(spark)
    spec = default_dataset_spec()
    lk = lake(spark, sf_dir)
    fs = SP.split_by_flag(lk, spec)
    flag = F.col(spec.split_column)
    counts = lk.agg(F.count(F.lit(1)).alias("load"),
                    F.count(F.when(flag == spec.split_train_value, 1)).alias("train"),
                    F.count(F.when(flag == spec.split_eval_value, 1)).alias("eval"))
    ncols = {"load": len(lk.columns), "train": len(fs.train.columns), "eval": len(fs.eval.columns)}
    parts = ", ".join(f"'{k}', `{k}`, {v}" for k, v in ncols.items())
    return counts.selectExpr(f"stack(3, {parts}) AS (part, rows, columns)")


def q_run_records_flat(spark, sf_dir):
    """Run records as a nested record, flattened to dotted columns."""
    apply_runtime_defaults(spark)
    runs = derived_runs(spark, sf_dir)
    t, p, m = F.col("tags"), F.col("params"), F.col("metrics")
    nested = runs.select(
        "run_id",
        F.struct(t["candidate_name"].alias("name"), t["candidate_kind"].alias("kind"),
                 F.struct(p["candidate.params.max_depth"].alias("max_depth"),
                          p["candidate.params.learning_rate"].alias("learning_rate"),
                          p["candidate.params.strategy"].alias("strategy")).alias("params"))
        .alias("candidate"),
        F.struct(F.round(m["f1"], 10).alias("f1"), F.round(m["roc_auc"], 10).alias("roc_auc"))
        .alias("metrics"))
    return S.flatten_struct_columns(nested)


def _metric_map(prefix: str = "") -> F.Column:
    names = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]
    return F.create_map(*[x for n in names for x in (F.lit(n), F.col(prefix + n))])


def q_retrain_metric_prefixes(spark, sf_dir):
    """Retrain metrics per segment: ``old.*`` (coarse score), ``new.*`` (fine
    score, NaN metrics removed) and ``delta.primary_metric``, one row per key."""
    apply_runtime_defaults(spark)
    s = scored_events(spark, sf_dir).withColumn("pred_fine", (F.col("fine_score") >= 0.5).cast("int"))
    old = M.binary_metrics(s, "y", "pred", "score", ["event_type"])
    new = M.binary_metrics(s, "y", "pred_fine", "fine_score", ["event_type"])
    new = new.select("event_type", *[F.col(c).alias("n_" + c) for c in new.columns if c != "event_type"])
    j = old.join(new, "event_type")
    merged = j.select("event_type", G.prefixed_metrics(_metric_map(), _metric_map("n_"),
                                                       F.col("n_roc_auc") - F.col("roc_auc")).alias("m"))
    return merged.select("event_type", F.explode("m").alias("key", "value")) \
        .select("event_type", "key", F.round("value", 10).alias("value"))


def q_dated_export(spark, sf_dir):
    """Export of the eval split (flag split, run-date/snapshot columns
    dropped) as a dated copy; read back with the date folder as a column."""
    apply_runtime_defaults(spark)
    fs = SP.split_by_flag(lake(spark, sf_dir), default_dataset_spec())
    export = S.drop_if_present(fs.eval, ["pipeline_run_date", "snapshot_id"])
    base = SK.scratch_path(spark, "training-sets")
    SK.write_dated_copy(export.select("row_id", "location_id", "will_visit"), base, "2024-01-28")
    back = spark.read.parquet(base)
    return back.select("row_id", "location_id", "will_visit", F.col("run_date").cast("string").alias("run_date"))


DECISION_SCHEMA = "candidate_name string, gate_tag string, registered boolean, failures_text string"


def q_decision_sidecar(spark, sf_dir):
    """Gate decisions appended as JSON sidecar records and read back."""
    apply_runtime_defaults(spark)
    d = G.gate_decisions(derived_runs(spark, sf_dir), default_gate_spec())
    out = d.select(F.col("tags")["candidate_name"].alias("candidate_name"), "gate_tag", "registered",
                   F.concat_ws("; ", "failures").alias("failures_text"))
    path = SK.append_json(out, SK.scratch_path(spark, "decisions"))
    return spark.read.schema(DECISION_SCHEMA).json(path)


def q_latest_metadata(spark, sf_dir):
    """Per-status summary documents under ``transformed/``; the greatest key
    is the latest metadata document, read as one multi-line JSON document."""
    apply_runtime_defaults(spark)
    o = table(spark, sf_dir, "orders")
    summary = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"),
                                             F.round(F.sum("o_totalprice"), 4).alias("total_price"))
    base = SK.scratch_path(spark, "pipeline")
    summary.withColumn("status", F.col("o_orderstatus")).write.partitionBy("o_orderstatus") \
        .json(f"{base}/transformed")
    return RD.read_latest_metadata(spark, f"{base}/transformed").select("status", "orders", "total_price")


# The reference's tuning search space (types and bounds).
SEARCH_SPACE = {
    "max_depth": {"type": "choice", "values": [4, 6, 8, 10]},
    "min_child_weight": {"type": "choice", "values": [1, 2, 4]},
    "subsample": {"type": "uniform", "lower": 0.6, "upper": 1.0},
    "colsample_bytree": {"type": "uniform", "lower": 0.6, "upper": 1.0},
    "learning_rate": {"type": "loguniform", "lower": 0.01, "upper": 0.2},
    "scale_pos_weight": {"type": "choice", "values": [0.5, 0.8, 1.0, 1.2]},
    "reg_lambda": {"type": "loguniform", "lower": 0.001, "upper": 10.0},
    "reg_alpha": {"type": "loguniform", "lower": 0.0001, "upper": 1.0},
}


def q_successive_halving(spark, sf_dir):
    """Four sampled trials, rungs of 2/4 rounds, halving factor 2, on the lake
    split; per rung the trials that ran, the validation rows, and whether every
    trial grew to the trees of its rung."""
    apply_runtime_defaults(spark)
    from .tuning import tune
    bundle, _ = _lake_bundle(spark, sf_dir)
    reports, _ = tune(spark, bundle, SEARCH_SPACE, 4, max_t=4, grace=2, reduction=2, at_once=SEARCH_AT_ONCE)
    m = F.col("metrics")
    return reports.groupBy("iteration").agg(
        F.count(F.lit(1)).alias("trials"), F.max(m["rows"]).alias("val_rows"),
        F.min(m["training_iteration"] == F.col("iteration")).alias("trees_follow_rung"),
        (F.min(m["roc_auc"]) > 0.5).alias("auc_above_baseline"))


def q_weekly_job(spark, sf_dir):
    """Export (lake split) -> train candidates -> registry gate against the
    runs derived from the events, short-circuiting on failure."""
    apply_runtime_defaults(spark)
    from .training import weekly_job
    history = derived_runs(spark, sf_dir)
    versions = derived_model_versions(history, MODEL_NAME)
    out = weekly_job(spark, lambda: _lake_bundle(spark, sf_dir)[0], history, versions, MODEL_NAME,
                     MODEL_CANDIDATES)
    version = None
    if out.registered is not None:
        version = out.registered.first()["version"]
    return spark.createDataFrame([(out.ok, out.stage, out.message, version)],
                                 "ok boolean, stage string, message string, registered_version int")


QUERIES: dict[str, Query] = {
    "newton_tree": q_newton_tree,
    "newton_scores": q_newton_scores,
    "strata_split_counts": q_strata_split_counts,
    "prepare_frame": q_prepare_frame,
    "split_by_flag": q_split_by_flag,
    "latest_run_delta": q_latest_run_delta,
    "time_split_2way": q_time_split_2way,
    "time_split_3way": q_time_split_3way,
    "stratified_split_counts": q_stratified_split_counts,
    "stratified_downsample_counts": q_stratified_downsample_counts,
    "sequential_split": q_sequential_split,
    "capped_time_splits": q_capped_time_splits,
    "binary_metrics": q_binary_metrics,
    "roc_auc": q_roc_auc,
    "average_precision": q_average_precision,
    "logloss": q_logloss,
    "majority_baseline": q_majority_baseline,
    "label_cardinality": q_label_cardinality,
    "reference_stats": q_reference_stats,
    "impute_scale": q_impute_scale,
    "quality_gates": q_quality_gates,
    "beat_baseline": q_beat_baseline,
    "registry_gates": q_registry_gates,
    "gate_tags": q_gate_tags,
    "quality_gate_best": q_quality_gate_best,
    "production_regression": q_production_regression,
    "registry_append": q_registry_append,
    "leaderboard": q_leaderboard,
    "retrain_decision": q_retrain_decision,
    "parse_list_edge_cases": q_parse_list_edge_cases,
    "embedding_expand_pad": _embedding_expand(70),
    "embedding_expand_truncate": _embedding_expand(20),
    "interaction_lexicographic": q_interaction_lexicographic,
    "align_features": q_align_features,
    "old_new_union": q_old_new_union,
    "csv_roundtrip": q_csv_roundtrip,
    "split_write_roundtrip": q_split_write_roundtrip,
    "shuffled_write": q_shuffled_write,
    "latest_file": q_latest_file,
    "reference_sample": q_reference_sample,
    "top2_checkpoints": q_top2_checkpoints,
    "best_checkpoint_trial": q_best_checkpoint_trial,
    "halving_survivors": q_halving_survivors,
    "run_records_flat": q_run_records_flat,
    "load_split_counts": q_load_split_counts,
    "retrain_metric_prefixes": q_retrain_metric_prefixes,
    "dated_export": q_dated_export,
    "decision_sidecar": q_decision_sidecar,
    "latest_metadata": q_latest_metadata,
    "leaderboard_markdown": q_leaderboard_markdown,
    "lineitem_ranking": q_lineitem_ranking,
    "train_candidates": q_train_candidates,
    "batch_score": q_batch_score,
    "continue_boosting": q_continue_boosting,
    "successive_halving": q_successive_halving,
    "weekly_job": q_weekly_job,
    "catalog_fallback": q_catalog_fallback,
    "source_builders": q_source_builders,
    "run_log": q_run_log,
    "full_refit": q_full_refit,
}

ORACLES: dict[str, str] = {
    "prepare_frame": O.prepare_frame_sql(),
    "split_by_flag": O.split_by_flag_sql(),
    "latest_run_delta": O.latest_run_delta_sql(),
    "time_split_2way": O.time_split_2way_sql(),
    "time_split_3way": O.time_split_3way_sql(0.1),
    "stratified_split_counts": O.stratified_split_counts_sql(0.7, 0.15),
    "stratified_downsample_counts": O.stratified_downsample_counts_sql(150),
    "sequential_split": O.sequential_split_sql(0.7, 0.15),
    "capped_time_splits": O.capped_time_splits_sql(CAPS, 0.1),
    "binary_metrics": O.binary_metrics_sql(),
    "roc_auc": O.roc_auc_sql(),
    "average_precision": O.average_precision_sql(),
    "logloss": O.logloss_sql(),
    "majority_baseline": O.majority_baseline_sql(),
    "label_cardinality": O.label_cardinality_sql(),
    "reference_stats": O.reference_stats_sql(),
    "impute_scale": O.impute_scale_sql(),
    "quality_gates": O.quality_gates_sql(),
    "beat_baseline": O.beat_baseline_sql(),
    "registry_gates": O.registry_gates_sql(),
    "gate_tags": O.gate_tags_sql(),
    "quality_gate_best": O.quality_gate_best_sql(),
    "production_regression": O.production_regression_sql(),
    "registry_append": O.registry_append_sql(),
    "leaderboard": O.leaderboard_sql(),
    "retrain_decision": O.retrain_decision_sql(0.0),
    "parse_list_edge_cases": O.parse_list_edge_cases_sql(),
    "embedding_expand_pad": O.embedding_expand_sql(70),
    "embedding_expand_truncate": O.embedding_expand_sql(20),
    "interaction_lexicographic": O.interaction_lexicographic_sql(),
    "align_features": O.align_features_sql(),
    "old_new_union": O.old_new_union_sql(),
    "csv_roundtrip": O.csv_roundtrip_sql(),
    "split_write_roundtrip": O.split_write_roundtrip_sql(),
    "leaderboard_markdown": O.leaderboard_markdown_sql(),
    "shuffled_write": O.shuffled_write_sql(),
    "latest_file": O.latest_file_sql(),
    "reference_sample": O.reference_sample_sql(),
    "top2_checkpoints": O.top2_checkpoints_sql(),
    "best_checkpoint_trial": O.best_checkpoint_trial_sql(),
    "halving_survivors": O.halving_survivors_sql(HALVING_RUNG),
    "run_records_flat": O.run_records_flat_sql(),
    "load_split_counts": O.load_split_counts_sql(),
    "retrain_metric_prefixes": O.retrain_metric_prefixes_sql(),
    "dated_export": O.dated_export_sql(),
    "decision_sidecar": O.decision_sidecar_sql(),
    "latest_metadata": O.latest_metadata_sql(),
    "lineitem_ranking": O.lineitem_ranking_sql(),
    "train_candidates": O.train_candidates_sql([c.name for c in default_candidates()]),
    "newton_tree": O.newton_tree_sql(),
    "newton_scores": O.newton_scores_sql(),
    "strata_split_counts": O.strata_split_counts_sql(0.7, 0.15),
    "batch_score": O.batch_score_sql(),
    "continue_boosting": O.continue_boosting_sql(),
    "successive_halving": O.successive_halving_sql({2: 4, 4: 2}),
    "weekly_job": O.weekly_job_sql(),
    "catalog_fallback": O.catalog_fallback_sql(),
    "source_builders": O.source_builders_sql(),
    "run_log": O.run_log_sql(),
    "full_refit": O.full_refit_sql(),
}
