"""DuckDB oracle SQL for the registered queries (same column names)."""
from __future__ import annotations

from .tables import LAKE_SQL

LAKE_CTE = f"lake AS ({LAKE_SQL})"
RENAMED = """renamed AS (
 SELECT row_id, user_id, location_id AS gmap_id, location_category_encoded AS category_encoded,
  location_avg_rating AS avg_rating, location_popularity, location_vibe_tags AS destination_vibe_tag,
  user_total_visits, user_personal_preferences, will_visit, split, pipeline_run_date, time
 FROM lake)"""


def _arr(col: str) -> str:
    return f"coalesce(try_cast({col} AS DOUBLE[]), []::DOUBLE[])"


def _expand(arr: str, n: int, prefix: str) -> list[str]:
    return [f"CASE WHEN len({arr}) > {i} THEN {arr}[{i + 1}] ELSE 0.0 END AS {prefix}_{i}" for i in range(n)]


def _text_sorted(n: int) -> list[str]:
    return sorted(str(i) for i in range(n))


def prepared_sql(where: str = "TRUE") -> str:
    """Oracle for prepare_frame on the lake adapter (row_id kept as key)."""
    vibe_order = _text_sorted(20)
    inter = [f"user_pref_{s} * vibe_{s} AS pref_x_vibe_{j}" for j, s in enumerate(vibe_order)]
    return f"""WITH {LAKE_CTE}, {RENAMED},
parsed AS (
 SELECT row_id, avg_rating, location_popularity, user_total_visits, will_visit, split, pipeline_run_date, time,
  {_arr('category_encoded')} AS a0, {_arr('destination_vibe_tag')} AS a1, {_arr('user_personal_preferences')} AS a2
 FROM renamed WHERE {where}),
expanded AS (
 SELECT row_id, avg_rating, location_popularity, user_total_visits, CAST(will_visit AS INT) AS will_visit,
  split, pipeline_run_date, time,
  {', '.join(_expand('a0', 21, 'cat_enc') + _expand('a1', 20, 'vibe') + _expand('a2', 20, 'user_pref'))}
 FROM parsed)
SELECT *, {', '.join(inter)} FROM expanded"""


def prepare_frame_sql() -> str:
    return f"SELECT * EXCLUDE (split, pipeline_run_date, time) FROM ({prepared_sql()})"


CUTOFF_MS_2024_01_22 = 1705881600000  # 2024-01-22T00:00:00Z in epoch ms


def split_by_flag_sql() -> str:
    return f"WITH {LAKE_CTE} SELECT row_id, split, will_visit FROM lake WHERE split IN ('train', 'eval')"


def latest_run_delta_sql() -> str:
    return f"""WITH {LAKE_CTE}, tr AS (SELECT * FROM lake WHERE split = 'train')
SELECT row_id, pipeline_run_date FROM tr WHERE pipeline_run_date = (SELECT max(pipeline_run_date) FROM tr)"""


EVENTS_MS = "SELECT event_id, epoch_us(ts)//1000 AS time FROM events"


def time_split_2way_sql() -> str:
    return f"""SELECT event_id, time, CASE WHEN time < {CUTOFF_MS_2024_01_22} THEN 'train' ELSE 'val' END AS split
FROM ({EVENTS_MS}) WHERE time IS NOT NULL"""


def time_split_3way_sql(test_pct: float = 0.1) -> str:
    return f"""WITH ev AS ({EVENTS_MS} WHERE ts IS NOT NULL),
c AS (SELECT count(*) AS total, sum(CASE WHEN time >= {CUTOFF_MS_2024_01_22} THEN 1 ELSE 0 END) AS post FROM ev),
q AS (SELECT least(CAST(round_even({test_pct}::DOUBLE * total, 0) AS BIGINT), post) AS n_test FROM c),
r AS (SELECT *, row_number() OVER (ORDER BY time DESC, event_id DESC) AS rk FROM ev WHERE time >= {CUTOFF_MS_2024_01_22})
SELECT event_id, time, 'train' AS split FROM ev WHERE time < {CUTOFF_MS_2024_01_22}
UNION ALL SELECT event_id, time, CASE WHEN rk <= (SELECT n_test FROM q) THEN 'test' ELSE 'val' END FROM r"""


def _report_from_quotas(quotas_cte: str) -> str:
    """quotas(cls, n_train, n_val, n_test) -> split report rows."""
    return f"""{quotas_cte},
parts AS (
 SELECT 'train' AS split, cls, n_train AS n FROM quotas UNION ALL
 SELECT 'val', cls, n_val FROM quotas UNION ALL
 SELECT 'test', cls, n_test FROM quotas)
SELECT split, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n * cls) AS BIGINT) AS positives,
 CAST(sum(CASE WHEN cls = 0 THEN n ELSE 0 END) AS BIGINT) AS zeros,
 CAST(sum(n * cls) AS DOUBLE) / sum(n) AS positive_rate
FROM parts GROUP BY split HAVING sum(n) > 0"""


def stratified_split_counts_sql(train_pct: float = 0.7, test_pct: float = 0.15) -> str:
    quotas = f"""WITH {LAKE_CTE},
cnt AS (SELECT will_visit AS cls, count(*) AS n FROM lake WHERE will_visit IS NOT NULL GROUP BY 1),
quotas AS (SELECT cls, CAST(floor(n * {train_pct}::DOUBLE) AS BIGINT) AS n_train,
  n - CAST(floor(n * {train_pct}::DOUBLE) AS BIGINT) - CAST(floor(n * {test_pct}::DOUBLE) AS BIGINT) AS n_val,
  CAST(floor(n * {test_pct}::DOUBLE) AS BIGINT) AS n_test FROM cnt)"""
    return _report_from_quotas(quotas)


def stratified_downsample_counts_sql(max_rows: int = 150) -> str:
    return f"""WITH tot AS (SELECT count(*) AS n FROM labels),
cnt AS (SELECT quality, count(*) AS n_c FROM labels WHERE quality IS NOT NULL GROUP BY 1)
SELECT quality, CASE WHEN (SELECT n FROM tot) <= {max_rows} THEN n_c
  ELSE greatest(1, CAST(floor(CAST({max_rows} * n_c AS DOUBLE) / (SELECT n FROM tot)) AS BIGINT)) END AS rows
FROM cnt"""


def sequential_split_sql(train_pct: float = 0.7, test_pct: float = 0.15) -> str:
    return f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
q AS (SELECT *, CAST(floor(n * {train_pct}::DOUBLE) AS BIGINT) AS n_train,
  CAST(floor(n * {test_pct}::DOUBLE) AS BIGINT) AS n_test FROM r)
SELECT o_orderkey, CASE WHEN pos < n_train THEN 'train' WHEN pos < n - n_test THEN 'val' ELSE 'test' END AS split FROM q"""


def capped_time_splits_sql(caps: dict, test_pct: float = 0.1) -> str:
    cap_rows = " UNION ALL ".join(f"SELECT '{k}' AS split, {v} AS cap" for k, v in caps.items())
    return f"""WITH {LAKE_CTE},
base AS (SELECT row_id, time, will_visit FROM lake WHERE time IS NOT NULL),
c AS (SELECT count(*) AS total, sum(CASE WHEN time >= {CUTOFF_MS_2024_01_22} THEN 1 ELSE 0 END) AS post FROM base),
q AS (SELECT least(CAST(round_even({test_pct}::DOUBLE * total, 0) AS BIGINT), post) AS n_test FROM c),
r AS (SELECT *, row_number() OVER (ORDER BY time DESC, row_id DESC) AS rk FROM base WHERE time >= {CUTOFF_MS_2024_01_22}),
tagged AS (SELECT row_id, will_visit, 'train' AS split FROM base WHERE time < {CUTOFF_MS_2024_01_22}
  UNION ALL SELECT row_id, will_visit, CASE WHEN rk <= (SELECT n_test FROM q) THEN 'test' ELSE 'val' END FROM r),
caps AS ({cap_rows}),
fr AS (SELECT split, count(*) AS n FROM tagged GROUP BY 1),
cl AS (SELECT split, will_visit, count(*) AS n_c FROM tagged WHERE will_visit IS NOT NULL GROUP BY 1, 2),
kept AS (
 SELECT cl.split, cl.will_visit,
  CASE WHEN caps.cap IS NULL OR fr.n <= caps.cap THEN cl.n_c
       ELSE greatest(1, CAST(floor(CAST(caps.cap * cl.n_c AS DOUBLE) / fr.n) AS BIGINT)) END AS n
 FROM cl JOIN fr USING (split) LEFT JOIN caps USING (split))
SELECT split, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n * will_visit) AS BIGINT) AS positives,
 CAST(sum(CASE WHEN will_visit = 0 THEN n ELSE 0 END) AS BIGINT) AS zeros,
 CAST(sum(n * will_visit) AS DOUBLE) / sum(n) AS positive_rate
FROM kept GROUP BY split"""


# Scored events: label, a tied score (21 levels), a prediction and a fine score.
SCORED_EVENTS = """SELECT event_id, event_type, CASE WHEN value > 40 THEN 1 ELSE 0 END AS y,
 least(floor(value / 8.0) + (event_id * 7) % 5, 20) / 20.0 AS score,
 CASE WHEN least(floor(value / 8.0) + (event_id * 7) % 5, 20) / 20.0 >= 0.5 THEN 1 ELSE 0 END AS pred,
 value / 500.0 + (event_id % 13) / 1000.0 AS fine_score
FROM events"""


def _ranking_cte(source: str, group: str | None, score: str, name: str = "rank_m", digits: int | None = 10) -> str:
    g = f"{group} AS g" if group else "1 AS g"
    r0, r1 = ("round(", f", {digits})") if digits is not None else ("(", ")")
    return f"""{name}_ps AS (SELECT g, s, CAST(count(*) AS DOUBLE) AS k, CAST(sum(y) AS DOUBLE) AS p
  FROM (SELECT {g}, {score} AS s, y FROM ({source})) GROUP BY g, s),
{name}_cum AS (SELECT *, sum(p) OVER w AS cp, sum(k) OVER w AS ck, sum(p) OVER (PARTITION BY g) AS tp,
  sum(k) OVER (PARTITION BY g) AS tk FROM {name}_ps
  WINDOW w AS (PARTITION BY g ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name} AS (SELECT g, CASE WHEN any_value(tp) = 0 OR any_value(tk) - any_value(tp) = 0 THEN 'nan'::DOUBLE
   ELSE {r0}sum((k - p) * (cp - p + p / 2.0)) / (any_value(tp) * (any_value(tk) - any_value(tp))){r1} END AS roc_auc,
  CASE WHEN any_value(tp) = 0 OR any_value(tk) - any_value(tp) = 0 THEN 'nan'::DOUBLE
   ELSE {r0}sum(p * (cp / ck)) / any_value(tp){r1} END AS average_precision
 FROM {name}_cum GROUP BY g)"""


def binary_metrics_sql() -> str:
    return f"""WITH {_ranking_cte(SCORED_EVENTS, 'event_type', 'score')},
conf AS (SELECT event_type AS g, CAST(count(*) AS DOUBLE) AS n,
  CAST(sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN y <> 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN y = 1 AND pred <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
  CAST(sum(CASE WHEN y = pred THEN 1 ELSE 0 END) AS DOUBLE) AS ok
 FROM ({SCORED_EVENTS}) GROUP BY 1)
SELECT conf.g AS event_type,
 round(CASE WHEN n = 0 THEN 0.0 ELSE ok / n END, 10) AS accuracy,
 round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 10) AS precision,
 round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 10) AS recall,
 round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 10) AS f1,
 CAST(n AS BIGINT) AS rows, roc_auc, average_precision
FROM conf LEFT JOIN rank_m ON conf.g = rank_m.g"""


def roc_auc_sql() -> str:
    return f"WITH {_ranking_cte(SCORED_EVENTS, None, 'fine_score')} SELECT roc_auc FROM rank_m"


def average_precision_sql() -> str:
    return f"WITH {_ranking_cte(SCORED_EVENTS, None, 'fine_score')} SELECT average_precision FROM rank_m"


def logloss_sql() -> str:
    return f"""SELECT event_type, round(-avg(y * ln(least(greatest(score, 1e-15), 1 - 1e-15))
  + (1 - y) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15))), 10) AS logloss
FROM ({SCORED_EVENTS}) GROUP BY 1"""


def majority_baseline_sql() -> str:
    return """WITH c AS (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY 1)
SELECT CAST(arg_max(quality, n * 1000000 - quality) AS INT) AS majority_class, CAST(max(n) AS BIGINT) AS majority_count,
 CAST(sum(n) AS BIGINT) AS rows FROM c"""


def label_cardinality_sql() -> str:
    return "SELECT CAST(count(DISTINCT quality) AS BIGINT) AS distinct_labels FROM labels"


REF_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def reference_stats_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM lineitem" for f in REF_FEATURES)
    return f"""SELECT feature, CAST(count(*) AS BIGINT) AS count, round(avg(value), 9) AS mean,
 round(stddev_samp(value), 9) AS std, min(value) AS min, max(value) AS max
FROM ({parts}) WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature"""


IMPUTE_SOURCE = """SELECT event_id,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v_value,
 CASE WHEN event_id % 5 = 0 THEN 'nan'::DOUBLE ELSE CAST(user_id AS DOUBLE) END AS v_user,
 CAST(3.0 AS DOUBLE) AS v_const,
 CAST(NULL AS DOUBLE) AS v_empty
FROM events"""
IMPUTE_FEATURES = ["v_value", "v_user", "v_const", "v_empty"]


def impute_scale_sql() -> str:
    live = ["v_value", "v_user", "v_const"]
    med = ", ".join(f"median(CASE WHEN isnan({f}) THEN NULL ELSE {f} END) AS med_{f}" for f in live)
    imp = ", ".join(f"coalesce(CASE WHEN isnan({f}) THEN NULL ELSE {f} END, med_{f}) AS {f}" for f in live)
    st = ", ".join(f"avg({f}) AS mu_{f}, stddev_pop({f}) AS sd_{f}" for f in live)
    out = ", ".join(
        f"round(({f} - mu_{f}) / CASE WHEN sd_{f} < {ZERO_SCALE_SQL} THEN 1.0 ELSE sd_{f} END, 8) AS {f}"
        for f in live)
    return f"""WITH src AS ({IMPUTE_SOURCE}), med AS (SELECT {med} FROM src),
imp AS (SELECT event_id, {imp} FROM src, med), st AS (SELECT {st} FROM imp)
SELECT event_id, {out}, 0.0::DOUBLE AS v_empty FROM imp, st"""


ZERO_SCALE_SQL = "2.220446049250313e-15"


def _conf_cte(source: str, group: str | None, name: str) -> str:
    g = group if group else "1"
    return f"""{name} AS (SELECT {g} AS g, CAST(count(*) AS DOUBLE) AS n,
  CAST(sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN y <> 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN y = 1 AND pred <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
  CAST(sum(CASE WHEN y = pred THEN 1 ELSE 0 END) AS DOUBLE) AS ok, max(ts) AS max_ts, min(ts) AS min_ts
 FROM ({source}) GROUP BY 1)"""


SCORED_TS = SCORED_EVENTS.replace("SELECT event_id, event_type,", "SELECT event_id, event_type, ts,")
BASE_SOURCE = f"""SELECT se.*, m.maj AS pred2 FROM ({SCORED_TS}) se,
 (SELECT arg_max(y, n * 1000000 - y) AS maj FROM (SELECT y, count(*) AS n FROM ({SCORED_TS}) GROUP BY y)) m"""
BASE_SCORED = f"SELECT event_id, ts, y, pred2 AS pred, CAST(pred2 AS DOUBLE) AS score FROM ({BASE_SOURCE})"

KIND_SQL = ("CASE event_type WHEN 'click' THEN 'xgboost' WHEN 'view' THEN 'xgboost' "
            "WHEN 'purchase' THEN 'hist_gradient_boosting' WHEN 'signup' THEN 'random_forest' "
            "WHEN 'error' THEN 'logistic_regression' ELSE 'xgboost' END")


def runs_cte() -> str:
    """Flat runs (one column per tag/param/metric) matching plans.runs."""
    metric_cols = """CASE WHEN c.n = 0 THEN 0.0 ELSE c.ok / c.n END AS accuracy,
  CASE WHEN c.tp + c.fp = 0 THEN 0.0 ELSE c.tp / (c.tp + c.fp) END AS precision,
  CASE WHEN c.tp + c.fn = 0 THEN 0.0 ELSE c.tp / (c.tp + c.fn) END AS recall,
  CASE WHEN 2 * c.tp + c.fp + c.fn = 0 THEN 0.0 ELSE 2 * c.tp / (2 * c.tp + c.fp + c.fn) END AS f1,
  r.roc_auc, r.average_precision, c.n AS train_rows, c.n / 1000.0 AS train_seconds,
  c.n / greatest(c.n / 1000.0, 1e-9) AS rows_per_second"""
    return f"""{_ranking_cte(SCORED_TS, 'event_type', 'score', 'seg_rank')},
{_conf_cte(SCORED_TS, 'event_type', 'seg_conf')},
{_ranking_cte(BASE_SCORED, None, 'score', 'base_rank')},
{_conf_cte(BASE_SCORED, None, 'base_conf')},
runs AS (
 SELECT 'run-' || c.g AS run_id, CAST(c.max_ts AS TIMESTAMP) AS start_time, c.g AS candidate_name,
  {KIND_SQL.replace('event_type', 'c.g')} AS candidate_kind, 'v' || CAST(length(c.g) AS VARCHAR) AS code_version,
  CAST(CAST(c.n AS BIGINT) % 7 + 2 AS VARCHAR) AS p_max_depth, '0.1' AS p_learning_rate, NULL::VARCHAR AS p_strategy,
  'segment ' || c.g AS notes, {metric_cols}
 FROM seg_conf c JOIN seg_rank r ON c.g = r.g
 UNION ALL
 SELECT 'run-baseline', CAST(c.min_ts AS TIMESTAMP), 'baseline', 'dummy', 'v0', NULL, NULL, 'most_frequent',
  'majority class', {metric_cols}
 FROM base_conf c JOIN base_rank r ON c.g = r.g)"""


NO_BASELINE = ("beat_baseline gate is configured but no baseline metrics were captured "
               "— train the baseline candidate before other candidates.")


def _nan_null(x: str) -> str:
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


def gate_decisions_cte() -> str:
    return f"""WITH {runs_cte()},
bl AS (SELECT arg_max({_nan_null('roc_auc')}, start_time) AS b_auc, count(*) AS nb FROM runs WHERE candidate_name IN ('baseline')),
g AS (SELECT r.*, candidate_name IN ('baseline') AS exempt, bl.nb > 0 AS has_base,
  {_nan_null('r.roc_auc')} AS c_auc, bl.b_auc,
  {_nan_null('r.roc_auc')} - bl.b_auc AS delta,
  CASE WHEN {_nan_null('r.roc_auc')} IS NULL THEN 'roc_auc is missing or NaN (threshold 0.55)'
       WHEN r.roc_auc < 0.55 THEN printf('roc_auc=%.4f below hard minimum 0.55', r.roc_auc) END AS m1,
  CASE WHEN {_nan_null('r.recall')} IS NULL THEN 'recall is missing or NaN (threshold 0.3)'
       WHEN r.recall < 0.3 THEN printf('recall=%.4f below hard minimum 0.3', r.recall) END AS m2
 FROM runs r, bl),
d AS (SELECT *, has_base AND c_auc IS NOT NULL AND b_auc IS NOT NULL AS comparable FROM g),
e AS (SELECT *, CASE WHEN NOT has_base THEN '{NO_BASELINE}'
   WHEN comparable AND delta < 0.02 THEN printf('roc_auc delta vs baseline %+.4f < required min_delta=0.02', delta) END AS m3 FROM d),
f AS (SELECT *, CASE WHEN exempt THEN '' ELSE concat_ws('; ', m1, m2, m3) END AS failures_text,
  CASE WHEN exempt THEN 0 ELSE (CASE WHEN m1 IS NULL THEN 0 ELSE 1 END + CASE WHEN m2 IS NULL THEN 0 ELSE 1 END
   + CASE WHEN m3 IS NULL THEN 0 ELSE 1 END) END AS nf FROM e)"""


def quality_gates_sql() -> str:
    return gate_decisions_cte() + """
SELECT candidate_name, exempt, exempt OR nf = 0 AS passed,
 CASE WHEN exempt THEN 'exempt' WHEN nf = 0 THEN 'passed' ELSE 'failed' END AS gate_tag,
 (NOT exempt) AND nf = 0 AS registered, CAST(nf AS BIGINT) AS n_failures, failures_text
FROM f"""


def beat_baseline_sql() -> str:
    return gate_decisions_cte() + """
SELECT candidate_name, 'roc_auc' AS metric, round(c_auc, 10) AS candidate, round(b_auc, 10) AS baseline,
 round(delta, 10) AS delta, 0.02::DOUBLE AS min_delta, delta >= 0.02 AS meets_min_delta
FROM f WHERE NOT exempt AND comparable"""


def _registry_eval_cte(max_runs: int = 10) -> str:
    return f"""WITH {runs_cte()},
bf AS (SELECT arg_max(f1, start_time) AS baseline_f1 FROM runs WHERE candidate_kind = 'dummy'),
recent AS (SELECT * FROM runs WHERE candidate_kind <> 'dummy' ORDER BY start_time DESC, run_id ASC LIMIT {max_runs}),
ev AS (SELECT r.*, bf.baseline_f1,
  NOT isnan(coalesce(f1, 0.0)) AND coalesce(f1, 0.0) >= 0.6 AS f1_minimum,
  NOT isnan(coalesce(roc_auc, 0.0)) AND coalesce(roc_auc, 0.0) >= 0.7 AS auc_minimum,
  NOT isnan(coalesce(precision, 0.0)) AND coalesce(precision, 0.0) >= 0.55 AS precision_minimum,
  NOT isnan(coalesce(recall, 0.0)) AND coalesce(recall, 0.0) >= 0.5 AS recall_minimum,
  CASE WHEN bf.baseline_f1 IS NULL THEN TRUE ELSE NOT isnan(coalesce(f1, 0.0)) AND coalesce(f1, 0.0) > bf.baseline_f1 + 0.05 END AS beats_baseline
 FROM recent r, bf),
ev2 AS (SELECT *, f1_minimum AND auc_minimum AND precision_minimum AND recall_minimum AND beats_baseline AS all_passed FROM ev),
best AS (SELECT run_id, candidate_name, coalesce(f1, 0.0) AS f1, coalesce(roc_auc, 0.0) AS roc_auc FROM ev2
 WHERE all_passed AND coalesce(f1, 0.0) > -1.0 ORDER BY coalesce(f1, 0.0) DESC, start_time DESC, run_id ASC LIMIT 1),
mv AS (SELECT 'WillVisit' AS name, CAST(row_number() OVER (ORDER BY start_time, run_id) AS INT) AS version, run_id
 FROM runs WHERE candidate_kind <> 'dummy'),
mv2 AS (SELECT *, CASE WHEN version = 1 THEN 'Production' ELSE 'Archived' END AS stage FROM mv),
prod AS (SELECT r.f1 AS production_f1 FROM (SELECT arg_max(run_id, version) AS run_id FROM mv2
  WHERE name = 'WillVisit' AND stage = 'Production') p JOIN runs r ON r.run_id = p.run_id),
decision AS (SELECT best.*, prod.production_f1,
  prod.production_f1 IS NULL OR best.f1 >= prod.production_f1 - 0.02 AS register
 FROM best LEFT JOIN prod ON TRUE)"""


def registry_gates_sql() -> str:
    return _registry_eval_cte() + """
SELECT run_id, f1_minimum, auc_minimum, precision_minimum, recall_minimum, beats_baseline, all_passed FROM ev2"""


def gate_tags_sql() -> str:
    return _registry_eval_cte() + """
SELECT run_id, CASE WHEN all_passed THEN 'True' ELSE 'False' END AS quality_gate_passed,
 '{"f1_minimum": ' || f1_minimum || ', "auc_minimum": ' || auc_minimum || ', "precision_minimum": '
 || precision_minimum || ', "recall_minimum": ' || recall_minimum || ', "beats_baseline": ' || beats_baseline || '}'
 AS quality_gate_details FROM ev2"""


def quality_gate_best_sql() -> str:
    return _registry_eval_cte() + "\nSELECT run_id, candidate_name, round(f1, 10) AS f1, round(roc_auc, 10) AS roc_auc FROM best"


def production_regression_sql() -> str:
    return _registry_eval_cte() + """
SELECT run_id, round(f1, 10) AS f1, round(production_f1, 10) AS production_f1, register FROM decision"""


def registry_append_sql() -> str:
    return _registry_eval_cte() + """
SELECT 'WillVisit' AS name, CAST((SELECT coalesce(max(version), 0) FROM mv2 WHERE name = 'WillVisit') + 1 AS INT) AS version,
 'Staging' AS stage, run_id, candidate_name AS source_candidate FROM decision WHERE register"""


def leaderboard_sql() -> str:
    def kv(key, col, fmt=None):
        val = f"printf('{fmt}', {col})" if fmt else col
        return f"CASE WHEN {col} IS NOT NULL THEN '{key}=' || {val} END"
    params = ", ".join([kv("kind", "candidate_kind"), kv("learning_rate", "p_learning_rate"),
                        kv("max_depth", "p_max_depth"), kv("strategy", "p_strategy")])
    quality = ", ".join(kv(k, k, "%.4f") for k in ["accuracy", "f1", "roc_auc", "average_precision"])
    cost = ", ".join(kv(k, k, "%.2f") for k in ["train_seconds", "rows_per_second"])
    return f"""WITH {runs_cte()}
SELECT CAST(row_number() OVER (ORDER BY f1 DESC NULLS LAST, run_id ASC) AS INT) AS rank,
 coalesce(candidate_name, '-') AS candidate, '-' AS run_link, coalesce(code_version, '-') AS code_version,
 coalesce(nullif(concat_ws(', ', {params}), ''), '-') AS hyperparams,
 coalesce(nullif(concat_ws(', ', {quality}), ''), '-') AS quality,
 coalesce(nullif(concat_ws(', ', {cost}), ''), '-') AS cost,
 coalesce(notes, '') AS notes
FROM runs"""


def retrain_decision_sql(threshold: float = 0.0) -> str:
    return f"""WITH {_ranking_cte(SCORED_EVENTS, 'event_type', 'score', 'old_m')},
{_ranking_cte(SCORED_EVENTS, 'event_type', 'fine_score', 'new_m')}
SELECT o.g AS event_type, 'roc_auc' AS primary_metric, o.roc_auc AS old_score, n.roc_auc AS new_score,
 round(n.roc_auc - o.roc_auc, 10) AS delta, {threshold}::DOUBLE AS threshold,
 CASE WHEN isnan(o.roc_auc) OR isnan(n.roc_auc) THEN 'reject'
      WHEN round(n.roc_auc - o.roc_auc, 10) >= {threshold} THEN 'keep' ELSE 'reject' END AS decision
FROM old_m o JOIN new_m n ON o.g = n.g"""


def parse_list_edge_cases_sql() -> str:
    """Vibe text (with malformed, object, short and long values) at length 3."""
    return f"""WITH {LAKE_CTE}, a AS (SELECT row_id, {_arr('location_vibe_tags')} AS a FROM lake)
SELECT row_id, {', '.join(_expand('a', 3, 'vt'))} FROM a"""


def embedding_expand_sql(length: int) -> str:
    return f"""WITH a AS (SELECT vec_id, label, coalesce(CAST(embedding AS DOUBLE[]), []::DOUBLE[]) AS a FROM embeddings)
SELECT vec_id, label, {', '.join(_expand('a', length, 'emb'))} FROM a"""


def interaction_lexicographic_sql() -> str:
    cols = [f"user_pref_{s} * vibe_{s} AS pref_x_vibe_{j}" for j, s in enumerate(_text_sorted(20))]
    return f"SELECT row_id, {', '.join(cols)} FROM ({prepared_sql()})"


def align_features_sql() -> str:
    """Train features from train rows; eval rows lack cat_enc_3 (filled 0.0)
    and carry an extra column (dropped)."""
    return f"""SELECT row_id, avg_rating, location_popularity, user_total_visits, cat_enc_0, cat_enc_1, cat_enc_2,
 0.0::DOUBLE AS cat_enc_3, vibe_0, will_visit FROM ({prepared_sql("split = 'eval'")})"""


def old_new_union_sql() -> str:
    return """SELECT o_orderkey, o_totalprice, CAST(o_orderstatus = 'F' AS INT) AS label, 'old' AS part FROM orders
 WHERE o_orderdate < CAST('1995-01-01' AS TIMESTAMP)
UNION ALL SELECT o_orderkey, o_totalprice, CAST(o_orderstatus = 'F' AS INT), 'new' FROM orders
 WHERE o_orderdate >= CAST('1995-01-01' AS TIMESTAMP)"""


def csv_roundtrip_sql() -> str:
    return "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def split_write_roundtrip_sql() -> str:
    return f"SELECT split, CAST(count(*) AS BIGINT) AS rows FROM ({sequential_split_sql(0.7, 0.15)}) GROUP BY split"


def leaderboard_markdown_sql() -> str:
    return f"""SELECT rank, '| ' || concat_ws(' | ', candidate, run_link, code_version, hyperparams, quality, cost, notes)
 || ' |' AS line FROM ({leaderboard_sql()})"""


LINEITEM_SCORED = """SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
 floor(l_discount * 100.0) / 10.0 + floor(l_quantity / 10.0) AS score FROM lineitem"""


def lineitem_ranking_sql() -> str:
    return f"WITH {_ranking_cte(LINEITEM_SCORED, None, 'score')} SELECT roc_auc, average_precision FROM rank_m"


def latest_file_sql() -> str:
    """The newest of three drops (F, O, then P orders) is the P drop."""
    return "SELECT * FROM orders WHERE o_orderstatus = 'P'"


def reference_sample_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM lineitem" for f in REF_FEATURES)
    return f"""SELECT feature, CAST(count(*) AS BIGINT) AS count, CAST(least(count(*), 500) AS BIGINT) AS sample_size,
 true AS sample_in_range
FROM ({parts}) WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature"""


def _checkpoint_ll_cte() -> str:
    """Validation log loss per (segment, week since 2024-01-01)."""
    clip = "least(greatest(score, 1e-15), 1 - 1e-15)"
    return f"""s AS (SELECT event_type, y, score,
  CAST(floor((epoch_us(ts) // 1000 - 1704067200000) / 604800000) AS INT) AS iteration FROM ({SCORED_TS})),
ll AS (SELECT event_type AS trial_id, iteration, -avg(y * ln({clip}) + (1 - y) * ln(1 - {clip})) AS l
 FROM s GROUP BY 1, 2)"""


def top2_checkpoints_sql() -> str:
    return f"""WITH {_checkpoint_ll_cte()}
SELECT trial_id, iteration, round(l, 10) AS validation_logloss FROM ll
WHERE l IS NOT NULL AND NOT isnan(l) ORDER BY l, trial_id, iteration LIMIT 2"""


def best_checkpoint_trial_sql() -> str:
    return f"""WITH {_checkpoint_ll_cte()},
last AS (SELECT trial_id, max(iteration) AS iteration, arg_max(l, iteration) AS l FROM ll GROUP BY trial_id)
SELECT trial_id, iteration, round(l, 10) AS validation_logloss FROM last
WHERE l IS NOT NULL AND NOT isnan(l) ORDER BY l LIMIT 1"""


def halving_survivors_sql(rung: int) -> str:
    return f"""WITH {_checkpoint_ll_cte()},
rung AS (SELECT trial_id, row_number() OVER (ORDER BY l ASC NULLS LAST, trial_id) AS r, count(*) OVER () AS n
 FROM ll WHERE iteration = {rung})
SELECT trial_id FROM rung WHERE r <= greatest(1, floor(n / 2))"""


def run_records_flat_sql() -> str:
    return f"""WITH {runs_cte()}
SELECT run_id, candidate_name AS "candidate.name", candidate_kind AS "candidate.kind",
 p_max_depth AS "candidate.params.max_depth", p_learning_rate AS "candidate.params.learning_rate",
 p_strategy AS "candidate.params.strategy", round(f1, 10) AS "metrics.f1", round(roc_auc, 10) AS "metrics.roc_auc"
FROM runs"""


METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]


def _metric_cols(c: str = "c", r: str = "r") -> str:
    return f"""CASE WHEN {c}.n = 0 THEN 0.0 ELSE {c}.ok / {c}.n END AS accuracy,
  CASE WHEN {c}.tp + {c}.fp = 0 THEN 0.0 ELSE {c}.tp / ({c}.tp + {c}.fp) END AS precision,
  CASE WHEN {c}.tp + {c}.fn = 0 THEN 0.0 ELSE {c}.tp / ({c}.tp + {c}.fn) END AS recall,
  CASE WHEN 2 * {c}.tp + {c}.fp + {c}.fn = 0 THEN 0.0 ELSE 2 * {c}.tp / (2 * {c}.tp + {c}.fp + {c}.fn) END AS f1,
  {r}.roc_auc, {r}.average_precision"""


def retrain_metric_prefixes_sql() -> str:
    new_src = f"""SELECT event_id, event_type, ts, y, fine_score,
 CASE WHEN fine_score >= 0.5 THEN 1 ELSE 0 END AS pred FROM ({SCORED_TS})"""
    kv = []
    for side in ("old", "new"):
        kv += [f"SELECT g, '{side}.{m}' AS key, {m} AS value FROM {side}_m" for m in METRIC_NAMES]
    kv.append("SELECT o.g, 'delta.primary_metric', n.roc_auc - o.roc_auc FROM old_m o JOIN new_m n ON o.g = n.g")
    return f"""WITH {_ranking_cte(SCORED_TS, 'event_type', 'score', 'o_r', digits=None)},
{_conf_cte(SCORED_TS, 'event_type', 'o_c')},
{_ranking_cte(new_src, 'event_type', 'fine_score', 'n_r', digits=None)},
{_conf_cte(new_src, 'event_type', 'n_c')},
old_m AS (SELECT c.g, {_metric_cols()} FROM o_c c JOIN o_r r ON c.g = r.g),
new_m AS (SELECT c.g, {_metric_cols()} FROM n_c c JOIN n_r r ON c.g = r.g),
kv AS ({' UNION ALL '.join(kv)})
SELECT g AS event_type, key, round(value, 10) AS value FROM kv
WHERE NOT ((key LIKE 'old.%' OR key LIKE 'new.%') AND isnan(value))"""


def dated_export_sql() -> str:
    return f"""WITH {LAKE_CTE}
SELECT row_id, location_id, will_visit, '2024-01-28' AS run_date FROM lake WHERE split = 'eval'"""


def decision_sidecar_sql() -> str:
    return f"SELECT candidate_name, gate_tag, registered, failures_text FROM ({quality_gates_sql()})"


def latest_metadata_sql() -> str:
    return """SELECT o_orderstatus AS status, CAST(count(*) AS BIGINT) AS orders, round(sum(o_totalprice), 4) AS total_price
FROM orders WHERE o_orderstatus = (SELECT max(o_orderstatus) FROM orders) GROUP BY 1"""


LAKE_COLUMNS = 14  # the adapter's columns; a flag split drops the flag column


def load_split_counts_sql() -> str:
    return f"""WITH {LAKE_CTE}
SELECT 'load' AS part, count(*) AS rows, {LAKE_COLUMNS} AS columns FROM lake
UNION ALL SELECT 'train', count(*) FILTER (WHERE split = 'train'), {LAKE_COLUMNS - 1} FROM lake
UNION ALL SELECT 'eval', count(*) FILTER (WHERE split = 'eval'), {LAKE_COLUMNS - 1} FROM lake"""


def train_candidates_sql(names: list[str], baseline: str = "baseline") -> str:
    """Row counts, and the baseline's metrics from the class counts of both parts."""
    listed = ", ".join(f"('{n}')" for n in names)
    return f"""WITH {LAKE_CTE},
c AS (SELECT CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE) AS train_rows,
  CAST(count(*) FILTER (WHERE split = 'eval') AS DOUBLE) AS val_rows,
  sum(will_visit) FILTER (WHERE split = 'eval') AS pos,
  CASE WHEN 2 * sum(will_visit) FILTER (WHERE split = 'train') > count(*) FILTER (WHERE split = 'train') THEN 1 ELSE 0 END AS major
 FROM lake),
names(candidate_name) AS (VALUES {listed})
SELECT candidate_name, 'ok' AS status, CASE WHEN candidate_name = '{baseline}' THEN 'exempt' ELSE 'passed' END AS gate_tag,
 train_rows, val_rows,
 CASE WHEN candidate_name = '{baseline}' THEN round(CASE WHEN major = 1 THEN pos ELSE val_rows - pos END / val_rows, 10) END AS baseline_accuracy,
 CASE WHEN candidate_name = '{baseline}' THEN round(CASE WHEN major = 1 THEN 2.0 * pos / (pos + val_rows) ELSE 0.0 END, 10) END AS baseline_f1,
 candidate_name <> '{baseline}' AS auc_above_baseline
FROM names, c"""


def _newton_tree_ctes() -> str:
    """The tree of ``newton_tree``: soft-thresholded gains over all distinct values (a missing value lies with the lowest)."""
    features = ["location_popularity", "user_total_visits", "location_avg_rating"]
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - 2.0, 0))"
    part = lambda g, h: f"({soft(g)} * {soft(g)} / ({h} + 1.5))"
    cells = " UNION ALL ".join(f"SELECT row_id, node, {k} AS f, '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), (SELECT CAST(min({c}) AS DOUBLE) FROM t)) AS v, g, h FROM {{src}}"
                               for k, c in enumerate(features))

    def level(src: str, k: int) -> str:
        return f"""
c{k} AS ({cells.replace("{src}", src)}),
s{k} AS (SELECT node, f, feature, v, sum(g) AS g, sum(h) AS h FROM c{k} GROUP BY ALL),
u{k} AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY node, f) AS gt, sum(h) OVER (PARTITION BY node, f) AS ht
  FROM s{k} WINDOW w AS (PARTITION BY node, f ORDER BY v ROWS UNBOUNDED PRECEDING)),
b{k} AS (SELECT *, 0.5 * ({part("gl", "hl")} + {part("(gt - gl)", "(ht - hl)")} - {part("gt", "ht")}) AS gain FROM u{k}
  WHERE hl >= 2 AND ht - hl >= 2 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, v) = 1 AND gain > 1e-12)"""

    return f"""WITH {LAKE_CTE}, t AS (SELECT *, 'root' AS node, CAST(0.5 - will_visit AS DOUBLE) AS g, 0.25::DOUBLE AS h FROM lake WHERE split = 'train' AND will_visit IS NOT NULL),
{level("t", 0)},
t1 AS (SELECT t.* REPLACE (CASE WHEN x.v <= b0.v THEN 'root.L' ELSE 'root.R' END AS node) FROM t JOIN c0 x USING (row_id) JOIN b0 ON x.f = b0.f),
{level("t1", 1)},
e AS (SELECT node, feature, v, gain, gl, hl, gt, ht FROM b0 UNION ALL SELECT node, feature, v, gain, gl, hl, gt, ht FROM b1),
n AS (SELECT 'root' AS node, sum(g) AS g, sum(h) AS h FROM t UNION ALL SELECT node || '.L', gl, hl FROM e UNION ALL SELECT node || '.R', gt - gl, ht - hl FROM e),
tree AS (SELECT n.node, e.feature, e.v AS threshold, round(e.gain, 6) AS gain, round(-0.3 * {soft("n.g")} / (n.h + 1.5), 8) AS weight, -0.3 * {soft("n.g")} / (n.h + 1.5) AS exact FROM n LEFT JOIN e USING (node))"""


def newton_tree_sql() -> str:
    return f"{_newton_tree_ctes()} SELECT node, feature, threshold, gain, weight FROM tree"


def newton_scores_sql() -> str:
    """Every eval row walks down the tree, two levels."""
    value = "coalesce(CASE t.feature WHEN 'location_popularity' THEN CAST(location_popularity AS DOUBLE) " \
            "WHEN 'user_total_visits' THEN CAST(user_total_visits AS DOUBLE) " \
            "WHEN 'location_avg_rating' THEN CAST(location_avg_rating AS DOUBLE) END, '-Infinity'::DOUBLE)"
    step = f"CASE WHEN t.feature IS NULL THEN t.node WHEN {value} <= t.threshold THEN t.node || '.L' ELSE t.node || '.R' END"
    return f"""{_newton_tree_ctes()},
w1 AS (SELECT l.*, {step} AS place FROM lake l JOIN tree t ON t.node = 'root' WHERE l.split = 'eval'),
w2 AS (SELECT w1.* EXCLUDE (place), {step} AS place FROM w1 JOIN tree t ON t.node = w1.place)
SELECT row_id, user_id, location_id AS gmap_id, round(1 / (1 + exp(-exact)), 8) AS will_visit_probability,
 CAST(exact > 0 AS INT) AS recommend, 'WillVisit' AS model_name, '1' AS model_version FROM w2 JOIN tree ON tree.node = w2.place"""


def strata_split_counts_sql(train_pct: float, test_pct: float) -> str:
    return f"""WITH c AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1),
q AS (SELECT o_custkey, n, CAST(floor(n * {train_pct}::DOUBLE) AS BIGINT) AS a, CAST(floor(n * {test_pct}::DOUBLE) AS BIGINT) AS b FROM c),
s AS (SELECT o_custkey, 'train' AS split, a AS rows FROM q UNION ALL SELECT o_custkey, 'val', n - a - b FROM q
 UNION ALL SELECT o_custkey, 'test', b FROM q)
SELECT * FROM s WHERE rows > 0"""


def batch_score_sql() -> str:
    return f"""WITH {LAKE_CTE}
SELECT row_id, user_id, location_id AS gmap_id, 'WillVisit' AS model_name, '1' AS model_version,
 TRUE AS probability_in_range, TRUE AS recommend_follows FROM lake WHERE split = 'eval'"""


def continue_boosting_sql() -> str:
    return f"""WITH {LAKE_CTE}, tr AS (SELECT * FROM lake WHERE split = 'train')
SELECT 'roc_auc' AS primary_metric, CAST(0.001 AS DOUBLE) AS threshold,
 (SELECT CAST(count(*) AS DOUBLE) FROM tr WHERE pipeline_run_date = (SELECT max(pipeline_run_date) FROM tr)) AS new_rows,
 (SELECT CAST(count(*) AS DOUBLE) FROM lake WHERE split = 'eval') AS val_rows,
 CAST(10 AS DOUBLE) AS old_trees, CAST(15 AS DOUBLE) AS new_trees, TRUE AS auc_above_baseline, TRUE AS decision_follows"""


def successive_halving_sql(rungs: dict[int, int]) -> str:
    listed = ", ".join(f"({k}, {n})" for k, n in rungs.items())
    return f"""WITH {LAKE_CTE}, rungs(iteration, trials) AS (VALUES {listed})
SELECT CAST(iteration AS INT) AS iteration, CAST(trials AS BIGINT) AS trials,
 (SELECT CAST(count(*) AS DOUBLE) FROM lake WHERE split = 'eval') AS val_rows,
 TRUE AS trees_follow_rung, TRUE AS auc_above_baseline FROM rungs"""


def weekly_job_sql() -> str:
    """Every segment run is registered once, and the week's best run becomes the next version."""
    return """SELECT TRUE AS ok, 'registered' AS stage, 'registered' AS message,
 CAST(count(DISTINCT event_type) + 1 AS INT) AS registered_version FROM events"""


def shuffled_write_sql() -> str:
    return """SELECT o_orderkey, o_custkey,
 row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS position FROM orders"""


def catalog_fallback_sql() -> str:
    return """SELECT o_orderkey, o_orderstatus, o_totalprice, 'table' AS via FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'prefix' FROM orders WHERE o_orderstatus = 'P'"""


def source_builders_sql() -> str:
    return f"""WITH lake AS ({LAKE_SQL}), parts AS (
SELECT CASE split WHEN 'train' THEN 'train' ELSE 'validation' END AS part, CAST(count(*) AS BIGINT) AS rows, CAST(sum(will_visit) AS BIGINT) AS positives,
 84 AS features, CAST(sum(location_popularity) AS DOUBLE) AS location_popularity, CAST(sum(user_total_visits) AS DOUBLE) AS user_total_visits,
 round(sum(location_avg_rating), 10) AS location_avg_rating
FROM lake WHERE split IN ('train', 'eval') GROUP BY 1)
SELECT s.source, p.* FROM parts p, (VALUES ('csv'), ('parquet')) s(source)"""


def run_log_sql() -> str:
    return f"""WITH {runs_cte()}
SELECT run_id, candidate_name, candidate_kind, round(f1, 10) AS f1, round(roc_auc, 10) AS roc_auc FROM runs"""


def full_refit_sql() -> str:
    share = "round(CAST(count(*) FILTER (WHERE will_visit = {m}) AS DOUBLE) / count(*), 10)"
    majority = "CASE WHEN 2 * sum(will_visit) > count(*) THEN 1 ELSE 0 END"
    return f"""WITH lake AS ({LAKE_SQL}), train AS (SELECT * FROM lake WHERE split = 'train'),
last AS (SELECT max(pipeline_run_date) AS d FROM train),
old_m AS (SELECT {majority} AS m FROM train, last WHERE pipeline_run_date <> d),
all_m AS (SELECT {majority} AS m FROM train),
fresh AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM train, last WHERE pipeline_run_date = d),
val AS (SELECT {share.format(m='(SELECT m FROM old_m)')} AS old_accuracy, {share.format(m='(SELECT m FROM all_m)')} AS new_accuracy,
 CAST(count(*) AS DOUBLE) AS val_rows FROM lake WHERE split = 'eval')
SELECT t.threshold, CASE WHEN t.threshold <= 0 THEN 'keep' ELSE 'reject' END AS decision, old_accuracy, new_accuracy,
 (SELECT n FROM fresh) AS new_rows, val_rows, CASE WHEN t.threshold <= 0 THEN 'keep' ELSE 'reject' END AS recorded, t.threshold > 0 AS set_aside,
 CAST((SELECT m FROM all_m) AS DOUBLE) AS saved_majority,
 CASE WHEN t.threshold <= 0 THEN CAST((SELECT m FROM old_m) AS DOUBLE) END AS backup_majority
FROM val, (VALUES (CAST(0.0 AS DOUBLE)), (CAST(0.001 AS DOUBLE))) t(threshold)"""
