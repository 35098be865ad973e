"""Table access for the registered queries: the driver's parquet tables and
the lake-shaped adapter that Spark derives from them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spread(spark.read.parquet(path), key=path)


# Scan partition counts per path: planning a scan to count its splits costs a
# file listing, and the registered queries read the same tables repeatedly.
_SCAN_PARTS: dict = {}


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Scans of few large files give fewer tasks than cores (a single-row-group
    file is one task). Only then add a round-robin repartition to the
    cluster's parallelism; scans that are already split are left alone."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if key is None or key not in _SCAN_PARTS:
        n = df.rdd.getNumPartitions()
        if key is not None:
            _SCAN_PARTS[key] = n
    else:
        n = _SCAN_PARTS[key]
    if n < target:
        return df.repartition(target)
    return df


def _pref_text(user_id_col: str) -> F.Column:
    parts = ", ".join(f"concat('0.', lpad(CAST(({user_id_col} * 7 + {i * 13}) % 100 AS STRING), 2, '0'))"
                      for i in range(20))
    return F.expr(f"concat('[', concat_ws(', ', {parts}), ']')")


#: Lake rows of one partition at most: a row has some 50 bytes here and over 1 KB as features that a fit holds and reads again.
ROWS_A_PART = 100_000


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake-schema training rows built from ``events`` x ``part`` (one row per
    event): list columns as JSON text with malformed and edge values mixed in,
    a ``split`` flag, weekly ``pipeline_run_date`` and epoch-ms ``time``.

    Partitions are counted in rows, while these are still narrow: a join sized
    by its bytes would leave a few partitions to the wide rows of every fit."""
    e = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    parts = max(spark.sparkContext.defaultParallelism, -(-e.count() // ROWS_A_PART))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    n_part = p.select(F.count(F.lit(1))).scalar()
    e = e.withColumn("__pk", (F.col("event_id") * 13) % n_part)
    j = e.join(p, e["__pk"] == p["p_partkey"], "inner").select("p_partkey", "p_size", "event_id", "ts", "user_id", "value", "props").repartition(parts)
    pk = F.col("p_partkey")
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    cat_pos = (pk % 21).cast("int")
    vibe_ones = (pk % 20).cast("int")
    vibe = (F.when(eid % 97 == 0, F.lit(None).cast("string"))
            .when(eid % 97 == 1, F.lit("[1, 0"))
            .when(eid % 97 == 2, F.col("props"))
            .when(eid % 97 == 3, F.lit("[1, 1]"))
            .when(eid % 97 == 4, F.lit("[]"))
            .when(eid % 97 == 5, F.concat(F.lit("[1"), F.repeat(F.lit(", 1"), 24), F.lit("]")))
            .when(eid % 97 == 6, F.lit("[1, null, 1]"))
            .otherwise(F.concat(F.lit("["), F.repeat(F.lit("1, "), vibe_ones),
                                F.repeat(F.lit("0, "), 19 - vibe_ones), F.lit("1]"))))
    run_date = (F.when(ts < F.lit("2024-01-08").cast("timestamp"), F.lit("2024-01-07"))
                .when(ts < F.lit("2024-01-15").cast("timestamp"), F.lit("2024-01-14"))
                .when(ts < F.lit("2024-01-22").cast("timestamp"), F.lit("2024-01-21"))
                .otherwise(F.lit("2024-01-28")))
    return j.select(
        eid.alias("row_id"),
        F.col("user_id").cast("string").alias("user_id"),
        pk.cast("string").alias("location_id"),
        F.unix_millis(ts).alias("time"),
        F.concat(F.lit("["), F.repeat(F.lit("0, "), cat_pos), F.lit("1"),
                 F.repeat(F.lit(", 0"), 20 - cat_pos), F.lit("]")).alias("location_category_encoded"),
        F.when(eid % 31 == 0, F.lit(None).cast("double"))
         .otherwise(1 + (pk % 41) / F.lit(10.0)).alias("location_avg_rating"),
        F.col("p_size").alias("location_popularity"),
        vibe.alias("location_vibe_tags"),
        (F.col("user_id") % 60).cast("int").alias("user_total_visits"),
        _pref_text("user_id").alias("user_personal_preferences"),
        F.when(F.col("p_size") + F.col("value") / 10 > 20, 1).otherwise(0).alias("will_visit"),
        F.when(eid % 53 == 0, F.lit("holdout"))
         .when(ts >= F.lit("2024-01-25").cast("timestamp"), F.lit("eval"))
         .otherwise(F.lit("train")).alias("split"),
        run_date.alias("pipeline_run_date"),
        F.lit(1).cast("bigint").alias("snapshot_id"),
    )


# The same adapter for DuckDB (oracle side); {REST} lets callers add columns.
LAKE_SQL = """
SELECT e.event_id AS row_id, CAST(e.user_id AS VARCHAR) AS user_id, CAST(p.p_partkey AS VARCHAR) AS location_id,
 epoch_us(e.ts)//1000 AS time,
 concat('[', repeat('0, ', CAST(p.p_partkey%21 AS INT)), '1', repeat(', 0', CAST(20-p.p_partkey%21 AS INT)), ']') AS location_category_encoded,
 CASE WHEN e.event_id%31=0 THEN NULL ELSE CAST(1+(p.p_partkey%41)/CAST(10 AS DOUBLE) AS DOUBLE) END AS location_avg_rating,
 p.p_size AS location_popularity,
 CASE e.event_id%97 WHEN 0 THEN NULL WHEN 1 THEN '[1, 0' WHEN 2 THEN e.props WHEN 3 THEN '[1, 1]' WHEN 4 THEN '[]'
  WHEN 5 THEN concat('[1', repeat(', 1',24), ']') WHEN 6 THEN '[1, null, 1]'
  ELSE concat('[', repeat('1, ', CAST(p.p_partkey%20 AS INT)), repeat('0, ', CAST(19-p.p_partkey%20 AS INT)), '1]') END AS location_vibe_tags,
 CAST(e.user_id%60 AS INT) AS user_total_visits,
 concat('[', concat_ws(', ', {PREF}), ']') AS user_personal_preferences,
 CASE WHEN p.p_size+e.value/10 > 20 THEN 1 ELSE 0 END AS will_visit,
 CASE WHEN e.event_id%53=0 THEN 'holdout' WHEN e.ts >= CAST('2024-01-25' AS TIMESTAMP) THEN 'eval' ELSE 'train' END AS split,
 CASE WHEN e.ts < CAST('2024-01-08' AS TIMESTAMP) THEN '2024-01-07' WHEN e.ts < CAST('2024-01-15' AS TIMESTAMP) THEN '2024-01-14'
  WHEN e.ts < CAST('2024-01-22' AS TIMESTAMP) THEN '2024-01-21' ELSE '2024-01-28' END AS pipeline_run_date,
 CAST(1 AS BIGINT) AS snapshot_id
FROM events e JOIN part p ON p.p_partkey = (e.event_id*13) % (SELECT count(*) FROM part)
""".replace("{PREF}", ", ".join(
    f"concat('0.', lpad(CAST((e.user_id*7 + {i}*13) % 100 AS VARCHAR), 2, '0'))" for i in range(20)))
