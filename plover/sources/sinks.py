"""Sinks: split CSVs, partitioned split tables, dated copies, model artifacts
routed by the gate, decision sidecars, run records and leaderboard text."""
from __future__ import annotations

import uuid
from datetime import datetime, timezone
from typing import Sequence
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import seeded_hash
from ..session import default_partitions, ensure_checkpoint_dir

RUNS_SCHEMA = ("run_id string, experiment string, start_time timestamp, tags map<string,string>, "
               "params map<string,string>, metrics map<string,double>")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a
    machine-local temp folder)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/plover-scratch/{name}-{uuid.uuid4().hex[:12]}"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def write_csv_pair(train: DataFrame, val: DataFrame, out_dir: str) -> tuple[str, str]:
    out = out_dir.rstrip("/")
    return write_csv(train, f"{out}/train"), write_csv(val, f"{out}/val")


def write_splits(tagged: DataFrame, out_dir: str, fmt: str = "parquet", split_col: str = "split") -> str:
    """All splits in one job, one folder per split value."""
    writer = tagged.write.mode("overwrite").partitionBy(split_col)
    if fmt == "csv":
        writer.option("header", True).csv(out_dir)
    else:
        writer.format(fmt).save(out_dir)
    return out_dir


def dated_path(base: str, run_date: str | None = None) -> str:
    day = run_date or datetime.now(timezone.utc).strftime("%Y-%m-%d")
    return f"{base.rstrip('/')}/run_date={day}"


def write_dated_copy(df: DataFrame, base: str, run_date: str | None = None, fmt: str = "parquet") -> str:
    path = dated_path(base, run_date)
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def model_path(artifact_dir: str, name: str, registered: bool) -> str:
    base = artifact_dir.rstrip("/")
    return f"{base}/{name}" if registered else f"{base}/_rejected/{name}"


def save_model(model, artifact_dir: str, name: str, registered: bool) -> str:
    """Registered models go to ``<dir>/<name>``; rejected ones to
    ``<dir>/_rejected/<name>``."""
    path = model_path(artifact_dir, name, registered)
    model.write().overwrite().save(path)
    return path


def save_retrained(model, old_model, artifact_dir: str, name: str, keep: bool, stamp: str) -> dict:
    """Keep: back up the old model to ``_backup/<name>_prev_<stamp>`` and
    replace; reject: store the new one as ``_rejected/<name>_rejected_<stamp>``."""
    base = artifact_dir.rstrip("/")
    if keep:
        backup = f"{base}/_backup/{name}_prev_{stamp}"
        if old_model is not None:
            old_model.write().overwrite().save(backup)
        model.write().overwrite().save(f"{base}/{name}")
        return {"saved": f"{base}/{name}", "backup": backup}
    rejected = f"{base}/_rejected/{name}_rejected_{stamp}"
    model.write().overwrite().save(rejected)
    return {"saved": rejected, "backup": None}


def append_json(df: DataFrame, path: str) -> str:
    df.write.mode("append").json(path)
    return path


def append_runs(runs: DataFrame, path: str) -> str:
    """Append run records to the ``runs`` table (parquet)."""
    runs.selectExpr("run_id", "experiment", "start_time", "tags", "params", "metrics") \
        .write.mode("append").parquet(path)
    return path


def write_leaderboard_text(lines: DataFrame, path: str) -> str:
    """Markdown header then ranked rows, as one text output (registry scale)."""
    header = lines.sparkSession.createDataFrame(
        [(-1, "| Candidate | Run link | Code version | Key hyperparams | Key model metrics | "
              "Key training cost metrics | Notes |"),
         (0, "| --- | --- | --- | --- | --- | --- | --- |")], "rank int, line string")
    allrows = header.unionByName(lines.select(F.col("rank").cast("int"), "line"))
    allrows.orderBy("rank").select("line").coalesce(1).write.mode("overwrite").text(path)
    return path


def write_shuffled(df: DataFrame, path: str, key_cols: Sequence[str], seed: int = 42, parts: int | None = None,
                   rank: Column | None = None) -> str:
    """Rows in the order of a seeded rank of their key (ties: the key), as files that give this order when read by part number.

    ``rank`` defaults to the seeded hash. The order depends on rank and key
    only: neither the input's partitions nor ``parts`` change it, and no task
    holds more than its range.
    """
    ranked = df.withColumn("_rank", rank if rank is not None else seeded_hash(seed, *key_cols))
    order = ["_rank", *key_cols]
    ranked.repartitionByRange(parts or default_partitions(df.sparkSession), *order).sortWithinPartitions(*order) \
        .drop("_rank").write.mode("overwrite").parquet(path)
    return path


def read_shuffled(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`write_shuffled` with their 0-based ``position``: rows of earlier files (one row per file) and the place in the own one."""
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    rows = spark.read.parquet(path).select("*", name.alias("_file"), row.alias("_row"))
    sizes = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    earlier = Window.orderBy(F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(before, "_file").withColumn("position", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def claim_version(spark: SparkSession, claims: str, model_name: str, least: int = 1) -> int:
    """The next free version number of a model, given to one caller only.

    Each number is an empty file that is created exclusively; a caller that
    comes second takes the next one. A caller lost after its claim leaves an
    unused number. The file system must create files exclusively (HDFS and
    local ones do).
    """
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    folder = Path(f"{claims.rstrip('/')}/{quote(model_name, safe='')}")
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    taken = [int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()]
    number = max([least - 1, *taken]) + 1
    while True:
        path = Path(folder, f"{number:09d}")
        try:
            if fs.getScheme() == "file":
                # Hadoop's local file system checks and creates in two steps.
                local = jvm.java.nio.file.Paths.get(fs.makeQualified(path).toUri())
                jvm.java.nio.file.Files.createFile(local, sc._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
            else:
                fs.create(path, False).close()
            return number
        except Py4JJavaError as e:
            if not e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise
            number += 1
