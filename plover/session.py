"""Session defaults and checkpoint-directory handling."""
from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # 84 feature columns plus keys and target sit just under the default of 100.
    "spark.sql.codegen.maxFields": "200",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Jobs that run side by side share the executors evenly.
    "spark.scheduler.mode": "FAIR",
}


def build_session(master: str | None = None, app_name: str = "plover",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> SparkSession:
    """Set the SQL defaults on an existing session (the driver may hand us one)."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.maxFields"):
        try:
            spark.conf.set(key, SESSION_DEFAULTS[key])
        except Exception:  # pragma: no cover - static conf on some clusters
            pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="plover-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/plover-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_small, _batches = {"uses": 0, "before": None}, threading.Lock()


def small_batches(spark: SparkSession, use: int) -> None:
    """From the first use (1) to the end of the last one (-1) Arrow batches are of some 4 MB: a task's Python side
    works on one while the next is on its way, instead of waiting for its whole partition."""
    with _batches:
        if use > 0 and _small["uses"] == 0:
            _small["before"] = spark.conf.get(_BATCH_BYTES, None)
            spark.conf.set(_BATCH_BYTES, "4m")
        _small["uses"] += use
        if _small["uses"] == 0:
            if _small["before"] is None:
                spark.conf.unset(_BATCH_BYTES)
            else:
                spark.conf.set(_BATCH_BYTES, _small["before"])


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], Any]], at_once: int) -> list:
    """Results of ``jobs`` in their order, ``at_once`` of them running at a time, each in a scheduler pool of its own.

    Small jobs wait for planning and stragglers most of the time; run side by
    side they fill each other's gaps. The caller's thread properties hold in
    every job. All jobs end before the first error is raised.
    """
    if at_once <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    sc = spark.sparkContext

    def pooled(number: int, job: Callable[[], Any]) -> Callable[[], Any]:
        def run() -> Any:
            sc.setLocalProperty("spark.scheduler.pool", f"plover-{number}")
            return job()
        return inheritable_thread_target(run)

    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(pooled(k, job)) for k, job in enumerate(jobs)]
    return [r.result() for r in running]


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
