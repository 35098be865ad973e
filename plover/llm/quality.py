"""Quality classifier: compressed sizes under dictionaries of good and of bad text.

Two zstandard dictionaries are built from labelled text. A text is compressed in
blocks with each of them; the difference of the two totals per byte of text is
mapped to a probability by a one-variable logistic fit on labelled documents
that no dictionary has seen.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DOUBLE, arrow_batch, fold, texts_of

BLOCK = 1024
#: Bounds of the labelled sample: documents per label for the dictionaries and, apart from them, for
#: the calibration; a document gives at most PASSAGE characters from one place to a dictionary.
PER_LABEL, CALIBRATION, PASSAGE, DICTIONARY_BYTES = 1500, 1000, 2048, 110 * 1024
_READY: dict[tuple, list] = {}


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float


def build_dictionary(samples: list[str]) -> bytes:
    """A zstandard dictionary of the samples; too little text to train on: the text itself."""
    import zstandard
    parts = [s.encode("utf-8", "surrogatepass") for s in samples if s]
    if not parts:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


def _compressors(model: QualityModel) -> list:
    import zstandard
    key = (model.good, model.bad)
    if key not in _READY:
        made = []
        for d in key:
            held = zstandard.ZstdCompressionDict(d) if d else None
            if held is not None:
                held.precompute_compress(level=3)
            made.append(zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_dict_id=False)
                        if held is not None else zstandard.ZstdCompressor(write_content_size=False))
        _READY.clear()
        _READY[key] = made
    return _READY[key]


def difference(text: str | None, model: QualityModel) -> float:
    """(size under bad - size under good) per byte, over blocks of the whole text; 0 if empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return 0.0
    good, bad = _compressors(model)
    gap = 0
    for lo in range(0, len(data), BLOCK):
        block = data[lo:lo + BLOCK]
        gap += len(bad.compress(block)) - len(good.compress(block))
    return gap / len(data)


def calibrate(x: np.ndarray, y: np.ndarray, prior: float | None = None) -> tuple[float, float]:
    """Slope and intercept of P(1 | x); ``prior`` is the share of label 1 outside the sample."""
    if len(x) == 0 or y.min() == y.max():
        p = min(max(prior if prior is not None else 0.5, 1e-3), 1 - 1e-3)
        return 0.0, math.log(p / (1 - p))
    scale = float(np.std(x)) or 1.0
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, z.T @ (weight * (y - p)) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    shift = 0.0 if prior is None else math.log(prior / (1 - prior))
    return float(w[0] / scale), float(w[1] + shift)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", seed: int = 1) -> QualityModel:
    """Fit on a bounded sample of the labelled documents given (the caller leaves out held-out rows).

    The sample is the smallest seeded hashes of the ids, so it is the same on
    every run. Null ids, labels other than 0 and 1 and null texts are not
    sampled. Without rows of both labels the score is the share of label 1.
    """
    known = (labels.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).cast("int").alias("y"))
             .filter("i is not null and y in (0, 1)").distinct())
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    order = F.xxhash64(F.lit(seed), "i")
    part = F.pmod(F.xxhash64(F.lit(seed + 1), "i"), F.lit(5))
    take = lambda y, where, n: known.filter((F.col("y") == y) & where).orderBy(order, "i").limit(n)
    chosen = take(0, part > 1, PER_LABEL).union(take(1, part > 1, PER_LABEL)).withColumn("use", F.lit(0)).union(
        take(0, part <= 1, CALIBRATION).union(take(1, part <= 1, CALIBRATION)).withColumn("use", F.lit(1)))
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).filter("t is not null")
    met = rows.join(F.broadcast(chosen), "i")  # at most 2 * (PER_LABEL + CALIBRATION) rows
    room = F.greatest(F.length("t") - PASSAGE, F.lit(0))
    at = (F.pmod(F.xxhash64(F.lit(seed + 2), "i"), room + 1) + 1).cast("int")
    passages = met.filter("use = 0").select("y", F.substring(F.col("t"), at, F.lit(PASSAGE)).alias("p")).orderBy("y", "p").collect()
    model = QualityModel(*(build_dictionary([r["p"] for r in passages if r["y"] == y]) for y in (1, 0)), 0.0, 0.0)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"y": f["y"], "x": [difference(t, model) for t in f["t"]]})

    seen = met.filter("use = 1").select("y", "t").mapInPandas(measure, "y int, x double").orderBy("x", "y").collect()
    slope, intercept = calibrate(np.array([r["x"] for r in seen]), np.array([r["y"] for r in seen], dtype=float), prior)
    return QualityModel(model.good, model.bad, slope, intercept)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size_difference, score`` for every row of ``docs``.

    The whole text counts, in blocks of 1 KB. Null and empty texts have
    difference 0. Null and repeated ids pass through. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            x = np.array([difference(t, model) for t in f["t"].to_pylist()], dtype=float)
            p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.intercept, -500, 500)))
            yield arrow_batch({"doc_id": f["doc_id"], "size_difference": x, "score": p},
                              {"size_difference": DOUBLE, "score": DOUBLE})

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, size_difference double, score double")


def held_out(parts: int, remainder: int, id_col: str = "doc_id"):
    return fold(id_col, parts) == F.lit(remainder)
