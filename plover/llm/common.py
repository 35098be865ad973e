"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

WHITE = "\\x20\\x09-\\x0D"


def written(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts lineage without a second computation (``checkpoint()`` runs the last
    stage twice) and survives the loss of any executor.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/plover-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def arrow_batch(columns: dict, types: dict) -> pa.RecordBatch:
    """A record batch; columns are Arrow arrays or sequences, nulls and large integers stay exact."""
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=types[n]) for n, c in columns.items()]
    return pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays],
                                      names=list(columns))


LONG, INT, DOUBLE, STRING, BINARY = pa.int64(), pa.int32(), pa.float64(), pa.string(), pa.binary()


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, t``: the two columns an operator reads, under names of its own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``df`` has no column so called (case aside)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(id_col: str, parts: int) -> Column:
    """``crc32`` of the id written as text, modulo ``parts`` (a null id counts as '')."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % F.lit(parts)


def salts(count: Column, per_salt: int) -> Column:
    """How many salts a group of ``count`` rows is split into."""
    return F.greatest(F.lit(1), F.ceil(count / F.lit(per_salt))).cast("long")


# ---- 64-bit mixing on numpy arrays --------------------------------------------------------------

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with good avalanche (xor-shift, multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream64(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words for ``seed``."""
    with np.errstate(over="ignore"):
        base = np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
        return mix64(base + _U(seed) * _U(0xD1342543DE82EF95))


_SEGMENT = 1 << 20
_BYTE = stream64(11, 256)
_BASE = int(stream64(12, 1)[0]) | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, _SEGMENT) + 1
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            table = np.full(size, _U(base))
            table[0] = 1
            _POWERS[key] = np.multiply.accumulate(table)
    return _POWERS["up"], _POWERS["down"]


def _segments(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut the buffer at white space, about every megabyte (a longer word stays whole)."""
    lo = 0
    while lo < len(buf):
        hi = min(len(buf), lo + _SEGMENT)
        while hi < len(buf):
            found = np.flatnonzero(_IS_SPACE[buf[hi:hi + 65536]])
            if len(found):
                hi += int(found[0])
                break
            hi = min(len(buf), hi + 65536)
        yield lo, hi
        lo = hi


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after, 64-bit hash) of each maximal run without white space, in order."""
    buf = np.frombuffer(data, dtype=np.uint8)
    starts, ends, hashes = [], [], []
    for lo, hi in _segments(buf):
        seg = buf[lo:hi]
        inside = np.empty(len(seg) + 2, dtype=np.int8)
        inside[0] = inside[-1] = 0
        inside[1:-1] = ~_IS_SPACE[seg]
        edge = np.diff(inside)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(first):
            continue
        up, down = _powers(len(seg))
        prefix = np.zeros(len(seg) + 1, dtype=_U)
        np.cumsum(_BYTE[seg] * up[:len(seg)], out=prefix[1:])
        h = (prefix[last] - prefix[first]) * down[first]
        hashes.append(mix64(h + (last - first).astype(_U)))
        starts.append(first + lo)
        ends.append(last + lo)
    if not starts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=_U)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``size``-word shingles.

    Words are the maximal runs without ``[\\x20\\x09-\\x0D]`` after lower-casing
    A-Z. Fewer words than ``size``: the whole sequence is the one shingle. No
    word or no text: empty.
    """
    out: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0
    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass").lower()
        if held and held + len(b) > _SEGMENT:
            out.extend(_shingle_group(group, size))
            group, held = [], 0
        group.append(b)
        held += len(b) + 1
    out.extend(_shingle_group(group, size))
    return out


def _shingle_group(group: list[bytes], size: int) -> list[np.ndarray]:
    if not group:
        return []
    ends = np.cumsum([len(b) + 1 for b in group])
    starts, _, words = word_hashes(b" ".join(group))
    cuts = np.searchsorted(starts, ends)  # words of text i: [cuts[i-1], cuts[i])
    weight = stream64(13, size) | _U(1)
    n = len(words) - size + 1
    if n > 0:
        total = words[:n] * weight[0]
        for j in range(1, size):
            total = total + words[j:j + n] * weight[j]
        grams = mix64(total)
    out, lo = [], 0
    for hi in cuts.tolist():
        if hi - lo >= size:
            out.append(np.unique(grams[lo:hi - size + 1]))
        elif hi > lo:
            short = np.array([hi - lo], dtype=_U) * _U(0x9E3779B97F4A7C15)
            out.append(mix64(short + (words[lo:hi] * weight[:hi - lo]).sum(dtype=_U)))
        else:
            out.append(np.empty(0, dtype=_U))
        lo = hi
    return out


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def release_memory() -> None:
    """Give freed memory back to the system at the end of a task; Python workers live on for later stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it trims on its own terms
        pass


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``spark-submit --py-files`` would."""
    import os
    import tempfile
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="plover-py-"), "plover.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "plover")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
