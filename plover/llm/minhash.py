"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard check.

One permutation places each word shingle on a ring of 2**32 places; a second
one, shifted by one place per coordinate, gives every signature coordinate, so
two permutations make a signature of any length. Bands of the signature bring
candidates together and each candidate pair is confirmed on the full shingle
sets before it counts as a link.

Documents with equal shingle sets are one node from the start, so a group of
exact copies is one row in every later step. Inside a band bucket members are
first compared with one pivot each, a linear number of pairs; components merge
what is linked, and only members that still lie in different components are
compared further, in blocks of bounded size held by one task.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BINARY, LONG, arrow_batch, fresh, mix64, salts, shared, shingle_sets, stream64, texts_of, written
from .components import connected_components

SHINGLE, BANDS, ROWS = 5, 28, 4
#: A pair at the threshold whose signatures agree on less than this share is not met again in the
#: block step; 4.7 standard deviations of a 112-coordinate signature below 0.8.
LEAST_AGREEMENT = 0.62
_BLOCK = 256


def ring_places(grams: np.ndarray) -> np.ndarray:
    """First permutation: shingle hash to a place on the ring."""
    return (mix64(grams ^ stream64(21, 1)[0]) >> np.uint64(32)).astype(np.uint32)


def _second(y: np.ndarray) -> np.ndarray:
    """Second permutation, a bijection of 32-bit places, in place."""
    y ^= y >> np.uint32(16)
    y *= np.uint32(0x7FEB352D)
    y ^= y >> np.uint32(15)
    y *= np.uint32(0x846CA68B)
    y ^= y >> np.uint32(16)
    return y


def signature(grams: np.ndarray, length: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k is the least second-permutation value over all places shifted by k."""
    shift = np.arange(1, length + 1, dtype=np.uint32)
    best = np.full(length, 0xFFFFFFFF, dtype=np.uint32)
    places = ring_places(grams)
    for lo in range(0, len(places), _BLOCK):
        np.minimum(best, _second(places[lo:lo + _BLOCK, None] + shift).min(axis=0), out=best)
    return best


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
           length: int = BANDS * ROWS) -> DataFrame:
    """``doc_id, n_shingles, set_key, sig``; the last two are null where there is no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            sets = shingle_sets(f["t"].to_pylist(), size)
            yield arrow_batch({
                "doc_id": f["doc_id"], "n_shingles": [len(s) for s in sets],
                "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "sig": [signature(s, length).tobytes() if len(s) else None for s in sets]},
                {"n_shingles": LONG, "set_key": BINARY, "sig": BINARY})

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary")


def _bands(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    width = 4 * rows
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                       lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * width + 1, F.lit(width))))
    return classes.select("rep", F.posexplode(keys).alias("band", "key"))


def _confirm(texts: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets satisfy 100 * shared >= percent * union.

    Every task meets a pivot ``a`` with up to 256 of its partners; a pivot with
    more of them is repeated per salt.
    """
    count = pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("n", salts(F.col("n"), 256))
    left = count.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("salt"),
                        F.col("a").alias("b"))
    right = pairs.join(count, "a").select("a", F.pmod(F.xxhash64("b"), F.col("n")).alias("salt"), "b")
    rows = left.union(right).join(texts, F.col("b") == texts["rep"]).select("a", "salt", "b", "t")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, pivot = None, None
        for f in frames:
            sets = shingle_sets(f["t"].tolist(), size)
            a_out, b_out = [], []
            for a, salt, b, s in zip(f["a"].tolist(), f["salt"].tolist(), f["b"].tolist(), sets):
                if a == b:
                    at, pivot = (a, salt), s
                elif at == (a, salt):
                    n = shared(pivot, s)
                    if n and 100 * n >= percent * (len(pivot) + len(s) - n):
                        a_out.append(a)
                        b_out.append(b)
            yield pd.DataFrame({"a": a_out, "b": b_out}, dtype="int64")

    met = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", (F.col("a") != F.col("b")).cast("int"))
    return met.mapInPandas(run, "a long, b long")


def _across(members: DataFrame, texts: DataFrame, size: int, rows: int, percent: int) -> DataFrame:
    """Links between members of one bucket that still lie in different components.

    A bucket is cut into blocks of at most 2,000 members and 32 MB of text; a
    task compares two blocks. Sizes and signatures rule out most pairs, the rest
    is compared on full sets, the most alike first. A link merges components at
    once, so a task writes a spanning set of links, and what is merged is not
    compared again. A pair is left to the first band that it shares.
    """
    load = members.groupBy("key").agg(F.count("*").alias("m"), F.sum("chars").alias("c")).select(
        "key", F.greatest(salts(F.col("m"), 2000), salts(F.col("c"), 32 << 20)).alias("parts"))
    own = members.join(load, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")))
    placed = own.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    placed = placed.select("key", "band", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "rep", "component", "sig")

    def run(key: tuple, f: pa.Table) -> pa.Table:
        _, band, i, j = (k.as_py() for k in key)
        sig = np.frombuffer(b"".join(f["sig"].to_pylist()), dtype=np.uint32).reshape(len(f), -1)
        rep, comp, own = (f[c].to_numpy() for c in ("rep", "component", "own"))
        sets = shingle_sets(f["t"].to_pylist(), size)
        n = np.array([len(x) for x in sets])
        comp = np.unique(comp, return_inverse=True)[1]
        out = []
        for x in np.flatnonzero(own == i):
            y = np.flatnonzero((own == j) & (comp != comp[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])))
            if i == j:
                y = y[y > x]
            agree = sig[y] == sig[x]
            alike = agree.mean(axis=1)
            first = ~agree[:, :band * rows].reshape(len(y), band, rows).all(axis=2).any(axis=1)
            ok = first & (alike >= LEAST_AGREEMENT)
            for k in y[ok][np.argsort(-alike[ok], kind="stable")]:
                if comp[k] == comp[x]:
                    continue
                both = shared(sets[x], sets[k])
                if both and 100 * both >= percent * (n[x] + n[k] - both):
                    out.append((rep[x], rep[k]))
                    comp[comp == comp[k]] = comp[x]
        return pa.table({"a": pa.array([a for a, _ in out], LONG), "b": pa.array([b for _, b in out], LONG)})

    full = placed.join(texts, "rep").select("key", "band", "i", "j", "own", "rep", "component", "sig", "t")
    return full.groupBy("key", "band", "i", "j").applyInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked when ``100 * shared >= percent * union`` on their
    sets of distinct ``size``-word shingles (lower-cased A-Z; fewer words: the
    whole sequence; no word, empty or null text: an empty set, linked with
    nothing). ``component_id`` is the smallest id reachable over links, ``kept``
    marks it. Rows that share an id are one document. A row with a null id takes
    the component of its equals and is kept only where it has none. Ids are cast
    to long; other columns are ignored. Empty table: empty result. A linked pair
    at exactly 0.8 shares no band with probability 4e-7.
    """
    own = written(sketch(docs, id_col, text_col, size, bands * rows), "sketch")
    classes = (own.filter("set_key is not null").groupBy("set_key")
               .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("sig").alias("sig")))
    known = written(classes.filter("rep is not null"), "classes")
    banded = _bands(known, bands, rows)
    buckets = (banded.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("most"))
               .filter("pivot <> most").select("key", "pivot"))
    members = written(banded.join(buckets, "key"), "members")
    wanted = members.select("rep").distinct()
    # Rows that repeat an id with other text are one document here; the link of either counts.
    texts = written(docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("t"))
                    .join(wanted, "rep", "left_semi"), "texts")
    first = _confirm(texts, members.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
                     .distinct(), size, percent)
    links = written(first, "links")
    merged = connected_components(links)
    # Every pair with a pivot is decided; what is left lies between the other members of a bucket.
    placed = (members.filter("rep <> pivot").select("key", "band", "rep").join(merged, F.col("rep") == F.col("node"), "left")
              .select("key", "band", "rep", F.coalesce("component", "rep").alias("component")))
    open_keys = (placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .filter("lo <> hi").select("key"))
    about = known.select("rep", "sig").join(texts.groupBy("rep").agg(F.max(F.length("t")).alias("chars")), "rep")
    rest = written(placed.join(open_keys, "key", "left_semi").join(about, "rep"), "open")
    more = written(_across(rest, texts, size, rows, percent), "links")
    final = connected_components(links.union(more))
    by_set = (known.select("set_key", "rep").join(final, F.col("rep") == F.col("node"), "left")
              .select("set_key", F.coalesce("component", "rep").alias("component")))
    out = own.select("doc_id", "n_shingles", "set_key").join(by_set, "set_key", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      (F.col("doc_id").eqNullSafe(component)).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose document is kept, all columns unchanged (their names may be any)."""
    keep, = fresh(docs, "_keep")
    groups = near_groups(docs, id_col, text_col, **options)
    stay = groups.filter("kept").select(F.col("doc_id").alias(keep)).distinct()
    return docs.join(stay, F.col(id_col).cast("long").eqNullSafe(F.col(keep)), "left_semi")
