"""Source divergence audit by single-pass in-memory indexing.

A task reads texts once and builds block postings in memory; when the block is
full it is spilled as a run sorted by (language, term) and the next begins. Runs
are dealt to hash shards of (language, term); inside a shard the sort's merge of
its runs (Spark's external sort, a heap merge that spills) brings a term's
postings together, and one streaming pass adds them up to frequencies and keeps
the terms of enough documents. Shares are exact integers. Pairs of sources start
from the distance that all absent terms would give, and a second streaming pass
over the postings adds the corrections of the terms that do occur.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LONG, STRING, arrow_batch, release_memory, written

LEAST_DOCS, TOP, SMOOTH, SCALE = 30, 50, 5, 1_000_000_000
BLOCK_BYTES = 8 << 20  # of text in one in-memory block; a longer text is a block of its own
_PAIRS = 1 << 20  # pairs of postings corrected at once
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms_of(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of the texts in order (dictionary encoded) and the text that each stands in."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    buf = _LOWER[np.frombuffer(b" ".join(parts), dtype=np.uint8)]
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = _IN_TERM[buf]
    edge = np.diff(inside)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.append(0, np.cumsum(last - first))
    data = buf[inside[1:-1] == 1]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    ends = np.cumsum([len(p) + 1 for p in parts])
    return words.dictionary_encode(), np.searchsorted(ends, first, side="right")


def _block(langs: list[str], sources: list[str], texts: list[str]) -> pa.RecordBatch | None:
    """Postings of one block: ``lang, term, source, n, d`` sorted by language and term."""
    coded, at = terms_of(texts)
    if not len(at):
        return None
    groups = sorted(set(zip(langs, sources)))
    number = {g: k for k, g in enumerate(groups)}
    group = np.array([number[g] for g in zip(langs, sources)], dtype=np.int64)
    vocabulary = coded.dictionary.cast(pa.binary())
    place = np.empty(len(vocabulary), dtype=np.int64)  # rank of each term in byte order
    order = pc.sort_indices(vocabulary).to_numpy()
    place[order] = np.arange(len(order))
    term = place[coded.indices.to_numpy()]
    key = group[at] * len(order) + term
    found, n = np.unique(key, return_counts=True)
    once = np.unique(at * len(order) + term)  # each term once a document
    d = np.bincount(np.searchsorted(found, group[once // len(order)] * len(order) + once % len(order)), minlength=len(found))
    g, t = np.divmod(found, len(order))
    lang_rank = np.searchsorted(sorted({x for x, _ in groups}), [x for x, _ in groups])
    run = np.lexsort((g, t, lang_rank[g]))
    g, t = g[run], t[run]
    return arrow_batch({"lang": pa.array([x for x, _ in groups]).take(pa.array(g)), "term": vocabulary.take(pa.array(order[t])).cast(pa.string()),
                        "source": pa.array([x for _, x in groups]).take(pa.array(g)), "n": n[run], "d": d[run]}, {"n": LONG, "d": LONG})


def block_runs(docs: DataFrame) -> DataFrame:
    """``lang, term, source, n, d`` per block: occurrences and documents of a term in a source (``docs``: lang, source, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = ([], [], []), 0

        def spill() -> Iterator[pa.RecordBatch]:
            made = _block(*held) if held[0] else None
            for column in held:
                column.clear()
            if made is not None:
                yield made

        for f in batches:
            for lang, source, text in zip(*(f[c].to_pylist() for c in ("lang", "source", "text"))):
                if size and size + len(text) > BLOCK_BYTES:
                    yield from spill()
                    size = 0
                for column, value in zip(held, (lang, source, text)):
                    column.append(value)
                size += len(text) + 1
        yield from spill()
        release_memory()

    return docs.mapInArrow(run, "lang string, term string, source string, n long, d long")


def _runs_of(f: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    """Where a batch sorted by ``names`` begins another value of them."""
    new = np.zeros(len(f), dtype=bool)
    new[0] = True
    for name in names:
        column = f[name]
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(f) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _whole_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted stream cut so that no (lang, term) is divided; one term's postings are held at most beside a batch."""
    rest: list[pa.RecordBatch] = []
    for f in batches:
        if not len(f):
            continue
        begins = _runs_of(f, ("lang", "term"))
        same = bool(rest) and f["lang"][0] == rest[0]["lang"][0] and f["term"][0] == rest[0]["term"][0]
        if rest and not same:
            yield _joined(rest)
            rest = []
        cut = int(begins[-1])
        if cut and rest:
            head = int(begins[1]) if len(begins) > 1 else len(f)
            yield _joined([*rest, f.slice(0, head)])
            rest = []
            if head < cut:
                yield f.slice(head, cut - head)
        elif cut:
            yield f.slice(0, cut)
        rest.append(f.slice(cut))
    if rest:
        yield _joined(rest)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def frequencies(runs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term, source, n, whole`` of the terms in at least ``least_docs`` documents of their language.

    ``whole`` is the term's count in all of the language. The postings of a term
    are one per block and source, however often it occurs.
    """
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in _whole_terms(batches):
            begins = _runs_of(f, ("lang", "term", "source"))
            terms = np.searchsorted(begins, _runs_of(f, ("lang", "term")))  # first posting of each term
            n = np.add.reduceat(f["n"].to_numpy(), begins)
            d = np.add.reduceat(f["d"].to_numpy(), begins)
            sizes = np.diff(np.append(terms, len(begins)))
            keep = np.repeat(np.add.reduceat(d, terms) >= least_docs, sizes)
            if keep.any():
                at = pa.array(begins[keep])
                yield arrow_batch({**{c: f[c].take(at) for c in ("lang", "term", "source")}, "n": n[keep],
                                   "whole": np.repeat(np.add.reduceat(n, terms), sizes)[keep]}, {"n": LONG, "whole": LONG})

    sharded = runs.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return sharded.mapInArrow(merge, "lang string, term string, source string, n long, whole long")


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept))`` in exact decimals (``kept`` > 0)."""
    big = lambda c: c.cast("decimal(18,0)")
    over = big(count + F.lit(SMOOTH)) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", over, big(total + F.lit(SMOOTH) * kept)) + F.lit(1)


def pair_corrections(postings: DataFrame) -> DataFrame:
    """``lang, a, b, c`` (a < b): what terms that stand in both sources change against each being absent from the other.

    ``postings``: ``lang, term, source, p, base``; ``base`` is the source's share
    of a term that it does not hold.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in _whole_terms(batches):
            coded = f["source"].dictionary_encode()
            names, src = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            p, base = f["p"].to_numpy(), f["base"].to_numpy()
            begins = _runs_of(f, ("lang", "term"))
            sizes = np.diff(np.append(begins, len(f)))
            lang = f["lang"].dictionary_encode()
            lang_at = lang.indices.to_numpy().astype(np.int64)
            # Posting i meets those after it in its term.
            after = np.repeat(begins + sizes, sizes) - np.arange(len(f)) - 1
            upto = np.cumsum(after)
            lo = 0
            while lo < len(f):
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + _PAIRS, side="right")))
                left = np.repeat(np.arange(lo, hi), after[lo:hi])
                nth = np.arange(len(left)) - np.repeat(np.cumsum(after[lo:hi]) - after[lo:hi], after[lo:hi])
                right = left + 1 + nth
                lo = hi
                if not len(left):
                    continue
                both = np.abs(p[left] - p[right])
                c = both - np.abs(p[left] - base[right]) - np.abs(base[left] - p[right]) + np.abs(base[left] - base[right])
                key = (lang_at[left] * len(names) + src[left]) * len(names) + src[right]
                found, back = np.unique(key, return_inverse=True)
                total = np.zeros(len(found), dtype=np.int64)
                np.add.at(total, back, c)
                ab, b = np.divmod(found, len(names))
                at_lang, a = np.divmod(ab, len(names))
                yield arrow_batch({"lang": lang.dictionary.take(pa.array(at_lang)), "a": names.take(pa.array(a)),
                                   "b": names.take(pa.array(b)), "c": total}, {"c": LONG})

    met = postings.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return met.mapInArrow(run, "lang string, a string, b string, c long").groupBy("lang", "a", "b").agg(F.sum("c").alias("c"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` (see the module's text).

    Part ``pair``: every other source of the language by summed difference of
    shares over all kept terms; part ``term``: the first ``top`` kept terms whose
    share in the source exceeds the language's. Null text, language and source
    read as ''. A (language, source) without terms is a group all the same; a
    language without kept terms has differences of 0 and no terms. Repeated rows
    count each, ids are not read, other columns are ignored, whatever their
    names. Ties go to the item first in byte order. Empty table: empty result.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(part(lang_col).alias("lang"), part(source_col).alias("source"), part(text_col).alias("text"))
    kept = written(frequencies(block_runs(rows), least_docs), "frequencies")
    size = kept.groupBy("lang").agg(F.count_distinct("term").alias("v"))
    total = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(size, "lang", "left").join(total, ["lang", "source"], "left")
    everything = Window.partitionBy("lang")
    groups = groups.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total"))
    groups = groups.withColumn("lang_total", F.sum("total").over(everything))
    groups = written(groups.withColumn("base", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.greatest("v", F.lit(1)))).otherwise(F.lit(0))), "groups")

    scored = kept.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", "base", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("whole"), F.col("lang_total"), F.col("v")).alias("q"))
    scored = written(scored, "shares")
    by_term = scored.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_term = by_term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    # Terms of a against their absence from b, from how many terms of a have each share.
    held = scored.groupBy("lang", "source", "p", "base").agg(F.count("*").alias("m"))
    other = groups.select("lang", F.col("source").alias("b"), F.col("base").alias("base_b"))
    absent = (held.join(other, "lang").filter("source <> b")
              .groupBy("lang", F.col("source").alias("a"), "b")
              .agg(F.sum(F.col("m") * (F.abs(F.col("p") - F.col("base_b")) - F.abs(F.col("base") - F.col("base_b")))).alias("c")))
    both = pair_corrections(scored.select("lang", "term", "source", "p", "base"))
    turned = lambda df: df.union(df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "c"))
    plain = (groups.select("lang", F.col("source").alias("a"), "v", "base").join(other, "lang").filter("a <> b")
             .select("lang", "a", "b", (F.col("v") * F.abs(F.col("base") - F.col("base_b"))).alias("c")))
    summed = plain.union(turned(absent.select("lang", "a", "b", "c"))).union(turned(both)).groupBy("lang", "a", "b").agg(F.sum("c").alias("value"))
    by_pair = summed.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    by_pair = by_pair.withColumn("rank", F.row_number().over(order))
    return by_pair.union(by_term.select(*by_pair.columns)).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
