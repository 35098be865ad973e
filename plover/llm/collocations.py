"""Phrase collocations by relational mining (SETM).

An occurrence relation holds (piece, position, phrase) sorted by piece and
position. Level by level it is merge-joined with itself on the piece and the
adjacent position, the longer phrases are group-counted, and the relation is
semi-joined with the frequent ones before the next level extends it.

The relation is persisted in blocks: a block holds the pieces of a few megabytes
of text of one language, sorted, as compressed columns, so that the merge-join of
neighbours never leaves its block. What is shuffled are the distinct phrases of
each block with their counts (a phrase that fills a third of the corpus is one row
a block), and the ids of the frequent ones on their way back to the blocks.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BINARY, LONG, STRING, arrow_batch, release_memory, written

LONGEST, LEAST, COVERED_PERCENT, TOP, SCALE = 3, 10, 50, 2000, 1_000_000
BLOCK_BYTES = 8 << 20
_BLOCKS = 1 << 12  # blocks of one input partition, and room for as many phrases a block as 2**31
_PIECE_END = np.zeros(256, dtype=bool)
_PIECE_END[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_IN_WORD = ~_PIECE_END
_IN_WORD[[0x20, 0x09]] = False
_RELATION = "block long, lang string, items binary, lengths binary"


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, low bytes first and together: small numbers compress well."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def cut_pieces(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words in order (A-Z lower-cased, dictionary encoded) and the number of words of each piece that has some."""
    data = b"\n".join(t.encode("utf-8", "surrogatepass") for t in texts).lower()
    buf = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = _IN_WORD[buf]
    edge = np.diff(inside)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.append(0, np.cumsum(last - first)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside[1:-1] == 1])])
    piece = np.cumsum(_PIECE_END[buf])[first] if len(first) else np.empty(0, dtype=np.int64)
    begins = np.flatnonzero(np.diff(piece, prepend=-1))
    return words.dictionary_encode(), np.diff(np.append(begins, len(piece)))


def occurrences(docs: DataFrame) -> DataFrame:
    """``block, lang, items, lengths, words, counts``: the first relation (``docs``: lang, text).

    ``items`` are places in the block's dictionary ``words``, piece after piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}
        made = 0

        def spill(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal made
            coded, lengths = cut_pieces(held.pop(lang))
            size.pop(lang)
            if not len(lengths):
                return
            if made == _BLOCKS:
                raise ValueError(f"more than {_BLOCKS} blocks in one input partition; read the input in smaller partitions")
            items = coded.indices.to_numpy()
            yield arrow_batch({"block": [part * _BLOCKS + made], "lang": [lang], "items": [_pack(items)], "lengths": [_pack(lengths)],
                               "words": pa.array([coded.dictionary.cast(pa.binary()).cast(pa.string()).to_pylist()], pa.list_(pa.string())),
                               "counts": pa.array([np.bincount(items, minlength=len(coded.dictionary))], pa.list_(pa.int64()))},
                              {"block": LONG, "lang": STRING, "items": BINARY, "lengths": BINARY})
            made += 1

        for f in batches:
            for lang, text in zip(f["lang"].to_pylist(), f["text"].to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 1
                if size[lang] >= BLOCK_BYTES:
                    yield from spill(lang)
                elif sum(size.values()) >= 3 * BLOCK_BYTES:  # many languages: the fullest makes room
                    yield from spill(max(size, key=size.get))
        for lang in sorted(held):
            yield from spill(lang)
        release_memory()

    return docs.mapInArrow(run, f"{_RELATION}, words array<string>, counts array<long>")


def _frequent(counted: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The rows of frequent groups with the group's ``id`` (one of its own places, so ids are unique) and count ``f``."""
    group = Window.partitionBy(*keys)
    summed = counted.withColumn("f", F.sum("n").over(group)).withColumn("id", F.min("place").over(group))
    return summed.filter(F.col("f") >= least)


def _joined(items: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a block's relation with itself on piece and adjacent position.

    ``items`` has one phrase (-1: none) per position. Returns the positions that
    join, and per distinct pair of phrases its two items and the pair's number at
    each joining position.
    """
    ends = np.zeros(len(items), dtype=bool)
    ends[np.cumsum(lengths) - 1] = True
    at = np.flatnonzero((items[:-1] >= 0) & (items[1:] >= 0) & ~ends[:-1]) if len(items) else np.empty(0, dtype=np.int64)
    pair = items[at].astype(np.int64) << 32 | items[at + 1]
    distinct, number = np.unique(pair, return_inverse=True)
    return at, distinct >> 32, distinct & 0xFFFFFFFF, number


def _relation(items: np.ndarray) -> np.ndarray:
    return np.where(items == 0xFFFFFFFF, -1, items.astype(np.int64))


def _counted(relation: DataFrame) -> DataFrame:
    """``left, right, place, n``: each block's distinct pairs of adjacent phrases, by phrase id, with their count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            for block, items, lengths, ids in zip(*(f[c].to_pylist() for c in ("block", "items", "lengths", "ids"))):
                _, left, right, number = _joined(_relation(_unpack(items)), _unpack(lengths))
                if len(left):
                    ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), dtype=np.int64)
                    yield arrow_batch({"left": ids[left], "right": ids[right], "place": (block << 31) + np.arange(len(left)),
                                       "n": np.bincount(number, minlength=len(left))}, dict.fromkeys(("left", "right", "place", "n"), LONG))
        release_memory()

    return relation.mapInArrow(run, "left long, right long, place long, n long")


def _semi_join(relation: DataFrame, frequent: DataFrame, extend: bool) -> DataFrame:
    """The next relation, blocks as before: only positions of frequent phrases keep one, by place in ``ids``.

    ``extend``: the phrases are the pairs that join at a position, else the items themselves.
    """
    marks = frequent.select(F.shiftright("place", 31).alias("block"), (F.col("place") % (1 << 31)).alias("nth"), "id")

    def run(key: tuple, blocks: pa.Table, own: pa.Table) -> pa.Table:
        out = []
        nth, ids = own["nth"].to_numpy(), own["id"].to_numpy()
        for block, lang, items, lengths in zip(*(blocks[c].to_pylist() for c in ("block", "lang", "items", "lengths"))):
            items, lengths = _relation(_unpack(items)), _unpack(lengths)
            if extend:
                at, left, _, number = _joined(items, lengths)
                known = np.full(len(left), -1, dtype=np.int64)
            else:
                at, number = np.arange(len(items)), items
                known = np.full(int(items.max()) + 1, -1, dtype=np.int64)
            known[nth] = np.arange(len(nth))
            longer = np.full(len(items), -1, dtype=np.int64)
            longer[at] = known[number]
            out.append((block, lang, _pack(longer.astype(np.uint32)), _pack(lengths), zstandard.ZstdCompressor(level=1).compress(ids.tobytes())))
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("block", "lang", "items", "lengths", "ids"), columns, (LONG, STRING, BINARY, BINARY, BINARY))})

    return (relation.select("block", "lang", "items", "lengths").groupBy("block").cogroup(marks.groupBy("block"))
            .applyInArrow(run, f"{_RELATION}, ids binary"))


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of 1 to ``longest`` words, one table per length, and ``lang, n`` (all words of a language).

    A table has ``id, lang, phrase, last, f, heads, tails``: the phrase, its last
    word, its count, and the counts of its beginnings and ends of 1, 2, ... words
    up to itself; from the second length on ``left`` and ``right``, the ids of the
    phrases without its last and without its first word.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    first = written(occurrences(rows), "occurrences")
    words = first.select("lang", "block", F.posexplode(F.arrays_zip("words", "counts")).alias("nth", "w"))
    words = words.select("lang", F.col("w.words").alias("phrase"), ((F.col("block") * F.lit(1 << 31)) + F.col("nth")).alias("place"), F.col("w.counts").alias("n"))
    totals = first.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = written(_frequent(words, ["lang", "phrase"], least).select("id", "place", "lang", "phrase", "f"), "frequent")
    own = F.array("f")
    levels = [written(frequent.filter("id = place").select("id", "lang", "phrase", F.col("phrase").alias("last"), "f", own.alias("heads"), own.alias("tails")), "phrases")]
    relation = None
    for size in range(2, longest + 1):
        relation = written(_semi_join(first if relation is None else relation, frequent, extend=relation is not None), "relation")
        frequent = written(_frequent(_counted(relation), ["left", "right"], least).select("id", "place", "left", "right", "f"), "frequent")
        before = levels[-1]
        a = before.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), F.col("heads").alias("before_heads"))
        b = before.select(F.col("id").alias("right"), "last", F.col("tails").alias("before_tails"))
        longer = frequent.filter("id = place").select("id", "left", "right", "f").join(a, "left").join(b, "right")
        levels.append(written(longer.select("id", "left", "right", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "f",
                                            F.concat("before_heads", own).alias("heads"), F.concat("before_tails", own).alias("tails")), "phrases"))
    return levels, totals


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(SCALE * a * a / (left * right))`` in exact decimals (counts below 10**14)."""
    big = lambda c: c.cast("decimal(14,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * big(a) * big(a), big(left) * big(right))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST,
                 covered_percent: int = COVERED_PERCENT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of 2 to ``longest`` words of each language.

    A phrase is a run of words inside a piece that occurs ``least`` times or
    more. Of its cuts the lowest-scoring counts (ties: the shortest first part).
    A phrase goes where a longer one that contains it has ``covered_percent`` of
    its count. Null language: ``und``; null or empty text has no words. Repeated
    rows count each; ids and other columns are not read, whatever their names.
    Ties go to the higher count, then the phrase first in byte order. Empty
    table, or no frequent phrase: empty result.
    """
    levels, totals = phrases(docs, lang_col, text_col, longest, least)
    every = None
    for size, table in enumerate(levels[1:], 2):
        if size < longest:  # the most frequent extension; longer ones are no more frequent than it
            inside = levels[size]
            around = inside.select(F.col("left").alias("id"), "f").union(inside.select(F.col("right").alias("id"), "f"))
            around = around.groupBy("id").agg(F.max("f").alias("most"))
            table = table.join(around, "id", "left").filter(F.coalesce(100 * F.col("most") < covered_percent * F.col("f"), F.lit(True)))
        cuts = [F.struct(_score(F.col("f"), F.get("heads", F.lit(k - 1)), F.get("tails", F.lit(size - k - 1))).alias("score"), F.lit(k).alias("k"),
                         F.get("heads", F.lit(k - 1)).alias("l"), F.get("tails", F.lit(size - k - 1)).alias("r")) for k in range(1, size)]
        scored = table.select("lang", "phrase", F.col("f").alias("a"), F.array_min(F.array(*cuts)).alias("cut"))
        every = scored if every is None else every.union(scored)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
