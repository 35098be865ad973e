"""Token packing: best-fit bins improved by swap-based local search.

Documents become token pieces of at most one sequence. Pieces are dealt by hash
into groups of a few thousand; inside a group they are placed best-fit and then
underfull bins exchange documents (a move, one for one, two for one) whenever
that raises the sum of squared fills, until bins empty.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, INT, LONG, arrow_batch, texts_of
from .tokens import RESERVED, encoder, vocabulary

CAPACITY, END_ID = 1024, 2
PIECES_PER_GROUP = 4096
_SLICE_BYTES = 4 << 20


def _slices(f: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about 4 MB of text (a longer text is a run of its own)."""
    upto = np.cumsum(np.nan_to_num(pc.binary_length(f[column]).to_numpy(zero_copy_only=False)))
    lo = 0
    while lo < len(f):
        before = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, before + _SLICE_BYTES, side="right")))
        yield f.slice(lo, hi - lo)
        lo = hi


def tokenize_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                    end_id: int = END_ID, ranks_path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit ids).

    A document is its text's ids as the vocabulary's JSON form gives them (a
    reserved string in a text is its one id), then ``end_id`` (null text: just
    that). Only
    longer documents are cut, into pieces of ``capacity``; the first may be
    shorter. Null and repeated ids pass through; other columns are ignored.
    """
    path = ranks_path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, RESERVED)
        end = np.array([end_id], dtype="<u4")
        for whole in batches:
            for f in _slices(whole, "t"):
                rows = []
                for doc, ids in enumerate(coder.batch(f["t"].to_pylist())):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    cuts = list(range(len(ids) % capacity or capacity, len(ids) + 1, capacity))
                    for k, hi in enumerate(cuts):
                        at = cuts[k - 1] if k else 0
                        rows.append((doc, k, at, hi - at, ids[at:hi].tobytes()))
                doc, piece, start, length, packed = zip(*rows)
                yield arrow_batch({"doc_id": f["doc_id"].take(pa.array(doc)), "piece": piece, "start": start,
                                   "length": length, "ids": packed},
                                  {"piece": INT, "start": LONG, "length": LONG, "ids": BINARY})
        coder.release()

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: largest first, each into the fullest bin with room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fits = rooms >> sizes[i]
        if fits:
            room = sizes[i] + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(i)
        else:
            at, room = len(bins), capacity
            bins.append([i])
        left = room - sizes[i]
        by_room.setdefault(left, []).append(at)
        rooms |= 1 << left
    return bins


def swap_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Raise the sum of squared fills by exchanges between underfull bins until none helps.

    The emptiest bin gives: a document moves to a bin with room, or is exchanged
    for one smaller document or for two that are smaller together. Every
    exchange takes tokens out of the giver, so each bin ends emptied or stuck.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    alive = sum(1 for b in bins if b)
    for giver in sorted((k for k in range(len(bins)) if fill[k] < capacity), key=lambda k: (fill[k], k)):
        if alive <= least:
            break
        others = sorted((k for k in range(len(bins)) if k != giver and bins[k] and fill[k] < capacity),
                        key=lambda k: (-fill[k], k))
        moved = True
        while moved and bins[giver]:
            moved = False
            others = [k for k in others if fill[k] < capacity and fill[k] >= fill[giver]]
            for i in sorted(bins[giver], key=lambda k: (-sizes[k], k)):
                gain, taker, back = 0, -1, ()
                for k in others:
                    room = capacity - fill[k]
                    if room <= gain:
                        continue
                    if sizes[i] <= room:
                        if sizes[i] > gain:
                            gain, taker, back = sizes[i], k, ()
                        continue
                    need = sizes[i] - room  # the taker gives back at least this
                    own = sorted(bins[k], key=lambda j: sizes[j])
                    for j in own:
                        if need <= sizes[j] < sizes[i]:
                            if sizes[i] - sizes[j] > gain:
                                gain, taker, back = sizes[i] - sizes[j], k, (j,)
                            break
                    lo, hi = 0, len(own) - 1
                    while lo < hi:
                        two = sizes[own[lo]] + sizes[own[hi]]
                        if two < need:
                            lo += 1
                        else:
                            if two < sizes[i] and sizes[i] - two > gain:
                                gain, taker, back = sizes[i] - two, k, (own[lo], own[hi])
                            hi -= 1
                if taker < 0:
                    continue
                bins[giver].remove(i)
                bins[taker].append(i)
                for j in back:
                    bins[taker].remove(j)
                    bins[giver].append(j)
                fill[giver] -= gain
                fill[taker] += gain
                moved = True
                break
        if not bins[giver]:
            alive -= 1
    return [b for b in bins if b]


def pack_pieces(pieces: DataFrame, groups: int, key_cols: tuple[str, ...] = ("doc_id", "piece"),
                length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; offsets of a sequence are gapless from 0.

    Every other column passes through; input columns of those two names are
    replaced. Lengths above ``capacity`` raise. Rows are dealt to ``groups`` by
    hash of their key, so a document of any length is spread; a group is bounded
    by the caller's count, not by any one key.
    """
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(*[F.col(f"`{c}`") for c in own])
    schema = T.StructType(pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    group = "_group"
    while group in own:
        group += "_"

    def run(key: tuple, f: pa.Table) -> pa.Table:
        f = f.drop_columns([group]).sort_by([(c, "ascending") for c in (*key_cols, length_col)])
        sizes = f[length_col].to_pylist()
        if sizes and max(sizes) > capacity:
            raise ValueError(f"a piece of {max(sizes)} tokens does not fit a sequence of {capacity}")
        bins = swap_search(best_fit(sizes, capacity), sizes, capacity)
        seq, off = np.zeros(len(f), dtype="int64"), np.zeros(len(f), dtype="int64")
        for k, items in enumerate(bins):
            at = 0
            for i in items:
                seq[i], off[i] = (key[0].as_py() << 32) + k, at
                at += sizes[i]
        return f.append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))

    dealt = pieces.withColumn(group, F.pmod(F.xxhash64(*key_cols), F.lit(groups).cast("long")))
    return dealt.groupBy(group).applyInArrow(run, schema)


def groups_for(rows: int) -> int:
    """How many packing groups; a lone group would be one task, so there are always a few."""
    return max(1, -(-rows // PIECES_PER_GROUP))
