"""Sharding along a Hilbert curve, on DataFrame functions only.

Several metadata dimensions are quantised to a few bits each, rows are ordered
by their place on the Hilbert curve through that grid, and the order is cut into
runs of equal row counts, so every shard covers a compact region of the grid.

The global row number comes from bounded pieces: counts per (cell, salt), prefix
sums over the cells of each curve prefix, and a window inside each (cell, salt).
A cell that holds a third of all rows is spread over the salts.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS, SALTS, SHARDS = 5, 256, 16
_HEAD = 128  # curve prefixes; the prefix sum over them is the only one in a single task


def hilbert_index(point: list[int], bits: int) -> int:
    """Reference form of the curve on plain integers (used to state and test the rule)."""
    x, n = list(point), len(point)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = 0
    for level in range(bits - 1, 0, -1):
        if x[n - 1] & (1 << level):
            flip ^= (1 << level) - 1
    x = [v ^ flip for v in x]
    return sum(((x[i] >> level) & 1) << (level * n + n - 1 - i) for level in range(bits) for i in range(n))


def hilbert_column(dims: list[Column], bits: int = BITS) -> Column:
    """The same index as a column expression over integer columns in ``[0, 2**bits)``."""
    n = len(dims)
    one = F.lit(1).cast("int")
    steps = F.array(*[F.struct(F.lit(1 << level).alias("q"), F.lit(i).alias("i")) for level in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, s: Column) -> Column:
        q, i = s["q"], s["i"]
        xi, x0 = F.get(x, i), F.get(x, F.lit(0))
        set_ = xi.bitwiseAND(q) != 0
        swap = x0.bitwiseXOR(xi).bitwiseAND(q - one)
        first = F.when(set_, x0.bitwiseXOR(q - one)).otherwise(x0.bitwiseXOR(swap))
        own = F.when(set_, xi).otherwise(xi.bitwiseXOR(swap))
        return F.transform(x, lambda v, k: F.when(k == 0, first).when(k == i, own).otherwise(v))

    turned = F.aggregate(steps, F.array(*[d.cast("int") for d in dims]), turn) if bits > 1 else F.array(*[d.cast("int") for d in dims])
    # Gray code: running exclusive-or from the first dimension.
    gray = F.aggregate(turned, F.array().cast("array<int>"),
                       lambda a, v: F.concat(a, F.array(v.bitwiseXOR(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))))))
    levels = F.array(*[F.lit(level) for level in range(bits - 1, -1, -1)])

    def woven(x: Column) -> Column:
        flip = F.aggregate(levels, F.lit(0), lambda t, v: F.when(
            (v > 0) & (F.get(x, F.lit(n - 1)).bitwiseAND(F.call_function("shiftleft", one, v)) != 0),
            t.bitwiseXOR(F.call_function("shiftleft", one, v) - one)).otherwise(t))
        return F.aggregate(levels, F.struct(F.lit(0).cast("long").alias("h"), flip.alias("f")), lambda a, v: F.struct(
            F.aggregate(x, a["h"], lambda h, d: h * 2 + F.call_function("shiftright", d.bitwiseXOR(a["f"]), v).bitwiseAND(one)).alias("h"),
            a["f"].alias("f")))["h"]

    # A one-element transform binds the Gray code once instead of repeating it.
    return F.get(F.transform(F.array(gray), woven), F.lit(0))


def coded(value: Column, bits: int = BITS) -> Column:
    """A text dimension on the grid: a checksum of its value; null is its own value."""
    return F.when(value.isNull(), F.lit(0)).otherwise(
        F.crc32(F.encode(value.cast("string"), "UTF-8")) % F.lit((1 << bits) - 1) + 1).cast("int")


def magnitude(size: Column, bits: int = BITS) -> Column:
    """A size on the grid: its binary magnitude."""
    return F.least(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))), F.lit((1 << bits) - 1)).cast("int")


def hilbert_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   dims: dict[str, Column] | None = None, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot`` for every row of ``docs``.

    ``dims`` maps names to integer columns on the grid; by default language,
    source and size where those columns exist. Row counts of any two shards
    differ by at most one; slots are gapless from 0 and follow the curve, then a
    checksum, the id and the text's checksum. Size is the UTF-8 bytes of the
    text plus 1; null text has no bytes. Null ids come first in their cell,
    repeated rows keep a slot each. Fewer rows than shards leave shards empty;
    an empty table gives an empty result. Other columns are ignored.
    """
    raw = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    size = (F.octet_length(raw) + 1).cast("long")
    if dims is None:
        dims = {c: coded(F.col(c), bits) for c in ("lang", "source") if c in docs.columns}
        dims["size"] = magnitude(size, bits)
    head = max(0, bits * len(dims) - (_HEAD.bit_length() - 1))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), F.crc32(raw).alias("text_crc32"),
                       hilbert_column(list(dims.values()), bits).alias("curve"))
    mark = F.xxhash64("doc_id", "text_crc32")
    rows = rows.withColumn("mark", mark).withColumn("salt", F.pmod("mark", F.lit(SALTS)).cast("int"))
    counts = rows.groupBy("curve", "salt").agg(F.count("*").alias("n"))
    cells = counts.groupBy("curve").agg(F.sum("n").alias("n")).withColumn("top", F.call_function("shiftright", F.col("curve"), F.lit(head)))
    tops = cells.groupBy("top").agg(F.sum("n").alias("n"))
    tops = tops.select("top", F.coalesce(F.sum("n").over(Window.orderBy("top").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("top_before"),
                       F.sum("n").over(Window.partitionBy()).alias("total"))
    in_top = Window.partitionBy("top").orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.join(tops, "top").select("curve", "total", (F.col("top_before") + F.coalesce(F.sum("n").over(in_top), F.lit(0))).alias("cell_before"))
    in_cell = Window.partitionBy("curve").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = (counts.withColumn("in_cell", F.coalesce(F.sum("n").over(in_cell), F.lit(0))).join(cells, "curve")
             .select("curve", "salt", "total", (F.col("cell_before") + F.col("in_cell")).alias("before")))
    inside = F.row_number().over(Window.partitionBy("curve", "salt").orderBy("mark", "doc_id", "text_crc32")) - 1
    rank = F.col("before") + F.col("inside")
    ranked = rows.withColumn("inside", inside).join(parts, ["curve", "salt"]).withColumn("rank", rank)
    shard = F.expr(f"((rank + 1) * {shards} + total - 1) div total - 1")
    return (ranked.withColumn("shard", shard.cast("int"))
            .select("doc_id", "size", "text_crc32", "curve", "shard",
                    F.expr(f"rank - (cast(shard as bigint) * total) div {shards}").alias("slot")))
