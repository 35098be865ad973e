"""Order MinHash fingerprints on DataFrame functions only.

A k-mer is ``k`` consecutive words, hashed from the md5 of each. The n-th
occurrence of a k-mer in a text counts as an item of its own with a rank of its
own in one random permutation, whose first six bits name one of 64 sections. In
each section the ``l`` items of least rank
are selected, put back into text order, and the hash of the ordered tuple is one
signature entry: it changes when the selected k-mers change and when they change
places, so agreement falls with the edit distance, not with the common words
alone.

Everything is done on the arrays of one row: sorting puts equal k-mers next to
each other (occurrence numbers), and equal sections (the least of each). Nothing
is exploded, so the only rows that move are the texts that meet their neighbour.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import running_totals
from .common import written

K, TUPLE = 3, 2
SPACE = "[\\x20\\x09-\\x0D]+"
#: Arithmetic modulo a prime below 2**31 keeps every product inside a long, in Spark as in any other SQL.
PRIME = 2147483647
_WORD = (1566083941, 1812433253, 2083697861, 1664525011, 1103515267)  # factor of each word of a k-mer
_RANK, _NTH = 1284865837, 981584591  # a k-mer's place in the permutation, and what its n-th occurrence adds
_ORDER = (1099087573, 1812433259, 1389796867, 2137482011)  # factor of each member of a tuple: order counts
_SECTION_BITS = 25  # the upper six bits of a rank name its section
_HIGH = 1 << 32  # a number above, the place in the text below


def _starts(numbers: Column, bits: int) -> Column:
    """0-based places where a sorted array's numbers change above their lowest ``bits``."""
    head = lambda i: F.shiftright(F.get(numbers, i), bits)
    every = F.sequence(F.lit(0), F.greatest(F.size(numbers) - 1, F.lit(0)))
    return F.when(F.size(numbers) > 0, F.filter(every, lambda i: (i == 0) | (head(i) != head(i - 1)))).otherwise(F.array().cast("array<int>"))


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, least: int = TUPLE) -> DataFrame:
    """``df`` with the fingerprint ``out`` of its non-null column ``text``.

    The fingerprint is a comma-joined list of signature entries, two hex digits
    for the section and eight of the tuple's hash, in order of sections; a
    section without k-mers has none, and a text without words has the empty
    fingerprint. Fewer words than ``k`` are one k-mer. Equal texts have equal
    fingerprints.
    """
    if not (1 <= k <= len(_WORD) and 1 <= least <= len(_ORDER)):
        raise ValueError(f"k from 1 to {len(_WORD)}, least from 1 to {len(_ORDER)}")
    others = [F.col(f"`{c}`") for c in df.columns]
    a, b = f"{out}_a", f"{out}_b"
    long = lambda n: F.lit(n).cast("long")
    words = F.array_remove(F.split(text, SPACE), "")
    step = df.select(*others, F.transform(words, lambda x: F.coalesce(
        F.conv(F.left(F.md5(x.cast("binary")), F.lit(7)), 16, 10).cast("long"), long(0))).alias(a))

    def kmer(i: Column) -> Column:
        mixed = sum((F.coalesce(F.get(F.col(a), i + j), long(0)) * long(_WORD[j]) for j in range(1, k)), F.get(F.col(a), i) * long(_WORD[0]))
        return F.coalesce(mixed % long(PRIME) * long(_HIGH) + i, long(0))

    every = F.transform(F.sequence(F.lit(0), F.greatest(F.size(a) - k, F.lit(0))), kmer)
    # Equal k-mers side by side, in text order.
    step = step.select(*others, F.sort_array(F.when(F.size(a) > 0, every).otherwise(F.array().cast("array<bigint>"))).alias(a))
    step = step.select(*others, F.col(a), _starts(F.col(a), 32).alias(b))
    # Occurrence numbers: 0, 1, ... from each start to the next.
    number = F.flatten(F.transform(F.col(b), lambda x, i: F.sequence(F.lit(0), F.coalesce(F.get(F.col(b), i + 1), F.size(a)) - x - 1)))
    step = step.select(*others, F.col(a), number.alias(b))
    # An argument of zip_with is computed once a row; a column read inside a lambda may be inlined there.
    rank = lambda x, n: (F.shiftright(x, 32) * long(_RANK) + n * long(_NTH)) % long(PRIME) * long(_HIGH) + x % long(_HIGH)
    step = step.select(*others, F.sort_array(F.zip_with(a, b, lambda x, n: F.coalesce(rank(x, n), long(0)))).alias(a))
    step = step.select(*others, F.col(a), _starts(F.col(a), 32 + _SECTION_BITS).alias(b))

    def entry(at: Column, i: Column) -> Column:
        stop = F.coalesce(F.get(F.col(b), i + 1), F.size(a))
        picked = F.slice(F.col(a), at + 1, F.least(stop - at, F.lit(least)))
        # Back into text order: place above, rank below.
        in_text = F.sort_array(F.transform(picked, lambda x: x % long(_HIGH) * long(PRIME) + F.shiftright(x, 32)))
        mixed = F.aggregate(F.transform(in_text, lambda x, j: x % long(PRIME) * F.get(F.array(*map(long, _ORDER)), j) % long(PRIME)),
                            long(0), lambda s, x: s + x)
        section = F.shiftright(F.get(F.col(a), at), 32 + _SECTION_BITS)
        return F.concat(F.lpad(F.hex(section), 2, "0"), F.lpad(F.hex(mixed % long(PRIME)), 8, "0"))

    return step.select(*others, F.concat_ws(",", F.transform(F.col(b), entry)).alias(out))


def likeness(x: Column, y: Column) -> Column:
    """Agreeing entries by sections that either fingerprint has (0 to 1; both empty: 1)."""
    entries = lambda f: F.when(f == "", F.array().cast("array<string>")).otherwise(F.split(f, ","))
    sections = lambda f: F.transform(entries(f), lambda e: F.left(e, F.lit(2)))
    both = F.size(F.array_intersect(entries(x), entries(y)))
    either = F.size(F.array_union(sections(x), sections(y)))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _key(id_col: Column, text: Column) -> Column:
    """One text key per distinct (id, text); a null id is none of the others."""
    return F.concat(F.coalesce(id_col.cast("long").cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, id, n_chars, before_key, room_before``: each distinct (id, text) between its neighbours.

    Order: id ascending, a null id first, equal ids by the text's md5; after the
    last comes the first, and a lone document follows itself. ``room_before`` is
    what the edited text of the document before takes from this one.
    """
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias("id"), _key(F.col(id_col), t).alias("key"),
                      F.length(t).cast("long").alias("n_chars")).distinct()
    placed = written(running_totals(written(own, "order"), ["id", "key"]), "order")
    beside = lambda step: F.pmod(F.col("_rk_pos") + step, F.col("total_rows")).alias("_rk_pos")
    before = placed.select(beside(1), F.col("key").alias("before_key"), F.floor(F.col("n_chars") / 2).cast("int").alias("room_before"))
    return placed.join(before, "_rk_pos").select("key", "id", "n_chars", "before_key", "room_before")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, least: int = TUPLE) -> DataFrame:
    """``doc_id, n_chars, edited, fingerprint, next_fingerprint`` for every row of ``docs``.

    ``edited`` is the text whose last ``floor(n_chars / 2)`` code points gave way
    to the first as many (or all) of the next document. A text moves once, with
    its fingerprint, and from there only the part that its neighbour takes.
    """
    plan = written(in_order(docs, id_col, text_col), "plan")
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Both uses of the texts need the same columns, so that one exchange serves both.
    rows = with_fingerprint(docs.select(_key(F.col(id_col), t).alias("key"), t.alias("text")), "text", "fingerprint", k, least)
    met = rows.join(plan, "key")
    tails = met.select(F.col("before_key").alias("key"), F.left("text", F.col("room_before")).alias("tail"),
                       F.col("fingerprint").alias("next_fingerprint")).dropDuplicates(["key"])
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int")
    return met.join(tails, "key").select(F.col("id").alias("doc_id"), "n_chars", F.concat(F.left("text", kept), "tail").alias("edited"),
                                         "fingerprint", "next_fingerprint")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, least: int = TUPLE) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row of ``docs``.

    Null text is the empty text. Rows that repeat an id and text are one place in
    the order and get the same result; null ids pass through. Texts without a
    word have the empty fingerprint, alike to another empty one and to nothing
    else. Other columns are ignored, whatever their names; empty table: empty
    result.
    """
    pairs = edited_pairs(docs, id_col, text_col, k, least)
    made = pairs.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "next_fingerprint", "edited")
    made = with_fingerprint(made, "edited", "edited_fingerprint", k, least)
    return made.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
