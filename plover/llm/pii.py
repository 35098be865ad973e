"""Personal data: fixed patterns, and terms that give protected entities away.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Each value
found is a protected entity. Over the whole corpus, the words of its texts are
counted with it and without it: the pointwise mutual information of word and
entity, as a share of the entity's own information content, says how much of the
entity the word discloses. Words beyond one threshold for some entity are
generalised, beyond a higher one removed, wherever they stand.
"""
from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BINARY, arrow_batch, texts_of, written

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalised", "removed")
#: Shares of the entity's information content from which a word is generalised or removed.
GENERALISE, REMOVE = 0.6, 0.85
#: Standard errors by which the rate of an entity given a word is lowered: few texts count for less.
ERRORS = 1.0
#: Bits of the filter that tells tasks which words may be terms, bits of one aggregated piece, words a task remembers.
_BITS, _PIECE, _REMEMBERED = 1 << 25, 1 << 15, 1 << 18

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run that fails from its start fails from its middle, so only starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TERM_BREAK = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # everything before belongs to an earlier match
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        free = m.end() if m else at + 1
        if m:
            yield start, m.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def entity(kind: str, value: str) -> str:
    """A protected entity: its kind and its value without punctuation and case."""
    if kind in ("card", "phone"):
        value = re.sub(r"[^0-9]", "", value)
    return f"{kind}:{value.lower()}"


def words_outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(word, start, end) of the words of a text that touch none of its spans."""
    starts, ends = [], []  # joined where they overlap
    for _, a, b in spans:
        if starts and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for m in _TERM.finditer(text):
        k = bisect_right(starts, m.end() - 1) - 1
        if k < 0 or ends[k] <= m.start():
            yield m[0], m.start(), m.end()


def _list_type() -> pa.DataType:
    return pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``text_key, entities, words`` of every row: its entities and, if it has any, its different words."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            keys, entities, words = [], [], []
            for t in f["t"].to_pylist():
                t = t or ""
                found = base_spans(t)
                keys.append(hashlib.md5(t.encode("utf-8", "surrogatepass")).digest())
                entities.append(sorted({entity(k, t[a:b]) for k, a, b in found}))
                words.append(sorted(set(_TERM.findall(t))) if found else [])
            yield arrow_batch({"text_key": keys, "entities": entities, "words": words},
                              {"text_key": BINARY, "entities": pa.list_(pa.string()), "words": pa.list_(pa.string())})

    return docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, "text_key binary, entities array<string>, words array<string>")


def _lower_rate(hits: Column, tries: Column, errors: float = ERRORS) -> Column:
    """Wilson's lower bound of ``hits / tries``; k of k gives k / (k + errors**2)."""
    rate, z2 = hits / tries, errors * errors
    spread = F.sqrt(rate * (1 - rate) / tries + z2 / (4 * tries * tries))
    return (rate + z2 / (2 * tries) - errors * spread) / (1 + z2 / tries)


def _filter_of(rows: DataFrame, name: str) -> bytes:
    """A bitmap with the bit of every value of a binary column set; other values may share a bit."""
    at = rows.select((F.crc32(name) % F.lit(_BITS)).alias("at"))
    pieces = at.groupBy((F.col("at") / _PIECE).cast("int").alias("k")).agg(F.bitmap_construct_agg(F.col("at") % F.lit(_PIECE)).alias("m")).collect()
    out = np.zeros((_BITS // _PIECE, _PIECE // 8), dtype=np.uint8)
    for r in pieces:
        out[r["k"]] = np.frombuffer(r["m"], dtype=np.uint8)
    return out.tobytes()


def _may_hold(bits: bytes, value: bytes) -> int:
    at = zlib.crc32(value) % _BITS
    return bits[at >> 3] >> (at & 7) & 1


def _rows_in(docs: DataFrame, bits: bytes, text_col: str) -> DataFrame:
    """``text_key, t`` of the rows whose text's key has its bit set."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            keys = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in f["t"].to_pylist()]
            yield arrow_batch({"text_key": keys, "t": f["t"]}, {"text_key": BINARY}).filter(pa.array([bool(_may_hold(bits, k)) for k in keys], type=pa.bool_()))

    return docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).mapInArrow(run, "text_key binary, t string")


def texts_with(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n_word``: in how many different texts of ``docs`` each word stands."""
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    word = F.explode(F.array_distinct(F.split("t", TERM_BREAK))).alias("word")
    by_row = texts.select(word, F.lit(1).cast("long").alias("n"))
    # Every row counts, then the rows beyond the first of a text are taken off: only copied texts are moved.
    copied = texts.groupBy(F.unhex(F.md5(F.col("t").cast("binary"))).alias("text_key")).agg(F.count("*").alias("rows")).filter("rows > 1")
    moved = _rows_in(docs, _filter_of(copied, "text_key"), text_col)
    once = moved.groupBy("text_key").agg(F.first("t").alias("t"), F.count("*").alias("rows")).filter("rows > 1")
    surplus = once.select(word, (1 - F.col("rows")).alias("n"))
    return by_row.union(surplus).groupBy("word").agg(F.sum("n").alias("n_word"))


def disclosure(scanned: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, share``: the greatest part of an entity's information content that the word discloses.

    All counts are different texts of the whole corpus; copies are no evidence.
    The rate of the entity among the word's texts is taken at its lower bound, so
    one common text is an estimate too, and a weaker one than many.
    """
    texts = scanned.filter(F.size("entities") > 0).groupBy("text_key").agg(F.first("entities").alias("entities"), F.first("words").alias("words"))
    held = texts.select("text_key", F.explode("entities").alias("entity"))
    # Entities of the same texts have the same counts for every word: they are one set, known by two 64-bit sums.
    sets = held.groupBy("entity").agg(F.count("*").alias("n_entity"), F.bit_xor(F.xxhash64("text_key")).alias("a"),
                                      F.bit_xor(F.xxhash64(F.lit(1), "text_key")).alias("b"))
    placed = held.join(sets, "entity").select("text_key", "n_entity", "a", "b").distinct()
    heard = texts.select("text_key", "words").join(placed, "text_key").select("n_entity", "a", "b", F.explode("words").alias("word"))
    # A set of one text meets each of its words once: nothing to count by set.
    alone = heard.filter("n_entity = 1").select("word", F.lit(1).cast("long").alias("texts"), "n_entity")
    both = alone.union(heard.filter("n_entity > 1").groupBy("n_entity", "a", "b", "word").agg(F.count("*").alias("texts")).select("word", "texts", "n_entity")).distinct()
    total = scanned.select("text_key").distinct().count()
    prior = F.col("n_entity") / F.lit(float(max(total, 1)))
    information = -F.log2(prior)
    mutual = F.log2(_lower_rate(F.col("texts").cast("double"), F.greatest("n_word", "texts").cast("double")) / prior)
    share = F.when(information > 0, mutual / information).otherwise(F.lit(0.0))
    return both.join(texts_with(docs, text_col), "word").groupBy("word").agg(F.max(share).alias("share"))


def mark(docs: DataFrame, bits: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans, words``: pattern spans, and the words outside them whose bit is set."""
    words_type = pa.list_(pa.struct([("word", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}

        def may(word: str) -> int:
            got = known.get(word)
            if got is None:
                if len(known) >= _REMEMBERED:
                    known.clear()
                got = known[word] = _may_hold(bits, word.encode("utf-8", "surrogatepass"))
            return got

        for f in batches:
            spans, words = [], []
            for t in f["t"].to_pylist():
                t = t or ""
                found = base_spans(t)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                words.append([{"word": w, "start": a, "end": b} for w, a, b in words_outside(t, found) if may(w)])
            yield arrow_batch({"doc_id": f["doc_id"], "spans": spans, "words": words}, {"spans": _list_type(), "words": words_type})

    return texts_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint>>, words array<struct<word:string,start:bigint,end:bigint>>")


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE,
                  remove: float = REMOVE) -> DataFrame:
    """``doc_id, spans, term_spans`` for every row of ``docs``.

    ``spans`` are the pattern spans, ``term_spans`` the words to be generalised
    or removed, both as (kind, start, end) in code points. A word that discloses
    an entity is marked wherever it stands outside a pattern span, in texts
    without that entity too. Null text is empty. Rows that repeat an id and text
    get the same spans; null ids pass. Other columns are ignored; empty table:
    empty result.
    """
    scanned = written(scan(docs, text_col), "personal")
    kind = F.when(F.col("share") >= remove, F.lit("removed")).otherwise(F.lit("generalised")).alias("kind")
    terms = written(disclosure(scanned, docs, text_col).filter(F.col("share") >= generalise).select("word", kind), "terms")
    marked = written(mark(docs, _filter_of(terms.select(F.encode("word", "UTF-8").alias("word")), "word"), id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "marked")
    told = marked.select("row", F.explode("words").alias("w")).select("row", "w.*").join(terms, "word")
    places = told.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("terms"))
    listed = F.transform(F.coalesce("terms", F.expr("array()")), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return marked.select("row", "doc_id", "spans").join(places, "row", "left").select("doc_id", "spans", listed.alias("term_spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with pattern spans replaced by their kind, words generalised to their first letter or removed."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < at:
            continue
        out.append(text[at:a])
        out.append("" if kind == "removed" else f"{text[a]}\N{HORIZONTAL ELLIPSIS}" if kind == "generalised" else f"[{kind.upper()}]")
        at = b
    out.append(text[at:])
    return "".join(out)
