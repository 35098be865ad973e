"""Exact deduplication on DataFrame functions only.

Texts are equal when identical after deleting white space. Rows are grouped by
a 128-bit content hash *and* the text itself, so the grouping compares bytes
inside every hash group and a hash collision cannot merge two texts; the hash
only decides where rows meet. Copies are folded map-side, so a group that holds
a third of all rows is a few rows per task by the time it is shuffled.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

_SPAN = "18446744073709551616"  # 2**64: code points and id share one decimal order


def normalised(text: Column) -> Column:
    """The text (null: empty) without ``[\\x20\\x09-\\x0D]``."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def _keyed(docs: DataFrame, id_col: str, text_col: str, content_hash) -> DataFrame:
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    norm = base.select("doc_id", F.length("_t").cast("long").alias("_cp"), normalised(F.col("_t")).alias("_n"))
    return norm.select("doc_id", "_cp", "_n", content_hash(F.col("_n")).alias("_h"))


def _classes(keyed: DataFrame) -> DataFrame:
    """One row per distinct normalised text: hash, digest, size and the id that stays."""
    id_type = keyed.schema["doc_id"].dataType
    # Most code points first, then the smallest id (a null id after all others).
    order = (F.col("_cp").cast("decimal(20,0)") * F.expr(f"{_SPAN}BD")
             + F.coalesce(F.lit(9223372036854775806).cast("decimal(20,0)") - F.col("doc_id").cast("long").cast("decimal(20,0)"),
                          F.lit(-9223372036854775808).cast("decimal(20,0)")))
    return (keyed.withColumn("_o", order.cast("decimal(38,0)")).groupBy("_h", "_n")
            .agg(F.count("*").alias("group_size"), F.max_by("doc_id", "_o").cast(id_type).alias("keep_id"))
            .select("_h", F.sha2(F.encode("_n", "UTF-8"), 256).alias("text_sha256"), "group_size", "keep_id"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 content_hash=lambda n: F.md5(F.encode(n, "UTF-8"))) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Null text is the empty text; empty texts are equal to each other. Of equal
    texts the row with the most code points in the original stays, then the
    smallest id. Rows that repeat the same id and text count in ``group_size``;
    all of them name the same ``keep_id`` and only :func:`drop_copies` folds
    them. A null id is kept only where its group has no other id. Other columns
    of ``docs`` are ignored, whatever their names. Empty table: empty result.
    ``content_hash`` may be any hash of the text; a weak one costs time, never
    correctness.
    """
    keyed = _keyed(docs, id_col, text_col, content_hash)
    rows = keyed.select("doc_id", "_h", F.sha2(F.encode("_n", "UTF-8"), 256).alias("text_sha256"))
    return (rows.join(_classes(keyed), ["_h", "text_sha256"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged, one row per distinct text.

    Column names of the input may be any. Empty table: empty result.
    """
    keep, digest, own = fresh(docs, "_keep", "_digest", "_digest_own")
    keyed = _keyed(docs, id_col, text_col, lambda n: F.md5(F.encode(n, "UTF-8")))
    stay = _classes(keyed).select(F.col("keep_id").alias(keep), F.col("text_sha256").alias(digest))
    tagged = docs.withColumn(own, F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256))
    met = tagged.join(stay, F.col(id_col).eqNullSafe(F.col(keep)) & (F.col(own) == F.col(digest)))
    return met.dropDuplicates([keep, digest]).select(*[F.col(f"`{c}`") for c in docs.columns])
