"""The registered queries of the training-data operators, on whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, embedding_dedup, exact_dedup, langid, minhash, mixing, order_minhash, packing, pii, quality, sharding, source_audit
from .common import documents, fold, ship_package
from .oracles import ORACLES  # noqa: F401


def op1_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = fold("doc_id", 3) == 1
    model = quality.fit_quality(docs.filter(~held), labels.filter(~held))
    return quality.score_quality(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "size_difference")


def op2_mix_hierarchical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op3_pack_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pack_documents(docs)


def pack_documents(docs: DataFrame) -> DataFrame:
    pieces = packing.tokenize_pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack_pieces(pieces, packing.groups_for(docs.count()))


def op4_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = f"{chat.END}{chat.START}assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.read_back(chat.format_chat(table.union(extra)))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op6_minhash_circulant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir), size=4)


def op7_langid_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = fold("doc_id", 5) == 0
    model = langid.fit_languages(docs.filter(~held))
    return langid.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op8_embedding_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_shard_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op10_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    order = lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, (*pii.KINDS, *pii.TERM_KINDS))), s["kind"]).alias("k"),
                               s["kind"].alias("kind"), s["end"].alias("end"))
    every = F.array_sort(F.transform(F.concat("spans", "term_spans"), order))
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(F.encode(pii.span_text(F.col("spans")), "UTF-8"), 256).alias("base_sha256"),
                        pii.span_text(every).alias("spans"), F.size("term_spans").cast("long").alias("n_terms"))


def op11_phrases_setm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_source_spimi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(documents(spark, sf_dir))


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(documents(spark, sf_dir))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _shipped(f) for f in (
    op1_quality_compression, op2_mix_hierarchical, op3_pack_swap, op4_chat_tokens, op5_exact_dedup, op6_minhash_circulant,
    op7_langid_cross_parsing, op8_embedding_binary_codes, op9_shard_hilbert, op10_pii_disclosure, op11_phrases_setm, op12_source_spimi, op13_order_minhash)}
