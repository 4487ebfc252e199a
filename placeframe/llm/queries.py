"""The registered queries of this subpackage: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeframe.llm import ann, bpe_codec, fim, langid, minhash, mixing, repair, sharding, token_count, token_files, toxicity, vector_dedup, warc
from placeframe.llm.common import held_out
from placeframe.session import fresh_dir

VOCABULARY = "byte_bpe_50k.json"
#: Documents with more tokens are over the limit.
TOKEN_LIMIT = 512
#: Ends each document in token files.
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.AT).cast("int").alias("predicted"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = token_count.count_tokens(docs, public_tokenizers.path(VOCABULARY), keep=["doc_id", "n_bytes"])
    return counted.select("*", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return codec_digests(bpe_codec.encode_documents(docs, public_tokenizers.path(VOCABULARY), keep=["doc_id"], decoded="decoded"))


def codec_digests(coded: DataFrame) -> DataFrame:
    """Digests of ids and decoded texts (columns ids and decoded)."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return placed.select(
        "doc_id",
        "source",
        F.col("__epoch").alias("epoch"),
        F.col("__block").alias("block"),
        F.col("__release").alias("release"),
        F.col("__deadline").alias("deadline"),
        F.col("__slot").alias("slot"),
        F.col("__place").alias("place"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit_languages(docs), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.convert_pages(table(spark, sf_dir, "pages"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY), end=END_ID)
    return token_files.token_file_digests(spark, path)


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    found = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    back = fim.restore_middle(made, keep=[*found, "output"])
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return back.select(*found, digest("output").alias("output_sha256"), digest("text").alias("restored_sha256"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_token_count": op3_token_count,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_nearest": op5_nearest,
    "op6_vector_dedup": op6_vector_dedup,
    "op7_mixing": op7_mixing,
    "op8_language_id": op8_language_id,
    "op9_minhash": op9_minhash,
    "op10_warc": op10_warc,
    "op11_repair": op11_repair,
    "op12_token_files": op12_token_files,
    "op13_fim": op13_fim,
}
