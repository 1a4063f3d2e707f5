"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, ann, chat, importance, langid, lm, pii, repeats, simhash, sketch, toxicity
from tidemark.llm.common import documents, remainder
from tidemark.llm.mixing import mix
from tidemark.llm.packing import pack

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def word_tokenizer() -> str:
    """The tokenizer file that the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(documents(spark, sf_dir), words=3, distance=3, seed=42)


@query
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rest = remainder(docs["doc_id"], 5)
    model = langid.learn(docs.filter(rest != 0), F.col("lang"))
    asked = docs.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "text")
    return langid.predict(asked, model, ["doc_id", "held_out"])


@query
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(vectors, F.col("id") % 50 == 0, k=5, bits=64, radius=29)


@query
def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


@query
def op6_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(documents(spark, sf_dir))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    scorer = toxicity.learn(docs, labels.filter(remainder(F.col("doc_id"), 4) != 2))
    held_out = F.coalesce(remainder(docs["doc_id"], 4) == 2, F.lit(False))
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), scorer, threshold=0.3)


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.digests(chat.format_conversations(conversations))


ORACLES["op8_chat"] = chat.DIGESTS_SQL


@query
def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rest = remainder(docs["doc_id"], 5)
    model = lm.learn(docs.filter(rest != 1))
    held_out = F.coalesce(rest == 1, F.lit(False))
    return lm.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@query
def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), word_tokenizer())


@query
def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.removed(documents(spark, sf_dir), length=100))


@query
def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    byte_bpe, pieces = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(documents(spark, sf_dir), byte_bpe, pieces)


@query
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.resample(
        documents(spark, sf_dir), target, max_words=1, buckets=10_000, least_words=20, percent=10, seed=2024
    )
