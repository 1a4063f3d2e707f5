"""A corpus pipeline of five stages over `documents`.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of `documents`. ``run`` writes each result as Parquet to the shared
folder and reads it again, so that a lost executor never costs more than a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid, pii, simhash
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.packing import pack
from tidemark.llm.queries import word_tokenizer
from tidemark.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have a language, mixed ones too; fills in a null lang.

    Texts are read whole. Null and empty texts and those without letters have no language and go; of equal shares of
    a text the first language by code point counts. Repeated rows stay, no rows give no rows, and columns beside
    those of documents go.
    """
    return langid.identified(docs, langid.learn(docs, docs["lang"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of three-word SimHashes at most three bits apart.

    Texts are read whole; null counts as empty, and all without words are one component. The smallest doc_id stays
    (null is the largest), of equal ones the text with the smallest hash, so repeated rows become one. No rows give
    no rows, and columns beside those of documents go.
    """
    return simhash.first_of_each(docs, words=3, distance=3, seed=42)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; keeps every document.

    Texts are read whole; null stays null and empty stays empty. Overlapping spans become one, named by the first. Repeated
    rows stay, no rows give no rows, and columns beside those of documents go.
    """
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the words that the mix of sources takes, once for each time it takes them.

    Null, empty and wordless texts are never taken; a very long one may come in part. A null source is a source,
    the last one. Repeated rows are documents of their own, no rows give no rows, and columns beside those of documents go.
    """
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences.

    A null or empty text is the end id alone, a long one is cut into pieces. Repeated rows are packed each. Equal
    lengths go by doc_id, to the first sequence of those of equal cost. No rows give no rows, and other columns are ignored.
    """
    return pack(docs, word_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language models, CRF decoding and pseudorandom draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
