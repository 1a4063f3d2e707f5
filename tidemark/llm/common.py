"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import math
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The columns of `documents`, and words as the contracts define them.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(docs: DataFrame) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(docs["text"], F.lit(""))


def remainder(column: Column, divisor: int) -> Column:
    """crc32 of a value as text, modulo ``divisor``; null for null."""
    return F.crc32(column.cast("string")) % divisor


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The columns of `documents` and text_hash, one row per doc_id and text."""
    keyed = docs.select(*DOCUMENT_COLUMNS, F.xxhash64(text_of(docs)).alias("text_hash"))
    one = Window.partitionBy("doc_id", "text_hash").orderBy("doc_id", "text_hash")
    return keyed.withColumn("_nth", F.row_number().over(one)).filter("_nth = 1").drop("_nth")


def root_buckets(rows: int) -> int:
    """About as many buckets as a bucket has rows, so that neither level of two grows large."""
    return max(1, math.isqrt(max(rows, 1)))


def runs(texts: list, budget: int) -> Iterator[tuple[int, int]]:
    """Index ranges of at most ``budget`` characters each; a longer text is alone."""
    begin = total = 0
    for i, text in enumerate(texts):
        if total + len(text) > budget and i > begin:
            yield begin, i
            begin, total = i, 0
        total += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def slices(texts: pa.Array, budget: int) -> Iterator[tuple[int, int]]:
    """Index ranges of an Arrow array of at most ``budget`` bytes each; a longer text is alone."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    return runs([range(n) for n in sizes.tolist()], budget)


def cuts(got: pa.RecordBatch, column: str, budget: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, of at most ``budget`` bytes of a text column each (null: none); a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(got[column]), 0).to_numpy(zero_copy_only=False)
    for begin, end in runs([range(n) for n in sizes.tolist()], budget):
        yield got.slice(begin, end - begin)


def give_back() -> None:
    """Hands freed memory to the system; allocators otherwise keep what they once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def given_back(work: Callable[[Iterator], Iterator], keeps: str | None = None) -> Callable[[Iterator], Iterator]:
    """``work`` of a task, which gives freed memory back at its end: Python workers live on.

    Of what :func:`per_worker` keeps, only things of the kind ``keeps`` outlive the task's beginning: what another
    operator left in the worker would stay for good.
    """

    def run(batches: Iterator) -> Iterator:
        if forget(keeps):
            give_back()
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def _kept() -> dict:
    return sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__


def per_worker(name: tuple, make: Callable):
    """What ``make`` gives, made once per Python worker and kept between its tasks; the name begins with its kind."""
    kept = _kept()
    if name not in kept:
        kept[name] = make()
    return kept[name]


def forget(but: str | None) -> bool:
    """Drops what :func:`per_worker` keeps, ``but`` one kind; whether there was any."""
    kept = _kept()
    gone = [name for name in kept if isinstance(name, tuple) and name[0] != but]
    for name in gone:
        del kept[name]
    return bool(gone)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
