"""Mixing sources to target weights, from fixed-length blocks of words.

Each source's documents, in the order of a hash, form one stream of words that is packed into
blocks. Output shards of ``shard_slots`` slots draw their counts per source: the whole part of
each expected count, and the rest multinomially. A slot of a source is numbered over all shards;
the slot number gives an epoch and, through that epoch's pseudorandom permutation of the source's
block indexes, a block. So within an epoch no block is drawn twice, and none more than
``most`` times. Slots are joined with blocks by index.

Targets: sources by code point, null last, weigh 1, 2, 3, and so on again. They share the words of
all sources by weight, but none gets more than ``most`` times its own words; the excess is reshared.

Null texts have no words. Documents without words are never taken. Rows with one doc_id are separate
documents; equal rows are interchangeable, and those that share a part of a stream lie by doc_id and text hash. Very long
texts are cut into blocks like others, so a document may lie in many. No rows give no rows. Columns other than doc_id, text and
source are ignored by ``mix``; ``mixed_documents`` keeps those of ``documents``. The driver
holds one row per source (name, size, target), nothing per document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import DOCUMENT_COLUMNS, WORD, batch, cuts, distinct_documents, given_back, root_buckets, text_of
from tidemark.session import write_scratch

SLOTS = "shard long, slot long, source_ix int, epoch int, block long"

TASK_SLOTS = 500_000
BROADCAST_SOURCES = 100_000
RUN_BYTES = 2_000_000


@dataclass
class Source:
    name: str | None
    size: int
    target: float
    blocks: int
    slots: float  # expected


def targets(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``most`` times its size."""
    left, weight, result = float(sum(sizes)), float(sum(weights)), [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / weights[i])
    for place, i in enumerate(order):
        if most * sizes[i] > left / weight * weights[i]:
            for j in order[place:]:
                result[j] = left / weight * weights[j]
            break
        result[i] = float(most * sizes[i])
        left, weight = left - result[i], weight - weights[i]
    return result


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n): a Feistel network, walked until inside."""
    half = max(1, math.ceil(n.bit_length() / 2))
    mask, out = np.uint64((1 << half) - 1), np.array(index, np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for turn in range(4):
            mixed = (right + np.uint64((key * 4 + turn + 1) % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def shard_counts(rng: np.random.Generator, slots: int, share: np.ndarray) -> np.ndarray:
    """Slots per source: whole expected slots, the rest drawn multinomially."""
    expected = slots * share
    counts = np.floor(expected).astype(np.int64)
    rest = int(slots - counts.sum())
    if rest > 0:
        odds = np.maximum(expected - counts, 0)
        odds = odds / odds.sum() if odds.sum() > 0 else share
        counts += rng.multinomial(rest, odds)
    return counts


class Mix:
    """Sizes, targets, and the slots and document parts of one mix."""

    def __init__(self, docs: DataFrame, *, block_words: int = 64, shard_slots: int = 1024, most: int = 3, seed: int = 7):
        self.docs, self.block_words, self.shard_slots = docs, block_words, shard_slots
        self.most, self.seed, self.spark = most, seed, docs.sparkSession
        text = text_of(docs)
        buckets = root_buckets(docs.count())
        self.sizes = write_scratch(
            docs.select(
                docs["doc_id"].alias("doc_id"),
                docs["source"].alias("source"),
                F.xxhash64(text).alias("text_hash"),
                F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            ).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets))),
            "mix-sizes",
        )
        self.by_bucket = self.sizes.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        self.sources = self._sources()

    def _sources(self) -> list[Source]:
        found = self.by_bucket.groupBy("source").agg(F.sum("words").alias("size")).collect()
        found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
        sizes = [r["size"] for r in found]
        wanted = targets(sizes, [float(i % 3 + 1) for i in range(len(found))], self.most)
        sources = []
        for row, target in zip(found, wanted, strict=True):
            blocks = math.ceil(row["size"] / self.block_words)
            slots = target * blocks / row["size"] if row["size"] else 0.0
            sources.append(Source(row["source"], row["size"], target, blocks, slots))
        return sources

    def source_table(self) -> DataFrame:
        # An Arrow table: rows would start Python workers on the executors, beside those of the operators.
        rows = [{"source_ix": i, "source": s.name, "source_size": s.size, "target": s.target} for i, s in enumerate(self.sources)]
        kinds = [("source_ix", pa.int32()), ("source", pa.string()), ("source_size", pa.int64()), ("target", pa.float64())]
        return self.spark.createDataFrame(pa.Table.from_pylist(rows, pa.schema(kinds)))

    def with_sources(self, rows: DataFrame, *keys: str) -> DataFrame:
        """``rows`` joined with columns of the source table: broadcast if it is small, else shuffled."""
        table = self.source_table()
        small = F.broadcast(table) if len(self.sources) <= BROADCAST_SOURCES else table
        return rows.join(small, list(keys)) if keys else rows.join(
            small.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
        )

    def slots(self) -> DataFrame:
        """Rows of ``SLOTS``: which block each slot of each shard takes."""
        per, most, seed = self.shard_slots, self.most, self.seed
        blocks = [s.blocks for s in self.sources]
        expected = np.array([s.slots for s in self.sources])
        total = int(round(expected.sum())) if len(expected) else 0
        if not total:
            return self.spark.createDataFrame([], SLOTS)
        share = expected / expected.sum()

        def draw(shards: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in shards:
                drawn = [
                    shard_counts(np.random.default_rng([seed, h]), min(per, total - h * per), share)
                    for h in pdf["id"].tolist()
                ]
                yield pd.DataFrame(
                    {
                        "shard": np.repeat(pdf["id"].to_numpy(), len(share)),
                        "source_ix": np.tile(np.arange(len(share), dtype=np.int32), len(pdf)),
                        "n": np.concatenate(drawn),
                    }
                )

        def place(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in rows:
                n = pdf["n"].to_numpy()
                at = np.repeat(np.arange(len(pdf)), n)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                source = pdf["source_ix"].to_numpy()[at]
                size = np.array(blocks)[source]
                number = pdf["first"].to_numpy()[at] + nth
                epoch, index, block = number // size, number % size, np.zeros(len(at), np.int64)
                for ix, e in np.unique(np.column_stack([source, epoch]), axis=0).tolist():
                    now = (source == ix) & (epoch == e)
                    block[now] = permuted(index[now], blocks[ix], (seed * 1_000_003 + ix) * 1_000 + e)
                drawn = pd.DataFrame(
                    {
                        "shard": pdf["shard"].to_numpy()[at],
                        "slot": pdf["slot"].to_numpy()[at] + nth,
                        "source_ix": source.astype(np.int32),
                        "epoch": epoch.astype(np.int32),
                        "block": block,
                    }
                )
                yield drawn[epoch < most]

        shards = math.ceil(total / per)
        counts = self.spark.range(shards).mapInPandas(draw, "shard long, source_ix int, n long")
        # Slot numbers by running sums, within groups of shards and over the groups.
        group = math.isqrt(shards) + 1
        grouped = counts.withColumn("g", F.expr(f"shard div {group}"))
        upto = (Window.unboundedPreceding, -1)
        over_groups = Window.partitionBy("source_ix").orderBy("g").rowsBetween(*upto)
        in_group = Window.partitionBy("source_ix", "g").orderBy("shard").rowsBetween(*upto)
        in_shard = Window.partitionBy("shard").orderBy("source_ix").rowsBetween(*upto)

        def running(window) -> Column:
            return F.coalesce(F.sum("n").over(window), F.lit(0))

        starts = grouped.groupBy("source_ix", "g").agg(F.sum("n").alias("n"))
        starts = starts.select("source_ix", "g", running(over_groups).alias("start"))
        numbered = (
            grouped.withColumn("inside", running(in_group))
            .join(starts, ["source_ix", "g"])
            .withColumn("first", F.col("start") + F.col("inside"))
            .withColumn("slot", running(in_shard))
        )
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_SLOTS))
        # Written: the plan can't know how many rows the draws give, and would broadcast them.
        return write_scratch(numbered.repartition(tasks, "shard", "source_ix").mapInPandas(place, SLOTS), "mix-slots")

    def spans(self) -> DataFrame:
        """Each document with words: its place in the stream of its source."""
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = self.by_bucket.select(
            "source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_start")
        )
        starts = starts.toDF("s", "b", "bucket_start")
        inside = (
            Window.partitionBy("source", "bucket")
            .orderBy("doc_id", "text_hash")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        placed = self.sizes.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        joined = placed.join(
            starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
        )
        return (
            self.with_sources(joined.filter("size > 0"))
            .select("doc_id", "text_hash", "size", "source_ix", (F.col("bucket_start") + F.col("inside")).alias("start"))
        )

    def parts(self) -> DataFrame:
        """Documents by block: doc_id, text_hash, size, source_ix, start, block, from_word, words."""
        b = self.block_words
        end = F.col("start") + F.col("size")
        block = F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})"))
        return (
            self.spans()
            .withColumn("block", block)
            .withColumn("from_word", F.greatest(F.col("block") * b - F.col("start"), F.lit(0)))
            .withColumn("words", F.least(end, (F.col("block") + 1) * b) - F.col("start") - F.col("from_word"))
        )


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of each document."""
    m = Mix(docs, **options)
    times = m.slots().groupBy("source_ix", "block").agg(F.count("*").alias("times"))
    taken = (
        m.parts()
        .join(times, ["source_ix", "block"], "left")
        .groupBy("source_ix", "start", "doc_id", "size")
        .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
        .select("doc_id", "size", "source_ix", "taken")
    )
    empty = m.with_sources(m.sizes.filter("size = 0"))
    empty = empty.select("doc_id", "size", "source_ix", F.lit(0).cast("long").alias("taken"))
    return m.with_sources(taken.unionByName(empty), "source_ix").select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: one row per document and epoch, with the words taken in it.

    A document taken whole keeps its text; of another, its runs of taken words stand in lines.
    """
    m = Mix(docs, **options)
    drawn = m.slots().select("source_ix", "block", "epoch")
    pieces = (
        m.parts()
        .join(drawn, ["source_ix", "block"])
        .groupBy("doc_id", "text_hash", "size")
        .agg(F.collect_list(F.struct("start", "epoch", "from_word", "words")).alias("pieces"))
        .select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "size", "pieces")
    )
    once = distinct_documents(docs)
    joined = once.join(
        pieces, once["doc_id"].eqNullSafe(F.col("d")) & (once["text_hash"] == F.col("h"))
    ).drop("d", "h", "text_hash")
    schema = docs.select(*DOCUMENT_COLUMNS).schema
    kinds = pa.schema([(c, pa.int64() if c in ("doc_id", "n_chars") else pa.string()) for c in DOCUMENT_COLUMNS])
    word = re.compile(WORD)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in (some for whole in batches for some in cuts(whole, "text", RUN_BYTES)):
            out: dict[str, list] = {c: [] for c in DOCUMENT_COLUMNS}
            for row in got.to_pylist():
                copies: dict[tuple, list] = {}
                for p in row["pieces"]:
                    copies.setdefault((p["start"], p["epoch"]), []).append((p["from_word"], p["words"]))
                places = None
                for key in sorted(copies):
                    taken = sorted(copies[key])
                    if sum(n for _, n in taken) == row["size"]:
                        text = row["text"]
                    else:
                        places = places or [x.span() for x in word.finditer(row["text"])]
                        merged: list[list[int]] = []
                        for first, n in taken:
                            if merged and merged[-1][1] == first:
                                merged[-1][1] = first + n
                            else:
                                merged.append([first, first + n])
                        text = "\n".join(row["text"][places[a][0] : places[b - 1][1]] for a, b in merged)
                    for c in DOCUMENT_COLUMNS:
                        out[c].append({"text": text, "n_chars": len(text)}.get(c, row[c]))
            yield batch(kinds, **out)

    return joined.mapInArrow(given_back(cut), schema)
