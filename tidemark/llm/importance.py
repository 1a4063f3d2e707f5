"""Importance resampling of documents towards a target distribution of hashed n-grams.

A text's words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII signs; its features are all
runs of 1 to ``max_words`` words, joined by one space, repeats included. A feature's bucket is the crc32 of
its UTF-8 bytes modulo ``buckets``. With s of S features of the source in a bucket and t of T of the target, the
bucket's gain is floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))). A document's weight is the sum
of its features' gains; with Gumbel noise from its doc_id added, the highest scores are a draw without
replacement in proportion to the exponential of the weights.

In a task, the n-grams of each run of texts are interned in an open-addressed table of NumPy arrays:
XXH64 keys probe linearly, an equal key counts only if the bytes agree, and a slot holds its n-gram's bucket and
count. Every occurrence knows its slot, so a bucket is worked out once per distinct n-gram, and the gains of
all occurrences are one gather. Only counts by bucket leave the tasks.

Null and empty texts have no words: no features and weight 0. A very long text is a run of its own, a very long
word one feature. Ties go to the smaller doc_id (null last), then to more features, then to the larger weight;
repeated rows are separate documents and take ranks one after another. A null doc_id has the noise of the empty
text. Without documents, or with an empty target, counts are zero and the formula holds. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, give_back, given_back, slices
from tidemark.session import write_scratch

RUN_BYTES = 4_000_000
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5,
    )
)


# ---- hashing spans of a buffer -----------------------------------------------------


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotated(state + lane * P2, 31) * P1


class Spans:
    """Byte strings given as begin and length in one buffer."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.data, self.begin, self.length = data, begin, length
        # Eight bytes from every place on.
        self.lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))

    def __len__(self) -> int:
        return len(self.begin)

    def xxhash64(self, seed: int = 0) -> np.ndarray:
        """XXH64 of each, all at once: a step takes the next bytes of the spans that have so many."""
        begin, length, lanes = self.begin, self.length, self.lanes
        with np.errstate(over="ignore"):
            out = np.full(len(self), np.uint64(seed) + P5)
            wide = np.flatnonzero(length >= 32)
            if len(wide):
                s = np.uint64(seed)
                state = [np.full(len(wide), v) for v in (s + P1 + P2, s + P2, s, s - P1)]
                for stripe in range(int(length[wide].max()) // 32):
                    on = np.flatnonzero(length[wide] >= 32 * (stripe + 1))
                    at = begin[wide[on]] + 32 * stripe
                    for i in range(4):
                        state[i][on] = _round(state[i][on], lanes[at + 8 * i])
                mixed = sum((_rotated(v, r) for v, r in zip(state, (1, 7, 12, 18), strict=True)), np.uint64(0))
                for v in state:
                    mixed = (mixed ^ _round(np.uint64(0), v)) * P1 + P4
                out[wide] = mixed
            out += length.astype(np.uint64)
            at, left = begin + (length & ~31), length & 31
            for step in range(3):
                on = np.flatnonzero(left >= 8 * (step + 1))
                out[on] = _rotated(out[on] ^ _round(np.uint64(0), lanes[at[on] + 8 * step]), 27) * P1 + P4
            at, left = at + (left & ~7), left & 7
            on = np.flatnonzero(left >= 4)
            four = lanes[at[on]] & np.uint64(0xFFFFFFFF)
            out[on] = _rotated(out[on] ^ (four * P1), 23) * P2 + P3
            at, left = at + (left & ~3), left & 3
            for step in range(3):
                on = np.flatnonzero(left > step)
                one = self.data[at[on] + step].astype(np.uint64)
                out[on] = _rotated(out[on] ^ (one * P5), 11) * P1
            for shift, prime in ((33, P2), (29, P3)):
                out = (out ^ (out >> np.uint64(shift))) * prime
            return out ^ (out >> np.uint64(32))

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a`` have the bytes of spans ``b``."""
        same = self.length[a] == self.length[b]
        on, done = np.flatnonzero(same), 0
        while len(on):
            left = self.length[a[on]] - done
            on, left = on[left > 0], left[left > 0]
            drop = np.uint64(8) * np.uint64(8 - np.minimum(left, 8))
            differ = (self.lanes[self.begin[a[on]] + done] ^ self.lanes[self.begin[b[on]] + done]) << drop
            same[on[differ != 0]] = False
            on, done = on[differ == 0], done + 8
        return same


# ---- the table ---------------------------------------------------------------------


class Interned:
    """An open-addressed table of the distinct spans, with a slot for every occurrence."""

    def __init__(self, spans: Spans, buckets: int):
        size = 1 << max(4, (2 * len(spans)).bit_length())
        keys = spans.xxhash64()
        held = np.full(size, -1, np.int64)  # by slot, one occurrence of its n-gram
        at = (keys & np.uint64(size - 1)).astype(np.int64)
        self.slot = np.zeros(len(spans), np.int64)
        open_ = np.arange(len(spans))
        while len(open_):
            here = at[open_]
            free = held[here] < 0
            held[here[free]] = open_[free]  # one of them stays
            first = held[here]
            same = keys[first] == keys[open_]
            same[same] = spans.equal(first[same], open_[same])
            self.slot[open_[same]] = here[same]
            open_ = open_[~same]
            at[open_] = (at[open_] + 1) & (size - 1)
        used = np.flatnonzero(held >= 0)
        begin = spans.begin[held[used]]
        ends = (begin + spans.length[held[used]]).tolist()
        raw = spans.data.tobytes()
        self.bucket = np.zeros(size, np.int64)
        self.bucket[used] = [zlib.crc32(raw[a:b]) % buckets for a, b in zip(begin.tolist(), ends, strict=True)]
        self.count = np.bincount(self.slot, minlength=size)

    def by_bucket(self, buckets: int) -> np.ndarray:
        return np.bincount(self.bucket, self.count, buckets).astype(np.int64)


def ngrams(texts: pa.Array, max_words: int) -> tuple[Spans, np.ndarray, np.ndarray]:
    """The features of texts, one text's after another's; features, and words, per text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data = LOWER[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = np.concatenate([[False], WORD_BYTES[data], [False]])
    cut = np.zeros(len(data) + 1, bool)  # a text begins or ends here
    cut[offsets] = True
    begin = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    words = np.diff(np.searchsorted(begin, offsets))
    length = end - begin
    if max_words > 1:
        # Words one space apart, so that n-grams are spans too.
        places = np.repeat(np.arange(len(begin)), length) + np.arange(int(length.sum()))
        joined = np.full(int(length.sum()) + len(begin), 0x20, np.uint8)
        joined[places] = data[inside[1:-1]]
        data, begin = joined, np.cumsum(length + 1) - length - 1
        end = begin + length
    last = np.repeat(np.cumsum(words), words)
    first = np.arange(len(begin))
    begins, lengths, owner = [], [], []
    text = np.repeat(np.arange(len(texts)), words)
    for n in range(1, max_words + 1):
        at = first[first + n <= last]
        begins.append(begin[at])
        lengths.append(end[at + n - 1] - begin[at])
        owner.append(text[at])
    if max_words > 1:
        order = np.argsort(np.concatenate(owner), kind="stable")
    else:
        order = slice(None)
    spans = Spans(data, np.concatenate(begins)[order], np.concatenate(lengths)[order])
    return spans, np.bincount(np.concatenate(owner), minlength=len(texts)), words


# ---- over tables -------------------------------------------------------------------


def bucket_counts(texts: DataFrame, buckets: int, max_words: int) -> np.ndarray:
    """Features by bucket in all rows of a column ``text``."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for got in batches:
            for begin, end in slices(got["text"], RUN_BYTES):
                spans, _, _ = ngrams(got["text"].slice(begin, end - begin), max_words)
                found += Interned(spans, buckets).by_bucket(buckets)
            give_back()
        some = np.flatnonzero(found)
        yield batch(schema, bucket=some.astype(np.int32), n=found[some])

    text = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = text.mapInArrow(given_back(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket from features counted in source and target."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (all_source + n) / ((s + 1) * (all_target + n)))) for s, t in pairs],
        np.int64,
    )


def weighed(docs: DataFrame, gains: np.ndarray, max_words: int) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    names = ["doc_id", "n_words", "n_features", "weight"]
    schema = pa.schema([(name, pa.int64()) for name in names])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for begin, end in slices(got["text"], RUN_BYTES):
                spans, features, words = ngrams(got["text"].slice(begin, end - begin), max_words)
                table = Interned(spans, len(gains))
                gained = np.concatenate([[0], np.cumsum(gains[table.bucket][table.slot])])
                ends = np.concatenate([[0], np.cumsum(features)])
                yield batch(
                    schema,
                    doc_id=got["doc_id"].slice(begin, end - begin),
                    n_words=words,
                    n_features=features,
                    weight=gained[ends[1:]] - gained[ends[:-1]],
                )
            give_back()

    text = F.coalesce(docs["text"], F.lit("")).alias("text")
    frame = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text)
    return frame.mapInArrow(given_back(weigh), ", ".join(f"{name} long" for name in names))


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from ``seed`` and doc_id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, 1, 2, 3, ... in ``order``: ranges are sorted apart, then counted together."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = write_scratch(sorted_.withColumn("_at", F.monotonically_increasing_id()), "importance-ranks")
    part = F.shiftright("_at", 33)
    # One row per range.
    sizes = sorted((r["part"], r["n"]) for r in numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = dict(zip([p for p, _ in sizes], accumulate([0, *(n for _, n in sizes)]), strict=False))
    pairs = rows.sparkSession.createDataFrame(list(before.items()), "_part int, _before long")
    placed = numbered.withColumn("_part", part.cast("int")).join(F.broadcast(pairs), "_part")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("place", F.col("_before") + inside + 1).drop("_part", "_before", "_at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    max_words: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs`` (doc_id, text).

    ``percent`` of the documents of ``least_words`` words or more are drawn; rank is null for the others.
    """
    text = docs.select(docs["text"].alias("text"))
    gains = bucket_gains(
        bucket_counts(text, buckets, max_words),
        bucket_counts(target.select(target["text"].alias("text")), buckets, max_words),
    )
    scored = weighed(docs, gains, max_words).withColumn("score", F.col("weight") + noise(seed))
    scored = write_scratch(scored, "importance-scores")
    fit = F.col("n_words") >= least_words
    n = scored.filter(fit).count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.desc("weight")]
    drawn = F.when(F.col("place") <= percent * n // 100, F.col("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    taken = ranked(scored.filter(fit), order).select(*columns, drawn.alias("rank"))
    rest = scored.filter(~fit).select(*columns, F.lit(None).cast("long").alias("rank"))
    return taken.unionByName(rest)
