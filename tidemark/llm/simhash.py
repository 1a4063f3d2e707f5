"""SimHash fingerprints, and near duplicates by a binary trie self-join.

Fingerprints at most ``distance`` bits apart are linked, and components are the classes of that
relation's closure. Only distinct fingerprints are compared. By the pigeonhole principle two
linked ones agree in one of ``distance + 1`` bit blocks, so they are dealt by each block's
value. In a bucket, the binary trie of its fingerprints is joined with itself: pairs of nodes
go down together, differing bits add up, and a pair is pruned over ``distance`` bits, or
once all below it is connected. A bucket of more than ``hot`` fingerprints is dealt again by
blocks of its remaining bits, which loses no link. A bucket yields one edge per connected
member, not all pairs; components come from alternating large and small stars over the edges.

Null texts count as empty; texts without words have fingerprint zero, linked like any other.
Rows with one doc_id are separate documents and give a row each. A null doc_id takes no part in
component_id, which is null if a component has no other. Texts are read whole, however long. A bit that is set in
exactly half of the shingles' hashes is 0, and of a component's documents the smallest doc_id names it (``first_of_each``
keeps that one, of equal ones the text with the smallest hash). No rows give no rows. Other columns are
ignored by ``components``; ``first_of_each`` keeps those of `documents`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import DOCUMENT_COLUMNS, batch, cuts, distinct_documents, given_back, text_of
from tidemark.session import write_scratch

BITS = 64
CHUNK_ROWS = 1 << 16
RUN_BYTES = 2_000_000
FRONTIER = 1 << 20
DIRECT = 64  # node pairs of at most so many fingerprint pairs are compared at once
TASK_ROWS = 400_000

# ---- fingerprints ------------------------------------------------------------------


def simhash(text: str, words: int, seed: int) -> int:
    """The bits set in over half of the hashes of the shingles, repeats included."""
    import xxhash

    split = text.encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not split:
        return 0
    joined = b" ".join(split)
    if len(split) <= words:
        shingles = [joined]
    else:
        ends = np.cumsum([len(w) + 1 for w in split]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        cuts = zip(starts[: len(split) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
        shingles = [joined[a:b] for a, b in cuts]
    counts = np.zeros(BITS, np.int64)
    for begin in range(0, len(shingles), CHUNK_ROWS):
        some = shingles[begin : begin + CHUNK_ROWS]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(seed)), "<u8", len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, text_hash, fp: a signed 64-bit fingerprint per row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def print_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in (some for whole in batches for some in cuts(whole, "text", RUN_BYTES)):
            prints = np.array([simhash(t, words, seed) for t in got["text"].to_pylist()], np.uint64)
            yield batch(schema, doc_id=got["doc_id"], text_hash=got["text_hash"], fp=prints.view(np.int64))

    text = text_of(docs)
    frame = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    return frame.mapInArrow(given_back(print_), "doc_id long, text_hash long, fp long")


# ---- the trie self-join of a task's buckets ----------------------------------------


class Classes:
    """Connected classes of rows; a class is named by its first row."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self._runs()

    def _runs(self) -> None:
        ends = np.flatnonzero(np.append(self.label[1:] != self.label[:-1], True)) + 1
        self.run_end = np.repeat(ends, np.diff(ends, prepend=0))

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            root = np.arange(len(self.label))
            np.minimum.at(root, np.maximum(la, lb), np.minimum(la, lb))
            while (root[root] != root).any():
                root = root[root]
            self.label = root[self.label]
        self._runs()

    def settled(self, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
        """Which node pairs have all their rows in one class."""
        uniform = (self.run_end[a] >= a_end) & (self.run_end[b] >= b_end)
        return uniform & (self.label[a] == self.label[b])


def trie_classes(prints: np.ndarray, bounds: np.ndarray, distance: int) -> np.ndarray:
    """Classes of rows linked within buckets; a bucket's distinct fingerprints are sorted."""
    classes = Classes(len(prints))
    lo, hi = bounds[:-1], bounds[1:]
    stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        depth, a, a_end, b, b_end, errors = stack.pop()
        if len(a) > FRONTIER:
            # Nodes with themselves first: what they connect prunes the others.
            order = np.argsort(a != b, kind="stable")
            half = len(order) // 2
            for part in (order[half:], order[:half]):
                stack.append((depth, a[part], a_end[part], b[part], b_end[part], errors[part]))
            continue
        live = ~classes.settled(a, a_end, b, b_end)
        a, a_end, b, b_end, errors = a[live], a_end[live], b[live], b_end[live], errors[live]
        if not len(a):
            continue
        pairs = (a_end - a) * (b_end - b)
        small = (pairs <= DIRECT) | (depth == BITS)
        if small.any():
            _compare(prints, classes, a[small], a_end[small], b[small], b_end[small], pairs[small], distance)
        a, a_end, b, b_end, errors = a[~small], a_end[~small], b[~small], b_end[~small], errors[~small]
        if not len(a):
            continue
        zero = (prints >> np.uint64(BITS - 1 - depth)) & np.uint64(1) == 0
        zeros = np.concatenate([[0], np.cumsum(zero)])
        a_mid, b_mid = a + zeros[a_end] - zeros[a], b + zeros[b_end] - zeros[b]
        cross = a != b
        parts = [
            (a, a_mid, b, b_mid, errors, None),
            (a_mid, a_end, b_mid, b_end, errors, None),
            (a, a_mid, b_mid, b_end, errors + 1, None),
            (a_mid, a_end, b, b_mid, errors + 1, cross),
        ]
        children = []
        for p, p_end, q, q_end, e, only in parts:
            keep = (p_end > p) & (q_end > q) & (e <= distance)
            keep = keep if only is None else keep & only
            children.append((p[keep], p_end[keep], q[keep], q_end[keep], e[keep].astype(np.int8)))
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*children, strict=True))))
    return classes.label


def _compare(prints, classes, a, a_end, b, b_end, pairs, distance) -> None:
    """Compare all fingerprints below the given small node pairs."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(pairs) // FRONTIER)) + 1, [len(a)]])
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        count = pairs[begin:end]
        which = np.repeat(np.arange(begin, end), count)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        width = (b_end - b)[which]
        i, j = a[which] + nth // width, b[which] + nth % width
        near = np.bitwise_count(prints[i] ^ prints[j]) <= distance
        near &= i != j
        if near.any():
            classes.join(i[near], j[near])


def bucket_edges(key: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each linked fingerprint to the first of its class, over a task's buckets."""
    order = np.lexsort((prints, key))
    key, prints = key[order], prints[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    bounds = np.append(starts, len(key))
    found: list[tuple[np.ndarray, np.ndarray]] = [(prints[:0], prints[:0])]
    first = 0
    while first < len(starts):
        last = first + 1
        while last < len(starts) and bounds[last + 1] - bounds[first] <= CHUNK_ROWS:
            last += 1
        base, some = bounds[first], prints[bounds[first] : bounds[last]]
        label = trie_classes(some, bounds[first : last + 1] - base, distance)
        linked = np.flatnonzero(label != np.arange(len(label)))
        found.append((some[linked], some[label[linked]]))
        first = last
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---- dealing -----------------------------------------------------------------------


def _blocks(bits: int, count: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``count`` blocks that cover ``bits`` bits."""
    edges = [bits * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _dealt(rows: DataFrame, bits: int, distance: int) -> DataFrame:
    """Each row once per block of its ``rest``: the key grows by the block's number and value."""

    def ones(n: int) -> Column:
        return F.lit((1 << n) - 1 if n < 63 else -1).cast("long")

    parts = []
    for number, (low, width) in enumerate(_blocks(bits, distance + 1)):
        value = F.shiftrightunsigned("rest", low).bitwiseAND(ones(width))
        above = F.shiftleft(F.shiftrightunsigned("rest", low + width), low) if low + width < bits else F.lit(0).cast("long")
        rest = above.bitwiseOR(F.col("rest").bitwiseAND(ones(low)))
        key = F.xxhash64("key", F.lit(number), value)
        parts.append(F.struct(key.alias("key"), rest.alias("rest")))
    return rows.select("fp", F.explode(F.array(*parts)).alias("p")).select("fp", "p.key", "p.rest")


def edges(prints: DataFrame, distance: int, hot: int = 4096) -> DataFrame:
    """a, b: edges between distinct fingerprints (``fp``) that connect exactly what links connect.

    Keys of buckets are hashes of block values; two buckets with one key only meet needlessly.
    """
    spark = prints.sparkSession
    edge = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b["key"].to_numpy(), b["fp"].to_numpy()) for b in batches if b.num_rows]
        if got:
            key, fp = (np.concatenate(x) for x in zip(*got, strict=True))
            a, b = bucket_edges(key, fp.astype(np.int64).view(np.uint64), distance)
            for begin in range(0, len(a), CHUNK_ROWS):
                part = slice(begin, begin + CHUNK_ROWS)
                yield batch(edge, a=a[part].view(np.int64), b=b[part].view(np.int64))

    rows = prints.select("fp", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("key"))
    bits, done = BITS, []
    while True:
        rows = write_scratch(_dealt(rows, bits, distance), "simhash-buckets")
        bits -= max(w for _, w in _blocks(bits, distance + 1))
        large = rows.groupBy("key").count().filter(F.col("count") > hot).select("key")
        if bits < 4 * (distance + 1) or distance == 0 or large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, "key", "left_anti"))
        rows = rows.join(large, "key", "left_semi")
    found = []
    for part in done:
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(part.count() / TASK_ROWS))
        found.append(part.select("key", "fp").repartition(tasks, "key").mapInArrow(given_back(join), "a long, b long"))
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def roots(pairs: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for each node of the pairs ``a``, ``b``."""

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())

    def star(df: DataFrame) -> DataFrame:
        least = df.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        return df.join(least, "a")

    now = write_scratch(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "simhash-edges"
    )
    before = mark(now)
    while before[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = star(large)
        small = small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            small.select("a", F.col("m").alias("b"))
        )
        now = write_scratch(small.distinct(), "simhash-edges")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _classes(docs: DataFrame, words: int, distance: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints by row, and fp, root of every distinct fingerprint."""
    prints = write_scratch(fingerprints(docs, words, seed), "simhash-prints")
    distinct = prints.select("fp").distinct()
    found = roots(edges(distinct, distance))
    named = distinct.join(found, distinct["fp"] == found["node"], "left")
    return prints, named.select("fp", F.coalesce("root", "fp").alias("root"))


def components(docs: DataFrame, *, words: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (its smallest doc_id), a row for each row."""
    prints, named = _classes(docs, words, distance, seed)
    by_print = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(named, "fp")
    by_root = by_print.groupBy("root").agg(F.min("least").alias("component_id"))
    member = by_print.join(by_root, "root").select("fp", "component_id")
    return prints.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, *, words: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """The columns of `documents`, one row per component: that of the smallest doc_id.

    Of rows with that doc_id, the text with the smallest hash stays, once; null is the largest doc_id.
    """
    prints, named = _classes(docs, words, distance, seed)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    per_print = prints.groupBy("fp").agg(F.min(order).alias("best"))
    best = per_print.join(named, "fp").groupBy("root").agg(F.min("best").alias("best"))
    keep = best.select(F.col("best.doc_id").alias("d"), F.col("best.text_hash").alias("h"))
    once = distinct_documents(docs)
    return once.join(
        keep, once["doc_id"].eqNullSafe(F.col("d")) & (once["text_hash"] == F.col("h"))
    ).select(*DOCUMENT_COLUMNS)
