"""Approximate nearest neighbours by cosine: multi-index hashing over learned rotated binary codes.

Codes: vectors are normalised, rotated by a learned orthogonal matrix (iterative quantisation on a
bounded sample; further bits come from further rotations) and cut to signs. Index: rows are dealt to
blocks by a hash of their id; a block holds, for each substring of the codes, a directory from substring
values to rows. Search: by the pigeonhole principle a code within ``radius`` bits agrees with the
query within ``radius // parts`` bits in some substring, so probing all substring values that
near retrieves every code within the radius, which is then checked on whole codes. Those rows are
reranked by the cosine of their original vectors in double precision. A block that finds fewer than ``k`` rows
widens its radius, so each query gets ``k`` rows if there are as many. Queries go to every
block, in blocks of their own. Blocks are as large as memory allows, because rows are copied for each block of
queries and queries for each block of rows: what is shuffled falls with the blocks' size.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
whose length is not the commonest (of equal ones, the smaller), nor a null id. Of rows with one id the
smallest vector counts. Ties go to the smaller id. A query never finds its own id. No rows give no
rows; columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import write_scratch

PART_BITS = 16
BLOCK_COMPONENTS = 1 << 24
ASKED_AT_ONCE = 4096
POP16 = np.array([bin(i).count("1") for i in range(1 << PART_BITS)], np.uint8)


@dataclass
class Rotation:
    """Orthogonal matrices; each gives as many bits as the vectors have components."""

    mean: np.ndarray
    turns: list[np.ndarray]

    @classmethod
    def learn(cls, sample: np.ndarray, bits: int, steps: int = 30, seed: int = 3) -> Rotation:
        """Iterative quantisation: alternately take signs, and the rotation that fits them best."""
        n, d = sample.shape
        rng = np.random.default_rng(seed)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        mean = np.zeros(d)
        turns = []
        for _ in range(math.ceil(bits / d)):
            turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
            for _ in range(steps if n >= d else 0):
                u, _, vt = np.linalg.svd((unit - mean).T @ np.sign((unit - mean) @ turn))
                turn = u @ vt
            turns.append(turn)
        return cls(mean, turns)

    def codes(self, vectors: np.ndarray, bits: int) -> np.ndarray:
        """Substrings of 16 bits, row by part."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True) - self.mean
        signs = np.concatenate([unit @ t > 0 for t in self.turns], axis=1)[:, :bits]
        return np.packbits(signs, axis=1, bitorder="little").view("<u2")


class Index:
    """A block's codes with a directory per substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = []
        for part in range(codes.shape[1]):
            order = np.argsort(codes[:, part], kind="stable")
            values, starts = np.unique(codes[order, part], return_index=True)
            self.parts.append((order, values, np.append(starts, len(order))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row within ``radius`` bits of a code.

        With radius = parts * a + r, some substring r or earlier agrees within a bits, or a later one
        within a - 1.
        """
        n_parts = len(self.parts)
        a, r = divmod(radius, n_parts)
        found = np.zeros(len(self.codes), bool)
        for part, (order, values, starts) in enumerate(self.parts):
            near = a if part <= r else a - 1
            hit = np.flatnonzero(POP16[values ^ code[part]] <= near) if near >= 0 else np.zeros(0, int)
            sizes = starts[hit + 1] - starts[hit]
            at = np.repeat(starts[hit] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            found[order[at]] = True
        rows = np.flatnonzero(found)
        return rows[POP16[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64) <= radius]


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """id, vector of the rows that take part, one per id, and the vectors' length."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kind = vectors.schema[vector_column].dataType.elementType
    kept_kind = "array<float>" if isinstance(kind, T.FloatType) else "array<double>"
    rows = vectors.select(
        vectors[id_column].cast("long").alias("id"), vectors[vector_column].cast(kept_kind).alias("vector")
    ).filter("id is not null and vector is not null and size(vector) > 0")
    rows = rows.filter(~bad & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "d").first()
    if common is None:
        return rows.limit(0), 0
    kept = rows.filter(F.size("vector") == common["d"]).groupBy("id").agg(F.min("vector").alias("vector"))
    return kept, common["d"]


def matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten() if isinstance(flat, pa.Array) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def search(
    vectors: DataFrame,
    is_query,
    *,
    k: int = 5,
    bits: int = 64,
    radius: int = 29,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    sample: int = 4096,
    block_rows: int | None = None,
    block_queries: int | None = None,
    least_blocks: int = 16,
) -> DataFrame:
    """query_id, rank, vec_id, score. ``is_query``: a condition on the column ``id``.

    The rotation is learned from the ``sample`` rows with the smallest hashes of their id.
    Each pair of a row block and a query block is one task; rows are copied for each query block,
    and queries for each row block. A block of rows has ``BLOCK_COMPONENTS`` components of vectors unless given (262,144
    rows of 64), one of queries half of that. Small tables have ``least_blocks`` row blocks.
    """
    if bits % PART_BITS:
        raise ValueError(f"bits must be a multiple of {PART_BITS}")
    rows, d = usable(vectors, id_column, vector_column)
    result = "query_id long, rank int, vec_id long, score double"
    if not d:
        return vectors.sparkSession.createDataFrame([], result)
    block_rows = block_rows or max(1, BLOCK_COMPONENTS // d)
    block_queries = block_queries or max(1, BLOCK_COMPONENTS // 2 // d)
    rows = write_scratch(rows, "ann-rows")
    total, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    least = rows.select("id", "vector", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(sample)
    rotation = Rotation.learn(np.array([r["vector"] for r in least.collect()]), bits)
    row_blocks = max(math.ceil(total / block_rows), min(least_blocks, math.ceil(total / 1000)))
    query_blocks = max(1, math.ceil(asked / block_queries))

    def spread(blocks: int, other: str):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(other)

    mine = F.pmod(F.xxhash64("id"), F.lit(row_blocks)).cast("int").alias("row_block")
    theirs = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int").alias("query_block")
    base = rows.select("id", "vector", mine, spread(query_blocks, "query_block"))
    queries = rows.filter(is_query).select("id", "vector", theirs, spread(row_blocks, "row_block"))
    keys = ["row_block", "query_block"]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def probe(base: pa.Table, asked: pa.Table) -> pa.Table:
        if not base.num_rows or not asked.num_rows:
            return schema.empty_table()
        ids, found = base["id"].to_numpy(), {"query_id": [], "vec_id": [], "score": []}
        own = matrix(base["vector"], d)
        norms = np.sqrt((own * own).sum(axis=1))
        index = Index(rotation.codes(own, bits))
        for begin in range(0, asked.num_rows, ASKED_AT_ONCE):
            some = asked.slice(begin, ASKED_AT_ONCE)
            wanted = matrix(some["vector"], d)
            wanted_norms = np.sqrt((wanted * wanted).sum(axis=1))
            for query, vector, norm, code in zip(
                some["id"].to_pylist(), wanted, wanted_norms, rotation.codes(wanted, bits), strict=True
            ):
                reach = radius
                while True:
                    near = index.within(code, reach)
                    near = near[ids[near] != query]
                    if len(near) >= k or reach >= bits:
                        break
                    reach = min(bits, reach + max(1, bits // 16))
                cosine = (own[near] * vector).sum(axis=1) / (norms[near] * norm)
                best = np.lexsort((ids[near], -cosine))[:k]
                found["query_id"] += [query] * len(best)
                found["vec_id"] += ids[near[best]].tolist()
                found["score"] += cosine[best].tolist()
        return pa.table(found, schema=schema)

    near = (
        base.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(probe, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
