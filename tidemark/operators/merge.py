"""Keyed upsert with the rules of SQL ``MERGE``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import (
    all_set,
    name,
    names,
    resolve,
    resolve_keys,
    split_by_null_key,
)

# How often a key occurs in the source, and whether the target has it.
N, HIT = "_n", "_hit"

# Types that come back unchanged from their text form.
EXACT_AS_TEXT = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.StringType,
    T.DateType,
    T.TimestampNTZType,
)


class MergeConflict(ValueError):
    """Several source rows match the same target row."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the target's column order and types; the set of columns must agree."""
    have = {c.lower() for c in df.columns}
    want = {c.lower() for c in schema.names}
    if have != want:
        raise ValueError(
            f"columns differ: missing {sorted(want - have)}, unknown {sorted(have - want)}"
        )
    return df.to(schema)


def key_counts(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete keys, each once, with how often they occur as ``_n``. NULL equals nothing."""
    return source.filter(all_set(keys)).groupBy(*names(keys)).agg(F.count(F.lit(1)).alias(N))


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``. NULL equals nothing."""
    return key_counts(source, keys).filter(name(N) > 1).withColumnRenamed(N, "n")


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is in the source, one result row per target row."""
    return target.filter(all_set(keys)).join(
        _distinct_keys(source, keys), list(keys), "left_semi"
    )


def key_range(source: DataFrame, keys: Sequence[str]) -> Column:
    """A filter that every row passes whose key is in the source.

    It holds the lowest and highest source key as literals, so a scan skips the row
    groups outside them; new batches mostly carry recent keys. Runs one small query.
    """
    ends = range_ends(source.schema, keys)
    found = source.filter(all_set(keys)).agg(*ends).first() if ends else ()
    return range_filter(source.schema, keys, found)


def _bounded(schema: T.StructType, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if isinstance(schema[k].dataType, EXACT_AS_TEXT)]


def range_ends(schema: T.StructType, keys: Sequence[str]) -> list[Column]:
    """Aggregates for the lowest and highest value of each key column that has a range."""
    return [end(name(k)).cast("string") for k in _bounded(schema, keys) for end in (F.min, F.max)]


def range_filter(schema: T.StructType, keys: Sequence[str], ends: Sequence[str | None]) -> Column:
    """The filter that values of :func:`range_ends` stand for."""
    if None in ends:
        return F.lit(False)
    inside = F.lit(True)
    for i, key in enumerate(_bounded(schema, keys)):
        low, high = (F.lit(text).cast(schema[key].dataType) for text in ends[2 * i : 2 * i + 2])
        inside = inside & name(key).between(low, high)
    return inside


def counted_hits(target: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is among ``counts``, with the source's count ``_n`` of it."""
    return target.filter(all_set(keys)).join(counts, list(keys))


def check_hits(hits: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a hit's key comes more than once in the source."""
    found = hits.filter(name(N) > 1).select(*names(keys), F.col(N).alias("n")).head()
    if found is not None:
        raise MergeConflict(f"several source rows match one target row: {found}")


def check_single_match(source: DataFrame, hits: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key that exists in the target comes more than once in the source.

    Repeated keys that match nothing are plain inserts and pass.
    """
    check_hits(counted_hits(hits.select(*names(keys)), key_counts(source, keys), keys), keys)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hits: DataFrame | None = None,
) -> DataFrame:
    """Matched target rows take all values of their source row; the rest is inserted.

    A key that occurs several times in the target is updated each time. Several source rows
    for one matched key fail the query. ``hits`` are the target's keys found in the source, see
    :func:`counted_hits`, if the caller has them already. A key column may be given twice and in
    any case.

    The right side of every join has one row per key, so a hot key is only ever on the
    left, where Spark can split it. Which keys match is found by an aggregation, so that the
    target's keys are sorted by no task.
    """
    keys = resolve_keys(keys, target.columns)
    source = source.select(*[name(resolve(c, source.columns)).alias(c) for c in target.columns])
    old, old_unkeyed = split_by_null_key(target, keys)
    new, new_unkeyed = split_by_null_key(source, keys)
    located = new.join(_key_matches(target if hits is None else hits, new, keys), list(keys))
    values = [name(c) for c in target.columns if c not in keys]
    change = located.filter(name(HIT)).select(
        *names(keys), F.struct(F.lit(True).alias("_"), *values).alias("_new")
    )
    updated = old.join(change, list(keys), "left").select(
        *[
            name(c)
            if c in keys
            else F.when(F.col("_new").isNull(), name(c))
            .otherwise(F.col("_new").getField(c))
            .alias(c)
            for c in target.columns
        ]
    )
    inserted = located.filter(~name(HIT)).select(*names(target.columns))
    return (
        updated.unionByName(inserted).unionByName(old_unkeyed).unionByName(new_unkeyed)
    )


def replace_rows(target: DataFrame, hits: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`upsert` for a target with each of the keys ``hits`` once: those rows go, all source rows come.

    So the source is neither joined nor shuffled. Both have the same columns and types. For many hits: they are
    not broadcast, as Spark might by the small size of a file that has them sorted.
    """
    old, unkeyed = split_by_null_key(target, keys)
    kept = old.join(hits.select(*names(keys)).hint("merge"), list(keys), "left_anti")
    return kept.unionByName(unkeyed).unionByName(source)


def once_each(hits: DataFrame, keys: Sequence[str]) -> bool:
    """Whether no key comes twice, and keys that are equal are also the same, bit by bit."""
    same = all(
        isinstance(hits.schema[k].dataType, EXACT_AS_TEXT)
        and not (isinstance(hits.schema[k].dataType, T.StringType) and hits.schema[k].dataType != T.StringType())
        for k in keys
    )
    return same and (key_counts(hits, keys).agg(F.max(name(N))).first()[0] or 0) < 2


def _key_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source's complete keys, each once, and whether the target has them as ``_hit``.

    A key that the target has and that comes more than once in the source fails the query.
    Repeats are added up by each task before the shuffle.
    """
    there = target.filter(all_set(keys)).select(*names(keys), F.lit(0).alias(N), F.lit(True).alias(HIT))
    given = source.filter(all_set(keys)).select(*names(keys), F.lit(1).alias(N), F.lit(False).alias(HIT))
    found = there.unionByName(given).groupBy(*names(keys)).agg(F.sum(N).alias(N), F.max(HIT).alias(HIT))
    clash = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    wanted = F.when(name(N) == 0, F.lit(False)).when(~name(HIT) | (name(N) == 1), F.lit(True)).otherwise(clash)
    return found.filter(wanted).select(*names(keys), HIT)


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete keys, each once. Repeats are dropped by each task before the shuffle."""
    return df.filter(all_set(keys)).select(*names(keys)).distinct()
