"""Source systems. A source is anything with ``read(spark, table, after=None, keys=())``.

``after`` is ``(column, mark)`` for an incremental read, ``keys`` are the table's key columns. They only let a
source plan its scan; the row filter itself is applied by :mod:`tidemark.sources.extract`.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from types import MappingProxyType
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.scalars import resolve

After = tuple[str, str] | None

# Equal ranges that are counted for each range that is read.
BINS = 32


@dataclass(frozen=True)
class FrameSource:
    """Tables that are DataFrames already."""

    frames: Mapping[str, DataFrame]

    def read(self, spark: SparkSession, table: str, after: After = None, keys: Sequence[str] = ()) -> DataFrame:
        return self.frames[table]


@dataclass(frozen=True)
class ParquetSource:
    """Tables stored as Parquet under one root."""

    root: str
    suffix: str = ".parquet"

    def read(self, spark: SparkSession, table: str, after: After = None, keys: Sequence[str] = ()) -> DataFrame:
        return spark.read.parquet(f"{self.root.rstrip('/')}/{table}{self.suffix}")


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database, read over several connections at once.

    ``splits`` maps a table to ``(column, pieces)``. Without an entry an incremental read is split on its mark's
    column and a full one on the first of the table's keys, into ``pieces``. Ranges are cut so that they hold about
    as many rows each, by what the source answers to one query; one value's rows stay together. A read that
    can't be split comes over one connection in one task, with a warning.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    splits: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    fetch_size: int = 10_000
    pieces: int = 16

    def read(self, spark: SparkSession, table: str, after: After = None, keys: Sequence[str] = ()) -> DataFrame:
        options = {"fetchsize": str(self.fetch_size), **self.properties}
        relation = quoted(table)
        split = self.splits.get(table) or (after and (after[0], self.pieces))
        if not split and keys:
            # Keys may be in any case, but quoted names are not.
            key = resolve(keys[0], spark.read.jdbc(self.url, relation, properties=options).columns)
            split = key and (key, self.pieces)

        def ask(query: str) -> list:
            return spark.read.jdbc(self.url, query, properties=options).collect()

        predicates = split and split_predicates(ask, table, *split, after)
        if not predicates:
            warnings.warn(f"{table} can't be split: it is read over one connection, in one task", stacklevel=2)
            return spark.read.jdbc(self.url, relation, properties=options)
        return spark.read.jdbc(self.url, relation, predicates=predicates, properties=options)


def split_predicates(
    ask: Callable[[str], list], table: str, column: str, pieces: int, after: After = None
) -> list[str] | None:
    """Conditions that together take every row once, each about as many; None if the column has no such ranges.

    ``ask`` gives the rows of a subquery. Numbers and times are cut by counts of equal ranges, or, where the source
    can't count them so, into equal ranges. Texts are cut in the source's own order, by the least text of each of
    ``pieces`` equal parts.
    """
    ((low, high),) = ask(bounds_query(table, column, after))
    with_null = after is None or after[0] != column
    if low is None or pieces < 2:
        return range_predicates(column, None, None, pieces, with_null)
    if isinstance(low, str):
        try:
            found = ask(cuts_query(table, column, pieces, after))
        except Exception as error:
            warnings.warn(f"{table} can't be cut by {column}: {error}", stacklevel=3)
            return None
        texts = [text for _, text in sorted(found, key=lambda row: row[0])]
        return conditions(column, [text_literal(t) for t in dict.fromkeys(texts) if t != texts[0]], with_null)
    if not isinstance(low, (int, float, Decimal, date)) or isinstance(low, bool):
        return None
    if not isinstance(low, date) and not (math.isfinite(low) and math.isfinite(high)):
        return None
    counts = {}
    if low < high:
        try:
            found = ask(counts_query(table, column, low, high, pieces * BINS, after))
            counts = {int(b): int(n) for b, n in found if b is not None}
        except Exception as error:
            warnings.warn(f"{table} is read in equal ranges of {column}: {error}", stacklevel=3)
    return range_predicates(column, low, high, pieces, with_null, counts)


def quoted(identifier: str) -> str:
    """An SQL identifier, with or without schema, in double quotes."""
    return ".".join(
        '"' + part.replace('"', '""') + '"' for part in identifier.split(".")
    )


def text_literal(value: Any) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def bounds_query(table: str, column: str, after: After = None) -> str:
    """One-row subquery for the range that is to be split, answered by the source."""
    c = quoted(column)
    where = ""
    if after is not None:
        where = f" WHERE {quoted(after[0])} > {text_literal(after[1])}"
    return f"(SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {quoted(table)}{where}) bounds"


def counts_query(
    table: str, column: str, low: Any, high: Any, bins: int, after: After = None
) -> str:
    """Subquery for the rows in each of ``bins`` equal ranges, grouped by the source."""
    c = quoted(column)
    if isinstance(low, (date, datetime)):
        width = (high - low).total_seconds() / bins
        at = f"EXTRACT(EPOCH FROM CAST({c} AS TIMESTAMP) - TIMESTAMP {text_literal(low)})"
    else:
        width = float(high - low) / bins
        at = f"({c} - {low})"
    where = f" WHERE {c} IS NOT NULL"
    if after is not None:
        where += f" AND {quoted(after[0])} > {text_literal(after[1])}"
    group = f"FLOOR({at} / {width!r})"
    return f"(SELECT {group} AS b, COUNT(*) AS n FROM {quoted(table)}{where} GROUP BY {group}) counts"


def cuts_query(table: str, column: str, pieces: int, after: After = None) -> str:
    """Subquery for the least value of each of ``pieces`` parts with as many rows each."""
    c = quoted(column)
    where = f" WHERE {c} IS NOT NULL"
    if after is not None:
        where += f" AND {quoted(after[0])} > {text_literal(after[1])}"
    parts = f"(SELECT {c} AS c, NTILE({pieces}) OVER (ORDER BY {c}) AS part FROM {quoted(table)}{where}) parts"
    return f"(SELECT part, MIN(c) AS cut FROM {parts} GROUP BY part) cuts"


def range_predicates(
    column: str,
    low: Any,
    high: Any,
    pieces: int,
    with_null: bool = True,
    counts: Mapping[int, int] = MappingProxyType({}),
) -> list[str]:
    """Half-open ranges over a number or time column that together cover every row once.

    The first and last range are open-ended, so rows that arrive or change outside the
    measured bounds are still read, and NULL gets a range of its own. ``counts`` are rows
    by bin, of ``pieces * BINS``; without them the ranges are equally wide.
    """
    return conditions(column, _cuts(low, high, pieces, counts), with_null)


def conditions(column: str, cuts: Sequence[str], with_null: bool) -> list[str]:
    """Half-open ranges between literals in ascending order, open at both ends, and one for NULL."""
    c = quoted(column)
    null_range = [f"{c} IS NULL"] if with_null else []
    if not cuts:
        return [f"{c} IS NOT NULL", *null_range]
    inner = [f"{c} >= {a} AND {c} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{c} < {cuts[0]}", *inner, f"{c} >= {cuts[-1]}", *null_range]


def _cuts(low: Any, high: Any, pieces: int, counts: Mapping[int, int]) -> Sequence[str]:
    if low is None or high is None or pieces < 2:
        return []
    parts = pieces * BINS if counts else pieces
    edges = balanced_edges(counts, pieces) if counts else range(1, pieces)
    span = high - low
    if isinstance(low, int):
        points = [low + span * i // parts for i in edges]
    else:
        points = [low + span * i / parts for i in edges]
    distinct = sorted({p for p in points if p > low})
    if isinstance(low, (date, datetime)):
        return [text_literal(p) for p in distinct]
    return [str(p) for p in distinct]


def balanced_edges(counts: Mapping[int, int], pieces: int) -> list[int]:
    """Bins at which a new range begins, so that ranges hold about as many rows each."""
    share, seen, edges = sum(counts.values()) / pieces, 0, []
    for b in sorted(counts):
        # A bin that would overfill the range begins a new one, if that is nearer.
        over = seen + counts[b] - share * (len(edges) + 1)
        if seen and over > 0 and over > share * (len(edges) + 1) - seen:
            edges.append(b)
        seen += counts[b]
        if seen >= share * (len(edges) + 1):
            edges.append(b + 1)
    return sorted(set(edges))[: pieces - 1]
