"""Run queries next to their oracles and compare names, counts and values.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from tidemark.session import local_session

# The tables of the test data.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
        )
    return connection


def compare(spark, connection, sf_dir: str, query: str) -> str | None:
    """What differs, or None."""
    result = QUERIES[query](spark, sf_dir)
    expected = connection.execute(ORACLES[query])
    columns = [d[0] for d in expected.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} instead of {sorted(columns)}"
    want = Counter(expected.fetchall())
    got = Counter(tuple(r) for r in result.select(*columns).collect())
    if want == got:
        return None
    extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
    return (
        f"{sum(got.values())} rows instead of {sum(want.values())}; "
        f"extra {extra}, missing {missing}"
    )


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session(8)
    connection = oracle_connection(sf_dir)
    failed = 0
    for query in args[1:] or list(QUERIES):
        start = time.perf_counter()
        problem = compare(spark, connection, sf_dir, query)
        failed += problem is not None
        print(f"{query:34s} {time.perf_counter() - start:6.2f}s  {problem or 'ok'}")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
