"""Run queries and their SQL side by side: ``python -m tests.compare [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df, relation) -> list[str]:
    """Empty when names, kinds of types and values agree."""
    found = []
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} / {sorted(relation.columns)}"]
    types = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} / {types[name]}")
    ours = rows_of(df.columns, df.collect())
    theirs = rows_of(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    for a, b in zip(ours, theirs):
        if a != b:
            found.append(f"{a} / {b}")
            break
    return found


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, sql = make_session(), duck(sf_dir), oracle_sql()
    failed = 0
    for name, query in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            found = differences(query(spark, sf_dir), con.sql(sql[name])) if name in sql else ["no SQL"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{name}: {'same' if not found else found} {time.time() - start:.1f}s", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
