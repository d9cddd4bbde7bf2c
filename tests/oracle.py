"""Run registered queries next to their SQL twins and compare the rows.

Usage: python tests/oracle.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(value):
    """A value in a form that compares equal across the two engines."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}={canonical(v)}" for k, v in sorted(value.items(), key=str)) + "}"
    if hasattr(value, "asDict"):
        return canonical(value.asDict())
    if hasattr(value, "tzinfo"):
        return str(value.replace(tzinfo=None))
    try:
        number = float(value)
    except (TypeError, ValueError):
        return str(value)
    if isinstance(value, str):
        return value
    return "nan" if math.isnan(number) else repr(number + 0.0)


def compare(df, con, name: str) -> str | None:
    """None if a query's rows and its SQL agree, else what differs."""
    columns = sorted(df.columns)
    ours = sorted(tuple(canonical(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None if ours else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(canonical(row[i]) for i in order) for row in result.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}; first: {ours[:2]} vs {theirs[:2]}"
    for a, b in zip(ours, theirs):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
            return f"row differs in {diff}"
    return None if ours else "both empty"


def main() -> int:
    from fleetstats.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), []
    for name in wanted or queries():
        began = time.time()
        try:
            problem = compare(queries()[name](spark, sf_dir), con, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        if problem:
            failed.append(name)
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
