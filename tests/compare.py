"""Run registered queries beside their SQL: rows, names, types, and no plan that pairs all rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "BIGINT": "bigint", "HUGEINT": "hugeint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "FLOAT": "float",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=repr)


def compare(spark, con, name, query, sql, sf_dir) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    df = query(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for pairing in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if pairing in plan:
            return [f"{pairing} in the plan"]
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return [] if rows else ["no rows"]
    relation = con.execute(sql)
    described = relation.description
    expected = relation.fetchall()
    names = [d[0] for d in described]
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    types = dict(df.dtypes)
    for d in described:
        kind = KINDS.get(str(d[1]), str(d[1]))
        if types[d[0]] != kind:
            problems.append(f"type of {d[0]}: {types[d[0]]} != {kind}")
    _, got = table(df.columns, rows)
    cols, want = table(names, expected)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b][:3]
        problems.append(f"{cols}: " + "; ".join(f"{a} != {b}" for a, b in bad))
    return problems


def main() -> int:
    sys.path.insert(0, ".")
    from starsift.catalog import ORACLE, QUERIES
    from starsift.session import build_session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, query in QUERIES.items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            problems = compare(spark, con, name, query, ORACLE.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        mark = "ok " if not problems else "BAD"
        print(f"{mark} {name} {time.time() - start:.1f}s {'' if ORACLE.get(name) else '(no sql)'}", flush=True)
        for p in problems:
            print("     ", p[:1200], flush=True)
        failed += bool(problems)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
