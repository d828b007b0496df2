"""Run queries and their SQL side by side: schema, row count, values.

usage: python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

from checks import fixtures as fx

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def bag(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL, as messages."""
    cur = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in cur.description}
    sql_rows = cur.fetchall()
    rows = df.collect()
    out = []
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    if set(spark_types) != set(sql_types):
        return [f"columns differ: {sorted(set(spark_types) ^ set(sql_types))}"]
    for name, kind in spark_types.items():
        if TYPES.get(kind, kind) != sql_types[name]:
            out.append(f"type of {name}: {kind} / {sql_types[name]}")
    left = bag(rows, df.columns)
    right = bag(sql_rows, list(sql_types))
    if len(left) != len(right):
        out.append(f"rows: {len(left)} / {len(right)}")
    if left != right:
        ls, rs = set(left), set(right)
        out.append(f"only spark: {[x for x in left if x not in rs][:2]}")
        out.append(f"only sql:   {[x for x in right if x not in ls][:2]}")
    if not rows:
        out.append("no rows")
    return out


def main(args: list[str]) -> int:
    from checks import ORACLE, QUERIES
    from raterscope.session import local_session

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problems = compare(df, con, ORACLE[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        mark = "BAD " if problems else ("ok  " if name in ORACLE else "rows")
        print(f"{mark} {name} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("     ", p[:1800], flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
