"""Run registered queries and their SQL twins side by side.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set threads = 4")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if value is None:
        return ""
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def canonical(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_result(df):
    return canonical(df.columns, df.collect())


def sql_result(con, sql: str):
    cursor = con.execute(sql)
    return canonical([c[0] for c in cursor.description], cursor.fetchall())


def difference(ours, theirs) -> str | None:
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, sqls, bad = session(), connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            ours = spark_result(query(spark, sf_dir))
            took = time.time() - start
            problem = difference(ours, sql_result(con, sqls[name])) if name in sqls else "(no SQL)"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            took, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem) and problem != "(no SQL)"
        print(f"{name:24} {len(ours[1]):8} rows {took:6.1f}s  {problem or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
