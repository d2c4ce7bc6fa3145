"""Runs named queries next to their expected SQL. ``python tests/compare.py sf0.01 [name ...]``"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "benchmark", "conversations",
)
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def differences(df, con, sql: str) -> str | None:
    """What differs between a Spark result and a SQL result, or None."""
    rel = con.sql(sql)
    spark_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    sql_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    if spark_types != sql_types:
        odd = {n: (spark_types.get(n), sql_types.get(n)) for n in spark_types.keys() | sql_types.keys()}
        return "schema " + str({n: t for n, t in odd.items() if t[0] != t[1]})
    names = sorted(spark_types)
    mine = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    order = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.sql(f"SELECT {order} FROM ({sql})").fetchall(), key=_key)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} against {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ in {names}, first {bad[0]}" if bad else None


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    folder = f"/root/testdata/{sf}"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = differences(df, con, oracles[name])
            else:
                problem = None if df.collect() else "no rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
