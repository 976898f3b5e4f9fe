"""Compare queries with their SQL on the given tables.

    python -m tests.oracle_check [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(repr(r[i]) for i in order) for r in rows)


def differences(spark, con, folder, query, sql) -> str:
    """Empty when column names, values and Python types are equal as bags of rows."""
    df = query(spark, folder)
    names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    expected_names, expected = _rows([d[0] for d in cur.description], cur.fetchall())
    if names != expected_names:
        return f"columns {names} against {expected_names}"
    if got != expected:
        extra, missing = list((got - expected).items())[:2], list((expected - got).items())[:2]
        return f"{sum(got.values())} rows against {sum(expected.values())}; only here {extra}; only there {missing}"
    return ""


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from quotewright.session import build_session

    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            rows = con.execute(f"SELECT count(*) FROM ({sql[name]}) q").fetchone()[0] if name in sql else -1
            problem = differences(spark, con, folder, queries[name], sql[name]) if name in sql else "no SQL"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {name} {rows} rows {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} bad")
    spark.stop()
    return int(bad > 0)


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]))
