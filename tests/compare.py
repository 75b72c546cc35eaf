"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare every value.

``python tests/compare.py /root/testdata/sf0.01 [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import pathlib
import sys
import time
from collections import Counter

import duckdb

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()  # fmt: skip


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _kind(v) -> str:
    return type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[str, str]:
    started = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return ("rows only", f"{len(got)} rows, spark {took:.2f}s")
    started = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    duck_took = time.time() - started
    if sorted(names) != sorted(df.columns):
        return ("COLUMNS", f"spark {sorted(df.columns)} duckdb {sorted(names)}")
    a, b = rows_of(df.columns, got), rows_of(names, want)
    detail = f"{len(got)} rows, spark {took:.2f}s, duckdb {duck_took:.2f}s"
    if a != b:
        left, right = list((a - b).items())[:3], list((b - a).items())[:3]
        return ("DIFFERS", f"{detail}; {sorted(names)}\n   spark only {left}\n   duckdb only {right}")
    if got:
        kinds = {c: {_kind(r[i]) for r in got} - {"NoneType"} for i, c in enumerate(df.columns)}
        others = {c: {_kind(r[i]) for r in want} - {"NoneType"} for i, c in enumerate(names)}
        if kinds != others:
            bad = {c: (kinds[c], others[c]) for c in kinds if kinds[c] != others[c]}
            return ("TYPES", f"{detail}; {bad}")
    return ("ok", detail if got else detail + " EMPTY")


def main() -> None:
    from skyledger.checks import ORACLES, QUERIES
    from skyledger.session import local_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, query in QUERIES.items():
        if chosen and not any(name == c or (c.endswith("*") and name.startswith(c[:-1])) for c in chosen):
            continue
        try:
            verdict, detail = compare(spark, con, sf_dir, name, query, ORACLES.get(name))
        except Exception as failure:
            verdict, detail = "FAILED", str(failure)[:700]
        bad += verdict not in ("ok", "rows only")
        print(f"{verdict:10} {name}: {detail}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
