"""Run registered queries beside their SQL and compare whole results.

    python tests/oracle_check.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(series: pd.Series) -> str:
    values = series.dropna()
    if values.empty:
        return "empty"
    first = values.iloc[0]
    if isinstance(first, bool) or str(series.dtype) in ("bool", "boolean"):
        return "bool"
    if isinstance(first, str):
        return "str"
    return type(first).__name__


def canonical(df: pd.DataFrame) -> list[str]:
    def text(v):
        if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
            return "~"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, float):
            return str(int(v)) if v == int(v) and abs(v) < 1e17 else repr(round(v, 6))
        return str(v)

    cols = sorted(df.columns)
    return sorted("|".join(text(v) for v in row) for row in df[cols].astype(object).to_numpy())


def compare(spark, con, name, fn, sql, sf_dir):
    start = time.time()
    frame = fn(spark, sf_dir)
    got = frame.toPandas()
    took = time.time() - start
    if sql is None:
        return len(got) > 0, f"{name}: {len(got)} rows, no SQL, {took:.1f}s"
    start = time.time()
    rel = con.execute(sql)
    types = {d[0]: str(d[1]) for d in rel.description}
    want = pd.DataFrame(
        rel.fetchall(), columns=list(types), dtype=object)
    sql_took = time.time() - start
    if sorted(got.columns) != sorted(want.columns):
        return False, f"{name}: columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN"}
    wrong = [f"{c}:{t}/{types[c]}" for c, t in frame.dtypes if kinds.get(t) != types[c]]
    a, b = canonical(got), canonical(want)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:3]
        only_b = [x for x in b if x not in set(a)][:3]
        return False, (f"{name}: {len(a)} vs {len(b)} rows, cols {sorted(got.columns)}\n"
                       f"   spark {only_a}\n   sql   {only_b}")
    if wrong:
        return False, f"{name}: values equal, types differ {wrong}"
    return True, f"{name}: {len(a)} rows, {took:.1f}s (sql {sql_took:.1f}s)"


def main(argv):
    import __spark_entry__ as entry
    from meshfold.session import local_session

    sf = "0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        argv = argv[:at] + argv[at + 2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        try:
            ok, message = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as exc:  # report and go on
            ok, message = False, f"{name}: {type(exc).__name__} {str(exc)[:600]}"
        bad += not ok
        print("ok  " if ok else "BAD ", message, flush=True)
    print(f"{len(queries)} registered, {len(oracles)} with SQL, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
