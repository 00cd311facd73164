"""Compare registered queries with their SQL in DuckDB: names, types, row counts and values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, bool):
        return str(v)
    return repr(v)


KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, con, sql: str, exact_types: bool = True) -> str | None:
    """None when equal, else the first difference."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    theirs = res.fetchall()
    cols = sorted(df.columns)
    if cols != sorted(names):
        return f"columns {cols} vs {sorted(names)}"
    rows = [tuple(r) for r in df.select(*cols).collect()]
    idx = [names.index(c) for c in cols]
    a = sorted(tuple(_norm(v) for v in r) for r in rows)
    b = sorted(tuple(_norm(r[i]) for i in idx) for r in theirs)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} of {len(a)} rows differ in {cols}: {bad[:3]}"
    if exact_types:
        for c, t in df.dtypes:
            if KIND.get(t, t) != types[c]:
                return f"type of {c}: {t} vs {types[c]}"
    return None


def main(argv):
    sys.path.insert(0, ".")
    from tallyloom.session import local_session
    from tallyloom.workloads import ORACLES, QUERIES

    sf = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf = a
        else:
            names.append(a)
    spark = local_session(8)
    con = connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if names and not any(n == name or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t = time.time()
        try:
            if name in ORACLES:
                problem = compare(fn(spark, sf), con, ORACLES[name])
            else:
                n = len(fn(spark, sf).collect())
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {'' if name in ORACLES else '(rows only) '}{problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
