"""Spark-vs-DuckDB comparison used by the tests (and runnable as a script):
same column names, same row count, same multiset of rows (doubles compared
after rounding to 9 significant digits)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if v == 0:
            return ("f", 0.0)
        return ("f", float(f"{v:.9g}"))
    if hasattr(v, "item"):
        v = v.item()
        return _norm(v)
    if isinstance(v, bool):
        return ("i", int(v))
    if isinstance(v, int):
        return ("i", v)
    return ("s", str(v))


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


_SPARK_KIND = {"ByteType": "int8", "ShortType": "int16", "IntegerType": "int32", "LongType": "int64",
               "FloatType": "float", "DoubleType": "float", "StringType": "str", "BooleanType": "bool",
               "DateType": "date", "TimestampType": "ts", "TimestampNTZType": "ts"}
_DUCK_KIND = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64", "HUGEINT": "int128",
              "FLOAT": "float", "DOUBLE": "float", "VARCHAR": "str", "BOOLEAN": "bool", "DATE": "date",
              "TIMESTAMP": "ts"}


def _kinds(sdf, res):
    sk = {f.name: _SPARK_KIND.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in sdf.schema.fields}
    dk = {}
    for d in res.description:
        t = str(d[1]).upper()
        dk[d[0]] = _DUCK_KIND.get(t, "decimal" if t.startswith("DECIMAL") else t)
    return sk, dk


def compare(spark, name, fn, sql, sf_dir, warnings=None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    sk, dk = _kinds(sdf, res)
    drows = res.fetchall()
    problems = []
    for c in set(sk) & set(dk):
        a, b = sk[c], dk[c]
        if a != b:
            if a.startswith("int") and b.startswith("int"):
                if warnings is not None:
                    warnings.append(f"{name}.{c}: spark {a} vs duck {b}")
            else:
                problems.append(f"type of {c}: spark {a} vs duck {b}")
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: spark={scols} duck={dcols}")
    if len(srows) != len(drows):
        problems.append(f"row count spark={len(srows)} duck={len(drows)}")
    if not problems:
        a = rows_of(srows, scols)
        b = rows_of(drows, dcols)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, first: {diff}")
    return problems, t1 - t0, len(srows)


if __name__ == "__main__":
    from hearth.plans.registry import ORACLE, QUERIES, load_all
    from hearth.session import local_session

    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    load_all()
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session("8")
    bad = 0
    warns: list = []
    for n in names:
        if n not in ORACLE:
            df = QUERIES[n](spark, sf)
            print(f"[rows-only] {n}: {df.count()} rows")
            continue
        try:
            probs, secs, nrows = compare(spark, n, QUERIES[n], ORACLE[n], sf, warns)
        except Exception as e:  # report and continue
            probs, secs, nrows = [f"error: {type(e).__name__}: {str(e)[:400]}"], 0, 0
        bad += bool(probs)
        print(f"{'OK  ' if not probs else 'FAIL'} {n} ({nrows} rows, {secs:.1f}s) {'; '.join(probs)}")
    print(f"{len(names) - bad}/{len(names)} ok")
    for w in warns:
        print("WARN int width:", w)
