"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]

Comparison: same column names (sorted), same row count, and the same
multiset of rows after sorting columns by name (floats compared after
rounding to 9 significant digits, so last-bit noise is not reported).
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from kiln.plans.registry import load_all  # noqa: E402
from kiln.session import build_session  # noqa: E402
from kiln.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    reg = load_all()
    ok = bad = 0
    for name, q in sorted(reg.items()):
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            s_cols = df.columns
            s_types = [f.dataType.simpleString() for f in df.schema.fields]
            s_rows = [tuple(r) for r in df.collect()]
        except Exception:
            print(f"[SPARK-ERR] {name}\n{traceback.format_exc()[-1500:]}")
            bad += 1
            continue
        dt = time.time() - t0
        if not q.sql:
            print(f"[rows-only] {name}: {len(s_rows)} rows {dt:.1f}s")
            ok += 1
            continue
        try:
            res = con.execute(q.sql)
            d_cols = [d[0] for d in res.description]
            d_types = [str(d[1]) for d in res.description]
            d_rows = res.fetchall()
        except Exception as e:
            print(f"[DUCK-ERR] {name}: {e}")
            bad += 1
            continue
        problems = []
        if sorted(s_cols) != sorted(d_cols):
            problems.append(f"cols spark={s_cols} duck={d_cols}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if not problems:
            a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                problems.append(f"values differ e.g. {diff}")
        types = dict(zip(s_cols, s_types)), dict(zip(d_cols, d_types))
        if problems:
            bad += 1
            print(f"[MISMATCH] {name} ({dt:.1f}s): " + " | ".join(problems)[:2000])
            print(f"           types spark={types[0]} duck={types[1]}")
        else:
            ok += 1
            print(f"[ok] {name}: {len(s_rows)} rows {dt:.1f}s  types spark={list(types[0].values())} duck={list(types[1].values())}")
    print(f"ok={ok} bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()
