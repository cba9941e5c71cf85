"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names, Arrow-level type families, and the
order-insensitive multiset of rows (floats rounded to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(table) -> Counter:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return Counter(tuple(_norm(col[i]) for col in data) for i in range(table.num_rows))


def family(t) -> str:
    import pyarrow as pa
    if pa.types.is_integer(t):
        return f"int{t.bit_width}"
    if pa.types.is_floating(t) or pa.types.is_decimal(t):
        return "float"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    return str(t)


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import pyarrow as pa
    import __spark_entry__ as entry
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            st = pa.Table.from_pandas(sdf.toPandas(), preserve_index=False)
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in oracle:
            results[name] = f"rows-only ({st.num_rows} rows)"
            if verbose:
                print(f"{name:28s} {results[name]} spark {ts:.1f}s", flush=True)
            continue
        try:

            ot = con.sql(oracle[name]).to_arrow_table()
        except Exception as e:  # noqa: BLE001
            results[name] = f"ORACLE ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        issues = []
        if sorted(st.column_names) != sorted(ot.column_names):
            issues.append(f"columns spark={sorted(st.column_names)} oracle={sorted(ot.column_names)}")
        else:
            sf = {c: family(st.schema.field(c).type) for c in st.column_names}
            of = {c: family(ot.schema.field(c).type) for c in ot.column_names}
            bad = {c: (sf[c], of[c]) for c in sf if sf[c] != of[c] and st.num_rows and ot.num_rows}
            if bad:
                issues.append(f"types {bad}")
        if st.num_rows != ot.num_rows:
            issues.append(f"rows spark={st.num_rows} oracle={ot.num_rows}")
        elif not issues:
            a, b = rows_of(st), rows_of(ot)
            if a != b:
                diff_a = list((a - b).items())[:3]
                diff_b = list((b - a).items())[:3]
                issues.append(f"values differ: spark-only {diff_a} oracle-only {diff_b}")
        results[name] = "OK" if not issues else "; ".join(issues)
        if verbose:
            print(f"{name:28s} {results[name][:600]}  ({st.num_rows} rows, spark {ts:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from callfunnel.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if not (v == "OK" or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("  FAIL", k, v[:300])
