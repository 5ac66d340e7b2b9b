"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Mirrors the driver's check: columns sorted by name, row count, column names,
and an order-insensitive hash of the values. Floats are compared after rounding
to 9 significant digits (both engines compute in IEEE double).

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "\0NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\x1e".join(keys).encode()).hexdigest()
    return [cols[i] for i in order], len(rows), h


SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE",
}


def types_of_spark(df) -> dict[str, str]:
    return {n: SPARK_TO_DUCK.get(t, t.upper()) for n, t in df.dtypes}


def types_of_duck(rel) -> dict[str, str]:
    return {n: str(t) for n, t in zip(rel.columns, rel.types)}


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        rec: dict = {"oracle": name in sqls}
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            s_cols, s_n, s_h = digest(df.columns, rows)
            rec.update(spark_rows=s_n, spark_sec=round(time.time() - t0, 2))
            if name in sqls:
                rel = con.sql(sqls[name])
                d_cols, d_n, d_h = digest(rel.columns, rel.fetchall())
                st, dt = types_of_spark(df), types_of_duck(rel)
                rec.update(duck_rows=d_n, cols_match=s_cols == d_cols, rows_match=s_n == d_n, hash_match=s_h == d_h,
                           types_match=st == dt)
                if st != dt:
                    rec["types"] = {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
                if s_cols != d_cols:
                    rec["cols"] = (s_cols, d_cols)
                rec["ok"] = s_cols == d_cols and s_n == d_n and s_h == d_h and st == dt
            else:
                rec["ok"] = True
        except Exception as e:  # noqa: BLE001 - report and go on
            rec.update(ok=False, error=f"{type(e).__name__}: {str(e)[:600]}")
        out[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return out


if __name__ == "__main__":
    from brandpulse.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v["ok"]]
    print("FAILED:", bad if bad else "none", f"({len(res) - len(bad)}/{len(res)} ok)")
