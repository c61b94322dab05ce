"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Prints one line per query: status, rows, seconds.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from valuator.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        import numpy as np
        if isinstance(v, np.ndarray):
            return tuple(_norm(x) for x in v.tolist())
    except Exception:
        pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def frame_rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(x) for x in rec))
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"COLS spark={sorted(spark_pdf.columns)} duck={sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"ROWS spark={len(spark_pdf)} duck={len(duck_pdf)}"
    a, b = frame_rows(spark_pdf), frame_rows(duck_pdf)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return f"VALUES first diff row {i}: spark={x} duck={y}"
    return "OK"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[1:] if not a.startswith("/")]
    from valuator.session import local_session
    import __spark_entry__ as entry
    spark = local_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    n_ok = n_bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sp = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            n_bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows-only rows={len(sp)} {dt:.2f}s")
            continue
        try:
            dk = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SQL-ERROR {str(e)[:300]}")
            n_bad += 1
            continue
        status = compare(sp, dk)
        if status == "OK":
            n_ok += 1
        else:
            n_bad += 1
        print(f"{name:32s} {status[:400]} rows={len(sp)} {dt:.2f}s")
    print(f"ok={n_ok} bad={n_bad}")


if __name__ == "__main__":
    main()
