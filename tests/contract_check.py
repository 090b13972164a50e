"""Run contract queries against their DuckDB oracle, as the driver does.

    python tests/contract_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roomlake.sources.testdata import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return v


def compare(spark_pdf, duck_pdf):
    a_cols, b_cols = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if a_cols != b_cols:
        return f"columns differ: {a_cols} vs {b_cols}"
    if len(spark_pdf) != len(duck_pdf):
        return f"rows differ: spark {len(spark_pdf)} vs duck {len(duck_pdf)}"
    ra = sorted((tuple(_norm(v) for v in row) for row in spark_pdf[a_cols].itertuples(index=False)),
                key=repr)
    rb = sorted((tuple(_norm(v) for v in row) for row in duck_pdf[a_cols].itertuples(index=False)),
                key=repr)
    for x, y in zip(ra, rb):
        if x != y:
            return f"first differing row:\n spark {x}\n duck  {y}"
    return None


def run(sf_dir: str, names: list[str] | None = None) -> dict:
    import __spark_entry__ as E
    from roomlake.session import local_session

    spark = local_session(cores=8, shuffle_partitions=8, app="contract-check")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(sqls):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
            t1 = time.time()
            dk = con.execute(sqls[name]).df()
            err = compare(sp, dk)
        except Exception as e:  # report and go on
            err, t1 = f"{type(e).__name__}: {str(e)[:800]}", time.time()
        results[name] = err
        print(f"{'OK  ' if err is None else 'FAIL'} {name:32s} {t1 - t0:6.2f}s"
              + ("" if err is None else f"\n     {err}"), flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v]
    print(f"{len(res) - len(bad)}/{len(res)} match")
    sys.exit(1 if bad else 0)
