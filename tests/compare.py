"""Run registered queries and their check SQL side by side: python tests/compare.py SF_DIR [name ...]."""

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        if out[c].dtype == object:
            out[c] = out[c].map(lambda v: repr(v.tolist()) if isinstance(v, np.ndarray) else v if v is None or isinstance(v, (str, bool)) else repr(v))
            out[c] = out[c].where(out[c].notna(), None)
    return out.sort_values(list(out.columns), kind="stable", na_position="last").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        if a[c].dtype.kind in "fiu" and b[c].dtype.kind in "fiu":
            x, y = a[c].to_numpy(float), b[c].to_numpy(float)
            bad = ~((x == y) | (np.isnan(x) & np.isnan(y)))
            if a[c].dtype.kind != b[c].dtype.kind and not (np.isnan(x).any() or np.isnan(y).any()):
                return f"{c}: type {a[c].dtype} != {b[c].dtype}"
        else:
            bad = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna())).to_numpy(bool)
        if bad.any():
            k = int(np.argmax(bad))
            return f"{c}: {int(bad.sum())} of {len(a)} differ, first {a.iloc[k].to_dict()} != {b.iloc[k].to_dict()}"
    return None


if __name__ == "__main__":
    from landgrain import plans
    from landgrain.session import local_session

    sf = sys.argv[1]
    names = [n for n in plans.QUERIES if not sys.argv[2:] or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in sys.argv[2:])]
    spark, con = local_session("compare", cpus=8), connect(sf)
    failed = []
    for n in names:
        t0 = time.time()
        try:
            got = plans.QUERIES[n](spark, sf).toPandas()
            t1 = time.time()
            msg = differences(got, con.execute(plans.CHECKS[n]).df()) if n in plans.CHECKS else "no sql"
            t2 = time.time()
        except Exception as e:  # report and go on
            msg, got, t1, t2 = f"ERROR {type(e).__name__} {str(e)[:600]}", [], time.time(), time.time()
        ok = msg in (None, "no sql")
        if not ok:
            failed.append(n)
        print(f"{'ok  ' if ok else 'FAIL'} {n} rows={len(got)} spark={t1 - t0:.1f}s sql={t2 - t1:.1f}s {msg or ''}", flush=True)
    print("failed:", failed)
