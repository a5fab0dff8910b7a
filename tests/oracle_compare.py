"""Run every registered query in Spark and its SQL in DuckDB and compare
row counts, column names and an order-insensitive hash of the values.
With ORACLE_PANDAS=1 the two results are also compared as pandas frames
(``toPandas()`` against ``.df()``): same dtypes and same text of every
value. ORACLE_EXACT=1 compares floats without rounding. ORACLE_FRESH=1
lands every layer anew instead of reusing earlier runs.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, ".")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "None"
        return repr(v) if EXACT else repr(round(v, 6))
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def frame_hash(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from revcast.session import get_spark

    spark = get_spark("local[8]", shuffle_partitions=8)
    if os.environ.get("ORACLE_FRESH") == "1":  # do not reuse landed layers of earlier runs
        import tempfile

        spark.conf.set("revcast.landing.dir", tempfile.mkdtemp(prefix="revcast-oracle-"))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"NOSQL {name}: rows={len(srows)} {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [c[0] for c in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        if os.environ.get("ORACLE_PANDAS") == "1":
            sp, dp = sdf.toPandas(), con.execute(sqls[name]).df()
            diff = {c: (str(sp[c].dtype), str(dp[c].dtype)) for c in sp.columns
                    if c in dp.columns and str(sp[c].dtype) != str(dp[c].dtype)}

            def _txt(df):
                df = df[sorted(df.columns)].astype(str)
                return sorted("|".join(r) for r in df.itertuples(index=False))
            if diff or _txt(sp) != _txt(dp):
                print(f"PANDAS-DIFF {name}: dtypes {diff}")
                bad += 1
        ok_cols = sorted(scols) == sorted(dcols)
        hs, ls = frame_hash(srows, scols)
        hd, ld = frame_hash(drows, dcols)
        ok = ok_cols and len(srows) == len(drows) and hs == hd
        print(f"{'OK  ' if ok else 'DIFF'} {name}: rows spark={len(srows)} duck={len(drows)} "
              f"cols={'same' if ok_cols else (sorted(set(scols) ^ set(dcols)))} hash={'same' if hs == hd else 'diff'} {ts:.1f}s")
        if not ok:
            bad += 1
            if ok_cols:
                a, b = set(ls), set(ld)
                print("   spark-only:", sorted(a - b)[:3])
                print("   duck-only: ", sorted(b - a)[:3])
                print("   cols:", sorted(scols))
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
