"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: [ORACLE_TZ=America/Los_Angeles] python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key and a JSON summary; exit code 1 on any mismatch.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    import datetime

    import numpy as np

    if v is None:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, (datetime.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, key, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    scols = list(sdf.columns)
    srows = rows_of(scols, [tuple(r) for r in sdf.collect()])
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = rows_of(dcols, res.fetchall())
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_v = srows == drows
    detail = ""
    if not ok_v and ok_n:
        for a, b in zip(srows, drows):
            if a != b:
                detail = f"first diff spark={a} duck={b}"
                break
    return {
        "key": key,
        "cols": ok_cols,
        "rows": ok_n,
        "values": ok_v,
        "n_spark": len(srows),
        "n_duck": len(drows),
        "spark_s": round(t1 - t0, 2),
        "duck_s": round(t2 - t1, 2),
        "detail": detail if not ok_cols else detail,
        "spark_cols": scols if not ok_cols else None,
        "duck_cols": dcols if not ok_cols else None,
    }


def main(argv):
    import duckdb

    import __spark_entry__ as entry
    from encore.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = local_session()
    if os.environ.get("ORACLE_TZ"):  # results must not depend on the session time zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    results = []
    for key in keys or list(qs):
        if key not in sqls:
            t0 = time.time()
            n = qs[key](spark, sf_dir).count()
            print(f"{key:32s} rows-only n={n} {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            r = compare(spark, con, key, qs[key], sqls[key], sf_dir)
        except Exception as e:  # report and go on
            r = {"key": key, "error": repr(e)[:400]}
        results.append(r)
        good = r.get("cols") and r.get("rows") and r.get("values")
        bad += not good
        print(
            f"{key:32s} {'OK ' if good else 'BAD'} "
            + json.dumps({k: v for k, v in r.items() if k != 'key' and v not in (None, '')}),
            flush=True,
        )
    print(json.dumps({"checked": len(results), "bad": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
