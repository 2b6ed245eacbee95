"""Compare a registered Spark query with its DuckDB twin on the parquet test tables:
row count, column names and an order-insensitive comparison of the values (doubles
compared after rounding to 6 digits)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from fieldrank.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name: str, sf_dir: str, con=None, show: int = 5):
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    sql = oracle_sql().get(name)
    if sql is None:
        return {"name": name, "rows": len(srows), "oracle": None, "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    a, b = canon(srows, scols), canon(drows, dcols)
    ok = ok_cols and a == b
    info = {"name": name, "match": ok, "rows": (len(srows), len(drows)), "cols_ok": ok_cols,
            "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if not ok:
        info["cols"] = (sorted(scols), sorted(dcols))
        sa, sb = set(a), set(b)
        info["only_spark"] = sorted(sa - sb, key=str)[:show]
        info["only_duck"] = sorted(sb - sa, key=str)[:show]
    return info


if __name__ == "__main__":
    from fieldrank.session import get_spark

    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf)
    from __spark_entry__ import queries as _q

    for n in names or list(_q()):
        try:
            print(compare(spark, n, sf, con), flush=True)
        except Exception as e:  # keep going over the catalog
            print({"name": n, "error": repr(e)[:2000]}, flush=True)
