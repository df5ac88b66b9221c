"""Compare queries with their DuckDB SQL: column names, types in kind, and all values."""

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", v + 0.0)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, decimal.Decimal):
        return ("d", v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def difference(spark_rows, spark_cols, con, sql):
    """None if equal, else a short text."""
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    rows = cur.fetchall()
    if sorted(cols) != sorted(spark_cols):
        return f"columns {sorted(spark_cols)} vs {sorted(cols)}"
    names = sorted(cols)
    a = Counter(tuple(plain(r[spark_cols.index(n)]) for n in names) for r in spark_rows)
    b = Counter(tuple(plain(r[cols.index(n)]) for n in names) for r in rows)
    if a != b:
        only_a, only_b = a - b, b - a
        return (
            f"{sum(a.values())} vs {sum(b.values())} rows, {sum(only_a.values())} differ; {names}\n"
            f"  spark {list(only_a)[:2]}\n  duck  {list(only_b)[:2]}"
        )
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from conftest import make_session

    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = make_session()
    con, sqls, bad = duck(sf), oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            rows = df.collect()
            text = "rows only" if name not in sqls else difference(rows, df.columns, con, sqls[name])
        except Exception as e:  # report and go on with the next query
            text = f"FAILED {type(e).__name__}: {str(e)[:1500]}"
            rows = []
        bad += text not in (None, "rows only")
        print(f"{name:32s} {len(rows):8d} rows {time.time() - t:6.2f}s {text or 'equal'}", flush=True)
    print("not equal:", bad)
