"""Run registered Spark queries next to their DuckDB SQL and compare.

Comparison: column names (sorted), row count, and the multiset of rows
with values normalised (decimals as text, floats to 9 significant digits).
Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                  "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
                  "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT",
                  "timestamp_ntz": "TIMESTAMP"}


def _spark_type(t: str) -> str:
    return _SPARK_TO_DUCK.get(t, t.upper())


def compare(spark, con, name: str, sf_dir: str, query, sql: str | None) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    con.execute(f"CREATE OR REPLACE VIEW oracle AS {sql}")  # as the driver runs it
    cur = con.execute("SELECT * FROM oracle")
    dcols = [d[0] for d in cur.description]
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    stypes = {f.name: _spark_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    drows = cur.fetchall()
    res["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS spark={scols} duck={dcols}"
        return res
    a, b = _rows(scols, srows), _rows(dcols, drows)
    type_diff = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
    if a == b and type_diff:
        res["status"] = f"TYPES differ {type_diff}"
    elif a == b:
        res["status"] = "ok"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"VALUES differ (n={len(a)} vs {len(b)}) e.g. {diff}"
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from kubus.session import get_session
    import __spark_entry__ as E
    if os.environ.get("PLAIN_SESSION"):
        # The driver's way: no library settings at all.
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001 - report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("ok", "no-oracle")
        print(r, flush=True)
    print(f"{bad} failing of {len(names or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
