"""Compare each registered query with its DuckDB oracle on one test scale.

Usage: python tests/oracle_check.py [sf_dir] [key ...]

Prints one line per key: row counts, column sets, column types and whether the
order-insensitive multiset of rows is identical.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        return ("float", round(v, 9))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    return ("v", v)


_SPARK_TO_DUCK = {
    "StringType()": "VARCHAR",
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "ShortType()": "SMALLINT",
    "BooleanType()": "BOOLEAN",
    "DateType()": "DATE",
    "TimestampNTZType()": "TIMESTAMP",
    "DoubleType()": "DOUBLE",
}


def duck_type(spark_type) -> str:
    r = repr(spark_type)
    return _SPARK_TO_DUCK.get(r) or r.replace("DecimalType(", "DECIMAL(").replace(", ", ",")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, keys: list[str] | None = None) -> dict[str, dict]:
    import __spark_entry__ as entry

    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for key in keys or sorted(oracle):
        t0 = time.time()
        sdf = qs[key](spark, sf_dir)
        s_cols = sdf.columns
        s_rows = [tuple(r) for r in sdf.collect()]
        t1 = time.time()
        rel = con.sql(oracle[key])
        d_cols = rel.columns
        d_types = dict(zip(d_cols, (str(t) for t in rel.types)))
        d_rows = rel.fetchall()
        s_types = {f.name: duck_type(f.dataType) for f in sdf.schema.fields}
        order = sorted(s_cols)
        s_idx = [s_cols.index(c) for c in order]
        res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
        if sorted(d_cols) != order:
            res["columns"] = f"spark {sorted(s_cols)} vs oracle {sorted(d_cols)}"
            res["match"] = False
        else:
            d_idx = [d_cols.index(c) for c in order]
            sc = Counter(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
            dc = Counter(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
            type_diff = {c: (s_types[c], d_types[c]) for c in order if s_types[c] != d_types[c]}
            res["match"] = sc == dc and not type_diff
            if type_diff:
                res["types"] = type_diff
            if sc != dc:
                res["only_spark"] = list((sc - dc).elements())[:3]
                res["only_oracle"] = list((dc - sc).elements())[:3]
                res["columns_order"] = order
        out[key] = res
        print(key, res, flush=True)
    return out


if __name__ == "__main__":
    from ledgerline.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    result = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in result.items() if not v["match"]]
    print("MISMATCH:", bad if bad else "none", f"({len(result) - len(bad)}/{len(result)} match)")
