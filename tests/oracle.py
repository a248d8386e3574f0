"""Compare a Spark query with its SQL, order and column order aside."""

import datetime
import decimal
import math
import os

import duckdb


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()[:26]
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=key)


def compare(df, sql, sf_dir):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert table_rows(df.columns, df.collect()) == table_rows(want.columns, want.fetchall())
