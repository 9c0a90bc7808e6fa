"""Compare a registered query with its oracle SQL on one data folder."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(sf: str):
    con = duckdb.connect()
    for t in TABLES.split():
        if glob.glob(os.path.join(sf, f"{t}.parquet")):
            con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, Decimal):
        return format(x, "f")
    if isinstance(x, datetime):
        return x.isoformat()
    if isinstance(x, date):
        return x.isoformat()
    if isinstance(x, float):
        return repr(round(x, 6))
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str:
    """Empty text when both sides agree, otherwise what differs."""
    rel = con.sql(sql)
    if sorted(rel.columns) != sorted(spark_df.columns):
        return f"columns differ: spark {sorted(spark_df.columns)} oracle {sorted(rel.columns)}"
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = rows_of(rel.columns, rel.fetchall())
    if ours != theirs:
        a, b = ours - theirs, theirs - ours
        return f"rows {sum(ours.values())} vs {sum(theirs.values())}; only spark {list(a)[:2]}; only oracle {list(b)[:2]}"
    return ""
