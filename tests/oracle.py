"""Compares a query with its SQL: columns by name, rows as a multiset, floats to 9 digits."""

from __future__ import annotations

import math
from collections import Counter

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder):
    import duckdb

    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return db


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    return x


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def sql_rows(db, sql):
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, Counter(tuple(_plain(row[i]) for i in at) for row in result.fetchall())
