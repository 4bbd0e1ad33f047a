"""Spark results against DuckDB's on the same tables."""

import duckdb
import numpy as np

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    value = value.item() if isinstance(value, np.generic) else value
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value if isinstance(value, (int, bool, str)) else str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(repr(tuple(map(plain, row))) for row in frame.itertuples(index=False, name=None))


def duck(sf, sql):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection.sql(sql).df()


def same(df, sf, sql):
    ours, theirs = df.toPandas(), duck(sf, sql)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
