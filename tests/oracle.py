"""Compares a registered query's rows with those of its SQL counterpart."""

import datetime
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, decimal.Decimal, float)):
        return repr(float(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return repr(value)


def table(names, rows):
    place = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in place) for r in rows), key=repr)


def of_spark(df):
    return table(df.columns, df.collect())


def of_sql(con, sql):
    found = con.execute(sql)
    return table([c[0] for c in found.description], found.fetchall())
