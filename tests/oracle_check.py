"""Compare a registered query with its SQL, as sorted rows with columns in name order."""

import os

import duckdb

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        file = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(file):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{file}')")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def compare(spark, con, name, sf_dir):
    df = contract.queries()[name](spark, sf_dir)
    ours = _sorted(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(contract.oracle_sql()[name])
    theirs = _sorted([c[0] for c in result.description], result.fetchall())
    return ours, theirs
