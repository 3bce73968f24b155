"""Compares queries with their SQL; also a command: ``oracle_compare.py FOLDER [KEY ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "decimal(10,2)": "DECIMAL(10,2)",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def rows(names, values):
    """Rows with columns in name order, sorted by their text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in values), key=repr)


def compare(spark, connection, key, query, sql, folder) -> str:
    """An empty text if both agree, else what differs."""
    df = query(spark, folder)
    relation = connection.sql(sql)
    spark_schema = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    sql_schema = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    if spark_schema != sql_schema:
        return f"schema {sorted(spark_schema.items())} is not {sorted(sql_schema.items())}"
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, the SQL gives {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine} is not {other}"
    return "" if ours else "no rows"


def main(folder: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from subsmart.session import local_session

    spark, connection, failed = local_session(), connect(folder), 0
    sql = oracle_sql()
    for key, query in queries().items():
        if only and key not in only:
            continue
        begin = time.time()
        try:
            problem = compare(spark, connection, key, query, sql[key], folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{key:34s} {time.time() - begin:6.1f}s {problem[:2500] or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
