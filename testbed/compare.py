"""Run queries on Spark and their SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return repr(float(value))
    return None if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=lambda r: tuple(str(v) for v in r))


# DuckDB type of each Spark type the queries return.
SAME_TYPE = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, con, sql: str) -> list[str]:
    theirs = {name: str(kind) for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{c}: {t} is not {theirs.get(c)}" for c, t in df.dtypes if SAME_TYPE.get(t) != theirs.get(c)]


def differences(spark: SparkSession, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both engines give the same rows, otherwise what differs first."""
    df = query(spark, sf_dir)
    if wrong_types := type_differences(df, con, sql):
        return "; ".join(wrong_types)
    mine = _rows(df.columns, df.collect())
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = _rows(names, answer.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    from pingloom.session import build_session
    from testbed import oracle, queries

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or queries.ALL:
        start = time.time()
        if name not in oracle.ALL:
            print(f"{name}: no SQL")
            continue
        try:
            found = differences(spark, con, queries.ALL[name], oracle.ALL[name], sf_dir)
        except Exception as error:  # the other queries are compared all the same
            found = f"{type(error).__name__}: {str(error)[:300]}"
        bad += found is not None
        print(f"{'FAIL' if found else 'ok':4} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
