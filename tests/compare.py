"""Run every query beside its SQL twin and compare the bags of rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, db, sf_dir, build, sql) -> str | None:
    """None when equal, otherwise what differs."""
    got = build(spark, sf_dir)
    found = db.execute(sql)
    names = [column[0] for column in found.description]
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    types = {column[0]: str(column[1]) for column in found.description}
    wrong = {name: (kind, types[name]) for name, kind in got.dtypes if SQL_TYPES.get(kind) != types[name]}
    if wrong:
        return f"types differ: {wrong}"
    mine = bag(got.columns, [tuple(row) for row in got.collect()])
    theirs = bag(names, found.fetchall())
    if mine == theirs:
        return None
    extra, lacking = mine - theirs, theirs - mine
    return f"{mine.total()} vs {theirs.total()} rows; surplus {list(extra.items())[:3]}; lacking {list(lacking.items())[:3]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    sqls = oracle_sql()
    for name, build in queries().items():
        if name not in sqls or wanted and name not in wanted:
            continue
        began = time.time()
        try:
            problem = compare(spark, db, sf_dir, build, sqls[name])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
