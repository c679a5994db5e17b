"""Compare named queries with their SQL, run by another engine on the same files."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def bag(columns: list[str], rows: list) -> Counter:
    """Rows as a multiset, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, run, statement: str, sf_dir: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = run(spark, sf_dir)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(statement)
    columns = [d[0] for d in result.description]
    want = bag(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"{name}: columns {sorted(df.columns)} vs {sorted(columns)}"
    kinds = {
        "tinyint": "TINYINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
        "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
    }
    want_types = {d[0]: str(d[1]) for d in result.description}
    for field in df.schema.fields:
        kind = kinds.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != want_types[field.name]:
            return f"{name}: type of {field.name} is {kind}, SQL gives {want_types[field.name]}"
    if got != want:
        more, less = got - want, want - got
        return (
            f"{name}: {sum(got.values())} rows vs {sum(want.values())};"
            f" only Spark {list(more)[:3]}; only SQL {list(less)[:3]}"
        )
    return None if got else f"{name}: no rows"


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    sf_dir, wanted = argv[0], argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    statements, bad = oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in statements:
                problem = compare(spark, con, name, run, statements[name], sf_dir)
            else:
                problem = None if run(spark, sf_dir).count() else f"{name}: no rows"
        except Exception as error:  # report every query, not only the first failure
            problem = f"{name}: {type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        state = "BAD " if problem else "ok  " if name in statements else "rows"
        print(f"{state} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
