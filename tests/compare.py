"""Run registered queries beside their SQL and report the first differences.

python tests/compare.py [query ...]
"""

from __future__ import annotations

import datetime
import importlib.util
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def compare(spark, con, query, sql, sf_dir):
    started = time.time()
    df = query(spark, sf_dir)
    names, rows = normal(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    if sql is None:
        return len(rows), seconds, []
    cursor = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    different = {n: (t, sql_types.get(n)) for n, t in df.dtypes if TYPES.get(t) != sql_types.get(n)}
    if different:
        print("        types differ:", different)
    sql_names, sql_rows = normal([d[0] for d in cursor.description], cursor.fetchall())
    problems = []
    if names != sql_names:
        problems.append(f"columns {names} <> {sql_names}")
    elif len(rows) != len(sql_rows):
        problems.append(f"{len(rows)} rows <> {len(sql_rows)}")
    else:
        problems = [f"{a} <> {b}" for a, b in zip(rows, sql_rows) if repr(a) != repr(b)]
    return len(rows), seconds, problems


def main():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    entry, sf_dir = load_entry(), "/root/testdata/sf0.01"
    con, oracle, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if len(sys.argv) > 1 and name not in sys.argv[1:]:
            continue
        try:
            n, seconds, problems = compare(spark, con, query, oracle.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            n, seconds, problems = 0, 0.0, [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'FAIL' if problems else 'ok  '} {name:30} {n:6} rows {seconds:6.2f}s"
              f"{'' if name in oracle else '  (rows only)'}", flush=True)
        for problem in problems[:3]:
            print("       ", problem[:700])
        if problems:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
