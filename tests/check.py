"""Run registered queries against their SQL on DuckDB and report differences."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, decimal.Decimal):
        return (1, str(value))
    if isinstance(value, (dt.date, dt.datetime)):
        return (1, value.isoformat())
    return (1, str(value))


def table_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark: SparkSession, con, sf_dir: str, function, sql: str | None) -> str | None:
    """None when equal, else what differs."""
    df = function(spark, sf_dir)
    found = table_of([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return None
    answer = con.sql(sql)
    wanted = table_of(answer.fetchall(), answer.columns)
    if found[0] != wanted[0]:
        return f"columns {found[0]} != {wanted[0]}"
    if found[1] != wanted[1]:
        pairs = [(f, w) for f, w in zip(found[1], wanted[1]) if f != w][:3]
        return f"{len(found[1])} rows vs {len(wanted[1])}; first differences {pairs}"
    kinds = {
        f.name: (f.dataType.simpleString(), str(t))
        for f, t in zip(
            sorted(df.schema.fields, key=lambda f: f.name),
            [t for _, t in sorted(zip(answer.columns, answer.types), key=lambda p: p[0])],
        )
    }
    aliases = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    off = {
        n: p for n, p in kinds.items()
        if aliases.get(p[0], p[0].upper()).replace(" ", "") != p[1].replace(" ", "")
    }
    if not found[1]:
        return "no rows"
    return f"types {off}" if off else None


if __name__ == "__main__":
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry

    # Arguments: table directory, then query names and Spark settings (key=value).
    sf = sys.argv[1]
    settings = dict(a.split("=", 1) for a in sys.argv[2:] if "=" in a)
    names = [a for a in sys.argv[2:] if "=" not in a] or list(entry.queries())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=settings)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    for name in names:
        began = time.time()
        try:
            verdict = compare(
                session, con, sf, entry.queries()[name], entry.oracle_sql().get(name)
            )
        except Exception as failure:
            verdict = f"{type(failure).__name__}: {str(failure)[:600]}"
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - began:.1f}s {verdict or ''}", flush=True)
