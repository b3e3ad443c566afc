"""Run registered queries on Spark and their oracle SQL on DuckDB and compare all rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def norm(value, digits=None):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.{digits}g}") if digits else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(norm(x, digits) for x in value)
    return value


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def compare(df, con, sql: str, digits=None) -> str | None:
    """None when equal, else a description of the first differences."""
    spark_names = df.columns
    names, rows = oracle_rows(con, sql)
    if sorted(spark_names) != sorted(names):
        return f"columns {sorted(set(spark_names) ^ set(names))}"
    order = sorted(names)
    pos = [names.index(c) for c in order]
    expected = Counter(tuple(norm(row[i], digits) for i in pos) for row in rows)
    got = Counter(tuple(norm(row[c], digits) for c in order) for row in df.collect())
    if got == expected:
        return None
    extra, missing = got - expected, expected - got
    return (
        f"rows spark={sum(got.values())} duck={sum(expected.values())} differ={sum(extra.values())}\n"
        f"  cols {order}\n  spark {list(extra)[:3]}\n  duck  {list(missing)[:3]}"
    )


def main(sf: str, keys: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    keys = [k for k in queries if not keys or any(k == x or queries[k].__module__.endswith('.' + x) for x in keys)]
    for key in keys:
        t0 = time.time()
        try:
            df = queries[key](spark, sf)
            if key in oracles:
                problem = compare(df, con, oracles[key])
                if problem:
                    loose = compare(df, con, oracles[key], 9)
                    problem = f"{'(9 digits equal) ' if loose is None else ''}{problem}"
                n = len(oracle_rows(con, oracles[key])[1])
            else:
                n, problem = df.count(), None
        except Exception as exc:  # noqa: BLE001
            n, problem = -1, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{key:28s} {'ok' if problem is None else 'BAD'} rows={n} {time.time() - t0:.2f}s"
              f"{'' if key in oracles else ' (no oracle)'}{'' if problem is None else chr(10) + problem}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
