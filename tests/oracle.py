"""Run a registered query and its SQL side by side and compare all values."""

from __future__ import annotations

import collections
import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def differences(spark_df, con, sql: str, limit: int = 5) -> list[str]:
    """What differs: columns, kinds of types, row counts, values."""
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    kinds = {d[0]: str(d[1]) for d in out.description}
    wanted = out.fetchall()
    got = spark_df.collect()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: {sorted(spark_df.columns)} != {sorted(names)}"]
    order = sorted(names)
    problems = []
    whole = {"tinyint", "smallint", "int", "bigint"}
    for name, kind in spark_df.dtypes:
        oracle = kinds[name].upper()
        is_double, oracle_double = kind in ("double", "float"), oracle in ("DOUBLE", "FLOAT")
        is_date, oracle_date = kind == "date", oracle == "DATE"
        is_whole, oracle_whole = kind in whole, "INT" in oracle and "INTERVAL" not in oracle
        if (is_double, is_date, is_whole) != (oracle_double, oracle_date, oracle_whole):
            problems.append(f"type of {name}: {kind} / {oracle}")
    at = [names.index(n) for n in order]
    left = collections.Counter(tuple(plain(r[n]) for n in order) for r in got)
    right = collections.Counter(tuple(plain(r[i]) for i in at) for r in wanted)
    if len(got) != len(wanted):
        problems.append(f"rows: {len(got)} != {len(wanted)}")
    if left != right:
        key = lambda kv: str(kv[0])
        problems.append(f"values: {sum((left - right).values())} of {len(got)} rows differ; columns {order}")
        problems += [f"  spark  {r}" for r, _ in sorted((left - right).items(), key=key)[:limit]]
        problems += [f"  oracle {r}" for r, _ in sorted((right - left).items(), key=key)[:limit]]
    return problems
