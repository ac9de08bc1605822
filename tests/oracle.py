"""Run registered queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def normal(value):
    """One value in a form both engines share."""
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(normal(v) for v in value)
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, np.integer)):
        return int(value)
    if isinstance(value, (float, np.floating)):
        return None if math.isnan(value) else float(value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    lists = [[normal(v) for v in frame[c].tolist()] for c in columns]
    return sorted(zip(*lists), key=repr) if columns else []


def kinds_of(frame: pd.DataFrame) -> dict[str, str]:
    """Column types; the unit pandas keeps times in and the type of an all-NULL column say nothing."""
    return {
        c: "datetime" if str(frame[c].dtype).startswith("datetime") else str(frame[c].dtype)
        for c in sorted(frame.columns)
        if not frame[c].isna().all()
    }


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, sf_dir: str, name: str, queries, oracles) -> str | None:
    """None when both agree, else what differs. Queries without SQL are only run."""
    got = queries[name](spark, sf_dir).toPandas()
    if name not in oracles:
        return None if len(got) else "no rows"
    want = connection.execute(oracles[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = rows_of(got), rows_of(want)
    for x, y in zip(a, b):
        if x != y:
            return f"row {str(x)[:300]} != {str(y)[:300]}"
    ka, kb = kinds_of(got), kinds_of(want)
    if ka != kb:
        return "types only: " + str({c: (ka[c], kb[c]) for c in ka if ka[c] != kb[c]})
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from millrace.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    picked = sys.argv[1:]
    if picked and picked[0].startswith("/"):
        sf_dir, *picked = picked
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    connection, bad = duck(sf_dir), 0
    for name in queries:
        if picked and not any(p in name for p in picked):
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name, queries, oracles)
        except Exception as error:  # report every query, not the first failure only
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name}: {problem or ('sql' if name in oracles else 'rows')}", flush=True)
    print(f"{len(queries)} queries, {len(oracles)} with SQL, {bad} bad")


if __name__ == "__main__":
    main()
