"""Run registered queries against their SQL in DuckDB: python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _family(kind: str) -> str:
    """Column types by the names both engines share."""
    kind = kind.lower()
    return {"string": "varchar", "int": "integer", "number": "?"}.get(kind, kind)


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(name: str, result, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree in columns and rows, else what differs."""
    left_columns = result.columns
    left = _bag(left_columns, [tuple(r) for r in result.collect()])
    cursor = con.execute(sql)
    right_columns = [d[0] for d in cursor.description]
    if sorted(left_columns) != sorted(right_columns):
        return f"columns {sorted(left_columns)} <> {sorted(right_columns)}"
    types = {d[0]: _family(str(d[1])) for d in cursor.description}
    for column, kind in result.dtypes:
        if types[column] != _family(kind):
            return f"type of {column}: {kind} <> {types[column]}"
    right = _bag(right_columns, cursor.fetchall())
    if left != right:
        only_l, only_r = left - right, right - left
        return f"rows {sum(left.values())} <> {sum(right.values())}; only spark {list(only_l)[:2]}; only sql {list(only_r)[:2]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tariffmart.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    directory = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(directory)
    oracles = oracle_sql()
    names = sys.argv[2:] or list(queries())
    bad = 0
    for name in names:
        begin = time.time()
        try:
            df = queries()[name](spark, directory)
            problem = compare(name, df, con, oracles[name]) if name in oracles else f"no sql, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
