"""Compare every registered query with its SQL: columns, row count, values.

Run directly: ``python tests/compare.py SF_DIR [NAME ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return int(value) if value.is_integer() else round(value, 9)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both sides agree, else what differs."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = _bag(columns, cursor.fetchall())
    found = _bag(spark_df.columns, spark_df.collect())
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    for name, spark_type in spark_df.dtypes:
        if types[name] != TYPES[spark_type]:
            return f"type of {name}: {spark_type} != {types[name]}"
    if found != expected:
        missing, surplus = expected - found, found - expected
        return (
            f"rows {found.total()} vs {expected.total()}; missing {missing.total()} "
            f"{list(missing)[:2]}; surplus {surplus.total()} {list(surplus)[:2]}"
        )
    return None


def main() -> int:
    import __spark_entry__ as contract
    from doselake.session import local_session

    sf_dir, *wanted = sys.argv[1:]
    spark = local_session("8")
    con = open_oracle(sf_dir)
    oracle = contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = differences(df, con, oracle[name])
                note = problem or "ok"
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = note = f"{type(error).__name__}: {str(error)[:400]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - began:6.2f}s {note}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
