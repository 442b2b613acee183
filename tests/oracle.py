"""Compare the named queries with their SQL on DuckDB.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = Path("/root/testdata")


def connect(folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


KINDS = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}


def compare(spark, con, folder: str, function, sql: str) -> str:
    """Empty if both sides agree, else what differs."""
    df = function(spark, folder)
    ours = _rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    kinds = {column[0]: KINDS.get(str(column[1]), str(column[1])) for column in result.description}
    theirs = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if dict(df.dtypes) != kinds:
        return f"types {dict(df.dtypes)} and {kinds}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"first difference {left} and {right}"
    return "" if ours else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.conftest import local_session

    arguments = sys.argv[1:]
    folder = arguments[0] if arguments else str(TABLES / "sf0.01")
    session = local_session()
    connection = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in arguments[1:] or queries:
        start = time.time()
        try:
            if name in oracles:
                outcome = compare(session, connection, folder, queries[name], oracles[name])
            else:
                outcome = "" if queries[name](session, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(outcome)
        print(f"{name:28} {time.time() - start:6.2f}s {outcome or 'ok'}", flush=True)
    print(f"{bad} differ")
