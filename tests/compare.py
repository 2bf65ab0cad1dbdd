"""Compare registered queries with their SQL on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{root}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=repr
    )


def difference(frame, connection, sql: str) -> str | None:
    """None where both agree, else a short description."""
    names, ours = _table(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    sql_names, theirs = _table(columns, cursor.fetchall())
    if names != sql_names:
        return f"columns {names} against {sql_names}"
    if len(ours) != len(theirs):
        extra = list(set(ours) - set(theirs))[:2], list(set(theirs) - set(ours))[:2]
        return f"{len(ours)} rows against {len(theirs)}: {str(extra)[:900]}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"row {str(a)[:600]}\n   against {str(b)[:600]}"
        kinds = [(type(x).__name__, type(y).__name__) for x, y in zip(a, b) if x is not None and y is not None]
        if any(x != y for x, y in kinds):
            return f"types {kinds}"
    return None


_SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_difference(frame, connection, sql: str) -> str | None:
    theirs = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    ours = {n: _SPARK_TO_SQL.get(t, t) for n, t in frame.dtypes}
    wrong = {n: (ours[n], theirs.get(n)) for n in ours if ours[n] != theirs.get(n)}
    return str(wrong) if wrong else None


def main(root: str, *names: str) -> None:
    sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from quorumlake.session import session

    spark = session(
        "compare", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(root)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if names and not any(n in name for n in names):
            continue
        began = time.time()
        try:
            frame = build(spark, root)
            if name in sql:
                note = difference(frame, connection, sql[name])
                types = type_difference(frame, connection, sql[name])
                note = note or (f"TYPES {types}" if types else None)
            else:
                note = f"rows only: {frame.count()}"
        except Exception as error:  # noqa: BLE001
            note = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        bad += note is not None and not note.startswith("rows only")
        print(f"{name:28s} {time.time() - began:6.2f}s {note or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(*sys.argv[1:])
