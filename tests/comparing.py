"""Compare a frame with what plain SQL returns on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _value(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    return value


def rows_of(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> list[str]:
    names, ours = rows_of(frame.columns, frame.collect())
    result = connection.execute(sql)
    their_names, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    found = []
    if names != their_names:
        found.append(f"columns {names} against {their_names}")
    if sum(ours.values()) != sum(theirs.values()):
        found.append(f"{sum(ours.values())} rows against {sum(theirs.values())}")
    found += [f"only here: {r}" for r in list((ours - theirs))[:3]]
    found += [f"only there: {r}" for r in list((theirs - ours))[:3]]
    return found
