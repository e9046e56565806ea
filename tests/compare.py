"""Runs a registered query and its SQL oracle and compares their rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from tidemark.sources.tables import SCHEMAS
from tidemark.workload import ORACLES, QUERIES


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in SCHEMAS:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        raise TypeError("compared output must not hold native dates")
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when query and oracle agree in names, types and rows; otherwise what differs."""
    df = QUERIES[name](spark, sf_dir)
    described = connection.execute(ORACLES[name]).description
    ours = {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {d[0]: str(d[1]) for d in described}
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if not ours:
        return "no rows"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference ({sorted(names)}): {a} != {b}"
    return None
