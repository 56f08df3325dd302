"""Compare catalog queries with their SQL oracles: rows as multisets, columns by name."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def normal(value: object) -> object:
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time() else value
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short account of what differs."""
    result = con.execute(sql)
    types = {c[0]: str(c[1]) for c in result.description}
    expected = rows_of(list(types), result.fetchall())
    spark_types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), "?") for f in df.schema}
    duck_types = {
        name: str(kind)
        for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()
    }
    if spark_types != duck_types:
        names = set(spark_types) | set(duck_types)
        return "types: " + ", ".join(
            f"{n}: {spark_types.get(n)} / {duck_types.get(n)}"
            for n in sorted(names)
            if spark_types.get(n) != duck_types.get(n)
        )
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if actual == expected:
        return None
    names = sorted(df.columns)
    only_spark = list((actual - expected).items())[:1]
    only_duck = list((expected - actual).items())[:1]
    text = f"{sum(actual.values())} / {sum(expected.values())} rows"
    if only_spark and only_duck:
        a, b = only_spark[0][0], only_duck[0][0]
        text += f", {sum((actual - expected).values())} differ; "
        text += ", ".join(f"{n}: {x!r} / {y!r}" for n, x, y in zip(names, a, b) if x != y)
    return text
