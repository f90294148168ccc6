"""Registry of named queries. A column list fixes the output of a query and of its SQL twin.

The list is ``name:kind`` words, where kind is ``s`` text, ``i`` whole number, ``d`` date and
``t`` timestamp (both as text), or a digit: a double rounded to that many places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _rounded(column: Column, digits: int) -> Column:
    # Adding 0.0 turns a negative zero into a plain one.
    return F.round(column.cast("double") * float(10**digits)) / float(10**digits) + F.lit(0.0)


def _present(word: str) -> Column:
    name, kind = word.rsplit(":", 1)
    column = F.col(name)
    if kind == "i":
        column = column.cast("bigint")
    elif kind == "t":
        column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    elif kind.isdigit():
        column = _rounded(column, int(kind))
    else:
        column = column.cast("string")
    return column.alias(name)


def _present_sql(word: str) -> str:
    name, kind = word.rsplit(":", 1)
    name = f'"{name}"'
    if kind == "i":
        text = f"CAST({name} AS BIGINT)"
    elif kind == "t":
        text = f"strftime({name}, '%Y-%m-%d %H:%M:%S')"
    elif kind.isdigit():
        value = f"round(CAST({name} AS DOUBLE), {kind})"
        text = f"CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE {value} END"
    else:
        text = f"CAST({name} AS VARCHAR)"
    return f"{text} AS {name}"


def query(name: str, columns: str, sql: str | None = None):
    """Register a query; ``sql`` is ``WITH``-less: common tables, then ``=>`` and the body."""
    words = columns.split()

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(spark, folder).select(*[_present(w) for w in words])

        QUERIES[name] = run
        if sql is not None:
            shared, body = sql.split("=>", 1) if "=>" in sql else ("", sql)
            shown = ", ".join(_present_sql(w) for w in words)
            prefix = f"WITH {shared.strip()} " if shared.strip() else ""
            ORACLES[name] = f"{prefix}SELECT {shown} FROM ({body.strip()}) AS answer"
        return build

    return register
