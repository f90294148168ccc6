"""Readers and writers of panels, tables and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.operators.validate import missing_columns
from demandloom.plans.tables import nan_to_null

# Column types of the source tables.
SCHEMAS = {
    "sales": "date date, store_id string, product_id string, category string, quantity_sold bigint,"
    " unit_price double, discount_percent double, revenue double, cost double, profit double",
    "customer_traffic": "date date, store_id string, customer_traffic bigint, weather_impact double,"
    " is_holiday boolean",
    "inventory": "date date, store_id string, product_id string, inventory_level bigint,"
    " reorder_point bigint, days_of_supply double",
    "promotions": "date timestamp, product_id string, promotion_type string, discount_percent double",
    "store_events": "store_id string, date timestamp, event_type string, impact double",
    "contact_center": "timestamp timestamp, business_unit string, channel string, volume bigint,"
    " average_handle_time double, day_of_week int, day_of_week_name string, hour_of_day int,"
    " is_holiday boolean, holiday_name string, is_weekend boolean, date timestamp",
}


def read_panel(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType | None = None,
    where: Column | str | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Read a directory tree of parquet files; partition directories become columns.

    ``where`` on partition columns prunes directories, on others it reaches the scan. With
    ``tolerant`` unreadable and vanished files are skipped, which needs a schema.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if tolerant:
        if schema is None:
            raise ValueError("A tolerant read needs a schema")
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    paths = [path] if isinstance(path, str) else list(path)
    df = nan_to_null(reader.parquet(*paths))
    return df if where is None else df.where(where)


def combine(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    required: Sequence[str],
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Read CSV files by header name, rename, and insist on the required columns.

    Columns of ``schema`` that the file has are cast to their type, unreadable values to null.
    """
    raw = spark.read.csv(path, header=True)
    for old, new in (rename or {}).items():
        if new not in raw.columns and old in raw.columns:
            raw = raw.withColumnRenamed(old, new)
    absent = missing_columns(raw, required)
    if absent:
        raise ValueError(f"Missing columns: {absent}")
    types = {f.name: f.dataType for f in T.StructType.fromDDL(schema)}
    return raw.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in raw.columns})


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "date date, sales double, store_id string", ("date", "sales"))


def read_staffing_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "timestamp timestamp, volume double, average_handle_time double, scheduled_agents double,"
        " forecast_lower double, forecast_upper double"
    )
    required = ("timestamp", "volume", "average_handle_time")
    return read_csv(spark, path, schema, required, {"date": "timestamp"})


# Partition columns by layout.
LAYOUTS = {
    "day": {"year": F.year, "month": F.month, "day": F.dayofmonth},
    "week": {"year": F.year, "week": F.weekofyear},
}


def write_partitioned(
    df: DataFrame, path: str, date: str = "date", layout: str = "day", mode: str = "overwrite"
) -> None:
    """Write parquet in date directories.

    Rows are rebalanced by directory: adaptive execution merges small days and splits a day
    that is too large for one task, so a hot day becomes several files.
    """
    parts = LAYOUTS[layout]
    dated = df.withColumns({name: fn(F.col(date)) for name, fn in parts.items()})
    balanced = dated.hint("rebalance", *[F.col(c) for c in parts])
    balanced.write.mode(mode).partitionBy(*parts).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_lines(df: DataFrame, path: str, line: str = "line", mode: str = "overwrite") -> None:
    df.select(F.col(line).alias("value")).write.mode(mode).text(path)


def report_table(sections: dict[str, DataFrame]) -> DataFrame:
    """Report tables as JSON lines ``section, body``, whatever their columns."""
    return reduce(
        DataFrame.unionByName,
        [
            t.select(F.lit(name).alias("section"), F.to_json(F.struct(*t.columns)).alias("body"))
            for name, t in sections.items()
        ],
    )


def write_report(sections: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """Write the report as JSON, one directory per section."""
    report_table(sections).write.mode(mode).partitionBy("section").text(path)


def dataset_metadata(df: DataFrame, date: str, **distinct: str) -> DataFrame:
    """One row on a dataset: rows, date range, distinct counts, column names."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(date).alias("start_date"),
        F.max(date).alias("end_date"),
        *[F.count_distinct(F.col(c)).alias(name) for name, c in distinct.items()],
    ).withColumn("columns", F.array(*[F.lit(c) for c in df.columns]))
