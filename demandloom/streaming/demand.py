"""Interval demand, live staffing, scoring and duplicate suppression on streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from demandloom.config import StaffingAssumptions
from demandloom.operators.staffing import demand_cube, staffing_plan


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def watermarked(stream: DataFrame, time: str, delay: str = "2 hours") -> DataFrame:
    """Event time as a zoned timestamp, which watermarks need, with its watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def interval_demand(
    stream: DataFrame,
    time: str = "timestamp",
    by: Sequence[str] = ("channel",),
    handle_time: str = "handle_time",
    interval: str = "1 hour",
    delay: str = "2 hours",
) -> DataFrame:
    """Volume and mean handle time per interval; emitted once the watermark has passed it."""
    return demand_cube(watermarked(stream, time, delay), time, by, handle_time, interval)


def live_staffing(
    stream: DataFrame, cfg: StaffingAssumptions = StaffingAssumptions(), **demand
) -> DataFrame:
    """Staffing plan of every closed interval."""
    return staffing_plan(interval_demand(stream, **demand), cfg)


def without_repeats(
    stream: DataFrame, keys: Sequence[str], time: str = "timestamp", delay: str = "2 hours"
) -> DataFrame:
    """Keep the first row of each key within the watermark."""
    return watermarked(stream, time, delay).dropDuplicatesWithinWatermark(list(keys))


def score_batches(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> DataStreamWriter:
    """Score each micro-batch and write it under its batch number, so that a retry replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
