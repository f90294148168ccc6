"""Queries that replay a table through a stream and read back what the stream wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from demandloom.catalog.registry import query
from demandloom.catalog.scoring import LAG_COLUMNS, ROLLING_COLUMNS, STAT_SQL, week_ago
from demandloom.catalog.staffing import DEMAND, _erlang_sql
from demandloom.catalog.tables import CUBE, PANEL, contacts, panel, table
from demandloom.config import LAGS, WINDOW_STATS, WINDOWS
from demandloom.functions import calendar
from demandloom.plans.tables import new_folder
from demandloom.streaming import demand, series

#: The replay stops and starts again this often.
RUNS = 3


def replayed(
    spark: SparkSession, rows: DataFrame, time: str, folder: str, start: Callable[[DataFrame], DataStreamWriter]
) -> None:
    """Write the rows in ``RUNS`` deliveries by time, and run the stream after each of them.

    ``start(stream)`` gives a writer; every run is a new query that goes on from the checkpoint. The
    last delivery has a row without a key, ten years on, that lets the watermark pass all others.
    """
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    ends = rows.agg(F.min(seconds).alias("first"), F.max(seconds).alias("last")).first()
    first, last = ends["first"] or 0, ends["last"] or 0
    delivery = F.floor((seconds - first) * RUNS / F.lit(last - first + 1))
    later = F.timestamp_seconds(F.lit(last + 10 * 366 * 86_400))
    kinds = {f.name: f.dataType for f in rows.schema}
    beat = spark.range(1).select(*[(later if c == time else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])
    for run in range(RUNS):
        some = rows.where(delivery == run)
        some = some.unionByName(beat) if run == RUNS - 1 else some
        some.write.mode("append").parquet(f"{folder}/in")
        start(demand.read_stream(spark, f"{folder}/in", rows.schema)).start().awaitTermination()


HISTORY = f"""{PANEL},
numbered AS (SELECT *, count(*) OVER past AS n, avg(sales) OVER past AS m FROM panel
             WINDOW past AS (PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
history AS (
  SELECT date, store_id, sales,
         {", ".join(f"CASE WHEN n >= {k} THEN lag(sales, {k}) OVER w ELSE m END AS sales_lag_{k}" for k in LAGS)},
         {", ".join(f"CASE WHEN n >= {w} THEN {STAT_SQL[s]} OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN {w} PRECEDING"
                    f" AND 1 PRECEDING) {'WHEN n > 0 THEN 0.0' if s == 'std' else 'ELSE m'} END AS sales_rolling_{w}_{s}"
                    for w in WINDOWS for s in WINDOW_STATS)}
  FROM numbered WINDOW w AS (PARTITION BY store_id ORDER BY date)),
predicted AS (SELECT *, sales_rolling_7_mean * CASE WHEN isodow(date) >= 6 THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END
                        AS prediction FROM history)"""

FEATURES = " ".join(f"{c}:3" for c in [*LAG_COLUMNS, *ROLLING_COLUMNS])


def with_weekend(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_weekend", calendar.date_parts(F.col("date"))["is_weekend"])


@query("history_features", f"date:d store_id:s sales:2 {FEATURES}", f"{HISTORY} => SELECT * FROM history")
def history_features(spark, folder):
    return series.history_features(panel(spark, folder).select("date", "store_id", "sales"))


@query("stream_scoring", f"date:d store_id:s sales:2 {FEATURES} prediction:3", f"{HISTORY} => SELECT * FROM predicted")
def stream_scoring(spark, folder):
    rows = panel(spark, folder).select("date", "store_id", "sales")
    place = new_folder(spark, "stream-scoring")

    def start(stream):
        featured = series.stream_features(stream)
        score = lambda batch: week_ago(with_weekend(batch))
        return demand.score_batches(featured, score, f"{place}/out", f"{place}/checkpoint")

    replayed(spark, rows, "date", place, start)
    return spark.read.parquet(f"{place}/out")


def _streamed(spark, rows, time, name, build, out=None):
    """What ``build(stream)`` has appended to files after all deliveries."""
    place = new_folder(spark, name)

    def start(stream):
        return (
            build(stream).writeStream.format("parquet").outputMode("append").option("path", f"{place}/out")
            .option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True)
        )

    replayed(spark, rows, time, place, start)
    return spark.read.parquet(f"{place}/out")


@query("stream_demand", "timestamp:t channel:s volume:i average_handle_time:6", f"{CUBE} => SELECT * FROM cube")
def stream_demand(spark, folder):
    return _streamed(spark, contacts(spark, folder), "timestamp", "stream-demand", demand.interval_demand)


@query("stream_staffing", "timestamp:t channel:s volume:i workload:6 productive_agents:0 required_agents:0",
       f"{DEMAND}, {_erlang_sql('blocking')} => SELECT * FROM plan")
def stream_staffing(spark, folder):
    return _streamed(spark, contacts(spark, folder), "timestamp", "stream-staffing", demand.live_staffing)


@query("stream_unique", "user_id:i ts:t",
       "=> SELECT DISTINCT user_id, date_trunc('second', ts) AS ts FROM events")
def stream_unique(spark, folder):
    """Every event comes twice, half of the repeats in the same delivery; one row of each second stays."""
    rows = table(spark, folder, "events").select("user_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    once = lambda s: demand.without_repeats(s.where("user_id IS NOT NULL"), ["user_id", "ts"], "ts")
    return _streamed(spark, rows.unionByName(rows), "ts", "stream-unique", once)
