"""Features of the latest rows of each series on a stream, and scoring with them.

The state of a series is a ring of its last values, the sum and number of all of them, and the rows
that the watermark has not passed yet. Rows leave in the order of their time once the watermark has
passed them, so what arrives late or out of order within the delay gets the features that the same
row has in a batch. All state is in Spark's state store; a restart goes on where it ended.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from demandloom.config import FeatureConfig

DEFAULTS = FeatureConfig()
DAY = 86_400_000


def feature_names(target: str, config: FeatureConfig = DEFAULTS) -> list[str]:
    rolling = [f"{target}_rolling_{w}_{s}" for w in config.windows for s in config.stats]
    return [f"{target}_lag_{k}" for k in config.lags] + rolling


def history_features(
    df: DataFrame,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    config: FeatureConfig = DEFAULTS,
) -> DataFrame:
    """The batch form: for each row what ``last_window`` gives of the rows before it.

    Null targets are rows without a value: they move lags and windows on, statistics leave them out.
    A lag or window longer than the history is its mean, a deviation 0; the first row has no history.
    """
    series = Window.partitionBy(*keys).orderBy(date)
    past = series.rowsBetween(Window.unboundedPreceding, -1)
    n, mean = F.count(F.lit(1)).over(past), F.avg(target).over(past)
    known = F.col("__n") > 0
    fns = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max, "median": F.median}
    out = {
        f"{target}_lag_{k}": F.when(F.col("__n") >= k, F.lag(target, k).over(series)).otherwise(F.col("__mean"))
        for k in config.lags
    }
    for w in config.windows:
        frame = series.rowsBetween(-w, -1)
        recent = F.collect_list(target).over(frame)
        for stat in config.stats:
            value = _middle(recent) if stat == "median" else fns[stat](target).over(frame)
            short = F.when(known, F.lit(0.0)) if stat == "std" else F.col("__mean")
            out[f"{target}_rolling_{w}_{stat}"] = F.when(F.col("__n") >= w, value).otherwise(short)
    return df.withColumns({"__n": n, "__mean": mean}).withColumns(out).drop("__n", "__mean")


def _middle(values: Column) -> Column:
    ordered = F.sort_array(values)
    n = F.size(values)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


@dataclass
class Past:
    """What a series keeps of its rows: the last values (null: NaN), the numbers of rows and values, their sum."""

    ring: list[float]
    n: int = 0
    known: int = 0
    total: float = 0.0

    def features(self, values: np.ndarray, config: FeatureConfig) -> np.ndarray:
        """A row of features before each of the next ``values``; the past then ends with them."""
        depth = max([*config.lags, *config.windows])
        line = np.concatenate([np.full(depth - len(self.ring), np.nan), self.ring, values])
        before = np.lib.stride_tricks.sliding_window_view(line, depth)[:-1]
        there = ~np.isnan(values)
        known = self.known + np.cumsum(there) - there
        total = self.total + np.cumsum(np.where(there, values, 0.0)) - np.where(there, values, 0.0)
        n = self.n + np.arange(len(values))
        mean = np.where(known > 0, total / np.maximum(known, 1), np.nan)
        columns = [np.where(n >= k, before[:, -k], mean) for k in config.lags]
        fns = {"mean": np.nanmean, "std": np.nanstd, "min": np.nanmin, "max": np.nanmax, "median": np.nanmedian}
        with warnings.catch_warnings():
            # A window of nulls only has no statistics.
            warnings.simplefilter("ignore", RuntimeWarning)
            for w in config.windows:
                short = {"std": np.where(n > 0, 0.0, np.nan)}
                part = before[:, -w:]
                columns += [np.where(n >= w, fns[s](part, axis=1), short.get(s, mean)) for s in config.stats]
        self.ring = line[-min(depth, self.n + len(values)) :].tolist()
        self.n, self.known, self.total = self.n + len(values), int(known[-1] + there[-1]), float(np.nansum(values) + self.total)
        return np.column_stack(columns)


@dataclass
class SeriesFeatures(StatefulProcessor):
    """Rows ``row_at, row_value, row_text`` of one series, with the features of what came before them.

    ``forget_days``: a series silent for longer gives up its state and starts anew.
    """

    target: str
    config: FeatureConfig = DEFAULTS
    forget_days: int | None = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kind = "ring array<double>, n bigint, known bigint, total double, last bigint"
        self.past = handle.getValueState("past", kind)
        self.waiting = handle.getListState("waiting", "at bigint, value double, row string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        value = new["row_value"].astype(object).where(new["row_value"].notna(), None)
        self.waiting.appendList([(int(t), v, r) for t, v, r in zip(new["row_at"], value, new["row_text"])])
        self.handle.registerTimer(int(new["row_at"].min()))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = list(self.waiting.get()) if self.waiting.exists() else []
        ready = sorted((r for r in held if r[0] <= now), key=lambda r: (r[0], r[1] is None, r[1] or 0.0, r[2]))
        rest = [r for r in held if r[0] > now]
        forget = math.inf if self.forget_days is None else self.forget_days * DAY
        if ready:
            yield self._released(ready, forget)
        elif self.past.exists() and self.past.get()[4] + forget <= now:
            self.past.clear()
        if ready and rest:
            self.waiting.put(rest)
        elif ready:
            self.waiting.clear()
        if rest:
            self.handle.registerTimer(min(r[0] for r in rest))

    def _released(self, ready: list, forget: float) -> pd.DataFrame:
        if self.past.exists():
            ring, n, known, total, last = self.past.get()
            past = Past([np.nan if x is None else x for x in ring], n, known, total)
        else:
            past, last = Past([]), ready[0][0]
        at = np.array([r[0] for r in ready])
        values = np.array([np.nan if r[1] is None else r[1] for r in ready])
        anew = np.flatnonzero(np.diff(at, prepend=last) > forget)
        found = []
        for begin, end in zip([0, *anew], [*anew, len(at)]):
            if begin in anew:
                past = Past([])
            if end > begin:
                found.append(past.features(values[begin:end], self.config))
        ring = [None if np.isnan(x) else float(x) for x in past.ring]
        self.past.update((ring, past.n, past.known, past.total, int(at[-1])))
        if forget < math.inf:
            self.handle.registerTimer(int(at[-1] + forget))
        out = pd.DataFrame(np.concatenate(found), columns=feature_names(self.target, self.config))
        out.insert(0, "row_text", [r[2] for r in ready])
        return out

    def close(self) -> None:
        """Nothing is held outside the state store."""


def stream_features(
    stream: DataFrame,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    config: FeatureConfig = DEFAULTS,
    delay: str = "1 day",
    forget_days: int | None = None,
) -> DataFrame:
    """The stream's rows with the columns of :func:`history_features`, each once the watermark has passed it.

    Rows that come after the watermark are dropped; so are rows without a date.
    """
    use_rocksdb(stream.sparkSession)
    at = F.col(date).cast("timestamp")
    # Python gets rows as named tuples, whose names must not begin with an underscore.
    rows = stream.where(F.col(date).isNotNull()).select(
        *[F.col(k).alias(f"row_key_{k}") for k in keys],
        at.alias("row_time"),
        F.unix_millis(at).alias("row_at"),
        F.col(target).cast("double").alias("row_value"),
        F.to_json(F.struct(*stream.columns)).alias("row_text"),
    )
    features = ", ".join(f"`{c}` double" for c in feature_names(target, config))
    done = (
        rows.withWatermark("row_time", delay)
        .groupBy(*[f"row_key_{k}" for k in keys])
        .transformWithStateInPandas(
            SeriesFeatures(target, config, forget_days), f"row_text string, {features}", "Append", "EventTime"
        )
    )
    row = F.from_json("row_text", stream.schema)
    return done.withColumn("row_text", row).select("row_text.*", *feature_names(target, config))


def use_rocksdb(spark: SparkSession) -> None:
    """State with timers needs the RocksDB store."""
    package = "org.apache.spark.sql.execution.streaming.state"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", f"{package}.RocksDBStateStoreProvider")


def gated_batches(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    gate: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> DataStreamWriter:
    """Score each micro-batch and judge it: scores under ``path/scores``, checks under ``path/checks``.

    Both are written under the batch number, so a retry replaces them. A batch without rows has none.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"{path}/scores/batch={batch_id}"
        score(batch).write.mode("overwrite").parquet(place)
        scored = spark.read.parquet(place)
        if not scored.isEmpty():
            gate(scored).write.mode("overwrite").parquet(f"{path}/checks/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
