"""A panel with its lag and rolling features, bucketed by series, to which days are appended.

The tables share their buckets: the rows and their features, sorted by series and date, and the
tail, which has one row for each series with the last rows that lags and windows reach back to. An
append reads the tail alone, so history is neither read nor shuffled: the new rows come to the
buckets of the tail, and join, features and writes all stay there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.config import FeatureConfig
from demandloom.operators.features import series_names, with_series_columns

DEFAULTS = FeatureConfig()


class FeatureStore:
    """Tables ``{name}_rows``, ``_features``, ``_refused`` and ``_tail`` under ``path``.

    The files at ``path`` are the store; a session that does not know the tables registers them
    again. Batches have names: one that is in the store is not added twice, and one that was broken
    off is replaced as a whole, since its tail is written last. ``buckets`` is fixed at the start: take
    about one per 128 MB of tail, at least one per core. A series has a bounded number of rows in a
    batch (the table is at the grain of series and date).
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        path: str,
        schema: str,
        keys: Sequence[str] = ("store_id",),
        date: str = "date",
        target: str = "sales",
        config: FeatureConfig = DEFAULTS,
        buckets: int = 8,
    ):
        self.spark, self.name, self.path = spark, name, path
        self.keys, self.date, self.target, self.config, self.buckets = list(keys), date, target, config, buckets
        given = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(schema)}
        # Rows of a series are ordered as structs: by date, then by target.
        self.columns = [date, target, *[c for c in given if c not in (date, target)]]
        self.added = series_names(target, config.lags, config.windows, config.stats)
        rows = ", ".join(f"`{c}` {given[c]}" for c in self.columns)
        fields = ", ".join(f"`{c}`: {given[c]}" for c in self.columns)
        features = ", ".join(f"`{c}` double" for c in self.added)
        self._register("rows", rows, date)
        self._register("refused", rows, date)
        self._register("features", f"{rows}, {features}", date)
        self._register("tail", f"recent array<struct<{fields}>>")

    @property
    def lookback(self) -> int:
        return max([*self.config.lags, *(w - 1 for w in self.config.windows)])

    def table(self, part: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{part}")

    def batches(self) -> list[str]:
        """Names of the batches that are in the store, in order."""
        parts = self.spark.sql(f"SHOW PARTITIONS {self.name}_tail").collect()
        return sorted(r["partition"].split("=", 1)[1] for r in parts)

    def tail(self) -> DataFrame:
        """``series, recent``: the last rows of each series, by the last batch."""
        done = self.batches()
        return self.table("tail").where(F.col("batch") == (done[-1] if done else "")).drop("batch")

    def read(self, part: str = "features") -> DataFrame:
        """The rows of all complete batches; ``refused`` has the rows that no batch could take."""
        return self.table(part).where(F.col("batch").isin(self.batches())).drop("batch", "series")

    def append(self, new: DataFrame, batch: str) -> None:
        """Add rows under a name that sorts after the names so far.

        A row is refused if it is not later than the last row of its series in the store, since it
        would change features that are already there, or if its date is null. Rows of one series and
        date in a batch are ordered by the target. Null keys are a series; an empty batch is a batch.
        """
        done = self.batches()
        if batch in done:
            return
        if done and batch < done[-1]:
            raise ValueError(f"Batch {batch!r} does not follow {done[-1]!r}")
        met = self.met(new).persist()
        self._write("refused", self._rows(met, "refused"), batch)
        self._write("rows", self._rows(met, "fresh"), batch)
        self._write("features", self.featured(met), batch)
        every = F.concat("recent", "fresh")
        last = F.slice(every, F.greatest(F.lit(1), F.size(every) - self.lookback + 1), self.lookback)
        kept = self.tail().join(met.select("series"), "series", "left_anti")
        # The tail is read and written, so this partition is added; what a broken run wrote is not committed.
        self._write("tail", met.select("series", last.alias("recent")).unionByName(kept), batch, "INTO")
        met.unpersist()

    def met(self, new: DataFrame) -> DataFrame:
        """``series, recent, fresh, refused``: a row for each series with new rows, where its bucket is."""
        series = F.to_json(F.struct(*self.keys)).alias("series")
        packed = (
            new.select(series, F.struct(*self.columns).alias("row"))
            .repartition(self.buckets, "series")
            .groupBy("series")
            .agg(F.sort_array(F.collect_list("row")).alias("given"))
        )
        nothing = F.lit([]).cast(packed.schema["given"].dataType)
        both = packed.join(self.tail(), "series", "left").withColumn("recent", F.coalesce("recent", nothing))
        both = both.withColumn("end", F.get("recent", F.size("recent") - 1)[self.date])

        def late(row: Column) -> Column:
            return row[self.date].isNull() | F.coalesce(row[self.date] <= F.col("end"), F.lit(False))

        return both.select(
            "series",
            "recent",
            F.filter("given", lambda r: ~late(r)).alias("fresh"),
            F.filter("given", late).alias("refused"),
        )

    def featured(self, met: DataFrame) -> DataFrame:
        """The fresh rows with their features, computed over them and the tail before them."""
        told = lambda part, new: F.transform(part, lambda r: F.struct(F.lit(new).alias("is_new"), r.alias("row")))
        rows = met.select("series", F.inline(F.concat(told("recent", False), told("fresh", True))))
        rows = rows.select("series", "is_new", "row.*")
        c = self.config
        window = Window.partitionBy("series").orderBy(self.date, self.target)
        return with_series_columns(rows, self.target, c.lags, c.windows, c.stats, window).where("is_new").drop("is_new")

    def forget_old_tails(self) -> None:
        """Delete the tails of all batches but the last, which is the only one that is read again.

        Their names stay as empty partitions, so that the batches still count as done.
        """
        schema = self.table("tail").drop("batch").schema
        for old in self.batches()[:-1]:
            self._write("tail", self.spark.createDataFrame([], schema), old)

    def _rows(self, met: DataFrame, part: str) -> DataFrame:
        return met.select("series", F.inline(part))

    def _register(self, part: str, columns: str, order: str | None = None) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(place)
        ordered = f"series, `{order}`" if order else "series"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name}_{part} (series string, {columns}, batch string) USING parquet"
            f" PARTITIONED BY (batch) CLUSTERED BY (series) SORTED BY ({ordered}) INTO {self.buckets} BUCKETS"
            f" LOCATION '{self.path}/{part}'"
        )
        self.spark.catalog.recoverPartitions(f"{self.name}_{part}")

    def _write(self, part: str, rows: DataFrame, batch: str, how: str = "OVERWRITE") -> None:
        columns = ", ".join(f"`{c}`" for c in self.table(part).drop("batch").columns)
        rows.createOrReplaceTempView(f"{self.name}_given")
        self.spark.sql(
            f"INSERT {how} {self.name}_{part} PARTITION (batch = '{batch}') SELECT {columns} FROM {self.name}_given"
        )
        self.spark.catalog.dropTempView(f"{self.name}_given")
