"""Small plan helpers: scalar statistics, finite values, checkpoints, positions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def finite(column: Column) -> Column:
    """True where a double is present, not NaN and not infinite."""
    inf = F.lit(float("inf"))
    return F.coalesce(column.isNotNull() & ~F.isnan(column) & (F.abs(column) < inf), F.lit(False))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "missing" in the source files; Spark aggregates need NULL for that."""
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats})


def scalar_stats(df: DataFrame, **aggregates: Column) -> Column:
    """Whole-table aggregates as one struct column.

    The aggregate is a scalar subquery, so it is one row by construction and reaches the
    rows of another table without a join.
    """
    fields = [agg.alias(name) for name, agg in aggregates.items()]
    return df.agg(F.struct(*fields).alias("stats")).scalar()


def per_group(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join per-group statistics back on null-safe keys.

    No broadcast hint: the number of groups grows with the data, so the choice is left to
    the size statistics that adaptive execution measures.
    """
    renamed = stats.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return df.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of the session.

    The folder is ``spark.checkpoint.dir``. Only a local session may do without it: a temporary
    folder of one machine would not survive the loss of an executor.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_folder(df.sparkSession))
    return df.checkpoint()


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def whole_series(keys: Sequence[str], *order: str):
    """Window over a whole series.

    For tables at the (keys, date) grain, where the series length is bounded by the
    calendar. For any other grain use :func:`blocked`.
    """
    return Window.partitionBy(*keys).orderBy(*order)


def positions(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str], name: str = "position"
) -> DataFrame:
    """0-based row number of each row in its group, ordered by (time, ties).

    Counts per (keys, time) are summed over the calendar first, so the row-level window is
    partitioned by (keys, time): a group holding a large share of all rows still spreads
    over as many tasks as it has time values. The cell is one struct column, which compares
    equal on nulls, so that counting, ranking and joining share one partitioning.
    """
    placed = df.withColumn("__cell", F.struct(*keys, time))
    counts = placed.groupBy("__cell").agg(F.count(F.lit(1)).alias("__n"))
    series = Window.partitionBy(*[f"__cell.{k}" for k in keys])
    before = series.orderBy(F.col(f"__cell.{time}").asc_nulls_first())
    offsets = counts.select(
        "__cell",
        F.coalesce(
            F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__offset"),
    )
    inside = Window.partitionBy("__cell").orderBy(*ties)
    ranked = placed.withColumn("__inside", F.row_number().over(inside) - 1)
    joined = ranked.join(offsets, "__cell")
    return joined.withColumn(name, (F.col("__offset") + F.col("__inside")).cast("long")).drop(
        "__cell", "__offset", "__inside"
    )


def blocked(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str],
    lookback: int,
    build,
    block_rows: int = 100_000,
) -> DataFrame:
    """Row-based window columns over groups of any size.

    Each group is cut into blocks of ``block_rows`` consecutive rows and every block is given
    the ``lookback`` rows before it, so that ``build(rows, window)`` sees whole frames; the
    extra rows are dropped afterwards. ``build`` adds columns over the window and may look back
    at most ``lookback`` rows. The result equals the unblocked window.
    """
    if block_rows <= lookback:
        raise ValueError("block_rows must exceed lookback")
    placed = positions(df, keys, time, ties, "__position")
    block = F.floor(F.col("__position") / block_rows)
    tail = (F.col("__position") % block_rows) >= (block_rows - lookback)
    homes = F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread = placed.withColumn("__home", block).withColumn("__block", F.explode(homes))
    window = Window.partitionBy(*keys, "__block").orderBy("__position")
    return (
        build(spread, window)
        .where(F.col("__home") == F.col("__block"))
        .drop("__home", "__block", "__position")
    )


def range_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Cut a table into consecutive range slices of ``order`` and fix them durably.

    Adds ``__slice``, ascending in ``order``, and ``__rank``, the place of a row in the whole
    order with gaps between slices. The slice borders come from a sample, so the result is
    checkpointed before anything is derived from the slice numbers.
    """
    cut = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    return durable(
        cut.sortWithinPartitions(*order).select(
            *df.columns,
            F.spark_partition_id().alias("__slice"),
            F.monotonically_increasing_id().alias("__rank"),
        )
    )


def global_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """0-based place of every row in the order of the whole table.

    Rows are numbered inside range slices; the slices' offsets come from one row per slice.
    """
    sliced = range_slices(df, order)
    sizes = sliced.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__slice", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset")
    )
    inside = F.row_number().over(Window.partitionBy("__slice").orderBy("__rank")) - 1
    numbered = sliced.withColumn("__inside", inside).join(offsets, "__slice")
    place = (F.col("__offset") + F.col("__inside")).cast("long")
    return numbered.withColumn(name, place).select(*df.columns, name)
