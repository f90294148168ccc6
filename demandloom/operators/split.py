"""Chronological splits and rolling-origin folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import CvConfig, HorizonConfig, SplitConfig
from demandloom.plans.tables import per_group, whole_series


def _by_day(df: DataFrame, days: DataFrame, date: str, how: str = "inner") -> DataFrame:
    """Attach a table with one row per day.

    For a date column that table is bounded by the calendar (a century has 36,525 days), so it
    is broadcast and the rows stay where they are. A timestamp has no such bound.
    """
    small = F.broadcast(days) if dict(df.dtypes)[date] == "date" else days
    return per_group(df, small, [date], how)


def _running_days(df: DataFrame, date: str) -> DataFrame:
    """Rows per date, rows before it and rows in all: one row per calendar day."""
    days = df.groupBy(date).agg(F.count(F.lit(1)).alias("__n"))
    order = Window.orderBy(F.col(date).asc_nulls_last())
    before = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("__n").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return days.withColumns({"__before": F.coalesce(before, F.lit(0)), "__total": total})


def _segments(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    cuts: Callable[[Column], Sequence[Column]],
    whole_days: bool = False,
) -> DataFrame:
    """Add ``__segment``: how many of the row-count cuts lie at or before a row.

    Rows are in (date, keys) order. The running count per day places every day that no cut
    crosses. For the few days that one does, the key at the cut is looked up from the key
    columns alone, and rows compare with it. The table itself is neither sorted nor shuffled.
    """
    days = _running_days(df, date)
    wanted = cuts(F.col("__total"))
    marks = {f"__cut{i}": f"__edge{i}" for i in range(len(wanted))}
    days = days.withColumns(dict(zip(marks, wanted))).drop("__total")

    def crossed(mark: str) -> Column:
        ends = F.col("__before") + F.col("__n")
        return (F.col("__before") < F.col(mark)) & (ends > F.col(mark))

    if not whole_days:
        border = days.where(reduce(lambda x, y: x | y, [crossed(m) for m in marks]))
        inside = F.row_number().over(Window.partitionBy(date).orderBy(*keys)) - 1
        ranked = _by_day(df.select(date, *keys), border, date).withColumn(
            "__position", F.col("__before") + inside
        )

        def key_at(mark: str) -> Column:
            hit = crossed(mark) & (F.col("__position") == F.col(mark))
            return F.max(F.when(hit, F.struct(*keys)))

        edges = ranked.groupBy(date).agg(*[key_at(m).alias(e) for m, e in marks.items()])
        days = _by_day(days, edges, date, "left")
    placed = _by_day(df, days, date)

    def reached(mark: str, edge: str) -> Column:
        day = F.col("__before") >= F.col(mark)
        if whole_days:
            return day
        return F.when(F.col(edge).isNotNull(), F.struct(*keys) >= F.col(edge)).otherwise(day)

    steps = [reached(m, e).cast("int") for m, e in marks.items()]
    segment = reduce(lambda x, y: x + y, steps)
    return placed.withColumn("__segment", segment).select(*df.columns, "__segment")


def chronological_split(
    df: DataFrame,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    config: SplitConfig = SplitConfig(),
    by: str = "rows",
) -> DataFrame:
    """Add ``split``: the first 70% of rows by date train, 10% validate, the rest test.

    Cut points are row counts, so a date may straddle two splits; its rows are then taken in
    key order, (date, keys) being the grain of the table. With ``by="date"`` a straddled date
    stays whole, in the earlier split.
    """

    def cuts(total: Column) -> list[Column]:
        n_train = F.floor(total * F.lit(1 - config.test_size - config.validation_size))
        return [n_train, n_train + F.floor(total * F.lit(config.validation_size))]

    names = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    out = _segments(df, keys, date, cuts, whole_days=by == "date")
    return out.withColumn("split", F.get(names, F.col("__segment"))).drop("__segment")


def panel_positions(
    df: DataFrame,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    start: Column | None = None,
) -> DataFrame:
    """0-based place of every row in the panel sorted by (date, keys), as ``position``.

    With ``start`` only places from there on are kept, and earlier days are not ranked.
    """
    days = _running_days(df, date)
    if start is not None:
        days = days.where(F.col("__before") + F.col("__n") > start)
    placed = _by_day(df, days, date)
    inside = F.row_number().over(Window.partitionBy(date).orderBy(*keys)) - 1
    out = placed.withColumn("position", F.col("__before") + inside).select(*df.columns, "position")
    return out if start is None else out.where(F.col("position") >= start)


def series_positions(
    df: DataFrame, keys: Sequence[str] = ("store_id",), date: str = "date"
) -> DataFrame:
    """0-based place of every row in its own series, as ``position``."""
    return df.withColumn("position", (F.row_number().over(whole_series(keys, date)) - 1).cast("long"))


def rolling_origin_folds(
    sizes: DataFrame, config: CvConfig | HorizonConfig, keys: Sequence[str] = ("store_id",)
) -> DataFrame:
    """Expanding-window folds per series from its size ``n``.

    Columns: ``keys, fold_id, train_end, test_start, test_end, horizon, train_size``; ends are
    exclusive. A series too short for a fold yields none; :func:`unfolded_series` names those.
    """
    horizon = config.longest if isinstance(config, HorizonConfig) else config.horizon
    kept = _train_ends(config)
    return sizes.where(F.col("n") >= 2).select(*keys, F.posexplode(kept).alias("fold_id", "train_end")).select(
        *keys,
        "fold_id",
        "train_end",
        F.col("train_end").alias("test_start"),
        (F.col("train_end") + horizon).alias("test_end"),
        F.lit(horizon).alias("horizon"),
        F.col("train_end").alias("train_size"),
    )


def unfolded_series(
    sizes: DataFrame, config: CvConfig | HorizonConfig, keys: Sequence[str] = ("store_id",)
) -> DataFrame:
    """``keys, error``: the series for which :func:`rolling_origin_folds` has no fold."""
    n = F.col("n")
    return sizes.where((n < 2) | (F.size(_train_ends(config)) == 0)).select(
        *keys, F.format_string("Too short for a fold: %d rows", n).alias("error")
    )


def _train_ends(config: CvConfig | HorizonConfig) -> Column:
    """Ends of the training rows of each fold, as an array, from the size ``n``."""
    horizon = config.longest if isinstance(config, HorizonConfig) else config.horizon
    step = config.step if config.step is not None else horizon
    splits = config.n_splits
    n = F.col("n")
    if config.min_train_size is None:
        reserved = horizon + (splits - 1) * step
        smallest = F.greatest(
            F.lit(2 * horizon).cast("long"), n - reserved, F.floor(n * F.lit(0.4))
        )
    else:
        smallest = F.lit(int(config.min_train_size)).cast("long")
    last_origin = n - horizon
    origins = F.transform(
        F.sequence(F.lit(0), F.lit(splits - 1)),
        lambda i: (last_origin - (F.lit(splits - 1) - i) * step).cast("long"),
    )
    return F.filter(origins, lambda origin: origin >= smallest)


def fold_sizes(df: DataFrame, keys: Sequence[str], target: str = "sales") -> DataFrame:
    """Rows with a target per series; a series without any has 0."""
    return df.groupBy(*keys).agg(F.count(target).alias("n"))


def fold_rows(
    positioned: DataFrame, folds: DataFrame, keys: Sequence[str], part: str = "test"
) -> DataFrame:
    """Rows of each fold of their series.

    The folds of a series travel as one short array, so a row meets them through one equi-join
    on the series and is repeated only for the folds it belongs to. Without keys the array
    comes from a scalar subquery.
    """
    bounds = [c for c in folds.columns if c not in keys]
    packed = folds.groupBy(*keys).agg(F.collect_list(F.struct(*bounds)).alias("__folds"))
    if keys:
        joined = per_group(positioned, packed, keys, "inner")
    else:
        joined = positioned.withColumn("__folds", packed.scalar())
    position = F.col("position")

    def member(fold: Column) -> Column:
        if part == "train":
            return position < fold["train_end"]
        return (position >= fold["test_start"]) & (position < fold["test_end"])

    return joined.select(*positioned.columns, F.inline(F.filter("__folds", member)))


def early_stopping_slice(
    df: DataFrame, keys: Sequence[str] = ("store_id",), date: str = "date", share: float = 0.1
) -> DataFrame:
    """Mark the last ``share`` of the rows by (date, keys) as ``is_validation``.

    Of a table too short to spare them, no row is marked.
    """

    def cuts(total: Column) -> list[Column]:
        held = F.greatest(F.lit(1).cast("long"), F.floor(total * F.lit(share)))
        return [F.when(total > held + 5, total - held).otherwise(total)]

    out = _segments(df, keys, date, cuts)
    return out.withColumn("is_validation", F.col("__segment") > 0).drop("__segment")
