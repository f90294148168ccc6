"""Time-series features of a panel: lags, rolling statistics, fills, encodings.

All lag and rolling columns of a call share one window, so they cost one shuffle, one sort
and one window operator. Columns are row-based: a lag of 7 is seven rows back, which is
seven days only where the calendar has no gaps.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import FeatureConfig
from demandloom.functions import calendar
from demandloom.plans.tables import (
    blocked,
    range_slices,
    scalar_stats,
    whole_series,
)

DEFAULTS = FeatureConfig()


# Statistics by the aggregate that computes them; the median is taken from a list.
AGGREGATES = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def series_names(
    target: str, lags: Sequence[int], windows: Sequence[int], stats: Sequence[str]
) -> list[str]:
    rolling = [f"{target}_rolling_{w}_{s}" for w in windows for s in stats]
    return [f"{target}_lag_{k}" for k in lags] + rolling


def with_series_columns(
    df: DataFrame,
    target: str,
    lags: Sequence[int],
    windows: Sequence[int],
    stats: Sequence[str],
    window,
    shift: int = 0,
    counts: bool = False,
) -> DataFrame:
    """Add lag and rolling columns over one window; ``shift=1`` leaves the current row out.

    Medians of all window lengths sort heads of one list of the latest values per row, which
    is several times faster than an aggregate per length. ``counts`` keeps the number of
    values in each window as ``__n_{w}``.
    """

    def frame(w: int):
        return window.rowsBetween(-(w - 1) - shift, -shift)

    medians = "median" in stats and bool(windows)
    columns = {f"{target}_lag_{k}": F.lag(target, k).over(window) for k in lags}
    for w in windows:
        for stat in stats:
            if stat != "median":
                columns[f"{target}_rolling_{w}_{stat}"] = AGGREGATES[stat](target).over(frame(w))
    if medians or counts:
        columns |= {f"__n_{w}": F.count(target).over(frame(w)).cast("int") for w in windows}
    if medians:
        columns["__recent"] = F.collect_list(target).over(frame(max(windows)))
    out = df.withColumns(columns)
    if medians:
        latest_first = F.reverse("__recent")
        heads = {w: F.sort_array(F.slice(latest_first, F.lit(1), F.col(f"__n_{w}"))) for w in windows}
        out = out.withColumns({f"__head_{w}": head for w, head in heads.items()})
        for w in windows:
            n = F.col(f"__n_{w}")
            low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
            middle = F.get(f"__head_{w}", low) + F.get(f"__head_{w}", high)
            out = out.withColumn(f"{target}_rolling_{w}_median", middle / 2)
    kept = [f"__n_{w}" for w in windows] if counts else []
    return out.select(*df.columns, *series_names(target, lags, windows, stats), *kept)


def lag_features(
    df: DataFrame,
    target: str = "sales",
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    lags: Sequence[int] = DEFAULTS.lags,
) -> DataFrame:
    return with_series_columns(df, target, lags, (), (), whole_series(keys, date))


def rolling_features(
    df: DataFrame,
    target: str = "sales",
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    windows: Sequence[int] = DEFAULTS.windows,
    stats: Sequence[str] = DEFAULTS.stats,
    shift: int = 0,
) -> DataFrame:
    return with_series_columns(df, target, (), windows, stats, whole_series(keys, date), shift)


def blocked_features(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    date: str,
    ties: Sequence[str],
    config: FeatureConfig = DEFAULTS,
    block_rows: int = 100_000,
) -> DataFrame:
    """Lag and rolling columns for rows below the (keys, date) grain.

    There a single key may hold a large share of the table, so the series are cut into
    overlapping blocks. ``ties`` orders the rows of one date.
    """

    def build(rows: DataFrame, window) -> DataFrame:
        return with_series_columns(
            rows, target, config.lags, config.windows, config.stats, window
        )

    lookback = max([*config.lags, *(w - 1 for w in config.windows)])
    return blocked(df, keys, date, ties, lookback, build, block_rows)


def rolling_full_window(
    df: DataFrame,
    target: str = "sales",
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    config: FeatureConfig = DEFAULTS,
) -> DataFrame:
    """Lag and rolling columns of a forecast request.

    A rolling value counts only once its window is full. Before that a deviation is 0 and
    everything else is the mean of the series.
    """
    window = whole_series(keys, date)
    out = with_series_columns(
        df, target, config.lags, config.windows, config.stats, window, counts=True
    ).withColumn("__mean", F.avg(target).over(Window.partitionBy(*keys)))
    filled = {f"{target}_lag_{k}": F.coalesce(f"{target}_lag_{k}", "__mean") for k in config.lags}
    for w in config.windows:
        for stat in config.stats:
            name = f"{target}_rolling_{w}_{stat}"
            full = F.when(F.col(f"__n_{w}") == w, F.col(name))
            filled[name] = F.coalesce(full, F.lit(0.0) if stat == "std" else F.col("__mean"))
    return out.withColumns(filled).drop("__mean", *[f"__n_{w}" for w in config.windows])


def date_features(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(calendar.date_parts(F.col(date)))


def cyclical_features(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(calendar.cyclical(F.col(date)))


def interaction_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a_b`` text of every pair of categorical columns; null where either part is."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return df.withColumns(
        {
            f"{a}_{b}_interaction": F.concat(
                F.col(a).cast("string"), F.lit("_"), F.col(b).cast("string")
            )
            for a, b in pairs
        }
    )


def trend_features(
    df: DataFrame,
    target: str = "sales",
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    ratio_windows: Sequence[int] = DEFAULTS.ratio_windows,
) -> DataFrame:
    """Trend index, first and second difference, ratio to the rolling mean, per series."""
    window = whole_series(keys, date)
    index = F.row_number().over(window) - 1
    back = [F.lag(target, k).over(window) for k in (1, 2)]
    out = {
        "trend": index,
        "trend_squared": index * index,
        f"{target}_velocity": F.col(target) - back[0],
        f"{target}_acceleration": (F.col(target) - back[0]) - (back[0] - back[1]),
    }
    for w in ratio_windows:
        mean = F.avg(target).over(window.rowsBetween(-(w - 1), 0))
        out[f"{target}_ratio_to_{w}d"] = F.try_divide(F.col(target), mean + 1)
    return df.withColumns(out)


def month_position_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Month and quarter position; also promotion on a weekend where both flags exist."""
    out = df.withColumns(calendar.month_position(F.col(date)))
    if {"has_promotion", "is_weekend"} <= set(out.columns):
        out = out.withColumn("promotion_weekend", F.col("has_promotion") * F.col("is_weekend"))
    return out


def ewm_features(
    df: DataFrame,
    target: str = "sales",
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    spans: Sequence[int] = DEFAULTS.ewm_spans,
    block: int | None = None,
) -> DataFrame:
    """Exponentially weighted mean per series, ``y[t] = (1 - w) y[t-1] + w x[t]``, ``y`` starting at the first value.

    ``w`` is ``a = 2 / (span + 1)`` after a value in the row before. After ``g - 1`` nulls the past has
    decayed ``g`` times: ``w = a / ((1 - a)^g + a)``. A null repeats the mean so far; before the first
    value there is none. The recurrence is solved in closed form inside blocks of rows, as a running sum
    of ``w x`` over the running product of ``1 - w``, and the block ends are chained by the same
    recurrence over the few blocks of a series. Every step keeps the partitioning by series.
    """
    if min(spans) < 2:
        raise ValueError("spans must be >= 2")
    names = {s: f"{target}_ewm_{s}" for s in spans}
    decay = {s: 1.0 - 2.0 / (s + 1.0) for s in spans}
    # Long blocks keep the chain short, but the fastest decay must not overflow inside one.
    block = block or int(300.0 / max(-math.log(d) for d in decay.values()))
    series = whole_series(keys, date)
    placed = df.withColumn("__t", F.row_number().over(series) - 1)
    placed = placed.withColumn("__block", F.floor(F.col("__t") / block))
    inside = Window.partitionBy(*keys, "__block").orderBy("__t")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    earlier = series.rowsBetween(Window.unboundedPreceding, -1)
    present = F.col(target).isNotNull()
    last = F.max(F.when(present, F.col("__t"))).over(earlier)
    placed = placed.withColumn("__gap", F.when(present, F.col("__t") - last))

    def kept(d: float) -> Column:
        # Share of the past that stays; 1 where nothing is added or nothing was before.
        past = F.pow(F.lit(d), F.col("__gap"))
        return F.coalesce(past / (past + F.lit(1.0 - d)), F.lit(1.0))

    def gained(s: int) -> Column:
        share = F.when(F.col("__gap").isNull(), F.lit(1.0)).otherwise(1.0 - F.col(f"__kept_{s}"))
        return F.coalesce(share * F.col(target), F.lit(0.0))

    def ends(s: int) -> Column:
        last_row = F.col("__t") % block == block - 1
        return F.collect_list(F.when(last_row, F.struct(f"__local_{s}", f"__product_{s}")))

    def carry(s: int) -> Column:
        return F.aggregate(
            ends(s).over(earlier),
            F.lit(0.0),
            lambda acc, end: acc * F.exp(end[f"__product_{s}"]) + end[f"__local_{s}"],
        )

    out = placed.withColumns({f"__kept_{s}": kept(d) for s, d in decay.items()})
    # A product this small forgets the past altogether; the bound keeps its inverse finite.
    logs = {s: F.log(F.greatest(F.col(f"__kept_{s}"), F.lit(1e-130))) for s in spans}
    out = out.withColumns({f"__product_{s}": F.sum(logs[s]).over(running) for s in spans})
    out = out.withColumns(
        {
            f"__local_{s}": F.sum(gained(s) * F.exp(-F.col(f"__product_{s}"))).over(running)
            * F.exp(F.col(f"__product_{s}"))
            for s in spans
        }
    )
    out = out.withColumns({f"__carry_{s}": carry(s) for s in spans})
    out = out.withColumn("__any", F.count(target).over(series))
    out = out.withColumns(
        {
            names[s]: F.when(
                F.col("__any") > 0,
                F.col(f"__local_{s}") + F.col(f"__carry_{s}") * F.exp(F.col(f"__product_{s}")),
            )
            for s in spans
        }
    )
    return out.select(*df.columns, *names.values())


def fill_series(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
) -> DataFrame:
    """Forward fill, then backward fill, within each series.

    What a forward fill leaves open is the head of a series, so the backward fill is the first
    value of the whole series; no frame that shrinks row by row is needed.
    """
    window = whole_series(keys, date)
    past = window.rowsBetween(Window.unboundedPreceding, 0)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns(
        {c: F.coalesce(F.last(c, True).over(past), F.first(c, True).over(whole)) for c in columns}
    )


def fill_panel(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
) -> DataFrame:
    """Forward then backward fill over the panel sorted by (keys, date).

    A value may cross from one series to the next, as in a fill of the whole sorted table.
    Rows are only ordered inside their series. What crosses a border is carried over a table
    with one row per series, in range slices, and from slice to slice over one row per slice.
    """
    window = whole_series(["__series"], date)
    past = window.rowsBetween(Window.unboundedPreceding, 0)
    forward = df.withColumn("__series", F.struct(*keys)).withColumns(
        {f"__fwd_{c}": F.last(c, ignorenulls=True).over(past) for c in columns}
    )
    dated = {c: F.when(F.col(c).isNotNull(), F.col(date)) for c in columns}
    edges = df.groupBy(*keys).agg(
        *[F.max_by(c, dated[c]).alias(f"__last_{c}") for c in columns],
        *[F.min_by(c, dated[c]).alias(f"__first_{c}") for c in columns],
    )
    sliced = range_slices(edges, keys)

    def before(table: DataFrame, window, prefix: str) -> DataFrame:
        frame = window.rowsBetween(Window.unboundedPreceding, -1)
        return table.withColumns(
            {f"{prefix}{c}": F.last(f"__last_{c}", True).over(frame) for c in columns}
        )

    def ranked(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col("__rank"))

    near = before(sliced, Window.partitionBy("__slice").orderBy("__rank"), "__near_")
    slices = sliced.groupBy("__slice").agg(
        *[F.max_by(f"__last_{c}", ranked(f"__last_{c}")).alias(f"__last_{c}") for c in columns]
    )
    far = before(slices, Window.orderBy("__slice"), "__far_").drop(*[f"__last_{c}" for c in columns])
    # Only rows ahead of the first value of the whole table are left to the backward fill.
    head = scalar_stats(
        sliced, **{c: F.min_by(f"__first_{c}", ranked(f"__first_{c}")) for c in columns}
    )
    carried = near.join(far, "__slice").select(
        F.struct(*keys).alias("__series"),
        *[F.coalesce(f"__near_{c}", f"__far_{c}").alias(f"__in_{c}") for c in columns],
    )
    joined = forward.join(carried, "__series").withColumn("__head", head)
    filled = {c: F.coalesce(f"__fwd_{c}", f"__in_{c}", f"__head.{c}") for c in columns}
    return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns])


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the column mean; an all-null column stays null."""
    means = scalar_stats(df, **{c: F.avg(c) for c in columns})
    tagged = df.withColumn("__means", means)
    return tagged.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"__means.{c}")) for c in columns}
    ).drop("__means")


def fill_missing(
    df: DataFrame,
    ordered: Sequence[str],
    others: Sequence[str],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    scope: str = "group",
) -> DataFrame:
    """Fill lag and rolling columns along the series, the other numeric ones by their mean."""
    fill = {"group": fill_series, "panel": fill_panel}[scope]
    out = fill(df, ordered, keys, date) if ordered else df
    return fill_mean(out, others) if others else out


def target_encoding(
    df: DataFrame,
    columns: Sequence[str],
    target: str = "sales",
    smoothing: float = 1.0,
) -> DataFrame:
    """Smoothed mean of the target per category; an unknown category gets the overall mean.

    Category sizes count every row, category means only the rows with a target.
    """
    overall = scalar_stats(df, mean=F.avg(target))
    out = df.withColumn("__overall", overall)
    for column in columns:
        encoded = f"{column}_target_encoded"
        stats = (
            df.where(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.count(F.lit(1)).alias("__n"), F.avg(target).alias("__mean"))
        )
        value = (F.col("__n") * F.col("__mean") + smoothing * F.col("__overall.mean")) / (
            F.col("__n") + smoothing
        )
        out = (
            out.join(stats, column, "left")
            .withColumn(encoded, F.coalesce(value, F.col("__overall.mean")))
            .drop("__n", "__mean")
        )
    return out.select(*df.columns, *[f"{c}_target_encoded" for c in columns])


def all_features(
    df: DataFrame,
    target: str = "sales",
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    categorical: Sequence[str] = (),
    config: FeatureConfig = DEFAULTS,
    scope: str = "group",
) -> DataFrame:
    """The training features of a panel at (keys, date) grain, with nulls filled."""
    # Calendar columns come before the windows: in one projection with the fills they would
    # make a generated method too large for the JIT compiler.
    dated = df.withColumns({**calendar.date_parts(F.col(date)), **calendar.cyclical(F.col(date))})
    out = with_series_columns(
        dated, target, config.lags, config.windows, config.stats, whole_series(keys, date)
    )
    if len(categorical) > 1:
        out = interaction_features(out, categorical)
    kinds = ("int", "bigint", "double", "float", "smallint", "tinyint")
    others = [c for c, kind in df.dtypes if kind in kinds and c not in keys]
    ordered = series_names(target, config.lags, config.windows, config.stats)
    return fill_missing(out, ordered, others, keys, date, scope)
