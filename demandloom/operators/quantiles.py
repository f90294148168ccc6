"""Exact quantiles and order statistics without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.plans.tables import finite, range_slices

# Rank error of the sketch is at most n / ACCURACY; the bracket takes twice that. Groups of up
# to SMALL_GROUP rows are ranked whole.
ACCURACY = 10_000
SLACK = 2.0 / ACCURACY
SMALL_GROUP = 10 * ACCURACY


def exact_quantiles(
    df: DataFrame,
    value: str,
    shares: Sequence[float],
    keys: Sequence[str] = (),
    few_keys: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles per group: columns ``keys``, ``share``, ``quantile``.

    A mergeable sketch brackets the wanted ranks; the rows inside the brackets, about
    ``4 / ACCURACY`` of the group, are counted per distinct value and ranked exactly. A group
    of any size is therefore aggregated on the map side and never sorted as a whole. With
    ``few_keys`` the caller vouches that the groups are bounded by the schema or the settings
    (columns, models), and their statistics are broadcast.
    """
    shares = sorted(shares)
    data = df.select(*keys, F.col(value).cast("double").alias("__v")).where(finite(F.col("__v")))
    probes = sorted({p for s in shares for p in (max(0.0, s + -1 * SLACK), min(1.0, s + 1 * SLACK))})
    sketch = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__v", probes, ACCURACY).alias("__probe"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
    )

    def bound(share: float, sign: int) -> Column:
        probe = share + sign * SLACK
        edge = F.col("__min") if sign < 0 else F.col("__max")
        if not 0.0 < probe < 1.0:
            return edge
        sketched = F.element_at("__probe", probes.index(probe) + 1)
        return F.when(F.col("__n") <= SMALL_GROUP, edge).otherwise(sketched)

    brackets = sketch.select(
        *keys,
        F.array(
            *[
                F.struct(
                    F.lit(float(s)).alias("share"),
                    bound(s, -1).alias("low"),
                    bound(s, 1).alias("high"),
                    "__n",
                )
                for s in shares
            ]
        ).alias("__b"),
    )

    def with_brackets(rows: DataFrame) -> DataFrame:
        if keys:
            return rows.join(F.broadcast(brackets) if few_keys else brackets, list(keys))
        return rows.withColumn("__b", brackets.scalar())

    tagged = with_brackets(data)
    # One pass without repeating rows: a row is counted under the number of brackets that start
    # at or below it, and keeps its value only inside a bracket.
    v = F.col("__v")
    entries = [F.get("__b", F.lit(i)) for i in range(len(shares))]
    bounds = [(entry["low"], entry["high"]) for entry in entries]
    started = sum((v >= low).cast("int") for low, _ in bounds)
    inside = reduce(lambda x, y: x | y, [v.between(low, high) for low, high in bounds])
    cells = tagged.groupBy(*keys, started.alias("__k"), F.when(inside, v).alias("__v")).agg(
        F.count(F.lit(1)).alias("__c")
    )
    hits = with_brackets(cells).select(*keys, "__k", "__v", "__c", F.posexplode("__b").alias("__i", "__w"))
    below = F.col("__k") <= F.col("__i")
    value = F.when(~below & (v >= F.col("__w.low")) & (v <= F.col("__w.high")), v)
    counts = (
        hits.select(*keys, "__w.share", "__w.__n", below.alias("__below"), value.alias("__v"), "__c")
        .where("__below OR __v IS NOT NULL")
        .groupBy(*keys, "share", "__n", "__v")
        .agg(F.sum("__c").alias("__c"))
    )
    # Rows below the bracket have a null value and sort first.
    order = Window.partitionBy(*keys, "share").orderBy(F.col("__v").asc_nulls_first())
    upto = F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rank = F.col("share") * (F.col("__n") - 1)
    ranked = counts.withColumns({"__upto": upto, "__rank": rank})

    def at(position: Column) -> Column:
        found = (F.col("__upto") > position) & (F.col("__upto") - F.col("__c") <= position)
        return F.max(F.when(found, F.col("__v")))

    low, high = F.floor("__rank"), F.ceil("__rank")
    picked = ranked.groupBy(*keys, "share").agg(
        at(low).alias("__low"), at(high).alias("__high"), F.max("__rank").alias("__rank")
    )
    fraction = F.col("__rank") - F.floor("__rank")
    missed = F.raise_error(F.lit("A rank lies outside the bracket of its sketch")).cast("double")
    found = F.col("__low").isNotNull() & F.col("__high").isNotNull()
    between = F.col("__low") + (F.col("__high") - F.col("__low")) * fraction
    return picked.select(*keys, "share", F.when(found, between).otherwise(missed).alias("quantile"))


def quartile_bounds(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    reach: float = 1.5,
    few_keys: bool = False,
) -> DataFrame:
    """Quartiles and outlier fences ``q1 - reach * iqr`` and ``q3 + reach * iqr`` per group."""
    long = exact_quantiles(df, value, (0.25, 0.5, 0.75), keys, few_keys)

    def pick(share: float) -> Column:
        return F.max(F.when(F.col("share") == share, F.col("quantile")))

    wide = long.groupBy(*keys).agg(
        pick(0.25).alias("q1"), pick(0.5).alias("median"), pick(0.75).alias("q3")
    )
    iqr = F.col("q3") - F.col("q1")
    return wide.withColumns(
        {"lower_bound": F.col("q1") - reach * iqr, "upper_bound": F.col("q3") + reach * iqr}
    )


def two_sample_ks(
    reference: DataFrame, current: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per column: ``column, ks``.

    Both samples are first counted per (column, value). The counts are cut into range slices
    and summed slice by slice, so the running totals need no global sort in one task.
    """

    def counted(df: DataFrame, side: str) -> DataFrame:
        return (
            df.select(*[F.col(c).cast("double").alias(c) for c in columns])
            .unpivot([], list(columns), "column", "value")
            .where(finite(F.col("value")))
            .select("column", "value", F.lit(side).alias("side"))
        )

    is_a = F.col("side") == "a"
    counts = (
        counted(reference, "a")
        .unionByName(counted(current, "b"))
        .groupBy("column", "value")
        .agg(F.count_if(is_a).alias("a"), F.count_if(~is_a).alias("b"))
    )
    sliced = range_slices(counts, ["column", "value"])
    totals = sliced.groupBy("column", "__slice").agg(F.sum("a").alias("sa"), F.sum("b").alias("sb"))
    slices = Window.partitionBy("column").orderBy("__slice")
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("column")
    offsets = totals.select(
        "column",
        "__slice",
        F.coalesce(F.sum("sa").over(earlier), F.lit(0)).alias("ba"),
        F.coalesce(F.sum("sb").over(earlier), F.lit(0)).alias("bb"),
        F.sum("sa").over(every).alias("na"),
        F.sum("sb").over(every).alias("nb"),
    )
    inside = (
        Window.partitionBy("column", "__slice")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = sliced.withColumns({"ra": F.sum("a").over(inside), "rb": F.sum("b").over(inside)})
    gap = F.abs(
        F.try_divide(F.col("ba") + F.col("ra"), "na")
        - F.try_divide(F.col("bb") + F.col("rb"), "nb")
    )
    return running.join(offsets, ["column", "__slice"]).groupBy("column").agg(F.max(gap).alias("ks"))


#: Bins per column of a stored sample; what is held on the driver is columns x bins edges.
BINS = 1024


def _binned(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """``column, value, bin`` of every finite value; a bin reaches from its edge up to the next one."""
    parts = []
    for column, inner in edges.items():
        rows = df.select(F.lit(column).alias("column"), F.col(column).cast("double").alias("value"))
        # Without edges there is no row to place; any one serves.
        splits = [-math.inf, *(inner or [0.0]), math.inf]
        place = Bucketizer(splits=splits, inputCol="value", outputCol="bin")
        parts.append(place.transform(rows.where(finite(F.col("value")))))
    return reduce(DataFrame.unionByName, parts).withColumn("bin", F.col("bin").cast("int"))


def _bin_counts(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    return _binned(df, edges).groupBy("column", "bin").agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("least"), F.max("value").alias("most")
    )


def reference_bins(reference: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """A sample as bins with exact counts, to be stored: ``column, bin, edge, rows, least, most``.

    Edges are approximate quantiles, one sketch per column, so bins hold about equally many rows.
    Tables over the same edges add up (sum the rows, min and max of the rest). A column without a
    finite value has one empty bin. ``edge`` is null for the first bin, which has no lower one.
    """
    shares = [i / bins for i in range(1, bins)]
    names = list(columns)
    known = reference.select(
        *[F.when(finite(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in names]
    )
    row = known.agg(
        *[F.percentile_approx(c, shares, 4 * bins).alias(c) for c in names],
        *[F.max(c).alias(f"{c} at most") for c in names],
    ).first()
    # The last bin begins above the sample, for values that it does not have.
    edges = {
        c: sorted({*row[c], math.nextafter(row[f"{c} at most"], math.inf)}) if row[c] else [] for c in names
    }
    spark = reference.sparkSession
    frame = spark.createDataFrame(
        [(c, i, e) for c in names for i, e in enumerate([None, *edges[c]])],
        "column string, bin int, edge double",
    )
    counted = frame.join(_bin_counts(reference, edges), ["column", "bin"], "left")
    return counted.withColumn("rows", F.coalesce("rows", F.lit(0)))


def _edges(stored: DataFrame) -> dict[str, list[float]]:
    """Edges by column, from a stored table of at most columns x bins rows."""
    rows = stored.select("column", "edge").collect()
    return {c: sorted(r["edge"] for r in rows if r["column"] == c and r["edge"] is not None)
            for c in sorted({r["column"] for r in rows})}


def _gaps(stored: DataFrame, current: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Per bin: both shares before and up to its end, and bounds on the gap inside it."""
    now = _bin_counts(current, edges).withColumnsRenamed({"rows": "b", "least": "b_least", "most": "b_most"})
    met = stored.withColumnRenamed("rows", "a").join(now, ["column", "bin"], "left").fillna(0, ["b"])
    every = Window.partitionBy("column")
    upto = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumns({"na": F.sum("a").over(every), "nb": F.sum("b").over(every)})
    met = met.withColumns(
        {"a_end": F.try_divide(F.sum("a").over(upto), "na"), "b_end": F.try_divide(F.sum("b").over(upto), "nb")}
    )
    met = met.withColumns(
        {"a_start": F.col("a_end") - F.try_divide("a", "na"), "b_start": F.col("b_end") - F.try_divide("b", "nb")}
    )
    # Where all rows of a bin, on both sides, have one value, its only step is its end.
    one = F.greatest("most", "b_most") == F.least("least", "b_least")
    at_end = F.abs(F.col("a_end") - F.col("b_end"))
    inside = F.greatest(F.col("a_end") - F.col("b_start"), F.col("b_end") - F.col("a_start"))
    return met.withColumns({"low": at_end, "high": F.when(one, at_end).otherwise(inside)})


def binned_drift(
    stored: DataFrame, current: DataFrame, limit: float = 0.1, reference: DataFrame | None = None
) -> DataFrame:
    """Kolmogorov-Smirnov drift of ``current`` against stored bins: ``column, ks_low, ks_high, drifted``.

    The statistic lies between ``ks_low``, the largest gap at the end of a bin, and ``ks_high``.
    Both come from counts alone, so the stored sample is not read. Where the limit lies between
    them, ``drifted`` is null, or decided exactly if ``reference`` has the rows behind ``stored``:
    only the values of bins that can pass the limit are counted then. All null for a column that
    has no finite value on one side.
    """
    edges = _edges(stored)
    gaps = _gaps(stored, current, edges)
    bounds = gaps.groupBy("column").agg(F.max("low").alias("ks_low"), F.max("high").alias("ks_high"))
    decided = F.when(F.col("ks_low") > limit, 1).when(F.col("ks_high") <= limit, 0)
    bounds = bounds.withColumn("drifted", decided)
    if reference is None:
        return bounds
    doubtful = {r["column"]: edges[r["column"]] for r in bounds.where("drifted IS NULL AND ks_high IS NOT NULL").collect()}
    if not doubtful:
        return bounds
    can_pass = gaps.where(F.col("high") > limit).select("column", "bin", "a_start", "b_start", "na", "nb")
    counts = (
        _binned(reference, doubtful)
        .withColumn("old", F.lit(1))
        .unionByName(_binned(current, doubtful).withColumn("old", F.lit(0)))
        # At most columns x bins rows.
        .join(F.broadcast(can_pass), ["column", "bin"])
        .groupBy("column", "bin", "value", "a_start", "b_start", "na", "nb")
        .agg(F.sum("old").alias("a"), F.sum(1 - F.col("old")).alias("b"))
    )
    upto = Window.partitionBy("column", "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.abs(
        F.col("a_start") + F.sum("a").over(upto) / F.col("na")
        - F.col("b_start") - F.sum("b").over(upto) / F.col("nb")
    )
    exact = counts.withColumn("gap", gap).groupBy("column").agg(F.max("gap").alias("gap"))
    passes = F.when(F.col("gap") > limit, 1).otherwise(0)
    return (
        bounds.join(F.broadcast(exact), "column", "left")
        .withColumn("drifted", F.when(F.col("gap").isNull(), F.col("drifted")).otherwise(passes))
        .drop("gap")
    )
