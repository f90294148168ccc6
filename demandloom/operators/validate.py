"""Data validation: schema, contracts, profiles, duplicates, outliers, gaps, drift."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.config import TableContract
from demandloom.functions.calendar import wall_seconds
from demandloom.operators.quantiles import quartile_bounds
from demandloom.plans.tables import finite, scalar_stats, whole_series

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind in NUMERIC or kind.startswith("decimal")]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns a table lacks; a schema question, answered without reading rows."""
    return sorted(set(required) - set(df.columns))


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Cast the declared columns; what cannot be cast becomes null."""
    present = [c for c in contract.types if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast(contract.types[c]) for c in present})


def schema_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per problem: ``column, rule, violations``.

    ``required`` for an absent column, ``type`` for values that do not convert.
    """
    present = [c for c in contract.types if c in df.columns]
    counts = {
        c: F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(contract.types[c]).isNull())
        for c in present
    }
    absent = [
        F.struct(F.lit(c).alias("column"), F.lit("required").alias("rule"), F.lit(1).alias("n"))
        for c in missing_columns(df, contract.required)
    ]
    typed = [
        F.struct(F.lit(c).alias("column"), F.lit("type").alias("rule"), F.col(f"__{c}").alias("n"))
        for c in present
    ]
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *[v.alias(f"__{c}") for c, v in counts.items()])
    listed = one.select(
        F.inline(F.array(*[s.cast("struct<column:string,rule:string,violations:bigint>")
                           for s in [*absent, *typed]]))
    )
    return listed.where("violations > 0")


def range_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """Values outside the declared ranges: ``column, rule, bound, extreme, violations``."""
    rules = []
    for column, (low, high) in contract.ranges.items():
        if column not in df.columns:
            continue
        value = F.col(column).cast("double")
        if low is not None:
            rules.append((column, "minimum", low, F.min(value), F.count_if(value < low)))
        if high is not None:
            rules.append((column, "maximum", high, F.max(value), F.count_if(value > high)))
    one = df.agg(
        *[extreme.alias(f"__e{i}") for i, (*_, extreme, _n) in enumerate(rules)],
        *[count.alias(f"__n{i}") for i, (*_, count) in enumerate(rules)],
    )
    structs = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(rule).alias("rule"),
            F.lit(float(bound)).alias("bound"),
            F.col(f"__e{i}").alias("extreme"),
            F.col(f"__n{i}").alias("violations"),
        )
        for i, (column, rule, bound, *_) in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*structs))).where("violations > 0")


def file_checks(
    sales: DataFrame,
    required: Sequence[str] = ("date", "store_id", "product_id", "quantity_sold", "revenue"),
    by: Column | None = None,
    listing: DataFrame | None = None,
) -> DataFrame:
    """Rows and sign problems per source file, or per any other ``by`` expression.

    With a ``listing`` (column ``path``), listed files without a row count 0 of everything.
    """
    source = by if by is not None else F.col("_metadata.file_path")
    absent = missing_columns(sales, required)
    grouped = sales.groupBy(source.alias("source")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.count_if(F.col(c) < 0).alias(f"negative_{c}")
            for c in ("quantity_sold", "revenue")
            if c in sales.columns
        ],
    )
    if listing is not None:
        counts = [c for c in grouped.columns if c != "source"]
        listed = listing.select(F.col("path").alias("source")).join(grouped, "source", "left")
        grouped = listed.na.fill(0, counts)
    return grouped.withColumn("missing_columns", F.lit(",".join(absent)))


def empty_files(listing: DataFrame, checked: DataFrame) -> DataFrame:
    """Listed files that contributed no row."""
    return listing.join(checked.select(F.col("source").alias("path")), "path", "left_anti")


def column_counts(df: DataFrame) -> DataFrame:
    """Rows, nulls and distinct values per column: counted per (column, value) first."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).unpivot(
        [], list(df.columns), "column", "value"
    )
    per_value = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("unique_values"),
    )


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of several columns in one pass, as rows."""
    parts = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.groupBy(*by).agg(
        *[
            fn(F.col(c).cast("double")).alias(f"__{c}__{p}")
            for c in columns
            for p, fn in parts.items()
        ]
    )
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"__{c}__{p}").alias(p) for p in parts])
        for c in columns
    ]
    return wide.select(*by, F.inline(F.array(*structs)))


def iqr_outliers(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Outliers beyond the interquartile fences, per column."""
    long = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .where(finite(F.col("value")))
    )
    bounds = quartile_bounds(long, "value", ["column"], reach, few_keys=True)
    # One row per named column: the statistics are bounded by the width of the table.
    tagged = long.join(F.broadcast(bounds), "column")
    out = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    return tagged.groupBy("column", "q1", "q3", "lower_bound", "upper_bound").agg(
        F.count_if(out).alias("n_outliers"),
        (F.count_if(out) / F.count(F.lit(1)) * 100).alias("pct_outliers"),
        F.min(F.when(out, F.col("value"))).alias("min_outlier"),
        F.max(F.when(out, F.col("value"))).alias("max_outlier"),
    )


def zscore_outliers(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Number of values more than ``limit`` sample deviations from the mean, per column."""
    stats = scalar_stats(
        df,
        **{f"m_{c}": F.avg(c) for c in columns},
        **{f"s_{c}": F.stddev_samp(c) for c in columns},
    )
    tagged = df.select(*columns, stats.alias("__s"))
    far = {
        c: F.abs(F.try_divide(F.col(c) - F.col(f"__s.m_{c}"), F.col(f"__s.s_{c}"))) > limit
        for c in columns
    }
    wide = tagged.agg(*[F.count_if(v).alias(c) for c, v in far.items()])
    return wide.unpivot([], list(columns), "column", "n_outliers")


def column_profile(df: DataFrame) -> DataFrame:
    """Null share, distinct count, moments and outlier count of every column."""
    numeric = numeric_columns(df)
    counts = column_counts(df).withColumn(
        "null_percentage", F.col("null_count") / F.col("n_rows") * 100
    )
    out = counts.join(moments(df, numeric), "column", "left")
    outliers = iqr_outliers(df, numeric).select("column", F.col("n_outliers").alias("outliers"))
    return out.join(outliers, "column", "left")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows and of surplus copies; equal rows are merged before the shuffle."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return copies.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def date_range(df: DataFrame, date: str = "date") -> DataFrame:
    ends = df.agg(F.min(date).alias("start"), F.max(date).alias("end"))
    return ends.withColumn("days", F.datediff("end", "start"))


def date_gaps(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Every hole of more than one day in a series: ``keys, gap_start, gap_end, gap_days``.

    Dates are made distinct per series first, so the window is bounded by the calendar.
    """
    days = df.select(*keys, F.to_date(date).alias(date)).where(F.col(date).isNotNull()).distinct()
    before = F.lag(date).over(whole_series(keys, date))
    return (
        days.withColumn("gap_start", before)
        .withColumn("gap_days", F.datediff(date, "gap_start"))
        .where("gap_days > 1")
        .select(*keys, "gap_start", F.col(date).alias("gap_end"), "gap_days")
    )


def gap_summary(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    return date_gaps(df, keys, date).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("gap_count"), F.max("gap_days").alias("max_gap_days")
    )


def calendar_gaps(
    df: DataFrame, time: str = "date", step: str = "1 day", keys: Sequence[str] = ()
) -> DataFrame:
    """Expected times of each ``keys`` between its first and last observation that never occur."""
    seen = df.select(*keys, time).where(F.col(time).isNotNull()).distinct()
    ends = seen.groupBy(*keys).agg(F.min(time).alias("__a"), F.max(time).alias("__b"))
    steps = F.sequence("__a", "__b", F.expr(f"interval {step}"))
    spine = ends.select(*keys, F.explode(steps).alias(time))
    return spine.join(seen, [*keys, time], "left_anti")


def duplicate_times(df: DataFrame, time: str = "date", entity: Sequence[str] = ()) -> DataFrame:
    """Surplus rows per (time, entity); null keys count as equal."""
    cells = df.groupBy(time, *entity).agg(F.count(F.lit(1)).alias("__n"))
    return cells.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_timestamps"))


def mean_drift(
    training: DataFrame, current: DataFrame, columns: Sequence[str], reach: float = 3.0
) -> DataFrame:
    """Columns whose mean moved by more than ``reach`` training deviations."""
    old = moments(training, columns).select(
        "column", F.col("mean").alias("train_mean"), F.col("std").alias("train_std")
    )
    new = moments(current, columns).select("column", F.col("mean").alias("new_mean"))
    shift = F.abs(F.col("new_mean") - F.col("train_mean"))
    return old.join(new, "column").withColumn(
        "drifted", (shift > reach * F.col("train_std")).cast("int")
    )


def drift_alerts(statistics: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Kolmogorov-Smirnov statistics above the monitoring threshold are flagged."""
    return statistics.withColumn("drifted", (F.col("ks") > threshold).cast("int"))


def interval_seconds(
    df: DataFrame, time: str = "timestamp", keys: Sequence[str] = ()
) -> DataFrame:
    """Median distance of successive timestamps of each ``keys``, in whole seconds.

    Keys with fewer than two timestamps have no row.

    Repeated timestamps have distance 0; they are counted, not listed, before the distances
    are taken between the distinct ones inside hash-partitioned days and across their borders.
    """
    seen = (
        df.where(F.col(time).isNotNull())
        .groupBy(*keys, F.col(time).alias("__t"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__day", F.struct(*keys, F.to_date("__t").alias("__date")))
    )
    ends = seen.groupBy("__day").agg(F.max("__t").alias("__end"))
    series = [F.col(f"__day.{k}") for k in keys] or [F.lit(0)]
    previous = F.lag("__end").over(whole_series(series, "__day.__date"))
    borders = ends.withColumn("__previous", previous).drop("__end")
    inside = F.lag("__t").over(whole_series(["__day"], "__t"))
    linked = seen.withColumn("__before", inside).join(borders, "__day")
    step = wall_seconds(F.col("__t")) - wall_seconds(F.coalesce("__before", "__previous"))
    steps = linked.select(
        *keys,
        F.explode(
            F.array(
                F.struct(step.alias("delta"), F.lit(1).cast("long").alias("n")),
                F.struct(F.lit(0).cast("long").alias("delta"), (F.col("__n") - 1).alias("n")),
            )
        ).alias("s")
    ).select(*keys, "s.*")
    weighted = steps.where("delta is not null and n > 0").groupBy(*keys, "delta").agg(F.sum("n").alias("n"))
    # Distinct distances are few (a day has 86,400 seconds); the weighted median is exact.
    return weighted.groupBy(*keys).agg(
        F.percentile("delta", F.lit(0.5), F.col("n")).cast("long").alias("interval_seconds")
    )


def validation_report(
    df: DataFrame, contract: TableContract, keys: Sequence[str], date: str = "date"
) -> DataFrame:
    """Every finding as one row ``section, subject, measure, value``."""

    def rows(section: str, table: DataFrame, subject: Column, measures: Sequence[str]) -> DataFrame:
        pairs = [
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
            for m in measures
        ]
        return table.select(
            F.lit(section).alias("section"), subject.cast("string").alias("subject"),
            F.inline(F.array(*pairs)),
        )

    rule = F.concat_ws(":", "column", "rule")
    profile = ["null_count", "unique_values", "mean", "std", "min", "max", "outliers"]
    parts = [
        rows("schema", schema_violations(df, contract), rule, ["violations"]),
        rows("range", range_violations(df, contract), rule, ["violations", "extreme"]),
        rows("profile", column_profile(df), F.col("column"), profile),
        rows("duplicates", duplicate_rows(df), F.lit("table"), ["n_rows", "duplicate_rows"]),
        rows("dates", date_range(df, date), F.lit(date), ["days"]),
        rows("gaps", gap_summary(df, keys, date), F.concat_ws(",", *keys), ["gap_count", "max_gap_days"]),
    ]
    return reduce(DataFrame.unionByName, parts).where("value is not null")


