"""Feature matrix: label encoding and standard scaling with states fitted on training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.plans.tables import global_index, scalar_stats


def label_codes(train: DataFrame, column: str) -> DataFrame:
    """Code of each distinct label: its index in sorted order. One row per label."""
    labels = (
        train.select(F.col(column).cast("string").alias(column))
        .where(F.col(column).isNotNull())
        .distinct()
    )
    return global_index(labels, [column], "code").withColumn("code", F.col("code").cast("int"))


def encode_labels(
    df: DataFrame, codes: DataFrame, column: str, unseen: str = "error"
) -> DataFrame:
    """Replace labels by their codes. An unseen label raises, or becomes 0 (``unseen="zero"``)."""
    joined = df.withColumn(column, F.col(column).cast("string")).join(codes, column, "left")
    if unseen == "zero":
        value = F.coalesce("code", F.lit(0))
    elif unseen == "error":
        message = F.concat(F.lit(f"unseen label in {column}: "), F.col(column))
        value = F.when(F.col("code").isNull() & F.col(column).isNotNull(), F.raise_error(message))
        value = value.otherwise(F.col("code")).cast("int")
    else:
        raise ValueError("unseen must be 'error' or 'zero'")
    return joined.withColumn(column, value).drop("code").select(*df.columns)


def scaler_state(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column, as rows ``column, mean, scale``.

    A constant column has scale 1, so that scaling leaves it at 0.
    """
    wide = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"m_{c}").alias("mean"),
            F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}")).alias("scale"),
        )
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def scale(df: DataFrame, state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Apply a scaler state to the named columns."""
    entry = F.map_from_entries(F.collect_list(F.struct("column", F.struct("mean", "scale"))))
    fitted = scalar_stats(state, by_column=entry)
    tagged = df.withColumn("__fitted", fitted)

    def scaled(c: str):
        known = F.element_at("__fitted.by_column", F.lit(c))
        return (F.col(c) - known["mean"]) / known["scale"]

    return tagged.withColumns({c: scaled(c) for c in columns}).drop("__fitted")


def feature_matrix(
    parts: DataFrame,
    features: Sequence[str],
    labels: Sequence[str] = (),
    unseen: str = "error",
) -> DataFrame:
    """Encode and scale every split with states fitted on the rows where ``split = 'train'``."""
    train = parts.where(F.col("split") == "train")
    out = parts
    for column in labels:
        codes = label_codes(train, column)
        out = encode_labels(out, codes, column, unseen)
    names = [*features, *[c for c in labels if c not in features]]
    state = scaler_state(out.where(F.col("split") == "train"), names)
    return scale(out, state, names)
