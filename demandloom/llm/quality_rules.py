"""Quality rules with thresholds that each language and source sets for itself.

DataFrame functions only. Every document gets whole-number features. Per (language, source) each
feature is summed up in a mergeable quantile sketch: counts per log-linear bin, exact below 64 and
within 1/32 of the value above, added up by partial aggregation in any order. Upper fences
``Q3 + reach * max(Q3 - Q1, slack)`` from a group's sketch replace fixed cutoffs. Groups with few
documents take the merged sketch of their language, and small languages the merged sketch of all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm.store import SPACE, lookup, written

#: Features with a fence: name, and the least spread (in the feature's unit) that a group may have.
FENCED = {"symbol_rate": 10, "dup_line_rate": 150, "repeat_rate": 100, "word_length": 60, "upper_rate": 60}
#: Fences lie this many spreads above the third quartile.
REACH = 3
#: The counts that the contract names.
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: A group with fewer documents uses the sketch of its language, or of all documents.
LEAST = 50


def features(docs: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """The base counts and fenced rates of each ``text``, beside a struct ``row`` of ``carry``.

    ``carry`` are the columns to keep (default: all), whatever their names.

    Null and blank texts have no words: all counts are 0 and so are the rates. Repeated windows
    are found by sorting window hashes with their places packed into the low bits: two windows
    are taken as equal if 64 bits less the bits of a place agree.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    names = docs.columns if carry is None else carry
    joined = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        F.struct("lang", "source").alias("key"),
        text.alias("t"),
        F.trim(F.regexp_replace(text, SPACE, " ")).alias("j"),
    )
    words = joined.select(
        "row",
        "key",
        "t",
        F.length(F.replace("j", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        F.when(F.col("j") == "", F.array().cast("array<string>"))
        .otherwise(F.split("j", " "))
        .alias("w"),
    )
    hashed = words.select(
        "row",
        "key",
        "t",
        "word_chars",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.bin(F.size("w").cast("long"))).alias("bits"),
        F.expr("transform(w, x -> xxhash64(x))").alias("h"),
    )
    windows = hashed.select(
        "row",
        "key",
        "t",
        "word_chars",
        "n_words",
        "bits",
        F.expr("arrays_zip(h, slice(h, 2, size(h)), slice(h, 3, size(h)))").alias("z"),
    )
    placed = windows.select(
        "row",
        "key",
        "t",
        "word_chars",
        "n_words",
        "bits",
        F.when(
            F.col("n_words") >= 4,
            F.expr(
                "sort_array(slice(transform(z, (x, i) -> shiftleft(xxhash64(x), bits) | i), 1,"
                " cast(n_words as int) - 2))"
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("p"),
    )
    twice = placed.select(
        "row",
        "key",
        "t",
        "word_chars",
        "n_words",
        F.expr(
            "transform(filter(p, (x, i) -> shiftright(x, bits) = shiftright(get(p, i + 1), bits)"
            " or shiftright(x, bits) = shiftright(get(p, i - 1), bits)),"
            " x -> x & (shiftleft(1L, bits) - 1))"
        ).alias("s"),
    )
    covered = F.expr(
        "array_union(array_union(s, transform(s, x -> x + 1)), transform(s, x -> x + 2))"
    )
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = twice.select(
        "row",
        "key",
        "n_words",
        "word_chars",
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))).cast("long").alias("upper"),
        lines.alias("lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
    )
    sized = counted.select(
        "row",
        "key",
        "n_words",
        "word_chars",
        "n_symbols",
        "upper",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )

    def rate(part: str, whole: str, scale: int = 1000) -> Column:
        return F.when(F.col(whole) > 0, F.floor(scale * F.col(part) / F.col(whole))).otherwise(0).cast("long")

    return sized.select(
        "row",
        "key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (
            (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
        ).alias("base_failed"),
        rate("n_symbols", "word_chars").alias("symbol_rate"),
        rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"),
        rate("word_chars", "n_words", 100).alias("word_length"),
        rate("upper", "word_chars").alias("upper_rate"),
    )


def sketch_bin(value: str) -> str:
    """SQL for the lower edge of a value's bin: exact below 64, then 32 bins per power of two."""
    shift = f"greatest(0, length(bin({value})) - 6)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketches(rows: DataFrame) -> DataFrame:
    """``lang, source, feature, bin, n``: one mergeable sketch per group and feature."""
    cells = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.expr(sketch_bin(f)).alias("bin")) for f in FENCED]
    )
    return (
        rows.select("key.lang", "key.source", F.explode(cells).alias("c"))
        .groupBy("lang", "source", "c.feature", "c.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """First and third quartile and size of the sketches merged up to ``keys``."""
    merged = sketch.groupBy(*keys, "feature", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "feature")
    ranked = merged.select(
        *keys,
        "feature",
        "bin",
        F.sum("n").over(group.orderBy("bin")).alias("upto"),
        F.sum("n").over(group).alias("total"),
    )

    def at(quarter: int) -> Column:
        # Smallest bin whose running count reaches ceil(quarter / 4 of the group).
        return F.min(F.when(4 * F.col("upto") >= quarter * F.col("total"), F.col("bin")))

    return ranked.groupBy(*keys, "feature").agg(
        at(1).alias("q1"), at(3).alias("q3"), F.max("total").alias("total")
    )


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the fence of every feature, in a struct ``fence``.

    The three levels are a few rows per group; joins between them meet one row per key.
    """
    levels = [quartiles(sketch, keys) for keys in (["lang", "source"], ["lang"], [])]
    own, lang, all_ = (
        level.withColumnsRenamed({"q1": f"q1_{i}", "q3": f"q3_{i}", "total": f"total_{i}"})
        for i, level in enumerate(levels)
    )
    lang = lang.withColumnsRenamed({"lang": "lang_1"})
    both = own.join(
        lang.withColumnRenamed("feature", "feature_1"),
        (F.col("feature") == F.col("feature_1")) & F.col("lang").eqNullSafe(F.col("lang_1")),
    ).join(all_, "feature")

    def pick(name: str) -> Column:
        return (
            F.when(F.col("total_0") >= LEAST, F.col(f"{name}_0"))
            .when(F.col("total_1") >= LEAST, F.col(f"{name}_1"))
            .otherwise(F.col(f"{name}_2"))
        )

    slack = F.create_map(*[F.lit(x) for pair in FENCED.items() for x in pair])
    spread = F.greatest(pick("q3") - pick("q1"), slack[F.col("feature")])
    limit = both.select("lang", "source", "feature", (pick("q3") + REACH * spread).alias("limit"))
    wide = limit.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("feature") == f, F.col("limit"))).alias(f) for f in FENCED]
    )
    return wide.select(F.struct("lang", "source").alias("key"), F.struct(*FENCED).alias("fence"))


def judged(docs: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """``row``, the base counts, ``base_failed`` and ``kept`` for every document.

    ``docs`` needs ``text, lang, source``; ``row`` holds the columns ``carry`` (default: all).
    Null languages and sources are groups of their own. An empty table gives no rows.
    Features are computed once and written; fences are joined to them on the group, whose table
    is broadcast when its counted rows allow, else dealt over salts.
    """
    rows = written(features(docs, carry), "quality-features")
    table = written(fences(sketches(rows)), "quality-fences")
    met = lookup(rows, table, "key")
    within = F.lit(True)
    for f in FENCED:
        within = within & (F.col(f) <= F.col(f"fence.{f}"))
    return met.select("row", *BASE, "base_failed", (~F.col("base_failed") & within).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns unchanged."""
    return judged(docs).where("kept").select("row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return judged(docs, ["doc_id"]).select("row.doc_id", *BASE, "base_failed", "kept")
