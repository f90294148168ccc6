"""Shared folder of the session, written intermediate tables, and lookups on a small side."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a class for Java's and DuckDB's regular expressions.
SPACE = r"[\x20\x09-\x0D]+"

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local session without it gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="shared-")
    return _LOCAL[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a Parquet table in the shared folder.

    Cuts the lineage: what follows survives lost executors without computing ``df`` again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def present(spark: SparkSession, path: str) -> bool:
    """Whether the shared store has this folder."""
    store, where = _files(spark, path)
    return store.exists(where)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store that nothing reads any more."""
    store, where = _files(spark, path)
    store.delete(where, True)


#: Spark removes the shuffle files of a query once it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tidily_written(df: DataFrame, name: str) -> DataFrame:
    """:func:`written`, after which the shuffle files behind ``df`` are gone.

    What has been written needs them no more. Without this they stay until the driver collects its
    garbage, and the steps of a long operator add up on disk.
    """
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        spark.conf.set(_CLEANUP, before)


def lookup(
    rows: DataFrame, small: DataFrame, key: str, broadcast_rows: int = 200_000, salts: int = 64
) -> DataFrame:
    """``rows`` with the columns of ``small`` for their key; ``key`` is unique in ``small``.

    ``small`` is counted: up to ``broadcast_rows`` rows it is broadcast, which moves no row of the
    other side. Beyond, each of its rows is dealt to ``salts`` places and ``rows`` are spread over
    them, so that a key with a third of the rows is met by as many tasks.
    """
    if small.count() <= broadcast_rows:
        return rows.join(F.broadcast(small), key, "left")
    names = [c for c in rows.columns if c != key]
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in names]), F.lit(salts)).cast("int")
    dealt = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("__salt", salt).join(dealt, [key, "__salt"], "left").drop("__salt")


#: Keys with more than this share of all rows are hot; there are at most 1/share of them.
HOT_SHARE = 1 / 512


def split_lookup(rows: DataFrame, table: DataFrame, key: str, weight: str, how: str) -> DataFrame:
    """``rows`` with the columns of ``table`` for their key, ``inner`` or ``left``.

    ``key`` is unique in ``table``, whose column ``weight`` has how many of the ``rows`` it meets.
    Hot keys, whose number the share bounds, are broadcast; the rest is shuffled. Both are read
    twice, so they should be written tables or cheap.
    """
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    hot = F.broadcast(table.where(F.col(weight) > total * HOT_SHARE))
    rare = table.where(F.col(weight) <= total * HOT_SHARE)
    many = rows.join(hot, key)
    few = rows.join(hot.select(key), key, "left_anti").join(rare, key, how)
    return many.unionByName(few)
