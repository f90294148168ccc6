"""Exact dedup: a persistent digest index, bucketed and sorted by hash, met by a sort-merge anti-join.

DataFrame functions only. A text's digest is SHA-256 over the text with each run of white space
replaced by one space. The index is a table bucketed by digest, so a batch that arrives is
shuffled to the buckets of the index, not the index to the batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.store import SPACE, new_path, present, removed, split_lookup, written


def text_digest(text):
    """SHA-256 of the text with white space collapsed, as 32 bytes; null counts as empty."""
    normal = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")
    return F.unhex(F.sha2(normal, 256))


class DigestIndex:
    """Texts seen so far: ``digest, keep_id, copies, batch, first, buckets``, one row per text and batch.

    ``first`` marks the batch that brought the text. The files at ``path`` outlive the session: a
    later one that names the same path goes on with them, under any table name. ``buckets`` fixes
    the number of files per batch and of tasks that meet the index, and cannot change later (an
    error); take about one per 128 MB of the index it is to become. Appending is one write per batch.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = 24, path: str | None = None):
        self.spark, self.table, self.buckets, self.path = spark, table, buckets, path

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _open(self, id_type: str) -> None:
        """Register the table, with the files that are at its path already."""
        place = "" if self.path is None else f"LOCATION '{self.path}'"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {id_type}, copies BIGINT,"
            " batch STRING, first BOOLEAN, buckets INT) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS {place}"
        )
        if self.path is not None and present(self.spark, self.path):
            files = self.spark.read.schema(self.rows().schema).parquet(self.path)
            met = files.select("buckets").first()
            if met is not None and met["buckets"] != self.buckets:
                self.spark.sql(f"DROP TABLE {self.table}")
                raise ValueError(f"the index at {self.path} has {met['buckets']} buckets")

    def texts(self) -> DataFrame:
        """One row per text, without a shuffle: who stayed first, the smallest id, rows of all batches."""
        first = F.col("first")
        return self.rows().groupBy("digest").agg(
            F.max(F.when(first, F.col("keep_id"))).alias("stayed"),
            F.min("keep_id").alias("smallest"),
            F.max(F.when(first, F.col("batch"))).alias("batch"),
            F.sum("copies").alias("group_size"),
        )

    def append(self, digests: DataFrame, batch: str) -> None:
        """Take in a batch of :func:`digested` rows. A batch that is there already adds nothing.

        A merge anti-join finds the new texts; texts known from other batches are counted. Where an
        earlier attempt left only part of the batch, the rest is added.
        """
        self._open(digests.schema["doc_id"].dataType.simpleString())
        groups = _groups(digests).select("digest", F.col("least.doc_id").alias("keep_id"), "copies")
        index = self.rows()
        fresh = groups.join(index.select("digest").hint("merge"), "digest", "left_anti")
        others = (
            index.groupBy("digest")
            .agg(F.bool_or(F.col("batch") == batch).alias("taken"))
            .where("not taken")
        )
        again = groups.join(others.hint("merge"), "digest", "left_semi")
        rows = fresh.withColumn("first", F.lit(True)).unionByName(again.withColumn("first", F.lit(False)))
        rows.select(
            "digest", "keep_id", "copies", F.lit(batch).alias("batch"), "first", F.lit(self.buckets).alias("buckets")
        ).repartition(self.buckets, "digest").write.insertInto(self.table)

    def resolve(self, digests: DataFrame, batch: str | None = None) -> DataFrame:
        """One row per row: ``doc_id, keep_id, group_size, kept, digest``, by the index as it is now.

        With a ``batch``, rows of that batch stay whose text it brought first. Without, the row with
        the smallest doc_id of all batches stays.
        """
        keep, own = ("smallest", F.lit(True)) if batch is None else ("stayed", F.col("batch") == batch)
        resolved = (
            _groups(digests)
            .join(self.texts(), "digest")
            .select(
                "digest", F.col(keep).alias("keep_id"), "group_size", "copies",
                F.when(own, F.col("least.place")).alias("kept_place"),
            )
        )
        resolved = written(resolved, "resolved-digests")
        met = split_lookup(digests, resolved, "digest", "copies", "inner")
        kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("place").eqNullSafe(F.col("kept_place"))
        return met.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")

    def add(self, docs: DataFrame, batch: str) -> DataFrame:
        """Dedup a batch against the index and itself, and append its new digests.

        ``batch`` names these rows for good: the same batch again, after a failure or in another
        session, gives the same rows as kept. Of equal texts in a batch the smallest doc_id stays;
        a text that the index has is dropped in favour of the row that stayed before.
        ``group_size`` counts the rows of all batches so far. Of repeated rows (one doc_id, one
        text) one stays. An empty batch gives no rows. Null doc_ids come after others.
        """
        digests = digested(docs)
        self.append(digests, batch)
        return self.resolve(digests, batch)

    def drop(self) -> None:
        """Remove the table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        if self.path is not None:
            removed(self.spark, self.path)


def digested(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, place``, written; ``place`` tells rows with equal ids and texts apart."""
    rows = docs.select("doc_id", text_digest(F.col("text")).alias("digest"))
    return written(rows.withColumn("place", F.monotonically_increasing_id()), "digests")


def _groups(digests: DataFrame) -> DataFrame:
    """One row per text: its rows and the ``least`` of them, null doc_ids after others."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place"))
    return digests.groupBy("digest").agg(least.alias("least"), F.count(F.lit(1)).alias("copies"))


def dedup_documents(docs: DataFrame, buckets: int = 24, batches: int = 2) -> DataFrame:
    """A whole table, fed to an index of its own in ``batches`` by a hash of the doc_id.

    All but the first batch meet a filled index. As all batches are in before rows are resolved,
    the smallest doc_id stays whichever batch it came with. The index is removed at the end.
    """
    spark = docs.sparkSession
    name = f"digest_index_{uuid.uuid4().hex}"
    index = DigestIndex(spark, name, buckets, new_path(spark, name))
    digests = digested(docs)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for i in range(batches):
        index.append(digests.where(part == i), str(i))
    out = index.resolve(digests)
    index.drop()
    return out


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return dedup_documents(docs).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents
), g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.h AS text_sha256
FROM n JOIN g USING (h)
"""
