"""Audits of stored files: unreadable parquet, missing artifacts."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below a directory, listed by Spark without reading their content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", pattern).load(path).select("path", "length")


def _open_error(path: str, deep: bool) -> str | None:
    import pyarrow.parquet as pq
    from pyarrow import fs

    # Spark writes local paths as file:/x, Arrow reads them as file:///x.
    uri = re.sub(r"^file:/(?!/)", "file:///", path)
    try:
        system, name = fs.FileSystem.from_uri(uri)
        with system.open_input_file(name) as handle:
            file = pq.ParquetFile(handle)
            if deep:
                for group in range(file.num_row_groups):
                    file.read_row_group(group)
        return None
    except Exception as exc:
        return f"{type(exc).__name__}: {exc}"


def audit_files(listing: DataFrame, deep: bool = False) -> DataFrame:
    """Add ``status`` (valid, corrupted) and ``error`` to a listing with ``path``.

    Files are opened inside tasks. The footer is checked; ``deep`` also reads every row group,
    one at a time.
    """

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = batch["path"].map(lambda p: _open_error(p, deep))
            status = errors.isna().map({True: "valid", False: "corrupted"})
            yield pd.DataFrame({"path": batch["path"], "status": status, "error": errors})

    return listing.select("path").mapInPandas(probe, "path string, status string, error string")


def audit_counts(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "valid").alias("valid_count"),
        F.count_if(F.col("status") == "corrupted").alias("corrupted_count"),
    )


def missing_artifacts(
    listing: DataFrame, expected: Sequence[str], path: str = "path"
) -> DataFrame:
    """Expected path fragments that occur in no listed path.

    Each listed path is tested against the short expectation list in place; only the distinct
    hits are shuffled.
    """
    spark = listing.sparkSession
    wanted = spark.createDataFrame([(e,) for e in expected], "artifact string")
    fragments = F.array(*[F.lit(e) for e in expected])
    found = listing.select(
        F.explode(F.filter(fragments, lambda e: F.contains(F.col(path), e))).alias("artifact")
    ).distinct()
    return wanted.join(found, "artifact", "left_anti")


def artifact_summary(listing: DataFrame, expected: Sequence[str], path: str = "path") -> DataFrame:
    """Listed files, missing artifacts, and whether the listing is complete."""
    missing = missing_artifacts(listing, expected, path).agg(
        F.sort_array(F.collect_list("artifact")).alias("missing")
    )
    counted = listing.agg(F.count(F.lit(1)).alias("n_files")).withColumn("missing", missing.scalar())
    return counted.withColumn(
        "success", (F.col("n_files") > 0) & (F.size("missing") == 0)
    )
