"""Line dedup by site-relative frequency.

A line's weight is the share of its host's pages that contain it. Lines above a boilerplate ratio
are dropped from every page of the host. Per host at most (lines per page / ratio) lines can be
above it, so the lists that travel to the pages are bounded by the length of pages, not their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.store import lookup, written


def boilerplate(pages: DataFrame, ratio: float, least: int) -> DataFrame:
    """``host (a struct), dropped`` (hashes): lines on more than ``ratio`` of a host's pages.

    ``pages`` has ``host`` and ``lines``. A page counts a line once; blank lines are none. A line
    must also be on ``least`` pages, so that small hosts do not lose every line they have.
    """
    shown = F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    lines = pages.select("host", F.explode(F.array_distinct(F.transform(shown, _key))).alias("line"))
    counts = lines.groupBy("host", "line").count().where(F.col("count") >= least)
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    return (
        counts.join(totals, "host")
        .where(F.col("count") > ratio * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("line").alias("dropped"))
    )


def _key(line: Column) -> Column:
    return F.xxhash64(line)


def without_boilerplate(
    docs: DataFrame, host: Column, lines: Column, ratio: float, least: int
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``host``, ``lines``, ``kept`` (lines that stay).

    A null host is a host of its own; null or empty text has no lines; rows that repeat count
    as pages of their own. An empty table gives no rows. Lines are compared by 64-bit hashes
    within their host. Pages are written once; the dropped lines are met by a lookup on the host.
    """
    pages = written(
        docs.select(F.struct("*").alias("row"), F.struct(host).alias("host"), lines.alias("lines")),
        "pages",
    )
    table = written(boilerplate(pages, ratio, least), "boilerplate")
    met = lookup(pages, table, "host")
    stays = F.filter("lines", lambda x: ~F.array_contains(F.col("dropped"), _key(x)))
    return met.select(
        "row",
        "host",
        "lines",
        F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(stays).alias("kept"),
    )


#: Lines with text at either end of a document that can be a header or footer.
EDGE_LINES = 2


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def edge_boilerplate(pages: DataFrame, ratio: float, least: int) -> DataFrame:
    """``tongue (a struct), edges`` (hashes): headers and footers on more than ``ratio`` of its documents.

    ``pages`` has ``tongue`` and ``lines`` (trimmed). Only the first and last ``EDGE_LINES`` lines with
    text count, so a tongue has at most ``2 * EDGE_LINES / ratio`` of them. Documents with the same
    longest line count as one: copies share it, while a header meets a new one in each document.
    """
    shown = F.filter("lines", lambda x: x != "")
    ends = F.concat(F.slice("shown", 1, EDGE_LINES), F.slice(F.reverse("shown"), 1, EDGE_LINES))
    longest = F.array_max(F.transform("shown", lambda x: F.struct(F.length(x), _key(x))))
    rows = pages.select("tongue", shown.alias("shown")).select(
        "tongue",
        longest.alias("longest"),
        F.explode(F.array_distinct(F.transform(ends, _key))).alias("line"),
    )
    counts = rows.distinct().groupBy("tongue", "line").count().where(F.col("count") >= least)
    totals = pages.groupBy("tongue").agg(F.count(F.lit(1)).alias("pages"))
    return (
        counts.join(totals, "tongue")
        .where(F.col("count") > ratio * F.col("pages"))
        .groupBy("tongue")
        .agg(F.collect_list("line").alias("edges"))
    )


def drop_lines(
    docs: DataFrame, ratio: float = 0.1, least: int = 4, edge_ratio: float = 0.01
) -> DataFrame:
    """Documents with boilerplate lines taken out of ``text``.

    A line is boilerplate of its source above ``ratio`` of the source's documents, wherever it stands,
    and of its language above ``edge_ratio`` of the language's documents (where the table has ``lang``)
    if it stands at their ends. Lines are compared trimmed. A document whose lines all stay keeps its
    text as it is; null text stays null. ``n_chars`` follows the text where the table has that column.
    """
    text = F.col("row.text")
    raw = F.split(F.coalesce(text, F.lit("")), "\n")
    groups = {"host": F.struct("source")}
    if "lang" in docs.columns:
        groups["tongue"] = F.struct("lang")
    pages = written(docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in groups.items()]), "pages")
    lines = pages.withColumn("lines", F.transform(raw, _bare)).drop("row")
    met = lookup(pages, written(boilerplate(lines, ratio, least), "boilerplate"), "host")
    drops = [F.coalesce("dropped", F.array().cast("array<bigint>"))]
    if "tongue" in groups:
        met = lookup(met, written(edge_boilerplate(lines, edge_ratio, least), "edges"), "tongue")
        drops.append(F.coalesce("edges", F.array().cast("array<bigint>")))
    gone = F.array_union(*drops) if len(drops) > 1 else drops[0]
    met = met.withColumns({"gone": gone, "raw": raw})
    kept = F.filter("raw", lambda x: (_bare(x) == "") | ~F.array_contains("gone", _key(_bare(x))))
    met = met.withColumn("kept", F.when(F.size("gone") == 0, F.col("raw")).otherwise(kept))
    new = F.when(F.size("kept") == F.size("raw"), text).otherwise(F.array_join("kept", "\n"))
    row = F.col("row").withField("text", new)
    out = met.select(row.alias("row")).select("row.*")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


#: Pages: share of a host's pages from which a line is boilerplate, and the least number of pages.
PAGE_RATIO = 0.5
PAGE_LEAST = 3


def query(spark: SparkSession, folder: str) -> DataFrame:
    """All pages; a line is a stretch of HTML between tags or line ends that is not blank."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    parts = F.split(F.coalesce("html", F.lit("")), r"<[^>]*>|\n")
    lines = F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
    met = without_boilerplate(pages, host, lines, PAGE_RATIO, PAGE_LEAST)
    return met.select(
        "row.page_id",
        F.col("host").getField("col1").alias("host"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )


ORACLE = rf"""
WITH p AS (
  SELECT page_id,
         lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) AS host,
         list_filter(list_transform(string_split_regex(coalesce(html, ''), '<[^>]*>|\n'),
                     lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM pages
), t AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
l AS (SELECT host, unnest(list_distinct(lines)) AS line FROM p),
b AS (
  SELECT host, line FROM (SELECT host, line, count(*) AS n FROM l GROUP BY host, line) JOIN t USING (host)
  WHERE n >= {PAGE_LEAST} AND n > {PAGE_RATIO} * pages
), d AS (SELECT host, list(line) AS dropped FROM b GROUP BY host),
k AS (
  SELECT page_id, p.host, lines,
         list_filter(lines, lambda x: NOT list_contains(coalesce(dropped, []), x)) AS kept
  FROM p LEFT JOIN d ON p.host = d.host
)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
       coalesce(array_to_string(kept, chr(10)), '') AS text
FROM k
"""
