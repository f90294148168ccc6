"""Mixing sources to target weights by a splitting tree over exact block quotas.

DataFrame functions only. Documents of a source are dealt into blocks by hash. Whole passes over a
source are taken as they are; the part of a pass that is left becomes an exact quota of blocks,
drawn without repetition in a permuted order. A binary tree splits the quotas of all sources
together between the output shards: a node halves its tickets at random, so what each child
gets of each source is a multivariate hypergeometric draw and sums stay exact. A shard then owns a
disjoint range of each source's permuted blocks and orders its documents by a local shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm.store import lookup, written

#: Most passes over a source.
PASSES = 3
#: Blocks a source is dealt into; a source of fewer documents has a block for each.
BLOCKS = 512
#: The tree has this many levels: 2 ** LEVELS output shards.
LEVELS = 4


def draw(text: Column) -> Column:
    """A number from 0 to 2^60 - 1 from the MD5 of a text: the same in every run and engine."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, docs, target``: shares 1, 2, 3, repeating, in code point order.

    ``sizes`` has one row per source. Targets stop at ``PASSES`` sizes; what is over is dealt by
    weight again until none is above. That fixed point is a water level: with sources in order of
    size per weight, those up to some place are full and the rest share by weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weighed = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("long"))
    cap = PASSES * F.col("source_size")
    # Compare cap / weight without dividing: weights divide 6.
    level = Window.orderBy(cap * (F.lit(6) / F.col("weight")).cast("long"), F.col("source").isNull(), "source")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = weighed.select(
        "*",
        cap.alias("cap"),
        (
            F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
        ).alias("left"),
        (
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
        ).alias("share"),
    )
    # Full: its cap is at most its part of what is left by the sources before it.
    wide = {n: F.col(n).cast("decimal(19,0)") for n in ("cap", "share", "left", "weight")}
    full = wide["cap"] * wide["share"] <= wide["left"] * wide["weight"]
    first = ranked.select("*", full.alias("full")).select(
        "*",
        F.max(F.when(~F.col("full"), F.col("share"))).over(everything).alias("open_share"),
        F.max(F.when(~F.col("full"), F.col("left"))).over(everything).alias("open_left"),
    )
    part = F.col("open_left").cast("double") * F.col("weight") / F.col("open_share")
    return first.select(
        "source",
        "source_size",
        "docs",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(part).alias("target"),
    )


def plan(docs: DataFrame, carry: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with their draws, and the shard of every drawn block.

    The first table has ``row, size, source_size, target, passes, key, block``; the second
    ``key, block, shard`` for the blocks drawn beyond whole passes.
    """
    names = docs.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{n}`") for n in names])
    rows = written(docs.select(row.alias("row"), word_count(F.col("text")).alias("size")), "mix-rows")
    sizes = rows.groupBy("row.source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    targets = written(source_targets(sizes), "mix-targets")
    blocks = F.least(F.lit(BLOCKS), F.col("docs"))
    passes = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    table = targets.select(
        F.struct("source").alias("key"),
        F.struct("source_size", "target", blocks.alias("blocks"), passes.cast("long").alias("passes")).alias("plan"),
    )
    met = lookup(rows.withColumn("key", F.struct("row.source")), table, "key")
    dealt = met.select(
        "row",
        "size",
        "key",
        "plan.*",
        (draw(F.col("row.doc_id").cast("string")) % F.col("plan.blocks")).alias("block"),
    )
    weights = dealt.groupBy("key", "block", "source_size", "target", "passes").agg(
        F.sum("size").alias("words")
    )
    label = F.concat_ws("/", F.coalesce(F.col("key.source"), F.lit("\u0000")), F.col("block").cast("string"))
    permuted = Window.partitionBy("key").orderBy(draw(F.concat(F.lit("order/"), label)), "block")
    want = F.col("target") - F.col("passes") * F.col("source_size")
    run = F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, 0))
    # Blocks in permuted order up to the place nearest to what is wanted.
    drawn = written(
        weights.select(
            "key", "block", label.alias("label"), F.row_number().over(permuted).alias("place"),
            (run - F.col("words") / 2 < want).alias("in"),
        )
        .where("in")
        .select("key", "block", "label", "place"),
        "mix-drawn",
    )
    return dealt, drawn.join(shard_ranges(drawn), "key").where(
        F.col("place").between(F.col("first"), F.col("last"))
    ).select("key", "block", "shard")


def shard_ranges(drawn: DataFrame) -> DataFrame:
    """``key, shard, first, last``: the places of each source's permuted blocks that a shard owns.

    Level by level, the tickets of a node are put in random order and the first half goes left.
    Tickets are blocks, a bounded number per source. Only counts of tickets leave the tree: a
    child's quota per source. The ranges follow from them by running sums over the shards.
    """
    tickets = drawn.select("key", "label", F.lit(0).alias("node"))
    for depth in range(LEVELS):
        node = Window.partitionBy("node")
        order = node.orderBy(draw(F.concat(F.lit(f"split/{depth}/"), F.col("label"))), "label")
        right = 2 * F.row_number().over(order) > F.count(F.lit(1)).over(node) + F.col("node") % 2
        tickets = tickets.select("key", "label", (2 * F.col("node") + right.cast("int")).alias("node"))
    quotas = tickets.groupBy("key", "node").agg(F.count(F.lit(1)).alias("quota"))
    last = F.sum("quota").over(Window.partitionBy("key").orderBy("node"))
    return quotas.select(
        "key", F.col("node").alias("shard"), (last - F.col("quota") + 1).alias("first"), last.alias("last")
    )


def taken(docs: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """``row, size, source_size, target, passes, shard``; ``shard`` is null if no more is drawn.

    ``row`` holds the columns ``carry`` (default: all), ``doc_id`` and ``source`` among them.

    Null text has size 0; null sources form the last source; documents of size 0 follow their
    block. Repeated rows are documents of their own in one block. An empty table gives no rows.
    """
    dealt, shards = plan(docs, carry)
    keyed = dealt.withColumn("cell", F.struct("key", "block")).drop("key", "block")
    cells = shards.select(F.struct("key", "block").alias("cell"), "shard")
    return lookup(keyed, written(cells, "mix-shards"), "cell")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns unchanged.

    Whole passes deal a document to a shard by hash, the drawn pass by its block. Rows are spread
    over partitions by shard and shuffled inside each by hash.
    """
    rows = taken(docs)
    name = F.col("row.doc_id").cast("string")
    spread = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("passes"))),
        lambda p: F.struct((draw(F.concat(p.cast("string"), F.lit("/"), name)) % 2**LEVELS).cast("int").alias("shard"), p.alias("pass")),
    )
    whole = F.when(F.col("passes") > 0, spread).otherwise(F.slice(spread, 1, 0))
    last = F.when(
        F.col("shard").isNotNull(),
        F.array(F.struct(F.col("shard").cast("int").alias("shard"), (F.col("passes") + 1).alias("pass"))),
    ).otherwise(F.slice(spread, 1, 0))
    copies = rows.select("row", F.explode(F.concat(whole, last)).alias("c"))
    order = draw(F.concat(F.col("c.shard").cast("string"), F.lit("/"), F.col("c.pass").cast("string"), F.lit("/"), F.col("row.doc_id").cast("string")))
    return (
        copies.withColumn("__order", order)
        .repartition("c.shard", F.col("__order") % 64)
        .sortWithinPartitions("c.shard", "__order")
        .select("row.*")
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    times = F.col("passes") + F.col("shard").isNotNull().cast("long")
    return taken(docs, ["doc_id", "source"]).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM d GROUP BY source),
w AS (
  SELECT *, {PASSES} * source_size AS cap,
         (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
  FROM s
), r AS (
  SELECT *,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::HUGEINT AS "left",
         (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::HUGEINT AS share
  FROM w
  WINDOW o AS (ORDER BY cap * (6 // weight), source IS NULL, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (SELECT *, cap::HUGEINT * share <= "left" * weight AS "full" FROM r),
o AS (SELECT max(share) AS open_share, max("left") AS open_left FROM f WHERE NOT "full"),
t AS (
  SELECT source, source_size, least({BLOCKS}, docs) AS blocks,
         CASE WHEN "full" THEN cap::DOUBLE ELSE open_left::DOUBLE * weight / open_share END AS target
  FROM f, o
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t
), e AS (
  SELECT d.doc_id, d.size, p.*,
         ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 15))::BIGINT % blocks AS block
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), b AS (
  SELECT source, block, source_size, target, passes, sum(size)::BIGINT AS words,
         coalesce(source, chr(0)) || '/' || block AS label
  FROM e GROUP BY ALL
), c AS (
  SELECT *, sum(words) OVER (PARTITION BY source
              ORDER BY ('0x' || substr(md5('order/' || label), 1, 15))::BIGINT, block
              ROWS UNBOUNDED PRECEDING) AS run
  FROM b
), i AS (SELECT source, block FROM c WHERE run - words / 2 < target - passes * source_size)
SELECT e.doc_id, e.size, e.source_size, e.target,
       (e.size * (e.passes + (i.block IS NOT NULL)::BIGINT))::BIGINT AS taken
FROM e LEFT JOIN i ON e.source IS NOT DISTINCT FROM i.source AND e.block = i.block
"""
