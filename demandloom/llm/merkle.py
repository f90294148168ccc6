"""A Merkle manifest of a dataset whose witnesses grow while leaves are appended.

Leaves of one tree (a language) are numbered in order and cut into aligned blocks. A task streams a
block into an ``Appender``: each leaf joins the open subtrees, and whenever two siblings are
complete, the witnesses of the leaves below each of them are extended by the root of the other.
The roots of the blocks are appended in the same way, level by level, until one node is left for
each tree; the trees' roots are appended once more to give the root of all. What a block's leaves
lack is the witness of the block itself, so it is attached once per block on the way down.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm.store import written

#: Binary levels of a block, so 1,024 nodes; a block's row holds about 400 KB.
LEVELS = 10
#: Rows of a slice of the order.
SLICE_ROWS = 200_000

#: In a witness, a step is a side and a digest: no sibling, one to the right, or one to the left.
LONE, RIGHT, LEFT = 0, 1, 2
STEP = 33

#: The fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined(*digests: bytes) -> bytes:
    """The node above: SHA-256 of the digests as hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


class Appender:
    """Leaves appended one after another, and the witnesses they have so far.

    ``stack`` has the complete subtrees that are still without a sibling: height, root, first leaf.
    A leaf's witness is complete up to the height of the subtree it is in.
    """

    def __init__(self, most: int, levels: int = LEVELS):
        self.stack: list[tuple[int, bytes, int]] = []
        self.steps = np.zeros((most, levels, STEP), np.uint8)
        self.size = 0

    def append(self, leaf: bytes) -> None:
        self.stack.append((0, leaf, self.size))
        self.size += 1
        while len(self.stack) > 1 and self.stack[-1][0] == self.stack[-2][0]:
            self._pair()

    def _pair(self) -> None:
        height, right, middle = self.stack.pop()
        _, left, first = self.stack.pop()
        self.steps[first:middle, height] = np.frombuffer(bytes([RIGHT]) + right, np.uint8)
        self.steps[middle : self.size, height] = np.frombuffer(bytes([LEFT]) + left, np.uint8)
        self.stack.append((height + 1, joined(left, right), first))

    def _lift(self) -> None:
        height, root, first = self.stack.pop()
        self.stack.append((height + 1, joined(root), first))

    def close(self, height: int = 0) -> tuple[bytes, np.ndarray]:
        """Root and witnesses when nothing follows; a node without a sibling rises alone.

        The tree is made at least ``height`` levels high: what a block needs that has others beside it.
        """
        while len(self.stack) > 1:
            while self.stack[-1][0] < self.stack[-2][0]:
                self._lift()
            self._pair()
        while self.stack[0][0] < height:
            self._lift()
        return self.stack[0][1], self.steps[: self.size, : self.stack[0][0]]


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and the steps of its witness give."""
    node = leaf
    for at in range(0, len(witness), STEP):
        side, other = witness[at], witness[at + 1 : at + STEP]
        node = joined(node, other) if side == RIGHT else joined(other, node) if side == LEFT else joined(node)
    return node


def siblings(witness: bytes) -> str:
    """Hex text of the siblings in a witness, from the leaf upwards."""
    steps = (witness[at : at + STEP] for at in range(0, len(witness), STEP))
    return "".join(s[1:].hex() for s in steps if s[0] != LONE)


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row: each field as its UTF-8 length and value, ``-`` where it is null."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (a written table) with ``place``, from 0 in each ``tree``, and the tree's size ``many``.

    Slices of the whole order are sorted where they are; a row per slice and tree gives the offsets,
    so a tree with most of the rows is spread like any other. Null is a tree of its own.
    """
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + nodes.count() // SLICE_ROWS)
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    sliced = nodes.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # The high bits of the number are the slice, the low ones count its rows.
    sliced = written(sliced.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    sliced = sliced.withColumn("slice", F.shiftright("at", 33)).withColumn("row", F.col("at").bitwiseAND((1 << 33) - 1))
    counts = sliced.groupBy("slice", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("slice").alias("of_slice"),
        F.col("tree").alias("of_tree"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("many"),
    )
    met = (F.col("slice") == F.col("of_slice")) & F.col("tree").eqNullSafe(F.col("of_tree"))
    return sliced.join(offsets, met).select(*nodes.columns, (F.col("row") + F.col("shift")).alias("place"), "many")


_BLOCKS = "tree string, block long, height int, root binary, nodes binary, steps binary, items array<long>, changed array<binary>"


def blocks(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """A row per aligned block of ``tree, place, many, node, item, changed``: its root and witnesses.

    ``height`` is the number of steps in the witnesses of the block's nodes.
    """
    wide = 1 << levels

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        appender = Appender(table.num_rows, levels)
        leaves = table.column("node").to_pylist()
        for leaf in leaves:
            appender.append(leaf)
        many, first = table.column("many")[0].as_py(), table.column("place")[0].as_py()
        root, steps = appender.close(levels if many > wide else 0)
        row = {
            "tree": table.column("tree")[0].as_py(),
            "block": first // wide,
            "height": steps.shape[1],
            "root": root,
            "nodes": b"".join(leaves),
            "steps": steps.tobytes(),
            "items": table.column("item").to_pylist(),
            "changed": table.column("changed").to_pylist(),
        }
        return pa.Table.from_pylist([row], _ARROW)

    keyed = nodes.withColumn("block", F.shiftright("place", levels))
    return keyed.groupBy("tree", "block").applyInArrow(run, _BLOCKS)


_ARROW = pa.schema(
    [
        ("tree", pa.string()), ("block", pa.int64()), ("height", pa.int32()), ("root", pa.binary()),
        ("nodes", pa.binary()), ("steps", pa.binary()), ("items", pa.list_(pa.int64())),
        ("changed", pa.list_(pa.binary())),
    ]
)


def trees(nodes: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Written tables of blocks, from the leaves upwards, and ``tree, root`` for each tree.

    Each table has 1/1,024 of the rows of the one below; the last has one block for each tree.
    """
    tables = []
    while True:
        table = written(blocks(nodes, levels), f"merkle-blocks-{len(tables)}")
        tables.append(table)
        if table.agg(F.coalesce(F.max("block"), F.lit(0)).alias("n")).first()["n"] == 0:
            return tables, table.select("tree", "root")
        nodes = table.select(
            "tree",
            F.col("block").alias("place"),
            F.count(F.lit(1)).over(Window.partitionBy("tree")).alias("many"),
            F.col("root").alias("node"),
            F.lit(None).cast("long").alias("item"),
            F.lit(None).cast("binary").alias("changed"),
        )


def _with_paths(table: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with ``path``, the witness of the block itself in all that is above it."""
    paths = paths.select(F.col("tree").alias("of_tree"), F.col("place").alias("of_block"), "path")
    return table.join(paths, (F.col("block") == F.col("of_block")) & F.col("tree").eqNullSafe(F.col("of_tree")))


def expanded(tables: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``tree, place, path`` for every node of the lowest of ``tables``, from the top down.

    ``above``: the paths of the trees' roots, as ``tree, place`` (0) and ``path``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                many, width = len(row["items"]), row["height"] * STEP
                columns = {
                    "tree": pa.array([row["tree"]] * many, pa.string()),
                    "place": pa.array((row["block"] << levels) + np.arange(many), pa.int64()),
                    "path": pa.array([row["steps"][i * width : (i + 1) * width] + row["path"] for i in range(many)], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    for table in reversed(tables):
        above = _with_paths(table, above).mapInArrow(run, "tree string, place long, path binary")
    return above


def proven(table: DataFrame, root: bytes) -> DataFrame:
    """The rows of the leaves in blocks with ``path`` and ``subroot``, each folded along its witness.

    What a block's leaves share, the steps above the block, is read once for all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                many, width = len(row["items"]), row["height"] * STEP
                above, upper = row["path"], siblings(row["path"])
                leaf = [row["nodes"][i * 32 : (i + 1) * 32] for i in range(many)]
                own = [row["steps"][i * width : (i + 1) * width] for i in range(many)]
                seen = [c or n for c, n in zip(row["changed"], leaf)]
                ends = [folded(folded(n, w), above) for n, w in zip(seen, own)]
                columns = {
                    "doc_id": pa.array(row["items"], pa.int64()),
                    "leaf": [n.hex() for n in leaf],
                    "subroot": [row["subroot"].hex()] * many,
                    "root": [root.hex()] * many,
                    "proof_sha256": [sha256((siblings(w) + upper).encode()).hexdigest() for w in own],
                    "folded_root": [e.hex() for e in ends],
                    "verified": [e == root for e in ends],
                }
                yield pa.RecordBatch.from_pydict(columns)

    return table.mapInArrow(run, _PROVEN)


_PROVEN = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A tree per ``lang``, its leaves in the order of doc_id; trees in the order of lang; nulls first in
    both. Where ``tampered`` is true, a row is checked with 1 added to n_chars (null stays null)
    against the witness of the row as it was. Equal rows have leaves of their own, side by side; rows
    of one doc_id are ordered by their digests. Any column may be null, texts may be empty or long,
    other columns play no part, and an empty table gives no rows.
    """
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    changed = F.lit(None) if tampered is None else F.when(tampered, leaf_digest(n_chars=more))
    leaves = docs.select(
        F.col("lang").cast("string").alias("tree"),
        F.col("doc_id").cast("long").alias("item"),
        leaf_digest().alias("node"),
        changed.cast("binary").alias("changed"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    leaves = numbered(written(leaves, "merkle-leaves"), ["item", "node", "row_id"]).drop("row_id")
    tables, subroots = trees(leaves, levels)

    # The roots are the leaves of one more tree, without a name.
    names = subroots.select(
        F.lit("").alias("tree"),
        F.col("tree").alias("lang"),
        F.col("root").alias("node"),
        F.lit(None).cast("long").alias("item"),
        F.lit(None).cast("binary").alias("changed"),
    )
    names = written(numbered(names, ["lang"]), "merkle-roots")
    top_tables, top = trees(names.drop("lang"), levels)
    found = top.first()
    root = bytes(found["root"]) if found else b""
    start = top.select("tree", F.lit(0).cast("long").alias("place"), F.lit(b"").alias("path"))
    above = expanded(top_tables, start, levels).select(F.col("place").alias("at"), "path")
    named = names.select(F.col("lang").alias("tree"), F.col("place").alias("at"), F.col("node").alias("subroot"))
    above = written(named.join(above, "at").withColumn("place", F.lit(0).cast("long")), "merkle-paths")

    paths = expanded(tables[1:], above.select("tree", "place", "path"), levels)
    lowest = _with_paths(tables[0], paths)
    roots = above.select(F.col("tree").alias("name"), "subroot")
    return proven(lowest.join(roots, F.col("tree").eqNullSafe(F.col("name"))), root)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


_SQL_LEAF = " || ".join(
    f"coalesce(strlen({value}) || ':' || {value}, '-')"
    for value in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST({chars} AS VARCHAR)", "text")
)

#: Trees as lists, halved level by level. CRC-32 goes bit by bit: -1 is a shift, all else a byte.
ORACLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, sha256({_SQL_LEAF.format(chars="n_chars")}) AS leaf,
    sha256({_SQL_LEAF.format(chars="(n_chars + 1)")}) AS wrong,
    xor(4294967295, list_reduce(
      flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda x: list_prepend(CAST(ascii(x) AS BIGINT), list_transform(range(0, 8), lambda i: CAST(-1 AS BIGINT))))),
      lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
      CAST(4294967295 AS BIGINT))) AS crc,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS nr
  FROM documents
), levels AS (
  SELECT lang, 0 AS l, list(leaf ORDER BY doc_id) AS h FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, l + 1,
    list_transform(range(0, (len(h) + 1) // 2), lambda i: sha256(h[2 * i + 1] || coalesce(h[2 * i + 2], '')))
  FROM levels WHERE len(h) > 1
), subroots AS (
  SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS nr FROM levels WHERE len(h) = 1
), above AS (
  SELECT 0 AS l, list(subroot ORDER BY nr) AS h FROM subroots
  UNION ALL
  SELECT l + 1,
    list_transform(range(0, (len(h) + 1) // 2), lambda i: sha256(h[2 * i + 1] || coalesce(h[2 * i + 2], '')))
  FROM above WHERE len(h) > 1
), steps AS (
  SELECT d.doc_id, v.l, (d.nr >> v.l) & 1 AS side, v.h[xor(d.nr >> v.l, 1) + 1] AS other
  FROM leaves d JOIN levels v ON d.lang IS NOT DISTINCT FROM v.lang WHERE len(v.h) > 1
  UNION ALL
  SELECT d.doc_id, 1000 + v.l, (s.nr >> v.l) & 1, v.h[xor(s.nr >> v.l, 1) + 1]
  FROM leaves d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang CROSS JOIN above v WHERE len(v.h) > 1
), proofs AS (
  SELECT doc_id, sha256(coalesce(string_agg(other, '' ORDER BY l), '')) AS proof_sha256,
    list(CASE WHEN other IS NULL THEN '-' WHEN side = 0 THEN 'R' || other ELSE 'L' || other END ORDER BY l) AS path
  FROM steps GROUP BY doc_id
), ends AS (
  SELECT d.doc_id, d.leaf, s.subroot, (SELECT h[1] FROM above WHERE len(h) = 1) AS root,
    coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
    list_reduce(coalesce(p.path, []), lambda n, x: CASE x[1] WHEN 'R' THEN sha256(n || x[2:]) WHEN 'L' THEN sha256(x[2:] || n)
      ELSE sha256(n) END, CASE WHEN d.crc % 7 = 0 THEN d.wrong ELSE d.leaf END) AS folded_root
  FROM leaves d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang LEFT JOIN proofs p ON p.doc_id = d.doc_id
)
SELECT *, folded_root = root AS verified FROM ends
"""
