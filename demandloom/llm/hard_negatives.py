"""Hard negatives of anchors by angular triangle filtering and exact integer scores.

Every vector is stored with its angles to a few reference directions and its norm, in blocks of rows
of one label that lie near each other; a block has the window of angles and of norms that its rows
span. For an anchor, the triangle inequality on angles turns its own angles and a block's windows
into an interval of cosines, and the norms turn that into bounds of the score, widened by more than
floating point can lose. A block whose bounds miss what the anchor still needs is not scored; all
other blocks are, by products of whole numbers that no rounding can change.

Anchors meet rows in two passes, the first over rows of their label for the positives, the second
over the others within the score windows that the positives set. In both, slabs of anchors meet
groups of blocks, so a task holds a bounded part of each side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm import tokens
from demandloom.llm.store import written

POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 50, 95

#: Reference directions, and the rows they are chosen from, at most.
REFERENCES = 24
SAMPLE_ROWS = 4096
#: Rows of a block, of a group of blocks, and anchors of a slab.
BLOCK_ROWS = 256
GROUP_ROWS = 65_536
SLAB_ROWS = 32_768
#: Angles and cosines are trusted to this much.
SLACK = 1e-6
#: Scores are held within this bound, beyond which 64 bits end.
LIMIT = 1 << 62


def angles(vectors: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles to unit ``references``, and norms; zero vectors stand at right angles to all."""
    large = np.abs(vectors).max(axis=1, initial=0)
    scale = np.where(large > 0, large, 1.0)
    unit = vectors / scale[:, None]
    length = np.linalg.norm(unit, axis=1)
    unit /= np.where(length > 0, length, 1.0)[:, None]
    return np.arccos(np.clip(unit @ references.T, -1.0, 1.0)), length * scale


def choose_references(vectors: np.ndarray, many: int = REFERENCES, rounds: int = 6) -> np.ndarray:
    """Directions of clusters of a sample: the row farthest from those chosen, again and again, then means."""
    length = np.linalg.norm(vectors, axis=1)
    unit = vectors[length > 0] / length[length > 0][:, None]
    if not len(unit):
        return np.eye(1, vectors.shape[1] or 1)
    chosen = [unit[0]]
    nearest = unit @ chosen[0]
    while len(chosen) < many and nearest.min() < 1 - 1e-9:
        chosen.append(unit[nearest.argmin()])
        nearest = np.maximum(nearest, unit @ chosen[-1])
    centres = np.array(chosen)
    for _ in range(rounds):
        cell = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, unit)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where((size > 1e-9)[:, None], sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def exact_products(left: np.ndarray, right: np.ndarray, largest: float) -> np.ndarray:
    """Inner products of whole numbers as int64; ``largest`` bounds the product of the norms.

    Partial sums stay below that bound, so single or double precision is exact under 2**24 or 2**53;
    beyond, Python's whole numbers are used, and results are held within ``LIMIT``.
    """
    if largest < 1 << 24:
        return (left.astype(np.float32) @ right.astype(np.float32).T).astype(np.int64)
    if largest < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    product = whole(left) @ whole(right).T
    return np.vectorize(lambda x: max(-LIMIT, min(LIMIT, x)), otypes=[np.int64])(product)


def score_bounds(
    anchor_angles: np.ndarray, anchor_norms: np.ndarray, low: np.ndarray, high: np.ndarray, norms: tuple[float, float]
) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each anchor with any row of a block.

    ``low`` and ``high``: the block's window of angles to each reference; ``norms``: its least and largest norm.
    """
    apart = np.maximum(anchor_angles - high, low - anchor_angles).max(axis=1)
    across = np.minimum(anchor_angles + high, 2 * np.pi - anchor_angles - low).min(axis=1)
    most = np.cos(np.clip(apart - SLACK, 0.0, np.pi)) + SLACK
    least = np.cos(np.clip(across + SLACK, 0.0, np.pi)) - SLACK
    small, large = norms
    top = anchor_norms * most * np.where(most > 0, large, small)
    bottom = anchor_norms * least * np.where(least > 0, small, large)
    return bottom - SLACK * anchor_norms * large - 1, top + SLACK * anchor_norms * large + 1


class Best:
    """The first ``many`` rows of each list: higher scores first, then smaller ids, nulls last."""

    def __init__(self, lists: int, many: int):
        self.many = many
        self.owner = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.row = np.zeros((0, 2), np.int64)
        #: The score that a new row must reach.
        self.need = np.full(lists, -LIMIT - 1, np.int64)

    def add(self, owner: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        """``row``: two numbers by which equal scores are ordered."""
        if not len(owner):
            return
        owner, score = np.concatenate([self.owner, owner]), np.concatenate([self.score, score])
        row = np.concatenate([self.row, row])
        order = np.lexsort((row[:, 1], row[:, 0], -score, owner))
        owner, score, row = owner[order], score[order], row[order]
        first = np.searchsorted(owner, owner)
        place = np.arange(len(owner)) - first
        kept = place < self.many
        self.owner, self.score, self.row = owner[kept], score[kept], row[kept]
        last = kept & (place == self.many - 1)
        self.need[owner[last]] = score[last]


_VECTORS = "row long, id long, label long, cell int, angle float, vector binary"
_BLOCKS = (
    "part int, label long, many int, kind string, width int, rows binary, ids binary, named binary, vectors binary,"
    " angles binary, norms binary, low binary, high binary, targets array<array<bigint>>"
)


def whole_vectors(table: DataFrame, references: np.ndarray, width: int) -> DataFrame:
    """``row, id, label, cell, angle, vector``: whole numbers, and the nearest reference with the angle to it.

    Shorter vectors end in zeros. ``row`` tells repeated ids apart once the result is written.
    """
    shared = table.sparkSession.sparkContext.broadcast(references)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = np.asarray(lists.value_lengths(), np.int64)
            flat = np.asarray(lists.flatten(), np.float64)
            vectors = np.zeros((len(sizes), width))
            vectors[np.arange(width) < sizes[:, None]] = np.floor(flat * 256)
            seen, _ = angles(vectors, shared.value)
            cell = seen.argmin(axis=1)
            near = seen[np.arange(len(cell)), cell] if len(cell) else np.zeros(0)
            kind = np.float32 if np.abs(vectors).max(initial=0) < 1 << 24 else np.float64
            raw = [v.tobytes() for v in vectors.astype(kind)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(cell, pa.int32()), pa.array(near, pa.float32()), pa.array(raw, pa.binary())],
                names=["row", "id", "label", "cell", "angle", "vector"],
            )

    return table.select("row", "id", "label", "vector").mapInArrow(run, _VECTORS)


def blocks(vectors: DataFrame, references: np.ndarray, width: int, parts: int) -> DataFrame:
    """Blocks of near rows of one label, cut from ``parts`` slices of the order of label, cell and angle.

    A label with most of the rows takes most of the slices; equal vectors are told apart by ``row``.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(references)

    def block(part: int, table: pa.Table) -> dict:
        raw = table.column("vector").to_pylist()
        many = len(raw)
        kind = "f4" if all(len(r) == 4 * width for r in raw) else "f8"
        whole = np.array([np.frombuffer(r, np.float32 if len(r) == 4 * width else np.float64) for r in raw], kind)
        seen, norms = angles(whole.reshape(many, width).astype(np.float64), shared.value)
        ids = table.column("id")
        return {
            "part": part,
            "label": table.column("label")[0].as_py(),
            "many": many,
            "kind": kind,
            "width": width,
            "rows": np.asarray(table.column("row"), np.int64).tobytes(),
            "ids": np.asarray(ids.fill_null(0), np.int64).tobytes(),
            "named": np.asarray(ids.is_valid(), np.uint8).tobytes(),
            "vectors": whole.tobytes(),
            "angles": seen.tobytes(),
            "norms": norms.tobytes(),
            "low": seen.min(axis=0).tobytes(),
            "high": seen.max(axis=0).tobytes(),
            "targets": table.column("targets").to_pylist(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        part = 0
        for batch in batches:
            part = batch.column("part")[0].as_py()
            held.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(held)
            label = np.asarray(table.column("label"))
            starts = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), len(label)]
            cuts = [(c, min(c + BLOCK_ROWS, b)) for a, b in zip(starts, starts[1:]) for c in range(a, b, BLOCK_ROWS)]
            # The last block may go on in the next batch.
            found = [block(part, table.slice(a, b - a)) for a, b in cuts[:-1]]
            held = [table.slice(cuts[-1][0])]
            if found:
                yield pa.RecordBatch.from_pylist(found, _BLOCK_SCHEMA)
        if held and held[0].num_rows:
            yield pa.RecordBatch.from_pylist([block(part, held[0])], _BLOCK_SCHEMA)

    keys = ["label", "cell", "angle", "row"]
    dealt = vectors.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return dealt.withColumn("part", F.spark_partition_id()).mapInArrow(run, _BLOCKS)


_BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()), ("label", pa.int64()), ("many", pa.int32()), ("kind", pa.string()), ("width", pa.int32()),
        ("rows", pa.binary()), ("ids", pa.binary()), ("named", pa.binary()), ("vectors", pa.binary()),
        ("angles", pa.binary()), ("norms", pa.binary()), ("low", pa.binary()), ("high", pa.binary()),
        ("targets", pa.list_(pa.list_(pa.int64()))),
    ]
)


class Unpacked:
    """A block's row as arrays; angles and targets are there for anchors only."""

    def __init__(self, row: dict):
        many = row["many"]
        self.label, self.targets = row["label"], row.get("targets")
        self.rows = np.frombuffer(row["rows"], np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.named = np.frombuffer(row["named"], np.uint8)
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(many, row["width"])
        self.angles = np.frombuffer(row["angles"]).reshape(many, -1) if "angles" in row else None
        self.norms = np.frombuffer(row["norms"], np.float64)
        self.low, self.high = np.frombuffer(row["low"]), np.frombuffer(row["high"])

    def bounds(self, block: Unpacked) -> tuple[np.ndarray, np.ndarray]:
        return score_bounds(self.angles, self.norms, block.low, block.high, (block.norms.min(), block.norms.max()))

    def scores(self, block: Unpacked, some: np.ndarray) -> np.ndarray:
        """Scores of the anchors at ``some`` with the rows of the block."""
        largest = float(self.norms[some].max() * block.norms.max()) * (1 + SLACK) + 1
        return exact_products(self.vectors[some], block.vectors, largest)

    def order(self, at: np.ndarray) -> np.ndarray:
        """What orders equal scores: ids, null ones last."""
        return np.stack([1 - self.named[at].astype(np.int64), self.ids[at]], axis=1)


def nearest_first(anchors: Unpacked, others: list[Unpacked]) -> list[tuple[Unpacked, np.ndarray, np.ndarray]]:
    """Blocks with their bounds, those first that may have the highest scores: what is needed rises early."""
    found = [(b, *anchors.bounds(b)) for b in others]
    return sorted(found, key=lambda f: -float(f[2].mean()))


def best_positives(anchors: Unpacked, others: list[Unpacked], many: int) -> Best:
    """The first rows of the anchors' label, the anchors themselves left out."""
    best = Best(len(anchors.rows), many)
    for block, _, top in nearest_first(anchors, [b for b in others if b.label == anchors.label]):
        some = np.flatnonzero(top >= best.need)
        if not len(some):
            continue
        score = anchors.scores(block, some)
        apart = anchors.rows[some][:, None] != block.rows[None]
        if score.shape[1] > many:
            # The anchor itself may be among the first, so one more is looked at.
            cut = np.partition(score, -many - 1, axis=1)[:, -many - 1]
            need = np.maximum(best.need[some], cut)
        else:
            need = best.need[some]
        at, row = np.nonzero(apart & (score >= need[:, None]))
        best.add(some[at], score[at, row], block.order(row))
    return best


def best_negatives(anchors: Unpacked, others: list[Unpacked], many: int) -> tuple[Best, np.ndarray, np.ndarray]:
    """The first rows of other labels in each window, with the anchor and the positive score of each list.

    A list is an anchor and one of the different scores of its positives (``targets``).
    """
    pairs = [(a, s) for a, scores in enumerate(anchors.targets) for s in scores]
    owner = np.array([a for a, _ in pairs], np.int64)
    target = np.array([s for _, s in pairs], np.int64)
    floor = np.array([-((-LOWEST * s) // 100) for _, s in pairs], np.int64)
    ceiling = np.array([HIGHEST * s // 100 for _, s in pairs], np.int64)
    best = Best(len(pairs), many)
    for block, bottom, top in nearest_first(anchors, [b for b in others if b.label != anchors.label]):
        need = np.maximum(floor, best.need)
        lists = np.flatnonzero((top[owner] >= need) & (bottom[owner] <= ceiling) & (need <= ceiling))
        if not len(lists):
            continue
        some, first, size = np.unique(owner[lists], return_index=True, return_counts=True)
        score = anchors.scores(block, some)
        least, most = np.minimum.reduceat(need[lists], first), np.maximum.reduceat(ceiling[lists], first)
        at, row = np.nonzero((score >= least[:, None]) & (score <= most[:, None]))
        # Each hit goes to all lists of its anchor, and stays in those whose window it is in.
        to = lists[tokens.ragged(first[at], size[at])]
        row, value = np.repeat(row, size[at]), np.repeat(score[at, row], size[at])
        inside = (value >= need[to]) & (value <= ceiling[to])
        best.add(to[inside], value[inside], block.order(row[inside]))
    return best, owner, target


_PAIRS = "anchor long, target long, other_id long, score long"
_PAIR_SCHEMA = pa.schema([("anchor", pa.int64()), ("target", pa.int64()), ("other_id", pa.int64()), ("score", pa.int64())])


def meet(anchors: DataFrame, others: DataFrame, slabs: int, negatives: bool, many: int) -> DataFrame:
    """``anchor, target, other_id, score``: what each group of blocks has to offer to each slab of anchors.

    ``anchors`` say in ``to`` which groups they go to.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        others = [Unpacked(r) for r in right.to_pylist()]
        found = [_PAIR_SCHEMA.empty_table()]
        for row in (row for batch in left.to_batches(max_chunksize=4) for row in batch.to_pylist()):
            block = Unpacked(row)
            if negatives:
                best, owner, target = best_negatives(block, others, many)
                anchor, target = block.rows[owner[best.owner]], target[best.owner]
            else:
                best = best_positives(block, others, many)
                anchor, target = block.rows[best.owner], np.zeros(len(best.owner), np.int64)
            ids = pa.array(best.row[:, 1], pa.int64(), mask=best.row[:, 0] > 0)
            found.append(pa.table([pa.array(anchor, pa.int64()), pa.array(target, pa.int64()), ids, pa.array(best.score)], schema=_PAIR_SCHEMA))
        return pa.concat_tables(found)

    slab = F.pmod(F.xxhash64("rows"), F.lit(slabs)).cast("int")
    sent = anchors.withColumn("slab", slab).groupBy("to", "slab")
    met = others.drop("angles", "targets").withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))))
    return sent.cogroup(met.groupBy("part", "slab")).applyInArrow(run, _PAIRS)


def first_ones(pairs: DataFrame, keys: list[str], many: int) -> DataFrame:
    """The first ``many`` rows of each key, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_last())
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= many)


def mine(table: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows ``id, label, vector``.

    ``anchor`` (a condition on id) says which rows are anchors. Components count as floor(256 x).
    Rows take no part if label or vector is null or a component is null or not finite. Missing
    components of shorter vectors count as 0, so an empty vector scores 0 with all. Rows with one id
    are rows of their own: an anchor is left out of its own positives, a repeat of it is not, and
    both have results. Of equal scores smaller ids come first, null ids last. Scores beyond 62 bits
    are held at that bound. Empty tables, labels of one row and missing windows give no rows.
    """
    spark = table.sparkSession
    fine = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = table.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<double>").alias("vector"),
    ).where(F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)
    width = rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("n")).first()["n"]
    few = rows.orderBy(F.xxhash64("id"), "id", "row").limit(SAMPLE_ROWS).select("vector").toArrow().column(0).to_pylist()
    sample = np.zeros((len(few), width))
    for at, v in enumerate(few):
        sample[at, : len(v)] = np.floor(256 * np.array(v))
    references = choose_references(sample)

    vectors = written(whole_vectors(rows, references, width), "negatives-vectors")
    many = vectors.count()
    chosen = vectors.where(anchor)
    slabs = 1 + chosen.count() // SLAB_ROWS
    groups = 1 + many // min(GROUP_ROWS, max(8 * BLOCK_ROWS, many // 64))
    nothing = F.lit(None).cast("array<bigint>")
    others = written(blocks(vectors.withColumn("targets", nothing), references, width, groups), "negatives-blocks")

    # First pass: the groups that have rows of the anchor's label.
    homes = others.groupBy("label").agg(F.collect_set("part").alias("parts"))
    packed = blocks(chosen.withColumn("targets", nothing), references, width, groups)
    sent = packed.join(homes, "label").withColumn("to", F.explode("parts")).drop("parts")
    found = first_ones(meet(sent, others, slabs, False, positives), ["anchor"], positives)
    named = chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    found = found.join(named, "anchor").select(
        "anchor", "anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    found = written(found, "negatives-positives")

    # Second pass: all groups, with the scores of the positives.
    targets = found.groupBy("anchor").agg(F.array_sort(F.collect_set("positive_score")).alias("targets"))
    aimed = chosen.join(targets, F.col("row") == F.col("anchor")).drop("anchor")
    sent = blocks(aimed, references, width, groups).withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    hard = first_ones(meet(sent, others, slabs, True, negatives), ["anchor", "target"], negatives)
    hard = hard.select(
        "anchor",
        F.col("target").alias("positive_score"),
        "rank",
        F.col("other_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return found.join(hard, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return mine(rows, F.col("id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
