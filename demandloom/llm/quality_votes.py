"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a bag of hashed byte trigrams, taken once from its lower-case bytes and once from its
shape (letters, capitals, digits and words that repeat the one before as classes, all else as it is).
Weighted by log counts and
inverse document frequency and projected on the first singular vectors of a labelled sample, it is a
short vector. Its exact cosines with all labelled vectors come from one matrix product per block of
documents; the nearest neighbours vote with their labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import tokens
from demandloom.llm.language import remainder

#: Hashed features: half for bytes, half for shapes.
FEATURES = 2048
DIMENSIONS = 64
NEIGHBOURS = 25
#: Similarities count by this power.
SHARPNESS = 8
#: Labelled documents that vote, about, for each label; chosen by hash from all labelled rows.
SAMPLE_DOCS = 1500
CUTOFF = 0.3
#: Documents in a block of products.
BLOCK = 256

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = _SHAPE[128:] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")


def _hashed(raw: np.ndarray, seed: int) -> np.ndarray:
    value = raw.astype(np.uint32)
    three = (value[2:] | value[1:-1] << np.uint32(8) | value[:-2] << np.uint32(16)) + np.uint32(seed)
    return (three * np.uint32(2654435761)) >> np.uint32(32 - (FEATURES // 2).bit_length() + 1)


def counts(texts: pa.Array) -> np.ndarray:
    """A row of feature counts per text; null and empty texts have none.

    Each text is followed by two line ends, so that no trigram lies across two texts.
    """
    flat = pc.binary_join_element_wise(pc.fill_null(texts, ""), "\n\n", "")
    sizes = np.asarray(pc.binary_length(flat), dtype=np.int64)
    raw = np.frombuffer(flat.cast(pa.large_binary()).buffers()[2], np.uint8)
    raw = raw[_first(flat) :][: int(sizes.sum())] if len(raw) else raw
    owner = np.repeat(np.arange(len(sizes)), sizes)[:-2] * FEATURES
    lower = np.asarray(raw).copy()
    lower[(raw >= 65) & (raw <= 90)] += 32
    # The last two bytes of each text start trigrams that reach into the next one.
    own = np.ones(len(raw), bool)
    ends = np.cumsum(sizes)
    own[ends - 1] = own[ends - 2] = False
    own = own[:-2]
    shape = _SHAPE[raw]
    shape[_repeats(flat, raw)] = ord("R")
    cells = [owner[own] + _hashed(lower, 1)[own], owner[own] + FEATURES // 2 + _hashed(shape, 2)[own]]
    return sum(np.bincount(c, minlength=len(sizes) * FEATURES) for c in cells).reshape(-1, FEATURES)


def _repeats(flat: pa.Array, raw: np.ndarray) -> np.ndarray:
    """True for the bytes of words that equal the word before them in their text, whatever the case."""
    codes, offsets, _ = tokens.split_words(pc.ascii_lower(flat))
    same = np.zeros(len(codes), bool)
    same[1:] = codes[1:] == codes[:-1]
    same[offsets[:-1][offsets[:-1] < len(codes)]] = False
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    sizes = np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)
    out = np.zeros(len(raw), bool)
    out[inside] = np.repeat(same, sizes)
    return out


def _first(flat: pa.Array) -> int:
    offsets = np.frombuffer(flat.buffers()[1], np.int32)
    return int(offsets[flat.offset])


@dataclass
class Voters:
    """What is broadcast: the projection, the labelled vectors and their labels; sizes are fixed."""

    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def vector(self, table: np.ndarray) -> np.ndarray:
        out = (np.log1p(table) * self.weight).astype(np.float32)
        out = out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9) @ self.axes
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def score(self, table: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest neighbours; without any likeness, among all voters."""
        near = min(NEIGHBOURS, len(self.labels))
        cosine = self.vector(table) @ self.vectors.T
        best = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
        say = np.maximum(np.take_along_axis(cosine, best, axis=1), 0.0).astype(float) ** SHARPNESS
        total = say.sum(axis=1)
        share = (say * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-30)
        return np.clip(np.where(total > 1e-12, share, self.labels.mean()), 0.0, 1.0)


def fit(labelled: DataFrame, docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Voters | None:
    """Voters from rows ``doc_id, quality`` and the texts of these documents.

    About ``sample_docs`` documents of each label are chosen by hash, so the join side that is
    broadcast, the vectors that are gathered and the singular vectors are bounded by parameters.
    Null labels are left out; nothing to learn from gives None. Repeated labels vote repeatedly.
    """
    known = labelled.where(F.col("quality").isin(0, 1)).select("doc_id", "quality")
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    shares = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_docs / n))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) / 1e6
    sample = F.broadcast(known.where(place < shares[F.col("quality")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                rows = [r.tobytes() for r in counts(part.column(2)).astype(np.float32)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(rows, pa.binary())], names=["doc_id", "quality", "c"]
                )

    found = (
        docs.select("doc_id", "text")
        .join(sample, "doc_id")
        .select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text")
        .mapInArrow(run, "doc_id long, quality int, c binary")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    )
    if not found.num_rows:
        return None
    table = np.frombuffer(b"".join(found.column("c").to_pylist()), np.float32).reshape(-1, FEATURES)
    labels = np.asarray(found.column("quality"), dtype=float)
    weight = np.log((1 + len(table)) / (1 + (table > 0).sum(axis=0))) + 0.1
    plain = np.log1p(table) * weight
    plain /= np.maximum(np.linalg.norm(plain, axis=1, keepdims=True), 1e-9)
    _, axes = np.linalg.eigh(plain.T @ plain)
    model = Voters(weight.astype(np.float32), axes[:, ::-1][:, :DIMENSIONS].astype(np.float32), None, labels)
    model.vectors = model.vector(table)
    return model


def score_documents(docs: DataFrame, voters: Voters | None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; only the text decides.

    Null and empty texts resemble nothing and get the share of label 1 among the voters; without
    voters every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for begin, texts in tokens.text_slices(batch.column(2), 1_000_000):
                for first in range(begin, begin + len(texts), BLOCK):
                    part = batch.slice(first, min(BLOCK, begin + len(texts) - first))
                    if model is None:
                        score = np.zeros(part.num_rows)
                    else:
                        table = counts(part.column(2))
                        table[np.asarray(pc.fill_null(pc.equal(pc.binary_length(part.column(2)), 0), True))] = 0
                        score = model.score(table)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(score), pa.array((score >= CUTOFF).astype(np.int32))],
                        names=["doc_id", "held_out", "score", "predicted"],
                    )

    held = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learned = labels.where(remainder(F.col("doc_id"), 5) != 0)
    return score_documents(docs, fit(learned, docs))
