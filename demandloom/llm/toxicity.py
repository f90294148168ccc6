"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found with block-max bounds.

Terms are runs of five bytes of the lower-case text with single spaces around words, so that parts
of words count as much as words. Those whose document frequency differs most between the labels of
the examples form the vocabulary; TF-IDF vectors are taken over it.

The examples stand in an inverted index, in blocks of similar ones. Each term has, next to its
postings, its largest weight in every block. A document's products with these maxima bound its
cosine with all examples of a block; blocks are opened from the highest bound down until no bound
reaches the last of the nearest found so far, which makes the neighbours exact. They vote with a
weight that falls with distance, and the vote is calibrated on the examples themselves, each of them
scored by the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import tokens
from demandloom.llm.language import remainder
from demandloom.llm.store import written

#: Bytes of a term.
GRAM = 5
#: Examples of each label, about, chosen by hash from all labelled rows.
SAMPLE_DOCS = 1500
#: Terms of the vocabulary, and the least statistic (log-likelihood ratio) and documents of a term.
TERMS = 4096
LEAST_RATIO = 15.0
LEAST_DOCS = 3
NEIGHBOURS = 15
#: Added to distances, so that an equal text does not silence all other neighbours.
SOFTEN = 0.1
BLOCK_DOCS = 32
CUTOFF = 0.5
#: Bounds are widened by more than sums of products can be off.
SLACK = 1e-9
#: Documents looked up at a time.
BATCH = 512

_WORD_BREAK = np.zeros(256, bool)
_WORD_BREAK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``owner, gram``: every run of five bytes of each text, white space collapsed, a space at both ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    # A zero byte ends each text; runs that hold one are left out, and so no run lies across two texts.
    ends = [pa.scalar(x, pa.large_string()) for x in (" ", " \0", "")]
    flat = pc.binary_join_element_wise(ends[0], pc.fill_null(texts, "").cast(pa.large_string()), *ends[1:])
    sizes = np.asarray(pc.binary_length(flat), np.int64)
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset :]
    raw = np.frombuffer(flat.buffers()[2], np.uint8)[offsets[0] : offsets[len(sizes)]] if len(sizes) else np.zeros(0, np.uint8)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    space = _WORD_BREAK[raw]
    kept = ~space
    kept[1:] |= space[1:] & ~space[:-1]
    kept[:1] = True
    raw, owner = np.where(space, 32, _LOWER[raw])[kept].astype(np.uint64), owner[kept]
    if len(raw) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    run = np.zeros(len(raw) - GRAM + 1, np.uint64)
    whole = np.ones(len(run), bool)
    for i in range(GRAM):
        part = raw[i : len(raw) - GRAM + 1 + i]
        run = run << np.uint64(8) | part
        whole &= part != 0
    return owner[: len(run)][whole], run[whole]


def counted(owner: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of owner and term, in order, and how often each occurs."""
    order = np.lexsort((term, owner))
    owner, term = owner[order], term[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])])) if len(owner) else np.zeros(0, np.int64)
    return owner[first], term[first], np.diff(np.append(first, len(owner)))


@dataclass
class Vectors:
    """Sparse rows of unit length: row ``i`` has the entries from ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def take(self, some: np.ndarray) -> Vectors:
        size = self.starts[some + 1] - self.starts[some]
        at = tokens.ragged(self.starts[some], size)
        return Vectors(np.append(0, np.cumsum(size)), self.term[at], self.weight[at])


@dataclass
class Vocabulary:
    """Chosen terms in order, and their inverse document frequencies."""

    terms: np.ndarray
    idf: np.ndarray
    _near: np.ndarray = field(init=False)

    def __post_init__(self):
        # One bit for each term's hash tells most other runs apart before the search.
        self._near = np.zeros(1 << 20, bool)
        self._near[self._hash(self.terms)] = True

    @staticmethod
    def _hash(runs: np.ndarray) -> np.ndarray:
        return (runs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def vectors(self, texts: pa.Array) -> Vectors:
        """Unit TF-IDF vectors of texts; those without a term, null and empty ones are zero."""
        owner, run = grams(texts)
        maybe = np.flatnonzero(self._near[self._hash(run)])
        owner, run = owner[maybe], run[maybe]
        at = np.minimum(np.searchsorted(self.terms, run), max(len(self.terms) - 1, 0))
        known = self.terms[at] == run if len(self.terms) else np.zeros(len(run), bool)
        return self.weighted(len(texts), *counted(owner[known], at[known]))

    def weighted(self, many: int, owner: np.ndarray, term: np.ndarray, count: np.ndarray) -> Vectors:
        weight = (1 + np.log(count)) * self.idf[term]
        length = np.sqrt(np.bincount(owner, weight**2, minlength=many))
        return Vectors(np.searchsorted(owner, np.arange(many + 1)), term, weight / length[owner])


class BlockMaxIndex:
    """Postings of the examples by term and block, and each term's largest weight in each block."""

    def __init__(self, examples: Vectors, terms: int, block: int = BLOCK_DOCS):
        self.many, self.terms, self.size = len(examples), terms, block
        self.blocks = max(1, -(-self.many // block))
        row = examples.rows()
        cell = examples.term * self.blocks + row // block
        order = np.lexsort((row, cell))
        self.row, self.weight, cell = row[order], examples.weight[order], cell[order]
        self.starts = np.searchsorted(cell, np.arange(terms * self.blocks + 1))
        self.most = np.zeros(terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(terms, self.blocks)

    def bounds(self, queries: Vectors) -> np.ndarray:
        """For each query and block, what no cosine with an example of the block exceeds."""
        out = np.zeros((len(queries), self.blocks))
        np.add.at(out, queries.rows(), queries.weight[:, None] * self.most[queries.term])
        return out

    def cosines(self, queries: Vectors, query: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Exact cosines of each pair of a query and a block with all examples of the block."""
        size = queries.starts[query + 1] - queries.starts[query]
        entry = tokens.ragged(queries.starts[query], size)
        pair = np.repeat(np.arange(len(query)), size)
        cell = queries.term[entry] * self.blocks + block[pair]
        hits = self.starts[cell + 1] - self.starts[cell]
        at = tokens.ragged(self.starts[cell], hits)
        place = np.repeat(pair, hits) * self.size + self.row[at] % self.size
        product = np.repeat(queries.weight[entry], hits) * self.weight[at]
        return np.bincount(place, product, minlength=len(query) * self.size).reshape(-1, self.size)

    def nearest(self, queries: Vectors, most: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``rows, cosines`` of the nearest examples of each query, -1 and 0 where there are fewer.

        Only examples with a positive cosine count. Of equal cosines the example with the smaller row
        comes first. ``without`` is a row that each query leaves out. Also counts opened blocks.
        """
        many = len(queries)
        found = np.full((many, most), -1)
        cosine = np.zeros((many, most))
        bound = self.bounds(queries)
        order = np.argsort(-bound, axis=1, kind="stable")
        active = np.arange(many)
        self.opened = 0
        for turn in range(self.blocks):
            block = order[active, turn]
            best = bound[active, block]
            # A block whose bound equals the last cosine may hold a smaller row with that cosine.
            open_ = (best > 0) & (best + SLACK >= cosine[active, -1])
            active, block = active[open_], block[open_]
            if not len(active):
                break
            self.opened += len(active)
            score = self.cosines(queries, active, block)
            rows = block[:, None] * self.size + np.arange(self.size)
            if without is not None:
                score = np.where(rows == without[active][:, None], 0.0, score)
            rows = np.concatenate([found[active], np.where(score > 0, rows, -1)], axis=1)
            score = np.concatenate([cosine[active], score], axis=1)
            first = np.lexsort((np.where(rows < 0, self.many, rows), -score), axis=1)[:, :most]
            found[active] = np.take_along_axis(rows, first, axis=1)
            cosine[active] = np.take_along_axis(score, first, axis=1)
        return found, cosine


def vote(found: np.ndarray, cosine: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Share of label 1 among neighbours, weighted by nearness; -1 where there is none."""
    say = np.where(found >= 0, cosine / (1 - np.minimum(cosine, 1.0) + SOFTEN), 0.0)
    total = say.sum(axis=1)
    share = (say * labels[found]).sum(axis=1) / np.maximum(total, 1e-30)
    return np.where(total > 0, share, -1.0)


def rising(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, prior: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Steps ``from, score`` of the rising function of the vote that fits the labels best.

    Neighbouring votes are merged while the share of label 1 falls; a share counts ``prior`` examples
    of each label beside its own, scaled by the mean weight, so that no score is certain.
    """
    steps: list[list[float]] = []
    for v in np.unique(votes):
        same = votes == v
        steps.append([v, float((weights * labels)[same].sum()), float(weights[same].sum())])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, one, all_ = steps.pop()
            steps[-1][1] += one
            steps[-1][2] += all_
    # A last pass keeps order after smoothing.
    add = prior * float(weights.mean())
    score = [(one + add * 0.5) / (all_ + add) for _, one, all_ in steps]
    return np.array([s[0] for s in steps]), np.maximum.accumulate(score)


@dataclass
class Model:
    """What is broadcast; the parameters bound its size: examples x terms of the vocabulary at most."""

    vocabulary: Vocabulary
    index: BlockMaxIndex
    doc_ids: np.ndarray
    labels: np.ndarray
    steps: np.ndarray = None
    scores: np.ndarray = None
    neighbours: int = NEIGHBOURS

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        return self.scores[np.maximum(np.searchsorted(self.steps, votes, side="right") - 1, 0)]

    def judge(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, and rows and cosines of the neighbours."""
        found, cosine = self.index.nearest(self.vocabulary.vectors(texts), self.neighbours)
        return self.calibrated(vote(found, cosine, self.labels)), found, cosine


def chosen_terms(examples: DataFrame, sizes: dict[int, int]) -> Vocabulary:
    """The terms whose document frequency differs most between the labels.

    ``examples`` (a written table) has each example's different terms. Spark counts them; the driver
    gets the terms of the vocabulary alone. Of equal statistics the smaller term is taken.
    """
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    counts = (
        examples.select("label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    )
    expected = lambda n: (F.col("a") + F.col("b")) * n / (ones + zeros)
    part = lambda seen, want: F.when(seen > 0, seen * F.log(seen / want)).otherwise(0.0)
    ratio = 2 * sum(
        (part(seen, want) for seen, want in (
            (F.col("a"), expected(ones)),
            (F.col("b"), expected(zeros)),
            (ones - F.col("a"), ones - expected(ones)),
            (zeros - F.col("b"), zeros - expected(zeros)),
        )),
        F.lit(0.0),
    )
    best = (
        counts.where(F.col("a") + F.col("b") >= LEAST_DOCS)
        .withColumn("ratio", F.round(ratio, 6))
        .where(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.col("ratio").desc(), "term")
        .limit(TERMS)
        .select("term", (F.col("a") + F.col("b")).alias("n"))
        .toArrow()
        .sort_by("term")
    )
    seen = np.asarray(best.column("n"), np.float64)
    return Vocabulary(np.asarray(best.column("term"), np.int64).astype(np.uint64), np.log((1 + ones + zeros) / (1 + seen)) + 1)


def fit(labelled: DataFrame, docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """The model of rows ``doc_id, toxic`` and the texts of these documents.

    About ``sample_docs`` examples of each label are chosen by hash, which bounds the join side that
    is broadcast and the vectors that are gathered. Null labels are left out; repeated labels are
    examples of their own; nothing to learn from gives None.
    """
    known = labelled.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("label"))
    all_sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all_sizes:
        return None
    rates = {k: min(1.0, sample_docs / n) for k, n in all_sizes.items()}
    share = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    place = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_000)) / 1e6
    sample = F.broadcast(known.where(place < share[F.col("label")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in tokens.text_slices(batch.column(2), 2_000_000):
                owner, term, count = counted(*grams(texts))
                cuts = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(first, len(texts)) for c in batch.columns[:2]),
                        pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int64))),
                        pa.ListArray.from_arrays(cuts, pa.array(count.astype(np.int32), pa.int32())),
                    ],
                    names=["doc_id", "label", "terms", "counts"],
                )

    examples = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    examples = examples.select("doc_id", "label", "text").mapInArrow(
        run, "doc_id long, label int, terms array<long>, counts array<int>"
    )
    examples = written(examples, "toxicity-examples")
    sizes = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    vocabulary = chosen_terms(examples, sizes)
    return _index(_gathered(examples, vocabulary), vocabulary, rates)


def _gathered(examples: DataFrame, vocabulary: Vocabulary) -> pa.Table:
    """Examples with the terms of the vocabulary that they have, by their places in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            owner = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
            term = np.asarray(lists.flatten()).astype(np.uint64)
            count = np.asarray(batch.column(3).flatten())
            at = np.minimum(np.searchsorted(vocabulary.terms, term), max(len(vocabulary.terms) - 1, 0))
            own = vocabulary.terms[at] == term if len(vocabulary.terms) else np.zeros(len(term), bool)
            cuts = pa.array(np.searchsorted(owner[own], np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x[own].astype(np.int32), pa.int32())) for x in (at, count)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], names=["doc_id", "label", "terms", "counts"])

    found = examples.mapInArrow(run, "doc_id long, label int, terms array<int>, counts array<int>").toArrow()
    return found.sort_by([("doc_id", "ascending"), ("label", "ascending")])


def _index(found: pa.Table, vocabulary: Vocabulary, rates: dict[int, float]) -> Model:
    terms, counts = found.column("terms").combine_chunks(), found.column("counts").combine_chunks()
    owner = np.repeat(np.arange(found.num_rows), np.asarray(terms.value_lengths()))
    vectors = vocabulary.weighted(
        found.num_rows, owner, np.asarray(terms.flatten()).astype(np.int64), np.asarray(counts.flatten())
    )
    # Similar examples stand together: by their heaviest term, then by doc_id.
    size = np.diff(vectors.starts)
    heaviest = np.full(len(vectors), len(vocabulary.terms))
    filled = np.flatnonzero(size)
    order = np.lexsort((-vectors.weight, vectors.rows()))
    heaviest[filled] = vectors.term[order][vectors.starts[filled]]
    order = np.lexsort((np.arange(len(vectors)), heaviest))
    vectors = vectors.take(order)
    labels = np.asarray(found.column("label"))[order].astype(float)
    doc_ids = np.asarray(found.column("doc_id").fill_null(-1))[order]
    model = Model(vocabulary, BlockMaxIndex(vectors, len(vocabulary.terms)), doc_ids, labels)
    # Each example is scored by the others and weighs as many rows as it stands for.
    near, cosine = model.index.nearest(vectors, NEIGHBOURS, np.arange(len(vectors)))
    weights = np.array([1 / rates[int(k)] for k in labels])
    model.steps, model.scores = rising(vote(near, cosine, labels), labels, weights)
    return model


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence_ids, evidence_cosines`` for every row.

    Only the text decides. The evidence names the nearest examples, nearest first. Null and empty
    texts, and those without a term of the vocabulary, have no neighbours and get the share of label
    1 among the examples without any; without a model every score is 0. Repeated rows have equal
    scores; null doc_ids are not held out; other columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for begin, texts in tokens.text_slices(batch.column(2), 2_000_000):
                for first in range(0, len(texts), BATCH):
                    part = texts.slice(first, BATCH)
                    many = len(part)
                    if model is None:
                        score, found, cosine = np.zeros(many), np.full((many, 1), -1), np.zeros((many, 1))
                        named = found
                    else:
                        score, found, cosine = model.judge(part)
                        named = model.doc_ids[found]
                    there = found >= 0
                    cuts = pa.array(np.append(0, np.cumsum(there.sum(axis=1))), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(c.slice(begin + first, many) for c in batch.columns[:2]),
                            pa.array(score, pa.float64()),
                            pa.array((score >= CUTOFF).astype(np.int32)),
                            pa.ListArray.from_arrays(cuts, pa.array(named[there], pa.int64())),
                            pa.ListArray.from_arrays(cuts, pa.array(cosine[there], pa.float64())),
                        ],
                        names=_NAMES,
                    )

    held = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text").mapInArrow(
        run,
        "doc_id long, held_out boolean, score double, predicted int, evidence_ids array<long>, evidence_cosines array<double>",
    )


_NAMES = ["doc_id", "held_out", "score", "predicted", "evidence_ids", "evidence_cosines"]


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return score_documents(docs, fit(labels.where(remainder(F.col("doc_id"), 5) != 0), docs))
