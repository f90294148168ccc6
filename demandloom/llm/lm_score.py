"""Language-model scores by a weighted backoff automaton over words.

States are the training words as histories (and the begin of a text); the root knows no history.
From state h an arc for each seen word w carries log10 of
``(1 - e(h)) c(hw) / c(h) + e(h) p(w)``, and a failure arc to the root carries log10 e(h); the root's
arcs carry log10 p(w), with one arc for unknown words. ``p(w) = (c(w) - D1) / N`` leaves ``D1 V / N`` to the
unknown; D1 and D2 are absolute discounts ``n1 / (n1 + 2 n2)`` from counts of counts. ``e(h)``, the mass left
to unseen successors, is D2 times the number of different successors over c(h); that number is what
c(h) draws of independent words would give, scaled so that the sum over all histories equals the
number of different pairs in the corpus. Arcs out of a state add up to one. A text is traversed once
from left to right; the state after a word is that word, or the root after an unknown one.

All counts cover all training documents. A text's block asks for the counts of its own words and
pairs only, so no model is broadcast: it is met where it is needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import key_counts as kc
from demandloom.llm import tokens
from demandloom.llm.language import remainder
from demandloom.llm.store import written

#: Word counts are summed up in bins of a quarter of a power of two.
BINS = 256
_U64 = np.uint64


def word_keys(words: pa.Array) -> np.ndarray:
    """A 64-bit hash per word with its last bit 0."""
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), _U64, len(words))
    return hashes & ~_U64(1)


#: Key of the end of a text, which is no word.
END = _U64(0x5BD1E9955BD1E994)
#: The history at the begin of a text.
BEGIN = _U64(0x27D4EB2F165667C4)


class Texts:
    """Tokens of a block of texts: distinct words, and one row of codes with an end per text."""

    def __init__(self, texts: pa.Array, train: np.ndarray):
        codes, offsets, words = tokens.split_words(pc.ascii_lower(texts))
        keys = np.append(word_keys(words), END)
        self.keys, place = np.unique(keys, return_inverse=True)
        sizes = np.diff(offsets) + 1
        self.begins = np.cumsum(sizes) - sizes
        self.sizes = sizes
        flat = np.insert(codes, offsets[1:], len(keys) - 1)
        self.codes = place[flat]
        self.train = np.repeat(train, sizes)
        before = np.empty(len(flat), _U64)
        now = self.keys[self.codes]
        before[1:] = now[:-1]
        before[self.begins] = BEGIN
        pairs = kc.mixed(before * _U64(0x9E3779B97F4A7C15) + now) | _U64(1)
        self.pair_keys, self.pairs = np.unique(pairs, return_inverse=True)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys, sorted, with their training counts in this block."""
        single = np.bincount(self.codes[self.train], minlength=len(self.keys))
        double = np.bincount(self.pairs[self.train], minlength=len(self.pair_keys))
        keys = np.concatenate([self.keys, self.pair_keys])
        order = np.argsort(keys)
        return keys[order], np.concatenate([single, double])[order]

    def spread(self, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Totals in the order of ``keys`` and ``pair_keys`` from those of the sorted keys."""
        keys = np.concatenate([self.keys, self.pair_keys])
        out = np.empty(len(keys))
        out[np.argsort(keys)] = answers
        return out[: len(self.keys)], out[len(self.keys) :]


def count_bin(counts: np.ndarray) -> np.ndarray:
    return np.minimum((4 * np.log2(np.maximum(counts, 1))).astype(np.int64), BINS - 1)


def statistics(keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Word types and tokens per count bin, words seen once and twice; pairs, once and twice."""
    word = (keys & _U64(1)) == 0
    single, double = totals[word & (totals > 0)].astype(float), totals[~word]
    bins = count_bin(single)
    return np.concatenate(
        [
            np.bincount(bins, minlength=BINS),
            np.bincount(bins, weights=single, minlength=BINS),
            [(single == 1).sum(), (single == 2).sum(), (double > 0).sum(), (double == 1).sum(), (double == 2).sum()],
        ]
    )


class Automaton:
    """Weights of arcs and failure arcs from counts; its own size is fixed by ``BINS``."""

    def __init__(self, stats: np.ndarray):
        stats = np.zeros(2 * BINS + 5) if not len(stats) else stats
        types, mass = stats[:BINS], stats[BINS : 2 * BINS]
        once, twice, self.pairs, pair_once, pair_twice = stats[2 * BINS :]
        self.n, self.v = int(mass.sum()), int(types.sum())
        used = types > 0
        self.types, self.mean = types[used], mass[used] / types[used]
        self.d1, self.d2 = (
            float(np.clip(a / (a + 2 * b) if a + b else 0.5, 0.1, 0.9)) for a, b in ((once, twice), (pair_once, pair_twice))
        )
        expected = float((self.types * self._successors(self.mean)).sum())
        self.scale = min(1.0, self.pairs / expected) if expected else 1.0

    def _successors(self, counts: np.ndarray) -> np.ndarray:
        draws = np.asarray(counts, float)[:, None] * (self.mean / max(self.n, 1))[None, :]
        return (self.types * -np.expm1(-draws)).sum(axis=1)

    def failure(self, counts: np.ndarray) -> np.ndarray:
        """e(h) for histories seen ``counts`` times; 1 for unseen ones, which are the root."""
        different, place = np.unique(counts, return_inverse=True)
        left = self.d2 * self.scale * self._successors(different) / np.maximum(different, 1)
        return np.where(different > 0, np.clip(left, 1e-6, 1.0), 1.0)[place]

    def root(self, counts: np.ndarray) -> np.ndarray:
        """p(w) for words seen ``counts`` times; with no training tokens everything is unknown."""
        if not self.n:
            return np.ones(len(counts))
        return np.where(counts > 0, counts - self.d1, self.d1 * self.v) / self.n

    def traverse(self, texts: Texts, words: np.ndarray, pairs: np.ndarray, begins: float) -> np.ndarray:
        """log10 probability of each text; ``words``, ``pairs``, ``begins`` are training counts."""
        now = words[texts.codes]
        state = np.empty(len(now))
        state[1:] = now[:-1]
        state[texts.begins] = begins
        fail = self.failure(state)
        seen = pairs[texts.pairs] / np.maximum(state, 1)
        weight = np.log10(np.where(state > 0, (1 - fail) * seen, 0) + fail * self.root(now))
        return np.add.reduceat(weight, texts.begins)


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    ``docs`` has ``doc_id, text`` and ``held_out`` (not learned from). Null texts are the end alone.
    Rows that repeat are texts of their own. An empty table gives no rows.
    """
    rows = docs.select("doc_id", "held_out", "text")
    blocks, parts = kc.sizes(rows)
    dealt = rows.select(
        kc.block_of(blocks), F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text"
    )

    def read(table: pa.Table) -> Texts:
        train = ~np.asarray(table.column("held_out"), dtype=bool)
        return Texts(table.column("text").combine_chunks(), train)

    def emit(table: pa.Table) -> pa.Table:
        keys, counts = read(table).counted()
        return kc.sent(table.column("block")[0].as_py(), keys, counts, parts)

    emitted = dealt.groupBy("block").applyInArrow(emit, kc.SENT)
    answers = written(kc.totals(emitted, statistics), "lm-counts")
    model = Automaton(kc.summed_stats(answers))
    begins = float(rows.where(~F.col("held_out")).count())

    def score(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _EMPTY.empty_table()
        texts = read(table)
        words, pairs = texts.spread(kc.answered(found))
        now = words[texts.codes]
        base = np.log10((now + 0.1) / (model.n + 0.1 * (model.v + 1)))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "held_out": table.column("held_out"),
                "n_tokens": texts.sizes,
                "n_known": np.add.reduceat((now > 0).astype(np.int64), texts.begins),
                "train_tokens": np.full(len(texts.sizes), model.n, np.int64),
                "base_score": np.add.reduceat(base, texts.begins),
                "score": model.traverse(texts, words, pairs, begins),
            }
        )

    asked = answers.where(F.col("block") >= 0).select("block", "part", "counts")
    return dealt.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(score, _SCORES)


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double"
)
_EMPTY = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = (remainder(F.col("doc_id"), 10) == 0).alias("held_out")
    return score_documents(docs.select("doc_id", held, "text"))
