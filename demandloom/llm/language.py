"""Language ID by prediction by partial matching (PPM) over bytes.

Each language has a context tree of up to ``ORDER`` bytes with frozen counts. The next byte is
coded in the longest context that has been seen: a byte seen there with probability
``c / (T + d)`` (``T`` bytes coded in the context, ``d`` different ones), else by an escape with
probability ``d / (T + d)`` to the context one byte shorter, where bytes already excluded by the
longer one are left out and the rest renormalised. Below the empty context all bytes left are equal.
So the probabilities of all 256 bytes add up to one in every context, and a text's code length is exact.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import tokens

ORDER = 4
#: Documents per language from which counts are taken, about; chosen by hash from all of them.
SAMPLE_DOCS = 1200

#: Numerics that are no decimal digits, such as fractions and circled numbers: word characters, yet no letters.
#: A set, as a pattern with so many characters is matched one by one.
_NUMERIC = frozenset(
    c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not (c.isdecimal() or c.isalpha())
)
_NO_LETTER = re.compile(r"[\W\d_]+")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the doc_id as text, modulo ``by``; null doc_ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def letters(text: str | None) -> bytes:
    """Lower-case words of letters, one space between; empty if there is no letter."""
    lower = (text or "").lower()
    if not lower.isascii():
        for numeric in _NUMERIC.intersection(lower):
            lower = lower.replace(numeric, " ")
    return _NO_LETTER.sub(" ", lower).strip(" ").encode("utf-8", "replace")


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER + 1`` bytes ending at each byte, as a number, and the places where texts begin.

    Each text is preceded by ``ORDER`` spaces and followed by one.
    """
    pad = b" " * ORDER
    raw = np.frombuffer(b"".join(pad + t + b" " for t in texts), np.uint8)
    sizes = np.array([len(t) + ORDER + 1 for t in texts], np.int64)
    value = raw.astype(np.int64)
    key = value.copy()
    for back in range(1, ORDER + 1):
        key[back:] |= value[:-back] << (8 * back)
    ends = np.cumsum(sizes)
    keep = np.ones(len(raw), bool)
    keep[((ends - sizes)[:, None] + np.arange(ORDER)).ravel()] = False
    return key[keep], (ends - sizes) - ORDER * np.arange(len(texts))


@dataclass
class Level:
    """Grams of one length with ln probabilities, their contexts with ln escape weights."""

    keys: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


class ContextTrees:
    """The trees of all languages, side by side: one column per language."""

    def __init__(self, languages: list[str], keys: np.ndarray, counts: np.ndarray):
        """``keys``: distinct grams, ascending; ``counts``: a row per gram, a column per language."""
        self.languages = languages
        self.levels: list[Level] = []
        below = None
        for order in range(ORDER + 1):
            low = keys & ((1 << 8 * (order + 1)) - 1)
            grams_, inverse = np.unique(low, return_inverse=True)
            count = np.zeros((len(grams_), len(languages)))
            np.add.at(count, inverse, counts)
            contexts, owner = np.unique(grams_ >> 8, return_inverse=True)

            def per_context(values: np.ndarray) -> np.ndarray:
                out = np.zeros((len(contexts), values.shape[1]))
                np.add.at(out, owner, values)
                return out

            seen = count > 0
            total, different = per_context(count), per_context(seen.astype(float))
            if below is None:
                shorter = np.full(count.shape, 1 / 256)
            else:
                shorter = np.exp(below.logp[np.searchsorted(below.keys, grams_ & ((1 << 8 * order) - 1))])
            left = np.maximum(1 - per_context(np.where(seen, shorter, 0)), 1e-12)
            known = total > 0
            escape = np.where(known, different / np.maximum(total + different, 1) / left, 1.0)
            share = count / np.maximum(total + different, 1)[owner]
            p = np.where(seen, share, escape[owner] * shorter)
            below = Level(grams_, np.log(p), contexts, np.log(escape))
            self.levels.append(below)
        self._index()

    def _index(self) -> None:
        keys = self.levels[-1].keys
        self.bits = max(4, int(len(keys)).bit_length() + 2)
        self.slots = np.zeros(1 << self.bits, np.int64)
        self.slots[self._slot(keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def logp(self, keys: np.ndarray) -> np.ndarray:
        """ln probability of each gram's last byte after the others: a column per language."""
        top = self.levels[-1]
        at = self.slots[self._slot(keys)]
        out = top.logp[at]
        rest = np.flatnonzero(top.keys[at] != keys)
        out[rest] = 0
        for order in range(ORDER, -1, -1):
            if not len(rest):
                return out
            level = self.levels[order]
            want = keys[rest] & ((1 << 8 * (order + 1)) - 1)
            at = np.minimum(np.searchsorted(level.keys, want), len(level.keys) - 1)
            hit = level.keys[at] == want
            out[rest[hit]] += level.logp[at[hit]]
            rest, want = rest[~hit], want[~hit] >> 8
            at = np.minimum(np.searchsorted(level.contexts, want), len(level.contexts) - 1)
            hit = level.contexts[at] == want
            out[rest[hit]] += level.escape[at[hit]]
        out[rest] += np.log(1 / 256)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """ln probability of whole texts: a row per text, a column per language."""
        if not texts:
            return np.zeros((0, len(self.languages)))
        keys, begins = grams(texts)
        return np.add.reduceat(self.logp(keys), begins, axis=0)


def fit(rows: DataFrame, sample_docs: int = SAMPLE_DOCS) -> ContextTrees | None:
    """Trees from ``rows`` with ``doc_id, text, lang``; rows with null text or lang are left out.

    Counts come from about ``sample_docs`` whole documents per language, chosen by a hash of the
    doc_id, so what is gathered on the driver is bounded by languages times sample.
    """
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    shares = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_docs / n))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) / 1e6
    sample = usable.where(place < shares[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = [letters(t) for t in batch.column(1).to_pylist()]
            for name in sorted(set(names)):
                own = [t for n, t in zip(names, texts) if n == name and t]
                if own:
                    keys, numbers = np.unique(grams(own)[0], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": [name] * len(keys), "gram": keys, "n": numbers})

    table = (
        sample.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    if not table.num_rows:
        return None
    coded = table.column("lang").combine_chunks().dictionary_encode()
    languages = sorted(coded.dictionary.to_pylist())
    column = np.array([languages.index(x) for x in coded.dictionary.to_pylist()])[np.asarray(coded.indices)]
    keys, row = np.unique(np.asarray(table.column("gram")), return_inverse=True)
    counts = np.zeros((len(keys), len(languages)))
    counts[row, column] = np.asarray(table.column("n"))
    return ContextTrees(languages, keys, counts)


def predict(docs: DataFrame, trees: ContextTrees | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: the language with the shortest code and its posterior.

    Only the text decides. Null texts and texts without a letter are ``und`` with score 0, as is
    everything if nothing was learned. Of equal code lengths the first language in order wins.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, texts in tokens.text_slices(batch.column(2), 1_000_000):
                plain = [letters(t) for t in texts.to_pylist()]
                has = np.array([bool(t) for t in plain]) & (model is not None)
                names, score = np.full(len(plain), "und", object), np.zeros(len(plain))
                if has.any():
                    code = model.score([t for t, h in zip(plain, has) if h])
                    best = code.argmax(axis=1)
                    names[has] = np.array(model.languages, object)[best]
                    score[has] = 1 / np.exp(code - code.max(axis=1, keepdims=True)).sum(axis=1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(first, len(plain)),
                        "held_out": batch.column(1).slice(first, len(plain)),
                        "lang_pred": pa.array(names, pa.string()),
                        "score": score,
                    }
                )

    held = (remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    learned = docs.where(remainder(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang")
    return predict(docs, fit(learned))
