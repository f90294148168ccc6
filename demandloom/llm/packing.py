"""Best-fit packing of documents into sequences, with matching of large items.

Where a piece goes depends on its length alone, so the packing is planned on the histogram of
lengths: at most one entry per length up to the capacity, whatever the number of documents. Pieces
above a third of the capacity are matched greedily, at most two to a sequence: the largest with
the largest that still fits beside it. Smaller ones, from the longest down, go to the tightest gap.
The plan is a list of runs; each document finds its own place by its rank among those of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm import tokens
from demandloom.llm.store import written

CAPACITY = 4096
END_ID = 1
#: Rows of one length are ranked in so many parts, and one more per this many pieces.
PARTS, ROWS_PER_PART = 16, 2_000_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every document.

    A document is its ids and the end id; only longer ones than ``capacity`` are cut. Null and empty
    texts are the end id alone. Rows that repeat give pieces that repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in tokens.text_slices(batch.column(1)):
                flat, offsets = tokens.encode(texts, tokenizer)
                # The end id goes behind each document.
                sizes = np.diff(offsets) + 1
                ids = np.insert(flat, offsets[1:], end_id).astype("<u4")
                base = np.cumsum(sizes) - sizes
                number = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(sizes)), number)
                piece = tokens.ragged(np.zeros(len(sizes), np.int64), number)
                start = piece * capacity
                length = np.minimum(capacity, sizes[owner] - start)
                begin = base[owner] + start
                raw = [ids[a : a + n].tobytes() for a, n in zip(begin, length)]
                columns = [
                    batch.column(0).slice(first, len(sizes)).take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = _PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs ``(length, first rank, first sequence, offset, pieces of this length per sequence)``.

    A run lasts to the next one of its length: rank r of it lies in sequence
    ``first sequence + (r - first rank) // per`` at ``offset + (r - first rank) % per * length``.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    left = dict(histogram)
    used = dict.fromkeys(histogram, 0)
    open_: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    gaps: list[int] = []
    made = 0

    def opened(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in open_:
                open_[gap] = []
                insort(gaps, gap)
            open_[gap].append((first, number))

    def put(length: int, number: int, sequence: int, offset: int, per: int) -> None:
        runs.append((length, used[length], sequence, offset, per))
        used[length] += number
        left[length] -= number

    large = sorted(n for n in histogram if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        place = bisect_left(large, capacity - a + 1) - 1
        while place >= 0 and (not left[large[place]] or (large[place] == a and left[a] < 2)):
            if large[place] != a:
                large.pop(place)
            place -= 1
        if place < 0:  # nothing fits beside it
            number = left[a]
            put(a, number, made, 0, 1)
            opened(capacity - a, made, number)
        elif large[place] == a:
            number = left[a] // 2
            put(a, 2 * number, made, 0, 2)
            opened(capacity - 2 * a, made, number)
        else:
            b = large[place]
            number = min(left[a], left[b])
            put(a, number, made, 0, 1)
            put(b, number, made, a, 1)
            opened(capacity - a - b, made, number)
        made += number

    for length in sorted((n for n in histogram if 3 * n <= capacity), reverse=True):
        while left[length]:
            place = bisect_left(gaps, length)
            if place < len(gaps):
                gap = gaps[place]
                first, number = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
                    gaps.pop(place)
            else:
                gap, first = capacity, made
                number = -(-left[length] // (capacity // length))
                made += number
            # Best fit fills a sequence before it takes the next: its gap only gets tighter.
            per = gap // length
            full = min(number, left[length] // per)
            if full:
                put(length, full * per, first, capacity - gap, per)
                opened(gap - per * length, first, full)
            if full < number:
                rest = left[length]
                if rest:
                    put(length, rest, first + full, capacity - gap, per)
                    opened(gap - rest * length, first + full, 1)
                opened(gap, first + full + bool(rest), number - full - bool(rest))
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame, parts: int) -> DataFrame:
    """``rank`` (from 0) of each piece among those of its length.

    Rows of a length are dealt to parts by hash and numbered inside; counts per (length, part)
    give the offsets. No task sees a whole length.
    """
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int")
    dealt = pieces.withColumn("__part", part)
    counts = dealt.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "length", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy("length", "__part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = dealt.withColumn("__inside", F.row_number().over(inside) - 1)
    rank = (F.col("__inside") + F.col("__before")).alias("rank")
    return numbered.join(offsets, ["length", "__part"]).select(*pieces.columns, rank)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences hold at most ``capacity`` ids.

    ``pieces`` is read twice, so it should be a written table. Its histogram, at most ``capacity``
    rows, is planned on the driver; the plan, a few runs per length, is sent to the tasks.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(histogram, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    keys = runs[:, 0] << 44 | runs[:, 1]
    parts = PARTS + sum(histogram.values()) // ROWS_PER_PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.asarray(batch.column("length"), dtype=np.int64)
            rank = np.asarray(batch.column("rank"), dtype=np.int64)
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            _, first, sequence, offset, per = runs[at].T
            columns = [
                *[batch.column(n) for n in names],
                pa.array(sequence + (rank - first) // per),
                pa.array(offset + (rank - first) % per * length),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    names = pieces.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked(pieces, parts).mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """Cut and pack: one row per piece. An empty table gives no rows."""
    path = tokenizer or tokens.default_tokenizer()
    return pack(written(cut(docs, path, end_id, capacity), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, doc_ids, offsets, ids``: the packed sequences themselves.

    ``packed`` has the ``ids`` of each piece. A sequence holds at most ``capacity`` ids.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("length"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        F.transform("p", lambda x: x["offset"]).alias("offsets"),
        F.aggregate("p", F.lit(b""), lambda b, x: F.concat(b, x["ids"])).alias("ids"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{folder}/documents.parquet"))
