"""Token ids as binary files in patched frame-of-reference blocks, and their reader.

File format: a folder of Parquet files, one shard per range of doc_id, ascending. A row is a chunk
of whole documents: ``shard, chunk, n_ids, doc_ids, n_tokens, block_starts, payload``. The payload
is blocks of 128 ids, one after another; ``block_starts`` are their byte offsets. A block is its
minimum (4 bytes), the bit width (1), the number of exceptions (1), the ids less the minimum packed
at that width (16 bytes per bit), then the exceptions: places (1 byte each) and values (4 each).
The width is the least that holds the share ``PERCENTILE`` of the block; ids that need more are
exceptions. The last block of a chunk is filled up with its last id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm import tokens
from demandloom.llm.store import new_path

BLOCK = 128
PERCENTILE = 0.9
#: A chunk ends with the document that brings it to so many ids.
CHUNK_IDS = 65_536
END_ID = 2
HEADER = 6

_CHUNKS = (
    "shard int, chunk int, n_ids long, doc_ids array<long>, n_tokens array<long>,"
    " block_starts array<long>, payload binary"
)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 numbers below 2^width as bytes, lowest bits first.

    A number begins in one 32-bit word and may end in the next, so a word is the sum of the low
    halves that begin in it and of the high half that reaches it.
    """
    at = np.arange(BLOCK) * width
    shifted = values.astype(np.uint64) << (at & 31).astype(np.uint64)
    begins = np.searchsorted(at >> 5, np.arange(BLOCK // 32 * width))
    words = np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), begins, axis=1)
    words[:, 1:] += np.add.reduceat(shifted >> np.uint64(32), begins, axis=1)[:, :-1]
    return words.astype("<u4").view(np.uint8).reshape(len(values), -1)


def _unpacked(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(packed).view("<u4").astype(np.uint64)
    words = words | np.pad(words[:, 1:], ((0, 0), (0, 1))) << np.uint64(32)
    at = np.arange(BLOCK) * width
    return (words[:, at >> 5] >> (at & 31).astype(np.uint64) & np.uint64((1 << width) - 1)).astype(np.int64)


def pack_ids(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """``block_starts`` and ``payload`` of ids below 2^32."""
    if not len(ids):
        return np.zeros(0, np.int64), b""
    blocks = -(-len(ids) // BLOCK)
    table = np.full(blocks * BLOCK, ids[-1], np.uint32)
    table[: len(ids)] = ids
    table = table.reshape(blocks, BLOCK)
    low = table.min(axis=1)
    over = table - low[:, None]
    chosen = np.partition(over, int(PERCENTILE * BLOCK) - 1, axis=1)[:, int(PERCENTILE * BLOCK) - 1].astype(np.int64)
    width = np.where(chosen > 0, np.floor(np.log2(np.maximum(chosen, 1))).astype(np.int64) + 1, 0)
    outlier = over > ((1 << width) - 1).astype(np.uint32)[:, None]
    exceptions = outlier.sum(axis=1)
    sizes = HEADER + BLOCK // 8 * width + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[starts + 4] = width
    out[starts + 5] = exceptions
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = _packed(over[rows] & np.uint32((1 << int(w)) - 1), int(w))
        out[starts[rows][:, None] + HEADER + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(outlier)
    if len(block):
        nth = tokens.ragged(np.zeros(blocks, np.int64), exceptions)
        lists = starts + HEADER + BLOCK // 8 * width
        out[lists[block] + nth] = place
        values = over[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(lists + exceptions)[block][:, None] + 4 * nth[:, None] + np.arange(4)] = values
    return starts, out.tobytes()


def unpack_ids(starts: np.ndarray, payload: bytes, number: int) -> np.ndarray:
    """The ids again (uint32); any run of blocks can be read with its own starts."""
    raw = np.frombuffer(payload, np.uint8)
    starts = np.asarray(starts, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint32)
    low = np.ascontiguousarray(raw[starts[:, None] + np.arange(4)]).view("<u4").ravel().astype(np.int64)
    width = raw[starts + 4].astype(np.int64)
    exceptions = raw[starts + 5].astype(np.int64)
    table = np.zeros((len(starts), BLOCK), np.int64)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = raw[starts[rows][:, None] + HEADER + np.arange(BLOCK // 8 * w)]
        table[rows] = _unpacked(packed, int(w))
    if exceptions.any():
        block = np.repeat(np.arange(len(starts)), exceptions)
        nth = tokens.ragged(np.zeros(len(starts), np.int64), exceptions)
        lists = starts + HEADER + BLOCK // 8 * width
        place = raw[lists[block] + nth].astype(np.int64)
        at = (lists + exceptions)[block][:, None] + 4 * nth[:, None] + np.arange(4)
        table[block, place] = np.ascontiguousarray(raw[at]).view("<u4").ravel()
    return (table + low[:, None]).ravel()[:number].astype(np.uint32)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every text, append ``end_id``, and write ids in ascending ``doc_id`` order.

    Null and empty texts are the end id alone; equal doc_ids lie side by side. Texts are dealt by
    ranges of doc_id, so each task encodes and writes one shard by itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, ids, sizes, held, chunk, shard = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            starts, payload = pack_ids(flat)
            row = {
                "shard": [shard], "chunk": [chunk], "n_ids": [len(flat)], "doc_ids": [doc_ids],
                "n_tokens": [sizes], "block_starts": [starts], "payload": [payload],
            }
            return pa.RecordBatch.from_pydict(row, schema=_ARROW)

        for batch in batches:
            if batch.num_rows:
                shard = batch.column(2)[0].as_py()
            for first, texts in tokens.text_slices(batch.column(1)):
                flat, offsets = tokens.encode(texts, tokenizer)
                flat = np.insert(flat, offsets[1:], end_id)
                ends = offsets[1:] + np.arange(1, len(offsets))
                names = batch.column(0).slice(first, len(texts)).to_pylist()
                begin = 0
                for name, end in zip(names, ends):
                    doc_ids.append(name)
                    sizes.append(int(end - begin))
                    ids.append(flat[begin:end])
                    held += int(end - begin)
                    begin = end
                    if held >= CHUNK_IDS:
                        yield close()
                        doc_ids, ids, sizes, held, chunk = [], [], [], 0, chunk + 1
        if doc_ids:
            yield close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_last())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last())
        .withColumn("shard", F.spark_partition_id())
    )
    ordered.mapInArrow(run, _CHUNKS).write.parquet(folder)


_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
        ("block_starts", pa.list_(pa.int64())), ("payload", pa.binary()),
    ]
)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document in the files.

    ``start`` counts the ids of all documents before it: running sums over shards (one row each),
    over a shard's chunks and inside a chunk.
    """
    files = spark.read.schema(_CHUNKS).parquet(folder)
    chunks = files.select("shard", "chunk", "n_ids")
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = chunks.select(
        "shard", "chunk", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("place")
    ).join(bases, "shard")
    begins = places.select("shard", "chunk", (F.col("place") + F.col("base")).alias("begin"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["block_starts"], row["payload"], row["n_ids"]).astype("<u4")
                sizes = np.asarray(row["n_tokens"], np.int64)
                inside = np.cumsum(sizes) - sizes
                raw = [ids[a : a + n].tobytes() for a, n in zip(inside, sizes)]
                columns = {
                    "shard": np.full(len(sizes), row["shard"], np.int32),
                    "chunk": np.full(len(sizes), row["chunk"], np.int32),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "inside": inside,
                    "n_tokens": sizes,
                    "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(raw, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    kinds = "shard int, chunk int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    decoded = files.mapInArrow(run, kinds + (", ids binary" if with_ids else ""))
    start = (F.col("begin") + F.col("inside")).alias("start")
    more = ["ids"] if with_ids else []
    return decoded.join(begins, ["shard", "chunk"]).select("doc_id", start, "n_tokens", "ids_crc32", *more)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    files = new_path(spark, "token-blocks")
    write_tokens(docs, files, tokens.default_tokenizer())
    return read_tokens(spark, files)
