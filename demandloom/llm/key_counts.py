"""Counts of 64-bit keys over a whole corpus, brought back to where the keys occur.

Documents are dealt into blocks of bounded text. Each block sends its distinct keys, once each, to
parts of the key space: a hot key weighs no more than a rare one, and hashed keys fill the parts
evenly. A part adds up what the blocks sent and answers each block with totals in the order of its
keys. A block makes the same sorted keys again from its documents, so only totals travel back.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text per block and per part of the key space; both numbers grow with the corpus.
BLOCK_BYTES = 8_000_000
PART_BYTES = 24_000_000
#: Keys of a part that are sorted and added up at a time.
SLICE_KEYS = 250_000

#: ``block`` -1 marks a row of statistics.
ANSWER = "block int, part int, counts binary, stats array<double>"


def sizes(docs: DataFrame) -> tuple[int, int]:
    """Number of blocks and of parts for the text of ``docs``."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    return 1 + total // BLOCK_BYTES, 1 + total // PART_BYTES


def block_of(blocks: int):
    return F.pmod(F.xxhash64("doc_id", F.lit("block")), F.lit(blocks)).cast("int").alias("block")


def mixed(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them over the whole range."""
    keys = (keys ^ (keys >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    keys = (keys ^ (keys >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return keys ^ (keys >> np.uint64(33))


def part_bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins in sorted keys, and their end."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def to_bytes(values: np.ndarray) -> bytes:
    """Whole numbers at the least byte width that holds them all; the width comes first."""
    values = np.ascontiguousarray(values, np.uint64)
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def from_bytes(data: bytes | pa.Buffer, first: int = 0, end: int | None = None) -> np.ndarray:
    """The numbers of :func:`to_bytes`, or those from place ``first`` up to ``end``."""
    width = data[0]
    count = -1 if end is None else (end - first) * width
    raw = np.frombuffer(data, np.uint8, count, 1 + first * width).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view(np.uint64).ravel()


def _sorted_bytes(keys: np.ndarray) -> bytes:
    """Sorted numbers: the first one in full, then the differences at their least width."""
    return keys[:1].tobytes() + to_bytes(np.diff(keys))


def _sorted_numbers(data: bytes | pa.Buffer) -> np.ndarray:
    first = np.frombuffer(data, np.uint64, count=1)
    return np.cumsum(np.concatenate([first, from_bytes(data[8:])]), dtype=np.uint64)


def sent(block: int, keys: np.ndarray, counts: np.ndarray, parts: int, drop: np.uint64 = np.uint64(0)) -> pa.Table:
    """A block's rows: for each part its sorted keys as differences, and their counts.

    The lowest ``drop`` bits of all keys are 0 and are not sent.
    """
    bounds = part_bounds(keys, parts)
    used = np.flatnonzero(np.diff(bounds))
    cuts = [(bounds[p], bounds[p + 1]) for p in used]
    return pa.table(
        {
            "block": pa.array(np.full(len(used), block), pa.int32()),
            "part": pa.array(used, pa.int32()),
            "keys": pa.array([_sorted_bytes(keys[a:b] >> drop) for a, b in cuts], pa.binary()),
            "counts": pa.array([to_bytes(counts[a:b]) for a, b in cuts], pa.binary()),
        }
    )


SENT = "block int, part int, keys binary, counts binary"


def totals(
    emitted: DataFrame,
    statistics: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    drop: np.uint64 = np.uint64(0),
) -> DataFrame:
    """Answers to the blocks, and with ``statistics(keys, totals)`` one row of sums per part.

    Blocks send sorted keys, so a part is added up in slices of the key space, each cut from all
    blocks alike: beside the keys, which give way to their totals, only a slice is held unpacked.
    """

    def add(table: pa.Table) -> pa.Table:
        runs = [_sorted_numbers(k.as_buffer()) << drop for k in table.column("keys")]
        counted = [c.as_buffer() for c in table.column("counts")]
        low, high = min(int(r[0]) for r in runs), max(int(r[-1]) for r in runs)
        slices = 1 + sum(map(len, runs)) // SLICE_KEYS
        inner = np.array([low + (high - low) * i // slices for i in range(1, slices)], np.uint64)
        cuts = [np.concatenate([[0], np.searchsorted(r, inner), [len(r)]]).tolist() for r in runs]
        sums = []
        for i in range(slices):
            pieces = [r[c[i] : c[i + 1]] for r, c in zip(runs, cuts)]
            flat = np.concatenate(pieces)
            if not len(flat):
                continue
            count = np.concatenate([from_bytes(b, c[i], c[i + 1]) for b, c in zip(counted, cuts)])
            order = np.argsort(flat, kind="stable")
            flat, count = flat[order], count[order]
            first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
            total = np.add.reduceat(count, first)
            answer = np.empty(len(flat), np.uint64)
            answer[order] = np.repeat(total, np.diff(np.append(first, len(flat))))
            if statistics is not None:
                sums.append(statistics(flat[first], total))
            done = 0
            for piece in pieces:
                piece[:] = answer[done : done + len(piece)]
                done += len(piece)
        block = table.column("block").to_pylist()
        part = table.column("part").to_pylist()
        stats: list = [None] * len(block)
        counts: list = [to_bytes(r) for r in runs]
        if statistics is not None:
            block, part, counts = [*block, -1], [*part, part[0]], [*counts, None]
            stats = [*stats, np.sum(sums, axis=0)]
        return pa.table(
            {
                "block": pa.array(block, pa.int32()),
                "part": pa.array(part, pa.int32()),
                "counts": pa.array(counts, pa.binary()),
                "stats": pa.array(stats, pa.list_(pa.float64())),
            }
        )

    return emitted.groupBy("part").applyInArrow(add, ANSWER)


def summed_stats(answers: DataFrame) -> np.ndarray:
    """The statistics of all parts added up; their length does not depend on the corpus."""
    rows = (
        answers.where(F.col("block") == -1)
        .select(F.posexplode("stats"))
        .groupBy("pos")
        .agg(F.sum("col").alias("n"))
        .orderBy("pos")
        .collect()
    )
    return np.array([r["n"] for r in rows])


def answered(table: pa.Table) -> np.ndarray:
    """Totals for a block's sorted keys from the answers of all parts."""
    table = table.sort_by("part")
    parts = [from_bytes(c) for c in table.column("counts").to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)
