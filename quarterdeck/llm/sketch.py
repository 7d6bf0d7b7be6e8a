"""Count-min sketch over the hashes of all texts, merged from partition sketches.

Each hash is counted in two rows of counters that saturate at two. Partition sketches are sparse: for every block
of 65,536 counters or more (4,096 blocks at most) the gaps between sorted offsets, about a byte each. A shuffle by block adds them up, and what is left is one bit per counter:
counted twice or more. There are about `COUNTERS_PER_HASH` counters per hash, `MOST_COUNTERS` (128 MB of bits) at
most, which bounds the broadcast; beyond that more hashes pass the filter and none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import pieces

COUNTERS_PER_HASH = 8
MOST_COUNTERS = 1 << 30
ROWS = 2
#: Log of the counters in the smallest block, and of the most blocks: a task's rows grow with its hashes, not with the sketch.
_BLOCK = 16
_MOST_BLOCKS = 12
#: Bytes of text handled at once: hashes of a text take many times its bytes, and a worker holds the sketch beside them.
PIECE = 1 << 18
#: Hashes of a task that are sorted together.
_AT_ONCE = 1 << 21
_U = np.uint64
_SALT = [_U(0x9FB21C651E98DF25), _U(0xD6E8FEB86659FD93)]


def bits_for(hashes: int) -> int:
    """Log of the counters in a row."""
    want = min(max(hashes * COUNTERS_PER_HASH, 1 << (_BLOCK + 2)), MOST_COUNTERS)
    return (want - 1).bit_length() - 1


def block_bits(bits: int) -> int:
    return max(_BLOCK, bits + ROWS - 1 - _MOST_BLOCKS)


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Counter of each hash in one row; rows lie one after the other."""
    g = h * _SALT[row]
    return ((g ^ (g >> _U(29))) * _SALT[1 - row] >> _U(64 - bits)) + (_U(row) << _U(bits))


def encode_gaps(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gaps between sorted offsets as bytes (255 means 255 and more to come), and where the bytes of each gap begin."""
    at = np.zeros(len(gaps) + 1, np.int64)
    np.cumsum(gaps // 255 + 1, out=at[1:])
    out = np.full(at[-1], 255, np.uint8)
    out[at[1:] - 1] = gaps % 255
    return out, at


def decode_gaps(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(raw, dtype=np.int64)[raw != 255]


def add(counts: np.ndarray, offsets: np.ndarray) -> None:
    """Count sorted offsets into counters that stay at two: repeats are cut at two before they are added, so no byte wraps."""
    cells, times = np.unique(offsets, return_counts=True)
    counts[cells] = np.minimum(counts[cells] + np.minimum(times, 2).astype(np.uint8), 2)


def _gaps(h: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """(block, offsets) of the hashes: sorted offsets within each block as gaps."""
    wide = block_bits(bits)
    for row in range(ROWS):
        cells = _cells(h, row, bits)
        cells.sort()
        # Where each block of the row begins: few numbers, so that of all hashes only cells and offsets are held.
        first = row << (bits - wide)
        edges = np.searchsorted(cells, np.arange(first, first + (1 << (bits - wide)) + 1, dtype=_U) << _U(wide))
        block = np.flatnonzero(np.diff(edges))
        starts, ends = edges[block], edges[block + 1]
        block += first
        offsets = (cells & _U((1 << wide) - 1)).astype(np.int32)
        del cells
        gaps = np.empty_like(offsets)
        np.subtract(offsets[1:], offsets[:-1], out=gaps[1:])
        gaps[starts] = offsets[starts]
        del offsets
        coded, at = encode_gaps(gaps)
        for i in range(0, len(starts), 4096):
            raw = [coded[at[x] : at[y]].tobytes() for x, y in zip(starts[i : i + 4096], ends[i : i + 4096], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(block[i : i + 4096], pa.int32()), pa.array(raw, pa.binary())], ["block", "offsets"])


def _twice(docs: DataFrame, hashes: Callable[[list[bytes | None]], np.ndarray], bits: int) -> np.ndarray:
    """One bit per counter: counted twice or more."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, texts in pieces(batches, limit=PIECE):
            held.append(hashes(texts))
            size += len(held[-1])
            if size >= _AT_ONCE:
                h, held, size = np.concatenate(held), [], 0
                yield from _gaps(h, bits)
                del h
        if size:
            yield from _gaps(np.concatenate(held), bits)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by block, so that a task holds the counters of one block.
        open_block, counts = None, np.zeros(1 << block_bits(bits), np.uint8)

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([open_block], pa.int32()), pa.array([np.packbits(counts > 1, bitorder="little").tobytes()], pa.binary())], ["block", "twice"])

        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != open_block:
                    if open_block is not None:
                        yield full()
                    open_block = b
                    counts[:] = 0
                add(counts, decode_gaps(np.frombuffer(raw, np.uint8)))
        if open_block is not None:
            yield full()

    parts = docs.select("text").mapInArrow(partial, "block int, offsets binary")
    rows = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merged, "block int, twice binary").toArrow()
    out = np.zeros(ROWS << (bits - 3), np.uint8)
    size = 1 << (block_bits(bits) - 3)
    for b, raw in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
        out[b * size : (b + 1) * size] = np.frombuffer(raw, np.uint8)
    return out


class Sketch:
    """Merged sketch that tasks can ask whether a hash may occur twice."""

    def __init__(self, bits: int, shared):
        self.bits, self.shared = bits, shared

    @classmethod
    def of(cls, docs: DataFrame, hashes: Callable[[list[bytes | None]], np.ndarray], bytes_per_hash: int) -> Sketch:
        """`bytes_per_hash` is the least text that makes a hash on average; it sets the size, and with it the cost but never the result."""
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        bits = bits_for(total // bytes_per_hash)
        return cls(bits, docs.sparkSession.sparkContext.broadcast(_twice(docs, hashes, bits)))

    def close(self) -> None:
        """Free the bits in all workers, once what was asked is stored."""
        self.shared.destroy()

    def twice(self, h: np.ndarray) -> np.ndarray:
        """False only for hashes that occur once."""
        ok = np.ones(len(h), bool)
        for row in range(ROWS):
            c = _cells(h, row, self.bits).astype(np.int64)
            ok &= (self.shared.value[c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
        return ok
