"""Texts of Arrow batches in bounded pieces, and vectorised word hashes over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single text is a piece of its own.
PIECE_BYTES = 1 << 20
_PIECE_ROWS = 1 << 14

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches whose texts hold about `limit` bytes, with the texts as UTF-8 (None for null).

    Texts leave Arrow slice by slice, so that Python holds one slice of them and not a batch.
    """
    for batch in batches:
        held = column(batch, text).cast(pa.binary())
        sizes = pc.binary_length(held).fill_null(0).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            count = max(1, int(np.searchsorted(np.cumsum(sizes[start : start + _PIECE_ROWS], dtype=np.int64), limit, side="right")))
            yield batch.slice(start, count), held.slice(start, count).to_pylist()
            start += count


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash (the splitmix constants)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _STEP + _U(seed))


class Powers:
    """Powers of the base and of its inverse, as far as they have been needed."""

    def __init__(self) -> None:
        self._up = self._down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(n, 2 * len(self._up))
            with np.errstate(over="ignore"):
                self._up = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, _BASE, _U)]), dtype=_U)
                self._down = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, _INVERSE, _U)]), dtype=_U)
        return self._up[:n], self._down[:n]


POWERS = Powers()
BYTE_HASH = _table(7)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes; those of data[a:b] are `span_hashes(prefix, a, b)`."""
    up, _ = POWERS.upto(len(data))
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(BYTE_HASH[data] * up, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    _, down = POWERS.upto(len(prefix))
    return mix((prefix[b] - prefix[a]) * down[a] + (b - a).astype(_U))


class Words:
    """Words of several texts: hash, start and end byte in `data`, and first word of each text.

    Words are `[^\\x20\\x09-\\x0D]+`, or the runs between the bytes that `space` marks (a table of 256, line feed included).
    """

    def __init__(self, texts: list[bytes | None], lower: bool = False, space: np.ndarray = _SPACE):
        joined = b"\n".join(t or b"" for t in texts)
        self.data = np.frombuffer(joined, np.uint8)
        if lower:
            self.data = _LOWER[self.data]
        sizes = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        word = np.zeros(len(self.data) + 2, np.int8)
        word[1:-1] = ~space[self.data]
        edge = np.diff(word)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.hash = span_hashes(prefix_hashes(self.data), self.start, self.end) if len(self.start) else np.zeros(0, _U)
        self.first = np.searchsorted(self.start, np.concatenate([self.text_start, [len(self.data) + 1]]))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n consecutive words of one text, and the index of the text of each. Window i of a text starts at its word i."""
        at, owner = self.places(n)
        return self.joined(at, n), owner

    def places(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word of each run of n consecutive words of one text, and the index of its text."""
        counts = np.maximum(self.counts() - n + 1, 0)
        owner = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + self.first[:-1][owner]
        return at, owner

    def joined(self, at: np.ndarray, n: int) -> np.ndarray:
        h = np.full(len(at), n, _U)
        for k in range(n):
            h = mix(h * _STEP + self.hash[at + k])
        return h

    def shingles(self, n: int) -> list[np.ndarray]:
        """Per text, the sorted distinct hashes of its n-word shingles; with fewer words, of the whole sequence."""
        h, owner = self.windows(n)
        bounds = np.searchsorted(owner, np.arange(len(self.first)))
        out = []
        for i, count in enumerate(self.counts()):
            if count >= n:
                out.append(np.unique(h[bounds[i] : bounds[i + 1]]))
            elif count:
                out.append(self.joined(self.first[i : i + 1], int(count)))
            else:
                out.append(np.zeros(0, _U))
        return out
