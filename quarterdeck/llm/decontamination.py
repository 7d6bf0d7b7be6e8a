"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

The benchmark is a query set against all documents, taken in blocks of about `BLOCK_ITEMS` items, each of which
is broadcast. For an item of n words the windows of a document are its stretches of n words (the whole document if it
has fewer). A window is a bag of 5-word shingles; its SimHash sums the signed bits of its shingles, each as often as it
occurs, from running sums. Fingerprints are cut into eight bytes: two fingerprints within `RADIUS` = 20 bits differ by
at most two bits in one of the bytes, so tables of all bytes within two bits find every item in the radius.
Candidates are verified by the weighted Jaccard similarity of the bags (sum of smaller over sum of larger counts).

A pair of similarity 0.8 has an expected distance of about 10 bits with a deviation of 3; the radius is wide enough
for all but a few in ten thousand. Only windows that hold at least one shingle of an item of their size are
looked at; a window without one has similarity 0.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import Words, column, pieces

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCK_ITEMS = 2000
_U = np.uint64
_NEAR = np.array([[bin(a ^ b).count("1") <= RADIUS // 8 for b in range(256)] for a in range(256)])


def _running(shingles: np.ndarray) -> np.ndarray:
    """Sums of signed bits of all prefixes of a sequence of shingle hashes."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of signed sums, as eight bytes each."""
    return np.packbits(sums > 0, axis=1, bitorder="little")


class Items:
    """Benchmark items of one block, by their number of words."""

    def __init__(self, ids: list, texts: list[bytes]):
        w = Words(texts, lower=True)
        self.by_size: dict[int, list[int]] = defaultdict(list)
        self.ids, self.bags, prints = ids, [], []
        owners: dict[int, set[int]] = defaultdict(set)
        for i, n in enumerate(w.counts().tolist()):
            sh = self.sequence(w, i)
            self.bags.append(Counter(sh.tolist()))
            prints.append(_fingerprints(_running(sh)[-1:])[0] if n else np.zeros(8, np.uint8))
            if n:
                self.by_size[n].append(i)
                for h in self.bags[-1]:
                    owners[h].add(n)
        self.known = np.array(sorted(owners), _U)
        self.sizes = [sorted(owners[h]) for h in self.known.tolist()]
        self.tables = {n: (np.array(at), np.stack([prints[i] for i in at])) for n, at in self.by_size.items()}

    @staticmethod
    def sequence(w: Words, i: int) -> np.ndarray:
        """Shingle hashes of a text in order; of fewer words, the whole sequence as one."""
        n = int(w.first[i + 1] - w.first[i])
        if n < SHINGLE:
            return w.joined(w.first[i : i + 1], n) if n else np.zeros(0, _U)
        return w.joined(np.arange(w.first[i], w.first[i + 1] - SHINGLE + 1), SHINGLE)

    def search(self, texts: list[bytes | None]) -> list[list[tuple]]:
        """Per text: (item id, similarity, first word, words of the window) of each item found, at its best window."""
        w = Words(texts, lower=True)
        out: list[list[tuple]] = [[] for _ in texts]
        if not len(self.known):
            return out
        h, owner = w.windows(SHINGLE)
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        hits = np.flatnonzero(self.known[at] == h)
        touched = set(owner[hits].tolist()) | set(np.flatnonzero((w.counts() > 0) & (w.counts() < SHINGLE)).tolist())
        for i in sorted(touched):
            mine = h[bounds[i] : bounds[i + 1]]
            if not len(mine):
                mine = self.sequence(w, i)
            out[i] = self._in_text(mine, int(w.first[i + 1] - w.first[i]))
        return out

    def _in_text(self, sh: np.ndarray, words: int) -> list[tuple]:
        at = np.minimum(np.searchsorted(self.known, sh), len(self.known) - 1)
        places: dict[int, list[int]] = defaultdict(list)
        for p in np.flatnonzero(self.known[at] == sh).tolist():
            for n in self.sizes[at[p]]:
                places[n].append(p)
        running = _running(sh) if places else None
        best: dict[int, tuple] = {}
        for n, hit in places.items():
            if n < SHINGLE and words != n:
                continue  # so short an item is sought as a whole document
            m = min(len(sh), max(1, n - SHINGLE + 1))
            last = len(sh) - m
            near = np.zeros(len(sh) + 1, np.int64)
            lo = np.maximum(0, np.array(hit) - m + 1)
            np.add.at(near, np.minimum(lo, last), 1)
            np.add.at(near, np.minimum(np.array(hit), last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(near)[:-1] > 0)
            rows, prints = self.tables[n]
            for k in range(0, len(starts), 8192):
                part = starts[k : k + 8192]
                found = _fingerprints(running[part + m] - running[part])
                for s, r in self._within(found, prints):
                    item, start = int(rows[r]), int(part[s])
                    sim = self._similarity(sh[start : start + m], item)
                    if sim >= SIMILARITY and (item not in best or (-sim, start) < (-best[item][0], best[item][1])):
                        best[item] = (sim, start, min(n, words))
        return [(self.ids[i], *v) for i, v in sorted(best.items())]

    @staticmethod
    def _within(found: np.ndarray, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) with fingerprints within the radius: byte tables propose, the full distance decides."""
        for a in range(0, len(prints), 64):
            block = prints[a : a + 64]
            maybe = np.zeros((len(found), len(block)), bool)
            for b in range(8):
                maybe |= _NEAR[:, block[:, b]][found[:, b]]
            s, r = np.nonzero(maybe)
            far = np.bitwise_count(found[s] ^ block[r]).sum(axis=1)
            for x, y in zip(s[far <= RADIUS].tolist(), r[far <= RADIUS].tolist(), strict=True):
                yield x, a + y

    def _similarity(self, sh: np.ndarray, item: int) -> float:
        bag, other = Counter(sh.tolist()), self.bags[item]
        both = sum((bag & other).values())
        return both / (bag.total() + other.total() - both)


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    rows = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    n = -(-rows.count() // BLOCK_ITEMS)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toArrow()
        yield Items(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist())


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): every item that a document holds, at its best window.

    Letters A-Z are compared in lower case. Null, empty and wordless texts and items match nothing. Items of fewer than
    five words match only a whole document of the same words. Rows that repeat a doc_id give rows each.
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, similarity double, first_word bigint, n_words bigint"
    out = spark.createDataFrame([], schema)
    for items in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, texts in pieces(batches):
                ids = column(batch, "doc_id").to_pylist()
                rows = [(d, *r) for d, found in zip(ids, shared.value.search(texts), strict=True) for r in found]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "item_id", "similarity", "first_word", "n_words"])

        out = out.unionAll(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no item; columns as they were."""
    spark = docs.sparkSession
    for items in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, texts in pieces(batches):
                yield batch.filter(pa.array([not r for r in shared.value.search(texts)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
