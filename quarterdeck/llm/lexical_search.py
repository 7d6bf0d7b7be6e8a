"""Ranked lexical search: items times documents as dense blocked matrix products in float64.

The terms of a block of items are its compact vocabulary. One pass over the documents gives the corpus counts (documents,
terms, documents per vocabulary term). A second pass turns documents into tiles of integer impacts and multiplies the
weight tiles of the items with them by BLAS. All factors are whole numbers; a product is split over the vocabulary
so that no sum passes 2**53, where float64 is still exact, and the parts are added in 64-bit integers.

A task holds the ten best documents of each item and tests a tile against the tenth score, equal scores included,
so ties are settled by id and never by the order in which tiles come. Tasks' lists are merged in two steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import Words, column, pieces

TOP = 10
#: Bytes of item text in one block: it bounds what the driver holds and sends, and each block reads the documents twice.
BLOCK_BYTES = 4 << 20
#: Cells of one dense tile (8 bytes each).
TILE_CELLS = 1 << 21
#: Items in one product.
ITEM_TILE = 1024
#: No partial sum may pass it.
EXACT = 1 << 53
#: An impact is a quotient of 1000000000 * tf by more than 1000 * tf.
MOST_IMPACT = 1_000_000
#: Lists of tasks are merged in so many groups an item first.
MERGES = 64
_NO_ID = np.iinfo(np.int64).min
_ENDS = 8

_OUTSIDE = np.ones(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _OUTSIDE[_a : _b + 1] = False


def terms(texts: list[bytes | None]) -> Words:
    """Terms `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, A-Z in lower case."""
    return Words(texts, lower=True, space=_OUTSIDE)


def _ends(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """First and last eight bytes (zero where it is shorter) and length of each word."""
    step = np.arange(_ENDS)
    padded = np.concatenate([data, np.zeros(_ENDS, np.uint8)])
    head = np.where(step < (end - start)[:, None], padded[start[:, None] + step], 0)
    tail = np.where(step < (end - start)[:, None], padded[np.maximum(end[:, None] - 1 - step, 0)], 0)
    both = np.ascontiguousarray(np.concatenate([head, tail], axis=1).astype(np.uint8)).view(np.uint64)
    return np.column_stack([both, (end - start).astype(np.uint64)])


class Block:
    """Items with their distinct terms, as places in the sorted vocabulary of the block."""

    def __init__(self, texts: list[list[bytes | None]]):
        parts = [terms(t) for t in texts]
        owner = np.repeat(np.arange(len(parts)), [len(p.hash) for p in parts])
        hashes = np.concatenate([p.hash for p in parts]) if parts else np.zeros(0, np.uint64)
        ends = np.concatenate([_ends(p.data, p.start, p.end) for p in parts]) if parts else np.zeros((0, 3), np.uint64)
        self.hash, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        self.ends = ends[first]
        if not (ends == self.ends[place]).all():
            raise ValueError("two terms of the items share a hash")
        pairs = np.unique(owner * max(1, len(self.hash)) + place)
        self.item, self.term = np.divmod(pairs, max(1, len(self.hash)))
        self.items = len(parts)

    def of(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary place and text of each term occurrence that the vocabulary holds."""
        if not len(self.hash) or not len(w.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hash, w.hash), len(self.hash) - 1)
        hit = np.flatnonzero(self.hash[at] == w.hash)
        hit = hit[(_ends(w.data, w.start[hit], w.end[hit]) == self.ends[at[hit]]).all(axis=1)]
        return at[hit], np.searchsorted(w.first, hit, side="right") - 1


def _counts(docs: DataFrame, shared) -> dict[int, int]:
    """Documents that hold each vocabulary term; at -1 the documents with a term, at -2 all terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        df = np.zeros(len(block.hash), np.int64)
        some = total = 0
        for _, texts in pieces(batches):
            w = terms(texts)
            place, owner = block.of(w)
            pairs = np.unique(owner * max(1, len(df)) + place)
            df += np.bincount(pairs % max(1, len(df)), minlength=len(df))[: len(df)]
            some += int((w.counts() > 0).sum())
            total += len(w.hash)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2]), pa.int64()), pa.array(np.append(df[at], [some, total]), pa.int64())], ["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True))


class Best:
    """The TOP highest (score, smallest id) of each item so far."""

    def __init__(self, items: int):
        self.score, self.doc = np.zeros((items, TOP), np.int64), np.full((items, TOP), np.iinfo(np.int64).max)

    def add(self, scores: np.ndarray, first: int, docs: np.ndarray) -> None:
        """Scores of the items from `first` on (rows) and `docs` (columns)."""
        held = slice(first, first + len(scores))
        item, at = np.nonzero((scores >= self.score[held, -1:]) & (scores > 0))
        if not len(item):
            return
        rows = np.unique(item)
        every = np.concatenate([item, np.repeat(rows, TOP)])
        score = np.concatenate([scores[item, at], self.score[held][rows].ravel()])
        doc = np.concatenate([docs[at], self.doc[held][rows].ravel()])
        order = np.lexsort((doc, -score, every))
        begin = np.searchsorted(every[order], rows)
        take = order[begin[:, None] + np.arange(TOP)]
        self.score[first + rows], self.doc[first + rows] = score[take], doc[take]


def _best(docs: DataFrame, shared, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(item, score, doc_id): the best documents of each item in each task."""
    # A sum of so many products stays below EXACT.
    width = max(1, min(TILE_CELLS // ITEM_TILE, EXACT // max(1, int(weights.max(initial=1)) * MOST_IMPACT)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best = Best(block.items)
        bounds = np.searchsorted(block.item, np.arange(block.items + 1))
        for batch, texts in pieces(batches):
            ids = column(batch, "doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            w = terms(texts)
            place, owner = block.of(w)
            if not len(place):
                continue
            pairs, tf = np.unique(owner * len(block.hash) + place, return_counts=True)
            owner, place = np.divmod(pairs, len(block.hash))
            m = 10 + 90 * w.counts()[owner] * n_docs // n_terms
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * m)
            used = np.unique(place)  # columns of this piece
            at = np.searchsorted(used, place)
            rows = np.unique(owner)
            row = np.searchsorted(rows, owner)
            high = max(1, TILE_CELLS // min(width, len(used)))
            for top in range(0, block.items, ITEM_TILE):
                own = slice(bounds[top], bounds[min(top + ITEM_TILE, block.items)])
                col = np.minimum(np.searchsorted(used, block.term[own]), len(used) - 1)
                known = used[col] == block.term[own]
                item, col, weight = block.item[own][known] - top, col[known], weights[block.term[own][known]]
                n = min(ITEM_TILE, block.items - top)
                for r in range(0, len(rows), high):
                    here = slice(*np.searchsorted(row, [r, r + high]))
                    docs_here = min(high, len(rows) - r)
                    scores = np.zeros((n, docs_here), np.int64)
                    for c in range(0, len(used), width):
                        wide = min(width, len(used) - c)
                        left, right = np.zeros((n, wide)), np.zeros((docs_here, wide))
                        a, b = (col >= c) & (col < c + wide), (at[here] >= c) & (at[here] < c + wide)
                        left[item[a], col[a] - c] = weight[a]
                        right[row[here][b] - r, at[here][b] - c] = impact[here][b]
                        scores += (left @ right.T).astype(np.int64)
                    best.add(scores, top, ids[rows[r : r + docs_here]])
        item, k = np.nonzero(best.score)
        found = best.doc[item, k]
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(best.score[item, k], pa.int64()), pa.array(found, pa.int64(), mask=found == _NO_ID)], ["item", "score", "doc_id"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "item bigint, score bigint, doc_id bigint")


def _top(rows: DataFrame, *keys: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP)


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score: per item of `items` (item_id, text) its TOP documents with a score above 0.

    Equal scores go by ascending doc_id. A null text has no terms; an item without terms, or whose terms no document
    holds, has no rows. Every row of `docs` is a document: repeated rows are ranked each, a null doc_id comes before
    others of the same score. Rows of `items` that share an item_id are one item with the terms of all; a null
    item_id is an item as well. Empty tables give no rows. Very long texts are a tile of their own. Other columns
    are not read. Items are taken in blocks of about BLOCK_BYTES; each block reads all documents.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = []
    for b in range(blocks):
        held: dict[int | None, list[bytes]] = {}
        for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).where("text IS NOT NULL").toArrow().to_pylist():  # about BLOCK_BYTES
            held.setdefault(r["item_id"], []).append(r["text"].encode())
        block = Block(list(held.values()))
        shared = spark.sparkContext.broadcast(block)
        counts = _counts(docs, shared)
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(block.hash))], np.int64)
        merged = _top(_top(_best(docs, shared, weights, n_docs, n_terms).withColumn("part", F.spark_partition_id() % MERGES), "item", "part").drop("rank"), "item")
        ids = spark.createDataFrame([(i, k) for i, k in enumerate(held)], "item bigint, item_id bigint")
        out.append(merged.join(ids, "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, out)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
tf AS MATERIALIZED (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY ALL),
q AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark WHERE text IS NOT NULL),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * coalesce(df, 0) + 1)))::BIGINT AS w FROM (SELECT DISTINCT t FROM q) LEFT JOIN (SELECT t, count(*) AS df FROM tf GROUP BY t) USING (t), s),
p AS (SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(ts) * n_docs) // n_terms))))::BIGINT AS score FROM q JOIN w USING (t) JOIN tf USING (t) JOIN d USING (r), s GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM p JOIN d USING (r) WHERE score > 0)
WHERE rank <= {TOP}
"""
