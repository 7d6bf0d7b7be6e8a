"""Substring dedup: a count-min sketch finds the windows that may repeat, exact grouping decides them.

Pass 1 counts all windows of `WINDOW` words in partition sketches and merges them (sketch.py). Pass 2 sends only
windows that the merged sketch estimates repeated as (hash, doc_id), finds the smallest doc_id of each, and
returns to each document the hashes that start in a smaller one. A last pass over the texts removes what those
windows cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import Words, column, pieces
from quarterdeck.llm.flags import flagged
from quarterdeck.llm.sketch import PIECE, Sketch
from quarterdeck.session import materialise

WINDOW = 13
#: Sizes the sketch.
BYTES_PER_WORD = 6
_U = np.uint64


def _window_hashes(texts: list[bytes | None]) -> np.ndarray:
    """Hashes of the windows of each text, once per text: only windows of several documents have to count twice."""
    h, owner = Words(texts).windows(WINDOW)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return np.concatenate([np.unique(h[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """doc_id and `hashes` (64-bit): the windows of the document that also start in a smaller doc_id."""
    sketch = Sketch.of(docs, _window_hashes, BYTES_PER_WORD)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, limit=PIECE):
            w = Words(texts)
            at, owner = w.places(WINDOW)
            h = w.joined(at, WINDOW)
            ok = np.flatnonzero(sketch.twice(h))
            # Once per text, in the order of texts and hashes.
            ok = ok[np.lexsort((h[ok], owner[ok]))]
            ok = ok[np.diff(h[ok], prepend=_U(0)).astype(bool) | np.diff(owner[ok], prepend=-1).astype(bool)]
            ids = column(batch, "doc_id").to_numpy(zero_copy_only=False)[owner[ok]].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h[ok].view(np.int64)), pa.array(ids)], ["h", "doc_id"])

    found = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(candidates, "h bigint, doc_id bigint")
    # Read twice rather than stored: the rows are as many bytes as a shuffle of them.
    first = found.groupBy("h").agg(F.min("doc_id").alias("first"))
    late = found.join(first, "h").where("doc_id > first").select("doc_id", "h")
    # Rows that repeat a doc_id may hold the same windows: a set, not a list.
    out = materialise(late.groupBy("doc_id").agg(F.collect_set("h").alias("hashes")), "late-windows")
    sketch.close()
    return out


def remove(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_removed, `kept` (the words that stay, joined by one space), kept_sha256.

    A word goes if a window of 13 words that covers it also starts in a document with a smaller doc_id. Null texts have
    no words. Rows with a null doc_id keep all words and take none from others; rows that share a doc_id are one
    document for the comparison. Other columns are not read.
    """
    late = repeated_windows(docs)
    rows = flagged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), late, ["doc_id"])
    touched = rows.where("_flag").drop("_flag").join(late, "doc_id", "left")
    joined = touched.unionByName(rows.where("NOT _flag").select("doc_id", "text", F.lit(None).cast("array<bigint>").alias("hashes")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, limit=PIECE):
            w = Words(texts)
            h, owner = w.windows(WINDOW)
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            n, removed, kept = w.counts(), [], []
            for i, marks in enumerate(column(batch, "hashes")):
                lo, hi = w.first[i], w.first[i + 1]
                gone = np.zeros(hi - lo, bool)
                if marks.is_valid:
                    hits = np.flatnonzero(np.isin(h[bounds[i] : bounds[i + 1]], marks.values.to_numpy().view(_U)))
                    edge = np.zeros(hi - lo + 1, np.int64)
                    np.add.at(edge, hits, 1)
                    np.add.at(edge, hits + WINDOW, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                base = w.text_start[i]
                text = texts[i] or b""
                kept.append(b" ".join(text[a - base : b - base] for a, b in zip(w.start[lo:hi][~gone].tolist(), w.end[lo:hi][~gone].tolist(), strict=True)))
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")


ORACLE = rf"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS MATERIALIZED (SELECT r, doc_id, i, array_to_string(w[i:i+{WINDOW - 1}], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS MATERIALIZED (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM win JOIN f USING (g) WHERE m < doc_id),
kept AS (SELECT x.r, string_agg(x.w[x.p], ' ' ORDER BY x.p) AS t, count(*) AS k FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM w) x ANTI JOIN gone g ON g.r = x.r AND g.p = x.p GROUP BY x.r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (r)"""
