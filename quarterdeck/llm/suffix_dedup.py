"""Suffix-array dedup of long byte strings: hash-compared suffix sort over candidate places.

Which byte strings of `LENGTH` bytes occur twice anywhere is a question about all suffixes. Two steps make it a job
of many small sorts without losing a pair:

* Every window of LENGTH bytes has an anchor, its 64-byte gram of the smallest hash (leftmost of equals). Equal windows have
  equal anchors at equal distances, so only windows under an anchor that occurs twice can repeat (a sketch of all
  anchors drops most of the others early). Windows of one anchor place are consecutive; the bytes they cover are the anchor's context. Equal contexts are counted once.
* Contexts that share an anchor are sorted suffix by suffix: prefix polynomial hashes give the common extension of
  two suffixes by binary search, so a comparison takes log(LENGTH) steps, and a bottom-up mergesort merges runs by binary search
  with that comparison. Neighbours in the order that agree in LENGTH bytes, verified byte by byte, are repeats.

Suffixes are compared inside (anchor, distance) groups only. A group with more than `GROUP` contexts is not sorted: its
windows are counted by a 128-bit digest, with partial sums, and looked up again, so no task holds a whole hot group
even if all of it is one window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import column, pieces, prefix_hashes, span_hashes
from quarterdeck.llm.flags import flagged, only_flagged
from quarterdeck.llm.sketch import Sketch
from quarterdeck.session import materialise

LENGTH = 200
GRAM = 64
#: Contexts of one anchor that one sort takes; the windows of larger groups are counted by digest.
GROUP = 1000
_U = np.uint64
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: anchor hashes, their places, first window and number of windows of each, and the prefix hashes.

    The anchor of a window is the gram with the smallest high half of its hash, the leftmost of equals.
    """
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = span_hashes(prefix, at, at + GRAM)
    key = (gram >> _U(32) << _U(32)) | at.astype(_U)
    span = LENGTH - GRAM + 1  # grams in a window
    n = len(gram) - span + 1
    padded = np.concatenate([key, np.full(-len(key) % span, _FULL, _U)]).reshape(-1, span)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(right[:n], left[span - 1 : span - 1 + n]) & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return gram[place[first]], place[first], first, np.diff(np.append(first, n)), prefix


def _long(t: bytes | None) -> bool:
    return t is not None and len(t) >= LENGTH


def _anchor_hashes(texts: list[bytes | None]) -> np.ndarray:
    found = [anchors(np.frombuffer(t, np.uint8))[0] for t in texts if _long(t)]
    return np.concatenate(found) if found else np.zeros(0, _U)


def places(docs: DataFrame, sketch: Sketch) -> DataFrame:
    """Anchor places of the distinct texts whose anchor may occur twice: tid, anchor, context, first, n, back, copies.

    `context` is the hash of all bytes under the windows of the place, `back` the distance from its first window to
    the anchor, `copies` the number of rows with that text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for t, tid in zip(texts, column(batch, "tid").to_pylist(), strict=True):
                if not _long(t):
                    continue
                h, place, first, n, prefix = anchors(np.frombuffer(t, np.uint8))
                ok = np.flatnonzero(sketch.twice(h))
                h, place, first, n = h[ok], place[ok], first[ok], n[ok]
                context = span_hashes(prefix, first, first + n + LENGTH - 1)
                for c, v in zip(cols, (np.full(len(h), tid, np.int64), h.view(np.int64), context.view(np.int64), first, n, place - first), strict=True):
                    c.append(v)
            if cols[0]:
                kinds = [pa.int64()] * 3 + [pa.int32()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(cols, kinds, strict=True)], ["tid", "anchor", "context", "first", "n", "back"])

    found = docs.select("text", F.xxhash64("text").alias("tid")).mapInArrow(run, "tid bigint, anchor bigint, context bigint, first int, n int, back int")
    return found.groupBy("tid", "anchor", "context", "first", "n", "back").agg(F.count("*").alias("copies"))


def _extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common extension of the suffixes at a and b, up to `most` bytes: binary search on prefix hashes."""
    lo, hi = np.zeros(len(a), np.int64), most.copy()
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = span_hashes(prefix, a, a + mid) == span_hashes(prefix, b, b + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return lo


def _before(data: np.ndarray, prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the suffix at a sorts before the one at b by its first LENGTH bytes (false for equals)."""
    k = _extension(prefix, a, b, np.full(len(a), LENGTH))
    at = np.minimum(k, LENGTH - 1)
    return (k < LENGTH) & (data[a + at] < data[b + at])


def sort_suffixes(data: np.ndarray, prefix: np.ndarray, group: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Order of the suffixes at `start` inside each group (group is sorted): bottom-up mergesort of all groups together."""
    n = len(start)
    order, bounds = np.arange(n), np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    base = np.repeat(bounds[:-1], np.diff(bounds))  # first index of the own group
    stop = np.repeat(bounds[1:], np.diff(bounds))
    width, widest = 1, int(np.diff(bounds).max()) if n else 0
    while width < widest:
        here = np.arange(n)
        run = (here - base) // width
        mine = base + run * width
        other = np.where(run % 2 == 0, mine + width, mine - width)
        lo, hi = np.minimum(other, stop), np.minimum(other + width, stop)
        left = run % 2 == 0
        origin = lo.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            x, y = start[order[here[open_]]], start[order[mid]]
            # Equal suffixes keep the left run first.
            ahead = np.where(left[open_], _before(data, prefix, y, x), ~_before(data, prefix, x, y))
            lo[open_], hi[open_] = np.where(ahead, mid + 1, lo[open_]), np.where(ahead, hi[open_], mid)
        rank = here - mine + (lo - origin)
        at = np.where(left, mine, np.minimum(other, stop)) + rank
        new = np.empty(n, np.int64)
        new[at] = order
        order, width = new, 2 * width
    return order


def repeats(data: np.ndarray, group: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For suffixes in sorted groups: whether another of the group has the same first LENGTH bytes."""
    prefix = prefix_hashes(data)
    order = sort_suffixes(data, prefix, group, start)
    a, b = start[order[:-1]], start[order[1:]]
    close = np.flatnonzero((group[order[:-1]] == group[order[1:]]))
    k = _extension(prefix, a[close], b[close], np.full(len(close), LENGTH))
    close = close[k >= LENGTH]
    same = np.ones(len(close), bool)
    for i in range(0, len(close), 4096):  # collision check on the bytes themselves
        x, y = a[close[i : i + 4096], None] + np.arange(LENGTH), b[close[i : i + 4096], None] + np.arange(LENGTH)
        same[i : i + 4096] = (data[x] == data[y]).all(axis=1)
    out = np.zeros(len(start), bool)
    out[order[close[same]]] = True
    out[order[close[same] + 1]] = True
    return out


def _with_places(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """text and `places` of the texts with contexts in `wanted` (tid, anchor, context, first, n, back)."""
    lists = wanted.groupBy("tid").agg(F.collect_list(F.struct("anchor", "context", "first", "n", "back")).alias("places"))  # places of one text
    texts = docs.where(F.octet_length("text") >= LENGTH).select(F.xxhash64("text").alias("tid"), "text")
    texts = only_flagged(texts, wanted.select("tid").distinct(), ["tid"]).dropDuplicates(["tid"])
    return texts.join(lists, "tid").select("text", "places")


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of the contexts in `wanted` (tid, anchor, context, first, n, back)."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
    names = ["anchor", "context", "bytes", "n", "back"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch, texts in pieces(batches):
            for t, at in zip(texts, column(batch, "places").to_pylist(), strict=True):
                for p in at:
                    a, n = p["first"], p["n"]
                    if a + n + LENGTH - 1 > len(t):
                        continue  # another text with the same hash
                    out.append((p["anchor"], p["context"], t[a : a + n + LENGTH - 1], n, p["back"]))
                if len(out) > 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return _with_places(docs, wanted).mapInArrow(run, "anchor bigint, context bigint, bytes binary, n int, back int")


def _counted_groups(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, context, hits): what `_sorted_groups` gives, a row per window, of groups of any size.

    Equal windows have equal anchors at equal distances, so one context holds a window once, and one that is counted
    twice is a repeat. Only sums per task are shuffled for the count, and repeated windows for the look-up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            for t, at in zip(texts, column(batch, "places").to_pylist(), strict=True):
                for p in at:
                    a, n = p["first"], p["n"]
                    if a + n + LENGTH - 1 > len(t):
                        continue  # another text with the same hash
                    digests = [hashlib.blake2b(t[i : i + LENGTH], digest_size=16).digest() for i in range(a, a + n)]
                    hits = np.arange(n, dtype=np.int32).tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p["anchor"]] * n, pa.int64()), pa.array([p["context"]] * n, pa.int64()), pa.array(digests, pa.binary()), pa.array([hits[4 * i : 4 * i + 4] for i in range(n)], pa.binary())],
                        ["anchor", "context", "digest", "hits"],
                    )

    texts = materialise(_with_places(docs, wanted), "hot_texts")
    windows = texts.mapInArrow(run, "anchor bigint, context bigint, digest binary, hits binary")
    repeated = materialise(windows.groupBy("digest").agg(F.count("*").alias("c")).where("c > 1").select("digest"), "repeated")
    return only_flagged(windows, repeated, ["digest"]).join(repeated, "digest").select("anchor", "context", "hits")


def _judged(rows: list[tuple]) -> pa.RecordBatch:
    """Repeated windows of rows (anchor, context, bytes, n, back) that hold whole groups."""
    data = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
    offset = np.cumsum([0] + [len(r[2]) for r in rows])[:-1]
    n = np.array([r[3] for r in rows])
    row, ends = np.repeat(np.arange(len(rows)), n), np.cumsum(n)
    windows = np.arange(len(row)) - (ends - n)[row]
    number = np.cumsum([0] + [rows[i][0] != rows[i - 1][0] for i in range(1, len(rows))])
    key = number[row] * LENGTH + np.array([r[4] for r in rows])[row] - windows  # group and distance to the anchor
    by = np.argsort(key, kind="stable")
    hit = np.empty(len(by), bool)
    hit[by] = repeats(data, key[by], (offset[row] + windows)[by])
    out = [np.flatnonzero(hit[b - k : b]).astype(np.int32).tobytes() for b, k in zip(ends, n, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(out, pa.binary())], ["anchor", "context", "hits"])


def _sorted_groups(contexts: DataFrame) -> DataFrame:
    """(anchor, context, hits): per context, the windows that repeat in another context of the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > (1 << 20) and r[0] != held[-1][0]:
                    yield _judged(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[2])
        if held:
            yield _judged(held)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "anchor bigint, context bigint, hits binary").where(F.octet_length("hits") > 0)


def repeated_places(docs: DataFrame) -> DataFrame:
    """Per distinct text: `marks`, the places with repeated windows (first, n, context, whole, hits)."""
    sketch = Sketch.of(docs, _anchor_hashes, GRAM)
    found = materialise(places(docs, sketch), "places")
    sketch.close()
    classes = found.groupBy("anchor", "context").agg(F.sum("copies").alias("copies"), F.min(F.struct("tid", "first", "n", "back")).alias("at"))
    classes = materialise(classes, "contexts")
    groups = classes.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor", (F.col("k") > GROUP).alias("hot"))
    wanted = materialise(classes.join(groups, "anchor").select("anchor", "context", "at.*", "hot"), "wanted")
    hits = _sorted_groups(_contexts(docs, wanted.where("NOT hot")))
    hot = wanted.where("hot")
    if not hot.isEmpty():
        hits = hits.unionByName(_counted_groups(docs, hot))
    hits = materialise(hits, "hits").groupBy("anchor", "context").agg(F.collect_list("hits").alias("hits"))  # windows of one context
    whole = classes.where("copies > 1").select("anchor", "context", F.lit(True).alias("whole"))
    marked = whole.join(hits, ["anchor", "context"], "full")
    rows = found.join(marked, ["anchor", "context"])
    return rows.groupBy("tid").agg(F.collect_list(F.struct("first", "n", "context", F.coalesce("whole", F.lit(False)).alias("whole"), F.when(F.col("whole"), None).otherwise(F.col("hits")).alias("hits"))).alias("marks"))


def removed_bytes(text: bytes, marks: list[dict]) -> np.ndarray:
    edge = np.zeros(len(text) + 1, np.int64)
    prefix = prefix_hashes(np.frombuffer(text, np.uint8))
    for m in marks:
        a, n = m["first"], m["n"]
        end = a + n + LENGTH - 1
        if end > len(text) or int(span_hashes(prefix, np.array([a]), np.array([end])).view(np.int64)[0]) != m["context"]:
            continue  # another text with the same hash
        if m["whole"]:
            edge[a] += 1
            edge[end] -= 1
        else:
            w = a + np.concatenate([np.frombuffer(h, np.int32) for h in m["hits"]])
            np.add.at(edge, w, 1)
            np.add.at(edge, w + LENGTH, -1)
    return np.cumsum(edge)[:-1] > 0


def remove(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_removed, n_spans, `kept` (the bytes that stay), kept_sha256.

    A byte goes if a string of LENGTH bytes that covers it also starts at another place of any row, the same row
    included. Null texts count as empty; shorter texts lose nothing. Repeated rows repeat each other's bytes. Ids may be
    null or repeated: only texts are compared. Other columns are not read.
    """
    marks = materialise(repeated_places(docs), "marks")
    rows = flagged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tid")), marks, ["tid"])
    touched = rows.where("_flag").drop("_flag").join(marks, "tid", "left")
    joined = touched.unionByName(rows.where("NOT _flag").drop("_flag").withColumn("marks", F.lit(None).cast(marks.schema["marks"].dataType)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            cols: list[list] = [[], [], [], [], []]
            for t, m in zip(texts, column(batch, "marks").to_pylist(), strict=True):
                t = t or b""
                gone = removed_bytes(t, m) if m else np.zeros(len(t), bool)
                kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
                spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                for c, v in zip(cols, (len(t), int(gone.sum()), spans, kept, hashlib.sha256(kept).hexdigest()), strict=True):
                    c.append(v)
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
