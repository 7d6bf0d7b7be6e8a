"""Document fingerprints by a randomised edit embedding.

All texts share one random walk: step t reads the character at the pointer and moves on if a random bit of (character
class, t) says so. What the walk reads is the embedding. Texts with a small edit distance fall into step again
after an edit, so their embeddings have a small Hamming distance; and all of a text is read.

A fingerprint samples `SLOTS` steps of the embedding. Each slot has its own chain of record steps (a new record after
step t lies beyond x with probability t / x), and a text takes the last record inside its walk: a uniform choice that texts of similar
length share. Likeness is the share of equal slots; it falls with the Hamming distance and with the difference of
the lengths. `link` finds near copies: bands of slots give buckets, hubs of the buckets give star-shaped candidates, and
the likeness of the whole fingerprints decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import column, mix, pieces
from quarterdeck.llm.near_dedup import components
from quarterdeck.session import materialise

SLOTS = 128
#: Classes of characters that move on together, and period of the random bits.
CLASSES = 16
PERIOD = 1 << 16
#: Bytes of text that walk side by side.
TOGETHER = 4 << 20
#: With fewer texts side by side each one walks alone.
WIDE = 16
#: Text of one sorted partition, and the most partitions.
PART_BYTES = 32 << 20
MOST_PARTS = 1 << 15
#: Slots of a band, and bands: at a likeness of 0.8 all bands miss in 5 of a million cases.
BAND_SLOTS, BANDS = 6, 40
_RECORDS = 64
_U = np.uint64
_NO_ID = -(1 << 63)


def _random(seed: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(np.broadcast_shapes(*(np.shape(p) for p in parts)), seed, _U)
    for p in parts:
        h = mix(h * _U(0x9E3779B97F4A7C15) + np.asarray(p).astype(_U))
    return h


def _stays() -> np.ndarray:
    """For each class and step of the period: steps that a walk spends on a character it reaches then."""
    moves = _random(1, np.arange(CLASSES)[:, None], np.arange(PERIOD)[None, :]) & _U(1)
    twice = np.concatenate([moves, moves], axis=1).astype(bool)
    at = np.where(twice, np.arange(2 * PERIOD), 2 * PERIOD)
    following = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :PERIOD]
    return (following - np.arange(PERIOD) + 1).astype(np.uint8).ravel()


def _records() -> np.ndarray:
    """Record steps of each slot, ascending from 0."""
    out = np.full((SLOTS, _RECORDS), np.iinfo(np.int64).max)
    t = np.ones(SLOTS)
    out[:, 0] = 0
    for r in range(1, _RECORDS):
        u = (_random(2, np.arange(SLOTS), np.int64(r)) >> _U(11)).astype(float) / (1 << 53)
        t = np.ceil(t / np.maximum(u, 1e-12))
        fits = t < 2.0**50
        t = np.minimum(t, 2.0**50)
        out[fits, r] = t[fits].astype(np.int64) - 1
    return np.maximum.accumulate(out, axis=1)


STAYS = _stays()
_STAYS_LIST = STAYS.tobytes()
RECORDS = _records()


def walk(cls: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Step at which each character is reached, and the length of each text's walk. `cls` holds class * PERIOD."""
    reached = np.zeros(len(cls), np.int64)
    order = np.argsort(-size, kind="stable")
    first, left = start[order], size[order]
    t = np.zeros(len(size), np.int64)
    i, active = 0, int((left > 0).sum())
    ascending = np.sort(size)
    while active >= WIDE:
        at = first[:active] + i
        now = t[:active]
        reached[at] = now
        now += STAYS[cls[at] | (now & (PERIOD - 1))]
        i += 1
        active = len(size) - int(np.searchsorted(ascending, i, side="right"))
    for k in range(active):
        step, steps, a, b = int(t[k]), [], int(first[k]) + i, int(first[k] + left[k])
        for c in cls[a:b].tolist():
            steps.append(step)
            step += _STAYS_LIST[c | (step & (PERIOD - 1))]
        reached[a:b] = steps
        t[k] = step
    ends = np.empty(len(size), np.int64)
    ends[order] = t
    return reached, ends


def prints(texts: list[str]) -> np.ndarray:
    """Fingerprints, a row of SLOTS bytes each; that of the empty text is all zero, others have no zero."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    size = np.array([len(p) for p in points], np.int64)
    start = np.cumsum(size) - size
    every = np.concatenate(points) if points else np.zeros(0, np.uint32)
    cls = (_random(3, every) % _U(CLASSES)).astype(np.int64) * PERIOD
    reached, ends = walk(cls, start, size)
    out = np.zeros((len(texts), SLOTS), np.uint8)
    slots = np.arange(SLOTS)
    for k in np.flatnonzero(size):
        step = RECORDS[slots, (RECORDS < ends[k]).sum(axis=1) - 1]
        a, b = start[k], start[k] + size[k]
        read = every[a + np.searchsorted(reached[a:b], step, side="right") - 1]
        out[k] = _random(4, slots, step, read) % _U(255) + _U(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def _strings(texts: list[bytes | None]) -> list[str]:
    return [(t or b"").decode() for t in texts]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, digest (of the text), fp. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in pieces(batches, limit=TOGETHER):
            texts = _strings(raw)
            fp = prints(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.blake2b(t or b"", digest_size=16).digest() for t in raw], pa.binary()),
                    pa.array([x.tobytes() for x in fp], pa.binary()),
                ],
                ["doc_id", "n_chars", "digest", "fp"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_chars bigint, digest binary, fp binary")


_ROW = "doc_id bigint, n_chars bigint, edited_sha256 string, fp binary, edited_fp binary, near_edited double, near_next double"
_ROW_NAMES = ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"]
_ROW_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def edited(text: str, following: str) -> str:
    """`text` with its last half (rounded down) replaced by as many first characters of the next text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: list, texts: list[str], fp: np.ndarray, fp_next: np.ndarray, changed: list[str], fp_changed: np.ndarray) -> list[pa.Array]:
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([x.tobytes() for x in fp], pa.binary()),
        pa.array([x.tobytes() for x in fp_changed], pa.binary()),
        pa.array(likeness(fp, fp_changed), pa.float64()),
        pa.array(likeness(fp, fp_next), pa.float64()),
    ]


def compare_edits(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text takes its second half from the next document by ascending doc_id; the last one's next is the first.
    Null ids come first, rows that share an id go by the hash of their text. Null texts count as empty; two empty texts
    have a likeness of 1, an empty and another one of 0. A single row is its own next. An empty table gives no rows.
    Very long texts walk alone. Other columns are not read.

    Texts are shuffled once, by ranges of doc_id, and read in order; only the last row of a partition waits for the first of the next.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("key"), F.xxhash64("text").alias("th"), "doc_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_PARTS, max(1, -(-size // PART_BYTES)))
    dealt = rows.repartitionByRange(parts, "key", "th").sortWithinPartitions("key", "th").select("doc_id", "text")
    names = [*_ROW_NAMES, "part", "edge", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def edge(kind: str, doc_id, text: str) -> pa.RecordBatch:
            none = [pa.array([doc_id], pa.int64()), *(pa.nulls(1, t) for t in _ROW_TYPES[1:])]
            return pa.RecordBatch.from_arrays([*none, pa.array([part], pa.int32()), pa.array([kind], pa.string()), pa.array([text], pa.string())], names)

        last = None
        for batch, raw in pieces(batches, limit=TOGETHER):
            texts, ids = _strings(raw), column(batch, "doc_id").to_pylist()
            if last is None:
                yield edge("first", ids[0], texts[0])
            before = ([last[1]] if last else []) + texts
            changed = [edited(a, b) for a, b in zip(before, before[1:], strict=False)]
            fp = prints(texts + changed)
            fp, fp_changed = fp[: len(texts)], fp[len(texts) :]
            every = np.concatenate([last[2][None], fp]) if last else fp
            n = len(changed)
            cols = _compared((([last[0]] if last else []) + ids)[:n], before[:n], every[:n], every[1:], changed, fp_changed)
            yield pa.RecordBatch.from_arrays([*cols, pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names)
            last = (ids[-1], texts[-1], fp[-1])
        if last:
            yield edge("last", last[0], last[1])

    found = materialise(dealt.mapInArrow(run, f"{_ROW}, part int, edge string, text string"), "fingerprints")
    # Partitions with rows, in order: MOST_PARTS at most.
    held = [r[0] for r in found.where("edge = 'first'").select("part").orderBy("part").collect()]
    following = spark.createDataFrame(list(zip(held, held[1:] + held[:1], strict=True)), "part int, next int")
    firsts = found.where("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    ends = found.where("edge = 'last'").select("part", "doc_id", "text").join(following, "part").join(firsts, "next").select("doc_id", "text", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in pieces(batches, limit=TOGETHER):
            texts, nexts = _strings(raw), column(batch, "following").to_pylist()
            changed = [edited(a, b) for a, b in zip(texts, nexts, strict=True)]
            fp, fp_next, fp_changed = (prints(x) for x in (texts, nexts, changed))
            cols = _compared(column(batch, "doc_id").to_pylist(), texts, fp, fp_next, changed, fp_changed)
            yield pa.RecordBatch.from_arrays(cols, _ROW_NAMES)

    every = found.where("edge IS NULL").select(*_ROW_NAMES).unionByName(ends.mapInArrow(close, _ROW))
    text = lambda c: F.lower(F.hex(c))
    return every.select("doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next")


def _alike(pairs: DataFrame, least: float) -> DataFrame:
    """(a, b) of the pairs (a, b, fa, fb) whose fingerprints are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fa, fb = (np.frombuffer(b"".join(column(batch, c).to_pylist()), np.uint8).reshape(-1, SLOTS) for c in ("fa", "fb"))
            yield batch.select(["a", "b"]).filter(pa.array(likeness(fa, fb) >= least))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def link(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """Per row of `docs`: doc_id, n_chars, component_id (smallest doc_id reachable over likenesses of `least` or more).

    Equal texts are one class, named by its smallest doc_id. Classes that share a band are candidates. In each round every
    bucket with several components names a member that was none before as its hub, and the others are compared with it; rounds end when each
    bucket is one component or all of its members have been hubs, so no pair of a bucket between two components stays
    untested. Empty and null texts and rows with a null doc_id are linked with nothing. Other columns are not read.
    """
    rows = materialise(fingerprints(docs), "fingerprints")
    classes = rows.where("n_chars > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc"), F.first("fp").alias("fp"))
    classes = materialise(classes, "classes")
    places = [np.argsort(_random(5, np.int64(b), np.arange(SLOTS)))[:BAND_SLOTS].tolist() for b in range(BANDS)]
    key = lambda b, at: F.xxhash64(F.lit(b), *(F.substring("fp", i + 1, 1) for i in at))
    entries = classes.select("doc", "fp", F.explode(F.array(*(key(b, at) for b, at in enumerate(places)))).alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    members = materialise(entries.select("doc", "key").join(shared, "key"), "members")
    of = lambda x: classes.select(F.col("doc").alias(x), F.col("fp").alias(f"f{x}"))
    links = used = labels = None
    turn = 0
    while True:
        now = members.withColumn("component", F.col("doc")) if labels is None else members.join(labels, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        spread = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
        fresh = now.join(spread, "key")
        fresh = fresh if used is None else fresh.join(used, ["key", "doc"], "left_anti")
        order = F.struct(F.xxhash64("doc", F.lit(turn)).alias("place"), "doc", "component") if turn else F.struct(F.col("doc").alias("place"), "doc", "component")
        hubs = materialise(fresh.groupBy("key").agg(F.min(order).alias("hub")), "hubs")
        if hubs.isEmpty():
            break
        seen = hubs.select("key", F.col("hub.doc").alias("doc"))
        used = seen if used is None else materialise(used.unionAll(seen), "used")
        pairs = now.join(hubs, "key").where("component <> hub.component").select(F.least("doc", "hub.doc").alias("a"), F.greatest("doc", "hub.doc").alias("b")).distinct()
        good = materialise(_alike(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "fa", "fb"), least), "links")
        if not good.isEmpty():
            links = good if links is None else links.unionAll(good)
            labels = components(links)
        turn += 1
    named = classes.select("digest", F.col("doc").alias("component_id")) if labels is None else classes.join(labels, "doc", "left").select("digest", F.coalesce("component", "doc").alias("component_id"))
    out = rows.join(named, "digest", "left")
    linked = (F.col("n_chars") > 0) & F.col("doc_id").isNotNull()
    return out.select("doc_id", "n_chars", F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
