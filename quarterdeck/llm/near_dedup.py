"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

A document is the set of its 5-word shingles. One hash per shingle: its high bits choose a bin, the smallest hash of a
bin is the bin's value, and an empty bin takes the value of the first filled bin in a pseudo-random order of its own.
Bands of bins are bucket keys. Documents with equal sets are one class from the start, so a large group of copies is
one bucket entry.

In each bucket a hub is paired with the members that are not yet connected to it (a star, so the pairs of a round
grow with the members and not with their square); pairs are confirmed on the full sets. Rounds with new hubs follow
until `ROUNDS` are done and a round confirms nothing more, so buckets of up to ROUNDS + 1 members are compared in
full. Members of larger buckets that were no hub and still lie in different components are then joined exactly: two
sets that are similar enough share a shingle among the rarest of each, so only those prefixes meet, under the length
and position bounds. No candidate pair between components stays untested.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import Words, column, mix, pieces
from quarterdeck.llm.flags import only_flagged
from quarterdeck.session import materialise

SHINGLE = 5
BIN_BITS = 7
#: A pair at the threshold shares no bucket with this probability at most.
MISSED = 1e-4
ROUNDS = 4
#: Counters of the table by which the last join tells rare shingles.
RARITY_BITS = 20
#: Longs of a set's parity: bit i tells whether an odd number of its shingles has hash i.
PARITY = [f"q{i}" for i in range(4)]
_U = np.uint64
_BINS = 1 << BIN_BITS
_SCHEMA = "doc_id bigint, n_shingles bigint, cls binary, bands array<bigint>"


def _orders() -> np.ndarray:
    """For each bin, the order in which it looks for a filled one."""
    with np.errstate(over="ignore"):
        keys = mix(np.arange(_BINS * _BINS, dtype=_U).reshape(_BINS, _BINS) * _U(0x9E3779B97F4A7C15) + _U(1))
    return np.argsort(keys, axis=1)


ORDERS = _orders()


def bins(sets: list[np.ndarray]) -> np.ndarray:
    """Densified bins of non-empty sorted sets, one row per set."""
    h = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cell = owner * _BINS + (h >> _U(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))  # sets are sorted, so the first of a bin is its smallest
    out, filled = np.zeros(len(sets) * _BINS, _U), np.zeros(len(sets) * _BINS, bool)
    out[cell[first]], filled[cell[first]] = h[first], True
    out, filled = out.reshape(-1, _BINS), filled.reshape(-1, _BINS)
    for a in range(0, len(sets), 256):
        row, empty = np.nonzero(~filled[a : a + 256])
        look = ORDERS[empty]
        hit = np.take_along_axis(filled[a : a + 256][row], look, axis=1).argmax(axis=1)
        out[a + row, empty] = out[a + row, look[np.arange(len(row)), hit]]
    return out


def banding(percent: int) -> tuple[int, int]:
    """Bands and bins in each: the longest bands that miss a pair at the threshold no more often than `MISSED`.

    21 bands of 6 for 85 percent, 25 of 5 for 80.
    """
    fits = [r for r in range(1, _BINS + 1) if (1 - (percent / 100) ** r) ** (_BINS // r) <= MISSED]
    rows = max(fits, default=1)
    return _BINS // rows, rows


def band_keys(filled: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = []
    for b in range(bands):
        k = np.full(len(filled), b + 1, _U)
        for r in range(rows):
            k = mix(k * _U(0x9E3779B97F4A7C15) + filled[:, b * rows + r])
        keys.append(k)
    return np.stack(keys, axis=1)


def _class(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, percent: int) -> DataFrame:
    """Per row: doc_id, set size, 128-bit name of the set, band keys (null for an empty set)."""
    bands, rows = banding(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            for i in range(0, len(texts), 1024):
                sets = Words(texts[i : i + 1024], lower=True).shingles(SHINGLE)
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(bins(full), bands, rows).view(np.int64).tolist() if full else ())
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, "doc_id").slice(i, 1024),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_class(s) for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "cls", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def parity(h: np.ndarray) -> np.ndarray:
    """Parity of a set of shingles. Two sets differ in at least as many shingles as their parities do in bits."""
    bits = len(PARITY) * 64
    odd = np.bincount((h.view(_U) >> _U(RARITY_BITS) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, shingles) of the classes in `wanted` (cls, doc)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in pieces(batches):
            sets = Words(texts, lower=True).shingles(SHINGLE)
            yield pa.RecordBatch.from_arrays([pa.array([_class(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["cls", "shingles"])

    # Texts are not shuffled: a few more than wanted are hashed instead.
    texts = only_flagged(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), wanted, ["doc"])
    got = texts.select("text").mapInArrow(run, "cls binary, shingles array<bigint>")
    return got.groupBy("cls").agg(F.first("shingles").alias("shingles"))


def components(links: DataFrame) -> DataFrame:
    """(doc, component) of the documents in `links` (a, b): the smallest document that each can reach.

    Each step takes the smallest label among the neighbours and then follows labels once, so paths shrink by halves.
    """
    both = links.select(F.col("a").alias("doc"), F.col("b").alias("to")).unionAll(links.select(F.col("b").alias("doc"), F.col("a").alias("to")))
    both = materialise(both.distinct(), "links")
    labels = materialise(both.groupBy("doc").agg(F.least("doc", F.min("to")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("doc", "to"), "to").groupBy("doc").agg(F.min("component").alias("near"))
        step = labels.join(near, "doc").select("doc", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        jump = labels.select(F.col("doc").alias("component"), F.col("component").alias("far"))
        step = step.join(jump, "component", "left").select("doc", F.least("component", F.coalesce("far", "component")).alias("component"), "old")
        step = materialise(step, "labels")
        labels = step.select("doc", "component")
        if step.where("component < old").isEmpty():
            return labels


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda x: only_flagged(sets.select(F.col("cls").alias(f"cls_{x}"), F.col("shingles").alias(f"s{x}")), pairs.select(f"cls_{x}").distinct(), [f"cls_{x}"])
    a, b = side("a"), side("b")
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(b, "cls_b").join(a, "cls_a")
    return joined.withColumn("_both", both).where(F.col("_both") * 100 >= percent * (F.size("sa") + F.size("sb") - F.col("_both"))).select("cls_a", "cls_b", "a", "b")


def _prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of `rest` (cls, doc, n, component) in different components that may be similar enough; none is left out.

    Of two sets the longer has at least percent of its shingles in common with the shorter one, and the shorter at
    least 2 * percent / (100 + percent) of its own. So in any common order of shingles, here the rarest first, the two
    share one among those that may come before such an overlap ends. Shingles counted once are shared with none.
    Members of one template share most of their shingles without being similar enough; their parities tell that most of
    these pairs differ in too many, before a row is made of them.
    """
    held = only_flagged(sets, rest, ["cls"]).join(rest, "cls")
    held = materialise(held.select("cls", "doc", "n", "component", "shingles"), "rest_sets")
    size = 1 << RARITY_BITS
    counts = held.select(F.explode("shingles").alias("s")).groupBy(F.pmod("s", F.lit(size)).alias("at")).agg(F.count("*").alias("c")).toArrow()
    table = np.zeros(size, np.int32)
    table[counts.column("at").to_numpy()] = np.minimum(counts.column("c").to_numpy(), np.iinfo(np.int32).max)
    shared = rest.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                owner, shingle, place, short, odd = [], [], [], [], []
                for k, s in enumerate(column(batch, "shingles")):
                    h = s.values.to_numpy()
                    c = count[h & (size - 1)]
                    n = len(h)
                    at = np.arange(n + (-percent * n // 100) + 1)
                    odd.append(parity(h))
                    order = np.lexsort((h, c))[at]
                    some = c[order] > 1
                    owner.append(np.full(int(some.sum()), k))
                    shingle.append(h[order][some])
                    place.append(at[some])
                    short.append(at[some] <= n + (-2 * percent * n // (100 + percent)))
                whose = np.concatenate(owner)
                take = batch.select(["cls", "doc", "n", "component"]).take(pa.array(whose, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*take.columns, pa.array(np.concatenate(shingle), pa.int64()), pa.array(np.concatenate(place), pa.int32()), pa.array(np.concatenate(short), pa.bool_()), *(pa.array(q) for q in np.stack(odd)[whose].T)],
                    ["cls", "doc", "n", "component", "shingle", "place", "short", *PARITY],
                )

    rows = materialise(held.mapInArrow(run, "cls binary, doc bigint, n bigint, component bigint, shingle bigint, place int, short boolean, " + ", ".join(f"{q} bigint" for q in PARITY)), "prefixes")
    shared.destroy()
    y = rows.where("short").select("shingle", *(F.col(c).alias(f"{c}2") for c in ("cls", "doc", "n", "component", "place", *PARITY)))
    longer = "(n2 < n OR n2 = n AND doc2 < doc) AND n2 * 100 >= n * {0} AND component <> component2"
    room = "(least(place, place2) + 1 + least(n - place - 1, n2 - place2 - 1)) * (100 + {0}) >= {0} * (n + n2)"
    differ = " + ".join(f"bit_count({q} ^ {q}2)" for q in PARITY)
    few = f"({differ}) * (100 + {{0}}) <= (100 - {{0}}) * (n + n2)"
    return rows.join(y, "shingle").where(f"{longer} AND {room} AND {few}".format(percent)).select("cls", "doc", "n", "cls2", "doc2", "n2")


def link(docs: DataFrame, percent: int = 85, exhaustive: bool = True) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, kept, n_links.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets; component_id is the smallest
    doc_id reachable. Null, empty and wordless texts are linked with nothing and stay; so do rows with a null doc_id
    (their component_id is null). Rows that repeat a doc_id give one row each. `n_links` counts the confirmed links of
    the row's class with other classes that the component was built from. Other columns are not read. With
    `exhaustive=False` pairs of two members of a large bucket that were never its hubs stay untested.
    """
    sigs = materialise(signatures(docs, percent), "signatures")
    classes = sigs.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = materialise(classes, "classes")
    entries = classes.select("cls", "doc", "n", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    members = materialise(entries.join(shared, "key"), "members")
    sets = materialise(_sets(docs, members.select("cls", "doc").distinct()), "sets")
    tested = used = links = labels = None
    turn, last = 0, False
    while True:
        now = members.withColumn("component", F.col("doc")) if labels is None else members.join(labels, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        fresh = now if used is None else now.join(used, ["key", "doc"], "left_anti")
        if last:
            spread = fresh.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
            rest = materialise(fresh.join(spread, "key").select("cls", "doc", "n", "component").distinct(), "rest")
            if rest.isEmpty():
                break
            pairs = _prefix_pairs(rest, sets, percent)
        else:
            order = F.struct((F.col("doc") if turn == 0 else F.xxhash64(F.col("doc"), F.lit(turn))).alias("place"), "cls", "doc", "n", "component")
            spread = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
            hubs = materialise(fresh.join(spread, "key").groupBy("key").agg(F.min(order).alias("hub")), "hubs")
            seen = hubs.select("key", F.col("hub.doc").alias("doc"))
            used = seen if used is None else used.unionAll(seen)
            pairs = now.join(hubs, "key").where("component <> hub.component").select("cls", "doc", "n", F.col("hub.cls").alias("cls2"), F.col("hub.doc").alias("doc2"), F.col("hub.n").alias("n2"))
        pairs = pairs.where(F.least("n", "n2") * 100 >= percent * F.greatest("n", "n2"))
        first = F.col("doc") < F.col("doc2")
        side = lambda x: [F.when(first, F.col(x)).otherwise(F.col(f"{x}2")), F.when(first, F.col(f"{x}2")).otherwise(F.col(x))]
        pairs = pairs.select(side("cls")[0].alias("cls_a"), side("cls")[1].alias("cls_b"), side("doc")[0].alias("a"), side("doc")[1].alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("cls_a", "cls_b"), ["cls_a", "cls_b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        turn += 1
        if pairs.isEmpty():
            more = turn < ROUNDS and not hubs.isEmpty() and not last
        else:
            good = materialise(_confirmed(pairs, sets, percent), "confirmed")
            tested = pairs if tested is None else tested.unionAll(pairs)
            some = not good.isEmpty()
            more = some and not last
            if some:
                links = good if links is None else links.unionAll(good)
                labels = components(links.where("a < b"))
            more = more or turn < ROUNDS
        if last or not (more or exhaustive):
            break
        last = not more
    if links is None:
        links = pairs.limit(0)
    if labels is not None:
        classes = classes.join(labels, "doc", "left")
    else:
        classes = classes.withColumn("component", F.lit(None).cast("long"))
    counts = links.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("n_links"))
    named = classes.select("cls", F.coalesce("component", "doc").alias("component")).join(counts, "cls", "left")
    out = sigs.select("doc_id", "n_shingles", "cls").join(named, "cls", "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
    )


def dedupe(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose document is the smallest of its component; columns as they were."""
    gone = link(docs, percent).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def oracle_sql(percent: int) -> str:
    """The contract's columns in DuckDB by counting shared shingles; for tables without repeated ids."""
    return rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+{SHINGLE - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
many AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM many JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS doc_id, a AS r FROM (SELECT DISTINCT a FROM both_ways) UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON both_ways.a = reach.r),
least AS (SELECT doc_id, min(r) AS m FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least.m, w.doc_id) AS component_id, coalesce(least.m, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)"""
