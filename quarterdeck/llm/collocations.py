"""Phrase collocation mining by direct-address tiling.

Words of a language are items. Items that occur often enough get ids by descending frequency; pairs of neighbouring
ids fall into square tiles of `SIDE` ids a side. A tile with many pairs is counted by one `bincount` over all its cells, the
others as sorted coordinates. The frequent pairs are ranked anew and are the items of the next level: two
phrases of k words that overlap in k - 1 make one of k + 1, so up to five words no infrequent part is ever counted.

Tasks shuffle (pair, count) sums only; no key has more rows than there are tasks. What is sent to the tasks are the
ids of `RANKED` items a level at most. Items past that bound (or whose hashes collide) have no id: phrases that hold one are
counted by their text instead, a slower way with the same result. Parts that are known to be infrequent are dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import Words, column, mix, pieces
from quarterdeck.session import materialise

LONGEST = 5
LEAST = 100
TOP = 2000
#: Items with an id at one level: 12 bytes each in every worker.
RANKED = 1 << 20
#: Ids along the side of a tile.
SIDE_BITS = 10
#: A tile is dense from one pair in so many cells.
DENSE = 16
#: Pairs of a task that are counted together.
AT_ONCE = 1 << 21
_U = np.uint64

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[[0x20, 0x09]] = True


class Tokens:
    """Words of texts: hash with the language, byte span, text, and whether the next word is in the same piece."""

    def __init__(self, texts: list[bytes | None], langs: list[str | None]):
        self.words = w = Words(texts, lower=True, space=_BETWEEN)
        self.langs = ["und" if x is None else x for x in langs]
        seed = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs], _U)
        self.text = np.repeat(np.arange(len(texts)), w.counts())
        self.hash = mix(w.hash ^ seed[self.text]) if len(w.hash) else w.hash
        breaks = np.concatenate([[0], np.cumsum(_BREAK[w.data])])
        self.joined = np.append(breaks[w.end[:-1]] == breaks[w.start[1:]], False) if len(w.start) else np.zeros(0, bool)

    def phrase(self, i: int, k: int) -> bytes:
        w = self.words
        return b" ".join(w.data[a:b].tobytes() for a, b in zip(w.start[i : i + k].tolist(), w.end[i : i + k].tolist(), strict=True))


class Level:
    """Ids of the items of one length: `keys` in the order of ids. `whole`: an item without an id is infrequent."""

    def __init__(self, keys: np.ndarray, whole: bool):
        order = np.argsort(keys)
        self.keys, self.ids, self.whole = keys[order], order.astype(np.int32), whole

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Id of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ids[at], -1).astype(np.int64)


def pair_counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of ids as a << 32 | b, and how often each occurs: dense tiles by address, the rest sorted."""
    side = 1 << SIDE_BITS
    across = (int(max(a.max(initial=0), b.max(initial=0))) >> SIDE_BITS) + 1
    tile = (a >> SIDE_BITS) * across + (b >> SIDE_BITS)
    tiles, sizes = np.unique(tile, return_counts=True)
    keys, counts = [], []
    for t in tiles[sizes * DENSE >= side * side]:
        own = tile == t
        cells = np.bincount((a[own] % side) * side + b[own] % side, minlength=side * side)
        at = np.flatnonzero(cells)
        keys.append(((t // across * side + at // side) << 32) | (t % across * side + at % side))
        counts.append(cells[at])
        a, b, tile = a[~own], b[~own], tile[~own]
    rest, times = np.unique((a << 32) | b, return_counts=True)
    return np.concatenate([*keys, rest]), np.concatenate([*counts, times])


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, h, f): all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            t = Tokens(texts, column(batch, "lang").to_pylist())
            h, first, n = np.unique(t.hash, return_index=True, return_counts=True)
            # Words that share a hash inside the piece are told apart by their text.
            langs, words = [t.langs[x] for x in t.text[first]], [t.phrase(i, 1) for i in first.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["lang", "phrase", "h", "f"])

    rows = docs.mapInArrow(run, "lang string, phrase string, h bigint, f bigint")
    return rows.groupBy("lang", "phrase", "h").agg(F.sum("f").alias("f"))


def _longer_counts(docs: DataFrame, shared, k: int) -> DataFrame:
    """(pair, lang, phrase, f): phrases of k words by the ids of their two parts of k - 1 words, or by text where one has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels: list[Level] = shared.value
        by_text = not all(x.whole for x in levels)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> pa.RecordBatch:
            keys, n = pair_counts(*(np.concatenate(x) for x in zip(*held, strict=True)))
            none = pa.nulls(len(keys), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(keys), none, none, pa.array(n, pa.int64())], ["pair", "lang", "phrase", "f"])

        for batch, texts in pieces(batches):
            t = Tokens(texts, column(batch, "lang").to_pylist())
            fits = t.joined  # the phrase of this length at i stays inside its piece
            ids = levels[0].of(t.hash)
            open_ = fits.copy()
            for n, level in enumerate(levels, 1):
                if n > 1:
                    both = np.flatnonzero(fits & (ids >= 0) & (np.append(ids[1:], -1) >= 0))
                    fits = fits & np.append(t.joined[n - 1 :], np.zeros(min(n - 1, len(fits)), bool))[: len(fits)]
                    nxt = np.full(len(ids), -1, np.int64)
                    nxt[both] = level.of((ids[both] << 32) | ids[both + 1])
                    ids = nxt
                if level.whole and by_text:
                    for i in range(k - n + 1):
                        open_ &= np.append(ids[i:], np.full(min(i, len(ids)), -1))[: len(ids)] >= 0
            after = np.append(ids[1:], -1)
            both = fits & (ids >= 0) & (after >= 0)
            if both.any():
                held.append((ids[both], after[both]))
                size += int(both.sum())
                if size >= AT_ONCE:
                    yield counted()
                    held, size = [], 0
            if by_text:
                loose = Counter((t.langs[t.text[i]], t.phrase(i, k)) for i in np.flatnonzero(fits & open_ & ~both).tolist())
                keys = list(loose)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(keys), pa.int64()), pa.array([x[0] for x in keys], pa.string()), pa.array([x[1] for x in keys], pa.binary()).cast(pa.string()), pa.array(list(loose.values()), pa.int64())],
                    ["pair", "lang", "phrase", "f"],
                )
        if held:
            yield counted()

    rows = docs.mapInArrow(run, "pair bigint, lang string, phrase string, f bigint")
    return rows.groupBy("pair", "lang", "phrase").agg(F.sum("f").alias("f"))


def _ranked(frequent: DataFrame, key: str, name: str) -> tuple[DataFrame, Level]:
    """`frequent` (key, lang, phrase, f) with `id`, stored, and its level: the most frequent rows with a key have the ids."""
    known = frequent.where(F.col(key).isNotNull())
    keys = known.orderBy(F.desc("f"), key).select(key).limit(RANKED).toArrow().column(0).to_numpy()  # RANKED rows at most
    ids = frequent.sparkSession.createDataFrame(pa.table({key: pa.array(keys, pa.int64()), "id": pa.array(np.arange(len(keys)), pa.int64())}))
    rows = materialise(frequent.join(ids, key, "left").select("id", "lang", "phrase", "f"), name)
    level = Level(keys.view(_U) if key == "h" else keys, rows.where("id IS NULL").isEmpty())
    return rows, level


def frequent_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f, k) of all words and phrases of up to LONGEST words with f >= LEAST, and (lang, n) of all words."""
    docs = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    words = materialise(_word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    # A hash of two words would mix them up: such words have no key and are counted by text.
    clash = words.groupBy("h").agg(F.count("*").alias("c"), F.max("f").alias("m")).where(f"c > 1 AND m >= {LEAST}").select("h", F.lit(True).alias("clash"))
    frequent = words.where(F.col("f") >= LEAST).join(clash, "h", "left").select(F.when(F.col("clash").isNull(), F.col("h")).alias("h"), "lang", "phrase", "f")
    rows, level = _ranked(materialise(frequent, "frequent_words"), "h", "level1")
    levels, tables = [level], [rows]
    for k in range(2, LONGEST + 1):
        shared = docs.sparkSession.sparkContext.broadcast(levels)
        found = materialise(_longer_counts(docs, shared, k).where(F.col("f") >= LEAST), f"pairs{k}")
        shared.destroy()
        part = lambda x: tables[-1].where("id IS NOT NULL").select(F.col("id").alias(x), F.col("lang").alias(f"lang_{x}"), F.col("phrase").alias(f"phrase_{x}"))  # noqa: B023, E731
        pairs = found.where("pair IS NOT NULL").withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))})
        named = pairs.join(part("a"), "a").join(part("b"), "b").select("pair", F.col("lang_a").alias("lang"), F.concat_ws(" ", "phrase_a", F.substring_index("phrase_b", " ", -1)).alias("phrase"), "f")
        rows, level = _ranked(named.unionByName(found.where("pair IS NULL")), "pair", f"level{k}")
        if rows.isEmpty():
            break
        levels.append(level)
        tables.append(rows)
    every = tables[0].select("lang", "phrase", "f", F.lit(1).alias("k"))
    for k, rows in enumerate(tables[1:], 2):
        every = every.unionByName(rows.select("lang", "phrase", "f", F.lit(k).alias("k")))
    return every, totals


def mine(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the TOP phrases of each language (null: `und`) by score.

    Texts are lower-cased (A-Z), split at `[.,;:!?\\x0A-\\x0D]` into pieces and at blanks and tabs into words. Phrases have 2 to 5
    words of one piece and occur a >= LEAST times. The score is the lowest floor(1000 * a * n / (l * r)) over the cuts of the
    phrase into parts that occur l and r times, ties to the shortest first part; n counts the words of the language.
    A phrase inside a longer one that occurs as often is dropped. Equal scores go by higher a, then by the bytes of the
    phrase. Null and empty texts have no words; repeated rows count each; an empty table gives no rows. A very long
    text is a piece of its own. Other columns are not read.
    """
    every, totals = frequent_phrases(docs)
    every = materialise(every, "phrases")
    candidates = every.where("k > 1")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    text = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cuts = cuts.select("lang", "phrase", "a", "cut", text(F.lit(1), F.col("cut")).alias("first"), text(F.col("cut") + 1, F.size("w") - F.col("cut")).alias("rest"))
    side = lambda x, f: every.select("lang", F.col("phrase").alias(x), F.col("f").alias(f))
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumns({"top": big("a") * big("n") * F.lit(1000).cast("decimal(4,0)"), "low": big("l") * big("r")}).withColumn("score", F.expr("top div low"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("s")).select("lang", "phrase", "s.*")
    # Parts of one word less are enough: a part that occurs as often as a longer phrase does so in all lengths between.
    longer = candidates.where("k > 2").select("lang", "f", F.split("phrase", " ").alias("w"))
    inside = longer.select("lang", "f", F.explode(F.array(text(F.lit(1), F.size("w") - 1), text(F.lit(2), F.size("w") - 1))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # Candidates occur LEAST times at least, so a language has few of them next to its words; one task ranks them.
    ranked = left.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM (
  SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents WHERE text IS NOT NULL)),
w AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS MATERIALIZED (
  SELECT lang, k, phrase, count(*)::BIGINT AS f FROM (
    SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE len(w) >= k))
  GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a FROM g WHERE k > 1 AND f >= {LEAST}),
cut AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS s, unnest(range(1, k)) AS j FROM c),
sc AS (
  SELECT cut.lang, cut.phrase, a, j, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN n USING (lang)
  JOIN g l ON l.lang = cut.lang AND l.phrase = array_to_string(s[1:j], ' ') JOIN g r ON r.lang = cut.lang AND r.phrase = array_to_string(s[j+1:], ' ')),
lo AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (SELECT * FROM lo WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE c.lang = lo.lang AND c.k > len(string_split(lo.phrase, ' ')) AND contains(' ' || c.phrase || ' ', ' ' || lo.phrase || ' ') AND 100 * c.a >= 100 * lo.a))
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= {TOP}
"""
