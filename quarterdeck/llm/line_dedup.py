"""Line dedup: exact set-similarity join of lines, in DataFrame functions only.

A line is the set of its words. Lines with equal sets are one class, named by the first line. The words of a class are
ordered by rarity; two sets of similarity 0.8 share a word in their short prefixes of rarest words. Classes that
share a prefix word and pass the length and the positional filter are candidates; Jaccard is verified on the
words themselves, read again from the documents that hold candidates. Each class meets the earliest class of its prefix
words first; the classes that are left are then joined with all, so a template's lines make no square of pairs. A line goes if an earlier line (by doc_id, text hash,
line number) has a similarity of 0.8 or more, judged on the input.

Rarity comes from counters of all words by hash, one byte each on a log scale; the table has a fixed size and goes
into the expressions as a literal. Words of equal rarity are ordered by hash, so all lines use one order and rarity
changes the cost only, never the result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.flags import flagged, only_flagged
from quarterdeck.session import materialise

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
#: Counters of word rarity: the bytes of the literal, which is also in each text that the driver keeps of the plan.
COUNTERS = 1 << 19
#: Similarity 4 / 5; lines of fewer words than LEAST match equal sets only.
LEAST = 4
#: Sets of so many words and more are compared by a parity of 128 bits; one of 64 tells little about sets of over 120 words.
WIDE = 64
#: Rarest words of a class that are tried for its first partner; more of them only move work between the two joins.
HUB_WORDS = 3
_NO_ID = -(1 << 63)


def _words(line: Column) -> Column:
    plain = F.when(line.rlike(r"[\x09-\x0D]"), F.regexp_replace(line, SPACE, " ")).otherwise(line)
    return F.array_remove(F.split(plain, " "), "")


def rarity(docs: DataFrame) -> bytes:
    """One byte per counter: four times the binary logarithm of its count of words, at most 127."""
    words = docs.select(F.explode(_words(F.coalesce("text", F.lit("")))).alias("w"))
    counts = words.groupBy(F.pmod(F.xxhash64("w"), F.lit(COUNTERS)).cast("int").alias("cell")).agg(F.count("*").alias("c"))
    got = counts.select("cell", F.least(F.lit(127), F.floor(4 * F.log2("c") + 1)).cast("byte").alias("v")).toArrow()  # COUNTERS rows at most
    table = np.zeros(COUNTERS, np.uint8)
    table[got.column("cell").to_numpy()] = got.column("v").to_numpy()
    return table.tobytes()


def lines(docs: DataFrame, table: bytes) -> DataFrame:
    """did, th, line_no, n (distinct words), k1, k2 (128-bit name of the word set), parity (bit i: whether an odd
    number of its words has hash i modulo 64), half (the same of about half of the words, 0 below WIDE), prefix (codes of
    its rarest words)."""
    split = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("did"), F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    split = split.where(F.col("line").rlike(WORD))
    words = F.array_distinct(_words(F.col("line")))
    coded = split.select("did", "th", "line_no", F.sort_array(F.transform(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _rank(h, table))).alias("codes"))
    n = F.size("codes")
    return coded.select(
        "did",
        "th",
        "line_no",
        n.alias("n"),
        F.xxhash64("codes").alias("k1"),
        F.xxhash64(F.lit(1), "codes").alias("k2"),
        _parity(lambda c: F.lit(1).cast("long")).alias("parity"),
        F.when(n >= WIDE, _parity(lambda c: F.shiftright(c, 6).bitwiseAND(F.lit(1)))).otherwise(F.lit(0).cast("long")).alias("half"),
        F.transform(F.slice("codes", 1, (n - F.ceil(n * 4 / 5) + 1).cast("int")), lambda c: F.hash(c)).alias("prefix"),
    )


def _parity(bit: Callable[[Column], Column]) -> Column:
    """Each code flips the bit of its last six binary digits, where `bit` of the code is 1."""
    return F.aggregate("codes", F.lit(0).cast("long"), lambda a, c: a.bitwiseXOR(F.call_function("shiftleft", bit(c), c.bitwiseAND(F.lit(63)).cast("int"))))


def _rank(h: Column, table: bytes) -> Column:
    """Rarity in the high bits, then the hash of the word: ascending order is rarest first."""
    byte = F.substring(F.lit(table), F.pmod(h, F.lit(COUNTERS)).cast("int") + 1, F.lit(1))
    return F.ascii(byte.cast("string")).cast("long") * F.lit(1 << 56) + F.shiftrightunsigned(h, 8)


#: Length, prefix and positional filters for a word shared at pa and pb, and the parity filter: two sets differ in at least
#: as many words as their parity bits do, and at similarity 0.8 in (na + nb) / 9 at most. Parities of both halves tell more than their sum.
_FILTERS = f"""5 * na >= 4 * nb AND 5 * nb >= 4 * na
  AND 9 * IF(least(na, nb) >= {WIDE}, bit_count(ha ^ hb) + bit_count(qa ^ ha ^ qb ^ hb), bit_count(qa ^ qb)) <= na + nb
  AND pa + ceil((na + nb) * 4 / 9) <= na AND pb + ceil((na + nb) * 4 / 9) <= nb
  AND least(pa, pb) + least(na - pa, nb - pb) >= ceil((na + nb) * 4 / 9)"""


def _named(rows: DataFrame, k: str) -> DataFrame:
    names = {"id": k, "did": f"d{k}", "n": f"n{k}", "p": f"p{k}", "parity": f"q{k}", "half": f"h{k}", "open": f"o{k}"}
    return rows.withColumnsRenamed(names)


def entries(classes: DataFrame, *more: str) -> DataFrame:
    """One row per class and word of its prefix: id, did, n, parity, half, p (place in the prefix), code."""
    return classes.where(F.col("n") >= LEAST).select("id", "did", "n", "parity", "half", *more, F.posexplode("prefix").alias("p", "code"))


def hub_pairs(classes: DataFrame) -> DataFrame:
    """Candidates (a, b): each class with the earliest class of its rarest words and its length, at most one pair a word."""
    rows = entries(classes).where(F.col("p") < HUB_WORDS).withColumn("band", F.floor(4 * F.log2("n")).cast("int"))
    # One exchange for both sides: both have all columns, and the tests for null that a join adds to its own side.
    rows = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in rows.columns)).repartition("code", "band")
    hubs = rows.groupBy("code", "band").agg(F.min(F.struct("did", "id", "n", "p", "parity", "half")).alias("h"), F.count("*").alias("m")).where("m > 1")
    hubs = _named(hubs.select("code", "band", "h.*"), "a")
    pairs = _named(rows, "b").join(hubs, ["code", "band"]).where(f"a <> b AND da <= db AND {_FILTERS}")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def opened(classes: DataFrame, gone: DataFrame) -> DataFrame:
    """`classes` with `open`: whether the id is not in `gone`. Only classes that the bitmap takes for gone are shuffled."""
    marked = flagged(classes, gone, ["id"])
    told = marked.where("_flag").drop("_flag").join(gone.select("id", F.lit(False).alias("open")), "id", "left").withColumn("open", F.coalesce("open", F.lit(True)))
    return told.unionByName(marked.where("NOT _flag").drop("_flag").withColumn("open", F.lit(True)))


def open_pairs(classes: DataFrame) -> DataFrame:
    """Candidates (a, b) among `classes`, which have a column `open`; a pair needs an open class on its later side.

    Both sides of the join have the same columns and no filter of their own, so one exchange of the entries serves both.
    """
    # A pair meets in the octave of its longer line; a shorter line near the end of its octave is in the next one too, with the
    # words of its prefix that it can share with a longer line.
    octave = lambda n: F.floor(F.log2(n)).cast("int")
    both = F.array_distinct(F.array(octave(F.col("n")), octave(F.floor(F.col("n") * 5 / 4))))
    rows = entries(classes.withColumn("octave", F.explode(both)), "open", "octave")
    rows = rows.where((F.col("octave") == octave(F.col("n"))) | (F.col("p") + F.ceil(F.col("n") * 8 / 9) <= F.col("n")))
    rows = rows.withColumn("code", F.hash("code", "octave")).drop("octave")
    later = "((da <= db AND ob) OR (db <= da AND oa))"
    return _named(rows, "a").join(_named(rows, "b"), "code").where(f"a < b AND {later} AND {_FILTERS}").select("a", "b").distinct()


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"did": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), "th": F.xxhash64("text")})


def _later(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Ids of the later classes of the pairs that are similar."""
    side = lambda k: words.select(F.col("id").alias(k), F.col("w").alias(f"w{k}"), F.col("spot").alias(f"s{k}"))
    both = F.size(F.array_intersect("wa", "wb"))
    close = pairs.join(side("a"), "a").join(side("b"), "b").where(9 * both >= 4 * (F.size("wa") + F.size("wb")))
    return close.select(F.when(F.col("sa") < F.col("sb"), F.col("b")).otherwise(F.col("a")).alias("id")).distinct()


def _resembling(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Ids of the classes that are the later side of a similar pair; words are read from the documents again."""
    spot = ["did", "th", "line_no"]
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "line-ids")
    places = materialise(only_flagged(classes.select("id", *spot), ids, ["id"]).join(ids, "id"), "line-places")
    texts = only_flagged(keyed(docs).select("did", "th", "text"), places.select("did", "th").distinct(), ["did", "th"])
    # Lines are filtered before the exchange, so whole texts are not shuffled.
    found = only_flagged(texts.select("did", "th", F.posexplode(F.split("text", "\n")).alias("line_no", "line")), places.select(*spot), spot)
    words = found.join(places, spot).groupBy(*spot, "id").agg(F.first("line").alias("line"))  # repeated rows hold a line twice
    words = words.select("id", F.struct(*spot).alias("spot"), F.array_distinct(_words(F.col("line"))).alias("w"))
    return materialise(_later(pairs, materialise(words, "line-words")), "later-lines")


def kept_lines(docs: DataFrame) -> DataFrame:
    """did, th and `kept`: the numbers of the lines of a document that stay, wordless lines not counted."""
    docs = docs.select("doc_id", "text")
    found = lines(docs, rarity(docs))
    classes = found.groupBy("k1", "k2").agg(F.min(F.struct("did", "th", "line_no", "n", "parity", "half", "prefix")).alias("f"))
    classes = materialise(classes.select(F.monotonically_increasing_id().alias("id"), "f.*"), "line-classes")
    # Classes of a template go by its earliest class, so only what is left after that is joined with all.
    first = _resembling(docs, classes, materialise(hub_pairs(classes), "hub-pairs"))
    rest = _resembling(docs, classes, materialise(open_pairs(opened(classes, first)), "open-pairs"))
    stay = opened(classes, materialise(first.unionByName(rest).distinct(), "later-lines")).where("open")
    return stay.groupBy("did", "th").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))


def remove(docs: DataFrame) -> DataFrame:
    """`docs` with the repeated lines cut out of `text`; other columns as they were, except n_chars, which is counted anew.

    Lines are split at \\n. Lines without a word stay. A null text stays null; rows with a null doc_id come first in the
    order of documents; rows that repeat doc_id and text are one document and keep the same lines. A document
    may end up with an empty text.
    """
    kept = materialise(kept_lines(docs), "kept-lines")
    wordy = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    every = keyed(docs.select("doc_id", "text")).select("did", "th", wordy.alias("n")).where("n > 0").distinct()
    changed = every.join(kept.select("did", "th", F.size("kept").alias("m")), ["did", "th"], "left").where("m IS NULL OR m < n").select("did", "th")
    # Only texts that change are shuffled; the others pass as they are.
    k = kept.select("did", "th", "kept")
    # The row travels as one column, so no name of the input can meet a helper column.
    carried = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("did"), F.xxhash64("text").alias("th"))
    marked = flagged(carried, materialise(changed, "changed"), ["did", "th"])
    touched = marked.where("_flag").drop("_flag").join(k, ["did", "th"], "left")
    # Lines and kept numbers in one sorted array: a line that stays follows its own number.
    merged = F.expr(
        f"""sort_array(concat(
          transform(split(row.text, '\\n'), (l, i) -> struct(i AS i, IF(l RLIKE '{WORD.replace(chr(92), chr(92) * 2)}', 1, 2) AS kind, l AS l)),
          transform(coalesce(kept, array()), i -> struct(i AS i, 0 AS kind, '' AS l))))"""
    )
    step = touched.withColumn("merged", merged)
    stay = F.filter("merged", lambda x, i: (x["kind"] == 2) | ((x["kind"] == 1) & (F.get("merged", i - 1)["kind"] == 0) & (F.get("merged", i - 1)["i"] == x["i"])))
    text = F.when(F.col("row.text").isNotNull(), F.array_join(F.transform(stay, lambda x: x["l"]), "\n"))
    done = step.select("row", text.alias("left")).unionByName(marked.where("NOT _flag").select("row", F.col("row.text").alias("left")))
    at = lambda c: F.col("row")[c].alias(c)
    return done.select(*[F.col("left").alias(c) if c == "text" else (F.length("left").cast(t).alias(c) if c == "n_chars" else at(c)) for c, t in docs.dtypes])


def digest(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_lines (lines with a word), n_removed, kept_sha256 of the text that stays (null: empty)."""
    plain = docs.select("doc_id", "text", F.col("text").alias("before"))
    count = lambda c: F.size(F.filter(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: x.rlike(WORD))).cast("long")
    out = remove(plain)
    return out.select("doc_id", count("before").alias("n_lines"), (count("before") - count("text")).alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT d.rowid_ AS r, doc_id, i - 1 AS line_no, s[i] AS line FROM (
    SELECT row_number() OVER () AS rowid_, doc_id, string_split(text, chr(10)) AS s, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL) d),
w AS (SELECT r, doc_id, line_no, line, list_sort(list_distinct(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS w FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
o AS (SELECT *, row_number() OVER (ORDER BY doc_id, line_no, r) AS place FROM w),
c AS (SELECT w, min(place) AS place, len(w) AS n FROM o GROUP BY w),
f AS (SELECT t, count(*) AS df FROM (SELECT unnest(w) AS t FROM c) GROUP BY t),
k AS (SELECT place, n, t, row_number() OVER (PARTITION BY place ORDER BY df, t) AS p FROM (SELECT place, n, unnest(w) AS t FROM c) JOIN f USING (t)),
x AS (SELECT place, n, t FROM k WHERE p <= n - ceil(n * 4 / 5) + 1),
pairs AS (SELECT DISTINCT a.place AS a, b.place AS b FROM x a JOIN x b ON a.t = b.t AND a.place < b.place AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
late AS (SELECT DISTINCT b FROM (SELECT b, len(list_intersect(ca.w, cb.w)) AS s, ca.n + cb.n AS n FROM pairs JOIN c ca ON ca.place = a JOIN c cb ON cb.place = b) WHERE 9 * s >= 4 * n),
stay AS (SELECT place FROM c WHERE place NOT IN (SELECT b FROM late)),
every AS (SELECT l.r, l.line_no, l.line, o.place IS NOT NULL AS wordy, o.place IS NULL OR o.place IN (SELECT place FROM stay) AS kept FROM l LEFT JOIN o ON l.r = o.r AND l.line_no = o.line_no),
done AS (SELECT r, count(*) FILTER (wordy) AS n_lines, count(*) FILTER (NOT kept) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (kept), '') AS t FROM every GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM (SELECT row_number() OVER () AS rr, * FROM documents WHERE text IS NOT NULL) d JOIN done ON done.r = d.rr
UNION ALL SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""
