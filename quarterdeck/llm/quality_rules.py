"""Quality rules with thresholds that each language and source sets for itself.

Per document, array functions count words, symbols, repeated lines and words in repeated 5-word windows; no row is
exploded. The documents that pass the base rule feed KLL quantile sketches per (language, source), which Spark merges across
tasks; sketches of small groups are replaced by the merged sketch of their language, and those of small languages by
that of all documents. A ratio fails if it lies beyond a quartile by more than `REACH` times the quartile distance
(at least a floor), so a homogeneous group loses nothing. Documents are then joined with the thresholds of their
group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.session import materialise

SPACE = r"[\x20\x09-\x0D]+"
#: Quartile distances beyond a quartile, and the least distance of each ratio.
REACH = 6.0
RATIOS = {"mean_word": 1.0, "symbol_ratio": 0.02, "dup_line_ratio": 0.1, "repeat_ratio": 0.03}
TWO_SIDED = ("mean_word",)
#: Documents that a group needs for thresholds of its own.
LEAST_GROUP = 30
#: Size parameter of the sketches; groups below it are exact.
SKETCH_K = 1024
WINDOW = 5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _covered(hashes: str) -> str:
    """SQL for the number of words in windows whose hash occurs twice or more; hashes[i] is the window from word i on."""
    return f"""
    CASE WHEN size(array_distinct({hashes})) = size({hashes}) THEN 0L ELSE
      aggregate(
        sort_array(transform(array(sort_array(transform({hashes}, (h, i) -> struct(h AS h, i AS i)))), s ->
          transform(filter(s, (x, k) -> x.h = get(s, k - 1).h OR x.h = get(s, k + 1).h), x -> x.i))[0]),
        struct(0L AS n, {-WINDOW} AS last),
        (a, i) -> struct(a.n + least({WINDOW}, i - a.last) AS n, i AS last),
        a -> a.n)
    END"""


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every row of `docs`. Null and empty texts have no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select("doc_id", "lang", "source", text.alias("_t"), words_of(F.col("text")).alias("_w"), lines.alias("_l"))
    ahead = ", ".join(f"get(_w, i + {k})" for k in range(1, WINDOW))
    step = step.select(
        "doc_id",
        "lang",
        "source",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.expr(f"transform(slice(_w, 1, greatest(size(_w) - {WINDOW - 1}, 0)), (w, i) -> xxhash64(w, {ahead}))").alias("_h"),
    )
    n_repeat = F.expr(_covered("_h"))
    out = step.withColumn("n_repeat_words", n_repeat).drop("_h")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def with_ratios(m: DataFrame) -> DataFrame:
    return m.withColumns(
        {
            "mean_word": F.try_divide("word_chars", "n_words"),
            "symbol_ratio": F.try_divide("n_symbols", "n_words"),
            "dup_line_ratio": F.try_divide("n_dup_lines", "n_lines"),
            "repeat_ratio": F.try_divide("n_repeat_words", "n_words"),
        }
    )


def thresholds(m: DataFrame) -> DataFrame:
    """Per (lang, source): the quartiles that apply to it, from its own, its language's or the common sketch."""
    good = with_ratios(m.where(~F.col("base_failed")))
    own = good.groupBy("lang", "source").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(F.col(r), F.lit(SKETCH_K)).alias(r) for r in RATIOS))
    own = materialise(own, "quality-sketches")
    merge = lambda d: [F.sum("n").alias("n"), *(F.kll_merge_agg_double(r).alias(r) for r in RATIOS)]
    by_lang = own.groupBy("lang").agg(*merge(own)).select("lang", F.col("n").alias("lang_n"), *(F.col(r).alias(f"lang_{r}") for r in RATIOS))
    every = own.groupBy().agg(*merge(own)).select(*(F.col(r).alias(f"all_{r}") for r in RATIOS))
    joined = own.join(by_lang.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang"))).join(F.broadcast(every))  # one row
    picked = {r: F.when(F.col("n") >= LEAST_GROUP, F.col(r)).when(F.col("lang_n") >= LEAST_GROUP, F.col(f"lang_{r}")).otherwise(F.col(f"all_{r}")) for r in RATIOS}
    at = lambda r, q: F.kll_sketch_get_quantile_double(r, F.lit(q))
    own = joined.select("lang", "source", *(c.alias(r) for r, c in picked.items()))
    return own.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *(at(r, q).alias(f"{r}_{n}") for r in RATIOS for q, n in ((0.25, "q1"), (0.75, "q3"))))


def judge(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, the counts, base_failed, kept.

    Null languages and sources are groups of their own. Extra columns are not read; repeated rows give repeated rows;
    an empty table gives an empty result.
    """
    m = materialise(measures(docs), "quality-measures")
    t = thresholds(m)
    j = with_ratios(m).join(t, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    ok = F.lit(True)
    for r, floor in RATIOS.items():
        reach = REACH * F.greatest(F.col(f"{r}_q3") - F.col(f"{r}_q1"), F.lit(floor))
        ok &= F.coalesce(F.col(r) <= F.col(f"{r}_q3") + reach, F.lit(True))
        if r in TWO_SIDED:
            ok &= F.coalesce(F.col(r) >= F.col(f"{r}_q1") - reach, F.lit(True))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ok).alias("kept"))


def oracle_sql() -> str:
    """The same result in DuckDB; exact while every group has fewer documents than `SKETCH_K`."""
    quart = ", ".join(f"list_sort(list({r}))[greatest(1, ceil({q} * count(*)))::BIGINT] AS {r}_{n}" for r in RATIOS for q, n in ((0.25, "q1"), (0.75, "q3")))
    pick = ", ".join(f"CASE WHEN o.n >= {LEAST_GROUP} THEN o.{r}_{n} WHEN l.n >= {LEAST_GROUP} THEN l.{r}_{n} ELSE a.{r}_{n} END AS {r}_{n}" for r in RATIOS for n in ("q1", "q3"))
    tests = " AND ".join(f"{r} <= {r}_q3 + {REACH} * greatest({r}_q3 - {r}_q1, {f})" + (f" AND {r} >= {r}_q1 - {REACH} * greatest({r}_q3 - {r}_q1, {f})" if r in TWO_SIDED else "") for r, f in RATIOS.items())
    return rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT rid, i, list_aggregate(w[i:i+{WINDOW - 1}], 'string_agg', ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM base)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM dup) GROUP BY rid),
m AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN rep USING (rid)),
r AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, word_chars / n_words AS mean_word, n_symbols / n_words AS symbol_ratio,
  n_dup_lines / n_lines AS dup_line_ratio, n_repeat_words / n_words AS repeat_ratio FROM m),
o AS (SELECT lang, source, count(*) AS n, {quart} FROM r WHERE NOT base_failed GROUP BY ALL),
l AS (SELECT lang, count(*) AS n, {quart} FROM r WHERE NOT base_failed GROUP BY ALL),
a AS (SELECT {quart} FROM r WHERE NOT base_failed),
t AS (SELECT o.lang, o.source, {pick} FROM o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang CROSS JOIN a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND coalesce({tests}, true)) AS kept
FROM r LEFT JOIN t ON r.lang IS NOT DISTINCT FROM t.lang AND r.source IS NOT DISTINCT FROM t.source"""
