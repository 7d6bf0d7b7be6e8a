"""Similar lines against all pairs."""

import random
import re
import tracemalloc

from pyspark.sql import functions as F

from quarterdeck.llm import line_dedup
from quarterdeck.session import materialise


def plain(rows):
    every = []
    for r, (d, t) in enumerate(rows):
        for i, x in enumerate((t or "").split("\n")):
            if w := frozenset(re.findall(r"[^\x20\x09-\x0D]+", x)):
                every.append(((-1 if d is None else d, i), r, i, w))
    every.sort(key=lambda e: e[0])
    gone = {(r, i) for k, (p, r, i, w) in enumerate(every) if any(len(w & v) * 5 >= 4 * len(w | v) for q, _, _, v in every[:k] if q < p)}
    return {r: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (r, i) not in gone) for r, (_, t) in enumerate(rows)}


def test_against_all_pairs(spark):
    rnd = random.Random(3)
    pool = [[f"w{int(rnd.paretovariate(0.6)) % 300}" for _ in range(rnd.choice([1, 2, 3, 4, 5, 8, 15, 30]))] for _ in range(60)]
    rows = []
    for d in range(120):
        ls = []
        for _ in range(rnd.randint(0, 8)):
            w = list(rnd.choice(pool))
            for _ in range(rnd.choice([0, 0, 1, 2])):
                w[rnd.randrange(len(w))] = f"n{rnd.randint(0, 40)}"
            ls.append(" ".join(w))
            ls += rnd.choice([[], [], ["", " \t"]])
        rows.append((d, "\n".join(ls)))
    rows += [(None, rows[40][1]), (300, None), (301, ""), (302, rows[7][1]), (303, "same line\n" * 4000)]
    docs = spark.createDataFrame([(d, t, "k", i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, kept string, n_chars long").repartition(4)
    ordered = {(d, t): x for (d, t), x in zip(rows, plain(rows).values(), strict=True)}
    source = {i: r for i, r in enumerate(rows)}
    out = line_dedup.remove(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert len(got) == len(source)
    for (d, _), x in ordered.items():
        assert got[d] == (x, None if x is None else len(x))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "a b c\nd")], "doc_id long, text string")
    assert sorted(r.text for r in line_dedup.remove(docs).collect()) in (["a b c", "a b c", "d"], ["", "", "a b c\nd"])
    assert line_dedup.remove(docs.limit(0)).collect() == []
    assert line_dedup.digest(docs.limit(0)).collect() == []


def test_other_columns_stay_as_they_are(spark):
    names = ["_id", "_hash", "_flag", "_m", "_bucket", "_bits", "did", "th", "kept", "row", "merged", "left", "_text"]
    rows = [(1, "one two three four five\nsix", *range(10, 23)), (2, "one two three four five\nseven", *range(30, 43)), (3, None, *range(50, 63))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    got = line_dedup.remove(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [rows[0], (2, "seven", *range(30, 43)), rows[2]]


def test_candidates_of_a_template_grow_in_proportion(spark):
    """Lines that differ in the last word: the first join settles them, and the second has one open line left."""
    counts = []
    for m in (200, 400):
        rows = [(i, f"alpha beta gamma delta epsilon zeta eta theta iota x{i}") for i in range(m)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        found = line_dedup.lines(docs, line_dedup.rarity(docs)).withColumn("id", F.col("did"))
        first = line_dedup.hub_pairs(found)
        gone = first.select(F.col("b").alias("id"))
        still = found.join(gone.withColumn("gone", F.lit(True)), "id", "left").withColumn("open", F.col("gone").isNull())
        counts.append(first.count() + line_dedup.open_pairs(still).count())
        assert sorted(r.doc_id for r in line_dedup.remove(docs).where("text <> ''").collect()) == [0]
    assert counts[0] <= 2 * 200 and counts[1] <= 2 * 400


def test_very_long_lines(spark):
    long = " ".join(f"w{i}" for i in range(20000))
    docs = spark.createDataFrame([(1, long), (2, long + " tail"), (3, " ".join(f"v{i}" for i in range(20000)))], "doc_id long, text string")
    assert {r.doc_id: len(r.text) for r in line_dedup.remove(docs).collect()} == {1: len(long), 2: 0, 3: len(long)}


def test_counters_are_not_made_into_python_objects(spark):
    """A dictionary per counter took hundreds of MB of the driver."""
    docs = spark.range(200).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 2000), i -> concat('w', id * 2000 + i)), ' ') AS text")
    tracemalloc.start()
    table = line_dedup.rarity(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(v > 0 for v in table) > 250_000 and peak < 40_000_000


def _with_ids(docs):
    return line_dedup.lines(docs, line_dedup.rarity(docs)).withColumn("id", F.col("did")).withColumn("open", F.lit(True))


def test_long_lines_that_differ_are_no_candidates(spark):
    """Lines of 130 words that share their two rarest only: a parity of 64 bits let one pair in four through, and words of each were shuffled."""
    rnd = random.Random(11)
    rows = [(i, " ".join(["rare1", "rare2", *rnd.sample([f"w{k}" for k in range(1000)], 128)])) for i in range(120)]
    docs = spark.createDataFrame([*rows, *((1000 + i, " ".join(f"w{k}" for k in range(1000))) for i in range(200))], "doc_id long, text string").repartition(4)
    found = _with_ids(docs).where("id < 1000")
    assert found.where("parity <> 0 AND half <> 0").count() == 120
    assert line_dedup.open_pairs(found).count() <= 20


def test_pairs_across_octaves_are_candidates(spark):
    """A line and the same line with up to a quarter more words, at every length from 5 to 70."""
    rows, want = [], set()
    for n in range(5, 71):
        words = [f"l{n}w{k}" for k in range(n)]
        rows += [(10 * n, " ".join(words)), (10 * n + 1, " ".join(words + [f"x{n}y{k}" for k in range(n // 4)]))]
        want |= {(10 * n, 10 * n + 1)} if n >= 4 and n // 4 else set()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = _with_ids(docs)
    assert want <= {tuple(r) for r in line_dedup.open_pairs(found).collect()}
    assert sorted(r.doc_id for r in line_dedup.remove(docs).where("text <> ''").collect()) == [10 * n for n in range(5, 71)]


def test_hubs_take_one_exchange(spark):
    """Both sides of the join of hubs read the same shuffle."""
    docs = spark.createDataFrame([(i, f"alpha beta gamma delta x{i}") for i in range(20)], "doc_id long, text string")
    classes = materialise(_with_ids(docs).drop("open"), "classes")  # as stored, where every column may be null
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        plan = line_dedup.hub_pairs(classes)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("ReusedExchange") == 1


def test_settled_lines_are_told_without_a_shuffle_of_all(spark):
    classes = spark.range(5000).withColumn("n", F.lit(7))
    gone = spark.range(0, 5000, 50)
    got = line_dedup.opened(classes, gone)
    assert got.count() == 5000 and sorted(r.id for r in got.where("NOT open").collect()) == list(range(0, 5000, 50))
