"""Counts against a plain version, and thresholds that follow the group."""

import random
import re
from collections import Counter

from quarterdeck.llm import quality_rules


def plain(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    g = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    rep = {p for i in range(len(w) - 4) if g[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), failed


def test_counts(spark):
    rnd = random.Random(9)
    parts = ["a", "b", "c", " ", "  ", "\n", "\t", "#", "<>", "é", "😀", "a b a b a b", "x\n", "a b c d e f "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(400)] + [None, "", "z " * 20_000]
    docs = spark.createDataFrame([(i, t, None if i % 3 else "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_words int")
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules.judge(docs).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert quality_rules.judge(docs.limit(0)).collect() == []


def test_thresholds_follow_the_group(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8)))
    clean = lambda: " ".join(word() for _ in range(60))
    code = lambda: " ".join(word() + rnd.choice(["#", "|", "<>"]) for _ in range(60))
    rows = [(i, clean(), "en", "web") for i in range(300)] + [(1000 + i, code(), "en", "code") for i in range(300)] + [(2000, code(), "en", "web"), (2001, code(), None, None)]
    out = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(out[i] for i in range(300)) and all(out[1000 + i] for i in range(300)) and not out[2000] and 2001 in out
