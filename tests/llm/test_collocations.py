"""Collocations against a plain version."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from quarterdeck.llm import collocations as C


def plain(rows, least, top):
    f, n = Counter(), Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    rank = {}
    for (lang, p), a in cand.items():
        if any(m == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for (m, q), b in cand.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        rank.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    out = []
    for lang, x in rank.items():
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(x)[:top])]
    return sorted(out)


def _rows():
    rnd = random.Random(12)
    vocab = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(400)] + ["Été", "straße", " ", "日本"]
    fixed = ["new york city", "a b a b a b", "x x x x", "in the long run of"]
    rows = []
    for _ in range(400):
        parts = [rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        text = "".join(p + rnd.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "\x0b"]) for p in parts)
        rows.append((rnd.choice(["en", "en", "de", None, "und", ""]), text.upper() if rnd.random() < 0.2 else text))
    return rows + [("en", None), ("en", ""), ("xx", None), ("de", " . "), ("en", rows[0][1])] + [("fr", rows[1][1])] * 40 + [("es", "q r " * 20_000)]


@pytest.mark.parametrize("ranked", [1 << 20, 9, 0])
def test_against_plain(spark, monkeypatch, ranked):
    rows = _rows()
    for k, v in {"LEAST": 12, "TOP": 40, "RANKED": ranked, "SIDE_BITS": 3, "AT_ONCE": 500}.items():
        monkeypatch.setattr(C, k, v)
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], "lang string, text string, f int, phrase string").repartition(5)
    got = C.mine(docs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 12, 40)


def test_empty_tables(spark):
    docs = spark.createDataFrame([("en", "a b"), (None, None)], "lang string, text string")
    assert C.mine(docs).collect() == [] and C.mine(docs.limit(0)).collect() == []


def test_tiles_count_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    a, b = (np.minimum(rng.zipf(1.3, 20_000), 5000) - 1 for _ in range(2))
    want = Counter(zip(a.tolist(), b.tolist(), strict=True))
    for bits, dense in ((3, 1), (6, 4), (10, 16), (10, 1 << 30)):
        monkeypatch.setattr(C, "SIDE_BITS", bits)
        monkeypatch.setattr(C, "DENSE", dense)
        keys, n = C.pair_counts(a, b)
        assert dict(zip(zip((keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist(), strict=True), n.tolist(), strict=True)) == want


def test_products_past_64_bits(spark, monkeypatch):
    phrases = spark.createDataFrame([("en", "a b", 4 * 10**12, 2), ("en", "a", 5 * 10**12, 1), ("en", "b", 7 * 10**12, 1)], "lang string, phrase string, f long, k int")
    totals = spark.createDataFrame([("en", 9 * 10**13)], "lang string, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda docs: (phrases, totals))
    assert [r.score for r in C.mine(phrases).collect()] == [1000 * 4 * 9 * 10**25 // (35 * 10**24)]
