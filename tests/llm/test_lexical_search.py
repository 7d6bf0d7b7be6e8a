"""Ranked search against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np

from quarterdeck.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain(docs, items):
    bags = [(d, Counter(_terms(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(_terms(t))
    out = []
    for i, ts in wanted.items():
        scores = []
        for d, b in bags:
            m = 10 + 90 * b.total() * n_docs // max(1, n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t in ts if b[t])
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        out += [(i, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores)[:10])]
    return sorted(out, key=str)


def _data():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(150)] + ["été", "Straße", "日本", "É"]
    text = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", "-", ". ", "\n", "_"]) for _ in range(n))
    docs = [(d, text(rnd.choice([0, 1, 5, 30, 200]))) for d in range(300)]
    docs += [(d, docs[7][1]) for d in range(400, 430)] + [(7, docs[7][1])] * 3 + [(None, docs[7][1]), (500, None), (501, ""), (502, " .-"), (503, "w1 " * 50_000)]
    items = [(i, text(rnd.randint(1, 40))) for i in range(25)] + [(30, None), (31, "..."), (32, "unknown"), (None, "w3 W4"), (33, docs[7][1]), (1, "w5 w6")]
    return docs, items


def _rows(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def test_against_plain(spark):
    docs, items = _data()
    frame = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, item int, score string").repartition(5)
    bench = spark.createDataFrame([(*r, 2) for r in items], "item_id int, text string, rank int")
    assert _rows(L.search(frame, bench)) == plain(docs, items)
    assert L.search(frame.limit(0), bench).collect() == [] and L.search(frame, bench.limit(0)).collect() == []


def test_small_tiles_and_blocks_give_the_same(spark, monkeypatch):
    docs, items = _data()
    monkeypatch.setattr(L, "BLOCK_BYTES", 500)
    for cells, tile, exact in ((64, 3, 1 << 53), (1 << 21, 1024, 1 << 36)):
        monkeypatch.setattr(L, "TILE_CELLS", cells)
        monkeypatch.setattr(L, "ITEM_TILE", tile)
        monkeypatch.setattr(L, "EXACT", exact)
        assert _rows(L.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))) == plain(docs, items)


def test_top_keeps_ties_in_any_order():
    rng = np.random.default_rng(5)
    scores, docs = rng.integers(0, 4, (6, 200)), rng.permutation(200)
    best = L.Best(6)
    for a in range(0, 200, 7):
        best.add(scores[:4, a : a + 7], 0, docs[a : a + 7])
        best.add(scores[4:, a : a + 7], 4, docs[a : a + 7])
    for i in range(6):
        want = sorted((-s, d) for s, d in zip(scores[i].tolist(), docs.tolist(), strict=True) if s)[:10]
        assert [(-s, d) for s, d in zip(best.score[i].tolist(), best.doc[i].tolist(), strict=True) if s] == want
