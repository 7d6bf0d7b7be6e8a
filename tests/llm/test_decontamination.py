"""Benchmark search against all windows."""

import random
import re
from collections import Counter

import numpy as np

from quarterdeck.llm import decontamination as D


def _bag(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain(docs, items):
    out = set()
    for d, t in docs:
        w = _words(t)
        for i, u in items:
            v = _words(u)
            if not w or not v or (len(v) < 5 and len(v) != len(w)):
                continue
            n = min(len(v), len(w))
            for s in range(len(w) - n + 1):
                a, b = _bag(w[s : s + n]), _bag(v)
                both = sum((a & b).values())
                if both / (a.total() + b.total() - both) >= 0.8:
                    out.add((d, i))
    return out


def _data():
    rnd = random.Random(6)
    items = [(k, " ".join(f"i{rnd.randint(0, 300)}" for _ in range(rnd.choice([3, 8, 25, 40, 60])))) for k in range(25)] + [(90, None), (91, "  ")]
    docs = []
    for d in range(160):
        t = [f"w{rnd.randint(0, 90)}" for _ in range(rnd.randint(0, 60))]
        if rnd.random() < 0.5:
            v = _words(rnd.choice(items[:25])[1])
            for _ in range(rnd.choice([0, 0, 1, 2])):
                v[rnd.randrange(len(v))] = "x"
            t = t + v + t[:10]
        docs.append((d, " ".join(t).upper() if d % 3 else "\n".join(t)))
    return docs + [(500, None), (501, ""), (502, items[3][1]), (502, items[3][1]), (503, items[0][1]), (None, items[4][1])], items


def test_finds_what_all_windows_find(spark):
    docs, items = _data()
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain(docs, items)
    held = {d for d, _ in plain(docs, items)}
    left = D.clean(frame, bench)
    assert left.columns == frame.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((d for d, _ in docs if d not in held), key=str)
    assert D.find(frame.limit(0), bench).collect() == [] and D.find(frame, bench.limit(0)).collect() == []


def test_byte_tables_find_the_whole_radius():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 256, (50, 8), dtype=np.uint8)
    found = prints[rng.integers(0, 50, 400)].copy()
    for row in found:
        for bit in rng.permutation(64)[: rng.integers(0, 26)]:
            row[bit // 8] ^= 1 << (bit % 8)
    want = {(i, j) for i in range(400) for j in range(50) if sum(bin(int(x)).count("1") for x in found[i] ^ prints[j]) <= D.RADIUS}
    assert set(D.Items._within(found, prints)) == want
