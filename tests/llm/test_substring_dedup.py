"""Removal of repeated 13-word windows against a plain version."""

import hashlib
import random
import re

import numpy as np
import pytest

from quarterdeck.llm import sketch, substring_dedup


def plain(rows):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            if d is not None:
                first[k] = min(d, first.get(k, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 12):
            if d is not None and first[tuple(w[i : i + 13])] < d:
                gone |= set(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_plain(spark):
    rnd = random.Random(2)
    passage = [[f"p{k}w{i}" for i in range(rnd.randint(5, 40))] for k in range(6)]
    rows = []
    for d in range(150):
        w = []
        for _ in range(rnd.randint(0, 5)):
            w += rnd.choice(passage) if rnd.random() < 0.5 else [rnd.choice("a b é c d e".split(" ")) for _ in range(rnd.randint(0, 20))]
        rows.append((d, rnd.choice([" ", "\n", " \t "]).join(w)))
    rows += [(7, rows[30][1]), (None, rows[3][1]), (200, None), (201, ""), (202, rows[10][1]), (202, rows[10][1]), (203, "x " * 3000)]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, kept string, h int").repartition(5)
    got = substring_dedup.remove(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)
    assert substring_dedup.remove(docs.limit(0)).collect() == []


def test_saturated_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(sketch, "bits_for", lambda n: 17)
    rows = [(d, " ".join(f"w{(d * 50 + i) % 9000}" for i in range(300))) for d in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.remove(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


@pytest.mark.parametrize("parts", [1, 6])
def test_numbers_of_copies_around_a_byte(spark, parts):
    rows, d = [], 0
    for copies in (255, 256, 257, 512):
        for _ in range(copies):
            rows.append((d, " ".join(f"c{copies}w{i}" for i in range(13))))
            d += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = substring_dedup.remove(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_counters_stay_at_two():
    counts = np.zeros(8, np.uint8)
    for offsets in ([1] * 256, [2] * 257 + [3], [3], [4], [1] * 512):
        sketch.add(counts, np.array(offsets))
    assert counts.tolist() == [0, 2, 2, 2, 1, 0, 0, 0]


def test_very_long_text(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(400_000))), (2, "a " + " ".join(f"w{i}" for i in range(390_000, 400_000)) + " b")]
    got = substring_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_words", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(1, 400_000, 0), (2, 10_002, 10_000)]
