"""Removal of repeated 200-byte strings against a plain version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quarterdeck.llm import suffix_dedup
from quarterdeck.llm.arrow_text import prefix_hashes


def plain(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + 200] for _, t in texts for i in range(len(t) - 199))
    out = []
    for d, t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _rows():
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abcdé fgh") for _ in range(n))
    passage = [word(rnd.choice([150, 190, 200, 205, 260, 700])) for _ in range(8)]
    rows = []
    for d in range(120):
        t = ""
        for _ in range(rnd.randint(0, 4)):
            t += rnd.choice(passage) if rnd.random() < 0.5 else word(rnd.randint(0, 300))
        rows.append((d, t))
    edited = list(rows[5][1] + passage[5])
    edited[len(edited) // 2] = "#"
    return rows + [(300, None), (301, ""), (302, rows[9][1]), (302, rows[9][1]), (None, passage[5] + "x"), (303, "a" * 1000), (304, "ab" * 150 + "c"), (305, "".join(edited)), (306, "x" * 200)]


def test_against_plain(spark):
    rows = _rows()
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, first int, tid string").repartition(4)
    got = suffix_dedup.remove(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)
    assert suffix_dedup.remove(docs.limit(0)).collect() == []


def test_split_groups_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    rows = _rows()
    got = suffix_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_no_task_sorts_a_hot_passage(spark, monkeypatch):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = word(300)
    rows = [(d, word(300) + passage + word(300)) for d in range(200)]
    sorts, most = suffix_dedup._sorted_groups, []

    def watched(contexts):
        keys = [c for c in ("anchor", "salt") if c in contexts.columns]
        most.append(max((r["count"] for r in contexts.groupBy(*keys).count().collect()), default=0))
        return sorts(contexts)

    monkeypatch.setattr(suffix_dedup, "GROUP", 20)
    monkeypatch.setattr(suffix_dedup, "_sorted_groups", watched)
    got = suffix_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)
    assert len(most) == 1 and most[0] <= 20


def test_suffix_order_is_lexicographic():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    start, group = rng.permutation(3700)[:500], np.sort(rng.integers(0, 5, 500))
    order = suffix_dedup.sort_suffixes(data, prefix_hashes(data), group, start)
    want = sorted(range(500), key=lambda i: (group[i], data[start[i] : start[i] + 200].tobytes(), i))
    assert order.tolist() == want


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    part = rng.integers(97, 99, 400).astype(np.uint8)
    a, b = (np.concatenate([rng.integers(97, 99, n).astype(np.uint8), part]) for n in (70, 333))
    for x in (a, b):
        assert suffix_dedup.anchors(x)[3].sum() == len(x) - 199

    def of(x, w):
        _, place, first, _, _ = suffix_dedup.anchors(x)
        return place[np.searchsorted(first, w, side="right") - 1] - w

    for i in range(200):
        assert of(a, 70 + i) == of(b, 333 + i)


@pytest.mark.parametrize("parts", [1, 6])
def test_numbers_of_copies_around_a_byte(spark, parts):
    rnd, rows, d = random.Random(4), [], 0
    for copies in (255, 256, 257, 512):
        text = "".join(rnd.choice("abcdefgh ") for _ in range(200))
        for _ in range(copies):
            rows.append((d, text))
            d += 1
    # One anchor 256 times inside a text.
    unit = "".join(rnd.choice("abcdefgh ") for _ in range(250))
    rows.append((d, "#".join([unit] * 256)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = suffix_dedup.remove(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)
