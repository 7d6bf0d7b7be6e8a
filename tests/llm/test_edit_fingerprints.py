"""Edit fingerprints against a walk step by step, the edited texts against plain strings, links against all pairs."""

import hashlib
import random

import numpy as np

from quarterdeck.llm import edit_fingerprints as E


def _bit(c, t):
    return bool(E._random(1, np.int64(c), np.int64(t % E.PERIOD)) & np.uint64(1))


def plain_print(text):
    """Reads the characters one step at a time, then looks up the sampled steps."""
    embedding = []
    for ch in text:
        c = int(E._random(3, np.uint32(ord(ch))) % np.uint64(E.CLASSES))
        while True:
            embedding.append(ch)
            if _bit(c, len(embedding) - 1):
                break
    if not embedding:
        return "00" * E.SLOTS
    out = []
    for s in range(E.SLOTS):
        step = max(r for r in E.RECORDS[s].tolist() if r < len(embedding))
        out.append(int(E._random(4, np.int64(s), np.int64(step), np.uint32(ord(embedding[step]))) % np.uint64(255)) + 1)
    return bytes(out).hex()


def plain(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (d, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        t, u = t or "", u or ""
        h = len(t) // 2
        e = t[: len(t) - h] + u[:h]
        f, g, n = plain_print(t), plain_print(e), plain_print(u)
        like = lambda a, b: sum(a[i : i + 2] == b[i : i + 2] for i in range(0, 2 * E.SLOTS, 2)) / E.SLOTS
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, like(f, g), like(f, n)))
    return sorted(out, key=str)


def _text(rnd, n):
    return "".join(rnd.choice("abcdefghij éß日\n ") for _ in range(n))


def test_against_plain(spark, monkeypatch):
    rnd = random.Random(21)
    rows = [(d * 3, _text(rnd, rnd.choice([0, 1, 2, 3, 40, 300]))) for d in range(60)] + [(1000, None), (1001, ""), (1002, None), (None, "null id"), (1003, "x" * 5000), (1004, "x" * 5000)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, part int, fp string").repartition(4)
    want = plain(rows)
    for size in (1 << 25, 700):
        monkeypatch.setattr(E, "PART_BYTES", size)
        got = E.compare_edits(docs)
        assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert E.compare_edits(docs.limit(0)).collect() == []
    one = E.compare_edits(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "same text"), (1, "same text"), (2, "other")], "doc_id long, text string")
    got = E.compare_edits(docs).collect()
    assert len(got) == 3 and len({r.fingerprint for r in got}) == 2
    assert sorted(r.near_next for r in got if r.doc_id == 1)[-1] == 1.0


def test_likeness_follows_edits():
    rnd = random.Random(4)
    base, other = _text(rnd, 6000), _text(rnd, 6000)
    one = base[:3000] + "edit" + base[3000:]
    half = base[:3000] + other[:3000]
    f = E.prints([base, one, half, other, base])
    like = [float(E.likeness(f[0], x)) for x in f]
    assert like[4] == 1.0 and like[1] > 0.75 and 0.35 < like[2] < 0.7 and like[3] < 0.25


def test_walks_side_by_side_and_alone_agree(monkeypatch):
    rnd = random.Random(5)
    texts = [_text(rnd, rnd.randint(0, 900)) for _ in range(40)] + [_text(rnd, 200_000)]
    together = E.prints(texts)
    monkeypatch.setattr(E, "WIDE", 1 << 30)
    assert (E.prints(texts) == together).all()


def test_sampled_steps_are_uniform():
    steps = np.array([max(r for r in E.RECORDS[s].tolist() if r < 1000) for s in range(E.SLOTS)])
    assert 380 < steps.mean() < 620 and len(set(steps.tolist())) > 80


def test_links_against_all_pairs(spark):
    rnd = random.Random(6)
    rows = []
    for family in range(25):
        base = _text(rnd, rnd.choice([400, 1500]))
        for k in range(rnd.choice([1, 2, 12])):
            at = rnd.randrange(len(base))
            rows.append((family * 100 + k, base[:at] + ("#" * (k % 3)) + base[at:]))
    rows += [(9000, rows[0][1]), (9001, rows[0][1]), (9002, ""), (9003, None), (None, rows[0][1])]
    fp = E.prints([t or "" for _, t in rows])
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for i, (a, s) in enumerate(rows):
        for j, (b, t) in enumerate(rows[:i]):
            if a is not None and b is not None and s and t and E.likeness(fp[i], fp[j]) >= 0.8:
                links += s != t
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert links > 100
    got = E.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(((r.doc_id, r.component_id) for r in got.collect()), key=str) == sorted(((d, None if d is None else root(d)) for d, _ in rows), key=str)
    assert E.link(got.selectExpr("doc_id", "'' AS text").limit(0)).collect() == []
