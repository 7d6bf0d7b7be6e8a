"""Near-duplicate components against all pairs."""

import random
import re

import numpy as np

from quarterdeck.llm import near_dedup


def plain(rows, percent):
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                comp[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, len(sets[i]), least[root(i)], least[root(i)] == d) for i, (d, _) in enumerate(rows))


def _rows():
    rnd = random.Random(4)
    rows = []
    for g in range(40):
        base = [f"g{g}x{rnd.randint(0, 60)}" for _ in range(rnd.randint(1, 150))]
        for _ in range(rnd.randint(1, 6)):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                w[rnd.randrange(len(w))] = f"n{rnd.randint(0, 9)}"
            rows.append(" ".join(w))
    rows += ["", None, " \n ", "One TWO three", "one two three", "one two"]
    rnd.shuffle(rows)
    return list(enumerate(rows, 100))


def test_components_equal_all_pairs(spark):
    rows = _rows()
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, component_id int, cls string").repartition(4)
    for percent in (85, 80):
        got = near_dedup.link(docs, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
        assert sorted(map(tuple, got)) == plain(rows, percent)


def test_exhaustive_comparison_of_a_large_group(spark):
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(60):
        w = list(base)
        for i in rnd.sample(range(120), rnd.choice([0, 1, 2, 3])):
            w[i] = f"x{rnd.randint(0, 3)}"
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.link(docs, 85, exhaustive=True).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == plain(rows, 85)


def test_link_of_two_members_that_are_no_hubs(spark, monkeypatch):
    """A template family in one bucket: no star round confirms a link, one pair is similar enough."""
    monkeypatch.setattr(near_dedup, "band_keys", lambda filled, *_: np.full((len(filled), 1), 7, np.uint64))
    rows = []
    for d in range(40):
        w = [f"t{i}" if i % 20 else f"d{17 if d == 29 else d}x{i}" for i in range(100)]
        w[50] = "changed" if d == 29 else w[50]
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.link(docs, 85).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert [d for d, _, _, kept in plain(rows, 85) if not kept] == [29]
    assert sorted(map(tuple, got)) == plain(rows, 85)


def test_bands_follow_the_threshold():
    assert near_dedup.banding(85) == (21, 6) and near_dedup.banding(80) == (25, 5)
    for percent in range(50, 100, 5):
        bands, rows = near_dedup.banding(percent)
        assert bands * rows <= 128 and (1 - (percent / 100) ** rows) ** bands <= near_dedup.MISSED


def test_odd_rows(spark):
    same = "a b c d e f g"
    docs = spark.createDataFrame([(1, same), (1, same), (2, same), (None, same), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.link(docs).select("doc_id", "component_id", "kept").collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True), (None, None, True)]
    assert near_dedup.link(docs.limit(0)).collect() == []
    kept = near_dedup.dedupe(docs)
    assert kept.columns == docs.columns and kept.count() == 4


def test_densified_bins_agree_as_often_as_sets():
    rng = np.random.default_rng(1)
    share = []
    for _ in range(60):
        common, a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (40, 10, 10))
        x, y = np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b]))
        m = near_dedup.bins([x, y])
        share.append((m[0] == m[1]).mean())
    assert abs(np.mean(share) - 40 / 60) < 0.03


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200)], "a long, b long")
    got = {r.doc: r.component for r in near_dedup.components(links).collect()}
    assert set(got.values()) == {0, 100} and got[60] == 0 and got[200] == 100


def test_last_join_makes_few_rows_of_a_template(spark):
    """Members that each lack a part of the template: most pairs differ in too many shingles, which their parities tell."""
    rows = [(d, " ".join(f"t{i}" for i in range(120) if not d <= i < d + 16)) for d in range(1, 101)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = near_dedup.signatures(docs, 85).selectExpr("cls", "doc_id AS doc", "n_shingles AS n", "doc_id AS component")
    pairs = near_dedup._prefix_pairs(classes, near_dedup._sets(docs, classes.select("cls", "doc")), 85).collect()
    found = {(min(r.doc, r.doc2), max(r.doc, r.doc2)) for r in pairs}
    w = {d: t.split() for d, t in rows}
    sets = {d: {tuple(x[i : i + 5]) for i in range(len(x) - 4)} for d, x in w.items()}
    similar = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert similar and similar <= found and len(found) < 2 * len(similar)


def test_parity_differs_in_no_more_bits_than_sets_do():
    rnd = np.random.default_rng(5)
    bits = lambda a, b: sum(int(x).bit_count() for x in (near_dedup.parity(a) ^ near_dedup.parity(b)).view(np.uint64))
    for n in (1, 5, 100, 3000):
        h = rnd.integers(0, 2**63, n + 40)
        for k in (0, 1, 7, 40):
            assert bits(h[:n], h[k : n + k]) <= 2 * min(n, k)
