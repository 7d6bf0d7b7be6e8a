"""Held-out accuracy and odd rows of the toxicity classifier."""

import os
import re
import tracemalloc

import numpy as np
import pytest
from conftest import SF

from quarterdeck.llm import toxicity


def test_learns_only_from_rows_that_are_not_held_out(spark):
    rows = [(d, ("you vile grobnik " if d % 4 == 0 else "a mild remark ") + f"number {d * 7919 % 1000} of the day") for d in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d % 4 == 0)) for d, _ in rows], "doc_id long, toxic int")
    out = toxicity.classify(docs, labels).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in out) and 40 < sum(r.held_out for r in out) < 120
    wrong = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    assert sorted(map(tuple, toxicity.classify(docs, wrong).collect())) == sorted(map(tuple, out))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (2, "", 9), (None, "x", 9), (3, "a" * 200_000, 9)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(2, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity.classify(docs, labels).collect()
    assert len(out) == 5 and all(0 < r.score < 1 for r in out)
    none = toxicity.classify(docs, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.classify(docs.limit(0), labels).collect() == []
    kept = toxicity.reject(docs, toxicity.fit(docs, labels.limit(0)))
    assert kept.columns == docs.columns and kept.count() == 5


def test_held_out_accuracy(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    if not os.path.exists(sf):
        pytest.skip("the larger table is not there")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels).where("held_out").join(labels, "doc_id")
    r = out.selectExpr("avg(if(toxic = 1, predicted, null)) AS found", "avg(if(toxic = 0, predicted, null)) AS wrong").first()
    assert r.found > 0.65 and r.wrong < 0.01


def test_fit_holds_little_besides_its_rows():
    """The driver's memory: once it held eight arrays with an entry of eight bytes per feature of the sample."""
    rnd = np.random.default_rng(2)
    rows = [np.unique(rnd.integers(0, 1 << toxicity.BITS, 4000)).astype(np.int32) for _ in range(600)]
    labels = np.arange(600) % 2
    rows = [np.unique(np.append(r, np.arange(50) + 100 * y)).astype(np.int32) for r, y in zip(rows, labels, strict=True)]
    tracemalloc.start()
    model = toxicity.fit_rows(rows, labels, np.ones(600))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * sum(r.nbytes for r in rows)
    z = np.array([model.bias + model.weights[r].sum() for r in rows])
    assert ((z > 0) == (labels == 1)).mean() > 0.99


def test_freed_memory_of_a_fit_goes_back(spark):
    """The driver kept what the fit had freed, for all later stages of the pipeline."""
    if not os.path.exists("/proc/self/smaps_rollup"):
        pytest.skip("Linux only")
    held = lambda: int(re.search(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024
    docs = spark.createDataFrame([(d, ("vile grobnik " if d % 2 else "mild remark ") + str(d)) for d in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(d, d % 2) for d in range(60)], "doc_id long, toxic int")
    before = held()
    blocks = [np.ones(12_000, np.int32) for _ in range(4000)]
    between = blocks[::100]
    del blocks
    assert held() > before + 100
    toxicity.fit(docs, labels)
    assert held() < before + 60 and len(between) == 40
