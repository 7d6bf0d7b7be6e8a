"""The pipeline on planted cases."""

import random

from tokenizers import Tokenizer

import corpus_pipeline
from quarterdeck.llm.queries import TOKENIZERS


def test_stages_remove_what_is_planted(spark, tmp_path):
    rnd = random.Random(1)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    clean = {d: "\n".join(text(25) for _ in range(4)) for d in range(100, 500)}
    toxic = {d: text(15) + " vile grobnik scum " + text(15) for d in range(1000, 1160)}
    item = text(40)
    planted = {
        2000: clean[100] + " tail",  # near copy
        2001: clean[101],  # exact copy
        2002: text(30) + "\n" + item,  # benchmark passage
        2003: text(50) + "\n" + clean[102].split("\n")[2],  # repeated line
    }
    docs = [(d, t, "en", "s", len(t)) for d, t in {**clean, **toxic, **planted}.items()] + [(3000, None, None, None, None), (3001, "", "en", "s", 0)]
    labels = [(d, 1, int(d in toxic)) for d in [*clean, *toxic] if d % 10]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    read, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        read = stage(spark, read, str(tmp_path))
        assert read.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
        read.write.parquet(f"{tmp_path}/{name}")
        read = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in read.collect()}
    assert not set(seen["toxicity"]) & set(toxic) and set(seen["toxicity"]) == {d for d, *_ in docs} - set(toxic)
    lines = seen["line_dedup"]
    assert lines[2001].text == "" and lines[2003].text == planted[2003].split("\n")[0] and lines[2003].n_chars == len(lines[2003].text)
    assert all(lines[d].text == t for d, t in clean.items()) and lines[3000].text is None
    assert set(seen["decontamination"]) == set(seen["near_dedup"]) - {2002} and set(clean) <= set(seen["decontamination"])

    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == set(seen["decontamination"])
    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    assert all(r.ids == t.encode(seen["decontamination"][d].text or "", add_special_tokens=False).ids for d, r in out.items())
