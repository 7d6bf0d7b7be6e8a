"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

from tokenizers import Tokenizer

from quarterdeck.llm import bpe
from quarterdeck.llm.queries import TOKENIZERS

FILE = f"{TOKENIZERS}/byte_bpe_50k.json"
ODD = ["", " ", "a" * 30_000, "-" * 999, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endof", "ab\x00\x85  z", "՘ அ் 中文 한국 😀", "  \n\n 'Ll it's 12 345"]


def _library(texts):
    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    ids = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    return ids, [t.decode(i, skip_special_tokens=False) for i in ids]


def test_random_texts_equal_the_library():
    rnd = random.Random(3)
    parts = ["a", "b", "th", "ing", "e", " ", "\n", "\t", "1", "23", "--", "==", "'s", "é", "ß", "文字", "😀", "՘", "<|endoftext|>", "\x00", "न", "aaaa", "A", "://"]
    texts = ODD + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 50))) for _ in range(4000)]
    with open(FILE, encoding="utf-8") as f:
        coder = bpe.Coder(bpe.Vocabulary(f.read()))
    ids = coder.encode(texts)
    want_ids, want_texts = _library(texts)
    assert ids == want_ids
    assert [coder.decode(i) for i in ids] == want_texts
    words = {w for t in texts for w in coder.words(t)}
    assert any(coder.v.proposed(w.encode()) != coder.v.merged(w.encode()) for w in words)


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rows = [(i, t, "n", 1) for i, t in enumerate(ODD)] + [(None, None, "n", 2), (3, "same", "n", 3), (3, "same", "n", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = sorted(map(tuple, bpe.digests(docs, FILE).collect()), key=str)
    texts = [r[1] or "" for r in rows]
    ids, back = _library(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted(((r[0], len(i), sha(",".join(map(str, i))), sha(b)) for r, i, b in zip(rows, ids, back, strict=True)), key=str)
    full = bpe.encode(docs, FILE).collect()
    assert sorted(r.decoded for r in full) == sorted(texts) and sorted(r.ids for r in full) == sorted(ids)
    assert bpe.digests(docs.limit(0), FILE).collect() == []
