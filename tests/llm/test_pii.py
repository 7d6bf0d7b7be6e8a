"""Personal data against the patterns as written in the contract."""

import hashlib
import random
import re

from quarterdeck.llm import pii


def _plain(text):
    ds = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        t = [int(c) for c in s[::-1]]
        return (sum(t[0::2]) + sum(sum(divmod(2 * d, 10)) for d in t[1::2])) % 10 == 0

    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(ds(s)) <= 19 and luhn(ds(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(ds(s)) <= 15),
    ]
    return [[m.span() for m in re.finditer(p, text) if ok(m[0])] for p, ok in kinds]


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(5)
    parts = ["a@b.c", "@", "x.y%", "d-e", ".", "1.2.3.4", "256", "0010", "4111 1111 1111 1111", "4111-1111", "5", " ", "-", "+", "(0)", "+1 (555) 123-4567", "é", "ab", "\n", "7992739871", "3"]
    for _ in range(6000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert list(pii.base_spans(t).values()) == _plain(t), t


def test_long_runs_take_linear_time():
    for t in ["a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "@" * 400_000, "a@" * 200_000]:
        pii.find(t)


def test_checksums_and_context():
    iban = "GB82 WEST 1234 5698 7654 32"
    assert [k for _, _, k, _, _ in pii.find(f"pay to {iban} now")[1]] == ["iban"]
    assert pii.find("pay to GB83 WEST 1234 5698 7654 32 now")[1] == []
    near, far = pii.find("my ssn 123-45-6789")[1], pii.find("part 123-45-6789")[1]
    assert [k for _, _, k, _, _ in near] == ["ssn"] and far == []
    assert [k for _, _, k, _, _ in pii.find("call 555 123 4567 today")[1]] == ["local_phone"]
    assert pii.find("rows 555 123 4567 today")[1] == []


def test_iban_before_other_words():
    solid, spaced, british = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    for iban in (solid, spaced, british):
        for before, after in (("IBAN ", " BIC COBADEFF"), ("IBAN ", " BIC COBADEFFXXX"), ("account ", " 100 EUR"), ("REF12 AB12 CODE ", " X"), ("", ""), ("", f" {solid}")):
            got = [(a, b) for a, _, k, b, _ in pii.find(before + iban + after)[1] if k == "iban"]
            assert got[:1] == [(len(before), len(before) + len(iban))] and len(got) == 1 + (solid in after), (before, iban, after)
    assert [k for _, _, k, _, _ in pii.find("IBAN DE88370400440532013000 BIC COBADEFF")[1]] == []
    assert [k for _, _, k, _, _ in pii.find(f"IBAN {solid}1 BIC")[1]] == []
    pii.find("AB12 " * 80_000)


def test_rows(spark):
    docs = spark.createDataFrame([(1, "é a@b.co 😀 1.2.3.4", "s"), (None, None, "s"), (2, "", "s"), (2, "", "s")], "doc_id long, text string, spans string")
    got = sorted(map(tuple, pii.detect(docs).select("doc_id", "n_email", "n_ip", "base_sha256", "spans").collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted([(1, 1, 1, sha("email:2:8,ip:11:18"), "email:2:8,ip:11:18"), (2, 0, 0, sha(""), ""), (2, 0, 0, sha(""), ""), (None, 0, 0, sha(""), "")], key=str)
    assert pii.detect(docs.limit(0)).collect() == []
