"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Each kind has a pattern, a validator and a score. The four base kinds are decided by pattern and validator alone
and are always kept. The further kinds (IBAN, national id, phone numbers without a leading plus) are scored:
pattern score, plus what a checksum adds, plus what context words before the span add; spans from `THRESHOLD` on
are kept. Patterns begin at the start of a run and never give characters back, so their time is linear.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quarterdeck.llm.arrow_text import column, pieces

THRESHOLD = 0.6
#: Characters before and after a span in which context words count.
CONTEXT = 40
SCHEMA = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, scores string"

_AT_LEFT = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+().-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")
#: Characters of an IBAN by country code.
_IBAN_LENGTH = {
    code: int(n)
    for n, codes in (
        x.split(":")
        for x in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
            "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
        ).split()
    )
    for code in codes.split(",")
}
#: Score of the pattern, what a checksum adds, what a context word adds, context words.
_SCORED = {
    "iban": (0.3, 0.5, 0.2, re.compile(r"iban|account|konto|cuenta|compte|bank", re.I)),
    "ssn": (0.3, 0.0, 0.4, re.compile(r"ssn|social security|national id|tax id|steuer", re.I)),
    "local_phone": (0.3, 0.0, 0.4, re.compile(r"phone|tel\b|tel[.:]|telefon|téléphone|teléfono|mobile|handy|call|fax", re.I)),
}
KINDS = ["email", "ip", "card", "phone", *_SCORED]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The bank account check: rotated by four characters, letters as two digits, remainder 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans with a right checksum. A candidate may run on into the words behind it, so it is cut at the length of its
    country; with a code that is in no list, at each end of a group, the longest first. What fails is searched again
    from the next word on: a match has 64 characters at most, so the time stays linear."""
    at = 0
    while m := _IBAN.search(text, at):
        a, at = m.start(), m.start() + 1
        ends = [i + 1 for i in range(a, m.end()) if text[i] != " "]  # end after so many characters
        fixed = _IBAN_LENGTH.get(text[a : a + 2])
        for n in range(min(34, len(ends)), 14, -1) if fixed is None else (fixed,):
            if n <= len(ends) and (ends[n - 1] == m.end() or text[ends[n - 1]] == " ") and mod97(text[a : ends[n - 1]].replace(" ", "")):
                at = ends[n - 1]
                yield a, at
                break


def emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _AT_LEFT:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            last = max(last, at + 1)  # the run before this sign is never part of a later match
            at = text.find("@", at + 1)
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _low_parts(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in s.split("."))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {"email": emails(text) if "@" in text else [], "ip": [], "card": [], "phone": []}
    out["ip"] = [m.span() for m in _IP.finditer(text) if _low_parts(m[0])]
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def scored_spans(text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple[int, str, int, float]]:
    """(start, kind, end, score) of the further kinds; a span that touches a base span is not proposed again."""
    taken = sorted(s for spans in base.values() for s in spans)
    found = []
    for kind, pattern in (("iban", None), ("ssn", _SSN), ("local_phone", _LOCAL)):
        start_score, sum_score, near_score, near = _SCORED[kind]
        for a, b in ibans(text) if pattern is None else (m.span() for m in pattern.finditer(text)):
            score = start_score + (sum_score if kind == "iban" else 0)
            if near.search(text, max(0, a - CONTEXT), min(len(text), b + CONTEXT)):
                score += near_score
            if score >= THRESHOLD and (kind == "iban" or not any(x < b and a < y for x, y in taken)):
                found.append((a, kind, b, round(score, 2)))
    return found


def find(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[int, int, str, int, float]]]:
    """Base spans by kind, and all spans as (start, order of kind, kind, end, score), sorted."""
    base = base_spans(text)
    every = [(a, KINDS.index(k), k, b, 1.0) for k, spans in base.items() for a, b in spans]
    every += [(a, KINDS.index(k), k, b, s) for a, k, b, s in scored_spans(text, base)]
    return base, sorted(every)


def detect(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: counts of the base kinds, the digest of the base spans, all spans and their scores.

    Spans count code points, end exclusive, as `kind:start:end` joined by commas. Null text counts as empty and has
    no span. Repeated rows give repeated rows; doc_id may be null; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            counts, digests, spans, scores = [[], [], [], []], [], [], []
            for t in texts:
                base, every = find((t or b"").decode())
                for c, k in zip(counts, KINDS, strict=False):
                    c.append(len(base[k]))
                only = ",".join(f"{k}:{a}:{b}" for a, n, k, b, _ in every if n < 4)
                digests.append(hashlib.sha256(only.encode()).hexdigest())
                spans.append(",".join(f"{k}:{a}:{b}" for a, _, k, b, _ in every))
                scores.append(",".join(str(s) for *_, s in every))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(scores, pa.string())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
