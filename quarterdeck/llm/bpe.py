"""Byte-level BPE: greedy proposal, check of every adjacent pair, exact merging of the words that fail.

A token sequence is the BPE encoding of its bytes exactly if each token encodes to itself and no merge can cross a
boundary between neighbours. The pieces that touch a boundary during merging form a chain on either side; a
crossing merge happens if its rank comes before the merges that absorb the two pieces. Chains are rows of two
arrays, so all new pairs of a batch are tested together.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import pre_tokenizers

from quarterdeck.llm.arrow_text import column, pieces

#: Fixed value: the published pattern of this vocabulary family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"
_NEVER = 1 << 40
#: The pattern's classes depend on a library's Unicode version from here on.
_LATER = regex.compile("[԰-\U0010ffff]")
_CACHE_BYTES = 160 << 20


def byte_letters() -> dict[str, int]:
    """Letters that stand for the 256 bytes: printable bytes for themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


class Vocabulary:
    """Tables of a tokenizer file of byte-level BPE without normaliser."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters = byte_letters()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = regex.compile("|".join(regex.escape(a) for a in sorted(self.added, key=len, reverse=True))) if self.added else None
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in self.added}
        self.bytes_of = {i: bytes(letters[c] for c in k) for k, i in vocab.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.bytes_of |= {i: a.encode() for a, i in self.added.items()}
        self.longest: dict[bytes, int] = {}
        for b in self.id_of:
            self.longest[b[:2]] = max(len(b), self.longest.get(b[:2], 1))
        size = max(self.bytes_of) + 1
        left, right, born = np.full(size, -1), np.full(size, -1), np.full(size, -1, np.int64)
        self.rank: dict[tuple[int, int], int] = {}
        self.product: list[int] = []
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            a, b, ab = vocab[a], vocab[b], vocab[a + b]
            self.rank[a, b] = r
            self.product.append(ab)
            if born[ab] < 0:
                left[ab], right[ab], born[ab] = a, b, r
        self.right_chain, self.right_end = self._chains(right, born)
        self.left_chain, self.left_end = self._chains(left, born)
        self.born = born
        keys = np.array([a * size + b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.size, self.pair_keys = size, keys[order]
        self.pair_ranks = np.fromiter(self.rank.values(), np.int64, len(self.rank))[order]
        self.valid_token: dict[int, bool] = {}
        self.valid_pair: dict[int, bool] = {}
        self.text_of = {i: str(i) for i in self.bytes_of}

    @staticmethod
    def _chains(part: np.ndarray, born: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token, its pieces at one edge from the whole token inwards, and the rank at which each is absorbed."""
        pieces_, ends = [np.arange(len(part))], [np.full(len(part), _NEVER)]
        while (alive := pieces_[-1] >= 0).any():
            now = np.where(alive, part[pieces_[-1]], -1)
            if not (now >= 0).any():
                break
            ends.append(np.where(now >= 0, born[pieces_[-1]], -1))
            pieces_.append(now)
        return np.stack(pieces_), np.stack(ends)

    def merged(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost of equals."""
        ids = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        return self._merged_short(ids) if len(ids) <= 64 else self._merged_long(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        get = self.rank.get
        ranks = [get(p, _NEVER) for p in zip(ids, ids[1:], strict=False)]
        while ranks and (low := min(ranks)) < _NEVER:
            i = ranks.index(low)
            ids[i : i + 2] = [self.product[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), _NEVER)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), _NEVER)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same in n log n steps, with a heap and linked neighbours."""
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        heap = [(self.rank[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            low, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j >= len(ids) or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = self.product[low], -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (ids[a], ids[b]) in self.rank:
                    heapq.heappush(heap, (self.rank[ids[a], ids[b]], a, (ids[a], ids[b])))
        return [i for i in ids if i >= 0]

    def proposed(self, word: bytes) -> list[int]:
        """Longest token at each place."""
        get = self.id_of.get
        if (whole := get(word)) is not None:
            return [whole]
        out, at, longest, size = [], 0, self.longest.get, len(word)
        while at < size:
            end = at + longest(word[at : at + 2], 1)
            if end > size:
                end = size
            while (i := get(word[at:end])) is None:
                end -= 1
            out.append(i)
            at = end
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair, whether no merge crosses the boundary between token a and token b."""
        ok = np.ones(len(a), bool)
        for pa_, ea in zip(self.right_chain, self.right_end, strict=True):
            x, x_end = pa_[a], ea[a]
            if not (x >= 0).any():
                break
            for pb_, eb in zip(self.left_chain, self.left_end, strict=True):
                y, y_end = pb_[b], eb[b]
                live = np.flatnonzero((x >= 0) & (y >= 0) & ok)
                if not len(live):
                    break
                key = x[live] * self.size + y[live]
                at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                rank = np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NEVER)
                # Of equal ranks the leftmost merge comes first: before the right piece's, after the left piece's.
                start = np.maximum(self.born[x[live]], self.born[y[live]])
                meet = start < np.minimum(x_end[live], y_end[live])
                ok[live[meet & (rank < x_end[live]) & (rank <= y_end[live]) & (rank < _NEVER)]] = False
        return ok

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Tokens of each word."""
        proposals = [self.proposed(w) for w in words]
        for t in {t for p in proposals for t in p} - self.valid_token.keys():
            self.valid_token[t] = self.merged(self.bytes_of[t]) == [t]
        pairs = [[a * self.size + b for a, b in zip(p, p[1:], strict=False)] for p in proposals]
        if new := {k for ks in pairs for k in ks} - self.valid_pair.keys():
            keys = np.fromiter(new, np.int64, len(new))
            self.valid_pair.update(zip(keys.tolist(), self.compatible(keys // self.size, keys % self.size).tolist(), strict=True))
        token, pair = self.valid_token.__getitem__, self.valid_pair.__getitem__
        out = [p if all(map(token, p)) and all(map(pair, ks)) else self.merged(w) for w, p, ks in zip(words, proposals, pairs, strict=True)]
        if len(self.valid_pair) > 1_000_000:
            self.valid_pair.clear()
        return out


class Coder:
    """Encoder and decoder of texts with a bounded cache of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.find = regex.compile(PATTERN).findall
        self.exact = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.cache: dict[str, list[int]] = {}
        self.held = 0

    def words(self, text: str) -> list[str]:
        """Words of the pattern; from U+0530 on the library's own splitter decides what is a letter."""
        if text.isascii() or not _LATER.search(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.exact.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        parts: list[list[list[str] | int]] = []
        for t in texts:
            row: list[list[str] | int] = []
            at = 0
            for m in self.v.split_added.finditer(t) if self.v.split_added else ():
                row += [self.words(t[at : m.start()]), self.v.added[m[0]]]
                at = m.end()
            parts.append([*row, self.words(t[at:])])
        new = list({w for row in parts for p in row if isinstance(p, list) for w in p} - self.cache.keys())
        self.cache.update(zip(new, self.v.encode_words([w.encode() for w in new]), strict=True))
        self.held += sum(200 + 10 * len(w) for w in new)
        get = self.cache.__getitem__
        out = [[i for p in row for ids in ([[p]] if isinstance(p, int) else map(get, p)) for i in ids] for row in parts]
        if self.held > _CACHE_BYTES:
            self.cache.clear()
            self.held = 0
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.v.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_CODERS: dict[str, Coder] = {}


def _coder(text: str) -> Coder:
    """One coder per worker and vocabulary, so that its cache outlives a task."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(Vocabulary(text))
    return _CODERS[key]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, ids, decoded, and the digests of the decimal ids joined by commas and of `decoded`.

    `tokenizer` is the path of the vocabulary file on the driver; its text (a few MB) is broadcast. Null and empty
    texts give no ids and an empty string. Repeated rows give repeated rows; other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        names = coder.v.text_of.__getitem__
        for batch, texts in pieces(batches):
            ids = coder.encode([(t or b"").decode() for t in texts])
            decoded = [coder.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id").cast(pa.int64()),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(decoded, pa.string()),
                    pa.array([hashlib.sha256(",".join(map(names, i)).encode()).hexdigest() for i in ids]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded]),
                ],
                ["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    return encode(docs, tokenizer).drop("ids", "decoded")
