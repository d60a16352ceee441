"""Byte-level BPE by batched merge rounds in numpy.

The symbols of all words of a batch lie in one flat array. A round looks up the
rank of each pair of neighbours (binary search over the sorted keys of known
pairs), takes the lowest rank of each word, and merges that pair wherever it
stands in the word, from left to right. Words without a known pair leave the
array. A word is encoded once a batch, and the latest words are remembered
(``CACHE_WORDS``). Words of over ``LONG`` symbols, which would hold a batch up
for as many rounds, are merged alone with a heap; the result is the same.

Null text is empty and has no tokens. Rows are independent; repeated rows, null
ids and further columns change nothing. An empty table gives no rows. The text
of a special token is that token, as in the vocabulary file.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvia.llm import _text as T

LONG = 256
CACHE_WORDS = 200_000
CHUNK_BYTES = 1 << 20
#: White space of Unicode.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The splitting pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, more = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(more)
            more += 1
    return [letters[b] for b in range(256)]


class Flat:
    """Lists of different lengths in one array."""

    def __init__(self, values: np.ndarray, bounds: np.ndarray):
        self.values, self.bounds = values, bounds

    def take(self, index: np.ndarray) -> Flat:
        size = (self.bounds[1:] - self.bounds[:-1])[index]
        bounds = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1][index] - bounds[:-1], size)
        return Flat(self.values[at], bounds)

    @staticmethod
    def of(lists: list[bytes]) -> Flat:
        return Flat(np.frombuffer(b"".join(lists), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]))


class Codec:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for s, i in vocab.items():
            spelled[i] = bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
        for s, i in self.special.items():
            spelled[i] = s.encode()
        self.bytes = Flat.of(spelled)
        self.decimals = Flat.of([b"%d," % i for i in range(size)])
        self.of_byte = np.array([vocab[c] for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(key)
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), np.array([vocab[a + b] for a, b in merges], np.int64)
        self.parts = regex.compile(PATTERN)
        self.pieces = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
        self.specials = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.known: dict[str, int] = {}
        self.store = [np.zeros(0, np.int64)], [0]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words after all merges, and the bounds of each word."""
        n_words = len(bounds) - 1
        size = np.diff(bounds)
        word = np.repeat(np.arange(n_words), size)
        done_s, done_w = [], []
        rank = np.full(len(symbols), NONE)
        pair = np.flatnonzero(word[1:] == word[:-1])
        rank[pair] = self.rank(symbols[pair], symbols[pair + 1])
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.concatenate([first, [len(symbols)]]))
            over = np.repeat(least == NONE, size)
            if over.any():
                done_s.append(symbols[over])
                done_w.append(word[over])
                stay = ~over
                symbols, word, rank = symbols[stay], word[stay], rank[stay]
                size, least = size[least != NONE], least[least != NONE]
                if not len(symbols):
                    break
            hit = rank == np.repeat(least, size)
            # overlapping hits stand in runs: every second one of a run counts
            run = hit & np.concatenate([[False], hit[:-1]])
            if run.any():
                i = np.flatnonzero(hit)
                begin = np.concatenate([[True], np.diff(i) > 1])
                nth = np.arange(len(i)) - np.repeat(np.flatnonzero(begin), np.diff(np.concatenate([np.flatnonzero(begin), [len(i)]])))
                hit[i[nth % 2 == 1]] = False
            at = np.flatnonzero(hit)
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new = np.cumsum(keep) - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            at = new[at]
            touched = np.zeros(len(symbols), bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            near = np.flatnonzero(touched)
            rank[near] = NONE
            near = near[near < len(symbols) - 1]
            near = near[word[near] == word[near + 1]]
            rank[near] = self.rank(symbols[near], symbols[near + 1])
        if not done_s:
            return np.zeros(0, np.int64), np.zeros(n_words + 1, np.int64)
        symbols, word = np.concatenate(done_s), np.concatenate(done_w)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n_words))])

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """One word by a heap of (rank, place) over linked symbols."""
        s, n = symbols.tolist(), len(symbols)
        after, before, live = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        ranks = self.rank(symbols[:-1], symbols[1:])
        heap = [(int(r), i, s[i], s[i + 1]) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if live[i] else -1
            if j < 0 or s[i] != a or s[j] != b:
                continue
            s[i], live[j] = int(self.made[r]), False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (q := int(self.rank(np.array([s[x]]), np.array([s[y]]))[0])) != NONE:
                    heapq.heappush(heap, (q, x, s[x], s[y]))
        return np.array([x for x, ok in zip(s, live, strict=True) if ok], np.int64)

    def encode_words(self, words: list[bytes]) -> Flat:
        flat = Flat.of(words)
        symbols = self.of_byte[flat.values]
        size = np.diff(flat.bounds)
        if (long := np.flatnonzero(size > LONG)).size:
            own = {int(k): self.merge_long(symbols[flat.bounds[k] : flat.bounds[k + 1]]) for k in long}
            short = np.flatnonzero(size <= LONG)
            part = Flat(symbols, flat.bounds).take(short)
            s, b = self.merge(part.values, part.bounds)
            lists = dict(zip(short.tolist(), np.split(s, b[1:-1]), strict=True)) if len(short) else {}
            lists |= own
            return Flat(np.concatenate([lists[k] for k in range(len(words))]), np.concatenate([[0], np.cumsum([len(lists[k]) for k in range(len(words))])]))
        return Flat(*self.merge(symbols, flat.bounds))

    def _learn(self, new: list[str]) -> None:
        """Encode pieces not seen lately; a piece is one or more words of the pattern."""
        words, owner = [], []
        for k, piece in enumerate(new):
            found = self.parts.findall(piece)
            words += found
            owner += [k] * len(found)
        distinct: dict[str, int] = {}
        of = np.array([distinct.setdefault(w, len(distinct)) for w in words], np.int64)
        ids = self.encode_words([w.encode() for w in distinct]).take(of)
        n = np.bincount(np.asarray(owner, np.int64), weights=np.diff(ids.bounds), minlength=len(new)).astype(np.int64)
        base = len(self.known)
        self.known.update(zip(new, range(base, base + len(new)), strict=True))
        values, sizes = self.store
        values.append(ids.values)
        sizes.extend(n.tolist())

    def encode(self, texts: list[str]) -> Flat:
        pieces: list[str] = []
        count = []
        for text in texts:
            if self.specials and self.specials.search(text):
                at, found = 0, []
                for m in self.specials.finditer(text):
                    found += [*self.pieces.findall(text[at : m.start()]), SPECIAL + m[0]]
                    at = m.end()
                found += self.pieces.findall(text[at:])
            else:
                found = self.pieces.findall(text)
            pieces += found
            count.append(len(found))
        if len(self.known) > CACHE_WORDS:
            self.known, self.store = {}, ([np.zeros(0, np.int64)], [0])
        known = self.known
        new = list(dict.fromkeys(p for p in pieces if p not in known))
        special = [p for p in new if p.startswith(SPECIAL) and p[len(SPECIAL) :] in self.special]
        if special:
            for p in special:
                known[p] = len(known)
                self.store[0].append(np.array([self.special[p[len(SPECIAL) :]]], np.int64))
                self.store[1].append(1)
            new = [p for p in new if p not in known]
        if new:
            self._learn(new)
        values, sizes = self.store
        if len(values) > 1:
            values[:] = [np.concatenate(values)]
        table = Flat(values[0], np.cumsum(sizes))
        index = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        got = table.take(index)
        return Flat(got.values, got.bounds[np.concatenate([[0], np.cumsum(count, dtype=np.int64)])])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all lists of ids, and the bounds of each list's."""
        got = self.bytes.take(ids)
        return got.values, got.bounds[bounds]


NONE = np.iinfo(np.int64).max
#: Stands before a special token among pieces; no piece of text has a space before a letter of this plane and no more.
SPECIAL = "\U0010ffff "


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]): texts encoded with the vocabulary at ``path`` and decoded again.

    ``path`` is read by each Python worker and must exist on every executor.
    """

    def run(batches):
        c = codec(path)
        for batch in batches:
            _, offs = T.utf8(batch["text"])
            for a, b in T.chunks(offs, CHUNK_BYTES):
                got = c.encode([x or "" for x in batch["text"].slice(a, b - a).to_pylist()])
                digits = c.decimals.take(got.values)
                ends = digits.bounds[got.bounds]
                raw = memoryview(digits.values)
                text, at = c.decode(got.values, got.bounds)
                text = memoryview(text)
                n = np.diff(got.bounds)
                cols = [
                    batch["doc_id"].slice(a, b - a),
                    pa.array(n, pa.int64()),
                    pa.array([hashlib.sha256(raw[ends[k] : max(ends[k], ends[k + 1] - 1)]).hexdigest() for k in range(b - a)]),
                    pa.array([hashlib.sha256(repaired(text[at[k] : at[k + 1]])).hexdigest() for k in range(b - a)]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(got.bounds.astype(np.int32)), pa.array(got.values.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)


def repaired(raw) -> bytes:
    """Bytes that aren't UTF-8 become U+FFFD."""
    return bytes(raw).decode("utf-8", "replace").encode()
