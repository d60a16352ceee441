"""Quality rules as a short-circuit cascade.

Each task measures, on one of every ``EVERY`` chunks of documents that it reads,
what each measure costs a document and which share each rule rejects. On the
chunks between, rules run in the order of rejections per cost, each on the
documents that all before it left, and a measure is taken only of the documents
whose rules ask for it, never twice. The verdict is the same in any order, so
what the sample holds only moves the time. Rules are fixed thresholds on one
document.

Null text is empty: it has no words and fails ``few_words``. Rows are
independent: repeated rows, null ids and further columns change nothing. An
empty table gives no rows.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvia.llm import _text as T

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CONTINUATION = (np.arange(256) & 0xC0) == 0x80

#: One of so many chunks is measured with all rules.
EVERY = 64


class Texts:
    """A range of documents and measures of them, each taken once of a document, when first asked for."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs, self.n = buf, offs, len(offs) - 1
        self.words = T.Words(buf, offs)
        self._values: dict[str, np.ndarray] = {"n_words": self.words.counts}
        self._known: dict[str, np.ndarray] = {"n_words": np.ones(self.n, bool)}
        #: Documents that each measure was taken of, and the seconds spent.
        self.taken: Counter[str] = Counter()
        self.spent: Counter[str] = Counter()

    def get(self, name: str, rows: np.ndarray | None = None) -> np.ndarray:
        """A measure of some documents (all by default)."""
        rows = np.arange(self.n) if rows is None else rows
        if name not in self._values:
            self._values[name], self._known[name] = np.zeros(self.n, np.int64), np.zeros(self.n, bool)
        new = rows[~self._known[name][rows]]
        if len(new):
            began = time.perf_counter()
            together = ("n_lines", "n_dup_lines") if name in ("n_lines", "n_dup_lines") else (name,)
            for x, values in zip(together, self._measure(name, new), strict=True):
                self._values.setdefault(x, np.zeros(self.n, np.int64))[new] = values
                self._known.setdefault(x, np.zeros(self.n, bool))[new] = True
            self.taken[together[0]] += len(new)
            self.spent[together[0]] += time.perf_counter() - began
        return self._values[name][rows]

    def __getattr__(self, name: str) -> np.ndarray:
        if name in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"):
            return self.get(name)
        raise AttributeError(name)

    def bytes_in(self, table: np.ndarray) -> np.ndarray:
        return T.sums_by(table[self.buf], self.offs)

    def _bytes_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(rows) == self.n:
            return self.buf, self.offs
        keep = np.zeros(self.n, bool)
        keep[rows] = True
        size = np.diff(self.offs)
        return self.buf[np.repeat(keep, size)], np.concatenate([[0], np.cumsum(size[keep])])

    def _measure(self, name: str, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Values of a measure for some documents, in order."""
        if name == "n_repeat_words":
            yield self._repeats(rows)
            return
        buf, offs = self._bytes_of(rows)
        if name in ("n_lines", "n_dup_lines"):
            yield from _line_counts(buf, offs)
        else:
            yield T.sums_by((SYMBOLS if name == "n_symbols" else ~T.IS_SPACE & ~CONTINUATION)[buf], offs)

    def _repeats(self, rows: np.ndarray) -> np.ndarray:
        w = self.words
        keep = np.zeros(self.n, bool)
        keep[rows] = True
        mine = np.repeat(keep, w.counts)
        counts = w.counts[rows]
        h, at = T.ngrams(T.span_hashes(self.buf, w.starts[mine], w.ends[mine]), counts, 3)
        doc = np.repeat(np.arange(len(rows)), counts)
        key = T.mix(h ^ T.mix(doc[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        k = key[order]
        twin = np.zeros(len(k), bool)
        twin[1:] = k[1:] == k[:-1]
        twin[:-1] |= twin[1:]
        return T.sums_by(T.covered(at[order[twin]], 3, len(doc)), np.concatenate([[0], np.cumsum(counts)]))


def _line_counts(buf: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """Lines with a word, and those of them equal to an earlier one."""
    n = len(offs) - 1
    cut = np.flatnonzero(buf == 10)
    doc = np.searchsorted(offs, cut, "right") - 1
    starts = np.sort(np.concatenate([offs[:-1], cut + 1]))
    owner = np.sort(np.concatenate([np.arange(n), doc]))
    ends = np.minimum(np.concatenate([starts[1:], [len(buf)]]), offs[owner + 1])
    at_break = (ends > starts) & (buf[np.maximum(ends - 1, 0)] == 10) if len(buf) else np.zeros(len(starts), bool)
    ends = ends - at_break
    inside = np.concatenate([[0], np.cumsum(~T.IS_SPACE[buf])])
    has = inside[ends] > inside[starts]
    h, doc = T.span_hashes(buf, starts[has], ends[has]), owner[has]
    yield np.bincount(doc, minlength=n)
    order = np.lexsort((h, doc))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    yield np.bincount(doc[order][same], minlength=n)


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    #: From the needed measures of some documents: which are rejected.
    rejects: Callable[..., np.ndarray]


def default_rules(min_words: int = 50, max_symbols: float = 0.1, word_length: tuple[float, float] = (2, 15), max_dup_lines: float = 0.3, max_repeats: float = 0.5) -> list[Rule]:
    """Shares are of words (symbols, repeats) or of lines with a word (dup_lines)."""
    low, high = word_length
    return [
        Rule("few_words", ("n_words",), lambda words: words < min_words),
        Rule("symbols", ("n_symbols", "n_words"), lambda symbols, words: symbols > max_symbols * words),
        Rule("word_length", ("word_chars", "n_words"), lambda chars, words: (chars < low * words) | (chars > high * words)),
        Rule("dup_lines", ("n_dup_lines", "n_lines"), lambda dup, lines: dup > max_dup_lines * lines),
        Rule("repeats", ("n_repeat_words", "n_words"), lambda repeats, words: repeats > max_repeats * words),
    ]


class Cascade:
    """Rules in the order of rejections per cost, as measured so far by this task."""

    def __init__(self, rules: list[Rule], every: int = EVERY):
        self.rules, self.order, self.every, self.chunks = rules, list(rules), every, 0
        self.seen, self.cost, self.lost = 0, Counter(), Counter()

    def _measured(self, t: Texts) -> np.ndarray:
        good = np.ones(t.n, bool)
        for rule in self.rules:
            began = sum(t.spent.values())
            bad = rule.rejects(*(t.get(x) for x in rule.needs))
            # what measures cost beyond those that are there already; words are always there
            self.cost[rule.name] += sum(t.spent.values()) - began
            self.lost[rule.name] += int(bad.sum())
            good &= ~bad
        self.seen += t.n
        self.order = in_order(self.rules, [(r.name, self.cost[r.name] / max(self.seen, 1), self.lost[r.name] / max(self.seen, 1)) for r in self.rules])
        return good

    def verdicts(self, t: Texts) -> np.ndarray:
        """True for documents that no rule rejects."""
        self.chunks += 1
        return self._measured(t) if self.chunks % self.every == 1 % self.every else verdicts(t, self.order)


def in_order(rules: list[Rule], figures: list[tuple[str, float, float]]) -> list[Rule]:
    """Rules by rejections per cost, best first; as given where nothing was measured."""
    rate = {name: share / max(cost, 1e-12) for name, cost, share in figures}
    return sorted(rules, key=lambda r: -rate.get(r.name, 0))


def verdicts(t: Texts, rules: list[Rule]) -> np.ndarray:
    """True for documents that no rule rejects. A rule sees only what the rules before it left."""
    live = np.arange(t.n)
    for rule in rules:
        if len(live):
            live = live[~rule.rejects(*(t.get(x, live) for x in rule.needs))]
    kept = np.zeros(t.n, bool)
    kept[live] = True
    return kept


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, min_words: int = 50, max_repeats: float = 0.5) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept): the verdict and all measures, so that those which the cascade spared are taken after it. ``accepted`` spares them."""
    rules = default_rules(min_words=min_words, max_repeats=max_repeats) if rules is None else rules

    def run(batches):
        cascade = Cascade(rules)
        for batch in batches:
            buf, offs = T.utf8(batch["text"])
            for a, b in T.chunks(offs):
                t = Texts(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                kept = cascade.verdicts(t)
                base = (t.n_words < min_words) | (t.n_repeat_words > max_repeats * t.n_words)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), *(pa.array(t.get(x), pa.int64()) for x in MEASURES), pa.array(base), pa.array(kept & ~base)], ["doc_id", *MEASURES, "base_failed", "kept"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, " + "".join(f"{x} long, " for x in MEASURES) + "base_failed boolean, kept boolean")


def accepted(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Whole rows of docs that no rule rejects."""
    rules = default_rules() if rules is None else rules
    at = docs.columns.index("text")

    def run(batches):
        cascade = Cascade(rules)
        for batch in batches:
            buf, offs = T.utf8(batch.column(at))
            keep = [cascade.verdicts(Texts(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])) for a, b in T.chunks(offs)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)


#: The verdict of the default rules in SQL.
SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k FROM p),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
s AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN d USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_dup_lines > 3 * n_lines) AS kept
FROM s
"""
