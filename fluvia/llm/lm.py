"""N-gram scores by deleted interpolation.

Maximum-likelihood estimates of all orders up to ``order`` and a uniform floor
are mixed with weights that depend on the longest context that was seen and how
often it was. The weights are learned by expectation-maximisation: one fold of
the training documents (crc32 of doc_id mod 10 = 1) is held back from the counts
and its tokens tell which estimate foresaw them. The final counts are those of
all training documents (remainder not 0).

Counts go through the exchange of ``_blocks``: a block sends its distinct
n-grams and gets corpus totals back, so no table of counts is sent whole to
anyone. What EM needs of the held-back tokens is a table of bounded size: cells of
half an octave of each estimate, with the number of tokens and the sums of their
actual estimates, so that a cell stands for its means.

Words are told apart by 64-bit hashes, longer n-grams by ``KEY_BITS`` more bits
than number the corpus's bytes: an n-gram in some hundred thousand shares its
count with another.

Null text is empty: its one token is the end. A null doc_id is in no fold and
counts as training. Repeated rows count each time. Other columns aren't read.
An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvia.llm import _blocks as B
from fluvia.llm import _text as T

END = np.uint64(0x5851F42D4C957F2D)
ORDER = 3
#: Context frequencies: powers of 2.
BUCKETS = 24
#: Cells of log2(p / floor): 0 for a probability of 0, then half octaves.
STEP, BINS, ZERO = 0.5, 128, 24
ROUNDS = 60
KEY_BITS = 16
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def fold_of(ids: np.ndarray) -> np.ndarray:
    """crc32 of the decimal text, mod 10; -1 for null."""
    from zlib import crc32

    return np.fromiter((crc32(b"%d" % i) % 10 if i != B.NO_ID else -1 for i in ids.tolist()), np.int64, len(ids))


class Tokens:
    """Tokens of a block: of each order the distinct n-grams (sorted hashes), and each token's place among them."""

    def __init__(self, table: pa.Table, order: int, bits: int):
        buf, offs = T.utf8(table["text"])
        self.ids = B.ids_of(table["doc_id"])
        self.fold = fold_of(self.ids)
        seen, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for a, b in T.chunks(offs):
            w = T.Words(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            t = np.full(len(w.starts) + b - a, END)
            t[np.arange(len(w.starts)) + w.doc] = w.hashes(lower=True)
            seen.append(t)
            counts.append(w.counts + 1)
        token, self.counts = np.concatenate(seen), np.concatenate(counts)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.doc_fold = np.repeat(self.fold, self.counts)
        self.position = np.arange(len(token)) - np.repeat(self.first[:-1], self.counts)
        keys, places = np.unique(token, return_inverse=True)
        self.keys, self.places = [keys], [places]
        gram, before = token, token
        for _ in range(1, order):  # before a document stand ends
            before = np.concatenate([[END], before[:-1]])
            before[self.first[:-1]] = END
            gram = T.mix(gram * np.uint64(0x9E3779B97F4A7C15) + before)
            keys, places = np.unique(gram >> np.uint64(64 - bits) << np.uint64(64 - bits), return_inverse=True)
            self.keys.append(keys)
            self.places.append(places)

    def groups(self) -> list[list[np.ndarray]]:
        fit, held = (self.doc_fold != 0) & (self.doc_fold != 1), self.doc_fold == 1
        return [[k, *(B.small(np.bincount(p[m], minlength=len(k))) for m in (fit, held))] for k, p in zip(self.keys, self.places, strict=True)]

    def context(self, counts: list[np.ndarray], at: np.ndarray, order: int) -> np.ndarray:
        """How often the context of the n-gram that ends at each token was seen. A document's first token stands after ends only, as often as there are documents."""
        ends = counts[0][np.searchsorted(self.keys[0], END)] if len(at) else 0.0
        before = counts[order - 2][self.places[order - 2][at - 1]]
        return np.where(self.position[at] == 0, ends, before)

    def estimates(self, counts: list[np.ndarray], total: float, at: np.ndarray):
        """Of each order, lowest first, the estimate of each token; whether its context was seen; and the weights' row."""
        p, seen, row = [_ratio(counts[0][self.places[0][at]], total)], [np.full(len(at), total > 0)], np.zeros(len(at), np.int64)
        for n in range(2, len(self.keys) + 1):
            context = self.context(counts, at, n)
            p.append(_ratio(counts[n - 1][self.places[n - 1][at]], context))
            seen.append(context > 0)
            row = np.where(context > 0, (n - 2) * BUCKETS + bucket_of(context), row)
        return np.minimum(np.stack(p, axis=1), 1.0), np.stack(seen, axis=1), row


def exchange_of(n: int, order: int) -> B.Exchange:
    """Corpus totals of n-grams in both folds; the sums are distinct words, tokens of each fold, and distinct words of the first."""
    add = lambda g, values, at, m: [B.small(np.bincount(at, weights=v, minlength=m).astype(np.int64)) for v in values]

    def totals(groups):
        fit, held = (v.astype(np.int64) for v in groups[0][1:])
        return np.array([(fit + held > 0).sum(), fit.sum(), held.sum(), (fit > 0).sum()], np.int64)

    return B.Exchange(n, [B.Group(values=2, answers=2) for _ in range(order)], add, lambda g, keys, values: values, totals=totals)


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(np.maximum(context, 1))).astype(np.int64), BUCKETS - 1)


def _ratio(a, b):
    return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=np.asarray(b) > 0)


def _bin(ratio: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        x = np.log2(ratio)
    return np.where(ratio > 0, np.clip(np.round(x / STEP) + ZERO, 1, BINS - 1), 0).astype(np.int64)


def learn_weights(row: np.ndarray, p: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """Mixture weights of each row by EM, for estimates p (the last column is the floor's 1); a row starts from, and leans a little on, what all show."""
    width = p.shape[1]

    def em(at, start, prior):
        lam = start
        for _ in range(ROUNDS):
            r = p[at] * lam
            r /= r.sum(axis=1, keepdims=True)
            lam = (r * weight[at, None]).sum(axis=0) + prior
            lam /= lam.sum()
        return lam

    every = np.full(width, 1 / width)
    if len(weight):
        every = em(np.arange(len(weight)), every, np.full(width, 1e-3))
    lam = np.tile(every, (rows, 1))
    for k in np.unique(row):
        lam[k] = em(np.flatnonzero(row == k), every, 2 * every)
    return lam


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Each document's log10 probability, and that of a smoothed unigram base."""
    size = B.text_bytes(docs)
    n, bits = B.n_blocks(docs, size), min(64, B.sketch_bits(size, 1) + KEY_BITS)
    dealt = B.blocks(docs, n)
    exchange = exchange_of(n, order)
    weight_rows = max(1, order - 1) * BUCKETS

    def ask(key, table):
        return exchange.ask(key[0].as_py(), Tokens(B.thaw(table["payload"]), order, bits).groups())

    totals = exchange.answers(dealt.groupBy("blk").applyInArrow(ask, B.MESSAGE))
    estimates = [f"p{k}" for k in range(order)]

    def held_back(left, right):
        if not left.num_rows:
            return B.table_of([], HISTOGRAM)
        t = Tokens(B.thaw(left["payload"]), order, bits)
        groups, sums = exchange.read(right)
        at = np.flatnonzero(t.doc_fold == 1)
        p, _, row = t.estimates([g[0].astype(np.float64) for g in groups], float(sums[1]), at)
        p *= sums[3] + 1.0
        cell = row
        for k in range(order):
            cell = cell * BINS + _bin(p[:, k])
        cells, where, weight = np.unique(cell, return_inverse=True, return_counts=True)
        sums_of = [np.bincount(where, weights=p[:, k], minlength=len(cells)).astype(np.float64) for k in range(order)]
        return pa.table({"cell": cells, "weight": weight.astype(np.int64)} | dict(zip(estimates, sums_of, strict=True)))

    HISTOGRAM = "cell long, weight long" + "".join(f", {p} double" for p in estimates)
    histogram = dealt.groupBy("blk").cogroup(totals.groupBy("blk")).applyInArrow(held_back, HISTOGRAM).groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("weight", *estimates)))

    def mix(table):
        weight = np.asarray(table["weight"])
        p = np.stack([*(np.asarray(table[c]) / weight for c in estimates), np.ones(len(weight))], axis=1)
        lam = learn_weights(np.asarray(table["cell"]) // BINS**order, p, weight, weight_rows)
        return pa.table({"payload": pa.array([B.squeeze(lam.reshape(-1))], pa.binary())})

    # without training tokens there is no histogram; equal weights stand in
    learned = histogram.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(mix, "payload binary")
    # the one row of weights goes to the blocks, so that the answers' exchange is the same as above and is used again
    told = dealt.join(F.broadcast(learned.withColumnRenamed("payload", "weights")), F.lit(True), "left")

    def score(left, right):
        if not left.num_rows:
            return pa.schema(SCORE_ARROW).empty_table()
        t = Tokens(B.thaw(left["payload"]), order, bits)
        lam = np.full((weight_rows, order + 1), 1 / (order + 1))
        if left["weights"][0].is_valid:
            lam = B.unsqueeze(left["weights"][0].as_py())[0].reshape(lam.shape)
        groups, sums = exchange.read(right)
        total, vocabulary = float(sums[1] + sums[2]), float(sums[0])
        counts = [g[0].astype(np.float64) + g[1] for g in groups]
        p, seen, row = t.estimates(counts, total, np.arange(len(t.position)))
        mixed = lam[row]
        mass = (mixed[:, :order] * p).sum(axis=1) + mixed[:, order] / (vocabulary + 1)
        share = (mixed[:, :order] * seen).sum(axis=1) + mixed[:, order]
        known = counts[0][t.places[0]]
        by_doc = lambda x: np.add.reduceat(x, t.first[:-1]) if len(x) else np.zeros(0)
        base = np.log10((known + 0.1) / (total + 0.1 * (vocabulary + 1)))
        return pa.table(
            [B.ids_back(t.ids), pa.array(t.fold == 0), pa.array(t.counts), pa.array(by_doc((known > 0).astype(np.int64))), pa.array(np.full(len(t.ids), int(total))), pa.array(by_doc(base)), pa.array(by_doc(np.log10(mass / share)))],
            schema=pa.schema(SCORE_ARROW),
        )

    return told.groupBy("blk").cogroup(totals.groupBy("blk")).applyInArrow(score, RESULT)


SCORE_ARROW = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
