"""A quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Statistics of a document's text (``statistics``) are scaled and mapped to
``DIMENSION`` random cosine features, whose inner products approximate a
Gaussian kernel. Partitions sum their normal equations, the driver solves the
one system of that fixed size, and a further fold of the training labels maps
raw scores to rates of label 1 by pooling adjacent violators.

At most about ``max_labels`` labelled rows are used (a documented bound; the
rows of smallest hash). Every document is scored, whole.

Null or empty text has all statistics 0 and is scored like any other. Labels
that are null or have no document aren't used; without labels of both kinds
every score is the share of label 1, or 0.5 without labels. A null doc_id is
scored, never labelled. Repeated rows are scored each. Other columns aren't
read. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvia.llm import _blocks as B
from fluvia.llm import _text as T
from fluvia.llm.rules import CONTINUATION, Texts

DIMENSION = 192
MAX_LABELS = 100_000
RIDGE = 1e-3
PARTS = 8

_table = lambda *spans: np.isin(np.arange(256), [c for a, b in spans for c in range(a, b + 1)])
UPPER, LOWER, DIGIT = _table((65, 90)), _table((97, 122)), _table((48, 57))
POINTS = np.isin(np.arange(256), list(b".,;:!?"))
OTHER = np.isin(np.arange(256), np.arange(33, 127)) & ~UPPER & ~LOWER & ~DIGIT & ~POINTS
N_STATISTICS = 12


def statistics(t: Texts) -> np.ndarray:
    """One row a document: logarithms of lengths, and shares."""
    size = np.maximum(T.sums_by(~CONTINUATION[t.buf], t.offs), 1)
    words, lines = np.maximum(t.n_words, 1), np.maximum(t.n_lines, 1)
    share = lambda table: t.bytes_in(table) / size
    return np.stack([
        np.log1p(t.n_words), np.log1p(t.n_lines), np.log1p(t.word_chars / words), np.log1p(t.n_words / lines), t.n_dup_lines / lines,
        np.sqrt(t.n_symbols / words), np.sqrt(share(UPPER)), np.sqrt(share(DIGIT)), np.sqrt(share(POINTS)), np.sqrt(share(OTHER)), np.sqrt(share(T.IS_SPACE)), np.sqrt(share(CONTINUATION)),
    ], axis=1)


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    rates: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(np.clip((x - self.centre) / self.scale, -6, 6)) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if len(self.knots) == 0:
            return np.full(len(x), self.rates[0])
        return np.clip(np.interp(self.raw(x), self.knots, self.rates), 0, 1)


def fourier(x: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant; the draw is fixed."""
    rng = np.random.default_rng(20)
    omega = rng.normal(size=(x.shape[1], DIMENSION)) / np.sqrt(x.shape[1])
    z = np.cos(x @ omega + rng.uniform(0, 2 * np.pi, DIMENSION)) * np.sqrt(2 / DIMENSION)
    return np.concatenate([z, np.ones((len(x), 1))], axis=1)


def isotonic(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the mean raw score and the rate of each pool, both increasing."""
    values, at = np.unique(raw, return_inverse=True)
    weight = np.bincount(at).astype(float)
    rate = np.bincount(at, weights=label) / weight
    pools: list[list[float]] = []
    for v, w, r in zip(values, weight, rate, strict=True):
        pools.append([v, w, r])
        while len(pools) > 1 and pools[-2][2] >= pools[-1][2]:
            v2, w2, r2 = pools.pop()
            v1, w1, r1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, (r1 * w1 + r2 * w2) / (w1 + w2)])
    return np.array([p[0] for p in pools]), np.array([p[2] for p in pools])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, x): the statistics of every document."""

    def run(batches):
        for batch in batches:
            buf, offs = T.utf8(batch["text"])
            for a, b in T.chunks(offs):
                x = statistics(Texts(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "x"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, x binary").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))


def _rows(batch) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in batch["x"]), np.float64).reshape(-1, N_STATISTICS)


def fit(statistics_of: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    """Learn from labels (doc_id, quality) of rows that aren't held out."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and crc32(cast(doc_id as string)) % 3 != 1")
    count = own.count()
    if count > max_labels:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * max_labels / count))
    rows = B.written(statistics_of.where(~F.col("held_out")).join(own, "doc_id").select("x", "quality", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0).alias("calibrates")))
    flat = np.full(N_STATISTICS, 0.0), np.ones(N_STATISTICS)

    def moments(batches):
        n, s, q, ones = 0, np.zeros(N_STATISTICS), np.zeros(N_STATISTICS), 0
        for b in batches:
            x = _rows(b)
            n, s, q, ones = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0), ones + np.asarray(b["quality"]).sum()
        yield pa.RecordBatch.from_pydict({"v": pa.array([np.concatenate([[n, ones], s, q]).tobytes()], pa.binary())})

    total = sum(np.frombuffer(r.v) for r in rows.coalesce(PARTS).mapInArrow(moments, "v binary").collect()) + np.zeros(2 + 2 * N_STATISTICS)
    n, ones = total[:2]
    if n == 0 or ones in (0, n):
        return Model(*flat, np.zeros(0), np.zeros(0), np.array([ones / n if n else 0.5]))
    centre = total[2 : 2 + N_STATISTICS] / n
    scale = np.sqrt(np.maximum(total[2 + N_STATISTICS :] / n - centre**2, 0))
    scale[scale < 1e-6] = 1.0
    width = DIMENSION + 1

    def equations(batches):
        a, b = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            z = fourier(np.clip((_rows(batch) - centre) / scale, -6, 6))
            a += z.T @ z
            b += z.T @ np.asarray(batch["quality"]).astype(float)
        yield pa.RecordBatch.from_pydict({"v": pa.array([np.concatenate([a.reshape(-1), b]).tobytes()], pa.binary())})

    sums = sum(np.frombuffer(r.v) for r in rows.where("not calibrates").coalesce(PARTS).mapInArrow(equations, "v binary").collect()) + np.zeros(width * width + width)
    a, b = sums[: width * width].reshape(width, width), sums[width * width :]
    weights = np.linalg.solve(a + RIDGE * max(1.0, a[-1, -1]) * np.eye(width) / DIMENSION, b)
    model = Model(centre, scale, weights, np.zeros(0), np.array([ones / n]))

    def raw(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"raw": model.raw(_rows(batch)), "label": np.asarray(batch["quality"]).astype(float)})

    pairs = rows.where("calibrates").coalesce(PARTS).mapInArrow(raw, "raw double, label double").collect()
    if pairs:
        model.knots, model.rates = isotonic(np.array([p.raw for p in pairs]), np.array([p.label for p in pairs]))
    return model


def scored(statistics_of: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""

    def run(batches):
        for batch in batches:
            s = model.score(_rows(batch))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return statistics_of.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    x = B.written(measured(docs))
    return scored(x, fit(x, labels, max_labels))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labels: int = MAX_LABELS) -> DataFrame:
    """Whole rows of docs whose score is at least the threshold; the text is measured again rather than joined."""
    model = fit(measured(docs), labels, max_labels)
    names = docs.columns

    def run(batches):
        for batch in batches:
            buf, offs = T.utf8(batch.column(names.index("text")))
            keep = np.zeros(batch.num_rows, bool)
            for a, b in T.chunks(offs):
                keep[a:b] = model.score(statistics(Texts(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]))) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
