"""Removal of passages that an earlier document has, behind a count-min prefilter.

Pass 1: each block of documents writes its window hashes into the cells of a
count-min sketch (``ROWS`` rows), merged over all blocks by ``_blocks``; its width
follows the bytes of the corpus. A cell's merged count (kept as once or more) is
never below a window's true count, so a window with a cell that is used once
occurs once and is done.
Pass 2: only windows whose every cell is shared go to a grouping that finds the
smallest doc_id of each. Windows are the same there if two independent 64-bit
hashes of their words are (128 bits: among 2e13 windows, those of 100 TB, the
chance of one wrong pair is under 1e-12).
Pass 3: each block cuts the words that its repeated windows cover.

Null text has no words. A row whose doc_id is null counts as larger than all
others: it loses what numbered rows have, and takes nothing from them. Rows
with the same doc_id don't take from each other. Other columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fluvia.llm import _blocks as B
from fluvia.llm import _text as T

ROWS = 2
#: Cells of a sketch row for each word of the corpus, about.
SPREAD = 4


def _windows(table: pa.Table, width: int, lanes: int = 1):
    """All windows of a block: (hashes of each lane, row, first word in the row)."""
    buf, offs = T.utf8(table["text"])
    h, row, pos = [[] for _ in range(lanes)], [], []
    for a, b in T.chunks(offs):
        w = T.Words(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
        for lane in range(lanes):
            x, at = T.ngrams(w.hashes(lane=lane), w.counts, width)
            h[lane].append(x)
        d = w.doc[at]
        row.append((d + a).astype(np.int32))
        pos.append((at - w.first[d]).astype(np.int32))
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return [cat(x, np.uint64) for x in h], cat(row, np.int32), cat(pos, np.int32)


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each hash in a row of the sketch, at the top of 64 bits, so that cells are dealt like hashes."""
    h = T.mix(h + np.uint64(row)) if row else h
    return h >> np.uint64(64 - bits) << np.uint64(64 - bits)


def _sketch(h: np.ndarray, bits: int) -> list[list[np.ndarray]]:
    """Of each row the sorted cells in use, and whether the block alone uses a cell twice."""
    out = []
    for r in range(ROWS):
        cells, n = np.unique(_cells(h, r, bits), return_counts=True)
        out.append([cells, n > 1])
    return out


def _flags(cells: np.ndarray, flag: np.ndarray) -> np.ndarray:
    """Of each cell its flag, from those of the sorted distinct cells: by one sort, as a binary search for each cell misses the cache at most steps."""
    order = np.argsort(cells)
    ranked = cells[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    out = np.empty(len(order), bool)
    out[order] = flag[np.cumsum(new) - 1]
    return out


def sketches(n: int) -> B.Exchange:
    """Which cells more than one window of the corpus uses."""
    twice = lambda g, values, at, m: [(np.bincount(at, minlength=m) > 1) | (np.bincount(at, weights=values[0], minlength=m) > 0)]
    return B.Exchange(n, [B.Group() for _ in range(ROWS)], twice, lambda g, keys, values: values)


def owners(n: int) -> B.Exchange:
    """Whether a block holds the smallest doc_id of each of its windows."""

    def least(g, values, at, m):
        low = np.full(m, B.NO_ID)
        np.minimum.at(low, at, values[0])
        return [low]

    return B.Exchange(n, [B.Group(keys=2)], least, lambda g, keys, values: [np.ones(len(keys[0]), bool)], lambda g, at, values, merged, answers: [(values[0] == merged[0][at]) & answers[0][at]])


class Suspects:
    """Windows of a block whose every cell is shared: the distinct ones by their two hashes, and each one's place among them."""

    def __init__(self, table: pa.Table, flags: list[list[np.ndarray]], width: int, bits: int):
        (h1, h2), self.row, self.pos = _windows(table, width, lanes=2)
        shared = np.ones(len(h1), bool)
        for r, (flag,) in enumerate(flags):
            shared &= _flags(_cells(h1, r, bits), flag)
        at = np.flatnonzero(shared)
        h1, h2 = h1[at], h2[at]
        self.row, self.pos = self.row[at], self.pos[at]
        self.ids = B.ids_of(table["doc_id"])[self.row]
        order = np.lexsort((self.ids, h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        first = order[new]
        self.h1, self.h2, self.low = h1[first], h2[first], self.ids[first]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1


def remove_repeats(docs: DataFrame, width: int = 13, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, n_words, n_removed, kept_sha256, columns to carry): documents without words of repeated windows.

    A word goes if a window of ``width`` words around it also starts in a
    document with a smaller doc_id. ``text`` keeps its spacing where nothing
    went; kept_sha256 is of the kept words joined by single spaces.
    """
    size = B.text_bytes(docs)
    n, bits = B.n_blocks(docs, size), B.sketch_bits(size, SPREAD)
    dealt = B.blocks(docs, n, carry)
    kinds = [(f"carry_{k}", docs.schema[c].dataType) for k, c in enumerate(carry)]
    arrow = [(name, to_arrow_type(kind)) for name, kind in kinds]
    shared, smallest = sketches(n), owners(n)

    def pass_1(key, table):
        return shared.ask(key[0].as_py(), _sketch(_windows(B.thaw(table["payload"]), width)[0][0], bits))

    cells = shared.answers(dealt.groupBy("blk").applyInArrow(pass_1, B.MESSAGE))

    def pass_2(key, left, right):
        if not left.num_rows:
            return B.table_of([], B.MESSAGE)
        s = Suspects(B.thaw(left["payload"]), shared.read(right)[0], width, bits)
        return smallest.ask(key[0].as_py(), [[s.h1, s.h2, s.low]])

    least = smallest.answers(dealt.groupBy("blk").cogroup(cells.groupBy("blk")).applyInArrow(pass_2, B.MESSAGE))

    def pass_3(key, left, right):
        if not left.num_rows:
            return _result([], [], [], [], [], {name: pa.array([], kind) for name, kind in arrow})
        table, exact = B.thaw(left["payload"]), np.asarray(right["exact"])
        s = Suspects(table, shared.read(right.filter(pa.array(~exact)))[0], width, bits)
        own = smallest.read(right.filter(pa.array(exact)))[0][0][0].astype(bool)
        gone = ~own[s.place] | (s.ids > s.low[s.place])
        return _cut(table, s.row[gone], s.pos[gone], width)

    both = cells.withColumn("exact", F.lit(False)).unionByName(least.withColumn("exact", F.lit(True)))
    return dealt.groupBy("blk").cogroup(both.groupBy("blk")).applyInArrow(pass_3, ", ".join([RESULT, *(f"{name} {kind.simpleString()}" for name, kind in kinds)])).withColumnsRenamed({f"carry_{k}": c for k, c in enumerate(carry)})


def without_repeats(docs: DataFrame, width: int = 13) -> DataFrame:
    """Rows of docs with what stays of their texts; n_chars, where there is one, follows. Emptied documents stay, empty."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = remove_repeats(docs, width, carry)
    if "n_chars" in carry:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


RESULT = "doc_id long, text string, n_words long, n_removed long, kept_sha256 string"


def _result(ids, texts, n_words, n_removed, digests, carried) -> pa.Table:
    return pa.table({"doc_id": B.ids_back(np.asarray(ids, np.int64)), "text": pa.array(texts, pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())} | carried)


def _cut(table: pa.Table, row: np.ndarray, pos: np.ndarray, width: int) -> pa.Table:
    buf, offs = T.utf8(table["text"])
    order = np.argsort(row, kind="stable")
    row, pos = row[order], pos[order]
    texts, words_n, removed, digests = [], [], [], []
    for a, b in T.chunks(offs):
        base = offs[a]
        part = buf[base : offs[b]]
        w = T.Words(part, offs[a : b + 1] - base)
        lo, hi = np.searchsorted(row, [a, b])
        gone = T.covered(w.first[row[lo:hi] - a] + pos[lo:hi], width, len(w.starts))
        lost = T.sums_by(gone, w.first)
        raw, ends = T.joined_words(w, ~gone)
        # spaces after a word that goes go with it
        start_of_gap = np.zeros(len(part) + 1, np.int8)
        g = np.flatnonzero(gone)
        if len(g):
            stop = np.concatenate([w.starts[1:], [len(part)]])[g]
            stop = np.minimum(stop, (offs[a : b + 1] - base)[w.doc[g] + 1])
            np.add.at(start_of_gap, w.starts[g], 1)
            np.add.at(start_of_gap, stop, -1)
            stay = np.cumsum(start_of_gap[:-1], dtype=np.int8) == 0
            shown = part[stay]
            at = np.concatenate([[0], np.cumsum(stay)])[offs[a : b + 1] - base]
        else:
            shown, at = part, offs[a : b + 1] - base
        text = shown.tobytes()
        for k in range(b - a):
            digests.append(hashlib.sha256(raw[ends[k] : ends[k + 1]]).hexdigest())
            texts.append(text[at[k] : at[k + 1]].decode())
        words_n.append(w.counts)
        removed.append(lost)
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    carried = {c: table[c] for c in table.column_names if c.startswith("carry_")}
    return _result(B.ids_of(table["doc_id"]), texts, cat(words_n), cat(removed), digests, carried)
