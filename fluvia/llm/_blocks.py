"""Blocks of a corpus, and exchanges of packed arrays between blocks and shards.

An operator that needs a statistic of the whole corpus about each of a
document's windows would shuffle a row a window. Here documents are dealt once
into blocks (compressed, a few megabytes each). A block sends packed, sorted,
delta-coded arrays of its distinct hashes; what all blocks sent is added up, and
each gets answers in the order of what it sent.

``Exchange`` carries the arrays through a butterfly. At each of ``levels``
levels a node merges what up to ``fan`` nodes sent it, a frequent key to one
entry, and cuts the result by hash range into at most ``fan`` messages to the
next level; after the last level a node holds a range of the hash space from all
blocks. Answers go the same way back. A block so sends ``fan`` messages a level,
whatever the number of blocks, and a node holds about as much as a block. With
up to ``FAN`` blocks there is one level. Everything is an ordinary shuffle, so a
lost executor costs a recomputation only.
"""

from __future__ import annotations

import ctypes
import math
import pickle
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text in a block, about.
BLOCK_BYTES = 7 << 20
PACK_BYTES = 24 << 20
#: Messages that a node sends at most, and receives.
FAN = 256
#: Shuffle partitions at most; beyond, a partition takes its nodes one after the other.
MOST_PARTS = 50_000
NO_ID = np.iinfo(np.int64).max


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, counted."""
    return int(docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0)


def n_blocks(df: DataFrame, size: int) -> int:
    """Blocks for texts of that many bytes."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BLOCK_BYTES))


def sketch_bits(size: int, spread: int) -> int:
    """Bits that number about ``spread`` cells for every three bytes of text."""
    return min(44, max(16, math.ceil(math.log2(spread * max(1, size) / 3))))


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes. Sorted unsigned arrays become differences; equal byte places stand together; booleans are bits."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        kind = a.dtype.str
        delta = kind == "<u8" and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        if a.dtype == bool:
            raw = np.packbits(a).tobytes()
        else:
            if delta:
                a = np.diff(a, prepend=np.uint64(0))
            raw = a.view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) and a.dtype.itemsize > 1 else a.tobytes()
        parts.append((kind, delta, len(a), raw))
    raw = pickle.dumps(parts, 5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    out = []
    for kind, delta, n, b in pickle.loads(raw):
        dt = np.dtype(kind)
        a = np.frombuffer(b, np.uint8)
        if dt == bool:
            a = np.unpackbits(a, count=n).astype(bool)
        else:
            a = np.ascontiguousarray(a.reshape(dt.itemsize, n).T).view(dt).reshape(-1) if n and dt.itemsize > 1 else a.view(dt)
        out.append(np.cumsum(a, dtype=np.uint64) if delta else a)
    return out


def small(a: np.ndarray) -> np.ndarray:
    """Counts in the narrowest unsigned type that holds them."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def freeze(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def thaw(payloads: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for c in payloads.chunks for x in c])


def split_blocks(table: pa.Table, blk: np.ndarray):
    """Pairs of a block's number and its rows, frozen."""
    order = np.argsort(blk, kind="stable")
    table = table.take(pa.array(order))
    numbers, at = np.unique(blk[order], return_index=True)
    for k, a, b in zip(numbers, at, [*at[1:], len(blk)], strict=True):
        yield int(k), freeze(table.slice(a, b - a))


def gathered(batches, size=lambda b: b.nbytes, limit: int = PACK_BYTES):
    """Record batches put together to tables of about limit bytes."""
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += size(b)
        if n >= limit:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def pieces(batches, limit: int):
    """Record batches cut to about limit bytes: Spark's have a number of rows, whatever their bytes."""
    for b in batches:
        step = max(1, b.num_rows * limit // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def release() -> None:
    """Free memory of this process goes back to the system: a Python worker lives as long as its executor, and would keep the most that any task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def lean(step: Callable, *args):
    """What the step gives; what it took on its way is released."""
    out = step(*args)
    release()
    return out


def ids_of(column) -> np.ndarray:
    """doc_id as integers; null sorts after every other."""
    return np.asarray(column.cast(pa.int64()).fill_null(NO_ID).combine_chunks() if isinstance(column, pa.ChunkedArray) else column.cast(pa.int64()).fill_null(NO_ID))


def ids_back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def blocks(docs: DataFrame, n: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(blk, payload): whole documents (doc_id, text and columns to carry) dealt by id and text into n blocks, so that neither one id nor a group of copies fills a block."""

    def pack(batches):
        for t in gathered(batches):
            ids, blk = ids_of(t["doc_id"]), np.asarray(t["blk"])
            t = pa.table({"doc_id": pa.array(ids), "text": t["text"].cast(pa.large_string())} | {f"carry_{k}": t[f"carry_{k}"] for k in range(len(carry))})
            out = list(split_blocks(t, blk))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["blk", "payload"])

    extra = [F.col(f"`{c}`").alias(f"carry_{k}") for k, c in enumerate(carry)]
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(*own, F.pmod(F.xxhash64(*own), F.lit(n)).alias("blk"), *extra).mapInArrow(pack, DEALT).repartition(min(n, MOST_PARTS), "blk")


DEALT = "blk long, payload binary"
#: To a node of the next level, from the sender's place among its siblings.
MESSAGE = "node long, src int, payload binary"
#: To a node of the level before (a block at last), about one of the ranges that it sent.
ANSWER = "blk long, sub int, payload binary"


def table_of(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    fields = [x.split() for x in ddl.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


class Group:
    """Arrays that belong together: ``keys`` sorted hash arrays (the first rules the order), then ``values`` of each key."""

    def __init__(self, keys: int = 1, values: int = 1, answers: int = 1):
        self.keys, self.values, self.answers = keys, values, answers


class Exchange:
    """What n blocks send, merged over all of them, and the answers.

    ``combine(g, values, at, m)`` merges the values of group g; ``at`` tells for
    each entry which of the m merged ones it goes to. ``answer(g, keys, values)``
    gives the answer arrays of a merged range. ``back(g, at, values, merged,
    answers)`` turns answers about merged entries to those about what was sent;
    by default each takes its merged entry's. ``totals(groups)`` is an array of
    sums over a range; blocks get the sum over all ranges.
    """

    def __init__(self, n: int, groups: list[Group], combine: Callable, answer: Callable, back: Callable | None = None, totals: Callable | None = None, fan: int = FAN):
        self.n, self.groups, self.combine, self.answer, self.totals = n, groups, combine, answer, totals
        self.back = back or (lambda g, at, values, merged, answers: [a[at] for a in answers])
        self.levels = 1
        while fan**self.levels < n:
            self.levels += 1
        self.fan = 1
        while self.fan**self.levels < n:
            self.fan += 1

    def _flat(self, arrays: list[np.ndarray], widths: list[int]) -> list[list[np.ndarray]]:
        at = np.cumsum([0, *widths])
        return [arrays[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def _cut(self, groups: list[list[np.ndarray]], level: int, prefix: int):
        """Messages (range, payload) of a node of that level; empty ones only where totals of all ranges are wanted."""
        size = self.fan ** (level + 1)
        edges = np.array([((prefix * self.fan + r) << 64) // size for r in range(1, self.fan)], np.uint64)
        bounds = [np.concatenate([[0], np.searchsorted(g[0], edges), [len(g[0])]]) for g in groups]
        for r in range(self.fan):
            if self.totals or any(b[r + 1] > b[r] for b in bounds):
                yield r, squeeze(*(a[b[r] : b[r + 1]] for g, b in zip(groups, bounds, strict=True) for a in g))

    def ask(self, blk: int, groups: list[list[np.ndarray]]) -> pa.Table:
        """Messages of a block: of each group its key arrays and value arrays."""
        return self._messages(0, blk, groups)

    def _messages(self, level: int, node: int, groups: list[list[np.ndarray]]) -> pa.Table:
        group, prefix = divmod(node, self.fan**level)
        to, size = group // self.fan, self.fan ** (level + 1)
        return table_of([(to * size + prefix * self.fan + r, group % self.fan, x) for r, x in self._cut(groups, level, prefix)], MESSAGE)

    def _merged(self, table: pa.Table):
        table = table.take(pa.array(np.argsort(np.asarray(table["src"]), kind="stable")))
        parts = [self._flat(unsqueeze(x.as_py()), [g.keys + g.values for g in self.groups]) for x in table["payload"]]
        merged, places, sent = [], [], []
        for g, spec in enumerate(self.groups):
            every = [np.concatenate([p[g][k] for p in parts]) for k in range(spec.keys + spec.values)]
            keys, values = every[: spec.keys], every[spec.keys :]
            if spec.keys == 1:
                distinct, at = np.unique(keys[0], return_inverse=True)
                distinct = [distinct]
            else:
                order = np.lexsort(keys[::-1])
                new = np.ones(len(order), bool)
                new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
                distinct = [k[order[new]] for k in keys]
                at = np.empty(len(order), np.int64)
                at[order] = np.cumsum(new) - 1
            merged.append([*distinct, *self.combine(g, values, at, len(distinct[0]))])
            places.append((at, [len(p[g][0]) for p in parts]))
            sent.append(values)
        return np.asarray(table["src"]), merged, places, sent

    def _replies(self, level: int, node: int, src, merged, places, sent, answers: list[list[np.ndarray]], totals: list[np.ndarray]) -> pa.Table:
        group, prefix = divmod(node, self.fan**level)
        each: list[list[np.ndarray]] = [[] for _ in src]
        for g, spec in enumerate(self.groups):
            at, sizes = places[g]
            for a in self.back(g, at, sent[g], merged[g][spec.keys :], answers[g]):
                for own, piece in zip(each, np.split(a, np.cumsum(sizes)[:-1]), strict=True):
                    own.append(piece)
        to = lambda s: (group * self.fan + int(s)) * self.fan ** (level - 1) + prefix // self.fan
        return table_of([(to(s), prefix % self.fan, squeeze(*own, *totals)) for s, own in zip(src, each, strict=True)], ANSWER)

    def read(self, table: pa.Table) -> tuple[list[list[np.ndarray]], np.ndarray | None]:
        """Answers of each group in the order of what was asked, and the totals."""
        table = table.take(pa.array(np.argsort(np.asarray(table["sub"]), kind="stable")))
        parts = [unsqueeze(x.as_py()) for x in table["payload"]]
        n = sum(g.answers for g in self.groups)
        arrays = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(n)]
        return self._flat(arrays, [g.answers for g in self.groups]), sum(p[n] for p in parts) if self.totals and parts else None

    def _up(self, level: int):
        def up(key, table):
            _, merged, _, _ = self._merged(table)
            return self._messages(level, key[0].as_py(), merged)

        return up

    def _top(self):
        def top(key, table):
            src, merged, places, sent = self._merged(table)
            answers = [self.answer(g, m[: s.keys], m[s.keys :]) for g, (s, m) in enumerate(zip(self.groups, merged, strict=True))]
            return self._replies(self.levels, key[0].as_py(), src, merged, places, sent, answers, [self.totals(merged)] if self.totals else [])

        return top

    def _down(self, level: int):
        def down(key, left, right):
            if not left.num_rows:
                return table_of([], ANSWER)
            answers, totals = self.read(right)
            return self._replies(level, key[0].as_py(), *self._merged(left), answers, [] if totals is None else [totals])

        return down

    def answers(self, requests: DataFrame) -> DataFrame:
        """(blk, sub, payload) for ``read``, from the rows that ``ask`` gave."""
        parts = min(self.n, MOST_PARTS)
        up = [requests.repartition(parts, "node")]
        for level in range(1, self.levels):
            up.append(up[-1].groupBy("node").applyInArrow(self._up(level), MESSAGE).repartition(parts, "node"))
        down = up[-1].groupBy("node").applyInArrow(self._top(), ANSWER)
        for level in range(self.levels - 1, 0, -1):
            down = up[level - 1].groupBy("node").cogroup(down.withColumnRenamed("blk", "node").groupBy("node")).applyInArrow(self._down(level), ANSWER)
        return down


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local session gets one of its own."""
    app = spark.sparkContext.applicationId
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = _own[app] = _own.get(app) or "file://" + tempfile.mkdtemp(prefix="fluvia-")
    root = f"{at.rstrip('/')}/fluvia-{app}"
    if root not in _roots:
        _roots.add(root)
        path, fs = _path(spark, root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)  # by the JVM as it ends, also after spark.stop()
        if app in _own:
            fs.deleteOnExit(path.getParent())
    return root


_roots: set[str] = set()
_own: dict[str, str] = {}
_tables: list[str] = []


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def written(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read again: its lineage ends there, and any executor can be lost after."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    _tables.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``build`` gives, written; tables that were written on the way to it are removed."""
    before = len(_tables)
    out = written(build())
    for path in _tables[before:-1]:
        remove(spark, path)
    del _tables[before:-1]
    return out


def latest() -> str:
    """The folder of the table written last."""
    return _tables[-1]
