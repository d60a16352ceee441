"""Links between documents whose shingle sets are alike, by a prefix-tree join.

1. Documents with the same lower-cased word sequence (a 128-bit BLAKE2b of it)
   are one group. A scan task sends one text of each of its groups, with the
   number of copies and their smallest doc_id; ids themselves stay where they are.
2. Shingles get a global order, rarest first: a sketch of cells, merged over all
   blocks by ``_blocks``, counts for each cell the groups that use it.
   (cell count, hash) is a total order that all blocks compute alike. A shingle
   of a cell used once stands in no other group.
3. If two sets reach the threshold they share a shingle among the first
   ``n - ceil(t n) + 1`` of either. Groups that share such a shingle, directly
   or through others, form a cluster; no link leaves a cluster.
4. In a cluster the sets, most common shingles first, are stored in a prefix
   tree with joined edges. A set probes the tree: one walk shares the overlap
   with all sets that begin alike, and a subtree is left as soon as the
   remaining lengths can't reach the overlap that the smallest set below needs.
   Every link is verified once and counted for both its ends, each with the
   copies of the other; a spanning part of the links goes on to the components.
   Without the counts (``count_links=False``) a subtree is also left if all
   below it is already connected to the probe: components are the same then.
   A cluster of over ``CLUSTER_SHINGLES`` is cut into bands of set sizes, so
   that a link joins sets of one band or of two that follow each other, and a
   band into parts; each pair of parts that can have links is a task of its own.

Shingles are told apart by 64-bit hashes; a link is wrong only where two
different shingles of the same two documents collide.

Null text is empty; without words a document has the empty set and links with
nothing. With fewer words than a shingle has, the whole sequence is the one
shingle. Rows of one doc_id are rows of their own. A null doc_id sorts after all
others and is null in the result. Other columns aren't read. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluvia.llm import _blocks as B
from fluvia.llm import _text as T
from fluvia.llm._components import components, find

CLUSTER_SHINGLES = 1 << 16
SPREAD = 8
MOST_COUNT = 255
NODE_BITS = 32  # a group of equal texts is a node: its block, and its place in the block


def shingle_sets(buf: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted inside it, and their bounds."""
    w = T.Words(buf, offs)
    n = len(w.counts)
    h = w.hashes(lower=True)
    grams, at = T.ngrams(h, w.counts, words)
    doc = w.doc[at]
    for k in range(1, words):  # short documents: the whole sequence
        few = np.flatnonzero(w.counts == k)
        if len(few):
            v = np.zeros(len(few), np.uint64)
            for j in range(k):
                v = T.mix(v * np.uint64(0xD6E8FEB86659FD93) + h[w.first[few] + j])
            grams, doc = np.concatenate([grams, T.mix(v + np.uint64(k))]), np.concatenate([doc, few])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=n))])


def sequence_keys(texts: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """128 bits of each text's lower-cased words, as two columns."""
    buf, offs = T.utf8(texts)
    out = []
    for a, b in T.chunks(offs):
        w = T.Words(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
        raw, at = T.joined_words(w, np.ones(len(w.starts), bool), lower=True)
        raw = memoryview(raw)
        out += [blake2b(raw[i:j], digest_size=16).digest() for i, j in zip(at[:-1], at[1:], strict=True)]
    return np.frombuffer(b"".join(out), np.uint64).reshape(-1, 2)


def _grouped(k1: np.ndarray, k2: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their groups, smallest id first, and which of them begin a group."""
    order = np.lexsort((low, k2, k1))
    new = np.ones(len(order), bool)
    new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
    return order, new


def _pack(n: int):
    def packed(t: pa.Table) -> pa.RecordBatch:
        ids, keys = B.ids_of(t["doc_id"]), sequence_keys(t["text"])
        order, new = _grouped(keys[:, 0], keys[:, 1], ids)
        copies = np.diff(np.append(np.flatnonzero(new), len(order)))
        first, blk = order[new], (keys[order[new], 0] % np.uint64(n)).astype(np.int64)
        place = np.argsort(blk, kind="stable")
        first, copies, blk = first[place], copies[place], blk[place]
        numbers, at = np.unique(blk, return_index=True)
        # texts are copied block by block, not all at once
        text = t["text"].cast(pa.large_string())
        group = lambda g, many: pa.table({"k1": keys[g, 0], "k2": keys[g, 1], "low": ids[g], "copies": many, "text": text.take(pa.array(g))})
        out = [B.freeze(group(first[a:b], copies[a:b])) for a, b in zip(at, [*at[1:], len(blk)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(out, pa.binary())], ["blk", "payload"])

    def pack(batches):
        for t in B.gathered(B.pieces(batches, B.PACK_BYTES // 4)):
            yield B.lean(packed, t)

    return pack


class Sets:
    """Groups of a block, one entry each, with their sorted shingles."""

    def __init__(self, payloads: pa.ChunkedArray, words: int):
        t = B.thaw(payloads)
        k1, k2, low = (np.asarray(t[c]) for c in ("k1", "k2", "low"))
        order, new = _grouped(k1, k2, low)
        first = order[new]
        self.k1, self.k2, self.rep = k1[first], k2[first], low[first]
        self.copies = np.add.reduceat(np.asarray(t["copies"])[order], np.flatnonzero(new))
        buf, offs = T.utf8(t["text"].take(pa.array(first)))
        parts = [shingle_sets(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a], words) for a, b in T.chunks(offs)]
        self.shingles = np.concatenate([np.zeros(0, np.uint64), *(s for s, _ in parts)])
        self.sizes = np.concatenate([np.zeros(0, np.int64), *(np.diff(b) for _, b in parts)])
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])

    def cells(self, bits: int):
        """Sorted cells in use, how many sets use each, and each shingle's place among them."""
        c = self.shingles >> np.uint64(64 - bits) << np.uint64(64 - bits)
        return np.unique(c, return_inverse=True, return_counts=True)


def _counts(n: int) -> B.Exchange:
    """How many groups use each cell."""
    add = lambda g, values, at, m: [np.minimum(np.bincount(at, weights=values[0], minlength=m), MOST_COUNT).astype(np.uint8)]
    return B.Exchange(n, [B.Group()], add, lambda g, keys, values: values)


def needed(t: float, a: int, b: int) -> int:
    """Overlap that sets of sizes a and b need: 100 * overlap >= 100 t * union."""
    p = round(t * 100)
    return -(-p * (a + b) // (100 + p))


class Node:
    __slots__ = ("edge", "kids", "most", "least", "owner", "same", "ends")

    def __init__(self, edge, least, most):
        self.edge = edge  # shingles on the way from the parent
        self.kids: dict[int, Node] = {}
        self.ends: list[int] = []  # sets that end here
        self.least, self.most = least, most  # least set size below; most shingles that follow this edge
        self.same, self.owner = True, -1  # all sets below were of one component; one of them


class Tree:
    def __init__(self, t: float, sizes: list[int], sets: list[np.ndarray], parent: dict[int, int], copies: list[int] | None = None):
        self.t, self.sizes, self.sets, self.parent, self.copies = t, sizes, sets, parent, copies
        self.counts = [0] * len(sets)  # links of each set, where copies are given
        self.root = Node(np.zeros(0, np.uint64), 1 << 60, 0)
        self.links: list[tuple[int, int]] = []

    def join(self, x: int, y: int) -> None:
        self.links.append((x, y))
        x, y = find(self.parent, x), find(self.parent, y)
        self.parent[max(x, y)] = min(x, y)

    def connected(self, node: Node, me: int) -> bool:
        return node.same and node.owner >= 0 and find(self.parent, node.owner) == me

    def probe(self, x: int) -> None:
        """Link x with a set of each component of the tree that has one like it; count its links with all sets."""
        own, copies = self.sets[x], self.copies
        held = np.sort(own)
        n, size = len(own), self.sizes[x]
        stack = [(self.root, 0, n)]
        while stack:
            node, overlap, left = stack.pop()
            if copies is None and self.connected(node, find(self.parent, x)):
                continue
            edge = node.edge
            if len(edge):
                hits = int((held[np.minimum(np.searchsorted(held, edge), n - 1)] == edge).sum())
                overlap, left = overlap + hits, left - hits
            if overlap + min(left, node.most) < needed(self.t, size, max(node.least, math.ceil(self.t * size - 1e-9))):
                continue
            for y in node.ends:
                if overlap >= needed(self.t, size, self.sizes[y]):
                    if copies is not None:
                        self.counts[x] += copies[y]
                        self.counts[y] += copies[x]
                    if find(self.parent, x) != find(self.parent, y):
                        self.join(x, y)
            stack += [(kid, overlap, left) for kid in node.kids.values()]

    def add(self, x: int) -> None:
        own, size = self.sets[x], self.sizes[x]
        node, at, path = self.root, 0, []
        while True:
            node.least, node.most = min(node.least, size), max(node.most, len(own) - at)
            path.append(node)
            if at == len(own):
                node.ends.append(x)
                break
            kid = node.kids.get(int(own[at]))
            if kid is None:
                kid = Node(own[at:], size, 0)
                kid.ends, kid.owner = [x], x
                node.kids[int(own[at])] = kid
                break
            edge, rest = kid.edge, own[at:]
            m = min(len(edge), len(rest))
            differ = np.flatnonzero(edge[:m] != rest[:m])
            k = int(differ[0]) if len(differ) else m
            if k < len(edge):  # cut the edge
                upper = Node(edge[:k], kid.least, kid.most + len(edge) - k)
                upper.same, upper.owner = kid.same, kid.owner
                kid.edge = edge[k:]
                upper.kids[int(edge[k])] = kid
                node.kids[int(edge[0])] = kid = upper
            node, at = kid, at + k
        for node in reversed(path):
            if node.owner < 0:
                node.owner = x
            elif not (node.same and find(self.parent, node.owner) == find(self.parent, x)):
                of = {find(self.parent, k.owner) if k.same else -1 for k in node.kids.values()} | {find(self.parent, y) for y in node.ends}
                node.same = len(of) == 1 and -1 not in of
                node.owner = x


def tree_links(sizes: list[int], sets: list[np.ndarray], t: float, left: list[int] | None = None, right: list[int] | None = None, copies: list[int] | None = None) -> tuple[list[tuple[int, int]], list[int]]:
    """Links that connect what all pairs at the threshold would, and (where copies are given) how many links each set has; between left and right only where they are given."""
    tree = Tree(t, sizes, sets, {}, copies)
    if left is None:
        for x in sorted(range(len(sets)), key=lambda k: sizes[k]):
            if len(sets[x]):
                tree.probe(x)
                tree.add(x)
        return tree.links, tree.counts
    for x in left:
        tree.add(x)
    for x in right or []:
        tree.probe(x)
    return tree.links, tree.counts


def _cluster_task(t: float, count_links: bool):
    """Links (a, b, 0) between nodes, and (a, a, links) of each node that has any."""

    def run(table: pa.Table) -> pa.Table:
        a, b, c = [], [], []
        cluster, part = np.asarray(table["cluster"]), np.asarray(table["part"])
        i, j = np.asarray(table["i"]), np.asarray(table["j"])
        node, n, many = np.asarray(table["node"]), np.asarray(table["n"]), np.asarray(table["copies"])
        order = np.lexsort((node, j, i, cluster))
        key = np.stack([cluster[order], i[order], j[order]])
        cut = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])) if len(order) else []
        for k, e in zip(cut, [*cut[1:], len(order)], strict=True):
            rows = order[k:e]
            sets = [np.frombuffer(table["shared"][int(r)].as_py(), np.uint64) for r in rows]
            sizes = n[rows].tolist()
            copies = many[rows].tolist() if count_links else None
            if i[rows[0]] == j[rows[0]]:
                links, counts = tree_links(sizes, sets, t, copies=copies)
            else:
                at = np.argsort(n[rows], kind="stable").tolist()
                links, counts = tree_links(sizes, sets, t, [x for x in at if part[rows[x]] == i[rows[0]]], [x for x in at if part[rows[x]] == j[rows[0]]], copies)
            linked = [x for x, k in enumerate(counts) if k]
            a += [int(node[rows[x]]) for x, _ in links] + [int(node[rows[x]]) for x in linked]
            b += [int(node[rows[y]]) for _, y in links] + [int(node[rows[x]]) for x in linked]
            c += [0] * len(links) + [counts[x] for x in linked]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(c, pa.int64())})

    return run


FOUND = "node long, k1 long, k2 long, rep long, n long, copies long, shared binary, first array<long>"


def _found(docs: DataFrame, words: int, threshold: float) -> tuple[DataFrame, int]:
    """Groups of equal texts: (node, key, smallest id, set size, copies, shared shingles, those of the prefix), and the number of blocks."""
    size = B.text_bytes(docs)
    n, bits = B.n_blocks(docs, size), B.sketch_bits(size, SPREAD)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = plain.mapInArrow(_pack(n), B.DEALT).repartition(min(n, B.MOST_PARTS), "blk")
    exchange = _counts(n)

    def ask(key, table):
        cells, _, count = Sets(table["payload"], words).cells(bits)
        return exchange.ask(key[0].as_py(), [[cells, np.minimum(count, MOST_COUNT).astype(np.uint8)]])

    counts = exchange.answers(dealt.groupBy("blk").applyInArrow(lambda key, table: B.lean(ask, key, table), B.MESSAGE))

    def prefixes(key, left, right):
        s = Sets(left["payload"], words) if left.num_rows else None
        if s is None:
            return B.table_of([], "node long, k1 long, k2 long, rep long, n long, copies long, shared binary").append_column("first", pa.array([], pa.list_(pa.int64())))
        _, place, _ = s.cells(bits)
        count = exchange.read(right)[0][0][0][place]
        owner = np.repeat(np.arange(len(s.rep)), s.sizes)
        order = np.lexsort((s.shingles, count, owner))
        shingles, count = s.shingles[order], count[order]
        rank = np.arange(len(order)) - np.repeat(s.bounds[:-1], s.sizes)
        limit = s.sizes - -(-round(threshold * 100) * s.sizes // 100) + 1
        shared = count > 1
        first = shared & (rank < np.repeat(limit, s.sizes))
        tell = T.sums_by(first, s.bounds) > 0
        both = [np.concatenate([[0], np.cumsum(T.sums_by(m, s.bounds))]) for m in (shared, first)]
        kept, prefix = shingles[shared], pa.array(shingles[first].view(np.int64))
        told = [kept[a:b][::-1].tobytes() if t else None for a, b, t in zip(both[0][:-1], both[0][1:], tell.tolist(), strict=True)]
        at = pa.array([a if t else None for a, t in zip(both[1][:-1].tolist(), tell.tolist(), strict=True)] + [int(both[1][-1])], pa.int32())
        return pa.table({
            "node": (key[0].as_py() << NODE_BITS) + np.arange(len(s.rep)), "k1": s.k1.view(np.int64), "k2": s.k2.view(np.int64), "rep": s.rep, "n": s.sizes, "copies": s.copies,
            "shared": pa.array(told, pa.binary()), "first": pa.ListArray.from_arrays(at, prefix),
        })

    return B.written(dealt.groupBy("blk").cogroup(counts.groupBy("blk")).applyInArrow(lambda key, left, right: B.lean(prefixes, key, left, right), FOUND)), n


def _tasks(members: DataFrame, n: int, threshold: float, cluster_shingles: int) -> DataFrame:
    """Members of clusters by task: one for a small cluster, one for each pair of parts of a large one that can have links."""
    # sizes of linked sets differ by 1 / threshold at most: never by two bands
    banded = members.withColumn("band", F.floor(F.log(F.col("n")) / math.log(1.01 / threshold)).cast("long"))
    bands = banded.groupBy("cluster", "band").agg(F.sum(F.length("shared") / 8).alias("size"), F.count(F.lit(1)).alias("rows"))
    parts = F.collect_list(F.struct(F.col("band"), F.ceil(F.col("size") / cluster_shingles).cast("long").alias("parts")))  # an entry for each band: a logarithm of the longest text
    shapes = bands.groupBy("cluster").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"), F.map_from_entries(parts).alias("parts")).where("rows > 1").drop("rows")
    code = lambda band, part: F.shiftleft(band, 20) + part
    count = lambda band: F.coalesce(F.col("parts")[band], F.lit(0).cast("long"))
    to = lambda m: F.when(m > 0, F.sequence(F.lit(0).cast("long"), m - 1)).otherwise(F.array().cast("array<long>"))
    band, part = F.col("band"), F.col("part")
    pairs = F.concat(
        F.transform(to(count(band)), lambda q: F.struct(code(band, F.least(part, q)).alias("i"), code(band, F.greatest(part, q)).alias("j"))),
        F.transform(to(count(band + 1)), lambda q: F.struct(code(band, part).alias("i"), code(band + 1, q).alias("j"))),
        F.transform(to(count(band - 1)), lambda q: F.struct(code(band - 1, q).alias("i"), code(band, part).alias("j"))),
    )
    one = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))
    whole = F.col("size") <= cluster_shingles
    return (
        banded.join(shapes, "cluster")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.greatest(count(F.col("band")), F.lit(1).cast("long"))))
        .withColumn("whole", whole)
        .withColumn("pair", F.explode(F.when(F.col("whole"), one).otherwise(pairs)))
        .withColumn("code", F.when(F.col("whole"), F.lit(0).cast("long")).otherwise(code(F.col("band"), F.col("part"))))
        .select("node", "n", "copies", "shared", "cluster", F.col("code").alias("part"), "pair.i", "pair.j", F.when(F.col("whole"), F.pmod(F.xxhash64("cluster"), F.lit(8 * n))).otherwise(F.xxhash64("cluster", "pair.i", "pair.j")).alias("bin"))
    )


def _classes(docs: DataFrame, words: int, threshold: float, cluster_shingles: int, count_links: bool) -> DataFrame:
    """(k1, k2, n, copies, rep, least, first, links): each group with the smallest id of its class, whether it is the class's first group, and its links with other groups."""
    found, n = _found(docs, words, threshold)
    probes = found.where("first is not null").select("node", F.explode("first").alias("shingle"))
    least = probes.groupBy("shingle").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most").drop("most")
    clusters = B.written(components(probes.join(least, "shingle").select(F.col("node").alias("a"), "b")).withColumnRenamed("component", "cluster"))
    members = B.written(found.where("shared is not null").select("node", "n", "copies", "shared").join(clusters, "node"))
    links = B.written(_tasks(members, n, threshold, cluster_shingles).groupBy("bin").applyInArrow(_cluster_task(threshold, count_links), "a long, b long, links long"))
    nodes = components(links)
    groups = found.select("node", "k1", "k2", "n", "copies", "rep")
    least = nodes.join(groups.select("node", "rep"), "node").groupBy("component").agg(F.min(F.struct("rep", "node")).alias("low"))
    out = groups.join(nodes.join(least, "component").select("node", "low"), "node", "left")
    if count_links:
        out = out.join(links.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")), "node", "left")
    else:
        out = out.withColumn("links", F.lit(0).cast("long"))
    return out.select("k1", "k2", "n", "copies", "rep", F.coalesce("low.rep", "rep").alias("least"), F.coalesce(F.col("low.node") == F.col("node"), F.lit(True)).alias("first"), F.coalesce("links", F.lit(0)).alias("links"))


def _keyed(rows: DataFrame, text: Callable) -> DataFrame:
    """rows with the key (k1, k2) of each one's words; ``text`` finds the texts in a batch."""

    def run(batches):
        for batch in batches:
            k = sequence_keys(text(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k[:, 0].view(np.int64)), pa.array(k[:, 1].view(np.int64))], [*batch.schema.names, "k1", "k2"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, k1 long, k2 long")


def similar(docs: DataFrame, words: int = 5, threshold: float = 0.8, cluster_shingles: int = CLUSTER_SHINGLES, count_links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): the size of each document's set, the smallest doc_id reachable by links, and with how many other rows it has a link (left out without count_links)."""
    classes = _classes(docs, words, threshold, cluster_shingles, count_links)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = _keyed(own, lambda batch: batch["text"]).drop("text").join(classes, ["k1", "k2"])
    alone = F.col("n") == 0
    component = F.when(alone, F.col("doc_id")).when(F.col("least") != B.NO_ID, F.col("least"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")]
    if count_links:
        columns.append(F.when(alone, 0).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"))
    return rows.select(*columns)


def one_of_each(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """Whole rows of docs: of each class one row, with the smallest doc_id; rows without words link with nothing and stay. Classes are those of texts, so rows without doc_id or with a repeated one are judged each by its text."""
    keep = _classes(docs, words, threshold, CLUSTER_SHINGLES, False).where("first and n > 0").select("k1", "k2", F.col("rep").alias("id"), F.lit(True).alias("kept"))
    # inside Python the row is opaque: it goes through as it is
    place = docs.columns.index("text")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(B.NO_ID)).alias("id"))
    key = ["k1", "k2", "id"]  # with the id, copies of one text spread over the tasks
    rows = _keyed(whole, lambda batch: batch["row"].field(place)).join(keep, key, "left")
    e1, e2 = sequence_keys(pa.array([""]))[0].view(np.int64).tolist()
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("k1"))
    return rows.withColumn("nth", nth).where(((F.col("k1") == e1) & (F.col("k2") == e2)) | (F.col("kept") & (F.col("nth") == 1))).select("row.*")
