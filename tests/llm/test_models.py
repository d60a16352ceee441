"""Models and kernels against plain versions of themselves: scores, weights, sums, calibration, balance, words that a weak hash confuses."""

import hashlib
import time
import timeit
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from math import log2, log10

import numpy as np
import pyarrow as pa
import pytest

from fluvia.llm import _blocks as B
from fluvia.llm import _text as T
from fluvia.llm import ann, jaccard, lm, mixing, quality, rules, sharding, substring

SCHEMA = "doc_id long, text string, lang string, source string"


# words and lines that a polynomial modulo 2**64 can't tell apart
ODD = "".join("ab"[k.bit_count() & 1] for k in range(1024))
EVEN = ODD.translate(str.maketrans("ab", "ba"))


def test_hashes_tell_long_words_apart():
    words = [ODD, EVEN, ODD[:256], EVEN[:256], "a", "b", "", "ab", "ba", ODD + "a", ODD + "b"]
    buf, offs = T.utf8(pa.array(words))
    for lane in (0, 1):
        assert len(set(T.span_hashes(buf, offs[:-1], offs[1:], lane=lane).tolist())) == len(words)
    upper = T.utf8(pa.array([w.upper() for w in words]))[0]
    assert T.span_hashes(upper, offs[:-1], offs[1:], lower=True).tolist() == T.span_hashes(buf, offs[:-1], offs[1:]).tolist()


def test_long_words_in_all_operators(spark):
    tail = " ".join(f"t{k}" for k in range(12))
    rows = [(1, f"{ODD} {tail}", "", "s"), (2, f"{EVEN} {tail}", "", "s"), (20, ODD, "", "s"), (21, EVEN, "", "s"), (30, f"{ODD}\n{EVEN}\n{ODD} x", "", "s")]
    held = next(k for k in range(100, 200) if zlib.crc32(str(k).encode()) % 10 == 0)
    unseen = EVEN[::-1] + EVEN[:512]
    rows += [(held, f"{unseen} {ODD}", "", "s"), (40, unseen.translate(str.maketrans("ab", "ba")), "", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {x.doc_id: x.n_removed for x in substring.remove_repeats(docs).collect()} == {r[0]: 0 for r in rows}
    assert all(x.component_id == x.doc_id for x in jaccard.similar(docs, 4, 0.85).collect())
    assert {x.doc_id: x.n_dup_lines for x in rules.quality_rules(docs).collect()} == {r[0]: 0 for r in rows}
    assert {x.doc_id: x.n_known for x in lm.scores(docs).collect()}[held] == 2  # the long word it has in common, and the end


def routed(x: B.Exchange, blocks: list[list[list[np.ndarray]]]):
    """What Spark does with an exchange's rows, in plain loops: answers of each block, and how many messages went up."""
    sent, levels = 0, []
    now = [r for k, b in enumerate(blocks) for r in x.ask(k, b).to_pylist()]
    for level in range(1, x.levels + 1):
        sent += len(now)
        by = defaultdict(list)
        for r in now:
            by[r["node"]].append(r)
        levels.append({k: B.table_of([tuple(r.values()) for r in v], B.MESSAGE) for k, v in by.items()})
        if level < x.levels:
            now = [r for k, t in levels[-1].items() for r in x._up(level)((pa.scalar(k),), t).to_pylist()]
    back = [r for k, t in levels[-1].items() for r in x._top()((pa.scalar(k),), t).to_pylist()]
    for level in range(x.levels - 1, 0, -1):
        by = defaultdict(list)
        for r in back:
            by[r["blk"]].append(tuple(r.values()))
        back = [r for k, t in levels[level - 1].items() for r in x._down(level)((pa.scalar(k),), t, B.table_of(by[k], B.ANSWER)).to_pylist()]
    by = defaultdict(list)
    for r in back:
        by[r["blk"]].append(tuple(r.values()))
    return [x.read(B.table_of(by[k], B.ANSWER)) for k in range(len(blocks))], sent


@pytest.mark.parametrize("n, fan", [(3, 8), (9, 3), (30, 3), (64, 4)])
def test_exchange_answers_like_one_table(n, fan):
    rng = np.random.default_rng(n)
    pool = rng.integers(0, 2**64, 300, dtype=np.uint64)
    blocks = [np.unique(rng.choice(pool, 40)) for _ in range(n)]
    total = Counter(k for b in blocks for k in b.tolist())
    x = jaccard._counts(n)
    x = B.Exchange(n, x.groups, x.combine, x.answer, totals=lambda g: np.array([len(g[0][0])]), fan=fan)
    answers, _ = routed(x, [[[b, np.ones(len(b), np.uint8)]] for b in blocks])
    for b, (groups, totals) in zip(blocks, answers, strict=True):
        assert groups[0][0].tolist() == [total[k] for k in b.tolist()]
        assert totals.tolist() == [len(total)]
    ids = rng.permutation(n)
    y = substring.owners(n)
    y = B.Exchange(n, y.groups, y.combine, y.answer, y.back, fan=fan)
    least = {}
    for k, b in zip(ids.tolist(), blocks, strict=True):
        for v in b.tolist():
            least[v] = min(least.get(v, n), k)
    answers, _ = routed(y, [[[b, T.mix(b), np.full(len(b), k)]] for k, b in zip(ids.tolist(), blocks, strict=True)])
    for k, b, (groups, _) in zip(ids.tolist(), blocks, answers, strict=True):
        assert groups[0][0].tolist() == [least[v] == k for v in b.tolist()]


def test_messages_grow_with_the_input():
    """Of each block at most fan messages a level: never blocks times blocks."""
    rng = np.random.default_rng(0)
    sent = {}
    for n in (16, 64, 256):
        x = jaccard._counts(n)
        x = B.Exchange(n, x.groups, x.combine, x.answer, fan=4)
        _, sent[n] = routed(x, [[[np.unique(rng.integers(0, 2**64, 60, dtype=np.uint64)), np.ones(60, np.uint8)]] for _ in range(n)])
        assert sent[n] <= n * x.fan * x.levels and x.fan <= 4
    assert sent[256] <= 16 * sent[16] * 2  # levels: 2, 3, 4


def test_suspects_like_plain_sets_in_little_time():
    """Windows whose every cell is shared; of a full block they are found in a few times the CPU seconds that hashing takes."""
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 500))) for _ in range(1500)]
    for some, bits in (([*texts[:30], *texts[:5], "", "a b"], 16), (texts + texts[:500], 31)):
        table = pa.table({"doc_id": pa.array(range(len(some)), pa.int64()), "text": pa.array(some, pa.large_string())})
        where = [(k, j) for k, x in enumerate(some) for j in range(len(x.split()) - 12)]
        h = T.ngrams(T.Words(*T.utf8(table["text"])).hashes(), np.array([len(x.split()) for x in some]), 13)[0]
        used = [Counter(substring._cells(h, r, bits).tolist()) for r in range(substring.ROWS)]
        flags = [[np.array([u[c] > 1 for c in sorted(u)])] for u in used]
        s = substring.Suspects(table, flags, 13, bits)
        shared = np.all([[u[c] > 1 for c in substring._cells(h, r, bits).tolist()] for r, u in enumerate(used)], axis=0)
        assert list(zip(s.row.tolist(), s.pos.tolist(), strict=True)) == [x for x, y in zip(where, shared, strict=True) if y]
        assert s.h1[s.place].tolist() == h[shared].tolist()
    least = lambda f: min(timeit.repeat(f, timer=time.process_time, number=1, repeat=3))
    assert least(lambda: substring.Suspects(table, flags, 13, bits)) < 6 * least(lambda: substring._windows(table, 13))


def test_blocks_follow_counted_bytes(spark, monkeypatch):
    """Frames that Catalyst guesses wrong: joined with themselves, or made from nothing."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat(concat('w', id % 50, ' '), 40) AS text")
    both = docs.join(docs.select("doc_id"), "doc_id").crossJoin(spark.range(1))
    size = B.text_bytes(both)
    assert size == sum(len(f"w{k % 50} ") * 40 for k in range(2000))
    monkeypatch.setattr(B, "BLOCK_BYTES", 20_000)
    assert B.n_blocks(both, size) == -(-size // 20_000)
    assert B.text_bytes(docs.where("false")) == 0


def test_operators_over_several_levels(spark, monkeypatch):
    """Many small blocks and a fan of 3: results as with one level."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 40, 60)) for _ in range(40)]
    rows = [(k, texts[k % 40] + (f" x{k} y{k}" if k % 3 else ""), "en", "s") for k in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    run = lambda: [Counter(map(str, f.collect())) for f in (substring.remove_repeats(docs), jaccard.similar(docs, 3, 0.8), lm.scores(docs).selectExpr("doc_id", "n_known", "round(score, 8)"))]
    one = run()
    monkeypatch.setattr(B, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(B.Exchange.__init__, "__defaults__", (None, None, 3))
    assert run() == one


def test_no_shared_folder(spark, monkeypatch):
    class Far:
        class sparkContext:
            applicationId, master = "app", "spark://elsewhere:7077"

        conf = spark.conf

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            B.shared_folder(Far)


def test_intermediate_tables_go(spark):
    made = []

    def build():
        for k in range(2):
            made.append(B.written(spark.range(k + 1)).inputFiles()[0].rsplit("/", 1)[0])
        return spark.range(3)

    out = B.settled(spark, build)
    assert out.count() == 3
    for path in made:
        at, fs = B._path(spark, path)
        assert not fs.exists(at)


def model(rows, order=3):
    """Counts and weights in plain dictionaries; a function from (context of two words, word) to its probability."""
    docs = [(zlib.crc32(str(i).encode()) % 10, ["</s>", "</s>", *t.lower().split(), "</s>"]) for i, t, *_ in rows]

    def counts(folds):
        c, ctx = Counter(), Counter()
        for f, w in docs:
            if f in folds:
                for k in range(2, len(w)):
                    for n in range(order):
                        c[tuple(w[k - n : k + 1])] += 1
                        ctx[tuple(w[k - n : k])] += 1
        return c, ctx

    def estimates(c, ctx, before, w):
        grams = [tuple(before[len(before) - n :]) for n in range(order)]
        return [c[(*g, w)] / ctx[g] if ctx[g] else 0.0 for g in grams], [ctx[g] for g in grams]

    def row_of(seen):
        row = 0
        for n in range(1, order):
            if seen[n]:
                row = (n - 1) * lm.BUCKETS + int(log2(seen[n]))
        return row

    fit = counts(range(2, 10))
    floor = sum(len(g) == 1 for g in fit[0]) + 1
    cells = defaultdict(list)
    for f, w in docs:
        if f == 1:
            for k in range(2, len(w)):
                p, seen = estimates(*fit, w[k - 2 : k], w[k])
                p = [x * floor for x in p]
                cells[(row_of(seen), *(round(log2(x) / lm.STEP) if x else None for x in p))].append(p)
    keys = list(cells)
    lam = lm.learn_weights(np.array([k[0] for k in keys], int), np.array([[*np.mean(cells[k], axis=0), 1.0] for k in keys]).reshape(-1, order + 1), np.array([len(cells[k]) for k in keys]), (order - 1) * lm.BUCKETS)
    c, ctx = counts(range(1, 10))
    v = sum(len(g) == 1 for g in c)

    def probability(before, w):
        p, seen = estimates(c, ctx, before, w)
        mix = lam[row_of(seen)]
        share = sum(m for m, s in zip(mix, seen, strict=False) if s) + mix[-1]
        return (sum(m * x for m, x in zip(mix, p, strict=False)) + mix[-1] / (v + 1)) / share

    return docs, [g[0] for g in c if len(g) == 1], probability


def test_scores_by_deleted_interpolation(spark):
    rng = np.random.default_rng(2)
    words = ["the", "a", "cat", "dog", "sat", "ran", "on", "mat"]
    rows = [(k, " ".join(words[int(j) % 8] for j in np.cumsum(rng.integers(0, 3, 2 + k % 12))) + (f" only{k}" if k % 7 == 0 else ""), "en", "s") for k in range(300)] + [(1000, "", "en", "s")]
    docs, vocabulary, probability = model(rows)
    want = {r[0]: sum(log10(probability(w[k - 2 : k], w[k])) for k in range(2, len(w))) for r, (_, w) in zip(rows, docs, strict=True)}
    got = {x.doc_id: x.score for x in lm.scores(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}
    for before in (["</s>", "</s>"], ["</s>", "the"], ["cat", "sat"], ["mat", "zebra"], ["zebra", "the"]):
        assert sum(probability(before, w) for w in [*vocabulary, "never seen"]) == pytest.approx(1)


def test_em_finds_the_mixture():
    """Tokens drawn from a known mixture of two estimates and the floor."""
    rng = np.random.default_rng(1)
    true = np.array([0.6, 0.3, 0.1])
    dists = np.stack([rng.dirichlet(np.full(50, 0.1)), rng.dirichlet(np.full(50, 1.0)), np.full(50, 0.02)], axis=1)
    n = rng.multinomial(200_000, dists @ true)
    lam = lm.learn_weights(np.zeros(50, int), dists / 0.02, n, 2)
    assert np.abs(lam[0] - true).max() < 0.02
    assert np.allclose(lam[1].sum(), 1)


def test_ridge_and_calibration(spark):
    """The model fitted from sums over partitions is that of all rows at once."""
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for k in range(600):
        good = rng.random() < 0.5
        rows.append((k, " ".join(rng.choice(["word", "Text", "9", "#", "end."] if good else ["#", "$$", "9", "word"], int(rng.integers(1, 60)))), "en", "s"))
        labels.append((k, int(good ^ (rng.random() < 0.1)), 0))
    docs, y = spark.createDataFrame(rows, SCHEMA).repartition(7), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.fit(quality.measured(docs), y)
    learns = [k for k in range(600) if zlib.crc32(str(k).encode()) % 3 != 1]
    buf, offs = T.utf8(pa.array([r[1] for r in rows]))
    x = quality.statistics(rules.Texts(buf, offs))[learns]
    label = np.array([labels[k][1] for k in learns], float)
    assert np.allclose(got.centre, x.mean(axis=0)) and np.allclose(got.scale, np.where(x.std(axis=0) < 1e-6, 1, x.std(axis=0)))
    fold = spark.createDataFrame([(k,) for k in learns], "doc_id long").selectExpr("doc_id", "pmod(xxhash64(doc_id, 7), 4) = 0 AS c").collect()
    calibrates = np.array([dict((r.doc_id, r.c) for r in fold)[k] for k in learns])
    z = quality.fourier(np.clip((x - got.centre) / got.scale, -6, 6))
    a, b = z[~calibrates], label[~calibrates]
    weights = np.linalg.solve(a.T @ a + quality.RIDGE * max(1.0, len(a)) * np.eye(z.shape[1]) / quality.DIMENSION, a.T @ b)
    assert np.allclose(z @ weights, z @ got.weights, atol=1e-6)
    raw, rate = (z @ weights)[calibrates], label[calibrates]
    order = np.argsort(raw)
    r = rate[order]
    # isotonic regression by its minimax formula
    means = lambda i: [r[i : j + 1].mean() for j in range(i, len(r))]
    table = [[None] * i + means(i) for i in range(len(r))]
    fitted = np.array([max(min(table[i][k:]) for i in range(k + 1)) for k in range(len(r))])
    assert set(np.round(got.rates, 9)) == set(np.round(fitted, 9))


def test_isotonic_pools():
    knots, rates = quality.isotonic(np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1]))
    assert knots.tolist() == [1, 2.5, 4, 5][: len(knots)] or rates.tolist() == [0, 0.5, 1]


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(3)
    for case in range(30):
        n = int(rng.integers(3, 200))
        size = rng.integers(1, 500, n)
        p = rng.random(n)
        out = mixing.flight(p, size, np.random.default_rng(case))
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(p.sum(), abs=1e-6) and (out * size).sum() == pytest.approx((p * size).sum(), abs=1e-4 * size.max())


def test_flight_keeps_probabilities():
    p, size = np.array([0.1, 0.5, 0.3, 0.7, 0.4, 0.6, 0.25, 0.15]), np.array([5, 9, 2, 14, 7, 3, 11, 6])
    mean = np.mean([mixing.flight(p, size, np.random.default_rng(k)) for k in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def test_landing_is_the_nearest():
    p, size = np.array([1.0, 0.4, 0.0, 0.7]), np.array([50, 10, 30, 4])
    want = (p * size).sum()
    got = mixing.landing(p, size)
    settled = [0, 2]
    assert got[settled].tolist() == p[settled].tolist()
    assert abs((got * size).sum() - want) == min(abs(50 + a * 10 + b * 4 - want) for a in (0, 1) for b in (0, 1))


def test_mixing_many_rows_of_one_id(spark):
    """Rows without doc_id, and of one doc_id, are dealt to several blocks and drawn like any other."""
    rows = [(None if k % 2 else 7, "w " * (1 + k * 31 % 97), "en", "s") for k in range(4000)] + [(9, "same text", "en", "s")] * 300
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixed(docs, share=0.7).collect()
    assert len(got) == len(rows) and abs(sum(x.taken for x in got) - got[0].target) <= 0.001 * got[0].target
    kept = Counter((r.doc_id, r.text) for r in mixing.remixed(docs).collect())
    drawn = Counter()
    for x in mixing.mixed(docs).collect():
        drawn[x.doc_id, x.size] += x.copies
    by_size = Counter()
    for (i, t), n in kept.items():
        by_size[i, len(t.split())] += n
    assert by_size == +drawn


def texts(rows):
    buf, offs = T.utf8(pa.array(rows))
    return rules.Texts(buf, offs)


def test_cascade_takes_no_measure_twice():
    rows = ["# " * 80, "plain words " * 40, "x", " ".join(f"w{k}" for k in range(90)), "one line here\n" * 60, "", "#" * 400]
    for own in (rules.default_rules(), rules.default_rules()[::-1]):
        t = texts(rows)
        kept = rules.verdicts(t, own)
        spared = dict(t.taken)
        assert any(n < len(rows) for n in spared.values())
        for name in rules.MEASURES:
            t.get(name)
            t.get(name, np.array([0, 3]))
        assert {k for k, n in t.taken.items() if n != len(rows)} == set()
        plain = texts(rows)
        assert kept.tolist() == [not any(r.rejects(*(plain.get(x)[k : k + 1] for x in r.needs))[0] for r in own) for k in range(len(rows))]
        for name in (*rules.MEASURES, "n_lines"):
            assert t.get(name).tolist() == plain.get(name).tolist()


def test_rule_order_by_rejections_per_cost(spark):
    own = rules.default_rules()
    order = rules.in_order(own, [(r.name, 1.0 + k, 0.1 * k) for k, r in enumerate(own)])
    assert [r.name for r in order][-1] == "few_words"
    c = rules.Cascade(own, every=2)
    for _ in range(4):
        assert c.verdicts(texts(["plain words " * 40, " ".join(f"word{k}" for k in range(60)), "x"])).tolist() == [False, True, False]
    assert c.seen == 6 and c.order[-1].name in ("symbols", "word_length", "dup_lines")
    docs = spark.createDataFrame([(1, "x"), (2, " ".join(f"word{k}" for k in range(60))), (3, None)], "doc_id long, text string")
    assert [r.doc_id for r in rules.accepted(docs).collect()] == [2]


def test_tiers_keep_sizes_apart():
    s = [sharding.Shard(f"f{k}", 10) for k in range(8)] + [sharding.Shard("big", 900), sharding.Shard("mid", 100), sharding.Shard("more", 400), sharding.Shard("also", 490), sharding.Shard("near", 600), sharding.Shard("close", 700)]
    runs = sharding.tiers(s, 1000)
    assert [[x.path for x in r] for r in runs] == [[f"f{k}" for k in range(8)], ["more", "also"]]
    assert [sharding.tier_of(x, 4) for x in (0, 1, 3, 4, 15, 16, 4**20 - 1, 4**20)] == [0, 0, 0, 1, 1, 2, 19, 20]


def test_large_shards_are_left_alone(spark, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/store")
    big = spark.range(200_000).selectExpr("id", "sha2(cast(id AS string), 256) AS h").coalesce(1)
    store.append(big)
    large = store.shards()
    for k in range(5):
        store.append(big.where(f"id = {k}"))
    assert len(store.shards()) == 6
    store.compact()
    now = store.shards()
    assert large[0] in now and len(now) == 2 and store.read().count() == 200_005
    # files of one tier are packed to files of the target, by one job
    many = sharding.Store(spark, f"file://{tmp_path}/many")
    for _ in range(2):
        many.append(spark.range(40_000).selectExpr("id", "sha2(cast(id AS string), 256) AS h").repartition(8))
    size = sum(s.size for s in many.shards())
    many.compact(target=size // 3)
    assert 3 <= len(many.shards()) <= 6 and many.read().count() == 80_000 and many.read().distinct().count() == 40_000
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "0"


def test_writers_that_race_or_die(spark, tmp_path):
    store, other = (sharding.Store(spark, f"file://{tmp_path}/store") for _ in range(2))
    rows = spark.range(3).toDF("id")
    store.append(rows)
    base = store.manifest()
    assert other.append(rows) == 2
    with pytest.raises(sharding.Conflict):  # planned on version 1, which is no longer the last
        store.commit(base, base["schema"], [])
    store.fs.create(store._at(f"{store.path}/manifest/v000000003.claim"), False).close()  # a writer claimed and died
    with pytest.raises(sharding.Conflict):
        store.append(rows)
    patient = sharding.Store(spark, f"file://{tmp_path}/store", claim_seconds=-1)
    assert patient.append(rows) == 3 and store.read().count() == 9
    store.vacuum()
    assert store.append(rows) == 4 and store.read().count() == 12


def test_manifest_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "PART_SHARDS", 4)
    store = sharding.Store(spark, f"file://{tmp_path}/store")
    for k in range(3):
        store.append(spark.range(10 * k, 10 * k + 10).repartition(3))
    assert sum(p["shards"] for p in store.manifest()["parts"]) == len(store.shards()) == 9
    assert all(p["shards"] <= 4 for p in store.manifest()["parts"])
    store.compact()
    assert len(store.shards()) == 1 and store.read().count() == 30


def test_recall_of_forests():
    """Shards well over a leaf: nothing is searched whole, and recall comes from the share that is searched."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest, names = ann.Forest(x, seed=0), np.arange(6000)
    hits = looked = 0
    for q in range(0, 6000, 200):
        rows = forest.candidates(x[q], int(ann.SHARE * 6000), names)
        d = ((x - x[q]) ** 2).sum(axis=1)
        best = [k for k in np.argsort(d) if k != q][:10]
        hits += len(set(best) & set(rows.tolist()))
        looked += len(rows)
    assert hits >= 0.9 * 300 and looked <= 0.64 * 6000 * 30
    # one name in many rows counts once
    many = np.zeros(6000, int)
    many[5990:] = np.arange(1, 11)
    assert len(np.unique(many[forest.candidates(x[0], 11, many)])) == 11


def test_clustered_vectors_need_a_small_share(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(60, 24))
    x = np.repeat(centre, 50, axis=0) + 0.05 * rng.normal(size=(3000, 24))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    hits = 0
    for r in ann.neighbours(df, every=50, share=0.05, shard_rows=4000).collect():
        d = ((x - x[r.query_id]) ** 2).sum(axis=1)
        hits += r.vec_id in set([k for k in np.argsort(d) if k != r.query_id][:10])
    assert hits >= 0.9 * 600


def test_hot_groups_stay_out_of_blocks(spark):
    """A third of all rows is one text: blocks hold one entry a scan task, and every copy gets its class."""
    rows = [(k, "one and the same text of a few words", "en", "s") for k in range(3000)] + [(3000 + k, f"different {k} text {k * k} number {k}", "en", "s") for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    packs = docs.select("doc_id", "text").mapInArrow(jaccard._pack(4), B.DEALT).collect()
    held = sum(B.thaw(pa.chunked_array([pa.array([bytes(r.payload)], pa.binary())])).num_rows for r in packs)
    assert held <= 600 + 6
    got = jaccard.similar(docs, 3, 0.8).collect()
    assert len(got) == 3600 and all(x.component_id == 0 and x.n_links == 2999 for x in got if x.doc_id < 3000)
    assert all(x.component_id == x.doc_id for x in got if x.doc_id >= 3000)
    assert jaccard.one_of_each(docs).count() == 601


def test_packs_are_bounded_in_bytes():
    """Spark's batches have a number of rows: one of 60 MB is packed in parts, and each text is sent once with all its copies of that part."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": [f"{k} " + "word " * 200_000 for k in range(60)]})
    packs = list(jaccard._pack(4)(iter([batch])))
    sent = [B.thaw(pa.chunked_array([p.column("payload")])) for p in packs]
    assert len(packs) > 1 and all(t["text"].nbytes < 1.5 * B.PACK_BYTES for t in sent)
    assert sorted(x for t in sent for x in t["low"].to_pylist()) == list(range(60))
    blocks = [(blk, k1) for p in packs for blk, x in zip(p.column("blk").to_pylist(), p.column("payload"), strict=True) for k1 in B.thaw(pa.chunked_array([pa.array([x.as_py()], pa.binary())]))["k1"].to_pylist()]
    assert len(blocks) == 60 and all(k1 % 4 == blk for blk, k1 in blocks)


def test_bands_lose_no_link(spark):
    """Sets of many sizes in one cluster, cut into bands and parts: all links as by brute force."""
    rng = np.random.default_rng(9)
    base = [f"t{k}" for k in range(160)]
    rows = [(k, " ".join(base[: int(rng.integers(40, 160))]), "en", "s") for k in range(50)]
    sets = [frozenset(zip(*(r[1].split()[k:] for k in range(3)), strict=False)) for r in rows]
    links = Counter()
    for a, b in combinations(range(50), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
    docs = spark.createDataFrame(rows, SCHEMA)
    for most in (1 << 18, 300, 60):
        assert {x.doc_id: x.n_links for x in jaccard.similar(docs, 3, 0.8, cluster_shingles=most).collect()} == {k: links[k] for k in range(50)}


def test_rows_without_id_are_judged_by_text(spark):
    base = " ".join(f"t{k}" for k in range(60))
    other = " ".join(f"u{k}" for k in range(60))
    rows = [(None, base + " x", "en", "s"), (None, other + " y", "en", "s"), (None, "alone and clean text here", "en", "s"), (5, base, "en", "s"), (7, other, "en", "s"), (8, "a", "en", "s"), (8, "b", "en", "s"), (8, "b", "en", "s"), (9, "", "en", "s"), (9, None, "en", "s")]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(None, "alone and clean text here"), (5, base), (7, other), (8, "a"), (8, "b"), (9, ""), (9, None)])
    classes = {(r.doc_id, r.component_id) for r in jaccard.similar(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (5, 5) in classes and (7, 7) in classes


def digest(words):
    return hashlib.sha256(" ".join(words).encode()).hexdigest()
