"""Nulls, empty and long texts, ties, repeated rows, empty tables and further columns, against brute force on small rows."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from fluvia.llm import ann, bpe, chat, jaccard, lm, mixing, quality, rules, sharding, substring
from fluvia.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"w{i * i % 9973}" for i in range(30000))
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE + " tail", "en", "b"), (4, None, "en", None), (5, "", None, "a"), (6, "one two", "en", "b"), (7, "One\tTWO", "en", "b"),
    (8, LONG, "de", "a"), (9, LONG + " x y z", "de", "a"), (None, BASE, "en", "c"), (11, "  spaced\n\nout \x0b end ", "fr", "c"), (12, "é ü 漢字 \U0001f600 " * 20, "fr", "c"),
    (13, "same line\nsame line\nother\nsame line", "fr", None), (13, "same line\nsame line\nother\nsame line", "fr", None), (14, "a a a a a a a a " * 20, "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def words(text, lower=False):
    found = WORD.findall(text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found] if lower else found


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for c in ("blk", "payload", "rep", "ids", "component", "x", "_copies", "n", "size", "carry_0", "label"):  # names that operators use inside
        df = df.selectExpr("*", f"'z' AS {c}")
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for df in (bpe.encoded(none, Q.vocabulary()), lm.scores(none), quality.classify(none, labels), jaccard.similar(none), chat.read_back(chat.formatted(turns)), mixing.mixed(none), rules.quality_rules(none), substring.remove_repeats(none), ann.neighbours(vectors), quality.accepted(none, labels), jaccard.one_of_each(none), substring.without_repeats(none), mixing.remixed(none)):
        assert df.count() == 0


def test_bpe_like_the_library(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q.vocabulary())
    texts = [r[1] or "" for r in ROWS]
    want = Counter()
    for r, text in zip(ROWS, texts, strict=True):
        ids = t.encode(text, add_special_tokens=False).ids
        want[r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in bpe.encoded(docs, Q.vocabulary()).collect()) == want


def test_bpe_odd_texts():
    from tokenizers import Tokenizer

    c, t = bpe.codec(Q.vocabulary()), Tokenizer.from_file(Q.vocabulary())
    texts = ["<|endoftext|>", "a<|endoftext|> b", "x" * 3000, "ab" * 700 + " c", "  ", "\n\n a", "don't we'll 'S", "\x1c \x85 \xa0　", "\U0010ffff <|endoftext|>", "12³ Ⅳ"]
    for text in texts:
        flat = c.encode([text])
        assert flat.values.tolist() == t.encode(text, add_special_tokens=False).ids


def test_lm_base_and_model(docs):
    got = lm.scores(docs).collect()
    toks = [(r[0], words(r[1], True) + [None]) for r in ROWS]
    c = Counter(w for i, t in toks if i is None or zlib.crc32(str(i).encode()) % 10 for w in t)
    total, v = sum(c.values()), len(c)
    from math import log10

    want = sorted((str(i), len(t), sum(c[w] > 0 for w in t), round(sum(log10((c[w] + 0.1) / (total + 0.1 * (v + 1))) for w in t), 6)) for i, t in toks)
    assert sorted((str(x.doc_id), x.n_tokens, x.n_known, round(x.base_score, 6)) for x in got) == want
    assert {x.train_tokens for x in got} == {total}
    assert all(x.score < 0 for x in got)


@pytest.mark.parametrize("n, t", [(4, 85), (5, 80), (2, 50)])
def test_jaccard_classes(docs, n, t):
    def shingles(text):
        w = words(text, True)
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [shingles(r[1]) for r in ROWS]
    ids = [float("inf") if r[0] is None else r[0] for r in ROWS]
    parent = list(range(len(ROWS)))

    def find(k):
        return k if parent[k] == k else find(parent[k])

    for a, b in combinations(range(len(ROWS)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for k in range(len(ROWS)):
        least[find(k)] = min(least.get(find(k), float("inf")), ids[k])
    for k in range(len(ROWS)):
        if not sets[k]:
            least[k] = ids[k]
    want = Counter((r[0], len(s), None if least[find(k) if s else k] == float("inf") else least[find(k) if s else k]) for k, (r, s) in enumerate(zip(ROWS, sets, strict=True)))
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in jaccard.similar(docs, n, t / 100).collect()) == want


def test_jaccard_parts_and_rounds(spark):
    """Clusters cut into parts, and components in contraction rounds, end alike."""
    import numpy as np

    from fluvia.llm._components import components

    rng = np.random.default_rng(1)
    base = [f"t{i}" for i in range(80)]
    rows = []
    for k in range(60):
        w = list(base)
        for j in rng.choice(80, rng.integers(0, 3), replace=False):
            w[j] = f"e{k}_{j}"
        rows.append((k, " ".join(w), "en", "s"))
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {x.doc_id: x.component_id for x in jaccard.similar(df, 3, 0.8).collect()}
    assert {x.doc_id: x.component_id for x in jaccard.similar(df, 3, 0.8, cluster_shingles=400).collect()} == whole
    links = spark.createDataFrame([(int(a), int(b)) for a, b in zip(range(1, 200), [max(0, k - int(rng.integers(1, 4))) if k % 37 else k for k in range(1, 200)], strict=True)], "a long, b long")
    one = {x.node: x.component for x in components(links).collect()}
    assert {x.node: x.component for x in components(links, single=3).collect()} == one


def test_jaccard_counts_every_link(spark):
    """Near copies that all link: components need n - 1 of the links, counts need all; copies count each, two texts without doc_id apart."""
    rows = [(k, " ".join(f"t{j}" if j != 5 * k else f"e{k}" for j in range(80)), "en", "s") for k in range(1, 13)]
    rows += [(100, rows[0][1].upper(), "en", "s"), (101, rows[0][1], "en", "s"), (None, rows[1][1] + " x", "en", "s"), (None, " ".join(f"z{j}" for j in range(80)), "en", "s"), (200, "", "en", "s"), (201, None, "en", "s"), (202, "two words", "en", "s"), (203, "Two words", "en", "s")]
    sets = [frozenset(zip(*(words(r[1], True)[k:] for k in range(3)), strict=False)) or frozenset([tuple(words(r[1], True))] if r[1] else []) for r in rows]
    want = Counter((r[0], len(a), sum(k != j and bool(a) and 100 * len(a & b) >= 80 * len(a | b) for k, b in enumerate(sets))) for j, (r, a) in enumerate(zip(rows, sets, strict=True)))
    df = spark.createDataFrame(rows, SCHEMA)
    assert max(n for _, _, n in want) > 10
    for most in (2_000_000, 300):
        assert Counter((x.doc_id, x.n_shingles, x.n_links) for x in jaccard.similar(df, 3, 0.8, cluster_shingles=most).collect()) == want


def test_substring(docs):
    first = {}
    rows = [(float("inf") if r[0] is None else r[0], words(r[1])) for r in ROWS]
    for i, w in rows:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, i), i)
    want = Counter()
    for r, (i, w) in zip(ROWS, rows, strict=True):
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = substring.remove_repeats(docs).collect()
    assert Counter((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got) == want
    cut = substring.without_repeats(docs)
    assert cut.columns == docs.columns
    by = {(x.doc_id, x.n_removed): x.text for x in got}
    assert by[11, 0] == ROWS[10][1]


def test_rules(docs):
    def stats(text):
        w, text = words(text), text or ""
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        rep = {j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(k, k + 3)}
        lines = [x for x in text.split("\n") if words(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep)

    want = Counter((r[0], *stats(r[1])) for r in ROWS)
    got = rules.quality_rules(docs).collect()
    assert Counter((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in got) == want
    for x in got:
        assert x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words)
        assert not (x.base_failed and x.kept)


def test_chat_round_trip(spark):
    texts = [None, "", "### user: x </turn>\n", "\\### Assistant: </turn> ok", "a\\hb\\\\l", "#", "<", "\\", " </turn>\n### assistant: ", "tail ", " ", "\n", "\\b\\h\\l" * 3, "漢字 \U0001f600"]
    rows = [(c, t, role, text) for c in (1, 2, None) for t, text in enumerate(texts) for role in ("user", "assistant")] + [(3, None, None, "x"), (3, 1, "we:ird\nrole #", "y"), (3, 1, "we:ird\nrole #", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS piece", "2 AS end")
    got = {x.conv_id: x for x in chat.read_back(chat.formatted(df)).collect()}
    for c in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(own), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_mixing_balances(spark, docs):
    got = mixing.mixed(docs).collect()
    assert len(got) == len(ROWS)
    assert all(x.taken <= 2 * x.size and x.taken == x.copies * x.size for x in got)
    rows = [(k, "w " * (1 + k * 7919 % 200), "en", f"s{k % 5}" if k % 11 else None) for k in range(3000)]
    big = spark.createDataFrame(rows, SCHEMA)
    one = mixing.mixed(big).collect()
    taken, goal = Counter(), {}
    for x in one:
        taken[x.source] += x.taken
        goal[x.source] = x.target
    assert all(abs(taken[s] - goal[s]) <= 0.001 * goal[s] for s in goal)
    assert abs(sum(goal.values()) - 1.5 * sum(len(words(r[1])) for r in rows)) < 1e-3
    assert sorted((x.doc_id, x.taken) for x in mixing.mixed(big.repartition(7)).collect()) == sorted((x.doc_id, x.taken) for x in one)
    copies = Counter(x.doc_id for x in mixing.remixed(big).collect())
    assert copies == Counter({x.doc_id: x.copies for x in one if x.copies})
    assert mixing.remixed(docs).columns == docs.columns


def test_mixing_targets_reshare(spark):
    t = spark.createDataFrame([("a", 1, 100), ("b", 1, 1000), ("c", 1, 10000), (None, 1, 500)], "source string, n_rows long, source_size long")
    got = {x.source: x.target for x in mixing.targets(t).collect()}
    # a and then b and the null source reach twice their size; the rest goes to c
    assert got == {"a": 200.0, "b": 2000.0, None: 1000.0, "c": pytest.approx(1.5 * 11600 - 3200)}


def test_sharding(spark, docs, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/store")
    assert store.read().count() == 0
    for k in range(5):
        assert store.append(docs.where(f"coalesce(doc_id, 0) % 5 = {k}").repartition(3)) == k + 1
    before, rows = store.shards(), store.read().count()
    assert rows == len(ROWS)
    version = store.compact()
    assert version == 6 and len(store.shards()) < len(before)
    assert Counter(map(str, store.read().collect())) == Counter(map(str, docs.collect()))
    assert store.read(5).count() == rows  # the version before is whole still
    assert store.vacuum() > 0 and store.read().count() == rows and store.versions() == [6]
    with pytest.raises(sharding.Conflict):
        store.commit({"version": 5, "parts": []}, docs.schema.json(), [])
    assert store.compact() == 6  # one file: nothing to merge


def test_neighbours(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]  # one vector many times
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)] + [(5000, None, 1), (5100, [0.0] * 16, 1), (5200, [float("nan")] * 16, 1), (5300, [None] * 16, 1), (5400, [1.0] * 3, 1), (None, [1.0] * 16, 1), (100, x[100].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS shard", "2 AS part")
    got = {}
    for r in ann.neighbours(df, shard_rows=4000).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(range(0, 3000, 100))
    hit = 0
    d = x.astype(float)
    for q, found in got.items():
        dist = np.sqrt(((d - d[q]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((np.arange(3000), dist)) if k != q][:10]
        hit += len({r.vec_id for r in found} & set(map(int, order)))
        assert [r.rank for r in found] == list(range(1, 11)) and all(abs(r.score - dist[r.vec_id]) < 1e-9 for r in found)
    assert hit >= 0.9 * 10 * len(got)
    assert [r.vec_id for r in got[100]] == list(range(101, 111))


def test_quality(spark, docs):
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        rows.append((k, ("#$% " if bad else "plain words here ") * (20 + k % 30), "en", "s"))
        labels.append((k, 0 if bad else 1, 0))
    d, y = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.classify(d, y).collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) and 0 <= x.score <= 1 for x in got)
    assert sum(x.predicted == labels[x.doc_id][1] for x in got) >= 0.98 * len(got)
    assert {x.doc_id for x in quality.accepted(d, y).collect()} == {x.doc_id for x in got if x.predicted}
    odd = spark.createDataFrame([(None, None, None), (1, None, 0), (2, 1, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs, odd).count() == len(ROWS)


def test_isotonic_is_monotone():
    import numpy as np

    rng = np.random.default_rng(0)
    raw = rng.normal(size=500)
    knots, rates = quality.isotonic(raw, (raw + rng.normal(size=500) > 0).astype(float))
    assert (np.diff(knots) > 0).all() and (np.diff(rates) > 0).all()
