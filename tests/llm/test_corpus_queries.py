"""Queries and the pipeline's stages over the smallest tables."""

import re
from collections import Counter
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest

from fluvia.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, sf, name):
    db = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = Q.queries()[name](spark, sf)
    cols = sorted(df.columns)
    want = db.sql(f"SELECT {', '.join(cols)} FROM ({Q.oracle_sql()[name]})").fetchall()
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(want)


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.B.written(stage(spark, kept, sf))
        assert kept.columns == docs.columns
        seen.append({r.doc_id for r in kept.select("doc_id").collect()})
    assert seen[1] < seen[0] and seen[2] == seen[1] and seen[3] < seen[2]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = {k for k, v in labels.items() if v == 1}
    assert len(good & seen[0]) >= 0.95 * len(good)
    out = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in kept.collect())


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text, lower=False):
    found = WORDS.findall(text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found] if lower else found


@pytest.fixture
def corner(spark, tmp_path):
    """Documents with nulls, repeated ids, copies, near copies and shared passages, and columns beyond those of documents."""
    base = [f"term{k}" for k in range(80)]
    passage = [f"shared{k}" for k in range(30)]
    good = [" ".join(f"{a}{k}" for k in range(70)) for a in ("alpha", "beta", "gamma", "delta")]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(good)]
    rows += [(10, " ".join(base), "en", "s", 1), (11, " ".join(base).upper(), "en", "t", 1), (12, " ".join(base) + " more", "en", None, 1), (None, " ".join(base) + " other", "en", "s", 1)]
    rows += [(20, " ".join([f"left{k}" for k in range(40)] + passage), "en", "s", 1), (21, " ".join(passage + [f"right{k}" for k in range(40)]), None, "s", None)]
    rows += [(30, None, "en", "s", 0), (31, "", None, None, 0), (31, "  ", "en", "s", 2), (40, "same id, one", "en", "s", 1), (40, "same id, two", "en", "s", 1), (None, "lonely text", "en", "t", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("k1", "k2", "row", "payload", "score", "hash"):
        docs = docs.selectExpr("*", f"'z' AS {c}")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(4)] + [(None, None, None), (99, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_against_brute_force(spark, corner):
    """Each stage on what its predecessor left."""
    from tokenizers import Tokenizer

    from fluvia.llm import bpe

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{corner}/documents.parquet")
    rows = [r.asDict() for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
    first = stages["quality classifier"](spark, docs, corner)
    # one kind of label alone: every score is its share
    assert Counter(map(str, first.collect())) == Counter(map(str, docs.select(*corpus_pipeline.COLUMNS).collect()))

    second = stages["n-gram Jaccard join"](spark, first, corner)
    assert second.columns == corpus_pipeline.COLUMNS
    sets = [frozenset(zip(*(words_of(r["text"], True)[k:] for k in range(5)), strict=False)) or frozenset([tuple(words_of(r["text"], True))] if words_of(r["text"]) else []) for r in rows]
    parent = list(range(len(rows)))

    def find(k):
        return k if parent[k] == k else find(parent[k])

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    classes = {}
    for k, r in enumerate(rows):
        key = float("inf") if r["doc_id"] is None else r["doc_id"]
        if sets[k]:
            classes.setdefault(find(k), []).append((key, r["text"]))
    left = [r for r in second.collect()]
    assert Counter(float("inf") if r.doc_id is None else r.doc_id for r in left if words_of(r.text)) == Counter(min(c)[0] for c in classes.values())
    assert sum(not words_of(r.text) for r in left) == sum(not s for s in sets)

    third = stages["substring dedup"](spark, second, corner)
    at = {}
    for r in left:
        w = words_of(r.text)
        for k in range(len(w) - 12):
            key, i = tuple(w[k : k + 13]), float("inf") if r.doc_id is None else r.doc_id
            at[key] = min(at.get(key, i), i)
    want = Counter()
    for r in left:
        w, i = words_of(r.text), float("inf") if r.doc_id is None else r.doc_id
        gone = {j for k in range(len(w) - 12) if at[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        want[r.doc_id, " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    kept = third.collect()
    assert Counter((r.doc_id, " ".join(words_of(r.text))) for r in kept) == want and ("shared5" not in next(r.text for r in kept if r.doc_id == 21))
    assert all(r.n_chars == len(r.text or "") for r in kept)

    fourth = stages["mixing sources"](spark, third, corner)
    taken, size = Counter(), Counter()
    for r in fourth.collect():
        taken[r.source] += len(words_of(r.text))
    for r in kept:
        size[r.source] += len(words_of(r.text))
    assert all(taken[s] <= 2 * size[s] for s in taken) and {r.text for r in fourth.collect()} <= {r.text for r in kept}

    t = Tokenizer.from_file(Q.vocabulary())
    last = stages["BPE encoding"](spark, fourth, corner).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in last) == Counter((r.doc_id, tuple(t.encode(r.text or "", add_special_tokens=False).ids)) for r in fourth.collect())
    assert bpe is not None and Counter(map(str, corpus_pipeline.run(spark, corner).collect())) == Counter(map(str, last))


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, extra int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_without_the_subpackage(tmp_path):
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[2]
    for p in ("fluvia", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", root / p, tmp_path], check=True)
    subprocess.run(["rm", "-r", tmp_path / "fluvia" / "llm"], check=True)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') and k[2].isdigit() for k in e.queries()))"], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert re.fullmatch(r"\d+ False\n", out.stdout), out.stderr
