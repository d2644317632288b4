"""The corpus pipeline, stage by stage, and the SQL of the registered queries."""

import glob
import hashlib
import os
import re

import duckdb
import pytest

import corpus_pipeline
from verdance.llm import quality
from verdance.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(r[c] for c in columns) for r in df.collect())
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(r[names.index(c)] for c in columns) for r in cur.fetchall())


def shingles(text, size=5):
    words = text.encode().lower().split()
    k = min(size, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns = docs.columns
    held = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, sf_dir)
        held.append((name, before, docs.collect()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns

    name, before, after = held[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = quality.classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).collect()
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in scores if r["predicted"]}

    name, before, after = held[1]
    first = {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(first.values())

    name, before, after = held[2]
    before = sorted(before, key=lambda r: r["doc_id"])
    sets, root = [shingles(r["text"]) for r in before], list(range(len(before)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    assert sorted(r["doc_id"] for r in after) == sorted(before[i]["doc_id"] for i in set(root))

    name, before, after = held[3]
    words = lambda t: [w for w in re.split(r"[^\w]|_", t.lower()) if w]
    five = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    tests = [five(words(t)) for t in items]
    leaks = {r["doc_id"] for r in before for t in tests if 100 * len(t & five(words(r["text"]))) >= 80 * len(t)}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if r["doc_id"] not in leaks)

    name, before, after = held[4]
    texts = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in before}
    assert {r["doc_id"]: r["decoded_sha256"] for r in after} == texts
    assert all(len(r["ids"]) == r["n_tokens"] for r in after)

    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(texts)
    assert corpus_pipeline.ORACLE_SQL is None
