import random

import numpy as np
import pytest
from brute import components

from barloom.llm import components as C
from barloom.llm import jaccard_join as J

SF = "/root/testdata/sf0.001"


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df).collect()}


def test_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(df) == components({r["doc_id"]: r["text"] for r in df.collect()})


def corpus(seed):
    """Groups of near copies around one text, with a shared passage, copies, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(30))
    docs, n = {}, 0
    for _ in range(4):
        base = [word() for _ in range(60)]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            docs[n] = " ".join(w)
            n += 1
    for _ in range(30):
        docs[n] = passage + " " + " ".join(word() for _ in range(rng.randint(5, 60)))
        n += 1
    for t in (None, "", "  \n", "One", "one", "a b c d", "A b c\td", "a b c d e", "a b c d e f"):
        docs[n] = t
        n += 1
    return docs


@pytest.mark.parametrize("block", [512, 8])
def test_groups_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_CLASSES", block)
    monkeypatch.setattr(J, "FAN", 5)
    docs = corpus(block)
    df = spark.createDataFrame([(k, t, "n") for k, t in docs.items()], "doc_id long, text string, n string")
    assert found(df) == components(docs)


def test_repeated_rows_nulls_and_empty_table(spark):
    t = "the quick brown fox jumps over the lazy dog"
    df = spark.createDataFrame([(3, t), (3, t), (1, t.upper()), (None, "x y"), (5, "x y")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in J.jaccard_components(df).collect())
    assert got == [(0, 5), (1, 1), (3, 1), (3, 1), (5, 5)]
    assert J.jaccard_components(df.where("false")).count() == 0
    assert sorted(r["doc_id"] for r in J.one_of_each(df).collect()) == [1, 5]


def test_prefixes_share_enough(spark):
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, 60, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 1 << 62, 3, dtype=np.uint64)]))
        same = len(np.intersect1d(a, b))
        if 100 * same >= 80 * (len(a) + len(b) - same):
            for m in (1, 3, 7):
                p, q = (s[: len(s) - -(-80 * len(s) // 100) + m] for s in (a, b))
                assert len(np.intersect1d(p, q)) >= m


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1200)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges for x in (a, b) if a != b}
    got = {r["node"]: r["root"] for r in C.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert C.components(spark.createDataFrame([], "u long, v long")).count() == 0
