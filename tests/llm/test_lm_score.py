import math
from collections import Counter

import pytest
from brute import words

from barloom.llm import lm_score as L


def plain(texts, least=2):
    docs = [words(t) for t in texts]
    one, two = Counter(w for d in docs for w in d), Counter(p for d in docs for p in zip(d, d[1:], strict=False))
    n = sum(one.values())

    def score(d):
        s = math.log(one[d[0]] / n) if d else 0.0
        return s + sum(math.log(two[v, w] / one[v]) if two[v, w] >= least else math.log(0.4 * one[w] / n) for v, w in zip(d, d[1:], strict=False))

    return [(len(d), score(d)) for d in docs]


@pytest.mark.parametrize(("top_words", "least", "gather"), [(1 << 20, 2, 2_000_000), (1 << 20, 1, 5000), (300, 2, 5000), (300, 1, 2_000_000), (3, 2, 5000), (0, 2, 5000)])
def test_table(spark, monkeypatch, top_words, least, gather):
    monkeypatch.setattr(L, "GATHER", gather)
    monkeypatch.setattr(L, "PAIRS_AT_ONCE", gather)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(80)
    rows = df.collect()
    want = dict(zip([r["doc_id"] for r in rows], plain([r["text"] for r in rows], least), strict=True))
    got = {r["doc_id"]: r for r in L.lm_scores(df, top_words=top_words, least=least).collect()}
    assert set(got) == set(want)
    for k, (n, s) in want.items():
        assert got[k]["n_tokens"] == n and abs(got[k]["score"] - s) < 1e-5


def test_edges(spark):
    texts = [None, "", " \n", "a", "A b a B", "a b " * 300_000, "a b " * 3000, "a b " * 3000, "Z z", "Z z"]
    df = spark.createDataFrame([(i if i != 3 else None, t, 1.0, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, score double, body string, base int")
    got = sorted(((r["n_tokens"], r["score"]) for r in L.lm_scores(df.unionByName(df)).collect()))
    for (n, s), (m, t) in zip(got, sorted(plain(texts + texts)), strict=True):
        assert n == m and abs(s - t) < 1e-3
    assert [r["mean_score"] for r in L.lm_scores(df).where("n_tokens = 0").collect()] == [None] * 3
    assert L.lm_scores(df.where("false")).count() == 0


def test_more_rows_than_a_group_holds(spark, monkeypatch):
    monkeypatch.setattr(L, "GROUP_ROWS", 7)
    texts = [("a b c d " * (i % 5)).strip() for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r["doc_id"]: r["score"] for r in L.lm_scores(df, top_words=2).collect()}
    assert all(abs(got[i] - s) < 1e-5 for i, (_, s) in enumerate(plain(texts)))
