"""Quality, toxicity and language: held-out accuracy and edges."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.llm import language, quality, toxicity

SF = "/root/testdata/sf0.01"
EDGES = [(-1, None), (-2, ""), (-3, "\n"), (-4, "1234 !!"), (-5, "word " * 400_000), (None, "plain text here")]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(i, t, None) for i, t in EDGES], "doc_id long, text string, lang string")
    return docs.unionByName(extra), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(out, labels, col):
    y = {r["doc_id"]: r[col] for r in labels.collect()}
    rows = [r for r in out.collect()]
    own = [r for r in rows if r["held_out"] and r["doc_id"] in y]
    assert all(0 <= r["score"] <= 1 for r in rows)
    return rows, np.mean([r["predicted"] == y[r["doc_id"]] for r in own])


def test_quality(tables):
    docs, labels = tables
    rows, accuracy = held_out(quality.quality_scores(docs, labels), labels, "quality")
    assert len(rows) == 1000 + len(EDGES) and accuracy > 0.95
    assert quality.quality_scores(docs.where("false"), labels).count() == 0
    assert {r["score"] for r in quality.quality_scores(docs.limit(5), labels.where("false")).collect()} == {0.5}
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_toxicity(tables):
    docs, labels = tables
    rows, accuracy = held_out(toxicity.toxicity_scores(docs, labels), labels, "toxic")
    assert len(rows) == 1000 + len(EDGES) and accuracy > 0.85
    assert {r["score"] for r in toxicity.toxicity_scores(docs.limit(5), labels.where("false")).collect()} == {0.5}


def test_language(tables):
    docs, _ = tables
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language.languages(docs).collect()
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"] and truth[r["doc_id"]]]) > 0.98
    by = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert [by[i] for i in (-1, -2, -3, -4)] == ["und"] * 4 and by[-5] != "und"
    assert {r["lang_pred"] for r in language.languages(docs.withColumn("lang", docs["text"].substr(1, 0)).where("doc_id < 0")).collect()} <= {"und", ""}


def test_a_mixture_shows_both_languages():
    a, b = ("the cat sat on the mat and then the hat " * 50), ("der hund und die katze sind nicht hier und dort " * 50)
    count = lambda t: language.trigram_counts(np.frombuffer(t.encode(), np.uint8))
    m = language.Mixture(["de", "en"], np.array([count(b), count(a)]))
    lang, share = m.infer(count(a + b + b))
    assert m.languages[lang] == "de" and 0.5 < share < 0.85
    assert m.infer(count(a))[1] > 0.99


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((quality.fit_trees(x, y).score(x) > 0.5) == y).mean() > 0.97


def test_ftrl_weights_are_sparse():
    rng = np.random.default_rng(1)
    texts, y = [], []
    for i in range(400):
        w = [f"w{k}" for k in rng.integers(0, 500, 30)]
        y.append(i % 2)
        texts.append(" ".join(w + ["awful"] * y[-1]))
    model = toxicity.fit_weights(list(toxicity.present(pa.array(texts))), np.array(y, float))
    assert len(model.cells) < 3000 and (((model.score(pa.array(texts)) > 0.5) == np.array(y)).mean()) > 0.98


def test_one_document_a_step_is_plain_ftrl():
    """Against the update written out per coordinate."""
    rng = np.random.default_rng(2)
    docs = [np.unique(rng.integers(0, 40, 8)) for _ in range(60)]
    y = rng.integers(0, 2, 60).astype(float)
    model = toxicity.Ftrl(6, l1=0.3)
    z, n, z0, n0 = {}, {}, 0.0, 0.0
    weight = lambda i: 0.0 if abs(z.get(i, 0.0)) <= 0.3 else -(z[i] - np.sign(z[i]) * 0.3) / ((1 + n[i] ** 0.5) / 1 + 0.1)
    for d, label in zip(docs, y, strict=True):
        b = -z0 / ((1 + n0**0.5) / 1 + 0.1)
        w = {i: weight(i) for i in d}
        g = 1 / (1 + np.exp(-(sum(w.values()) + b))) - label
        for i in d:
            z[i] = z.get(i, 0.0) + g - ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) * w[i]
            n[i] = n.get(i, 0.0) + g * g
        z0, n0 = z0 + g - ((n0 + g * g) ** 0.5 - n0**0.5) * b, n0 + g * g
        model.learn(d, np.array([len(d)]), np.array([label]))
    cells = np.arange(64)
    assert np.allclose(model.weight(cells), [weight(i) if i in z else 0.0 for i in cells]) and np.isclose(model.z0, z0)


@pytest.mark.parametrize(("run", "label"), [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic"), (lambda d, _: language.languages(d), None)])
def test_repeated_rows_null_ids_and_other_columns(tables, run, label):
    docs, labels = tables
    few = docs.where("doc_id < 300 OR doc_id IS NULL")
    twice = few.unionByName(few).withColumns({"score": F.lit("x"), "y": F.lit(None).cast("string"), "held_out": F.lit(1), "cells": F.lit(2)})
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    once, both = ([r.asDict() for r in sorted(run(d, labels).collect(), key=key)] for d in (few, twice))
    assert len(both) == 2 * len(once) and both[::2] == both[1::2]
    if label:
        assert both[::2] == once  # a label counts once, however often its row is repeated
    assert run(few.where("false"), labels).count() == 0


def walk(model, row):
    z = model.bias
    for f, c, v in zip(model.feature, model.cut, model.value, strict=True):
        node = 0
        while node < len(f):
            node = 2 * node + (2 if row[f[node]] > c[node] else 1)
        z += v[node - len(f)]
    return 1 / (1 + np.exp(-z))


def test_trees_are_walked_as_written_out():
    """Scores of flattened trees against a walk node by node."""
    rng = np.random.default_rng(4)
    x = rng.random((500, 4))
    model = quality.fit_trees(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float))
    assert np.allclose(model.score(x), [walk(model, row) for row in x])


def test_mixture_against_every_set_of_languages():
    """EM over the chosen languages has the likelihood that a fine grid over proportions has."""
    a, b = ("the cat sat on the mat and then the hat " * 50), ("der hund und die katze sind nicht hier und dort " * 50)
    count = lambda t: language.trigram_counts(np.frombuffer(t.encode(), np.uint8))
    m = language.Mixture(["de", "en"], np.array([count(b), count(a)]), rounds=200)
    total = count(a + b + b)
    cells = np.flatnonzero(total)
    n = total[cells].astype(float)
    grid = [(s, float((n * np.log(m.p[cells] @ np.array([s, 1 - s]))).sum())) for s in np.linspace(0.001, 0.999, 999)]
    share, likelihood = m.proportions(cells, n, [0, 1])
    best = max(grid, key=lambda g: g[1])
    assert abs(best[0] - share[0]) < 0.01 and likelihood >= best[1] - 0.5


def test_more_languages_than_one_fetch(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 3)
    rows = [(i, f"{chr(97 + i % 20) * 3} {chr(98 + i % 20) * 4} " * 20, f"l{i % 20:02d}") for i in range(200)]
    got = language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    truth = {i: lang for i, _, lang in rows}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.95
