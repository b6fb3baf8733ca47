"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are present or absent: single words and their first bytes (so that inflected forms share a
feature), pairs, and pairs one or two words apart, hashed into a fixed number of cells. Each weight has its own learning rate, and the L1 term leaves most weights
at exactly zero, so what tasks get is one small sparse vector of a proven size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import wordhash as W
from barloom.llm.common import forget, id_bucket, map_arrow, narrow, stored, texts
from barloom.llm.quality import training_labels
from barloom.session import ship_package

#: Labelled rows that the weights are fitted on, at most (those with the smallest hash of doc_id).
MAX_TRAIN_ROWS = 8_192
BITS = 20
_WORDS = W.SPACES + W.PUNCTUATION
_STEMS = (4, 5, 6, 8)
_GAP = [np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)]


def features(col: pa.Array, bits: int = BITS):
    """For ranges of rows lo..hi: cells of all their features, and the row of each."""
    mask = np.uint64((1 << bits) - 1)
    for lo, hi, h, at, stems in W.stem_hashes(col, _WORDS, _STEMS):
        row = np.repeat(np.arange(hi - lo), np.diff(at))
        cells, rows = [x & mask for x in (h, *stems)], [row] * (1 + len(stems))
        for gap, salt in enumerate(_GAP, 1):
            if len(h) > gap:
                same = row[gap:] == row[:-gap]
                cells.append((W.mix(h[:-gap] * salt + h[gap:]) & mask)[same])
                rows.append(row[gap:][same])
        yield lo, hi, np.concatenate(cells).astype(np.int64), np.concatenate(rows)


class Ftrl:
    """FTRL-proximal: z and n per coordinate; weights follow from them."""

    def __init__(self, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.z0, self.n0 = 0.0, 0.0

    def weight(self, cells: np.ndarray) -> np.ndarray:
        z = self.z[cells]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[cells])) / self.alpha + self.l2))

    def bias(self) -> float:
        return -self.z0 / ((self.beta + self.n0**0.5) / self.alpha + self.l2)

    def learn(self, cells: np.ndarray, ends: np.ndarray, y: np.ndarray) -> None:
        """One step on a few documents: their cells one after another, the end of each, and their labels."""
        doc = np.repeat(np.arange(len(y)), np.diff(ends, prepend=0))
        b = self.bias()
        one, at = np.unique(cells, return_inverse=True)
        w = self.weight(one)
        margin = np.bincount(doc, w[at], len(y)) + b
        g = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) - y
        step = np.bincount(at, g[doc], len(one))
        n = self.n[one]
        # Each document's square counts: rates fall as if documents came one by one.
        more = n + np.bincount(at, g[doc] ** 2, len(one))
        self.z[one] += step - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[one] = more
        more = self.n0 + float((g * g).sum())
        self.z0 += float(g.sum()) - (more**0.5 - self.n0**0.5) / self.alpha * b
        self.n0 = more


class Weights:
    """The weights that aren't zero, for broadcast; scoring looks cells up in a dense copy."""

    def __init__(self, cells: np.ndarray, values: np.ndarray, bias: float, bits: int):
        self.cells, self.values, self.bias, self.bits = cells, values, bias, bits

    def score(self, col: pa.Array) -> np.ndarray:
        dense = np.zeros(1 << self.bits)
        dense[self.cells] = self.values
        out = np.zeros(len(col))
        for lo, hi, cells, rows in features(col, self.bits):
            hit = np.flatnonzero(dense[cells])
            one = np.unique(rows[hit] * np.int64(1 << self.bits) + cells[hit])  # present or absent
            out[lo:hi] = np.bincount(one >> self.bits, dense[one & ((1 << self.bits) - 1)], hi - lo)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -35, 35)))


def present(col: pa.Array, bits: int = BITS):
    """The distinct cells of each text, in order."""
    for lo, hi, cells, rows in features(col, bits):
        one = np.unique(rows * np.int64(1 << bits) + cells)
        ends = np.searchsorted(one >> bits, np.arange(hi - lo + 1))
        cell = (one & ((1 << bits) - 1)).astype(np.int32)
        yield from (cell[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))


def fit_weights(docs: list[np.ndarray], y: np.ndarray, epochs: int = 6, bits: int = BITS, seed: int = 7, together: int = 8) -> Weights:
    """Several passes over documents' cells in a fixed random order, a few documents a step. Without rows every score is 0.5."""
    model, order = Ftrl(bits), np.random.Generator(np.random.PCG64(seed))
    for _ in range(epochs):
        shuffled = order.permutation(len(docs))
        for at in range(0, len(docs), together):
            own = shuffled[at : at + together]
            model.learn(np.concatenate([docs[i] for i in own]), np.cumsum([len(docs[i]) for i in own]), y[own])
    w = model.weight(np.arange(1 << bits))
    cells = np.flatnonzero(w)
    return Weights(cells, w[cells], model.bias(), bits)


def training_cells(rows: DataFrame, bits: int = BITS) -> tuple[list[np.ndarray], np.ndarray]:
    """Cells and label of each row (text, y), in an order that follows from them. Texts stay on the executors.

    A cell in one or two documents tells little about others: only cells of more are sent, and a cell has bits bits, so
    what reaches the driver is bounded by rows and cells, not by the length of texts.
    """
    cells = 1 << bits

    def count(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for d in present(texts(batch), bits):
                total[d] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["cell", "n"])

    ship_package(rows.sparkSession)
    common = rows.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where("n > 2").select("cell").toArrow()
    seen = np.zeros(cells, bool)
    seen[common.column("cell").to_numpy()] = True
    kept = rows.sparkSession.sparkContext.broadcast(np.packbits(seen).tobytes())

    def select(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = np.unpackbits(np.frombuffer(kept.value, np.uint8)).view(bool)
        found = [d[own[d]] for d in present(texts(batch), bits)]
        ends = np.concatenate([[0], np.cumsum([len(d) for d in found])]).astype(np.int32)
        flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int32), pa.int32())
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), flat), batch.column(batch.schema.get_field_index("y")), batch.column(batch.schema.get_field_index("key"))], ["cells", "y", "key"])

    got = map_arrow(rows.withColumn("key", F.xxhash64("text", "y")), select, "cells array<int>, y int, key long").toArrow().sort_by("key")
    docs = [np.asarray(c.values.to_numpy()) for chunk in got.column("cells").chunks for c in chunk]
    return docs, got.column("y").to_numpy().astype(np.float64)


def fit_toxicity(df: DataFrame, labels: DataFrame, label_col: str = "toxic", held_modulus: int = 5, held_value: int = 0, max_rows: int = MAX_TRAIN_ROWS) -> Weights:
    """Fit on labelled rows of df outside the held-out split: max_rows labels at most, and one row of df for each.

    Where an id has several rows in df, the one whose text has the smallest hash counts.
    """
    wanted = training_labels(labels.where(id_bucket(F.col("doc_id"), held_modulus) != held_value), label_col, max_rows)
    rows = narrow(df, doc_id="doc_id", text="text").join(F.broadcast(wanted), "doc_id")  # at most max_rows ids
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("y").cast("int").alias("y"))
    rows = rows.groupBy("doc_id").agg(F.min_by(F.struct("text", "y"), F.xxhash64("text")).alias("r")).select("r.text", "r.y")
    train = stored(rows, "train")
    out = fit_weights(*training_cells(train))
    forget(train)
    return out


def toxicity_scores(df: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of df.

    Null and empty texts get the score of a text without words; without usable labels it is 0.5.
    An empty df gives an empty result; repeated rows, and rows whose id is null or repeated, are each scored.
    Very long texts are hashed in pieces. Other columns are ignored, whatever their names. Where an id has
    several labels, the rule of training_labels holds.
    """
    weights = fit_toxicity(df, labels)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(weights.score(texts(batch)))], ["doc_id", "score"])

    return map_arrow(narrow(df, doc_id="doc_id", text="text"), score, "doc_id long, score double").select(
        "doc_id",
        (F.coalesce(id_bucket(F.col("doc_id"), 5), F.lit(1)) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
