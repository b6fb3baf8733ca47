"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from vectorised passes over the UTF-8 buffer of each Arrow batch. Trees are
grown on quantised features by histograms of gradients, on a bounded sample of labelled rows on
the driver; the model is flattened into a few arrays that every task walks with numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import wordhash as W
from barloom.llm.common import id_bucket, map_arrow, narrow, texts

#: Labelled rows that the trees are fitted on, at most (those with the smallest hash of doc_id).
MAX_TRAIN_ROWS = 20_000

_GROUPS = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" ",
    b"\n",
    b"\t\x0b\x0c\r",
    b".",
    b",",
    b"!",
    b"?",
    b"|",
    b"#",
    b"$%&*@^~",
    b"'\"`",
    b"()[]{}<>",
    b"-_=+/\\",
    b":;",
]
_CLASS = np.full(256, len(_GROUPS), np.int64)
for _k, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _k
_CLASS[128:] = len(_GROUPS) + 1
N_CLASSES = len(_GROUPS) + 2


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over each row's range."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: how many distinct values it has, and how often the commonest occurs."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(h)))
    most = np.zeros(n)
    np.maximum.at(most, row[at], runs)
    return np.bincount(row[at], minlength=n).astype(np.float64), most


def statistics(col: pa.Array) -> np.ndarray:
    """One row of statistics per text; empty texts have zeros."""
    data, offsets = W.buffers(col)
    out = []
    for lo, hi, h, words in W.word_hashes(col, W.SPACES):
        n = hi - lo
        own = offsets[lo : hi + 1] - offsets[lo]
        size = np.diff(own)
        count = np.zeros((n, N_CLASSES))
        piece = data[offsets[lo] : offsets[hi]]
        for at in range(0, max(len(piece), 1), W.BLOCK):  # a long row piece by piece
            part = piece[at : at + W.BLOCK]
            row = np.searchsorted(own, np.arange(at, at + len(part)), "right") - 1 if n == 1 else np.repeat(np.arange(n), size)[at : at + W.BLOCK]
            count += np.bincount(row * N_CLASSES + _CLASS[part], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
        n_words = np.diff(words).astype(np.float64)
        pairs, pair_at = W.grams(h, words, 2)
        n_pairs = np.maximum(np.diff(pair_at), 1)
        distinct, most = _repeats(h, words)
        distinct2, most2 = _repeats(pairs, pair_at)
        same = np.zeros(len(h))
        if len(h):
            same[1:] = h[1:] == h[:-1]
            same[words[:-1][n_words > 0]] = 0
        w, b = np.maximum(n_words, 1), np.maximum(size, 1)
        letters = count[:, 0] + count[:, 1] + count[:, N_CLASSES - 1]
        out.append(
            np.column_stack(
                [
                    np.log1p(size),
                    np.log1p(n_words),
                    size / w,
                    distinct / w,
                    most / w,
                    distinct2 / n_pairs,
                    most2 / n_pairs,
                    _per_row(same, words) / w,
                    letters / b,
                    count[:, 1] / np.maximum(letters, 1),
                    count[:, 6] / w,
                    count[:, 7] / w,
                    count[:, 8] / w,
                    count[:, 10] / w,
                    (count[:, 11] + count[:, 12]) / w,
                    n_words / (count[:, 4] + 1),
                    count / b[:, None],
                ]
            )
        )
    return np.concatenate(out) if out else np.zeros((0, 16 + N_CLASSES))


@dataclass
class Trees:
    """A boosted model as arrays: heap-ordered full trees of one depth."""

    bias: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes
    value: np.ndarray  # trees x leaves
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of x."""
        z = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            z += v[node - len(f)]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least: float = 2.0) -> Trees:
    """Logistic boosting on quantile bins. Without both labels the score is constant."""
    inner, leaves = 2**depth - 1, 2**depth
    p = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    bias = float(np.log(p / (1 - p)))
    model = Trees(bias, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), depth)
    if not len(y) or y.min() == y.max():
        return model
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    z = np.full(n, bias)
    features, cuts, values = [], [], []
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-z))
        g, h = q - y, q * (1 - q)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-9)
            split = np.zeros(width, np.int64)
            for j in range(m):
                k = len(edges[j]) + 1
                if k < 2:
                    continue
                at = local * k + binned[:, j]
                gs = np.bincount(at, g, width * k).reshape(width, k).cumsum(1)
                hs = np.bincount(at, h, width * k).reshape(width, k).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gl, hl = gs[:, :-1], hs[:, :-1]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(hl < least) | (ht - hl < least)] = 0
                b = gain.argmax(1)
                top = gain[np.arange(width), b]
                better = top > best
                best[better] = top[better]
                feature[first : first + width][better] = j
                cut[first : first + width][better] = edges[j][b[better]]
                split[better] = b[better]
            f = feature[node]
            right = (binned[np.arange(n), f] > split[local]) & np.isfinite(cut[node])
            node = 2 * node + 1 + right
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        z += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    model.feature, model.cut, model.value = np.array(features), np.array(cuts), np.array(values)
    return model


def training_labels(labels: DataFrame, label_col: str, most: int, id_col: str = "doc_id") -> DataFrame:
    """At most `most` rows (doc_id, y): one per labelled id, those with the smallest hash of the id.

    Rows with a null id or label don't count; an id with several labels has their rounded mean.
    """
    one = narrow(labels, doc_id=id_col, y=label_col).where("doc_id IS NOT NULL AND y IS NOT NULL")
    one = one.groupBy("doc_id").agg(F.round(F.avg("y")).cast("int").alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit_quality(df: DataFrame, labels: DataFrame, label_col: str = "quality", held_modulus: int = 3, held_value: int = 1, max_rows: int = MAX_TRAIN_ROWS) -> Trees:
    """Fit on labelled rows of df outside the held-out split: max_rows labels at most, and one row of df for each.

    Where an id has several rows in df, the one whose statistics have the smallest hash counts.
    """
    wanted = training_labels(labels.where(id_bucket(F.col("doc_id"), held_modulus) != held_value), label_col, max_rows)
    rows = narrow(df, doc_id="doc_id", text="text").join(F.broadcast(wanted), "doc_id")  # at most max_rows ids

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(texts(batch))
        return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("y")), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())], ["doc_id", "y", "x"])

    measured = map_arrow(rows.select("doc_id", "text", "y"), measure, "doc_id long, y int, x array<double>")
    one = measured.groupBy("doc_id").agg(F.min_by(F.struct("x", "y"), F.xxhash64("x")).alias("r")).select("r.x", "r.y")
    got = one.withColumn("key", F.xxhash64("x", "y")).toArrow().sort_by("key")  # at most max_rows
    lists = got.column("x").combine_chunks()
    flat = np.concatenate([np.asarray(c.flatten()) for c in (lists.chunks if isinstance(lists, pa.ChunkedArray) else [lists])] or [np.zeros(0)])
    return fit_trees(flat.reshape(-1, 16 + N_CLASSES), got.column("y").to_numpy().astype(np.float64))


def score_quality(df: DataFrame, model: Trees) -> DataFrame:
    """One row per row of df: doc_id, score. Null and empty texts are scored as texts without words."""

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(model.score(statistics(texts(batch))))], ["doc_id", "score"])

    return map_arrow(narrow(df, doc_id="doc_id", text="text"), score, "doc_id long, score double")


def quality_scores(df: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of df.

    Without usable labels every score is 0.5; an empty df gives an empty result. Null and empty texts are scored as
    texts without words; repeated rows, and rows whose id is null or repeated, are each scored. Very long texts
    count whole. Other columns are ignored, whatever their names.
    """
    return score_quality(df, fit_quality(df, labels)).select(
        "doc_id",
        (F.coalesce(id_bucket(F.col("doc_id"), 3), F.lit(0)) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of df that the classifier doesn't reject (score >= 0.5), with all their columns."""
    model = fit_quality(df, labels)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.score(statistics(texts(batch))) >= 0.5))

    return map_arrow(df, keep, df.schema)
