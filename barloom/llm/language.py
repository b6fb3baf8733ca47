"""Language identification by multilingual mixture inference.

Every language has a distribution over hashed byte trigrams of lower-cased letters. A document is a
mixture of languages: expectation-maximisation estimates the proportions from the trigrams'
likelihoods, and the set of languages grows one by one as long as the penalised likelihood does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import wordhash as W
from barloom.llm.common import forget, id_bucket, map_arrow, narrow, stored, texts
from barloom.session import ship_package

CELLS = 1 << 13
#: Languages whose counts the driver fetches at once.
LANGUAGES_AT_ONCE = 512

_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigram_counts(data: np.ndarray) -> np.ndarray:
    """How often each cell occurs in one text (its UTF-8 bytes). Other bytes than letters count as one space."""
    total = np.zeros(CELLS, np.int64)
    for at in range(0, len(data), W.BLOCK):
        x = _FOLD[data[max(0, at - 2) : at + W.BLOCK]]
        if len(x) < 3:
            continue
        g = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        g = g[(x[1:-1] != 32) & ((x[:-2] != 32) | (x[2:] != 32))]  # a letter in the middle, another beside it
        total += np.bincount((g * np.uint32(2654435761)) >> np.uint32(19), minlength=CELLS)
    return total


class Mixture:
    """Log likelihoods of cells by language, and the inference over them."""

    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = 0.5, penalty: float = 4.0, rounds: int = 12):
        self.languages, self.penalty, self.rounds = languages, penalty, rounds
        p = (counts + smoothing) / (counts.sum(1, keepdims=True) + smoothing * CELLS)
        self.p = np.ascontiguousarray(p.T)  # cells x languages
        self.log = np.log(self.p)

    def proportions(self, cells: np.ndarray, count: np.ndarray, among: list[int]) -> tuple[np.ndarray, float]:
        """Proportions of the languages, and the log likelihood."""
        p = self.p[np.ix_(cells, among)]
        share = np.full(len(among), 1 / len(among))
        n = count.sum()
        for _ in range(self.rounds):
            joint = p * share
            new = (joint * (count / joint.sum(1))[:, None]).sum(0) / n
            done = np.abs(new - share).max() < 1e-3
            share = new
            if done:
                break
        return share, float((count * np.log((p * share).sum(1))).sum())

    def infer(self, total: np.ndarray) -> tuple[int, float]:
        """The leading language and its proportion."""
        cells = np.flatnonzero(total)
        if not len(cells):
            return 0, 1.0 / len(self.languages)
        count = total[cells].astype(np.float64)
        alone = (self.log[cells] * count[:, None]).sum(0)
        chosen = [int(alone.argmax())]
        share, best = np.ones(1), float(alone.max())
        cost = self.penalty * np.log(count.sum() + 1)
        while len(chosen) < len(self.languages):
            # The language that explains most of what the set explains badly.
            gain = (np.maximum(self.log[cells] - self.log[np.ix_(cells, chosen)].max(1)[:, None], 0) * count[:, None]).sum(0)
            gain[chosen] = -1
            nxt = int(gain.argmax())
            if gain[nxt] <= cost:
                break
            trial, likelihood = self.proportions(cells, count, [*chosen, nxt])
            if likelihood - best <= cost:
                break
            chosen, share, best = [*chosen, nxt], trial, likelihood
        lead = int(share.argmax())
        return chosen[lead], float(share[lead])

    def predict(self, col: pa.Array, has_text: np.ndarray) -> tuple[list[str], list[float]]:
        data, offsets = W.buffers(col)
        labels, scores = [], []
        for i in range(len(col)):
            piece = data[offsets[i] : offsets[i + 1]]
            if not has_text[i] or not self.languages or not _has_letter(piece):
                labels.append("und")
                scores.append(0.0)
                continue
            k, share = self.infer(trigram_counts(piece))
            labels.append(self.languages[k])
            scores.append(min(1.0, max(0.0, share)))
        return labels, scores


def _has_letter(piece: np.ndarray) -> bool:
    low = piece | 32
    if ((low >= 97) & (low <= 122)).any():
        return True
    return bool((piece >= 128).any()) and any(c.isalpha() for c in piece.tobytes().decode("utf-8"))


def fit_mixture(df: DataFrame, lang_col: str = "lang", held_modulus: int = 4, held_value: int = 2) -> Mixture:
    """Counts over all rows with a language outside the held-out split; each task sends one vector per language.

    The model has 128 KB for each value of lang_col, of which it takes any number that fits the driver.
    """
    rows = df.where(F.col(f"`{lang_col}`").isNotNull() & (F.coalesce(id_bucket(F.col("doc_id"), held_modulus), F.lit(held_value)) != held_value))

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            col = texts(batch)
            data, offsets = W.buffers(col)
            for i, lang in enumerate(batch.column(batch.schema.get_field_index("lang")).to_pylist()):
                total.setdefault(lang, np.zeros(CELLS, np.int64))
                total[lang] += trigram_counts(data[offsets[i] : offsets[i + 1]])
        for lang, vector in sorted(total.items()):
            cells = np.flatnonzero(vector)
            cells = cells if len(cells) else np.array([0])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells)), pa.array(cells, pa.int64()), pa.array(vector[cells], pa.int64())], ["lang", "cell", "n"])

    ship_package(df.sparkSession)
    found = narrow(rows, text="text", lang=lang_col).mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = stored(found, "trigrams")
    known = sorted(r["lang"] for r in found.select("lang").distinct().collect())
    counts = np.zeros((len(known), CELLS))
    place = {lang: k for k, lang in enumerate(known)}
    groups = -(-len(known) // LANGUAGES_AT_ONCE)
    for g in range(groups):  # about LANGUAGES_AT_ONCE * CELLS rows each
        own = (found if groups == 1 else found.where(F.pmod(F.xxhash64("lang"), F.lit(groups)) == g)).toArrow()
        lang = np.array([place[v] for v in own.column("lang").to_pylist()], np.int64)
        counts[lang, own.column("cell").to_numpy()] = own.column("n").to_numpy()
    forget(found)
    return Mixture(known, counts)


def languages(df: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of df.

    Texts that are null or without a letter are `und` with score 0; so are all where no language
    could be learned. Ties go to the language first in order. An empty df gives an empty result; repeated rows,
    and rows whose id is null or repeated, are each predicted. Very long texts are counted whole, in pieces.
    Other columns are ignored, whatever their names.
    """
    model = fit_mixture(df)

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(batch.schema.get_field_index("text"))
        labels, scores = model.predict(texts(batch), raw.is_valid().to_numpy(zero_copy_only=False))
        return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(labels), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return map_arrow(narrow(df, doc_id="doc_id", text="text"), predict, "doc_id long, lang_pred string, score double").select(
        "doc_id", (F.coalesce(id_bucket(F.col("doc_id"), 4), F.lit(0)) == 2).alias("held_out"), "lang_pred", "score"
    )
