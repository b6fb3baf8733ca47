"""Language-model scores by stupid backoff, computed relationally over the whole corpus.

Tokens are white-space words with A-Z lower-cased. With N tokens in all rows, c(w) and c(v w) the
corpus counts, a token w after v scores

    log(c(v w) / c(v))          if c(v w) >= least,
    log(0.4 * c(w) / N)         otherwise, and
    log(c(w) / N)               at the start of a document,

and a document's score is the sum: every token's backed-off score, plus for each pair that is in the
model what it is better by. The corpus is scored by its own counts, so the one occurrence that is being
scored is no evidence for itself: least is 2. With least 1 no pair would ever back off.

Every occurrence of every pair travels once, to the partition that counts it:

* Two words of the commonest (a bounded number, whose counts are broadcast) go by the hash of the pair.
* Any other word goes by its own hash, with its neighbours if they are common; its count is made there.
* Two words that aren't common are a small rest, counted and joined as rows.

A pair of two very frequent words is counted ahead and scored where it is read, so that no partition
can be dominated by one pair. Each partition builds its share of the count tables, joins it to the
occurrences it was built from, and sends sums per document back, packed by groups of consecutive rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import wordhash as W
from barloom.llm.common import narrow, stored, texts
from barloom.session import ship_package

BACKOFF = 0.4
#: A pair of words is in the model from this count on.
LEAST_PAIR = 2
#: Common words whose counts are broadcast, at most (16 bytes each); a place among them has so many bits.
TOP_BITS = 20
#: A word is very frequent from this share of all tokens on, so there are at most so many.
FREQUENT = 1000
#: Tokens that a task gathers before it sends them on, and pairs in a partition, about.
GATHER, PAIRS_AT_ONCE = 1_000_000, 1_000_000
#: Rows of a group, at most: their numbers within it have 16 bits.
GROUP_ROWS = 1 << 16


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def _pack(*columns: np.ndarray) -> bytes:
    return pa.Codec("zstd").compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns), asbytes=True)


def _unpack(raw: bytes, *columns: tuple[type, int]) -> list[np.ndarray]:
    sizes = [np.dtype(t).itemsize * n for t, n in columns]
    data = pa.Codec("zstd").decompress(raw, decompressed_size=sum(sizes), asbytes=True)
    ends = np.cumsum([0, *sizes])
    return [np.frombuffer(data, t, n, int(at)) for (t, n), at in zip(columns, ends[:-1], strict=True)]


def word_counts(docs: DataFrame) -> DataFrame:
    """h (word hash), n over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return _batch(["h", "n"], h.view(np.int64), n)

        for batch in batches:
            for _, _, h, _ in W.word_hashes(texts(batch), W.SPACES):
                held.append(h)
                size += len(h)
                if size >= GATHER:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    ship_package(docs.sparkSession)
    return docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


class Words:
    """Words by hash, in order, and their counts."""

    def __init__(self, h: np.ndarray, n: np.ndarray):
        order = np.argsort(h)
        self.h, self.n = h[order], n[order]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each word, -1 if it isn't here."""
        if not len(self.h) or not len(h):
            return np.full(len(h), -1)
        one, at = np.unique(h, return_inverse=True)
        k = np.minimum(np.searchsorted(self.h, one), len(self.h) - 1)
        return np.where(self.h[k] == one, k, -1)[at]


def common_words(counts: DataFrame, most: int) -> Words:
    """The commonest words, at most so many: all from some count on. The driver sees a histogram of logarithms, and them."""
    level = F.floor(F.log2("n") * 16)
    left, least = most, None
    for row in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("level")).collect():  # under 1,024 rows
        if row["words"] > left:
            break
        left, least = left - row["words"], row["level"]
    t = counts.where(F.lit(False) if least is None else level >= least).toArrow()
    return Words(t.column("h").to_numpy().view(np.uint64), t.column("n").to_numpy())


def frequent_pairs(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """pair (places in frequent), n: corpus counts of pairs of very frequent words."""
    words = Words(frequent, np.ones(len(frequent)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words.h) ** 2, np.int64)
        for batch in batches:
            for _, _, h, at in W.word_hashes(texts(batch), W.SPACES):
                k = words.find(h)
                both = (k[1:] >= 0) & (k[:-1] >= 0) & ~_starts(at, len(h))[1:]
                total += np.bincount(k[:-1][both] * len(words.h) + k[1:][both], minlength=len(total))
        cell = np.flatnonzero(total)
        if len(cell):
            yield _batch(["pair", "n"], cell, total[cell])

    return docs.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _starts(at: np.ndarray, n: int) -> np.ndarray:
    """Whether each word starts its row."""
    first = np.zeros(n + 1, bool)
    first[at] = True
    return first[:n]


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """Groups of consecutive rows: number of the first, ids, word hashes, and each row's offset among them."""
    base, ids, words, counts, rows, size = 0, [], [], [], 0, 0

    def made() -> tuple[int, pa.Array, np.ndarray, np.ndarray]:
        return base, pa.concat_arrays(ids), np.concatenate(words), np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    for batch in batches:
        number = batch.column(batch.schema.get_field_index("row_no")).to_numpy()
        own = batch.column(batch.schema.get_field_index("doc_id"))
        for lo, hi, h, at in W.word_hashes(texts(batch), W.SPACES):
            for a in range(0, hi - lo, GROUP_ROWS):
                b = min(hi - lo, a + GROUP_ROWS)
                if rows and (rows + b - a > GROUP_ROWS or size >= GATHER or number[lo + a] != base + rows):
                    yield made()
                    ids, words, counts, rows, size = [], [], [], 0, 0
                base = base if rows else int(number[lo + a])
                ids.append(own.slice(lo + a, b - a))
                words.append(h[at[a] : at[b]])
                counts.append(np.diff(at[a : b + 1]))
                rows, size = rows + b - a, size + int(at[b] - at[a])
    if rows:
        yield made()


class Model:
    """What every task gets: common words, pairs of very frequent ones, and the number of tokens."""

    def __init__(self, top: Words, total: int, pair_n: np.ndarray, least: int):
        self.top, self.pair_n, self.least = top, pair_n, least
        self.log_n, self.log_back = float(np.log(max(total, 1))), float(np.log(BACKOFF))
        self.log = np.log(np.maximum(top.n, 1).astype(np.float64))
        often = top.n * FREQUENT >= total
        self.rank = np.where(often, np.cumsum(often) - 1, -1)

    def better(self, c: np.ndarray, log_v: np.ndarray, log_w: np.ndarray) -> np.ndarray:
        """What pairs that occur c times add to the backed-off score."""
        return np.where(c >= self.least, np.log(np.maximum(c, 1)) - log_v - log_w + self.log_n - self.log_back, 0.0)


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(key, return_inverse=True, return_counts=True)


def explode(model: Model, n_parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group and part: packed occurrences. And per group (kind 0): row, id, tokens and what is known of the score."""
    top, bits = model.top, np.int64(TOP_BITS)
    for base, ids, h, at in groups(batches):
        rows, n = len(at) - 1, len(h)
        row = np.repeat(np.arange(rows), np.diff(at))
        first = _starts(at, n)
        k = top.find(h)
        common = k >= 0
        score = np.where(common, model.log[k] - model.log_n if len(top.h) else 0.0, 0.0) + np.where(first, 0.0, model.log_back)
        both = np.zeros(n, bool)
        both[1:] = common[1:] & common[:-1] & ~first[1:]
        at_w = np.flatnonzero(both)
        v, w = k[at_w - 1], k[at_w]
        ahead = (model.rank[v] >= 0) & (model.rank[w] >= 0) if len(top.h) else np.zeros(0, bool)
        a, b = v[ahead], w[ahead]
        score[at_w[ahead]] += model.better(model.pair_n[model.rank[a], model.rank[b]], model.log[a], model.log[b]) if len(a) else 0.0
        key = (v[~ahead] << bits) | w[~ahead]
        part = (W.mix(key.view(np.uint64)) % np.uint64(n_parts)).astype(np.int64)
        order = np.argsort((part << np.int64(2 * TOP_BITS)) | key)
        key, part, key_row = key[order], part[order], row[at_w[~ahead]][order].astype(np.uint16)

        rare = np.flatnonzero(~common)
        beside = np.concatenate([[-1], k, [-1]])
        begins = np.concatenate([first, [True]])
        before = np.where(begins[rare], -1, beside[rare]) + 1
        after = np.where(begins[rare + 1], -1, beside[rare + 2]) + 1
        rare_part = (W.mix(h[rare]) % np.uint64(n_parts)).astype(np.int64)
        order = np.argsort(rare_part, kind="stable")
        rare, before, after, rare_part = rare[order], before[order].astype(np.uint32), after[order].astype(np.uint32), rare_part[order]

        told = [pa.array([base] * rows), ids, pa.array(np.diff(at)), pa.array(np.bincount(row, score, rows).astype(np.float64))]
        facts = pa.StructArray.from_arrays([pa.array(np.arange(rows, dtype=np.int32)), *told[1:]], ["row", "doc_id", "n_tokens", "score"])
        parts = np.union1d(part, rare_part)
        i, j = np.searchsorted(part, parts, "left"), np.searchsorted(part, parts, "right")
        x, y = np.searchsorted(rare_part, parts, "left"), np.searchsorted(rare_part, parts, "right")
        bodies, heads = [], []
        for q in range(len(parts)):
            own, r = slice(i[q], j[q]), slice(x[q], y[q])
            step = np.diff(key[own], prepend=0).view(np.uint8).reshape(-1, 8)[:, : 2 * TOP_BITS // 8]
            heads.append((int(j[q] - i[q]), int(y[q] - x[q])))
            bodies.append(_pack(step.T, key_row[own], h[rare[r]], before[r], after[r], row[rare[r]].astype(np.uint16)))
        # What is told of rows goes by the group as well: it needn't be counted.
        yield _batch(
            ["part", "base", "n_pairs", "n_rare", "body", "facts"],
            pa.array([base % n_parts, *parts.tolist()], pa.int32()),
            pa.array([base] * (1 + len(parts)), pa.int64()),
            pa.array([0, *(p for p, _ in heads)], pa.int32()),
            pa.array([0, *(p for _, p in heads)], pa.int32()),
            pa.array([None, *bodies], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0] + [rows] * (1 + len(parts)), pa.int32()), facts),
        )


_SENT = "part int, base long, n_pairs int, n_rare int, body binary, facts array<struct<row int, doc_id long, n_tokens long, score double>>"
_BACK = "base long, n int, body binary, facts array<struct<row int, doc_id long, n_tokens long, score double>>"


def count_and_join(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A part's share of the count tables, joined to the occurrences it was built from and summed per row."""
    bases, steps, key_row, rare, before, after, rare_row = [], [], [], [], [], [], []
    for batch in batches:
        told = batch.filter(batch.column(4).is_null())
        if told.num_rows:
            yield _batch(["base", "n", "body", "facts"], told.column(1), pa.array([0] * told.num_rows, pa.int32()), pa.array([None] * told.num_rows, pa.binary()), told.column(5))
        rows = batch.filter(batch.column(4).is_valid())
        for base, n, r, raw in zip(*(rows.column(c).to_pylist() for c in (1, 2, 3, 4)), strict=True):
            width = 2 * TOP_BITS // 8
            planes, own_row, h, p, q, r_row = _unpack(raw, (np.uint8, width * n), (np.uint16, n), (np.uint64, r), (np.uint32, r), (np.uint32, r), (np.uint16, r))
            step = np.zeros((n, 8), np.uint8)
            step[:, :width] = planes.reshape(width, n).T
            at = np.int64(len(bases)) << np.int64(16)
            steps.append(np.cumsum(step.view(np.int64).reshape(-1)))
            key_row.append(at | own_row)
            rare.append(h)
            before.append(p)
            after.append(q)
            rare_row.append(at | r_row)
            bases.append(base)
    if not bases:
        return
    log = model.log
    key, at, c = _counted(np.concatenate(steps))
    value = model.better(c, log[key >> TOP_BITS], log[key & ((1 << TOP_BITS) - 1)])[at] if len(key) else np.zeros(0)
    place = np.concatenate(key_row)
    place, value = [place[value != 0]], [value[value != 0]]
    if sum(map(len, rare)):
        word, at, c = _counted(np.concatenate(rare))
        own = np.log(c)
        place.append(np.concatenate(rare_row))
        total = own[at] - model.log_n
        sides = [np.concatenate(side).astype(np.int64) for side in (before, after)]
        keys = [(at << np.int64(TOP_BITS + 2)) | (np.int64(s) << np.int64(TOP_BITS + 1)) | side for s, side in enumerate(sides)]  # side is a place + 1
        key, pair_at, c = _counted(np.concatenate(keys))
        beside = key & ((1 << (TOP_BITS + 1)) - 1)
        gain = np.where(beside > 0, model.better(c, log[np.maximum(beside - 1, 0)] if len(log) else 0.0, own[key >> (TOP_BITS + 2)]), 0.0)[pair_at]
        value.append(total + gain[: len(at)] + gain[len(at) :])
    row, at = np.unique(np.concatenate(place), return_inverse=True)
    score = np.bincount(at, np.concatenate(value), len(row))
    ends = np.searchsorted(row, np.arange(len(bases) + 1) << 16)
    made = [(b, x, y) for b, x, y in zip(bases, ends[:-1], ends[1:], strict=True) if y > x]
    if made:
        yield _batch(
            ["base", "n", "body", "facts"],
            pa.array([b for b, _, _ in made], pa.int64()),
            pa.array([int(y - x) for _, x, y in made], pa.int32()),
            pa.array([_pack((row[x:y] & 0xFFFF).astype(np.uint16), score[x:y]) for _, x, y in made], pa.binary()),
            pa.array([None] * len(made), pa.list_(pa.struct([("row", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())]))),
        )


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row_no, doc_id, n_tokens, score of the rows of some groups."""
    sums: dict[int, np.ndarray] = {}
    facts: dict[int, pa.StructArray] = {}
    for batch in batches:
        told = batch.column(3)
        for i, (base, n, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2)), strict=True)):
            if raw is None:
                facts[base] = told[i].values
                continue
            row, score = _unpack(raw, (np.uint16, n), (np.float64, n))
            own = sums.setdefault(base, np.zeros(int(row[-1]) + 1))
            if len(own) <= row[-1]:
                own = sums[base] = np.pad(own, (0, int(row[-1]) + 1 - len(own)))
            own[row] += score
    for base, told in facts.items():
        row, ids, tokens, score = told.flatten()
        score = score.to_numpy().copy()
        own = sums.pop(base, np.zeros(0))
        score[: len(own)] += own
        yield _batch(["row_no", "doc_id", "n_tokens", "score"], base + row.to_numpy().astype(np.int64), ids, tokens, score)


def rare_pairs(top: Words, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """v, w (hashes), row_no of each pair of words that aren't common."""
    for base, _, h, at in groups(batches):
        rare = top.find(h) < 0
        both = np.flatnonzero(rare[1:] & rare[:-1] & ~_starts(at, len(h))[1:]) + 1
        row = np.searchsorted(at, both, "right") - 1
        if len(both):
            yield _batch(["v", "w", "row_no"], h[both - 1].view(np.int64), h[both].view(np.int64), base + row)


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_PAIR, top_words: int = 1 << TOP_BITS, steady: bool = False) -> DataFrame:
    """One row per row of df: doc_id, n_tokens, score (sum of log scores), mean_score.

    Null and empty texts have no tokens, score 0 and a null mean. Repeated rows count as often as
    they occur, and each has its own result; ids may repeat or be null. Very long texts are hashed in
    pieces. Other columns are ignored, whatever their names; an empty table gives an empty result.
    steady: df has the same rows in the same order whenever a partition is read again, as plain
    scans of files do; other tables are written once, so that row numbers survive a repeated task.
    """
    spark = df.sparkSession
    docs = narrow(df, doc_id=id_col, text=text_col)
    numbered = docs.withColumn("row_no", F.monotonically_increasing_id())
    if not steady:
        numbered = stored(numbered, "numbered")
        docs = numbered.select("doc_id", "text")
    counts = stored(word_counts(docs), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = common_words(counts, min(top_words, 1 << TOP_BITS))
    often = top.h[top.n * FREQUENT >= total]
    pair_n = np.zeros((len(often), len(often)), np.int64)
    if len(often):
        t = frequent_pairs(docs, often).toArrow()  # at most FREQUENT squared
        pair_n.reshape(-1)[t.column("pair").to_numpy()] = t.column("n").to_numpy()
    shared = spark.sparkContext.broadcast(Model(top, total, pair_n, least))
    n_parts = int(max(1, -(-total // PAIRS_AT_ONCE)))

    sent = numbered.mapInArrow(lambda batches: explode(shared.value, n_parts, batches), _SENT)
    back = sent.repartitionById(n_parts, F.col("part")).mapInArrow(lambda batches: count_and_join(shared.value, batches), _BACK)
    rows = back.repartition(n_parts, "base").mapInArrow(add_up, "row_no long, doc_id long, n_tokens long, score double")
    if distinct > len(top.h):
        rest = stored(numbered.mapInArrow(lambda batches: rare_pairs(shared.value.top, batches), "v long, w long, row_no long"), "rare_pairs")
        n_of = lambda c: counts.select(F.col("h").alias(c), F.col("n").alias(f"n_{c}"))
        pairs = rest.groupBy("v", "w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).join(n_of("v"), "v").join(n_of("w"), "w")
        gain = F.log("n") - F.log("n_v") - F.log("n_w") + F.lit(float(np.log(max(total, 1)) - np.log(BACKOFF)))
        more = rest.join(pairs.select("v", "w", gain.alias("gain")), ["v", "w"]).groupBy("row_no").agg(F.sum("gain").alias("more"))
        rows = rows.join(more, "row_no", "left").withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0)))
    return rows.select("doc_id", "n_tokens", F.round("score", 6).alias("score"), F.round(F.col("score") / F.when(F.col("n_tokens") > 0, F.col("n_tokens")), 6).alias("mean_score"))
