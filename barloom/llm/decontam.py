"""Benchmark decontamination by greedy string tiling.

Tokens are words without punctuation and case. Seeds, runs of a few tokens that a benchmark item
shares with a document, pair the two up; greedy string tiling (running Karp-Rabin) then marks the
longest common runs that don't overlap, longest first, so reordered passages still add up. An item
leaks when its tiles cover enough of its tokens. The benchmark is taken in blocks of bounded size,
each against all documents, so it may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import wordhash as W
from barloom.llm.common import map_arrow, narrow

WORDS = W.SPACES + W.PUNCTUATION
#: Characters of benchmark text in a block: what one broadcast holds.
BLOCK_CHARS = 16_000_000
#: Places of seeds in items that are looked at at once, about.
PLACES_AT_ONCE = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


def windows(tokens: np.ndarray, starts: np.ndarray, size: int, prefix: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of the windows of size tokens at starts, from running sums."""
    return prefix[starts + size] - prefix[starts] * power[size]


def running(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """prefix[i] is the hash of the first i tokens; power[k] the base to the k."""
    n = len(tokens)
    power = np.full(n + 1, _BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    back = np.full(n + 1, inverse)
    back[0] = 1
    back = np.multiply.accumulate(back)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * back[1:])])
    return total * power, power


def free_starts(marked: np.ndarray, size: int) -> np.ndarray:
    """Where size unmarked tokens begin."""
    n = len(marked) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(total[size:] == total[:-size])


def covered(hit: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n tokens lie in one of the windows of size tokens that are hit."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return np.cumsum(edge[:-1]) > 0


def _shared(item: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either lie in a window of `least` tokens that both have: no tile lies elsewhere."""
    out = []
    every = [np.arange(max(0, len(x) - least + 1)) for x in (item, text)]
    h = [windows(x, at, least, *running(x)) if len(at) else np.zeros(0, np.uint64) for x, at in zip((item, text), every, strict=True)]
    for k, x in enumerate((item, text)):
        out.append(covered(np.flatnonzero(np.isin(h[k], h[1 - k])), least, len(x)))
    return out[0], out[1]


def tile(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in text, length) of at least `least` tokens, longest first; ties go to the earliest.

    In each round the longest length at which unmarked windows of both meet is found by bisection, and all tiles of
    that length are marked; so there are no more rounds than tiles of different lengths. A round takes time and memory
    in proportion to the tokens that lie in shared windows, however often a token is repeated.
    """
    tiles: list[tuple[int, int, int]] = []
    in_both, of_text = _shared(item, text, least)
    places = np.flatnonzero(of_text)
    if not len(places):
        return tiles
    # Text that shares nothing is left out; a marked place between its parts keeps windows from reaching over.
    new = np.flatnonzero(np.diff(places) > 1) + 1
    short = np.insert(text[places], new, np.uint64(0))
    origin = np.insert(places, new, -1)
    in_item, in_text = (~in_both).astype(np.int64), (origin < 0).astype(np.int64)
    prefix_a, power_a = running(item)
    prefix_b, power_b = running(short)

    def met(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Unmarked windows of the item that the text has, and of the text, with their hashes."""
        a, b = free_starts(in_item, size), free_starts(in_text, size)
        ha, hb = windows(item, a, size, prefix_a, power_a), windows(short, b, size, prefix_b, power_b)
        own = np.isin(ha, hb)
        return a[own], ha[own], b, hb

    most = min(len(item), len(short))
    while most >= least:
        low, high, here = least - 1, most, met(most)
        if len(here[0]):
            low = most
        else:
            high -= 1
        while low < high:
            size = (low + high + 1) // 2
            got = met(size)
            if len(got[0]):
                low, here = size, got
            else:
                high = size - 1
        if low < least:
            break
        a, ha, b, hb = here
        order = np.argsort(hb, kind="stable")
        b, hb = b[order], hb[order]
        lo, hi = np.searchsorted(hb, ha, "left"), np.searchsorted(hb, ha, "right")
        next_of: dict[int, int] = {}  # by hash: what of the list has been tried
        for p, x, end in zip(a.tolist(), lo.tolist(), hi.tolist(), strict=True):
            if in_item[p : p + low].any():
                continue
            at = next_of.get(x, x)
            while at < end:
                q = int(b[at])
                at += 1
                if not in_text[q : q + low].any() and (item[p : p + low] == short[q : q + low]).all():
                    in_item[p : p + low] = 1
                    in_text[q : q + low] = 1
                    tiles.append((p, int(origin[q]), low))
                    break
            next_of[x] = at
        most = low - 1
    return tiles


class Index:
    """A block of the benchmark: token hashes of its items, and sorted seeds with the item of each."""

    def __init__(self, items: list[tuple[int, str]], seed: int):
        self.seed = seed
        self.ids, self.tokens, seeds, owner = [], [], [], []
        col = pa.array([t for _, t in items], pa.string())
        for lo, hi, h, at in W.word_hashes(col, WORDS):
            for i in range(lo, hi):
                own = h[at[i - lo] : at[i - lo + 1]]
                if not len(own):
                    continue
                size = min(seed, len(own))
                g, _ = W.grams(own, np.array([0, len(own)]), size)
                self.ids.append(items[i][0])
                self.tokens.append(own)
                seeds.append(g)
                owner.append(np.full(len(g), len(self.ids) - 1) * 64 + size)
        self.sizes = sorted({int(x) for o in owner for x in o % 64})
        seeds, owner = (np.concatenate(seeds), np.concatenate(owner)) if seeds else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.lexsort((owner, seeds))
        self.seeds, self.owner = seeds[order], owner[order]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.filter = np.zeros(1 << 22, bool)
        self.filter[self.seeds >> np.uint64(42)] = True

    def candidates(self, h: np.ndarray, at: np.ndarray, cover: float) -> np.ndarray:
        """Pairs (row, item) whose shared seeds could cover enough of the item, from the token hashes of some rows."""
        pairs = []
        for size in self.sizes:
            g, g_at = W.grams(h, at, size)
            hit = np.flatnonzero(self.filter[g >> np.uint64(42)])
            lo, hi = np.searchsorted(self.seeds, g[hit], "left"), np.searchsorted(self.seeds, g[hit], "right")
            hit, lo, hi = hit[hi > lo], lo[hi > lo], hi[hi > lo]
            if not len(hit):
                continue
            row = np.searchsorted(g_at, hit, "right") - 1
            row, lo, hi = np.unique(np.column_stack([row, lo, hi]), axis=0).T
            ends = np.cumsum(hi - lo)
            keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            a = 0
            while a < len(row):  # so many places of seeds in items at once
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PLACES_AT_ONCE, "right")))
                n = hi[a:b] - lo[a:b]
                place = np.repeat(lo[a:b] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                own = self.owner[place]
                key = (np.repeat(row[a:b], n) * len(self.ids) + own // 64)[own % 64 == size]
                keys, back = np.unique(np.concatenate([keys, key]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([counts, np.ones(len(key), np.int64)]), len(keys)).astype(np.int64)
                a = b
            item = keys % len(self.ids)
            enough = counts * size >= np.where(self.lengths[item] >= self.seed, cover, 1) * self.lengths[item]
            pairs.append(np.column_stack([keys // len(self.ids), item])[enough])
        return np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)


def benchmark_blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about most characters, one block in the driver at a time."""
    block, size = [], 0
    for row in narrow(items, item_id=id_col, text=text_col).where("text IS NOT NULL").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    seed: int = 5,
    cover: float = 0.5,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item that leaks into it: doc_id, item_id, coverage, n_tiles, longest_tile.

    Items with fewer tokens than a seed must occur whole. Null and empty texts and items match
    nothing; repeated rows give repeated results; an empty table gives an empty result. Of tiles of one
    length the first in the item, then the first in the text is marked. Very long texts are compared
    whole, in time and memory in proportion to their length, whatever repeats in them. Other columns are
    ignored, whatever their names.
    """
    spark = df.sparkSession
    schema = "doc_id long, item_id long, coverage double, n_tiles int, longest_tile int"
    docs = narrow(df, doc_id=id_col, text=text_col)
    out = None
    for block in benchmark_blocks(benchmark, item_id_col, item_text_col, block_chars):
        index = spark.sparkContext.broadcast(Index(block, seed))

        def find(batch: pa.RecordBatch, index=index) -> pa.RecordBatch:
            from barloom.llm.common import texts

            ids = batch.column(batch.schema.get_field_index("doc_id"))
            rows: list[tuple] = []
            own = index.value
            for lo, _, h, at in W.word_hashes(texts(batch), WORDS):
                for r, i in own.candidates(h, at, cover).tolist():
                    item = own.tokens[i]
                    tiles = tile(item, h[at[r] : at[r + 1]], min(seed, len(item)))
                    covered = sum(k for _, _, k in tiles) / len(item)
                    if covered >= (cover if len(item) >= seed else 1):
                        rows.append((ids[lo + r].as_py(), own.ids[i], covered, len(tiles), max(k for _, _, k in tiles)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["doc_id", "item_id", "coverage", "n_tiles", "longest_tile"])

        found = map_arrow(docs, find, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def clean_rows(df: DataFrame, benchmark: DataFrame, seed: int = 5, cover: float = 0.5, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of df into which no item leaks, with all their columns. Edge cases are as in leaks."""
    out = df
    for block in benchmark_blocks(benchmark, "item_id", "text", block_chars):
        index = df.sparkSession.sparkContext.broadcast(Index(block, seed))

        def keep(batch: pa.RecordBatch, index=index) -> pa.RecordBatch:
            from barloom.llm.common import texts

            own, good = index.value, np.ones(batch.num_rows, bool)
            for lo, _, h, at in W.word_hashes(texts(batch), WORDS):
                for r, i in own.candidates(h, at, cover).tolist():
                    item = own.tokens[i]
                    if good[lo + r] and sum(k for _, _, k in tile(item, h[at[r] : at[r + 1]], min(seed, len(item)))) >= (cover if len(item) >= seed else 1) * len(item):
                        good[lo + r] = False
            return batch.filter(pa.array(good))

        out = map_arrow(out, keep, df.schema)
    return out
