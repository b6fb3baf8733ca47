"""Packing documents into sequences by cutting-stock column generation.

Each document is cut into whole sequences and a rest. The rests' length histogram (one number per
class of lengths, so bounded) goes to the driver: a linear program over patterns of lengths, solved by
revised simplex, whose columns a knapsack dynamic program prices. Rounded patterns become ranges of
ranks: a rest of class c and rank k among its class finds its sequence and slot by arithmetic, so
the documents themselves are never gathered. What rounding leaves over is cut into powers of two,
which lie side by side without gaps and end in sequences that need no padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.llm import tokens
from barloom.llm.common import map_arrow, narrow, stored, texts

#: Rests of one length and salt that are ranked together, about: at least so many, and so many groups a partition.
RANKED_AT_ONCE, GROUPS_A_PARTITION = 250, 8


def price_column(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits: unbounded knapsack. Its value, and how often each size occurs."""
    best = np.zeros(room + 1)
    used = np.full(room + 1, -1)
    for c in range(1, room + 1):
        fit = np.searchsorted(sizes, c, "right")
        best[c] = best[c - 1]
        if fit:
            v = value[:fit] + best[c - sizes[:fit]]
            k = int(v.argmax())
            if v[k] > best[c] + 1e-12:
                best[c], used[c] = v[k], k
    column = np.zeros(len(sizes))
    c = room
    while c > 0:
        if used[c] < 0:
            c -= 1
        else:
            column[used[c]] += 1
            c -= int(sizes[used[c]])
    return float(best[room]), column


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = 1e-3, most: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per row) and how often each is used, fractionally, to cover the demand.

    Minimises the number of sequences. Ends when no column improves, when the number is within gap
    of the total length over room, or after `most` columns; it is a feasible cover at any time.
    The matrices are small: einsum keeps them off the BLAS threads of the driver.
    """
    m = len(sizes)
    basis = np.diag(np.floor(room / sizes))  # columns are patterns
    inverse = np.diag(1 / np.diag(basis))
    x = np.einsum("ij,j->i", inverse, demand)
    least = float((sizes * demand).sum()) / room
    for step in range(most):
        if x.sum() <= least * (1 + gap):
            break
        worth = inverse.sum(0)  # duals: each pattern costs one sequence
        total, column = price_column(np.maximum(worth, 0), sizes, room)
        if total <= 1 + 1e-9:
            break
        d = np.einsum("ij,j->i", inverse, column)
        ratio = np.full(m, np.inf)
        ratio[d > 1e-9] = x[d > 1e-9] / d[d > 1e-9]
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        row = inverse[out] / d[out]
        inverse -= np.outer(d, row)
        inverse[out] = row
        if step % 200 == 199:  # a Newton step takes the rounding errors out
            inverse += np.einsum("ij,jk->ik", inverse, np.eye(m) - np.einsum("ij,jk->ik", basis, inverse))
            x = np.maximum(np.einsum("ij,j->i", inverse, demand), 0)
        else:
            x = np.maximum(x - ratio[out] * d, 0)
            x[out] = ratio[out]
    return basis.T.astype(np.int64), x


def round_patterns(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns that fill a sequence exactly, within the demand: ({size: times}, sequences).

    The linear program's patterns come first, rounded down and then up while demand is left; then
    pairs and triples that fill a sequence.
    """
    left = demand.astype(np.int64).copy()
    unit = int(np.gcd.reduce(np.append(sizes, room))) if len(sizes) else 1
    plan: list[tuple[dict[int, int], int]] = []

    def take(need: np.ndarray, times: int) -> None:
        nonlocal left
        left = left - need * times
        plan.append(({int(sizes[k]): int(need[k]) for k in np.flatnonzero(need)}, int(times)))

    if len(sizes):
        patterns, x = solve_patterns(sizes // unit, demand.astype(np.float64), room // unit)
        exact = (patterns * sizes).sum(1) == room
        for up in (0, 1):
            for k in np.argsort(-x, kind="stable"):
                if exact[k] and x[k] > 1e-6:
                    need = patterns[k]
                    has = need > 0
                    times = min(int(np.floor(x[k] + 1e-9)) if not up else 1, int((left[has] // need[has]).min()))
                    if times > 0:
                        take(need, times)
    at = np.zeros(room + 1, np.int64)
    at[sizes] = left
    where = {int(s): k for k, s in enumerate(sizes)}
    for a in sizes[::-1].tolist():
        while at[a]:
            at[a] -= 1
            found = None
            if room > a and at[room - a]:
                found = [a, room - a]
            else:
                b = np.flatnonzero(at[: room - a])
                b = b[(b > 0) & (at[room - a - b] > (2 * b == room - a))]
                if len(b):
                    found = [a, int(b[-1]), room - a - int(b[-1])]
            at[a] += 1
            if not found:
                break
            need = np.zeros(len(sizes), np.int64)
            for s in found:
                need[where[s]] += 1
            if (need > at[sizes]).any():
                break
            at[sizes] -= need
            plan.append(({s: found.count(s) for s in found}, 1))
    return plan


def rank_ranges(plan: list[tuple[dict[int, int], int]], demand: dict[int, int]) -> tuple[pd.DataFrame, dict[int, int], int]:
    """Ranges of ranks (from 0) by class: klass, lo, hi, base (first sequence), times (in each), slot (of the first).

    And how many rests of each class they take, and the number of sequences.
    """
    used = dict.fromkeys(demand, 0)
    ranges, base = [], 0
    for pattern, sequences in plan:
        slot = 0
        for klass in sorted(pattern, reverse=True):
            times = pattern[klass]
            ranges.append((klass, used[klass], used[klass] + times * sequences, base, times, slot))
            used[klass] += times * sequences
            slot += times
        base += sequences
    return pd.DataFrame(ranges, columns=["klass", "lo", "hi", "base", "times", "slot"], dtype="int64"), used, base


def tape_places(demand: dict[int, int], room: int) -> tuple[pd.DataFrame, int]:
    """Where the powers of two of cut rests lie on one tape, largest first, and the tape's length.

    size, part (the power of two), shift (its start in the rest), nth_part, tape (place of the first).
    """
    parts, tape = [], 0
    bit = room // 2
    while bit:
        for size in sorted(demand):
            if size & bit:
                before = size & ~(2 * bit - 1)
                parts.append((size, bit, before, before.bit_count() + 1, tape))
                tape += bit * demand[size]
        bit //= 2
    return pd.DataFrame(parts, columns=["size", "part", "shift", "nth_part", "tape"], dtype="int64"), tape


def ranked_within(df: DataFrame, key: str, counts: dict[int, int]) -> DataFrame:
    """df with rank, from 0, of each row within its key; row_no orders. counts: rows of each key.

    Keys are ranked in salted groups, so that none of them fills a task; the groups' counts are summed up.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = max(RANKED_AT_ONCE, sum(counts.values()) // (GROUPS_A_PARTITION * partitions))
    salts = max(1, -(-max(counts.values(), default=0) // together))
    salted = df.withColumn("salt", F.pmod(F.xxhash64("row_no"), F.lit(salts)))
    earlier = Window.partitionBy(key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        salted.groupBy(key, "salt")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col(key).alias("_key"), F.col("salt").alias("_salt"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    nth = F.row_number().over(Window.partitionBy(key, "salt").orderBy("row_no"))
    joined = salted.withColumn("nth", nth).join(before, (F.col(key) == F.col("_key")) & (F.col("salt") == F.col("_salt")))
    return joined.withColumn("rank", F.col("before") + F.col("nth") - 1).drop("_key", "_salt", "salt", "nth", "before")


def token_pieces(df: DataFrame, id_col: str, text_col: str, path: str, room: int, end_id: int) -> DataFrame:
    """Per row: doc_id, doc_tokens, checksums of its whole pieces, of its rest, and of the rest's powers of two."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = tokens.tokenizer(path)
        count, whole, rest, parts = [], [], [], []
        for text in texts(batch):
            ids = np.append(encoder(text.as_py()), np.uint32(end_id)).astype("<u4")
            n = len(ids)
            cut = n - n % room
            raw = ids.tobytes()
            count.append(n)
            whole.append([zlib.crc32(raw[4 * a : 4 * (a + room)]) for a in range(0, cut, room)])
            rest.append(zlib.crc32(raw[4 * cut :]))
            own, at, bit = [], cut, room // 2
            while bit:
                if (n - cut) & bit:
                    own.append(zlib.crc32(raw[4 * at : 4 * (at + bit)]))
                    at += bit
                bit //= 2
            parts.append(own)
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("doc_id")), pa.array(count, pa.int64()), pa.array(whole, longs), pa.array(rest, pa.int64()), pa.array(parts, longs)],
            ["doc_id", "doc_tokens", "whole", "rest", "parts"],
        )

    return map_arrow(narrow(df, doc_id=id_col, text=text_col), encode, "doc_id long, doc_tokens long, whole array<long>, rest long, parts array<long>")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, room: int = 1024, grid: int = 8, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    room is a power of two. The linear program sees rests by classes: their length rounded up to a
    multiple of grid, so a sequence is padded by less than grid for each rest in it. Null and empty
    texts are the end id alone. A text with the string of a special token has that token's id, as the
    tokenizer file says. Very long texts are encoded whole. Repeated rows and repeated or null ids are packed
    row by row; an empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    got = stored(token_pieces(df, id_col, text_col, path or tokens.default_path(), room, end_id), "token_pieces")
    size = F.col("doc_tokens") % room
    rests = got.where(size > 0).select("doc_id", "doc_tokens", "rest", "parts", size.alias("size"), F.monotonically_increasing_id().alias("row_no"))
    rests = rests.withColumn("klass", F.ceil(F.col("size") / grid) * grid)

    def counted(rows: DataFrame, key: str) -> dict[int, int]:
        """Rows by key: at most room keys."""
        return {int(r[key]): int(r["n"]) for r in rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).collect()}

    def frame(pdf: pd.DataFrame) -> DataFrame:
        """Bounded by room and the number of patterns, whatever the number of documents."""
        return F.broadcast(spark.createDataFrame(pdf.values.tolist(), ", ".join(f"{c} long" for c in pdf.columns)))

    histogram = counted(rests, "klass")
    classes = np.array(sorted(histogram), np.int64)
    plan = round_patterns(classes, np.array([histogram[c] for c in classes.tolist()], np.int64), room)
    ranges, used, sequences = rank_ranges(plan, histogram)
    ranked = stored(ranked_within(rests, "klass", histogram), "ranked")

    nth = F.col("rank") - F.col("lo")
    in_order = Window.partitionBy("sequence_id").orderBy("slot_no").rowsBetween(Window.unboundedPreceding, -1)  # at most room rests
    in_patterns = (
        ranked.join(frame(ranges.rename(columns={"klass": "of"})), (F.col("klass") == F.col("of")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .select(
            "doc_id",
            (F.col("doc_tokens") - F.col("size")).alias("start"),
            F.col("size").alias("length"),
            F.col("rest").alias("ids_crc32"),
            "doc_tokens",
            (2 * (F.col("base") + F.floor(nth / F.col("times")))).alias("sequence_id"),
            (F.col("slot") + F.pmod(nth, F.col("times"))).alias("slot_no"),
        )
        .withColumn("offset", F.coalesce(F.sum("length").over(in_order), F.lit(0)))
        .drop("slot_no")
    )

    over = frame(pd.DataFrame(sorted(used.items()), columns=["of", "used"], dtype="int64"))
    left = ranked.join(over, F.col("klass") == F.col("of")).where("rank >= used").drop("rank", "of", "used")
    left_sizes = counted(left, "size")
    places, tape = tape_places(left_sizes, room)
    place = F.col("tape") + F.col("rank") * F.col("part")
    cut = (
        ranked_within(left, "size", left_sizes)
        .join(frame(places.rename(columns={"size": "of"})), F.col("size") == F.col("of"))
        .withColumn("place", place)
    )
    # What doesn't fill the last sequence is as many sequences as its length has powers of two.
    ends, at, bit = [], tape - tape % room, room // 2
    while bit:
        if tape & bit:
            ends.append((at, at + bit))
            at += bit
        bit //= 2
    number, start = F.floor(F.col("place") / room), F.col("place") - F.col("place") % room
    for k, (lo, hi) in enumerate(ends):
        here = (F.col("place") >= lo) & (F.col("place") < hi)
        number, start = F.when(here, F.lit(tape // room + k)).otherwise(number), F.when(here, F.lit(lo)).otherwise(start)
    cut = cut.select(
        "doc_id",
        (F.col("doc_tokens") - F.col("size") + F.col("shift")).alias("start"),
        F.col("part").alias("length"),
        F.element_at("parts", F.col("nth_part").cast("int")).alias("ids_crc32"),
        "doc_tokens",
        (2 * (sequences + number)).cast("long").alias("sequence_id"),
        (F.col("place") - start).cast("long").alias("offset"),
    )
    full = got.select("doc_id", "doc_tokens", F.posexplode("whole").alias("nth", "ids_crc32")).select(
        "doc_id",
        (F.col("nth").cast("long") * room).alias("start"),
        F.lit(room).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return full.unionByName(in_patterns).unionByName(cut)
