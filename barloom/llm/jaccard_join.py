"""N-gram Jaccard join by adaptive multi-match prefixes.

A document is the set of its word shingles. Under one global order of shingles (rare ones first, by
a fixed-size frequency sketch, then by hash) two sets of similarity t that are each longer than
their prefix share at least l shingles within their first |s| - ceil(t |s|) + l. Every document
chooses its own l by the estimated cost of its candidates, and a pair must share the smaller of the
two numbers before it is verified on the whole sets.

Large groups of near copies aren't compared pair by pair over shingles. Documents with equal sets
are one class. In each shingle's list all classes are first compared with its most central one (the
class whose shingles are commonest), which links most of a group in one round. What came out
similar enough is a neighbourhood; within one, classes that are still apart are compared in blocks
of bounded size, and across neighbourhoods by shared prefixes. No link is lost, and none that lies
inside a component already found is looked for.
"""

from __future__ import annotations

import gc
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.llm import wordhash as W
from barloom.llm.common import forget, map_arrow, narrow, stored, texts
from barloom.llm.components import components
from barloom.session import ship_package

WORDS = 5
PERCENT = 80
#: Cells of the frequency sketch: its size doesn't depend on the input.
SKETCH_BITS = 22
_SPAN = 4096
_CHOICES = (1, 2, 3, 4, 6, 8, 12, 16, 24)
#: Similarity, in percent, from which a class belongs to a central class's neighbourhood.
NEIGHBOUR = 50
#: Classes in a block when a neighbourhood is compared in blocks.
BLOCK_CLASSES = 256
#: From this level of the sketch on (a logarithm of the frequency) a shingle's list is long.
LONG_LIST = 10
#: Central classes that a class is compared with first, and classes compared with one copy of the central one.
CENTRES, FAN = 2, 64
#: Bits of the map by which texts that aren't wanted are left out of a shuffle.
MAP_BITS = 24


def shingle_sets(col: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and distinct shingle hashes of each text."""
    for lo, hi, h, at in W.word_hashes(col, W.SPACES):
        g, g_at = W.grams(h, at, words, short=True)
        for i in range(hi - lo):
            yield lo + i, np.unique(g[g_at[i] : g_at[i + 1]])


def sketch(df: DataFrame, words: int) -> np.ndarray:
    """How often each cell of shingles occurs in all texts."""
    cells = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(cells, np.uint32), [], 0

        def note() -> None:
            cell, n = np.unique((np.concatenate(held) >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32), return_counts=True)
            total[cell] += n.astype(np.uint32)

        for batch in batches:
            for _, _, h, at in W.word_hashes(texts(batch), W.SPACES):
                held.append(W.grams(h, at, words, short=True)[0])
                size += len(held[-1])
                if size > 1 << 19:
                    note()
                    held, size = [], 0
        if held:
            note()
        yield pa.RecordBatch.from_arrays([pa.array(range(cells // _SPAN), pa.int64()), pa.array([zlib.compress(p.tobytes(), 1) for p in total.reshape(-1, _SPAN)], pa.binary())], ["span", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for span, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[span] = total.get(span, np.zeros(_SPAN, np.uint64)) + np.frombuffer(zlib.decompress(raw), np.uint32)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([zlib.compress(v.tobytes(), 1) for v in total.values()], pa.binary())], ["span", "n"])

    ship_package(df.sparkSession)
    spans = narrow(df, text="text").mapInArrow(count, "span long, n binary").repartition("span").mapInArrow(add, "span long, n binary")
    out = np.zeros((cells // _SPAN, _SPAN), np.float32)
    for row in spans.collect():  # a fixed number of rows of a fixed size
        out[row["span"]] = np.frombuffer(zlib.decompress(row["n"]), np.uint64)
    return out.reshape(-1)


def levels(counts: np.ndarray) -> np.ndarray:
    """log2 of the estimated frequency of each cell's shingles above what an average cell holds, 0 to 63."""
    mean = float(counts.mean(dtype=np.float64))
    base = mean + 4 * (mean + 1) ** 0.5
    out = np.zeros(len(counts), np.uint8)
    for at in range(0, len(counts), _SPAN):  # in pieces: the driver is small
        out[at : at + _SPAN] = np.minimum(np.log2(1 + np.maximum(counts[at : at + _SPAN] - base, 0)), 63)
    return out


def ordered(shingles: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Shingles under the global order, as keys: their level before their hash."""
    return np.sort((level[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(58)) | (shingles >> np.uint64(6)))


def choose_matches(keys: np.ndarray, percent: int) -> int:
    """The number of matches whose prefix has the least estimated cost: scanning lists, and verifying what they let through."""
    n = len(keys)
    need = -(-percent * n // 100)
    cost = np.cumsum(np.exp2((keys >> np.uint64(58)).astype(np.float64)) - 0.9)
    best, chosen = np.inf, 1
    for m in _CHOICES:
        if m > need:
            break
        scan = cost[min(n, n - need + m) - 1]
        total = scan * (1 + 4 / m**2)
        if total < best * 0.999:
            best, chosen = total, m
    return chosen


def _same(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def measured(df: DataFrame, level, words: int, percent: int) -> DataFrame:
    """Of each row: doc_id, n, digest of its set, centrality, matches, prefix."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digest, central, matches, prefix = [], [], [], [], []
        for _, s in shingle_sets(texts(batch), words):
            k = ordered(s, level.value)
            size = len(k)
            m = choose_matches(k, percent) if size else 1
            n.append(size)
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            central.append(int(16 * (k >> np.uint64(58)).astype(np.float64).mean()) if size else 0)
            matches.append(m)
            prefix.append(k[: size - -(-percent * size // 100) + m].view(np.int64))
        ends = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
        flat = pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("doc_id")),
                pa.array(n, pa.int64()),
                pa.array(digest, pa.binary()),
                pa.array(central, pa.int32()),
                pa.array(matches, pa.int32()),
                pa.ListArray.from_arrays(pa.array(ends), flat),
            ],
            ["doc_id", "n", "digest", "central", "matches", "prefix"],
        )

    return map_arrow(narrow(df, doc_id="doc_id", text="text"), run, "doc_id long, n long, digest binary, central int, matches int, prefix array<long>")


def _bits(ids: pa.Array) -> np.ndarray:
    return (W.mix(ids.fill_null(0).to_numpy().view(np.uint64)) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def possible(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs without most of those whose doc_id isn't in rows, by a bitmap of fixed size: fewer texts to shuffle."""

    spans = 1 << MAP_BITS - 3 - 13

    def parts(packed: np.ndarray) -> pa.RecordBatch:
        """A bitmap in spans of 8 KB, without the empty ones."""
        own = packed.reshape(spans, -1)
        some = np.flatnonzero(own.any(1))
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([zlib.compress(own[k].tobytes(), 1) for k in some], pa.binary())], ["span", "map"])

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << MAP_BITS, bool)
        for batch in batches:
            seen[_bits(batch.column(0))] = True
        yield parts(np.packbits(seen))

    def either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((spans, 1 << 13), np.uint8)
        for batch in batches:
            for span, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[span] |= np.frombuffer(zlib.decompress(raw), np.uint8)
        yield parts(total)

    ship_package(docs.sparkSession)
    total = np.zeros((spans, 1 << 13), np.uint8)
    noted = rows.select("doc_id").mapInArrow(note, "span long, map binary").repartition("span").mapInArrow(either, "span long, map binary")
    for row in noted.collect():  # a fixed number of rows of a fixed size
        total[row["span"]] |= np.frombuffer(zlib.decompress(row["map"]), np.uint8)
    packed = docs.sparkSession.sparkContext.broadcast(zlib.compress(total.tobytes(), 1))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(np.frombuffer(zlib.decompress(packed.value), np.uint8)).view(bool)
        for batch in batches:
            out = batch.filter(pa.array(seen[_bits(batch.column(0))]))
            if out.num_rows:
                yield out

    return docs.mapInArrow(keep, "doc_id long, text string")


class Join:
    """One run: the tables that its steps share."""

    def __init__(self, df: DataFrame, words: int, percent: int):
        self.spark = df.sparkSession
        self.words, self.percent = words, percent
        self.docs = narrow(df, doc_id="doc_id", text="text")
        level = self.spark.sparkContext.broadcast(levels(sketch(self.docs, words)))
        gc.collect()
        self.sets = stored(measured(self.docs, level, words, percent).withColumn("row_no", F.monotonically_increasing_id()), "sets")
        full = self.sets.where("n > 0")
        self.classes = stored(full.groupBy("digest").agg(F.min("row_no").alias("cid"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "classes")
        one = full.groupBy("digest").agg(F.min(F.struct("row_no", "n", "central", "matches", "prefix")).alias("r"))
        lists = one.select(F.col("r.row_no").alias("cid"), F.col("r.n").alias("n"), F.col("r.central").alias("central"), F.col("r.matches").alias("matches"), F.explode("r.prefix").alias("token"))
        lists = self.centred(lists)
        self.shared = stored(lists.select("token", "cid", "n", "matches", F.col("centre.cid").alias("centre")), "shared")

    def centred(self, lists: DataFrame) -> DataFrame:
        """lists with centre, the most central class of each token's list; without tokens that one class has.

        Long lists, as the sketch has it, are aggregated before they are shuffled and their few centres joined back; where one
        key of that join is large, its rows are split among tasks (adaptive skew join). Short lists are one window.
        """
        central = F.struct((-F.col("central")).alias("c"), F.col("cid").alias("cid"))
        long = F.shiftrightunsigned("token", 58) >= LONG_LIST
        by_token = Window.partitionBy("token")
        short = lists.where(~long).withColumn("members", F.count(F.lit(1)).over(by_token)).withColumn("centre", F.min(central).over(by_token))
        of = lists.where(long).groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("members"), F.min(central).alias("centre"))
        joined = lists.where(long).join(of, F.col("token") == F.col("_token")).drop("_token")
        return short.unionByName(joined).where("members > 1")

    def bodies(self, wanted: DataFrame) -> DataFrame:
        """cid, text of the wanted classes (column cid, distinct)."""
        rows = wanted.join(self.sets.where("n > 0").select(F.col("row_no").alias("cid"), "doc_id", "digest"), "cid")
        texts_of = possible(self.docs, rows).select(F.col("doc_id").alias("_doc"), "text")
        joined = rows.join(texts_of, F.col("doc_id").eqNullSafe(F.col("_doc"))).select("cid", "digest", "text")
        words = self.words

        def own(batch: pa.RecordBatch) -> pa.RecordBatch:
            """Only texts that have the class's set: ids may be repeated."""
            want = batch.column(1).to_pylist()
            good = np.zeros(batch.num_rows, bool)
            for i, s in shingle_sets(texts(batch), words):
                good[i] = hashlib.blake2b(s.tobytes(), digest_size=16).digest() == want[i]
            return batch.filter(pa.array(good)).select(["cid", "text"])

        repeated = self.docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not repeated.isEmpty():
            return map_arrow(joined, own, "cid long, text string").dropDuplicates(["cid"])
        return joined.select("cid", "text")

    def verified(self, pairs: DataFrame, floor: int) -> DataFrame:
        """a, b, same, linked of the pairs (a, b) with a similarity of at least floor percent.

        Each a travels to a share of b's partners; a b is copied once for every FAN of them.
        """
        pairs = stored(pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(1 << 30)).alias("h")), "pairs")
        per_b = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("shares")).select(F.col("b").alias("_b"), "shares")
        spread = stored(pairs.join(per_b, F.col("b") == F.col("_b")).select("a", "b", F.pmod("h", F.col("shares")).cast("int").alias("share")), "spread")
        ends = spread.select(F.col("a").alias("cid")).unionByName(spread.select(F.col("b").alias("cid"))).distinct()
        bodies = stored(self.bodies(ends), "bodies")
        first = spread.select("b", "share").distinct().join(bodies, F.col("b") == F.col("cid")).select("b", "share", F.lit(0).alias("kind"), "cid", "text")
        others = spread.join(bodies, F.col("a") == F.col("cid")).select("b", "share", F.lit(1).alias("kind"), "cid", "text")
        percent, words = self.percent, self.words

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whose, held = None, None
            for batch in batches:
                out: list[tuple] = []
                b, share, kind, cid = (batch.column(k).to_pylist() for k in range(4))
                for i, s in shingle_sets(texts(batch), words):
                    if kind[i] == 0:
                        whose, held = (b[i], share[i]), s
                    elif whose == (b[i], share[i]):
                        same = _same(held, s)
                        union = len(held) + len(s) - same
                        if 100 * same >= floor * union:
                            out.append((cid[i], b[i], same, 100 * same >= percent * union))
                cols = list(zip(*out, strict=True)) if out else [[]] * 4
                types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["a", "b", "same", "linked"])

        rows = first.unionByName(others).repartition("b", "share").sortWithinPartitions("b", "share", "kind", "cid")
        out = stored(rows.mapInArrow(compare, "a long, b long, same long, linked boolean"), "verified")
        forget(pairs, spread, bodies)
        return out

    def inside(self, groups: DataFrame, roots: DataFrame) -> DataFrame:
        """Links (u, v) within neighbourhoods (node, grp) between classes whose components (node, root) differ.

        Blocks of a neighbourhood meet in pairs; two blocks of one and the same component don't.
        """
        first = state = stored(
            groups.join(roots.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("node", "grp", F.coalesce("root", F.col("node")).alias("root")), "state"
        )
        apart = stored(state.groupBy("grp").agg(F.countDistinct("root").alias("roots")).where("roots > 1").select(F.col("grp").alias("_g")), "apart")
        state = state.join(apart, F.col("grp") == F.col("_g"), "left_semi")
        # A large component has blocks of its own, small ones share blocks: dealt out by hashes, no group is sorted in one task.
        per_root = stored(state.groupBy(F.col("grp").alias("_g"), F.col("root").alias("_r")).agg(F.count(F.lit(1)).alias("own")), "per_root")
        small = stored(per_root.where(F.col("own") < BLOCK_CLASSES).groupBy(F.col("_g").alias("_s")).agg(F.sum("own").alias("rest")), "small")
        deal = lambda key, n: F.pmod(F.xxhash64(key), F.ceil(F.col(n) / BLOCK_CLASSES)).cast("string")
        block = F.when(F.col("own") >= BLOCK_CLASSES, F.concat_ws("-", F.lit("large"), F.col("root").cast("string"), deal("node", "own"))).otherwise(F.concat_ws("-", F.lit("small"), deal("root", "rest")))
        sized = state.join(per_root, (F.col("grp") == F.col("_g")) & (F.col("root") == F.col("_r"))).join(small, F.col("grp") == F.col("_s"), "left")
        placed = stored(sized.select("node", "grp", "root", block.alias("block")), "placed")
        blocks = placed.groupBy("grp", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        x, y = blocks.alias("x"), blocks.alias("y")
        meet = x.join(y, (F.col("x.grp") == F.col("y.grp")) & (F.col("x.block") <= F.col("y.block"))).where("NOT (x.lo = x.hi AND y.lo = y.hi AND x.lo = y.lo)")
        meet = stored(meet.select(F.col("x.grp").alias("grp"), F.col("x.block").alias("i"), F.col("y.block").alias("j")), "meet")
        sides = meet.select("grp", F.col("i").alias("block"), "i", "j").unionByName(meet.where("i <> j").select("grp", F.col("j").alias("block"), "i", "j"))
        bodies = stored(self.bodies(placed.select(F.col("node").alias("cid"))), "bodies")
        rows = (
            placed.select(F.col("grp").alias("_g"), F.col("block").alias("_b"), "node", "root")
            .join(sides, (F.col("_g") == F.col("grp")) & (F.col("_b") == F.col("block")))
            .join(bodies, F.col("node") == F.col("cid"))
            .select("grp", "i", "j", "block", "node", "root", "text")
        )
        percent, words = self.percent, self.words

        def links(held: list[tuple[int, int, int, np.ndarray]]) -> list[tuple[int, int]]:
            """Links between different components in one meeting of two blocks (or of one with itself)."""
            size = np.array([len(h[3]) for h in held])
            block, root = np.array([h[0] for h in held]), np.array([h[2] for h in held])
            token = np.concatenate([h[3] for h in held])
            row = np.repeat(np.arange(len(held)), size)
            order = np.argsort(token, kind="stable")
            token, row = token[order], row[order]
            new = np.concatenate([[True], token[1:] != token[:-1]])
            col = np.cumsum(new) - 1
            common = np.bincount(col) > 1
            renamed = np.cumsum(common) - 1
            keep = common[col]
            row, col = row[keep], renamed[col[keep]]
            same = np.zeros((len(held), len(held)), np.float32)
            for at in range(0, int(common.sum()), 1024):
                own = (col >= at) & (col < at + 1024)
                m = np.zeros((len(held), 1024), np.float32)
                m[row[own], col[own] - at] = 1
                same += np.einsum("ik,jk->ij", m, m)
            union = size[:, None] + size[None, :] - same
            hit = (100 * same >= percent * union) & (root[:, None] < root[None, :])
            if len(set(block.tolist())) > 1:
                hit &= block[:, None] != block[None, :]
            return [(held[i][1], held[j][1]) for i, j in zip(*np.nonzero(hit), strict=True)]

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whose, held, out = None, [], []
            for batch in batches:
                key = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
                block, node, root = (batch.column(k).to_pylist() for k in (3, 4, 5))
                for i, s in shingle_sets(texts(batch), words):
                    if key[i] != whose:
                        out += links(held) if len(held) > 1 else []
                        whose, held = key[i], []
                    held.append((block[i], node[i], root[i], s))
            out += links(held) if len(held) > 1 else []
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], ["u", "v"])

        ordered_rows = rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "block", "node")
        out = stored(ordered_rows.mapInArrow(compare, "u long, v long").distinct(), "inside")
        forget(first, apart, per_root, small, placed, meet, bodies)
        return out

    def across(self, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs (a, b) of classes in different neighbourhoods that share enough of their prefixes, after the table they are read from."""
        own = self.shared.join(groups.withColumnRenamed("node", "_n"), F.col("cid") == F.col("_n"), "left").select("token", "cid", "n", "matches", F.coalesce("grp", F.col("cid")).alias("grp"))
        spread = own.groupBy(F.col("token").alias("_token")).agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo <> hi")
        mixed = stored(own.join(spread, F.col("token") == F.col("_token"), "left_semi"), "mixed")
        x, y = mixed.alias("x"), mixed.alias("y")
        near = (F.col("x.n") * 100 >= F.col("y.n") * self.percent) & (F.col("y.n") * 100 >= F.col("x.n") * self.percent)
        met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.cid") < F.col("y.cid")) & (F.col("x.grp") != F.col("y.grp")) & near)
        return mixed, (
            met.groupBy(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
            .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("x.matches", "y.matches")).alias("matches"))
            .where("shared >= matches")
            .select("a", "b")
        )

    def run(self) -> DataFrame:
        # Classes that share fewer shingles with their centre than they would need to are left to across().
        met = self.shared.where("cid <> centre").groupBy(F.col("cid").alias("a"), F.col("centre").alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.first("matches").alias("matches"))
        met = met.where("shared >= matches")
        nth = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("shared"), "b"))
        first = self.verified(met.withColumn("nth", nth).where(F.col("nth") <= CENTRES), NEIGHBOUR)
        edges = first.select(F.col("a").alias("u"), F.col("b").alias("v"), "linked")
        roots = components(edges.where("linked").select("u", "v"))
        grouped = components(edges.select("u", "v"))
        groups = grouped.withColumnRenamed("root", "grp")
        links = edges.where("linked").select("u", "v").unionByName(self.inside(groups, roots))
        mixed, pairs = self.across(groups)
        more = self.verified(pairs, self.percent).select(F.col("a").alias("u"), F.col("b").alias("v"))
        forget(mixed, self.shared, roots, grouped)
        final = components(links.unionByName(more)).select(F.col("node").alias("_node"), "root")
        placed = self.classes.join(final, F.col("cid") == F.col("_node"), "left").withColumn("root", F.coalesce("root", "cid"))
        placed = stored(placed.select("digest", "least", "root", "copies"), "placed")
        least = placed.groupBy("root").agg(F.min("least").alias("component_id")).select(F.col("root").alias("_root"), "component_id")
        named = stored(placed.join(least, F.col("root") == F.col("_root")).select(F.col("digest").alias("_digest"), "component_id"), "named")
        forget(placed, self.classes)
        rows = self.sets.select("doc_id", F.col("n").alias("n_shingles"), "row_no", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
        return rows.join(named, F.col("digest") == F.col("_digest"), "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "row_no")


def jaccard_components(df: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of df: doc_id, n_shingles, component_id, row_no (unique).

    component_id is the smallest doc_id that links reach; two rows link when their shingle sets'
    Jaccard similarity is at least percent. Null and empty texts and texts without words have no
    shingles and link with nothing, so their component is their own doc_id. Repeated rows are in one
    class. Other columns are ignored; an empty table gives an empty result.
    """
    return Join(df, words, percent).run()


def one_of_each(df: DataFrame) -> DataFrame:
    """The rows of df that stay when each component keeps the row with its smallest doc_id, with all columns.

    Texts without words stay. Where ids repeat (or are null), rows of one id stay together if any does.
    """
    found = jaccard_components(df)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stays")).distinct()
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col("doc_id").alias("_id"))
    return own.join(stored(stay, "stay"), F.col("_id").eqNullSafe(F.col("_stays")), "left_semi").select("_row.*")
