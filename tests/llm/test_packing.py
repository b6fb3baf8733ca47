import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from barloom.llm import packing, tokens

SF = "/root/testdata/sf0.001"


def check(rows, docs, room=1024):
    """Every id in exactly one piece, checksums right, offsets gapless; returns padding over tokens."""
    plain = Tokenizer.from_file(tokens.default_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(docs)
    for doc_id, text in docs.items():
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= room
        padding += 0 if at & (at - 1) == 0 else room - at
    return padding / sum(r["length"] for r in rows)


def test_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(df).collect()
    assert check(rows, {r["doc_id"]: r["text"] for r in df.collect()}) < 0.01


def test_edges(spark):
    texts = {1: None, 2: "", 3: "a " * 1023, 4: "a " * 5000, 5: "x", 6: "x", 7: "  \n\n tabs\t   \U0001f600 <|endoftext|> 漢字", 8: "don't '123 !!"}
    df = spark.createDataFrame([(k, v, "z") for k, v in texts.items()], "doc_id long, text string, length string")
    check(packing.pack(df).collect(), texts)
    assert packing.pack(df.where("false")).collect() == []


def test_patterns_stay_within_demand():
    rng = np.random.default_rng(3)
    for n in (1, 7, 200, 5000):
        sizes, demand = np.unique(rng.integers(1, 129, n) * 8, return_counts=True)
        taken = np.zeros(len(sizes), int)
        for pattern, times in packing.round_patterns(sizes, demand, 1024):
            assert sum(s * k for s, k in pattern.items()) == 1024
            for s, k in pattern.items():
                taken[np.searchsorted(sizes, s)] += k * times
        assert (taken <= demand).all()


def test_column_price_is_optimal():
    sizes, value = np.array([3, 5, 8]), np.array([0.31, 0.55, 0.9])
    best = max(a * 0.31 + b * 0.55 + c * 0.9 for a in range(8) for b in range(5) for c in range(3) if 3 * a + 5 * b + 8 * c <= 21)
    total, column = packing.price_column(value, sizes, 21)
    assert abs(total - best) < 1e-9 and abs((column * value).sum() - best) < 1e-9


def test_ids_are_those_of_the_tokenizer(spark):
    plain = Tokenizer.from_file(tokens.default_path())
    ours = tokens.tokenizer(tokens.default_path())
    for text in ("a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endoftext|", "plain", "", "\x00 \u00a0 x"):
        assert ours(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert ours("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, None), (2, None), (None, "x")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in packing.pack(df).collect() if r["start"] == 0) == [(0, 2), (1, 5), (2, 1), (2, 1)]
