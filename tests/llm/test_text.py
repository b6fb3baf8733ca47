"""Word hashing, chat, licences, decontamination, pipeline."""

import hashlib
import pathlib
import random
import sys
import textwrap
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from brute import words
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, "tests")
from compare import connect, same  # noqa: E402

from barloom.llm import chat, decontam, licenses, queries  # noqa: E402
from barloom.llm import wordhash as W  # noqa: E402

SF = "/root/testdata/sf0.001"


@given(st.lists(st.text(alphabet="abAé \n.　", max_size=30), max_size=8), st.sampled_from([4, 64, 1 << 21]))
@settings(max_examples=60, deadline=None)
def test_word_hashes_and_grams(texts, block):
    old = W.BLOCK
    W.BLOCK = block
    try:
        seen = {}
        for lo, hi, h, at in W.word_hashes(pa.array(texts, pa.string())):
            g, g_at = W.grams(h, at, 3, short=True)
            for i in range(lo, hi):
                w = words(texts[i])
                own = h[at[i - lo] : at[i - lo + 1]].tolist()
                assert len(own) == len(w)
                grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [tuple(w)] if w else []
                assert len(grams) == g_at[i - lo + 1] - g_at[i - lo]
                for key, value in [*zip(w, own, strict=True), *zip(grams, g[g_at[i - lo] : g_at[i - lo + 1]].tolist(), strict=True)]:
                    assert seen.setdefault(("k", key), value) == value and seen.setdefault(("v", value), key) == key
    finally:
        W.BLOCK = old


@given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "a", "|", ">", "/s>"]), max_size=12).map("".join))
@settings(max_examples=300, deadline=None)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text and not any(c in out for c in chat.CONTROLS)
    formatted, lo, hi = chat.write_turn("assistant", text)
    assert list(chat.read_turns(formatted)) == [("assistant", text)] and chat.unescape(formatted[lo:hi]) == text


def test_layouts_become_turns(spark):
    records = [
        (1, '{"prompt": "p", "response": "r"}'),
        (2, '{"instruction": "do", "input": "x", "output": "y"}'),
        (3, '{"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": null}]}'),
        (4, '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}'),
        (5, '{"strange": 1}'),
        (6, "no json"),
        (7, None),
    ]
    df = spark.createDataFrame([(i, r, 0) for i, r in records], "conv_id long, record string, nth int")
    got = {}
    for r in chat.canonical_turns(df).orderBy("conv_id", "nth").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got[1] == [("user", "p"), ("assistant", "r")] and got[2] == [("user", "do\n\nx"), ("assistant", "y")]
    assert got[3] == [("user", "u"), ("assistant", "")] and got[4] == [("user", "h"), ("assistant", "g")]
    assert got[5] == got[6] == got[7] == [(None, None)]


def test_conversations_with_nulls_and_ties(spark):
    rows = [(1, 0, "user", None), (1, 0, "assistant", "x<|end|>"), (1, None, "user", "first"), (None, 0, "assistant", "y"), (2, 0, None, "z"), (2, 0, None, "z")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nfirst\nassistant\nx<|end|>\nuser\n\n").hexdigest()
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[None]["n_turns"], got[2]["n_turns"]) == (3, 8, 1, 2)
    assert chat.digests(chat.format_conversations(df.where("false"))).count() == 0


def test_ties_go_by_role_and_text_as_they_are(spark):
    texts = ["</s> a", "<0 b", "<\\/s>", "[INST]", "[0", "<|text|>", "<|end|> x", "", "é", "z"]
    rows = [(1, 0, r, t) for r in ("user", "<s>", "<0") for t in texts]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in sorted(rows, key=lambda x: (x[2].encode(), x[3].encode()))).encode()).hexdigest()
    assert chat.digests(chat.format_conversations(df)).first()["turns_sha256"] == want


def test_layout_of_a_table_selects_its_mapping(spark):
    said = spark.createDataFrame([(1, "p", "r"), (2, None, "only"), (3, None, None)], "id long, prompt string, response string")
    got = [(r["conv_id"], r["nth"], r["role"], r["text"]) for r in chat.table_turns(said, "id").orderBy("conv_id", "nth").collect()]
    assert got == [(1, 0, "user", "p"), (1, 1, "assistant", "r"), (2, 0, "assistant", "only")]
    lists = spark.createDataFrame([(1, [("human", "h"), ("gpt", None)]), (2, None)], "id long, conversations array<struct<from:string,value:string>>")
    got = [(r["conv_id"], r["nth"], r["role"], r["text"]) for r in chat.table_turns(lists, "id").orderBy("conv_id", "nth").collect()]
    assert got == [(1, 0, "user", "h"), (1, 1, "assistant", "")]
    with pytest.raises(ValueError):
        chat.table_turns(said.withColumnRenamed("prompt", "strange"), "id")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name])


def test_licences(spark):
    mit = licenses.TEXTS["MIT"][0]
    rows = [(1, "MIT Licence\n\nCopyright (c) 2020 A. Author\n\n" + mit.lower().replace(",", " ,")), (2, mit + " more"), (3, "x\n* Released under the MIT licence! *\n"), (4, None), (5, ""), (6, "!!"), (6, "!!")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, license_id string")
    got = {r["doc_id"]: (r["license_id"], r["notices"]) for r in licenses.license_scan(df).collect()}
    assert got[1][0] == "MIT" and got[2] == (None, "") and got[3] == (None, "MIT") and got[4] == got[5] == got[6] == (None, "")
    assert licenses.license_scan(df).count() == 7 and licenses.license_scan(df.where("false")).count() == 0


def test_more_licences(spark):
    folder = pathlib.Path(licenses.__file__).parent / "license_texts"
    whole = {f.name: f.read_text() for f in folder.glob("*.txt")}
    assert {"Apache-2.0.txt", "GPL-2.0.txt", "GPL-3.0.txt", "LGPL-2.1.txt", "LGPL-3.0.txt", "MPL-2.0.txt", "CC0-1.0.txt", "CC-BY-4.0.txt", "CC-BY-SA-4.0.txt"} <= set(whole)
    got = {r["doc_id"]: r["license_id"] for r in licenses.license_scan(spark.createDataFrame([(k, " ".join(v.upper().split(" "))) for k, v in whole.items()], "doc_id string, text string")).collect()}
    assert got == {k: k.removesuffix(".txt").split("~")[0] for k in whole}
    lines = {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."}
    lines |= {"CC-BY-4.0": "Licensed under CC BY 4.0.", "CC-BY-ND-3.0": "Released under CC BY-ND 3.0.", "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3."}
    got = licenses.license_scan(spark.createDataFrame([(k, f"text\n{v}\n") for k, v in lines.items()], "doc_id string, text string")).collect()
    assert {(r["doc_id"], r["notices"]) for r in got} == {(k, k) for k in lines}


def test_copyright_statements(spark):
    heads = ["Copyright (c) 2024, X Y <x@y.org>", "(c) 2024 X", "© X", "Copyright 2024 X. All rights reserved.", "Copyright [yyyy] [name]\nAll rights reserved.", " * Copyright: 2001-2024 X"]
    rows, want = [], {}
    for i in ("ISC", "BSD-2-Clause", "BSD-3-Clause", "MIT", "0BSD"):
        for width in range(60, 81):  # some of them break lines before "copyright notice" or "copyright holders"
            body = textwrap.fill(licenses.TEXTS[i][0], width)
            rows += [(f"{i} {width} {k}", f"{head}\n\n{body}\n") for k, head in enumerate(heads)]
            want |= {f"{i} {width} {k}": i for k in range(len(heads))}
    assert sum("\ncopyright notice" in t for _, t in rows) > 10
    isc = (
        "ISC License\n\nCopyright (c) 2024 X\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, "
        "provided that the above\ncopyright notice and this permission notice appear in all copies.\n\n" + textwrap.fill(licenses._ISC, 76)
    )
    rows += [("isc", isc), ("one", "Copyright (c) 2024 X. Released under the MIT License.\n" + licenses.TEXTS["MIT"][0])]
    got = {r["doc_id"]: r["license_id"] for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == want | {"isc": "ISC", "one": "MIT"}
    lines = {
        "Copyright (c) 2024 X. Released under the MIT License.": "MIT", "Copyright 2024 X, licensed under the Apache License, Version 2.0.": "Apache-2.0", "© X. MIT License": "MIT",
        "All rights reserved. Released under the MIT License.": "MIT", "Copyright (c) 2024 MIT": "", "Copyright (c) 2024 X": "", "All rights reserved.": "", "(c) You must keep it": "",
    }
    df = spark.createDataFrame([(k, f"text\n{k}\nmore") for k in lines], "doc_id string, text string")
    assert {r["doc_id"]: r["notices"] for r in licenses.license_scan(df).collect()} == lines
    shared = ["Copyright (c) 2024 X. All rights", "copyright notice and", "Copyright 2024 X\r\nbody", "ALL RIGHTS RESERVED by", "(c) You", "© é. Released under é", "Copyright (c) 2024 X - licensed under MIT"]
    spark_says = [r[0] for r in spark.createDataFrame(list(enumerate(shared)), "i int, t string").orderBy("i").select(licenses.canonical("t")).collect()]
    duckdb_says = [connect(SF).execute(f"SELECT {licenses.duckdb_canonical('t')} FROM (SELECT ? AS t)", [t]).fetchone()[0] for t in shared]
    assert spark_says == duckdb_says == ["", "copyright notice and", "body", "all rights reserved by", "c you", "released under é", "licensed under mit"]


def test_other_ways_to_write_a_licence(spark):
    curly = lambda t: t.replace('"AS IS"', "“AS IS”").replace('("Software")', "(‘Software’)").replace(", ", " – ", 1)
    rows = [(f"{i} curly", "Copyright © 2024 X\n\n" + curly(licenses.TEXTS[i][0])) for i in ("MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause")]
    for i in ("BSD-2-Clause", "BSD-3-Clause"):
        for name, marks in (("stars", "***"), ("dashes", "---"), ("bullets", "•••"), ("letters", ("a.", "b.", "c.")), ("brackets", ("(1)", "(2)", "(3)")), ("round", ("a)", "b)", "c)"))):
            text = licenses.TEXTS[i][0]
            for k, mark in enumerate(marks, 1):
                text = text.replace(f" {k}. ", f"\n\n  {mark} ")
            rows.append((f"{i} {name}", "Copyright (c) 2024, X\nAll rights reserved.\n\n" + text))
    got = {r["doc_id"]: r["license_id"] for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {k: k.split()[0] for k, _ in rows}
    con = connect(SF)
    con.execute("DROP VIEW documents")
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    assert {r[0]: r[1] for r in con.execute(queries.SQL["op1_license_scan"]).fetchall()} == got


def test_catalogue_table(spark):
    known = spark.createDataFrame([("b", "text", "Do what you like."), ("a", "text", "do what you like"), ("a", "notice", "See A"), ("none", "text", "!!"), ("none", "text", None)], "license_id string, kind string, text string")
    df = spark.createDataFrame([(1, "Do what you LIKE"), (2, "x\nsee a!\nsee b"), (3, "Licensed under CC BY 4.0."), (4, None), (5, "See A")], "doc_id long, text string")
    got = {r["doc_id"]: (r["license_id"], r["notices"]) for r in licenses.license_scan(df, known=known).collect()}
    assert got == {1: ("a,b", "a,b"), 2: (None, "a"), 3: (None, ""), 4: (None, ""), 5: (None, "a")}
    assert {r["license_id"] for r in licenses.license_scan(df, known=known.where("false")).collect()} == {None}


def coverage(item, text, least):
    """Greedy string tiling by looking at every pair of places."""
    a, b = [False] * len(item), [False] * len(text)
    total = 0
    while True:
        best = []
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k >= least:
                    best.append((-k, i, j))
        if not best:
            return total
        k, i, j = min(best)
        total -= k
        for x in range(-k):
            a[i + x] = b[j + x] = True


def test_tiles_cover_as_plain_tiling_does():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.randrange(40) for _ in range(rng.randint(5, 40))]
        text = [rng.randrange(40) for _ in range(20)] + item[10:] + [99, 98] + item[:12] + [rng.randrange(40) for _ in range(10)]
        x, y = (np.array(v, np.uint64) * np.uint64(0x9E3779B97F4A7C15) for v in (item, text))
        tiles = decontam.tile(x, y, 3)
        assert sum(k for _, _, k in tiles) == coverage(item, text, 3)
        assert all((x[p : p + k] == y[q : q + k]).all() for p, q, k in tiles)


def test_leaks(spark):
    item = " ".join(f"w{i}" for i in range(30))
    half = item.split()
    docs = [(1, "Before. " + item.upper() + "! after"), (2, " ".join(half[15:] + ["x"] * 3 + half[:15])), (3, " ".join(half[:6])), (4, None), (5, ""), (6, "one two"), (7, "z " * 300_000 + item)]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one, two"), (4, "one, two")], "item_id long, text string")
    for size in (10, 16_000_000):  # several blocks, and one
        got = decontam.leaks(df, bench, block_chars=size).distinct().collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (2, 1), (6, 4), (7, 1)]
        assert sorted(r["doc_id"] for r in decontam.clean_rows(df, bench, block_chars=size).collect()) == [3, 4, 5]
    assert decontam.leaks(df, bench.where("false")).count() == 0 and decontam.leaks(df.where("false"), bench).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as P
    from brute import components
    from test_packing import check

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = docs.columns, [docs]
    for _, stage in P.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF).cache())
        assert kept[-1].columns == names
    rows = [{r["doc_id"]: r["text"] for r in k.collect()} for k in kept]
    assert all(set(b) <= set(a) and all(a[k] == b[k] for k in b) for a, b in zip(rows, rows[1:], strict=False))
    assert len({" ".join(t.split()) for t in rows[1].values()}) == len(rows[2])
    assert set(rows[3]) == {d for d, (_, root) in components(rows[2]).items() if d == root}
    items = [words(r["text"].translate(str.maketrans({c: " " for c in W.PUNCTUATION.decode()}))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for text in rows[4].values():
        body = " " + " ".join(words(text.translate(str.maketrans({c: " " for c in W.PUNCTUATION.decode()})))) + " "
        assert not any(f" {' '.join(i)} " in body for i in items)
    assert check(P.run(spark, SF).collect(), rows[4]) < 0.02


def test_tiling_of_short_overlapping_pieces():
    item = list(range(16))
    text = [90, *item[:6], 91, *item[5:12], 92]  # t0..t4 is what the tile t5..t11 leaves of the first piece
    assert sorted(decontam.tile(np.array(item, np.uint64), np.array(text, np.uint64), 5)) == [(0, 1, 5), (5, 8, 7)]
    rng = random.Random(7)
    for _ in range(300):
        item = [rng.choice([*range(40), i]) for i in range(rng.randint(8, 24))]
        text = []
        for _ in range(rng.randint(1, 6)):
            lo = rng.randrange(len(item))
            text += [*item[lo : lo + rng.randint(3, 10)], *[rng.randint(100, 200)] * rng.randint(0, 1)]
        for least in (3, 5):
            tiles = decontam.tile(np.array(item, np.uint64), np.array(text, np.uint64), least)
            assert sum(k for _, _, k in tiles) == coverage(item, text, least)


def test_tiling_of_random_reordered_texts():
    """Many small cases against plain tiling, with few and many different words."""
    rng = random.Random(5)
    for case in range(5000):
        words_of = rng.choice([2, 4, 12, 60])
        item = [rng.randrange(1, 1 + words_of) for _ in range(rng.randint(5, 24))]
        text = []
        for _ in range(rng.randint(1, 5)):
            lo = rng.randrange(len(item))
            text += [*item[lo : lo + rng.randint(2, 12)], *[rng.randint(100, 200)] * rng.randint(0, 1)]
        tiles = decontam.tile(np.array(item, np.uint64), np.array(text, np.uint64), 5)
        assert sum(k for _, _, k in tiles) == coverage(item, text, 5), case
        assert all(item[p : p + k] == text[q : q + k] for p, q, k in tiles)
        assert len({x for p, _, k in tiles for x in range(p, p + k)}) == sum(k for _, _, k in tiles) == len({x for _, q, k in tiles for x in range(q, q + k)})


def test_one_repeated_word_takes_time_in_proportion():
    item = np.full(220, 7, np.uint64)

    def seconds(n):
        began = time.process_time()
        assert decontam.tile(item, np.full(n, 7, np.uint64), 5) == [(0, 0, 220)]
        assert sum(k for _, _, k in decontam.tile(np.append(item, np.arange(10, 40, dtype=np.uint64)), np.full(n, 7, np.uint64), 5)) == 220
        return time.process_time() - began

    seconds(1000)
    assert seconds(400_000) < 4


def test_leaks_agree_with_plain_tiling(spark):
    """The whole query on a whole table: every pair that shares five words, by plain tiling."""
    plain_words = lambda t: words((t or "").translate(str.maketrans({c: " " for c in W.PUNCTUATION.decode()})))
    docs = {r["doc_id"]: plain_words(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: plain_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    seeds = {}
    for i, w in items.items():
        for k in range(len(w) - 4):
            seeds.setdefault(tuple(w[k : k + 5]), set()).add(i)
    want = {}
    for d, w in docs.items():
        for i in {i for k in range(len(w) - 4) for i in seeds.get(tuple(w[k : k + 5]), ())}:
            item = items[i]
            near = sorted({x for k in range(len(w) - 4) if i in seeds.get(tuple(w[k : k + 5]), ()) for x in range(k, k + 5)})
            text = [x for a, b in zip(near, [-9, *near], strict=False) for x in (["|"] if a != b + 1 else []) + [w[a]]]
            share = coverage(item, text, 5) / len(item)
            if share >= 0.5:
                want[d, i] = round(share, 9)
    got = {(r["doc_id"], r["item_id"]): round(r["coverage"], 9) for r in queries.QUERIES["op7_decontamination"](spark, SF).collect()}
    assert got == want and len(got) >= 3


def test_stages_with_nulls_repeated_rows_long_texts_and_other_columns(spark):
    import corpus_pipeline as P

    good = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    said = [r["text"] for r in good.collect()]
    rows = [(None, None), (7001, None), (7002, ""), (7003, " \n"), (7004, said[0]), (7004, said[0]), (7005, said[1] + " more"), (None, said[2]), (7006, (said[3] + "\n") * 400), (7007, "z " * 200_000)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    names = {"score": "1", "doc": "'x'", "y": "CAST(NULL AS INT)", "kept": "false", "cid": "2L", "keep_id": "3L", "_row": "'r'", "row_no": "4L", "size": "5"}
    docs = good.select("doc_id", "text").unionByName(extra).selectExpr("*", *(f"{v} AS {k}" for k, v in names.items()))
    for empty in (False, True):
        now = docs.where("false") if empty else docs
        columns, seen = now.columns, now.collect()
        for name, stage in P.STAGES[:-1]:
            now = stage(spark, now, SF).cache()
            assert now.columns == columns, name
            after = now.collect()
            assert all(r in seen for r in after), name
            seen = after
        packed = P.STAGES[-1][1](spark, now, SF).collect()
        assert sum(r["length"] for r in packed) == sum(r["doc_tokens"] for r in packed if r["start"] == 0)
        assert len([r for r in packed if r["start"] == 0]) == len(seen) and bool(seen) != empty
    for name, stage in P.STAGES:  # each stage on rows that an earlier one would have removed
        out = stage(spark, docs, SF).collect()
        assert out, name
