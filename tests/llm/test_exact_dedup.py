import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from barloom.llm import exact_dedup as E


def plain(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    return {i: (min(j for j in norm if norm[j] == norm[i]), sum(norm[j] == norm[i] for j in norm), hashlib.sha256(norm[i].encode()).hexdigest()) for i in norm}


LONG = "Lorem ipsum dolor, sit amet. " * 500
ROWS = [(1, "a  b"), (2, "a b"), (3, "a\t\nb"), (4, None), (5, ""), (6, " "), (7, LONG), (8, LONG.replace(" ", "\n")), (9, LONG + "x"), (10, "é" * 20000), (11, "a b")]


@pytest.mark.parametrize("digest", [E.sha256_id, lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 1))])
def test_edges_also_where_identifiers_collide(spark, digest):
    df = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, recipe string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in E.exact_dedup(df, least=16, most=64, digest=digest).collect()}
    assert got == plain(ROWS)


def test_one_of_repeated_ids_stays(spark):
    df = spark.createDataFrame([(1, "a", "p"), (1, "a", "q"), (None, "a", "r"), (2, "b", "s"), (2, "c", "t")], "doc_id long, text string, _sha string")
    assert sum(r["kept"] for r in E.exact_dedup(df).collect()) == 3
    kept = E.kept_rows(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"], r["_sha"]) for r in kept.collect()) == [(1, "a", "p"), (2, "b", "s"), (2, "c", "t")]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert E.exact_dedup(df).count() == 0 and E.kept_rows(df).count() == 0


def test_chunks_give_the_text_back_and_meet_again_after_a_change(spark):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdeinst") for _ in range(rng.randint(1, 8))) + rng.choice(["", "", ".", ","]) for _ in range(4000))
    df = spark.createDataFrame([(text,), ("something before. " + text,)], "t string")
    chunks = [r["c"] for r in df.select(F.regexp_extract_all("t", F.lit(E.chunk_pattern(128, 8192)), F.lit(0)).alias("c")).collect()]
    assert "".join(chunks[0]) == text
    assert len(set(chunks[0]) & set(chunks[1])) > 0.5 * len(set(chunks[0]))
