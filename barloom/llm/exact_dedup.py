"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

Each text is cut where its own content says so, each chunk gets a digest as its identifier, and an
identifier is verified: all chunks that carry it must be the same bytes. A text is then its recipe,
the ordered list of chunk identifiers, and only recipes are shuffled and compared; the chunks
travel once, deduplicated before the shuffle. Where an identifier stands for several chunks, the
chunk itself takes its place in the recipes, so the result is exact for any digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import stored

#: White space that isn't a single space already: one space replaces the run.
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUN, " ")


def chunk_pattern(least: int, most: int) -> str:
    """A chunk of at least `least` characters ends where its content says: at a punctuation mark and a
    space between certain letters, one place in about a thousand; else it has `most` characters.

    Such places are rare beside `least`, so chunks meet again soon after a difference.
    """
    return rf"(?s).{{{least},{most}}}?[aeinst][.!?,;:|] (?=[a-dA-D])|.{{1,{most}}}"


def sha256_id(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def recipes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 128,
    most: int = 8192,
    digest: Callable[[Column], Column] = sha256_id,
) -> DataFrame:
    """doc_id, row_no (unique for each row), text_sha256, recipe (ordered chunk identifiers).

    Null and empty texts have the empty recipe. Written once in the shared folder.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), normalised(F.col(f"`{text_col}`")).alias("text"))
    cut = docs.select(
        "doc_id",
        F.sha2("text", 256).alias("text_sha256"),
        F.regexp_extract_all("text", F.lit(chunk_pattern(least, most)), F.lit(0)).alias("chunks"),
    )
    table = stored(
        cut.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row_no"),
            "text_sha256",
            F.transform("chunks", digest).alias("recipe"),
        ),
        "recipes",
    )
    pieces = docs.select(F.explode(F.regexp_extract_all("text", F.lit(chunk_pattern(least, most)), F.lit(0))).alias("chunk"))
    bad = (
        pieces.select(digest(F.col("chunk")).alias("chunk_id"), "chunk")
        .distinct()
        .groupBy("chunk_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("chunk_id")
    )
    bad = stored(bad, "ambiguous")
    if bad.isEmpty():
        return table
    # The exact way: an ambiguous identifier gives way to its chunk.
    listed = (
        cut.select("doc_id", F.monotonically_increasing_id().alias("row_no"), "text_sha256", F.posexplode_outer("chunks").alias("pos", "chunk"))
        .withColumn("chunk_id", digest(F.col("chunk")))
        .join(bad.withColumn("ambiguous", F.lit(True)), "chunk_id", "left")
        .withColumn("part", F.when(F.col("ambiguous"), F.concat(F.lit("="), F.col("chunk")).cast("binary")).otherwise(F.concat(F.lit("#").cast("binary"), F.col("chunk_id"))))
    )
    exact = listed.groupBy("doc_id", "row_no", "text_sha256").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "part")))), lambda x: x["part"]).alias("recipe")
    )
    return stored(exact, "exact_recipes")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of df: doc_id, row_no, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised texts the one with the smallest doc_id stays (null ids last;
    among repeated ids just one row). Null and empty texts are equal to each other. An empty table
    gives an empty result; columns besides the two named are ignored.
    """
    table = recipes(df, id_col, text_col, **options)
    # Equal recipes meet by a 256-bit key of the list; lists are compared below.
    keyed = table.withColumn("recipe_key", F.sha2(F.concat_ws(",", F.transform("recipe", F.hex)), 256))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row_no").alias("row"))
    groups = keyed.groupBy("recipe_key", "recipe").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(groups, "groups").select(
        F.col("recipe_key"), F.col("recipe").alias("group_recipe"), F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"
    )
    return (
        keyed.join(groups, (keyed["recipe_key"] == groups["recipe_key"]) & (keyed["recipe"] == groups["group_recipe"]))
        .select(
            keyed["doc_id"],
            keyed["row_no"],
            "keep_id",
            F.col("group_size").cast("long").alias("group_size"),
            (F.col("row_no") == F.col("keep_row")).alias("kept"),
            "text_sha256",
        )
    )


def kept_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that stay, with all their columns.

    Rows that agree in doc_id and normalised text are told apart only if there are any: then the
    smallest by their printed columns stays.
    """
    found = exact_dedup(df, id_col, text_col)
    kept = stored(found.where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"), "group_size"), "kept")
    # Rows travel whole in one column, so that no name of theirs can clash.
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.sha2(normalised(F.col(f"`{text_col}`")), 256).alias("_sha"))
    out = own.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha")), "left_semi")
    twice = found.groupBy(F.col("doc_id"), "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        out = out.groupBy("_id", "_sha").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return out.select("_row.*")
