"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A normalised text is cut into chunks where its content says so (a minimum
length, then the next boundary pattern, a maximum length), so equal stretches
of different texts give equal chunks.  A chunk gets a 128-bit identifier; one
pass over the distinct chunks verifies that no identifier stands for two
different chunks, and takes other seeds if one does.  From then on texts are
compared as ordered identifier lists: a text's bytes move once, as distinct
chunks, and never again, however many copies there are.

Groups are counted by partial aggregation before the shuffle.  Rows get their
group by an equi-join against a written table of groups of two or more, whose
skewed partitions Spark splits, so a group may hold any share of the rows.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import ascii_lower, drop_rows, staged

MIN_CHUNK, MAX_CHUNK = 512, 8192
#: Content that ends a chunk: a vowel, one of r-t, then a space (or a line's end).
BOUNDARY = r"(?<=[aeiou][r-t][ \n])"


def chunks(text: Column, lo: int = MIN_CHUNK, hi: int = MAX_CHUNK, boundary: str = BOUNDARY) -> Column:
    """The text's chunks in order; joined together they are the text.  Empty text: none."""
    pattern = f"(?s).{{{lo},{hi}}}?{boundary}|.{{1,{hi}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def identifier(chunk: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), chunk).alias("a"), F.xxhash64(F.lit(seed + 1), chunk).alias("b"))


def verified_seed(texts: DataFrame, text: str, make=identifier) -> int:
    """The first seed whose identifiers tell all distinct chunks of ``texts`` apart."""
    for seed in count(0, 2):
        pairs = texts.select(F.explode(chunks(F.col(text))).alias("c"))
        distinct = pairs.select(make(F.col("c"), seed).alias("i"), "c").distinct()
        if distinct.groupBy("i").count().where("count > 1").isEmpty():
            return seed


def exact_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     make=identifier) -> DataFrame:
    """Group equal texts: one row per row of ``docs``.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``.  Texts are
    equal when identical after lower-casing A-Z; null counts as empty.  The
    largest id of a group is kept (a null id is the smallest).  Rows that
    repeat an id with an equal text share its decision.  An empty table gives
    an empty result; other columns are not read.
    """
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    seed = verified_seed(base, "t", make)
    recipes = staged(spark, base.select(
        "doc_id", F.sha2("t", 256).alias("text_sha256"),
        F.transform(chunks(F.col("t")), lambda c: make(c, seed)).alias("recipe"),
    ), "recipes")
    groups = recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = staged(spark, groups.where("group_size > 1"), "groups").withColumnRenamed("recipe", "r")
    joined = recipes.join(groups, F.col("recipe") == F.col("r"), "left")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), size.alias("group_size"),
                         keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns."""
    found = exact_duplicates(spark, docs)
    gone = staged(spark, found.where("NOT kept").select("doc_id", "text_sha256"), "copies")
    text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return drop_rows(docs, gone, {"text_sha256": F.sha2(text, 256)})
