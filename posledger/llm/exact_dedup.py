"""Exact deduplication by skew-safe combining, DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. Three combining steps, each keyed by the digest
*and* the whole content, so a digest that two texts share never merges them:

1. local: the map side of an aggregation folds the copies a task holds into one row per text;
2. salted: those rows meet under (digest, content, salt). The salt is the task's number, so the copies of
   a hot text are spread over ``SALTS`` reducers, which get at most one row per text and map task;
3. global: the salt winners, at most ``SALTS`` rows per text, meet under (digest, content).

The winners are then written without their texts and looked up by digest, length and a second,
independent hash. The lookup is a plain join of two exchanges, which adaptive execution splits on hot keys.

Defined results: a null text counts as empty and groups with empty texts. The row with the largest doc_id
stays; null ids are smaller than all others and a group with null ids only keeps one of its rows. Rows that
repeat an id and text are one document that occurs several times: one occurrence stays, and all count in
``group_size``. Extra columns never take part and pass through ``drop_copies`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from posledger.llm.common import fold_case, text_of, unused
from posledger.sources.tables import stage

SALTS = 16


def content_of(text: str | Column) -> Column:
    return fold_case(text_of(text))


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _keyed(docs: DataFrame, doc_id: str, text: str, digest) -> DataFrame:
    content = docs.select(F.col(doc_id).alias("doc_id"), content_of(text).alias("content"))
    return content.withColumns({
        "digest": digest(F.col("content")), "length": F.octet_length("content"), "mark": F.xxhash64("content")})


def _id_key(column: str) -> Column:
    """The id as text, a null as the empty string, so that ids join by plain equality."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def combine(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per text: its keys, the id that stays and the number of rows."""
    keys = ["digest", "content"]
    salted = keyed.withColumn("salt", F.spark_partition_id() % salts)
    local = salted.groupBy(*keys, "salt").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
    merged = local.groupBy(*keys).agg(F.max("keep_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return merged.select("digest", F.octet_length("content").alias("length"), F.xxhash64("content").alias("mark"),
                         "keep_id", "group_size")


def copy_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256,
                salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, digest, length, mark, keep_id, group_size, kept."""
    keyed = _keyed(docs, doc_id, text, digest)
    winners = stage(combine(keyed, salts), "exact-winners")
    keys = ["digest", "length", "mark"]
    # Occurrences of one id and text are folded first, so that exactly one of them can stay.
    rows = keyed.groupBy("doc_id", *keys).agg(F.count(F.lit(1)).alias("times"))
    joined = rows.join(winners, keys)
    joined = joined.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return joined.select("doc_id", *keys, "keep_id", "group_size", stays.alias("kept"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """``docs`` with one row per text, as it was."""
    keys = unused(docs, "digest", "length", "mark", "id_key")
    winners = stage(combine(_keyed(docs, doc_id, text, sha256), salts), "exact-winners").select(
        "digest", "length", "mark", _id_key("keep_id")).toDF(*keys)
    content = content_of(text)
    found = [sha256(content), F.octet_length(content), F.xxhash64(content), _id_key(doc_id)]
    kept = docs.withColumns(dict(zip(keys, found))).join(winners, keys, "left_semi")
    # Only rows that repeat both id and text are still together; they lie side by side after the join.
    return kept.dropDuplicates(keys).select(*docs.columns)
