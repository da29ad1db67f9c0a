"""The registered queries of the subpackage, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from posledger.llm import (chat_format, exact_dedup, filter_audit, html_extraction, lm_scoring, merkle, mixing, packing,
                           quality_rules, repeats, secrets, simhash, warc)
from posledger.llm.common import read_table
from posledger.llm.sql import EXACT_DEDUP_SQL, FILTER_AUDIT_SQL, MERKLE_SQL, QUALITY_SQL, WARC_SQL

QUERIES, ORACLES = {}, {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(read_table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select("doc_id", hexed.alias("fingerprint"), "component_id")


@_query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@_query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@_query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(read_table(spark, sf_dir, "pages"), warc.new_folder(spark))
    records = warc.read_archives(spark, archives, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


@_query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "format")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


@_query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extraction.extract(read_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


@_query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_table(spark, sf_dir, "documents"))


@_query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.repair(read_table(spark, sf_dir, "conversations"))


@_query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False).drop("ids")


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.assess(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(read_table(spark, sf_dir, "documents"))


@_query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query
def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(read_table(spark, sf_dir, "documents"), with_kept=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


ORACLES["op2_exact_dedup"] = EXACT_DEDUP_SQL
ORACLES["op4_warc"] = WARC_SQL
ORACLES["op10_quality_rules"] = QUALITY_SQL
ORACLES["op11_merkle_manifest"] = MERKLE_SQL
ORACLES["op12_filter_audit"] = FILTER_AUDIT_SQL
