"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.chat import CHAT_SQL, format_conversations
from tidelog.llm.common import table
from tidelog.llm.decontaminate import DECONTAMINATE_SQL, contaminated
from tidelog.llm.licenses import scan_licenses
from tidelog.llm.manifest import MANIFEST_SQL, merkle_manifest, verified
from tidelog.llm.mixing import MIX_SQL, by_position, curriculum_mix
from tidelog.llm.neighbours import vector_links
from tidelog.llm.pages import extract_main_text
from tidelog.llm.secrets import scan_secrets
from tidelog.llm.simhash import simhash_components
from tidelog.llm.substrings import remove_repeats
from tidelog.llm.toxicity import fit_on, held_out, score_toxicity
from tidelog.llm.trie import TRIE_SQL, prefix_trie
from tidelog.llm.urls import judge_urls


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score; the model is fitted on labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    score = F.col("__toxicity")
    return score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the least id it can be reached from."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes from it."""
    return by_position(curriculum_mix(table(spark, sf_dir, "documents")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a benchmark item in it, and how similar the passage is."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("key").alias("doc_id"), "item_id", "similarity")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in the documents, judged."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return format_conversations(table(spark, sf_dir, "conversations"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 400 bytes that also start elsewhere, as a digest."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and the least id it can be reached from; NN-descent runs at every size, and so does the exact check after it."""
    return vector_links(table(spark, sf_dir, "embeddings"), brute=0)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license match in the documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("left", "right")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and the root that follows after tampering."""
    return verified(merkle_manifest(table(spark, sf_dir, "documents")))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict by its url."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_simhash_dedup, op3_html_extraction, op4_source_mixing, op5_decontamination, op6_secret_scan, op7_chat_formatting,
    op8_suffix_array_dedup, op9_embedding_dedup, op10_license_scan,
    op11_conversation_trie, op12_merkle_manifest, op13_url_filter)}
ORACLE = {
    "op4_source_mixing": MIX_SQL.format(docs="documents"),
    "op5_decontamination": DECONTAMINATE_SQL.replace("{docs}", "documents"),
    "op7_chat_formatting": CHAT_SQL,
    "op11_conversation_trie": TRIE_SQL,
    "op12_merkle_manifest": MANIFEST_SQL,
}
