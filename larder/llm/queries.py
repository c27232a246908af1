"""The registered queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import common as C
from larder.llm import chat_format, html_extract, jaccard_join, lexical_search, mixing, nearest, packing, pii, prefix_trie, recompression, suffix_dedup, toxicity
from larder.llm import quality_rules as quality


def tokenizer_path() -> str:
    """The vocabulary file that the packing query and the pipeline count tokens with."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(C.read(spark, sf_dir, "documents", "doc_id", "text"), C.read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(C.read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.substring_dedup(C.read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(C.read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(C.read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.substring_dedup(C.read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(C.read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents", "doc_id", "text")
    found = quality.quality_rules(docs, C.read(spark, sf_dir, "labels", "doc_id", "quality"))
    return found.select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(C.read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(C.read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(C.read(spark, sf_dir, "documents", "doc_id", "text"), C.read(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(C.read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.with_trap(C.read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return chat_format.read_back(chat_format.format_conversations(turns))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_html_extract": op5_html_extract,
    "op6_recompression": op6_recompression,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_nearest": op9_nearest,
    "op10_pii": op10_pii,
    "op11_lexical_search": op11_lexical_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_chat_format": op13_chat_format,
}

#: DuckDB SQL by query name.
ORACLE: dict[str, str] = {
    "op7_mixing": mixing.sql(),
    "op11_lexical_search": lexical_search.sql(),
    "op12_prefix_trie": prefix_trie.sql(),
    "op13_chat_format": chat_format.sql(),
}
