"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.llm import alignment, bpe, chat, divergence, langid, maintext, mixing, passages, quality, setjoin, topk, toxicity, urls
from playbill.llm.common import id_hash_mod, table


def language_model(docs: DataFrame) -> langid.Model:
    """Fitted on labelled documents outside the held-out fold."""
    return langid.fit(docs.where(id_hash_mod("doc_id", 3) != 1))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document. No SQL: tested by accuracy on the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identified(docs, language_model(docs))
    held_out = F.coalesce(id_hash_mod("doc_id", 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page. No SQL: tested on pages with known articles."""
    return maintext.extracted(table(spark, sf_dir, "pages"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document. No SQL: tested against the tiktoken library."""
    vocabulary = Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()
    return bpe.encoded(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN, ids=False)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document. No SQL: tested by held-out labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.scored(docs, toxicity.fit(docs, labels.where(id_hash_mod("doc_id", 5) != 0)))
    held_out = F.coalesce(id_hash_mod("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_offending")


def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document. No SQL: the draw is by hashes; tested by its properties."""
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "mix.shards")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document. No SQL: tested against all pairs of a fixture."""
    return setjoin.near_copies(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest scores of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urls.judged(table(spark, sf_dir, "pages"), urls.rule_table(spark, urls.RULES))


def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated passage that a document loses, with the document that keeps it. No SQL: tested
    against a brute-force search."""
    return passages.removals(table(spark, sf_dir, "documents"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text and loss mask."""
    turns = chat.with_probe(spark, table(spark, sf_dir, "conversations"))
    return chat.digests(chat.formatted(turns))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in every document. No SQL: tested against brute force."""
    byte_level, pieces = (Path(public_tokenizers.path(name)).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(table(spark, sf_dir, "documents"), byte_level, pieces)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of a language, and the terms that set a source apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_main_text": op2_main_text,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_toxicity": op4_toxicity,
    "op5_host_quality": op5_host_quality,
    "op6_source_mix": op6_source_mix,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_url_rules": op9_url_rules,
    "op10_passage_dedup": op10_passage_dedup,
    "op11_chat_format": op11_chat_format,
    "op12_token_alignment": op12_token_alignment,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES = {
    "op5_host_quality": quality.ORACLE,
    "op8_exact_top_k": topk.ORACLE,
    "op9_url_rules": urls.ORACLE,
    "op11_chat_format": chat.oracle(),
    "op13_source_divergence": divergence.ORACLE,
}
