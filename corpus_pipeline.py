"""The corpus pipeline: a chain of operators over `documents`, each stage written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playbill.llm import bpe, langid, mixing, passages, setjoin
from playbill.llm.common import ship, table
from playbill.llm.queries import language_model
from playbill.session import scratch_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go."""
    ship(spark)
    return langid.accepted(docs, language_model(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, Jaccard 0.8 or more."""
    ship(spark)
    return setjoin.one_of_each(docs, words=5, num=80, den=100)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has too are cut out."""
    ship(spark)
    return passages.without_repeats(docs, length_column="n_chars")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in shards."""
    return mixing.taken_rows(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with their digests and the check of the way back."""
    ship(spark)
    vocabulary = Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()
    # smaller caches than by default: what earlier stages left in the executors takes its room
    return bpe.encoded(docs, vocabulary, public_tokenizers.PATTERN, max_states=60_000, max_pieces=120_000)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", bpe_encoding),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from `documents`. What a stage wrote goes when the next one
    has written its own; the last stage's files stay, as the result is read from them."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            folder = spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return docs
