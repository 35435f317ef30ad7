"""Helpers that several operators share: word hashes, reading tables, bounded broadcasts, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.session import cut_lineage, scratch_dir

ROOT = str(Path(__file__).resolve().parents[2])
# A side is broadcast only if its rows, counted first, take no more than this; else it is shuffled.
BROADCAST_BYTES = 32 << 20
# What goes to a Python worker at once. Spark's own limit of 64 MB is, with long texts, all of a
# partition, which the JVM and the worker then hold beside what they work on.
BATCH_CONF, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 2 << 20
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Let Python workers started on this machine find the package (a cluster has it installed or
    gets it with --py-files), and get small batches, unless the session has its own limit."""
    if spark.conf.get(BATCH_CONF).strip("bB") == str(BATCH_DEFAULT):
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_hash_mod(column: str, divisor: int):
    """crc32 of an id written as text, modulo the divisor: the fold of a row. NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def join_bounded(big: DataFrame, small: DataFrame, on: list[str], how: str, row_bytes: int) -> DataFrame:
    """Join with a broadcast of `small` if its counted size is within BROADCAST_BYTES, else with a
    shuffle. The rows are the same either way. `small` should be cheap to count (checkpointed)."""
    if small.count() * row_bytes <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return big.join(small, on, how)


def join_lists(big: DataFrame, small: DataFrame, on: list[str], how: str, lists: dict[str, int]) -> DataFrame:
    """`join_bounded` where the rows of `small` hold lists, whose items are counted: `lists` has the
    bytes of an item by column."""
    items = [F.coalesce(F.sum(F.size(F.coalesce(column, F.array()))), F.lit(0)) * size for column, size in lists.items()]
    rows, taken = small.select(F.count("*"), sum(items, F.lit(0))).first()
    if rows * (48 + 16 * len(lists)) + taken <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return big.join(small, on, how)


def among(big: DataFrame, on: list[str], keys: DataFrame, others: DataFrame, row_bytes: int = 16) -> DataFrame:
    """The rows of `big` with one of the keys. Where `others` are the keys it may have besides and are
    fewer, rows with one of these are left out instead: rows of `big`, which may be texts, stay where they are if
    either is small. Neither has repeated or NULL keys; both should be cheap to count."""
    if others.count() < keys.count():
        return join_bounded(big, others, on, "left_anti", row_bytes)
    return join_bounded(big, keys, on, "left_semi", row_bytes)


def slices(sizes: list[int], rows: int, total: int) -> Iterator[tuple[int, int]]:
    """Start and length of runs of at most `rows` items whose sizes add up to `total` at most; a
    larger item is a run of its own."""
    start = taken = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start == rows or taken + size > total):
            yield start, i - start
            start, taken = i, 0
        taken += size
    if len(sizes) > start:
        yield start, len(sizes) - start


def of_size(batches: Iterator[pa.RecordBatch], column: int, rows: int, total: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most so many rows and bytes of one column; a larger row is a
    slice of its own."""
    for batch in batches:
        lists = batch.column(column)
        width = lists.offsets.to_numpy() if pa.types.is_list(lists.type) else None
        sizes = np.diff(width) * 8 if width is not None else pc.binary_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        for start, n in slices(sizes.tolist(), rows, total):
            yield batch.slice(start, n)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Looking them up in a dictionary takes longer, and memory of the worker."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def release() -> None:
    """Give back the memory that this worker has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function of batches, which releases memory at its end: Spark keeps Python workers
    for later stages, and idle ones would hold what they have seen beside those at work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            release()

    return run


BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that sums of hashes spread over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for every window of n words; the order of the words counts."""
    total = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        total *= BASE
        total += hashes[i : len(hashes) - n + 1 + i]
    return mix(total)


def lower_words(text: bytes | None) -> list[bytes]:
    """Words between the six white-space characters of ASCII, A-Z in lower case."""
    return text.lower().split() if text else []


def shingles(words: list[bytes], n: int) -> np.ndarray:
    """The sorted distinct n-word shingles as int64 hashes; a shorter text is one shingle as a
    whole, a text without words has none."""
    if not words:
        return np.empty(0, np.int64)
    hashes = word_hashes(words)
    if len(words) < n:
        found = mix(grams(hashes, len(words)) + np.uint64(len(words)))
    else:
        found = np.unique(grams(hashes, n))
    return np.sort(found.view(np.int64))


@contextmanager
def stored(df: DataFrame, name: str, by: str, compression: str = "snappy"):
    """The rows of df, written once as Parquet in the shared scratch folder, a folder for each value
    of `by`, and read from there. The files go when the block ends: what is made from them has to be
    checkpointed or written before."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.partitionBy(by).parquet(path, compression=compression)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def all_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, or only edges from above."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b) of longs: the smallest node it reaches.

    Alternating large and small star contraction: every round is a few aggregates and joins of
    edges, cut by a checkpoint in the shared folder; it ends when each node has one edge, to the
    least of its component. A node
    with very many neighbours is only aggregated (with partial sums before the shuffle) and joined
    with one row per node, which AQE may split.
    """
    edges = edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
    edges = cut_lineage(edges)
    while not all_stars(edges):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        large = both.join(least, "a").where("b > a").selectExpr("b AS a", "m AS b").where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = small.selectExpr("b AS a", "m AS b").where("a <> b").union(least.selectExpr("a", "m AS b")).distinct()
        edges = cut_lineage(edges)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.selectExpr("a AS node", "b AS component").union(roots.selectExpr("node", "node AS component"))
