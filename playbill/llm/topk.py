"""Exact top-k by inner product: distributed histogram selection.

Queries and candidates meet in blocks (a block of queries with a block of candidates is one row), so
all scores are computed by matrix products and none is stored. For every query a global histogram
of its scores is refined round by round: each round counts the scores in the equal bins of the
query's current interval, in every block, sums the counts, and keeps the bin that holds the k-th
highest score, until the interval is one score wide. A last pass gives out the scores
above the k-th and, of those equal to it, the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.common import ship
from playbill.session import cut_lineage

SCALE = 256.0
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
SLICE = 2  # blocks of candidates that a block of queries meets in one task
BINS = 256
EXACT = 2.0**53


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by floating-point matrix products where every sum stays below
    2^53, else by 64-bit integers."""
    if not len(q) or not len(c):
        return np.zeros((len(q), len(c)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < EXACT:
        return q @ c.T
    return q.astype(np.int64) @ c.T.astype(np.int64)


def packed(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, dim, data): floor(256 x) of every component as doubles in one binary. Vectors that
    are NULL or empty or hold a NULL or non-finite component are left out, as are NULL ids."""
    v = F.col(vector_column)
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_column).isNotNull() & usable).select(F.col(id_column).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets, values = lists.offsets.to_numpy(), np.floor(lists.values.to_numpy() * SCALE)
            data = [values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets).astype(np.int32)), pa.array(data, pa.binary())], ["vec_id", "dim", "data"])

    return rows.mapInArrow(pack, "vec_id long, dim int, data binary")


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(dim, name, ids, data): up to `size` vectors of one dimension in one row, as they lie in the
    partitions, without a shuffle."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list[int], list[bytes]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, data = waiting.pop(dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([b"".join(data)], pa.binary())], ["dim", f"{name}_ids", name])

        for batch in batches:
            for vec_id, dim, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, parts = waiting.setdefault(dim, ([], []))
                ids.append(vec_id)
                parts.append(data)
                if len(ids) == size:
                    yield out(dim)
        for dim in list(waiting):
            yield out(dim)

    return rows.mapInArrow(gather, f"dim int, {name}_ids binary, {name} binary")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every id divisible by `every`, the k rows of the highest
    integer inner product, ties to the smaller id; all other rows if there are fewer.

    Rows with the query's own id are no candidates of it. A repeated id is a candidate as often as
    it comes, and one query: the one with the least vector. Vectors are compared with vectors of the
    same length only. Vectors that are NULL, empty, or hold a NULL or non-finite component take no
    part. Scores are below 2^61 in size. An empty table gives no rows.
    """
    ship(vectors.sparkSession)
    rows = packed(vectors, id_column, vector_column)
    chosen = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "data")).alias("v")).select("vec_id", "v.dim", "v.data")
    # a block of queries is a group of fixed size by id, made once
    n_queries = chosen.count()
    n_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    chosen = chosen.withColumn("q_block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    queries = cut_lineage(chosen.repartition(n_blocks, "q_block").sortWithinPartitions("q_block", "dim", "vec_id"))
    candidates = cut_lineage(blocks(rows, CANDIDATE_BLOCK, "c"))
    # the table's blocks are dealt to slices, and a block of queries goes to every slice: however few the
    # queries are, they do not meet the whole table in one task
    n_slices = max(1, -(-candidates.count() // SLICE))
    place, tasks = ["q_block", "dim", "slice"], min(n_blocks * n_slices, 100_000)
    dealt = candidates.withColumn("slice", F.pmod(F.xxhash64("c_ids"), F.lit(n_slices)).cast("int"))
    dealt = dealt.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).repartition(tasks, *place)

    def matrix(data: bytes, dim: int) -> np.ndarray:
        return np.frombuffer(data, np.float64).reshape(-1, dim)

    def met(state: DataFrame) -> DataFrame:
        """Each block of candidates with each block of queries and the queries' intervals."""
        sides = state.groupBy("q_block", "dim").agg(F.sort_array(F.collect_list(F.struct("vec_id", "low", "width", "left", "data"))).alias("q"))
        sides = sides.select("q_block", "dim", F.transform("q", lambda x: x["vec_id"]).alias("q_ids"), F.transform("q", lambda x: x["low"]).alias("low"),
                             F.transform("q", lambda x: x["width"]).alias("width"), F.transform("q", lambda x: x["left"]).alias("left"), F.array_join(F.transform("q", lambda x: F.hex(x["data"])), "").alias("q"))
        sides = sides.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1)))).repartition(tasks, *place)
        return dealt.join(sides.hint("merge"), place).select("dim", "q_ids", "low", "width", "left", F.unhex("q").alias("q"), "c_ids", "c")

    def scored(batch: pa.RecordBatch) -> Iterator[tuple]:
        for i in range(len(batch)):
            dim, q_ids, low, width, left, q, c_ids, c = (column[i] for column in batch.columns)
            numbers = [np.array(x.values) for x in (q_ids, low, width, left)]
            ids = np.frombuffer(c_ids.as_py(), np.int64)
            s = products(matrix(q.as_py(), dim.as_py()), matrix(c.as_py(), dim.as_py()))
            yield *numbers, ids, s

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per query the counts of its highest bins, down to the one with the block's own k-th: the
        k-th of all can not be lower."""
        for batch in batches:
            for q_ids, low, width, left, ids, s in scored(batch):
                n = len(q_ids)
                step = -(-width // BINS)
                bins = np.floor_divide(s - low[:, None], step[:, None])
                inside = (s >= low[:, None]) & (s < (low + width)[:, None]) & (ids[None, :] != q_ids[:, None])
                flat = (bins + np.arange(n)[:, None] * BINS)[inside].astype(np.int64)
                counts = np.bincount(flat, minlength=n * BINS).reshape(n, BINS)
                above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
                where, at = np.nonzero((counts > 0) & (above < left[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[where], pa.int64()), pa.array(at, pa.int64()), pa.array(counts[where, at], pa.int64())], ["vec_id", "bin", "n"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, low, _, left, ids, s in scored(batch):
                other = ids[None, :] != q_ids[:, None]
                out_q, out_c, out_s = [], [], []
                order = np.argsort(ids, kind="stable")
                for i, j in zip(*np.nonzero((s > low[:, None]) & other), strict=True):
                    out_q.append(q_ids[i])
                    out_c.append(ids[j])
                    out_s.append(int(s[i, j]))
                ties = ((s == low[:, None]) & other)[:, order]
                first = ties & (np.cumsum(ties, axis=1) <= left[:, None])
                for i, j in zip(*np.nonzero(first), strict=True):
                    out_q.append(q_ids[i])
                    out_c.append(ids[order[j]])
                    out_s.append(int(low[i]))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (out_q, out_c, out_s)], ["query_id", "vec_id", "score"])

    # |score| <= norm of the query * greatest norm of the candidates, by length of vectors
    norms = (queries.select("dim", "data").unionByName(rows.select("dim", "data"))).mapInArrow(norm_rows, "dim int, norm double").groupBy("dim").agg(F.max("norm").alias("norm"))
    reach = F.ceil(F.least(F.col("norm") * F.col("norm") * (1 + 1e-9), F.lit(2.0**61))) + 1
    state = queries.join(F.broadcast(norms), "dim").select(
        "q_block", "dim", "vec_id", "data", (-reach).cast("long").alias("low"), (2 * reach + 1).cast("long").alias("width"), F.lit(k).cast("long").alias("left"))
    state = cut_lineage(state)
    widest = state.agg(F.max("width")).first()[0] or 0
    while widest > 1:
        counts = met(state).mapInArrow(count, "vec_id long, bin long, n long").groupBy("vec_id", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("vec_id").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0))
        # the bin where the count from above reaches what is left to find; with fewer scores, the lowest
        found = counts.withColumn("above", above).join(state.select("vec_id", "left"), "vec_id")
        found = found.groupBy("vec_id").agg(
            F.max(F.when(F.col("above") >= F.col("left"), F.struct("bin", (F.col("above") - F.col("n")).alias("over")))).alias("hit"),
            F.min(F.struct("bin", (F.col("above") - F.col("n")).alias("over"))).alias("lowest"))
        found = found.select("vec_id", F.coalesce("hit", "lowest").alias("at"))
        step = F.expr(f"(width + {BINS - 1}) div {BINS}")
        state = state.join(found, "vec_id", "left").select(
            "q_block", "dim", "vec_id", "data",
            (F.col("low") + F.coalesce(F.col("at.bin"), F.lit(0)) * step).alias("low"),
            F.when(F.col("at").isNull(), 1).otherwise(F.least(step, F.col("width") - F.col("at.bin") * step)).cast("long").alias("width"),
            (F.col("left") - F.coalesce(F.col("at.over"), F.lit(0))).alias("left"))
        state = cut_lineage(state)
        widest = state.agg(F.max("width")).first()[0]
    result = met(state).mapInArrow(choose, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def norm_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        norms = [float(np.linalg.norm(np.frombuffer(data, np.float64))) for data in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(norms, pa.float64())], ["dim", "norm"])


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([x[1] * x[2] FOR x IN list_zip(q.w, c.w)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5
"""
