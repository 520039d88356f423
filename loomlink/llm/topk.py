"""Exact top-k by inner product: vectors in order of length, rotated partial sums, Cauchy-Schwarz bounds.

Components become integers, floor(scale * x). All vectors are rotated by the eigenvectors of their second moments (the
right singular vectors), so that the first components hold most of each product. Candidates are stored once, in blocks in
order of descending length, dealt by ranges of it, with their rotated heads and the lengths of what is left. A query's
bar is its k-th best product with the longest vectors of all (SEEDS of them, a fixed number) and rises as blocks are
read. Blocks whose longest vector is under the bar of every query are not read at all. In a block, rows whose length
times the query's is under the bar end the scan, as all later ones are shorter; of the others, those whose partial
product plus the product of the lengths of what is left of both is under the bar are passed over. The rest get their
exact integer product.

Queries are taken in turns of at most TURN blocks of BLOCK, which is all that is broadcast and all that a task holds, at
any number of queries; every turn scans the candidates in all tasks. Each task gives at most k rows a query, and a ranked
window takes the best. The dim rows of the moments are summed on executors; one row of each reaches the driver.

Defined results: vectors that are null, or hold null or non-finite components, take no part. Shorter vectors count as
padded with zeros. A row is a query if its vec_id is divisible by `every`; candidates are all rows of another vec_id,
repeated rows each. Rows with a null vec_id take no part. Products beyond 64 bits are held at its ends. Ties go to the
smaller vec_id. An empty table gives an empty one. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomlink.llm.common import partitions, stored, tables, tidy

SCALE, EVERY, K = 1024, 100, 10
BLOCK, SEEDS, FIRST = 4096, 2048, 16
#: Blocks of queries that are searched for at once.
TURN = 16
#: Integers up to this give exact products in double precision.
EXACT = float(1 << 53)


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, dim, norm, vector): rounded vectors as blobs of doubles, without those that take no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k is None or v is None or any(x is None for x in v):
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(x * scale)
                if np.isfinite(x).all():
                    rows.append((k, len(x), float(np.sqrt(np.square(x / 1e150).sum()) * 1e150) if np.abs(x).max(initial=0) > 1e100 else float(np.sqrt(np.square(x).sum())), x.tobytes()))
            kinds = (pa.int64(), pa.int32(), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kinds[j]) for j in range(4)], ["id", "dim", "norm", "vector"])

    return df.select(F.col(id_col).cast("long"), vector_col).mapInArrow(run, "id long, dim int, norm double, vector binary")


def matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(blobs), dim))
    for k, b in enumerate(blobs):
        out[k, : len(b) // 8] = np.frombuffer(b)
    return out


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the sum of v v' over all rows, largest eigenvalue first; dim rows of sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = matrix(batch.column(0).to_pylist(), dim)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(dim)
        for blob in table.column("sums").to_pylist():
            total += np.frombuffer(blob)
        return pa.table([table.column("i").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["i", "sums"])

    moments = np.zeros((dim, dim))
    for r in vectors.select("vector").mapInArrow(run, "i int, sums binary").groupBy("i").applyInArrow(add, "i int, sums binary").toLocalIterator():
        moments[r["i"]] = np.frombuffer(r["sums"])
    if not np.isfinite(moments).all():
        return np.eye(dim)
    return np.linalg.eigh(moments)[1][:, ::-1].copy()


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of rows, exact."""
    if not len(a):
        return np.zeros(0, np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * max(1, a.shape[1]) < EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
    return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in whole], np.int64)


def bars(ids: np.ndarray, queries: np.ndarray, k: int, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Each query's k-th best product with the seeds, or minus infinity."""
    bar = np.full(len(ids), -np.inf)
    for q in range(len(ids)):
        own = seeds[0] != ids[q]
        if own.sum() >= k:
            scores = exact(seeds[1][own], np.broadcast_to(queries[q], (int(own.sum()), queries.shape[1])))
            bar[q] = np.partition(scores, -k)[-k]
    return bar


class Best:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, heads: np.ndarray, rest: np.ndarray, bar: np.ndarray, k: int):
        self.ids, self.queries, self.k, self.heads, self.rest = ids, queries, k, heads, rest
        self.norm = np.sqrt(np.square(queries).sum(1))
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.bar = bar.copy()

    def scan(self, ids: np.ndarray, norms: np.ndarray, heads: np.ndarray, rest: np.ndarray, vectors: np.ndarray) -> None:
        """Takes in a block of candidates in order of descending norm."""
        for q in range(len(self.ids)):
            slack = 1e-6 + 1e-9 * self.norm[q] * (norms[0] if len(norms) else 0)
            n = int(np.searchsorted(-(norms * self.norm[q] + slack), -self.bar[q], "right")) if self.norm[q] else len(norms)
            if not n:
                continue
            bound = heads[:n] @ self.heads[q] + rest[:n] * self.rest[q] + slack
            near = np.flatnonzero((bound >= self.bar[q]) & (ids[:n] != self.ids[q])) if np.isfinite(bound).all() else np.flatnonzero(ids[:n] != self.ids[q])
            if not len(near):
                continue
            scores = exact(vectors[near], np.broadcast_to(self.queries[q], (len(near), vectors.shape[1])))
            keep = scores >= self.bar[q] if np.isfinite(self.bar[q]) else np.ones(len(scores), bool)
            if keep.any():
                best = sorted([*self.found[q], *zip((-scores[keep]).tolist(), ids[near[keep]].tolist(), strict=True)])[: self.k]
                self.found[q] = best
                if len(best) == self.k:
                    self.bar[q] = max(self.bar[q], -best[-1][0])


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k candidates of the highest integer inner product."""
    spark = df.sparkSession
    before = tables(spark)
    vectors = stored(integers(df, id_col, vector_col, scale), "vectors")
    size = vectors.agg(F.max("dim").alias("dim"), F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    dim = max(size["dim"] or 0, 1)
    first = min(FIRST, dim)
    longest = vectors.orderBy(F.desc("norm"), "id").limit(SEEDS).select("id", "vector").collect()
    seeds = spark.sparkContext.broadcast((np.array([r["id"] for r in longest], np.int64), matrix([bytes(r["vector"]) for r in longest], dim), rotation(vectors, dim)))

    def blocks(batches: Iterator[pa.RecordBatch], asking: bool) -> Iterator[pa.RecordBatch]:
        *seed, turn = seeds.value
        held, n = [], 0

        def out(table: pa.Table) -> pa.RecordBatch:
            ids, x = table.column("id").to_numpy(), matrix(table.column("vector").to_pylist(), dim)
            norms, rotated = table.column("norm").to_numpy(), x @ turn
            rest = np.sqrt(np.square(rotated[:, first:]).sum(1))
            bar = bars(ids, x, k, seed) if asking else np.zeros(0)
            lead = float(norms[0])
            if asking:  # the length under which no vector can pass any bar of the block
                slack = 1e-5 + 1e-8 * norms * (np.sqrt(np.square(seed[1]).sum(1)).max(initial=0) if len(seed[0]) else 0)
                lead = float(np.where(norms > 0, (bar - slack) / np.where(norms > 0, norms, 1), -np.inf).min())
                lead = lead if np.isfinite(lead) else -1.0
            blobs = [pa.array([c.tobytes()], pa.binary()) for c in (ids, norms, np.ascontiguousarray(rotated[:, :first]), rest, x, bar)]
            return pa.RecordBatch.from_arrays([pa.array([lead]), *blobs], names)

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= BLOCK:
                whole = pa.Table.from_batches(held)
                yield out(whole.slice(0, BLOCK))
                held, n = whole.slice(BLOCK).to_batches(), n - BLOCK
        if n:
            yield out(pa.Table.from_batches(held))

    names = ["lead", "ids", "norms", "heads", "rest", "vectors", "bars"]
    shape = "lead double, " + ", ".join(f"{c} binary" for c in names[1:])
    n_tasks = max(partitions(spark), ceil(size["n"] / (16 * BLOCK)))
    by_length = vectors.repartitionByRange(n_tasks, F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id")
    candidates = stored(by_length.mapInArrow(lambda x: blocks(x, False), shape).drop("bars"), "blocks")
    asking = vectors.where(F.col("id") % every == 0).dropDuplicates(["id", "vector"])
    turns = max(1, ceil(size["q"] / (BLOCK * TURN)))
    asking = asking.repartitionByRange(max(1, ceil(size["q"] / BLOCK)), F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id")
    asking = asking.mapInArrow(lambda x: blocks(x, True), shape).withColumn("turn", F.pmod(F.spark_partition_id(), F.lit(turns)))
    asking = stored(asking.toDF(*(f"q_{c}" for c in names), "turn"), "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[bytes, bytes], Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = row["q_ids"], row["q_vectors"]
                if key not in best:
                    part = [np.frombuffer(row[f"q_{c}"]) for c in ("vectors", "heads", "rest", "bars")]
                    best[key] = Best(np.frombuffer(key[0], np.int64), part[0].reshape(-1, dim), part[1].reshape(-1, first), part[2], part[3], k)
                part = [np.frombuffer(row[c]) for c in ("norms", "heads", "rest", "vectors")]
                best[key].scan(np.frombuffer(row["ids"], np.int64), part[0], part[1].reshape(-1, first), part[2], part[3].reshape(-1, dim))
        rows = [(int(b.ids[q]), mark, i, -s) for b in best.values() for q in range(len(b.ids)) if b.found[q] for mark in [hash_(b.queries[q])] for s, i in b.found[q]]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], ["query_id", "mark", "vec_id", "score"])

    parts = []
    for turn in range(turns):
        own = asking.where(F.col("turn") == turn).drop("turn")
        least = own.agg(F.min("q_lead")).first()[0]
        if least is None:
            continue
        met = candidates.where(F.col("lead") >= least).crossJoin(F.broadcast(own))  # about TURN blocks of queries
        met = met.mapInArrow(run, "query_id long, mark long, vec_id long, score long")
        parts.append(met if turns == 1 else stored(met, "met"))
    if not parts:
        parts = [spark.createDataFrame([], "query_id long, mark long, vec_id long, score long")]
    rank = F.row_number().over(W.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    ranked = reduce(DataFrame.union, parts).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    best = stored(ranked, "best")
    tidy(spark, before, best)
    return best


def hash_(v: np.ndarray) -> int:
    """Tells apart queries of one id."""
    return xxhash.xxh3_64_intdigest(v.tobytes()) >> 1


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op9_exact_top_k": op9_exact_top_k}
SQL = {
    "op9_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
}
