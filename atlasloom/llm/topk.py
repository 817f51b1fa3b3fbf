"""Exact top-k inner products over an impact-ordered index, score at a time.

Vectors become integers, floor(256 x) of each component. The index has one row per block of up to BLOCK
vectors and CELLS cells (every vector is in exactly one block, where its scan partition put it): per dimension, the
block's postings in ascending order of the component, cut into LEVELS segments of equal quantised impact.

For a query the segments of a block are processed by descending bound on |q_d * v_d|; accumulators take
the exact products. From time to time the k best accumulators are scored exactly, which proves a
threshold; a vector whose accumulator plus all that unprocessed segments could still add lies below it
cannot be among the k best. Processing stops once those that remain possible are few, and these are scored
exactly; without such a proof it goes on to the last segment. Nothing is approximate.

Every index block meets every block of queries, as exact search needs. A unit of work is an index block with up to
CHUNK blocks of QUERIES queries: units are dealt by their two numbers, and within a partition an index block is read
once, before its queries, which then stream past it. Neither side is broadcast or written into the plan, and each
pair of blocks returns k rows per query; the best k of these are ranked.

Vectors that are null, or hold null or non-finite components, take no part. Empty vectors have the score 0 with one
another. Vectors with a component of 2**23 or more are kept as doubles in blocks of their own, and any pair of blocks whose sums could leave 64
bits is scored in exact Python integers, row by row. A score among the k best that no long can hold ends the query with an error. Vectors are compared with queries of their own length alone. A query's own row means
all rows with its id; ties go to the smaller id; repeated rows are candidates each; a null id takes no part. Query rows that share an
id are one query, for which a candidate has the best of its scores.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import beside, bounded, claim, materialize, workspace

BLOCK, CELLS, QUERIES, CHUNK, LEVELS, FEW = 1 << 14, 1 << 20, 512, 64, 8, 64
#: Partitions at most that units are dealt to.
UNITS = 1 << 15


LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _integers(ids: pa.Array, vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix of floor(256 x)) of the rows that take part, by length; rows with large components apart, as doubles x."""
    if not len(vectors):
        return
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values.cast(pa.float64())
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    good = np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid())
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good &= bad[offsets[1:]] == bad[offsets[:-1]]
    large = np.concatenate([[0], np.cumsum(~(np.abs(flat) < 1 << 23))])
    large = large[offsets[1:]] != large[offsets[:-1]]
    own = ids.fill_null(0).to_numpy().astype(np.int64)
    for d in np.unique(size[good]).tolist():
        rows = np.flatnonzero(good & ~large & (size == d))
        if len(rows):
            yield own[rows], np.floor(256 * flat[offsets[rows][:, None] + np.arange(d)]).astype(np.int64)
        rows = np.flatnonzero(good & large & (size == d))
        if len(rows):
            yield own[rows], flat[offsets[rows][:, None] + np.arange(d)]


def _packed(cells: np.ndarray) -> bytes:
    return cells.astype("<f8" if cells.dtype == np.float64 else "<i4").tobytes()


def _exact(x: float) -> int:
    """floor(256 x) of any finite double."""
    return math.floor(256 * x) if abs(x) < 1 << 60 else 256 * int(x)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    """n cells: int64 of narrow ones, Python integers of wide ones."""
    if len(raw) == 4 * n:
        return np.frombuffer(raw, "<i4").astype(np.int64)
    return np.array([_exact(x) for x in np.frombuffer(raw, "<f8").tolist()], object)


def _blocks(vectors: DataFrame, path: str) -> DataFrame:
    """(part, k, dim, ids, cells, postings): cells and postings by dimension, the postings in ascending order of their cells; k: the block's place in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("topk")
        held: dict[tuple[int, bool], list] = {}
        part, k = TaskContext.get().partitionId(), -1

        def flush(kind: tuple[int, bool]) -> pa.RecordBatch:
            nonlocal k
            ids, cells = (np.concatenate(x) for x in zip(*held.pop(kind), strict=True))
            d, wide = kind
            postings = np.zeros(0, "<u2") if wide else np.argsort(cells, axis=0, kind="stable").T.astype("<u2")
            k += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([k], pa.int64()), pa.array([d], pa.int32()), pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([_packed(cells.T)], pa.binary()), pa.array([postings.tobytes()], pa.binary())],
                names=["part", "k", "dim", "ids", "cells", "postings"],
            )

        for batch in batches:
            for ids, cells in _integers(batch.column(0), batch.column(1)):
                d = cells.shape[1], cells.dtype == np.float64
                step = max(1, min(BLOCK, CELLS // max(1, cells.shape[1])) // 4)
                for low in range(0, len(ids), step):
                    held.setdefault(d, []).append((ids[low : low + step], cells[low : low + step]))
                    if sum(len(x) for x, _ in held[d]) > 3 * step:
                        yield flush(d)
        for d in list(held):
            yield flush(d)

    return materialize(vectors.mapInArrow(run, "part int, k long, dim int, ids binary, cells binary, postings binary"), path)


def _numbered(blocks: DataFrame, path: str) -> tuple[DataFrame, int]:
    """(the blocks with a number from 0 in place of part and k, how many there are)."""
    totals = blocks.groupBy("part").agg(F.count("*").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = materialize(totals.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first")), path)
    return beside(blocks, first, "part").withColumn("number", F.col("first") + F.col("k")).drop("part", "k", "first"), blocks.count()


def _query_blocks(queries: DataFrame, path: str) -> DataFrame:
    """(part, k, dim, ids, cells): up to QUERIES queries and CELLS cells each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("topk")
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for ids, cells in _integers(batch.column(0), batch.column(1)):
                step = max(1, min(QUERIES, CELLS // max(1, cells.shape[1])))
                for low in range(0, len(ids), step):
                    own = slice(low, low + step)
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([k], pa.int64()), pa.array([cells.shape[1]], pa.int32()), pa.array([ids[own].astype("<i8").tobytes()], pa.binary()), pa.array([_packed(cells[own])], pa.binary())], names=["part", "k", "dim", "ids", "cells"])
                    k += 1

    return materialize(queries.mapInArrow(run, "part int, k long, dim int, ids binary, cells binary"), path)


class Block:
    def __init__(self, ids: bytes, cells: bytes, postings: bytes, dim: int):
        self.ids, n = np.frombuffer(ids, "<i8"), len(ids) // 8
        self.cells = _unpacked(cells, n * dim).reshape(dim, n)
        self.rows = np.ascontiguousarray(self.cells.T)
        self.most = int(np.abs(self.cells).max(initial=0))
        self.early = self.whole = 0  # queries that a proof ended early, and queries that saw every segment
        if self.cells.dtype == object or dim == 0:
            return
        postings = np.frombuffer(postings, "<u2").reshape(dim, n).astype(np.int64)
        self.dim, self.low, self.high, self.at, self.values = [], [], [], [], []
        for d in range(dim):
            own = self.cells[d][postings[d]].astype(np.int64)
            step = max(1, -(-int(own[-1] - own[0] + 1) // LEVELS))
            cut = np.concatenate([[0], np.flatnonzero(np.diff((own - own[0]) // step)) + 1, [n]])
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                self.dim.append(d)
                self.low.append(own[a])
                self.high.append(own[b - 1])
                self.at.append(postings[d][a:b])
                self.values.append(own[a:b])
        self.dim, self.low, self.high = (np.array(x) for x in (self.dim, self.low, self.high))
        self.size = np.array([len(x) for x in self.at])

    def best(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, rows) of the k best rows without own_id, ties to the smaller id."""
        if not len(query):
            rows = np.flatnonzero(self.ids != own_id)
            rows = rows[np.argsort(self.ids[rows], kind="stable")][:k]
            return np.zeros(len(rows), np.int64), rows
        if query.dtype == object or self.cells.dtype == object or self.most * int(np.abs(query).max()) * len(query) >= 1 << 61:
            return self._best_of_all(query, own_id, k)
        n, weight = len(self.ids), query[self.dim]
        ends = weight * self.low, weight * self.high
        least, most = np.minimum(*ends), np.maximum(*ends)
        order = np.argsort(-np.maximum(-least, most), kind="stable")
        worth = order[np.maximum(-least, most)[order] > 0]
        done = np.cumsum(self.size[worth])
        stops = np.searchsorted(done, done[-1] * np.array([0.5, 0.65, 0.75, 0.82, 0.88, 0.93, 0.97])).tolist() if len(worth) else []
        total, rest, first = np.zeros(n, np.int64), np.flatnonzero(self.ids != own_id), 0
        for stop in stops:
            for s in worth[first:stop].tolist():
                total[self.at[s]] += weight[s] * self.values[s]
            first = max(first, stop)
            more, now = np.zeros(len(query), np.int64), worth[first:]
            np.maximum.at(more, self.dim[now], most[now])
            if len(rest) <= k:
                break
            held = total[rest]
            top = rest[np.argpartition(held, -k)[-k:]]
            proof = (self.rows[top] @ query).min()
            possible = rest[held + more.sum() >= proof]
            if len(possible) <= max(FEW, n >> 6):
                rest = possible
                self.early += 1
                break
        else:
            self.whole += 1
            for s in worth[first:].tolist():
                total[self.at[s]] += weight[s] * self.values[s]
            if len(rest) > k:
                held = total[rest]
                rest = rest[held >= np.partition(held, -k)[-k]]
        exact = self.rows[rest] @ query
        at = np.lexsort((self.ids[rest], -exact))[:k]
        return exact[at], rest[at]

    def _best_of_all(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """best() in Python integers; scores that no long can hold become LOWEST or HIGHEST."""
        q = [int(x) for x in query.tolist()]
        scored = ((-sum(a * b for a, b in zip(row.tolist(), q, strict=True)), i, at) for at, (row, i) in enumerate(zip(self.rows, self.ids.tolist(), strict=True)) if i != own_id)
        top = heapq.nsmallest(k, scored)
        return np.array([min(max(-s, LOWEST), HIGHEST) for s, _, _ in top], np.int64), np.array([at for _, _, at in top], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, <id_col>, score): for each query its k best rows of vectors, from rank 1."""
    path = workspace(vectors.sparkSession)
    index = _blocks(bounded(vectors).select(vectors[id_col].cast("long"), vectors[vector_col].cast("array<double>")), f"{path}/index")
    asked = queries.select(queries[id_col].cast("long").alias("id"), queries[vector_col].cast("array<double>").alias("v")).distinct()
    asked = materialize(asked, f"{path}/asked")
    index, n = _numbered(index, f"{path}/index-first")
    packs, m = _numbered(_query_blocks(asked, f"{path}/queries"), f"{path}/queries-first")
    chunks = -(-m // CHUNK)
    if not n or not m:
        return vectors.sparkSession.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    left = index.withColumnRenamed("number", "block").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    right = packs.withColumn("chunk", F.floor(F.col("number") / CHUNK)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    units = left.select("block", "chunk", F.lit(-1).cast("long").alias("place"), "dim", "ids", "cells", "postings")
    units = units.unionByName(right.select("block", "chunk", F.col("number").alias("place"), "dim", "ids", "cells", F.lit(None).cast("binary").alias("postings")))
    units = units.repartition(min(3 * n * chunks, UNITS), "block", "chunk").sortWithinPartitions("block", "chunk", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("topk")
        number, dim, block = -1, -1, None
        for batch in batches:
            for i in range(batch.num_rows):
                d, ids, cells = (batch.column(c)[i].as_py() for c in ("dim", "ids", "cells"))
                if batch.column("place")[i].as_py() < 0:
                    number, dim, block = batch.column("block")[i].as_py(), d, Block(ids, cells, batch.column("postings")[i].as_py(), d)
                elif d == dim:
                    ids = np.frombuffer(ids, "<i8")
                    found = [block.best(q, own, k) for q, own in zip(_unpacked(cells, len(ids) * dim).reshape(len(ids), dim), ids.tolist(), strict=True)]
                    counts, rows = [len(s) for s, _ in found], np.concatenate([x for _, x in found])
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts)), pa.array(block.ids[rows]), pa.array(np.concatenate([s for s, _ in found])), pa.array(number * BLOCK + rows)], names=["query_id", "_id", "score", "_row"])

    scored = units.mapInArrow(run, "query_id long, _id long, score long, _row long")
    if asked.groupBy("id").count().where("count > 1").limit(1).count():
        scored = scored.groupBy("query_id", "_id", "_row").agg(F.max("score").alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "_id"))).where(F.col("rank") <= k)
    fits = F.when(F.col("score").isin(LOWEST, HIGHEST), F.raise_error(F.lit("a score leaves 64 bits"))).otherwise(F.col("score"))
    return ranked.select("query_id", "rank", F.col("_id").alias(id_col), fits.cast("long").alias("score"))
