"""Exact top-k inner products by columnar branch and bound.

Vectors are turned into integers, floor(scale * x). Queries are handled in
blocks of at most ``QUERY_BLOCK`` rows, which is the bound on what is
broadcast; each block is searched against all rows. A task holds its
candidates in vertical layout, one row of an array for each dimension. It
accumulates the products dimension block by dimension block; after each, the
mass that is left in the other dimensions bounds what a candidate can still
gain (Cauchy-Schwarz on the norms of the rests), and only candidates that can
reach the query's k-th best score so far are kept, compacted. Scores are whole
numbers, exact in 64 bits, and ties go to the smaller id, so candidates that
can just reach the k-th best score stay as well.

Vectors that are null, empty, or hold null or non-finite components take no
part. A query is held against vectors of its own length only. Rows with the
query's id are never its partners; an id that repeats is a candidate once for
each row, and as a query keeps the best over its distinct rows. Rows without
an id take no part. Products that could pass 2**53 are computed with unbounded
whole numbers; scores beyond 64 bits are cut to the largest there is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketweave.llm.common import staged

QUERY_BLOCK = 4096
#: Components that a task searches at a time, and dimensions between two prunings.
COMPONENTS, DIMENSIONS = 1 << 18, 16
_NONE, _MOST = -np.iinfo(np.int64).max, np.iinfo(np.int64).max


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and v, array<long>: floor(scale * x) of usable vectors."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and size(v) > 0").where(~bad)
    return found.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _rests(columns: np.ndarray) -> np.ndarray:
    """For each block of dimensions, the norm of what comes from it on, rounded up."""
    squares = np.add.reduceat(columns * columns, np.arange(0, len(columns), DIMENSIONS), axis=0)
    return np.sqrt(squares[::-1].cumsum(axis=0)[::-1]) * (1 + 1e-9)


class _Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, ids: np.ndarray, whole: np.ndarray, k: int):
        self.ids, self.whole, self.k = ids, whole, k
        self.columns, self.largest = whole.astype(np.float64), _largest(whole)
        self.rests = _rests(self.columns)
        self.scores = np.full((len(ids), k), _NONE, np.int64)
        self.partners = np.zeros((len(ids), k), np.int64)

    def search(self, ids: np.ndarray, whole: np.ndarray) -> None:
        if self.largest * _largest(whole) * len(whole) >= 1 << 53:
            for q in range(len(self.ids)):
                exact = self.whole[:, q].astype(object) @ whole.astype(object)
                self._keep(q, np.array([min(max(x, _NONE + 1), _MOST) for x in exact], np.int64), ids)
            return
        columns = whole.astype(np.float64)
        rests, steps = _rests(columns), range(0, len(columns), DIMENSIONS)
        first = self.columns[:DIMENSIONS].T @ columns[:DIMENSIONS]  # whole numbers below 2**53: exact in doubles
        for q in range(len(self.ids)):
            least = self.scores[q, -1]
            partial, left = first[q], None
            for b, d in enumerate(steps):
                if b:
                    partial = partial + self.columns[d : d + DIMENSIONS, q] @ (columns[d : d + DIMENSIONS] if left is None else columns[d : d + DIMENSIONS, left])
                if b + 1 < len(steps):
                    if least == _NONE:
                        continue
                    rest = rests[b + 1] if left is None else rests[b + 1, left]
                    keep = np.flatnonzero(partial + self.rests[b + 1, q] * rest >= least - 0.5)
                    partial, left = partial[keep], keep if left is None else left[keep]
                    if not len(keep):
                        break
            if not len(partial):
                continue
            self._keep(q, partial.astype(np.int64), ids if left is None else ids[left])

    def _keep(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = np.flatnonzero((scores >= self.scores[q, -1]) & (ids != self.ids[q]))
        if len(keep) > self.k:
            keep = keep[scores[keep] >= np.partition(scores[keep], len(keep) - self.k)[len(keep) - self.k]]
        scores = np.concatenate((self.scores[q], scores[keep]))
        partners = np.concatenate((self.partners[q], ids[keep]))
        order = np.lexsort((partners, -scores))[: self.k]
        self.scores[q], self.partners[q] = scores[order], partners[order]

    def batch(self) -> pa.RecordBatch:
        found = self.scores.ravel() != _NONE
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(self.ids, self.k)[found], self.partners.ravel()[found], self.scores.ravel()[found])], ["query_id", "vec_id", "score"])


def _largest(whole: np.ndarray) -> int:
    return max(abs(int(whole.min())), abs(int(whole.max()))) if whole.size else 0


def _by_length(ids: np.ndarray, vectors: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors of one length at a time, one row for each dimension."""
    offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy()
    lengths = np.diff(offsets)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield int(n), ids[rows], np.ascontiguousarray(values[offsets[rows][None, :] + np.arange(n)[:, None]])


def _search(queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {n: _Best(ids, columns, k) for n, ids, columns in queries.value}
        for batch in batches:
            step = max(1, COMPONENTS * batch.num_rows // max(1, len(batch.column("v").values)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                for n, ids, columns in _by_length(part.column("vec_id").to_numpy(), part.column("v")):
                    if n in best:
                        best[n].search(ids, columns)
        for b in best.values():
            yield b.batch()

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best partners of each row that ``is_query`` marks, among all other rows of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    ready = staged(quantised(vectors, scale), "vectors")
    chosen = ready.where(is_query).distinct()
    blocks = -(-2 * chosen.count() // QUERY_BLOCK)
    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, blocks))))
    chosen = staged(chosen.repartition("block"), "queries") if blocks > 1 else chosen
    found = []
    for block in range(blocks):
        rows = chosen.where(F.col("block") == block).select("vec_id", "v").toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        arrays = [rows.column(c).combine_chunks() for c in ("vec_id", "v")]
        queries = spark.sparkContext.broadcast([x for x in _by_length(arrays[0].to_numpy(), arrays[1])])
        partial = ready.mapInArrow(_search(queries, k), "query_id long, vec_id long, score long")
        found.append(staged(_ranked(partial, k), "found") if blocks > 1 else _ranked(partial, k))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found[0] if len(found) == 1 else _ranked(reduce(DataFrame.unionAll, found), k)


def _ranked(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
