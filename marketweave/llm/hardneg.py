"""Hard negatives: rotated one-bit codes, popcount estimates, exact integer scores.

For each anchor row the positives are its best rows of the same label, and for
each positive the negatives are the best rows of another label whose score
lies between two shares of the positive's. The score is the inner product of
the vectors as whole numbers, floor(scale * x).

* Codes. Every vector is rotated (random signs and Walsh-Hadamard transforms,
  an exact rotation of the vector padded with zeros) and divided by its norm.
  The signs of its components are its first code, a unit vector; with it is
  stored how far code and vector agree, their inner product. What the code
  leaves is coded again, ``LEVELS`` times in all, and the norm of the last
  residual of each level is stored as well. Codes are written once and read by
  both passes.
* Estimates. An anchor's rotated vector is rounded to ``PLANES`` bits a
  component, held as bit planes. Its inner product with a code is a weighted
  sum of popcounts of plane and code. Times the stored agreement, this
  estimates the score.
* Interval. A residual is orthogonal to its last code, so by Cauchy-Schwarz it
  adds at most its norm times the norm of what of the anchor is orthogonal to
  that code; the anchor's rounding adds at most the rounding's norm. This
  interval always holds, there is nothing random in it. A pair goes on from
  level to level, and then to its integer score, only while the interval
  reaches what counts: the anchor's k-th best score so far, or for negatives a
  score between the two shares that can still enter the k best.

Anchors are a stated query set, held against all rows: blocks of anchors of at
most ``BLOCK`` components are collected and broadcast; each block makes two
passes, one for the positives, one for the negatives. A task keeps the k best
of each anchor, so what is shuffled doesn't grow with hot labels.

Rows without an id, a label or a vector, and vectors with null or non-finite
components, take no part. Vectors meet vectors of their own length only; those
of length 0 have score 0 with each other. Rows that share the anchor's id are
never its partners; a row that repeats is a partner each time, and an anchor
once for each different (id, label, vector), in order of label and vector.
``positive_rank`` tells positives that share an id apart. Scores beyond 64
bits are cut to the largest there is. Ties go to the smaller id. Without
anchors or rows the result is empty. Other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketweave.llm.common import seeds, staged

LEVELS, PLANES, ROUNDS = 4, 8, 3
#: Components of the anchors of a block, and pairs that a task handles at a time.
BLOCK, PAIRS = 1 << 18, 1 << 18
_NONE, _MOST = -np.iinfo(np.int64).max, np.iinfo(np.int64).max
_SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"


def rotated(whole: np.ndarray) -> np.ndarray:
    """The rows of ``whole`` in a rotated basis, padded to a power of two, 64 at least."""
    width = max(64, 1 << max(0, whole.shape[1] - 1).bit_length())
    out = np.zeros((len(whole), width))
    out[:, : whole.shape[1]] = whole
    for turn in range(ROUNDS):
        out *= np.where(seeds(width, 101 + turn) >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
        step = 1
        while step < width:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(out), width)
            step *= 2
        out /= np.sqrt(width)
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    return np.packbits(bits, axis=-1).view(np.uint64)


def encode(whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(norm, codes, agreement, residual norm) of each row; the last three by level, for the vector over its norm."""
    left = rotated(whole)
    norm = np.sqrt((left * left).sum(axis=1))
    left /= np.where(norm > 0, norm, 1)[:, None]
    codes, agree, rest = [], [], []
    for _ in range(LEVELS):
        up = left > 0
        sign = np.where(up, 1.0, -1.0) / np.sqrt(left.shape[1])
        share = (left * sign).sum(axis=1)
        left = left - share[:, None] * sign
        codes.append(_packed(up))
        agree.append(share)
        rest.append(np.sqrt((left * left).sum(axis=1)))
    return norm, np.stack(codes, 1), np.stack(agree, 1), np.stack(rest, 1)


class Planes:
    """Rotated anchors, rounded to ``PLANES`` bits a component."""

    def __init__(self, whole: np.ndarray):
        turned = rotated(whole)
        self.width = turned.shape[1]
        low, high = turned.min(axis=1), turned.max(axis=1)
        step = np.where(high > low, (high - low) / ((1 << PLANES) - 1), 1.0)
        level = np.rint((turned - low[:, None]) / step[:, None])
        rounded = low[:, None] + step[:, None] * level
        bits = level.astype(np.int64)
        self.planes = np.stack([_packed((bits >> p & 1).astype(bool)) for p in range(PLANES)], 1)
        self.low, self.step, self.sum = low, step, rounded.sum(axis=1)
        self.square = (rounded * rounded).sum(axis=1)
        self.off = np.sqrt(((turned - rounded) ** 2).sum(axis=1))  # the rounding's norm
        self.norm = np.sqrt((turned * turned).sum(axis=1))

    def on_code(self, a: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Inner products of rounded anchors ``a`` and codes, pair by pair, by popcounts."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        weighted = np.zeros(len(a), np.int64)
        for p in range(PLANES):
            weighted += np.bitwise_count(self.planes[a, p] & codes).sum(axis=1, dtype=np.int64) << p
        return (2 * (self.low[a] * ones + self.step[a] * weighted) - self.sum[a]) / np.sqrt(self.width)


class Coded:
    """Candidate rows of one length: ids, labels, whole numbers and what is stored of their codes."""

    def __init__(self, batch: pa.RecordBatch, rows: np.ndarray, n: int):
        flat = lambda c: _lists(batch.column(c), rows)
        self.ids, self.labels = (batch.column(c).to_numpy()[rows] for c in ("vec_id", "label"))
        self.whole = flat("v").reshape(len(rows), n)
        self.norm, self.agree, self.rest = batch.column("norm").to_numpy()[rows], flat("agree").reshape(len(rows), LEVELS), flat("rest").reshape(len(rows), LEVELS)
        self.codes = flat("codes").view(np.uint64).reshape(len(rows), LEVELS, -1)

    def __len__(self) -> int:
        return len(self.ids)


def _lists(column: pa.ListArray, rows: np.ndarray) -> np.ndarray:
    """The elements of the lists of ``rows``, which are of one length, one after the other."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    size = int(offsets[rows[0] + 1] - offsets[rows[0]])
    return values[(offsets[rows][:, None] + np.arange(size)[None, :]).ravel()]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, Coded]]:
    lengths = np.diff(batch.column("v").offsets.to_numpy())
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        at, step = 0, min(256, len(rows))
        while at < len(rows):  # few at first, so that the best so far soon filter
            yield int(n), Coded(batch, rows[at : at + step], int(n))
            at, step = at + step, min(2 * step, 4096)


def _with_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("v")
        lengths = np.diff(column.offsets.to_numpy())
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            for at in range(0, len(rows), max(1, BLOCK // max(64, int(n)))):
                part = rows[at : at + max(1, BLOCK // max(64, int(n)))]
                whole = _lists(column, part).reshape(len(part), int(n))
                norm, codes, agree, rest = encode(whole.astype(np.float64))
                many = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * (x.size // len(part))), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(part)) for c in ("vec_id", "label", "v")), pa.array(norm), many(codes.reshape(len(part), -1).view(np.int64)), many(agree), many(rest)],
                    ["vec_id", "label", "v", "norm", "codes", "agree", "rest"],
                )


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows, exact; beyond 64 bits cut to the largest."""
    largest = lambda x: max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if largest(a) * largest(b) * a.shape[1] < 1 << 62:
        return np.einsum("ij,ij->i", a, b)
    return np.array([min(max(sum(int(x) * int(y) for x, y in zip(r, s, strict=True)), _NONE + 1), _MOST) for r, s in zip(a, b, strict=True)], np.int64)


class _Search:
    """The ``k`` best partners of each slot; a slot is an anchor and the least and greatest score that count for it."""

    def __init__(self, ids, labels, whole, low, high, same: bool, k: int):
        self.ids, self.labels, self.whole, self.same, self.k = ids, labels, whole, same, k
        self.low, self.high = low, high  # one row for each anchor, one column for each of its slots
        self.planes = Planes(whole.astype(np.float64))
        self.least = low.copy()
        self.slot, self.score, self.partner = (np.empty(0, np.int64) for _ in range(3))

    def search(self, rows: Coded) -> None:
        step = max(1, PAIRS // max(1, len(rows)))
        for at in range(0, len(self.ids), step):
            a, c = np.nonzero(((self.labels[at : at + step, None] == rows.labels[None, :]) == self.same) & (self.ids[at : at + step, None] != rows.ids[None, :]))
            a += at
            estimate = np.zeros(len(a))
            for level in range(LEVELS):
                if not len(a):
                    break
                on = self.planes.on_code(a, rows.codes[c, level])
                estimate = estimate + rows.agree[c, level] * on
                reach = rows.rest[c, level] * np.sqrt(np.maximum(self.planes.square[a] - on * on, 0)) + self.planes.off[a]
                reach += 1e-9 * (self.planes.norm[a] + np.sqrt(self.planes.square[a]))  # of computing with doubles
                keep = self._counts(a, (estimate - reach) * rows.norm[c] - 0.5, (estimate + reach) * rows.norm[c] + 0.5)
                a, c, estimate = a[keep], c[keep], estimate[keep]
            if len(a):
                self._score(a, c, rows)

    def _counts(self, a: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Where an interval reaches a slot of its anchor: a score in the slot's range, and none too small for its best."""
        out = np.zeros(len(a), bool)
        for j in range(self.low.shape[1]):
            out |= (upper >= self.least[a, j]) & (lower <= self.high[a, j])
        return out

    def _score(self, a: np.ndarray, c: np.ndarray, rows: Coded) -> None:
        slots = self.low.shape[1]
        parts = [(self.slot, self.score, self.partner)]
        step = max(1, BLOCK // max(1, self.whole.shape[1]))
        for at in range(0, len(a), step):
            x, y = a[at : at + step], c[at : at + step]
            exact = scores(self.whole[x], rows.whole[y])
            for j in range(slots):
                good = (exact >= self.least[x, j]) & (exact <= self.high[x, j])
                parts.append((x[good] * slots + j, exact[good], rows.ids[y[good]]))
        slot, score, partner = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((partner, -score, slot))
        slot, score, partner = slot[order], score[order], partner[order]
        begin = np.concatenate(([0], np.flatnonzero(slot[1:] != slot[:-1]) + 1)) if len(slot) else np.empty(0, np.int64)
        place = np.arange(len(slot)) - np.repeat(begin, np.diff(np.append(begin, len(slot))))
        kth = place == self.k - 1
        self.least[slot[kth] // slots, slot[kth] % slots] = score[kth]
        keep = place < self.k
        self.slot, self.score, self.partner = slot[keep], score[keep], partner[keep]


def _searched(sent, same: bool, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {n: (_Search(*arrays, same, k), number) for n, number, *arrays in sent.value}
        for batch in batches:
            for n, rows in _by_length(batch):
                if n in found:
                    found[n][0].search(rows)
        for search, number in found.values():
            slots = search.low.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (number[search.slot // slots], search.slot % slots, search.partner, search.score)], ["anchor", "slot", "vec_id", "score"])

    return run


def _best(coded: DataFrame, sent, same: bool, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id")
    partial = coded.mapInArrow(_searched(sent, same, k), "anchor long, slot long, vec_id long, score long")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def with_codes(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, v (floor(scale * x)) and what is stored of the codes, of usable rows of ``vectors`` (vec_id, label, embedding)."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    found = found.where("vec_id is not null and label is not null and v is not null").where(~bad)
    found = found.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))
    return found.mapInArrow(_with_codes, "vec_id long, label long, v array<long>, norm double, codes array<long>, agree array<double>, rest array<double>")


def _shares(low: int, high: int, score: int) -> tuple[int, int]:
    """The least and greatest whole number x with low * score <= 100 * x <= high * score."""
    return -(-low * score // 100), high * score // 100


def hard_negatives(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank: for the rows that ``is_anchor`` (an expression of vec_id) marks and each of their
    ``positives`` best rows of the same label, the ``negatives`` best rows of other labels that score ``low`` to ``high`` percent of the positive."""
    spark = vectors.sparkSession
    coded = staged(with_codes(vectors, scale), "codes")
    chosen = coded.where(is_anchor).select("vec_id", "label", "v").distinct()
    components = chosen.agg(F.sum(F.greatest(F.size("v"), F.lit(64)))).first()[0] or 0
    blocks = -(-2 * components // BLOCK) if components > BLOCK else min(components, 1)
    chosen = staged(chosen.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(max(1, blocks)))).repartition("block"), "anchors") if blocks > 1 else chosen.withColumn("block", F.lit(0))
    found = []
    for block in range(blocks):
        rows = chosen.where(F.col("block") == block).select("vec_id", "label", "v").orderBy("vec_id", "label", "v").toArrow().combine_chunks()
        if rows.num_rows:
            found.append(_of_block(spark, coded, rows, positives, negatives, low, high))
            if blocks > 1:
                found[-1] = staged(found[-1], "negatives")
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], _SCHEMA)


def _of_block(spark, coded: DataFrame, rows: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
    vectors = rows.column("v").combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    groups = [(int(n), at, ids[at], labels[at], _lists(vectors, at).reshape(len(at), int(n))) for n in np.unique(lengths) for at in [np.flatnonzero(lengths == n)]]
    # first pass: every score counts
    every = [(*g, np.full((len(g[1]), 1), _NONE), np.full((len(g[1]), 1), _MOST)) for g in groups]
    best = _best(coded, spark.sparkContext.broadcast(every), True, positives).select("anchor", "rank", "vec_id", "score").toArrow().combine_chunks()
    # second pass: a slot for each positive, with the scores that count for it; none can where the positive is missing
    least, most = np.full((len(ids), positives), _MOST), np.full((len(ids), positives), _NONE)
    for anchor, rank, score in zip(*(best.column(c).to_pylist() for c in ("anchor", "rank", "score")), strict=True):
        least[anchor, rank - 1], most[anchor, rank - 1] = _shares(low, high, score)
    ranged = [(*g, least[g[1]], most[g[1]]) for g in groups]
    found = _best(coded, spark.sparkContext.broadcast(ranged), False, negatives)
    own = pa.table([best.column("anchor"), pa.array(best.column("rank").to_numpy() - 1, pa.int64()), pa.array(ids[best.column("anchor").to_numpy()]), best.column("vec_id"), best.column("score")], ["anchor", "slot", "anchor_id", "positive_id", "positive_score"])
    joined = found.join(spark.createDataFrame(own.to_pandas(), "anchor long, slot long, anchor_id long, positive_id long, positive_score long"), ["anchor", "slot"])
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), (F.col("slot") + 1).cast("int").alias("positive_rank"))
