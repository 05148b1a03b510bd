"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, A-Z lowered, whatever stands between
them. Seeds are all 3-grams of each item, and three of any four neighbouring
words (``SHAPES``); documents are searched for the same. So a copy holds a
seed unless half of the words around each place differ: an item of seven words
or more loses no copy whose changed words leave it the least score, wherever
they stand. How often the corpus holds a seed plays no part, since a seed that
the edits have broken is the rarest of all; what counts is how many items share
it. Where a rare seed (of at most ``COMMON`` items) meets a document, the words
around it that the item would cover are a window; hits on about the same
diagonal share one. A common seed, part of a phrase that many items hold, would
open a window for each of them wherever the phrase stands. So it opens one only
if the words around could hold enough of the item at all: both are sets of
``BITS`` bits, a word a bit, and the bits that they share are counted, which may
count too many words but never too few. A window goes on only if it holds as
many of the item's words as the least score needs, counted for all windows at
once. Then item and window are aligned word by word (match 2, other word -1,
gap -1), which scores copies with changed, added or missing words; the score is
divided by that of the item with itself.

Documents never move: seeds travel to them. The benchmark is handled in blocks
of at most ``ITEMS`` items, one pass over the documents for each, which bounds
what is sent.

Null texts and texts without words meet nothing. Items of fewer than n words
are seeds as a whole. Documents that share a doc_id, and items that share an
item_id, are aligned each and reported once, with the best score; rows without
a doc_id share the null one, and items without an item_id are searched for and
reported under the null one. Empty tables give no rows. Columns beyond ids and
texts play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import mix, pieces, seeds, staged, words

GRAM = 3
#: Places of the words of a seed: side by side, or with one other word between.
SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
ITEMS = 10_000
MATCH, OTHER, GAP = 2, -1, -1
#: Of the item's own score; from here on a document counts as contaminated.
LEAST = 0.45

#: Items that may share a rare seed, and bits of a set of words.
COMMON, BITS = 8, 1024

#: Seed hits, and cells of a row of the alignment, that a worker holds at a time.
HITS, CELLS = 1 << 20, 1 << 18

#: Bytes that part words: ASCII without letters and digits.
_PARTS = np.zeros(256, bool)
_PARTS[[b for b in range(128) if not chr(b).isalnum()]] = True


def gram_hashes(hashed: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the first word) of the seeds of ``n`` words within rows; of ``GRAM`` words, in all ``SHAPES``."""
    factors, found = seeds(n, 83), []
    for shape in SHAPES if n == GRAM else (tuple(range(n)),):
        count = len(hashed) - shape[-1]
        if count <= 0:
            continue
        at = np.flatnonzero(row[:count] == row[shape[-1] :])
        rolled = hashed[at] * factors[0]
        for factor, j in zip(factors[1:], shape[1:], strict=True):
            rolled = rolled + hashed[at + j] * factor
        found.append((mix(rolled), at))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([g for g, _ in found]), np.concatenate([at for _, at in found])


def _of_item(word: np.ndarray, item: np.ndarray) -> np.ndarray:
    """A hash of word and item."""
    return mix(word ^ mix(item.astype(np.uint64) + np.uint64(1)))


def _bit_sets(word: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """The words of each owner as a set of ``BITS`` bits."""
    out = np.zeros((rows, BITS), bool)
    out[owner, (mix(word) % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(range, number) of all numbers from ``lo`` to below ``hi``."""
    size = hi - lo
    of = np.repeat(np.arange(len(lo)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + lo[of]


class Items:
    """A block of benchmark items as word hashes, with their seeds in order of their hashes."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, n: int = GRAM):
        hashed, row, _, _ = words(texts, _PARTS)
        bounds = np.searchsorted(row, np.arange(len(ids) + 1))
        kept = np.flatnonzero(np.diff(bounds) > 0)
        self.ids = ids[kept]
        self.words = [hashed[bounds[i] : bounds[i + 1]] for i in kept]
        self.n = np.array([min(n, len(w)) for w in self.words])
        grams, item, place = [], [], []
        for k, own in enumerate(self.words):
            found, at = gram_hashes(own, np.zeros(len(own), np.int64), int(self.n[k]))
            grams.append(found)
            item.append(np.full(len(at), k))
            place.append(at)
        join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
        gram, item, place = join(grams, np.uint64), join(item, np.int64), join(place, np.int64)
        order = np.argsort(gram, kind="stable")
        self.gram, self.item, self.place = gram[order], item[order], place[order]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        of = np.repeat(np.arange(len(self.words)), self.lengths)
        flat = join(self.words, np.uint64)
        self.held = np.unique(_of_item(flat, of))
        self.bits = _bit_sets(flat, of, len(self.words))
        # words that share a bit, or stand twice, count as many as they are
        self.spare = self.lengths - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64) if len(self.words) else self.lengths

    def sizes(self) -> list[int]:
        return sorted(set(self.n.tolist()))


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The best local score of each item in its window, and the window's word after which it is reached."""
    width, depth = max(map(len, windows)), max(map(len, items))
    text, word = np.zeros((len(windows), width), np.uint64), np.zeros((depth, len(items)), np.uint64)
    there, known = np.zeros((len(windows), width), bool), np.zeros((depth, len(items)), bool)
    for k, (i, w) in enumerate(zip(items, windows, strict=True)):
        text[k, : len(w)], there[k, : len(w)] = w, True
        word[: len(i), k], known[: len(i), k] = i, True
    before = np.zeros((len(windows), width + 1), np.int32)
    best, end = np.zeros(len(windows), np.int32), np.zeros(len(windows), np.int64)
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    for j in range(depth):  # an item that has ended matches nothing, so that its scores only fall
        now = np.maximum(before + GAP, 0)
        same = (text == word[j][:, None]) & there & known[j][:, None]
        now[:, 1:] = np.maximum(now[:, 1:], before[:, :-1] + np.where(same, MATCH, OTHER))
        before = np.maximum.accumulate(now + slope, axis=1) - slope
        top = before.max(axis=1)
        better = top > best
        end[better] = before[better].argmax(axis=1)
        best = np.maximum(best, top)
    return best, end


def _hits(items: Items, hashed: np.ndarray, row: np.ndarray, begin: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(item, word where it would begin, row) of the seeds that rows hold, by ranges of items with about ``HITS`` at most; of common seeds only where the words around allow for it."""
    unique, first, counts = np.unique(items.gram, return_index=True, return_counts=True)
    met = []
    for n in items.sizes():
        gram, at = gram_hashes(hashed, row, n)
        to = np.minimum(np.searchsorted(unique, gram), len(unique) - 1)
        hit = np.flatnonzero(unique[to] == gram)
        met.append((n, to[hit], at[hit]))
    times = sum(np.bincount(to, minlength=len(unique)) for _, to, _ in met)
    of_item = np.bincount(items.item, np.repeat(times, counts), len(items.words))
    part = np.cumsum(of_item) // HITS  # of each item
    reach = int(items.lengths.max()) if len(items.words) else 0
    for p in np.unique(part[of_item > 0]):
        held = part[items.item] == p
        before = np.concatenate(([0], np.cumsum(held)))
        lo, many = before[first], before[first + counts] - before[first]
        seed_item, seed_place = items.item[held], items.place[held]
        found = []
        for n, to, at in met:
            which, hit = np.empty(0, np.int64), np.empty(0, np.int64)
            if len(to):
                hit, which = _ranges(lo[to], lo[to] + many[to])
            keep = items.n[seed_item[which]] == n
            keep[keep] = _allowed(items, seed_item[which[keep]], hit[keep], counts[to] > COMMON, hashed, row, at, begin, reach, least)
            which, hit = which[keep], hit[keep]
            found.append((seed_item[which], at[hit] - seed_place[which], row[at[hit]]))
        yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _allowed(items: Items, item, hit, common, hashed, row, at, begin, reach, least) -> np.ndarray:
    """Whether the words around a hit of a common seed could hold enough of the item; true for rare seeds."""
    out = np.ones(len(hit), bool)
    step = max(1, CELLS // 16)
    for chunk in range(0, len(hit), step):
        some = slice(chunk, chunk + step)
        tested = np.flatnonzero(common[hit[some]]) + chunk
        if not len(tested):
            continue
        places, of = np.unique(hit[tested], return_inverse=True)
        slack = reach // 4 + 2
        lo = np.maximum(at[places] - reach - slack, begin[row[at[places]]])
        hi = np.minimum(at[places] + reach + slack, begin[row[at[places]] + 1])
        owner, word = _ranges(lo, hi)
        around = _bit_sets(hashed[word], owner, len(places))
        shared = np.bitwise_count(items.bits[item[tested]] & around[of]).sum(axis=1, dtype=np.int64)
        out[tested] = shared + items.spare[item[tested]] >= least * items.lengths[item[tested]]
    return out


def _holding(items: Items, hashed: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: float) -> np.ndarray:
    """The windows that hold as many of the item's words as the least score needs."""
    kept, at, ends = [], 0, np.cumsum(hi - lo)
    while at < len(item):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * CELLS, "right")))
        of, word = _ranges(lo[at:to], hi[at:to])
        key = _of_item(hashed[word], item[at:to][of])
        there = items.held[np.minimum(np.searchsorted(items.held, key), len(items.held) - 1)] == key
        count = np.bincount(of, there, to - at)
        kept.append(at + np.flatnonzero(count >= least * items.lengths[item[at:to]]))
        at = to
    return np.concatenate(kept) if kept else np.empty(0, np.int64)


def _batched(depth: np.ndarray, width: np.ndarray) -> Iterator[np.ndarray]:
    """Windows of like items and widths, as many at a time as ``CELLS`` allow, or one."""
    order = np.lexsort((width, depth // 8))
    at = 0
    while at < len(order):
        most = np.maximum.accumulate(width[order[at : at + CELLS]])
        to = at + max(1, int(np.searchsorted(most * np.arange(1, len(most) + 1), CELLS, "right")))
        yield order[at:to]
        at = to


def found_in(items: Items, texts: pa.Array, least: float) -> tuple[np.ndarray, ...]:
    """(text, item, score, first word, end word) of all alignments that reach ``least``."""
    hashed, row, _, _ = words(texts, _PARTS)
    begin = np.searchsorted(row, np.arange(len(texts) + 1))
    out = []
    for item, start, doc in _hits(items, hashed, row, begin, least):
        if not len(item):
            continue
        order = np.lexsort((start, item, doc))
        item, start, doc = item[order], start[order], doc[order]
        slack = items.lengths[item] // 4 + 2
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] - start[:-1] > slack[1:])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(item)) - 1
        k, d, slack = item[at], doc[at], slack[at]
        lo = np.maximum(start[at] - slack, begin[d])
        hi = np.minimum(start[last] + items.lengths[k] + slack, begin[d + 1])
        keep = _holding(items, hashed, k, lo, hi, least)
        k, d, lo, hi = k[keep], d[keep], lo[keep], hi[keep]
        for some in _batched(items.lengths[k], hi - lo):
            own = [items.words[i] for i in k[some]]
            best, end = align(own, [hashed[a:b] for a, b in zip(lo[some], hi[some], strict=True)])
            good = np.flatnonzero(best >= least * MATCH * items.lengths[k[some]])
            if not len(good):
                continue
            some, best, end = some[good], best[good], end[good]
            # the same alignments from their ends
            size = align([own[g][::-1] for g in good], [hashed[a : a + e][::-1] for a, e in zip(lo[some], end, strict=True)])[1]
            stop = lo[some] + end - begin[d[some]]
            out.append((d[some], k[some], best / (MATCH * items.lengths[k[some]]), stop - size, stop))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 5


def _aligned(items: Items, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                d, k, score, a, b = found_in(items, piece.column("text"), least)
                if len(d):
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc_id").take(pa.array(d)), pa.array(items.ids[k], pa.int64()), pa.array(score, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                        ["doc_id", "item_id", "score", "first_word", "end_word"],
                    )

    return run


def _without(items: Items, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.schema.names.index("text")
            for piece in pieces(batch, "text"):
                bad = np.zeros(piece.num_rows, bool)
                bad[found_in(items, piece.column(text).cast(pa.string()), least)[0]] = True
                yield piece.filter(pa.array(~bad)) if bad.any() else piece

    return run


_MET = "doc_id long, item_id long, score double, first_word long, end_word long"


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of about ``ITEMS`` items at most."""
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    blocks = -(-wanted.count() // ITEMS)
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * blocks))) if blocks > 1 else wanted.withColumn("block", F.lit(0))
    for block in range(2 * blocks if blocks > 1 else blocks):
        rows = wanted.where(F.col("block") == block).orderBy("item_id", "text").toArrow().combine_chunks()
        if rows.num_rows:
            items = Items(np.array(rows.column("item_id").to_pylist(), object), rows.column("text").combine_chunks())
            if len(items.gram):
                yield items


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word: for each document and item the best alignment that reaches ``least``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [texts.mapInArrow(_aligned(items, least), _MET) for items in _blocks(benchmark)]
    met = reduce(DataFrame.unionAll, [staged(x, "aligned") for x in found] if len(found) > 1 else found) if found else docs.sparkSession.createDataFrame([], _MET)
    best = met.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("score", "first_word", "end_word"), F.struct("score", -F.col("first_word"), -F.col("end_word"))).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` without rows whose text holds a benchmark item, whatever other rows share their doc_id or have none.

    Each row is decided where it is read; nothing is shuffled, and no column is added on the way.
    """
    for items in _blocks(benchmark):
        docs = docs.mapInArrow(_without(items, least), docs.schema)
    return docs
