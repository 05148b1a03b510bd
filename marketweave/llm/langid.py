"""Language identification by Bloom filters over n-grams, one for each language, bit-sliced.

Slot s of the table holds a mask with one bit for each language; an n-gram sets
its language's bit in ``HASHES`` slots. The AND of an n-gram's slots answers at
once which languages contain it. A text's hits per language are popcounts over
the masks of all of its n-grams; a filter filled to f says yes to an unknown
n-gram with probability f ** HASHES, so of n n-grams with h hits about
(h - n * fp) / (1 - fp) are really contained. The language with the most
decides; among equal ones the first in order of name.

Learning counts, for each language, in how many n-gram places each n-gram
occurs in all learning documents (n bytes of the lowered text with ends of
words as blanks; partial counts are formed before the shuffle). An n-gram
belongs to a language if its share there is at least ``SHARE`` of its largest
share in any language and it has been seen at least ``LEAST`` times there; so
passages that stray into other languages don't blur them. The table has
``slots`` entries, sized by the number of n-grams and bounded by ``MOST_SLOTS``,
which bounds what is collected and broadcast.

A null text or one without a letter is ``und`` with score 0. Documents without
language teach nothing. Without learning documents everything is ``und``.
Repeated rows are handled each for itself; rows without a doc_id are predicted
as held out and teach nothing. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import crc_remainder, large_text, mix, pieces, seeds, staged, text_bytes

GRAM, HASHES = 4, 3
#: A gram is a language's own from this share of its best language's rate on, and from so many places.
SHARE, LEAST = 0.25, 3
MOST_SLOTS = 1 << 22
#: Languages in one word of a mask.
BITS = 63

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] += 32
_CLASS[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32  # anything but letters ends a word


def grams(column: pa.Array, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(gram, row): the n-byte windows of each row that hold no two blanks in a row, as numbers."""
    data, offsets = text_bytes(column)
    # a blank before and after each row, so that its first and last words have ends
    rows = len(offsets) - 1
    room = np.full(len(data) + 2 * rows, 32, np.uint8)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    room[np.arange(len(data)) + 2 * owner + 1] = _CLASS[data]
    if len(room) < n:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    value = np.zeros(len(room) - n + 1, np.uint32)
    for j in range(n):
        value = value << np.uint32(8) | room[j : len(room) - n + 1 + j]
    blank = room == 32
    pairs = blank[1:] & blank[:-1]
    keep = ~pairs[: len(value)]
    for j in range(1, n - 1):
        keep &= ~pairs[j : len(value) + j]
    at = np.flatnonzero(keep)
    return value[at], np.searchsorted(offsets + 2 * np.arange(rows + 1), at, "right") - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, dict[int, int]] = {}

    def flush(lang: str) -> pa.RecordBatch:
        own = totals.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own.keys()), pa.int64()), pa.array(list(own.values()), pa.int64())], ["lang", "gram", "places"])

    for batch in batches:
        for piece in pieces(batch, "text"):
            codes = piece.column("lang").dictionary_encode()
            value, row = grams(piece.column("text"))
            which = codes.indices.to_numpy()[row]
            for k, lang in enumerate(codes.dictionary.to_pylist()):
                own, places = np.unique(value[which == k], return_counts=True)
                held = totals.setdefault(lang, {})
                for g, c in zip(own.tolist(), places.tolist(), strict=True):
                    held[g] = held.get(g, 0) + c
                if len(held) > 1 << 20:
                    yield flush(lang)
    for lang in list(totals):
        yield flush(lang)


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the table of masks and each language's false-positive rate, from ``docs`` (text, lang)."""
    counts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null").mapInArrow(_counted, "lang string, gram long, places long")
    counts = staged(counts.groupBy("lang", "gram").agg(F.sum("places").alias("places")), "grams")
    totals = counts.groupBy("lang").agg(F.sum("places").alias("total"))
    languages = sorted(r["lang"] for r in totals.collect())
    if not languages:
        return [], np.zeros((1, 1), np.uint64), np.zeros(0)
    bits = docs.sparkSession.createDataFrame(list(zip(languages, range(len(languages)), strict=True)), "lang string, bit int")
    rated = counts.join(F.broadcast(totals.join(bits, "lang")), "lang").select("gram", "bit", "places", (F.col("places") / F.col("total")).alias("rate"))
    by_gram = rated.groupBy("gram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("bit", "rate", "places")).alias("seen"))  # an entry for each language
    own = staged(by_gram.select("gram", F.explode(F.filter("seen", lambda x: (x.rate >= SHARE * F.col("best")) & (x.places >= LEAST))).alias("x")).select("gram", "x.bit"), "own")
    held = own.select("gram").distinct().count()
    slots = 1 << 16
    while slots < 8 * held and slots < MOST_SLOTS:
        slots *= 2

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.tile(batch.column("bit").to_numpy().astype(np.int64), HASHES)
            at = slots_of(batch.column("gram").to_numpy().astype(np.uint32), slots).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bit // BITS), pa.array(np.int64(1) << bit % BITS)], ["slot", "word", "mask"])

    table = np.zeros((-(-len(languages) // BITS), slots), np.uint64)
    for word in range(len(table)):
        filled = own.where(F.col("bit").between(word * BITS, word * BITS + BITS - 1)).mapInArrow(placed, "slot long, word long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
        table[word, filled.column("slot").to_numpy()] = filled.column("mask").to_numpy().astype(np.uint64)
    fill = np.array([_bit(table, i).mean() for i in range(len(languages))])
    return languages, table, fill**HASHES


def _bit(masks: np.ndarray, i: int) -> np.ndarray:
    return (masks[i // BITS] >> np.uint64(i % BITS)) & np.uint64(1)


def slots_of(gram: np.ndarray, slots: int) -> np.ndarray:
    """The slots of each n-gram, one row for each hash."""
    x = mix(gram.astype(np.uint64) + seeds(1, 71)[0])
    step = x >> np.uint64(32) | np.uint64(1)
    return np.stack([((x + np.uint64(k) * step) & np.uint64(slots - 1)).astype(np.int64) for k in range(HASHES)])


def contained(gram: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The mask of languages that contain each n-gram, a row for each word of the mask."""
    return np.bitwise_and.reduce([table[:, own] for own in slots_of(gram, table.shape[1])])


def score(column: pa.Array, languages: list[str], table: np.ndarray, false_rate: np.ndarray) -> tuple[list[str], list[float]]:
    """The language of each text and a score from 0 to 1: its share of the n-grams that the two best languages really contain."""
    texts = large_text(column)
    value, row = grams(texts)
    rows = len(texts)
    unique, where = np.unique(value, return_inverse=True)
    masks = contained(unique, table)
    n = np.bincount(row, minlength=rows)
    real = np.empty((rows, len(languages)))
    for i in range(len(languages)):
        hits = np.bincount(row, _bit(masks, i).astype(np.float64)[where], minlength=rows)
        real[:, i] = np.maximum(0.0, (hits - n * false_rate[i]) / (1.0 - min(false_rate[i], 0.999)))
    best = real.argmax(axis=1)
    top = np.sort(real, axis=1)[:, ::-1]
    second = top[:, 1] if len(languages) > 1 else np.zeros(rows)
    share = np.where(top[:, 0] > 0, top[:, 0] / np.maximum(top[:, 0] + second, 1e-300), 1.0 / len(languages))
    lettered = [any(map(str.isalpha, t)) for t in texts.to_pylist()]
    return [languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)], [float(s) if ok else 0.0 for s, ok in zip(share, lettered, strict=True)]


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred and score for each row of ``docs`` (doc_id, text); only the text is looked at."""
    languages = model[0]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not languages:
        return texts.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                lang, share = score(piece.column("text"), *shared.value)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(lang, pa.string()), pa.array(share)], ["doc_id", "lang_pred", "score"])

    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs`` (doc_id, text, lang); learns where crc32(doc_id) mod 3 is not 1."""
    model = learn(docs.where(crc_remainder("doc_id", 3) != 1))
    return predict(docs, model).select("doc_id", F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "lang_pred", "score")
