"""Toxicity by compression with two zstandard dictionaries.

Both dictionaries hold the same ordinary words. Behind these one holds toxic
text, the other as many bytes of further ordinary text, so that a window of a
document compresses alike under both except where it shares stretches with
the toxic text. A window is ``WINDOW`` words; the difference of its two
lengths, in bytes, is what it has in common with toxic text. Sums and counts
of these differences over all windows of a text, against its number of words,
are turned into a probability by a logistic curve that was fitted on labelled
documents other than those which the dictionaries were learnt from; a text is
toxic from one half on.

The toxic text is learnt from words of toxic documents and their beginnings,
since languages bend words at the end. A word counts once for each pair of
neighbours it is seen with, so that copies of a document weigh no more than
one; words and beginnings that toxic documents use much more often than
ordinary ones are the text, the most telling last.

Learning takes at most ``TOXIC`` toxic and ``ORDINARY`` ordinary labelled
documents, those with the smallest hash of doc_id; two thirds of them for the
dictionaries, a third for the curve. Where a class has more, the constant of
the curve is moved to the odds of all labelled learning documents, so that one
half means the same on a table of any size. Whole texts are learnt from and
scored.

Null and empty texts have no windows and get the score that the curve gives
to nothing found. Labels without toxic mark teach nothing; of several labels
of a document the largest counts. Where the labels hold one class alone, every
text scores 0 or 1 accordingly; without labels, 0. Repeated rows are scored
each for itself, rows without a doc_id as held out. An empty table gives no
rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import crc_remainder, large_text, pieces, staged

WINDOW, LEVEL = 8, 3
TOXIC, ORDINARY = 4000, 8000
#: Words of the shared part, of the toxic part, and bytes of a word in a dictionary.
COMMON_WORDS, TOXIC_WORDS, WORD_BYTES = 6000, 3000, 32
#: Bytes of a word's beginning.
STEM = (4, 10)
#: A toxic word is this many times as frequent in toxic text, in so many surroundings, by so many standard deviations.
TIMES, SEEN, DEVIATIONS = 4.5, 5, 3.5

_word = re.compile(rb"[a-z0-9\x80-\xff]+")


def text_words(text: str) -> list[bytes]:
    return _word.findall(text.lower().encode())


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            for toxic, text in zip(piece.column("toxic").to_pylist(), large_text(piece.column("text")).to_pylist(), strict=True):
                own = [b"", *text_words(text), b""]
                met = {(hash_of(a, b, c), b[:WORD_BYTES]) for a, b, c in zip(own, own[1:], own[2:], strict=False)}
                if met:
                    around, word = zip(*met, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(around, pa.int64()), pa.array(word, pa.binary()), pa.array([toxic] * len(met), pa.int32())], ["around", "word", "toxic"])


def hash_of(*words: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b"\x00".join(words)) - (1 << 63)


def dictionaries(learning: DataFrame) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary, from ``learning`` (text, toxic)."""
    met = learning.select("text", "toxic").mapInArrow(_surroundings, "around long, word binary, toxic int")
    met = met.groupBy("around", "word").agg(F.max("toxic").alias("t"), F.max(1 - F.col("toxic")).alias("o"))
    seen = staged(met.groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "words")
    totals = seen.agg(F.sum("t"), F.sum("o")).first()
    t, o = float(totals[0] or 0), float(totals[1] or 0)
    common = [bytes(r[0]) for r in seen.where("o > 0").orderBy(F.desc("o"), "word").limit(3 * COMMON_WORDS).select("word").collect()]
    if not t or not o:
        return b" ".join(common), b" ".join(common)
    begun = F.transform(F.sequence(F.lit(STEM[0]), F.lit(STEM[1])), lambda n: F.substring("word", F.lit(1), n))
    stems = seen.withColumn("stem", F.explode(F.array_distinct(begun))).where(F.octet_length("stem").between(*STEM) & (F.octet_length("stem") < F.octet_length("word")))
    seen = seen.select("word", "t", "o").unionAll(stems.select(F.col("stem").alias("word"), "t", "o")).groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    ratio = ((F.col("t") + 0.5) / t) / ((F.col("o") + 0.5) / o)
    spread = (F.col("t") - F.col("o") * (t / o)) / F.sqrt(F.col("t") + F.col("o") * (t / o) ** 2 + 1)
    telling = seen.where(F.col("t") >= SEEN).where(ratio >= TIMES).where(spread >= DEVIATIONS).orderBy((F.log(ratio) * F.sqrt("t")).desc(), "word").limit(TOXIC_WORDS)
    toxic = b" ".join(reversed(_longest({bytes(r[0]): r[1] for r in telling.select("word", "t").collect()})))
    shared = b" ".join(reversed(common[:COMMON_WORDS]))
    further = b" ".join(common[COMMON_WORDS:])
    further = (further * (1 + len(toxic) // max(1, len(further))) if further else b" " * len(toxic))[: len(toxic)]
    return shared + b" " + toxic + b" ", shared + b" " + further + b" "


def _longest(found: dict[bytes, int]) -> list[bytes]:
    """``found`` without beginnings that mostly go on to a longer one of ``found``."""
    return [w for w, t in found.items() if not any(len(x) > len(w) and x.startswith(w) and 2 * u > t for x, u in found.items())]


class Comparer:
    """Lengths of windows under the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard

        settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, window_log=17, write_content_size=False, write_checksum=False, write_dict_id=False)

        def compressor(content: bytes):
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(dict_data=own, compression_params=settings).compress

        self.toxic, self.ordinary = compressor(toxic), compressor(ordinary)

    def features(self, text: str) -> list[float]:
        """What the windows have in common with toxic text, summed and counted, by word and in all."""
        own = text_words(text)
        toxic, ordinary, gains = self.toxic, self.ordinary, []
        for i in range(0, len(own), WINDOW):
            window = b" " + b" ".join(own[i : i + WINDOW]) + b" "
            gains.append(len(ordinary(window)) - len(toxic(window)))
        gain, n = np.maximum(np.array(gains or [0]), 0), len(own) + 1
        beyond = np.maximum(gain - 1, 0).sum()
        sums = (gain.sum(), beyond, (gain >= 3).sum(), (gain >= 4).sum(), (gain >= 6).sum())
        return [*(math.sqrt(100.0 * s / n) for s in sums), *(math.log1p(s) for s in sums[1:]), float(gain.max()), math.log(n)]


def _featured(model: tuple[bytes, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparer = Comparer(*model)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = [comparer.features(t) for t in large_text(piece.column("text")).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("toxic"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "toxic", "features"])

    return run


def _scored(contents: tuple[bytes, bytes], weights: np.ndarray, base: float, columns: list[str], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparer = Comparer(*contents)
        for batch in batches:
            for piece in pieces(batch, "text"):
                z = np.array([comparer.features(t) for t in large_text(piece.column("text")).to_pylist()]) @ weights + base
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in columns), pa.array(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))], [*columns, name])

    return run


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text and toxic (0 or 1) of labelled learning documents, a bounded number of each class; and how many documents each class has in all."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    marks = marks.where(crc_remainder("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = staged(marks.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi"), "marks")
    totals = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}
    place = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marks.where("toxic = 1").orderBy(*place).limit(TOXIC).unionAll(marks.where("toxic = 0").orderBy(*place).limit(ORDINARY))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id"), totals  # at most TOXIC + ORDINARY rows


def learn(docs: DataFrame, labels: DataFrame) -> tuple[tuple[bytes, bytes], np.ndarray, float]:
    """Dictionaries, weights and constant of the curve."""
    rows, totals = labelled(docs, labels)
    rows = staged(rows, "labelled")
    for_curve = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(3)) == 0
    width = len(Comparer(b"", b"").features(""))
    if len(totals) < 2:
        return (b"", b""), np.zeros(width), 500.0 if totals.get(1) else -500.0
    contents = dictionaries(rows.where(~for_curve))
    found = rows.where(for_curve).select("doc_id", "text", "toxic").mapInArrow(_featured(contents), "doc_id long, toxic int, features array<double>")
    found = staged(found.select(F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("vector"), "doc_id"), "features")
    shares = {r[0]: r[1] for r in found.groupBy("label").count().collect()}
    if len(shares) < 2:
        return contents, np.zeros(width), math.log(totals[1] / totals[0])
    fitted = LogisticRegression(maxIter=60, regParam=1e-3, featuresCol="vector").fit(found)
    beyond = math.log(max(1, totals[1] / TOXIC) / max(1, totals[0] / ORDINARY))  # a class that is cut to a part weighs as all of it
    return contents, fitted.coefficients.toArray(), float(fitted.intercept) + beyond


def score(docs: DataFrame, model: tuple[tuple[bytes, bytes], np.ndarray, float], name: str = "score") -> DataFrame:
    """``docs`` with a score for each row; only its text is looked at. A column of that name is replaced."""
    docs = docs.drop(name)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_scored(*model, docs.columns, name), f"{fields}, `{name}` double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``; learns where crc32(doc_id) mod 5 is not 0."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score(texts, learn(docs, labels))
    return scored.select("doc_id", F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that are predicted to be toxic; all their columns stay as they are."""
    name = max(docs.columns, key=len) + "_score"
    return score(docs, learn(docs, labels), name).where(F.col(f"`{name}`") < 0.5).select(docs.columns)
