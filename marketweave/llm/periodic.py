"""Periodic runs of words by an online sparse diagonal programme.

A run is a longest stretch of words in which words ``q`` apart are identical,
``q`` its smallest period, of at least ``max(least, times * q)`` words.

The programme walks over the words. The match length of lag q at word i, the
diagonal, counts how many words up to i equal the word q before them. An
earlier occurrence at that distance makes it longer by one; any other word ends
the diagonal, and if the stretch is then long enough the run is emitted. The
programme is sparse: of all earlier occurrences of a word, only those are
followed that can belong to a run. For a lag q in (2**(j-1), 2**j] that is the
nearest earlier occurrence of the 2**j words ending here. Inside a run of
smallest period q these 2**j >= q words recur at distance q and at no smaller
one, since a word sequence that is no power of a shorter one occurs in its own
powers only at whole periods; and a stretch of smaller period has a nearer
occurrence, so its multiples are never followed. So at each word at most one
diagonal of each size is active, n * log2(n) steps in all, whatever the words:
a text of one repeated word costs as much as any other.

Steps are carried out as arrays over all texts of a piece. Words and stretches
of words are compared by 64-bit hashes; every run is then held against the
words themselves.

Null and blank texts have no words and no runs. Rows that repeat, or share an
id, are each answered by themselves; a null id stays null. Empty tables give no
rows. Columns other than the id and the text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import _SPACE, mix, pieces, seeds, span_hashes, text_bytes

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_STRUCT = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the words between ASCII white space, in order; case matters."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)  # where a row begins, words part as well
    cut[offsets[:-1]] = True
    before = np.concatenate(([False], inside[:-1])) & ~cut
    starts = np.flatnonzero(inside & ~before)
    stops = np.flatnonzero(np.concatenate(([False], inside[:-1])) & (~inside | cut))
    return span_hashes(data, starts, stops), np.searchsorted(offsets, starts, "right") - 1


def _nearest(name: np.ndarray) -> np.ndarray:
    """For each place the nearest earlier place (in the array) of the same name, or -1."""
    order = np.argsort(name, kind="stable")
    same = name[order[1:]] == name[order[:-1]]
    out = np.full(len(name), -1, np.int64)
    out[order[1:][same]] = order[:-1][same]
    return out


def runs_of(hashed: np.ndarray, row: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, period) of all runs; words count over all rows, and no run leaves its row."""
    if not len(hashed):
        return (np.empty(0, np.int64),) * 3
    fold = seeds(2, 97)
    begin = np.concatenate(([0], np.flatnonzero(row[1:] != row[:-1]) + 1))
    first = np.repeat(begin, np.diff(np.append(begin, len(row))))  # of the word's row
    longest = int(np.diff(np.append(begin, len(row))).max())
    # rows never share a name; gram[i] names the 2**j words that end at word i
    gram = mix(hashed + mix(row.astype(np.uint64) + np.uint64(1)))
    alive = np.arange(len(hashed))  # words whose gram occurs elsewhere, so that a longer one may as well
    found, j = [], 0
    while True:
        size = 1 << j
        least_lag = size // 2 + 1 if j else 1
        if max(least, times * least_lag) > longest:
            break
        if j:
            longer = gram.copy()
            half = size // 2
            longer[half:] = mix(gram[half:] * fold[0] + gram[:-half] * fold[1])
            gram = longer
            alive = alive[alive - first[alive] >= size - 1]
        at = _nearest(gram[alive])
        recurs = at >= 0
        lag = np.where(recurs, alive - alive[at], 0)
        # the diagonals of this size: neighbouring words with one and the same lag
        on = np.flatnonzero((lag >= least_lag) & (lag <= size))
        if len(on):
            word, q = alive[on], lag[on]
            new = np.concatenate(([True], (word[1:] != word[:-1] + 1) | (q[1:] != q[:-1]) | (first[word[1:]] != first[word[:-1]])))
            opened = np.flatnonzero(new)
            closed = np.append(opened[1:], len(on)) - 1
            q = q[opened]
            start = word[opened] - size + 1 - q
            length = word[closed] + 1 - start
            enough = length >= np.maximum(least, times * q)
            found.append((start[enough], length[enough], q[enough]))
        again = recurs.copy()
        again[at[recurs]] = True
        alive = alive[again]
        if not len(alive):
            break
        j += 1
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _answered(least: int, times: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = text_bytes(piece.column("text"))
            hashed, row = word_hashes(data, offsets)
            start, length, period = runs_of(hashed, row, least, times)
            base = np.searchsorted(row, np.arange(piece.num_rows + 1))
            owner = np.searchsorted(base, start, "right") - 1
            bounds = np.searchsorted(owner, np.arange(piece.num_rows + 1))
            raw, runs, kept = data.tobytes(), [], []
            for i in range(piece.num_rows):
                own = raw[offsets[i] : offsets[i + 1]].split()  # bytes part at the same six bytes
                some = []
                dropped = np.zeros(len(own), bool)
                for k in range(bounds[i], bounds[i + 1]):
                    s, n, q = int(start[k] - base[i]), int(length[k]), int(period[k])
                    if own[s + q : s + n] == own[s : s + n - q]:
                        some.append({"start": s, "length": n, "period": q})
                        dropped[s + q : s + n] = True
                runs.append(some)
                kept.append(b" ".join(w for w, out in zip(own, dropped, strict=True) if not out) if some else b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(base[1:] - base[:-1], pa.int64()), pa.array(runs, pa.list_(_STRUCT)), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed for each row of ``docs`` (doc_id, text).

    ``collapsed`` holds the words that no run repeats, those after a run's first period left out, joined by one space.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(partial(_answered, least, times), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), the texts of every tenth crc32(doc_id) repeating their words from one place on with one period, words joined by one space."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cyclic = F.expr(r"""
        transform(array(struct(words, cast(size(words) as bigint) as n, h div 10 as g)), x ->
          transform(array(struct(x.words, x.n, x.g % x.n as a, 1 + (x.n - x.g % x.n) div (3 + x.g % 8) as p)), y ->
            array_join(transform(sequence(0L, y.n - 1), i -> y.words[int(if(i < y.a, i, y.a + (i - y.a) % y.p))]), ' '))[0])[0]
    """)  # fmt: skip
    marked = texts.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")))
    return marked.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.size("words") > 0), cyclic).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli) and the SHA-256 of all runs and of the collapsed text."""
    best = F.expr("array_sort(runs, (x, y) -> case when x.length != y.length then int(sign(y.length - x.length)) when x.start != y.start then int(sign(x.start - y.start)) else int(sign(x.period - y.period)) end)")
    best = F.try_element_at(best, F.lit(1))
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
