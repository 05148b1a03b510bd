"""Exact token counts at every prefix of a text, by dynamic programming over byte-level BPE.

A prefix of a piece ends in the one token t for which the encoding of what
stands before t ends in a token that stays apart from t, so

    count(prefix) = count(prefix without t) + 1.

Whether two tokens stay apart is asked of the library once for each pair.
Pieces are what the tokenizer's pattern splits a text into; counts of all
prefixes of a piece are kept while a task runs, and counts of a text's
prefixes are running sums of its pieces. Three places need care, since the
pattern looks ahead: the last of several white spaces belongs to the next piece
only once that has begun, a contraction is one only when complete, and the
start of a special token is ordinary text. All counts are those of the library
for the prefix as a text of its own.

With the table of counts stored, questions such as "how many tokens has the
text up to here", "where must it be cut to have at most n" or "how many
windows of n tokens" need no encoding again.

Characters whose class differs between the splitting pattern here and the
library's are detected by asking the library; texts that hold one are split by
the library itself. The tokenizer must be byte-level BPE without prefix space
or normaliser, with plain added tokens; others are refused.

Null texts count as empty: no bytes, no tokens. Repeated rows are counted each
for itself, rows without a doc_id as well. An empty table gives no rows.
Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import json
import re
import sys
import types
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import large_text, pieces

#: Fixed value: the pattern of byte-level BPE, in classes that ``re`` knows: letters, digits, the rest, white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Pieces that a worker keeps, beyond which they are begun anew, and bytes of text whose new pieces are learnt together.
ENTRIES, TOGETHER = 700_000, 4 << 20


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts of all prefixes under one tokenizer file's content."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        spec = json.loads(content)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        if spec["model"].get("type", "BPE") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("only byte-level BPE with plain added tokens is supported")
        self.library = Tokenizer.from_str(content)
        self.model, self.split_library = self.library.model, self.library.pre_tokenizer.pre_tokenize_str
        self.vocabulary = {t: t for t in spec["model"]["vocab"]}  # one string for each token, however often it is met
        self.table = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.longest: dict[str, int] = {}  # of the tokens that end in these three letters
        for t in self.vocabulary:
            if len(t) > 2:
                self.longest[t[-3:]] = max(self.longest.get(t[-3:], 0), len(t))
        self.split = re.compile(PATTERN).findall
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.first_letters = {n[0] for n in names}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: set[str] = set()
        self.odd: set[str] = set()
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.within: list[bytes] = []
        self.total, self.length, self.blank = array("i"), array("i"), array("b")

    def _apart(self, key: tuple[str, str]) -> bool:
        """Whether the library encodes the two tokens' text as just these two."""
        a, b = key
        found = [t.value for t in self.model.tokenize(a + b)] == [a, b] if a else len(self.model.tokenize(b)) == 1
        if len(self.pairs) > ENTRIES:
            self.pairs.clear()
        self.pairs[key] = found
        return found

    def _extend(self, letters: str, last: list[str], counts: list[int]) -> None:
        """The last token and the count of every prefix of a piece, given in byte letters; the lists hold those of its shorter prefixes already."""
        vocabulary, known, longest = self.vocabulary.get, self.pairs.get, self.longest.get
        for i in range(len(last), len(letters) + 1):
            token = last[-1] + letters[i - 1]  # most often the token before grows
            start = i - len(token)
            size = None
            while True:
                if (own := vocabulary(token)) is not None:
                    key = last[start], own
                    apart = known(key)
                    if apart or apart is None and self._apart(key):
                        break
                size = min(i, longest(letters[i - 3 : i], 2) if i > 2 else i) if size is None else size - 1
                if not size:
                    raise ValueError("the vocabulary lacks a byte")
                start = i - size
                token = letters[start:i]
            last.append(own)
            counts.append(counts[start] + 1)

    def _letters(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece.replace(" ", "\u0120")
        return piece.encode().decode("latin-1").translate(self.table)

    def learn(self, new: set[str]) -> None:
        """Keeps the counts after each character of new pieces. In order, a piece goes on from the prefix that it shares with the one before."""
        before, last, counts = "", [""], [0]
        for letters, piece in sorted((self._letters(p), p) for p in new):
            shared, most = 0, min(len(letters), len(before))
            while shared < most and letters[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], counts[shared + 1 :]
            self._extend(letters, last, counts)
            before = letters
            own = counts if piece.isascii() else [0, *(counts[e] for e in accumulate(map(_width, piece)))]
            if piece[0] == "'" and len(piece) == 3 and piece[1:].isalpha():  # 're, 've, 'll: before they end, two pieces
                own = [0, own[1], sum(self.count_plain(x) for x in self.split(piece[:2])), own[3]]
            self.number[piece] = len(self.within)
            self.within.append(bytes(own[1:]) if own[-1] < 256 else np.array(own[1:], np.int32).tobytes())
            self.total.append(own[-1])
            self.length.append(len(piece))
            self.blank.append(piece.isspace())

    def count_plain(self, piece: str) -> int:
        counts = [0]
        self._extend(self._letters(piece), [""], counts)
        return counts[-1]

    def _usual(self, text: str) -> bool:
        """Whether the pattern here classes every character as the library does."""
        for c in set(text) - self.known:
            (self.known if self._same_class(c) else self.odd).add(c)
        return not self.odd or self.odd.isdisjoint(text)

    def _same_class(self, c: str) -> bool:
        return all([len(x.encode()) for x in self.split(s)] == [len(x) for x, _ in self.split_library(s)] for s in (f"a{c}", f"1{c}", f"!{c}", f" {c}{c}a"))

    def pieces(self, text: str) -> list[str]:
        if text.isascii() and not self.odd or self._usual(text):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.split_library(text)]

    def _split(self, text: str) -> list[tuple[list[str], str]]:
        """Pieces of each stretch, and the special token that ends it, if one does."""
        if self.special is None or self.first_letters.isdisjoint(text):
            return [(self.pieces(text), "")]
        at, out = 0, []
        for m in self.special.finditer(text):
            out.append((self.pieces(text[at : m.start()]), m.group()))
            at = m.end()
        return [*out, (self.pieces(text[at:]), "")]

    def counts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text, the exact token counts of text[:0], text[:1], ... text[:len(text)]."""
        if len(self.within) > ENTRIES:
            self._forget()
        split = list(map(self._split, texts))
        new = {piece for stretches in split for own, _ in stretches for piece in own if piece not in self.number}
        if new:
            self.learn(new)
        for stretches in split:
            out, before = [np.zeros(1, np.int32)], 0
            for own, special in stretches:
                counts, total = self._stretch(own)
                out.append(counts + before)
                before += total
                if special:  # its beginnings are ordinary text, which may join what stands before
                    tail, base = "".join(own[-2:]), before - sum(map(self.count_plain, own[-2:]))
                    out.append(np.array([base + sum(map(self.count_plain, self.pieces(tail + special[:j]))) for j in range(1, len(special))] + [before + 1], np.int32))
                    before += 1
            yield np.concatenate(out)

    def _stretch(self, own: list[str]) -> tuple[np.ndarray, int]:
        """Counts after each character of a stretch without special tokens, and its total."""
        if not own:
            return np.empty(0, np.int32), 0
        numbers = list(map(self.number.__getitem__, own))
        at = np.array(numbers)
        totals, lengths, blank = np.frombuffer(self.total, np.int32)[at], np.frombuffer(self.length, np.int32)[at], np.frombuffer(self.blank, np.int8)[at]
        ends = np.cumsum(totals, dtype=np.int32)
        if totals.max() < 256:
            counts = np.frombuffer(b"".join(map(self.within.__getitem__, numbers)), np.uint8).astype(np.int32)
        else:
            counts = np.concatenate([np.frombuffer(self.within[k], np.uint8 if t < 256 else np.int32) for k, t in zip(numbers, totals, strict=True)]).astype(np.int32)
        counts += np.repeat(ends - totals, lengths)
        for i in np.flatnonzero(blank[:-1]):
            if own[i + 1][0].isspace():
                counts[lengths[: i + 1].sum()] = ends[i] - totals[i] + self.count_plain(own[i] + own[i + 1][0])
        return counts, int(ends[-1])


def _width(c: str) -> int:
    """Bytes of a character in UTF-8."""
    return 1 + (c > "\x7f") + (c > "\u07ff") + (c > "\uffff")


def _counter(content: str) -> PrefixCounter:
    """One counter for a Python worker and tokenizer, kept between its tasks."""
    kept = sys.modules.setdefault("_marketweave_prefix_counters", types.ModuleType("_marketweave_prefix_counters"))
    if getattr(kept, "content", None) != content:
        kept.content, kept.counter = content, PrefixCounter(content)
    return kept.counter


def longest_within(counts: np.ndarray, budget: int) -> int:
    """The length of the longest prefix that has at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def _mapped(docs: DataFrame, path: str, answer: Callable[[np.ndarray], tuple], names: list[str], types_: list[pa.DataType], schema: str) -> DataFrame:
    content = docs.sparkSession.sparkContext.broadcast(open(path, encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(content.value)
        for batch in batches:
            for piece in pieces(batch, "text", TOGETHER):
                texts = large_text(piece.column("text")).to_pylist()
                rows = [(len(text.encode()), *answer(counts)) for text, counts in zip(texts, counter.counts(texts), strict=True)]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), pa.array(columns[0], pa.int64()), *(pa.array(c, t) for c, t in zip(columns[1:], types_, strict=True))], ["doc_id", "n_bytes", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, n_bytes long, {schema}")


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``steps`` (what each character adds to the count, 16-bit little-endian) for each row of ``docs``."""
    return _mapped(docs, path, lambda counts: (int(counts[-1]), np.diff(counts).astype("<i2").tobytes()), ["n_tokens", "steps"], [pa.int64(), pa.binary()], "n_tokens long, steps binary")


def tokens_up_to(steps: bytes, length: int) -> int:
    """The token count of the first ``length`` characters, from a stored row."""
    return int(np.frombuffer(steps, "<i2")[:length].sum(dtype=np.int64))


def cut_for_budget(steps: bytes, budget: int) -> int:
    """The length of the longest prefix with at most ``budget`` tokens, from a stored row."""
    return longest_within(np.concatenate(([0], np.frombuffer(steps, "<i2").cumsum(dtype=np.int64))), budget)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, chars_within (the longest prefix that keeps the limit) for each row of ``docs`` (doc_id, text)."""
    answer = lambda counts: (int(counts[-1]), bool(counts[-1] > limit), longest_within(counts, limit))
    return _mapped(docs, path, answer, ["n_tokens", "over_limit", "chars_within"], [pa.int64(), pa.bool_(), pa.int64()], "n_tokens long, over_limit boolean, chars_within long")
