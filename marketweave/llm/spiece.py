"""SentencePiece models on the tokenizers library: encoding and decoding with checked parity.

``parse_model`` reads the model's protobuf, which is a handful of fields.
``rebuild`` makes a tokenizer of it:

* normaliser: the model's precompiled character map, folding of white space if
  the model asks for it, the marker U+2581 for spaces, the dummy prefix;
* a unigram model of pieces and scores, or a BPE model whose merges are all
  pairs of pieces that make a piece, the better scored piece first;
* byte pieces for characters outside the vocabulary;
* the decoder that undoes this.

Where no piece holds the marker after another character, a text falls into
stretches that begin with markers and are encoded each for itself: the ids of
a text are those of its stretches, one after another. Each task keeps the
ids of the stretches it has seen; new ones are encoded as one batch, on the
library's threads. Where a piece spans words, whole texts are the stretches.

New stretches that begin with a marker and end with another character keep
apart when written one after another, so they are encoded and decoded as long
runs, and cut by the lengths of their pieces.

Parity: the ids are those of the rebuilt tokenizer. Every new stretch is also
encoded by sentencepiece itself; only where the two differ are sentencepiece's
ids taken instead, and ``n_fallback`` counts these stretches of a row.
``parity`` says that there are none.

Null texts count as empty and have no ids. Rows that repeat, or lack a doc_id,
are encoded each for itself. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import large_text, pieces

MARKER = "▁"
#: Kinds of pieces and of models in the protobuf.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Stretches that a task learns until those that it has not met since the last time go, bytes of text whose new stretches are encoded together, and stretches of a run.
ENTRIES, TOGETHER, RUN = 75_000, 1 << 18, 128
#: Threads of the library in a worker, unless the cluster sets another number.
THREADS = "2"


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    fold_spaces: bool = True
    escape_spaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    at = 0
    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield number, data[at : at + size]
            at += size


def parse_model(data: bytes) -> Model:
    """The pieces, scores and settings of a sentencepiece model file."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            model.pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif number == 2:
            own = dict(_fields(value))
            model.kind, model.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
        elif number == 3:
            own = dict(_fields(value))
            model.charsmap = own.get(2, b"")
            model.dummy_prefix, model.fold_spaces, model.escape_spaces = (bool(own.get(n, 1)) for n in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, in the order in which sentencepiece joins them: by the score of the whole, then from the left."""
    usable = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for whole, i in usable.items():
        for cut in range(1, len(whole)):
            left, right = whole[:cut], whole[cut:]
            if left in usable and right in usable:
                found.append((-model.pieces[i][1], i, usable[left], usable[right], left, right))
    return [(x[4], x[5]) for x in sorted(found)]


def rebuild(model: Model):
    """The tokenizer of a parsed model, without pre-tokenizer: it takes whole texts."""
    os.environ.setdefault("RAYON_NUM_THREADS", THREADS)
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        tokenizer = Tokenizer(models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unknown, byte_fallback=model.byte_fallback))
    else:
        names = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        tokenizer = Tokenizer(models.BPE(names, _merges(model), unk_token=None if unknown is None else model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback))
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.fold_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])])
    own = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        tokenizer.add_tokens(own)
    return tokenizer


class Codec:
    """Encoding and decoding under one model file's content."""

    def __init__(self, content: bytes):
        import sentencepiece
        from tokenizers import decoders, normalizers

        self.model = model = parse_model(content)
        self.tokenizer = rebuild(model)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=content)
        #: For stretches: they are normalised already, and keep their first space.
        self.inner = self.tokenizer.from_str(self.tokenizer.to_str())
        self.inner.normalizer = normalizers.Sequence([])
        self.inner.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()])
        used = [(p, kind) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)]
        apart = model.escape_spaces and not model.fold_spaces and not any(MARKER in p.lstrip(MARKER) or kind == USER_DEFINED for p, kind in used)
        #: A stretch: spaces, which become markers, and what follows them. Unigram scores are sums over a text, so they split alike.
        self.split = re.compile(f"[ {MARKER}]+[^ {MARKER}]*|[^ {MARKER}]+").findall if apart else None
        #: Bytes that each id stands for, -1 where that is open.
        self.widths = np.array([len(p.encode()) if kind in (NORMAL, USER_DEFINED) else 1 if kind == BYTE else -1 for p, _, kind in model.pieces], np.int64)
        self.ids_of: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.differs: set[str] = set()
        self.changed: set[str] = set()

    def _forget(self) -> None:
        """What has been met since the last time stays, in second place; the rest goes."""
        self.older, self.ids_of = self.ids_of, {}
        self.differs &= self.older.keys()
        self.changed &= self.older.keys()

    def normalise(self, text: str) -> str:
        """The text as the model sees it, markers still written as spaces."""
        if self.model.charsmap:
            return self.tokenizer.normalizer.normalize_str(text).replace(MARKER, " ")
        return " " + text if self.model.dummy_prefix else text

    def learn(self, new: list[str]) -> None:
        """Encodes new stretches in runs on the library's threads, holds the ids against sentencepiece's, and decodes them; singly where a run does not come out alike."""
        marks = (" ", MARKER)
        plain = [s for s in new if s[0] in marks and s[-1] not in marks]
        runs = [plain[k : k + RUN] for k in range(0, len(plain), RUN)]
        texts = ["".join(run).replace(" ", MARKER) for run in runs]
        cut = int(self.model.dummy_prefix)  # sentencepiece puts a marker first by itself, except before an empty text
        found = [e.ids for e in self.inner.encode_batch_fast(texts, add_special_tokens=False)]
        right = self.original.encode([t[cut:] for t in texts], num_threads=1)
        back = self.inner.decode_batch(found, skip_special_tokens=False)
        singly = [s for s in new if s[0] not in marks or s[-1] in marks]
        for run, text, ids, own, again in zip(runs, texts, found, right, back, strict=True):
            if ids != own or again != text.replace(MARKER, " ") or not self._cut(run, ids):
                singly += run
        if singly:
            self._learn_singly(singly)

    def _cut(self, run: list[str], ids: list[int]) -> bool:
        """The ids of a run given to its stretches; false if they do not end where the stretches do."""
        ids = np.array(ids, np.int32)
        widths = self.widths[ids]
        if (widths < 0).any():
            return False
        ends = np.cumsum(widths)
        wanted = np.cumsum([len(s.replace(" ", MARKER).encode()) for s in run])
        at = np.searchsorted(ends, wanted)
        if at[-1] >= len(ends) or (ends[at] != wanted).any() or any(MARKER in s for s in run):
            return False
        raw, before = ids.tobytes(), 0
        for s, end in zip(run, (4 * (at + 1)).tolist(), strict=True):
            self.ids_of[s] = raw[before:end]
            before = end
        return True

    def _learn_singly(self, new: list[str]) -> None:
        found = [e.ids for e in self.inner.encode_batch_fast([s.replace(" ", MARKER) for s in new], add_special_tokens=False)]
        cut = int(self.model.dummy_prefix)
        right = self.original.encode([s[cut:] for s in new] if cut else new, num_threads=1)
        for k in (k for k, s in enumerate(new) if cut and len(s) == 1 and s in (" ", MARKER)):
            right[k] = self.original.encode("a ")[len(self.original.encode("a")) :]
        self.differs.update(s for s, x, y in zip(new, found, right, strict=True) if x != y)
        back = self.inner.decode_batch(right, skip_special_tokens=False)
        self.changed.update(s for s, x in zip(new, back, strict=True) if x != s)
        self.ids_of.update((s, array("i", x if x == y else y).tobytes()) for s, x, y in zip(new, found, right, strict=True))

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, int, bool]]:
        """The ids of each text, in how many of its stretches sentencepiece's ids stand for other ones of the rebuilt tokenizer, and whether decoding gives the text again."""
        if self.split is None:
            yield from self._whole(texts)
            return
        if len(self.ids_of) > ENTRIES:
            self._forget()
        split = [self.split(self.normalise(t)) if t else [] for t in texts]
        known, older = self.ids_of, self.older
        new = []
        for s in set().union(*split):
            if s not in known:
                if s in older:
                    known[s] = older[s]
                else:
                    new.append(s)
        if new:
            self.learn(new)
        for text, own in zip(texts, split, strict=True):
            ids = np.frombuffer(b"".join(map(known.__getitem__, own)), np.int32)
            back = (not self.changed or self.changed.isdisjoint(own)) and (not self.model.charsmap or "".join(own)[int(self.model.dummy_prefix) :] == text)
            yield ids, sum(s in self.differs for s in own) if self.differs and not self.differs.isdisjoint(own) else 0, back

    def _whole(self, texts: list[str]) -> Iterator[tuple[np.ndarray, int, bool]]:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        right = self.original.encode(texts, num_threads=1)
        for text, ids, own, back in zip(texts, encoded, right, self.tokenizer.decode_batch(right, skip_special_tokens=False), strict=True):
            yield np.array(ids if ids == own else own, np.int32), int(ids != own), back == text

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)


def _content(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (doc_id, text and any others) with input_ids, n_tokens, parity and n_fallback, which replace columns of these names."""
    content = _content(docs, path)
    rest = [c for c in docs.columns if c not in ("input_ids", "n_tokens", "parity", "n_fallback")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(content.value)  # of this task alone: a worker that goes on to other work shall not hold it
        for batch in batches:
            for piece in pieces(batch, "text", TOGETHER):
                done = list(codec.encode(large_text(piece.column("text")).to_pylist()))
                sizes = [len(ids) for ids, _, _ in done]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate([ids for ids, _, _ in done])))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), lists, pa.array(sizes, pa.int64()), pa.array([not n for _, n, _ in done]), pa.array([n for _, n, _ in done], pa.int64())], [*rest, "input_ids", "n_tokens", "parity", "n_fallback"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(rest).schema)
    return docs.select(rest).mapInArrow(run, f"{fields}, input_ids array<int>, n_tokens long, parity boolean, n_fallback long")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded text of ``encoded`` (doc_id, input_ids)."""
    content = _content(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(content.value)  # of this task alone: a worker that goes on to other work shall not hold it
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([codec.decode(ids or []) for ids in batch.column("input_ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "input_ids").mapInArrow(run, "doc_id long, text string")


def checked(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, ids_sha256 (of the ids as 32-bit little-endian numbers), parity, round_trip (decoding gives the text), n_fallback for each row of ``docs``."""
    content = _content(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(content.value)  # of this task alone: a worker that goes on to other work shall not hold it
        for batch in batches:
            for piece in pieces(batch, "text", TOGETHER):
                texts = large_text(piece.column("text")).to_pylist()
                rows = []
                for text, (ids, fallbacks, back) in zip(texts, codec.encode(texts), strict=True):
                    rows.append((len(text.encode()), len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), not fallbacks, back, fallbacks))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, columns)], ["doc_id", "n_bytes", "n_tokens", "ids_sha256", "parity", "round_trip", "n_fallback"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, ids_sha256 string, parity boolean, round_trip boolean, n_fallback long")
