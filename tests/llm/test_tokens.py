"""Token counts at every prefix and SentencePiece on the tokenizers library, against the libraries themselves."""

import hashlib
import random
import struct

import pytest

pytest.importorskip("marketweave.llm")

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from marketweave.llm import spiece  # noqa: E402
from marketweave.llm import token_prefix as tp  # noqa: E402

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["'re", "'r", "'ll", " ", "  ", "\n", "\n\n", "\t", "<|endoftext|>", "<|end", "é", "ß", "日本", "😀", "\x1c", "\x85", " ", "　", "a", "don't", "1", "12", "!!", "Hello", " world", "...", "--------", "x'", "́", "२", "Ⅷ", "²", "_", "ſ"]


@pytest.fixture(scope="module")
def counter():
    return tp.PrefixCounter(open(BPE, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_every_prefix_has_the_librarys_count(counter, library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(10))) for _ in range(400)] + ["x" * 300, "-" * 700, "abc" * 120 + "\n" * 40 + "z", "the quick brownfox " * 12]
    for text, counts in zip(texts, counter.counts(texts), strict=True):
        assert counts.tolist() == [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)], text


def test_dictionaries_can_begin_anew(library, monkeypatch):
    monkeypatch.setattr(tp, "ENTRIES", 5)
    own = tp.PrefixCounter(open(BPE, encoding="utf-8").read())
    for text in ("one two three four five six seven", "eight nine ten one two", "don't ''re"):
        assert next(own.counts([text]))[-1] == len(library.encode(text).ids)


def test_long_pieces_take_linear_memory(counter, library):
    text = "q" * 60_000
    assert next(counter.counts([text]))[-1] == len(library.encode(text).ids)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tp.PrefixCounter(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


ROWS = [(1, "Hello world, this is it."), (2, None), (3, ""), (1, "Hello world, this is it."), (None, "x<|endoftext|>y"), (4, "ab " * 2000), (5, "naïve 日本語 😀")]


def test_counts_and_stored_table(spark, library):
    docs = spark.createDataFrame([(*r, "clash") for r in ROWS], "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, tp.count_tokens(docs, BPE, limit=6).collect()), key=repr)
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    want = []
    for d, t in ROWS:
        t = t or ""
        within = max(k for k in range(min(len(t), 400) + 1) if size(t[:k]) <= 6)
        want.append((d, len(t.encode()), size(t), size(t) > 6, within))
    assert got == sorted(want, key=repr)
    for r in tp.prefix_table(docs, BPE).collect():
        text = next(t or "" for d, t in ROWS if d == r["doc_id"])
        if len(text) < 100:
            assert [tp.tokens_up_to(r["steps"], k) for k in range(len(text) + 1)] == [size(text[:k]) for k in range(len(text) + 1)]
            assert tp.cut_for_budget(r["steps"], 3) == max(k for k in range(len(text) + 1) if size(text[:k]) <= 3)
    assert tp.count_tokens(docs.limit(0), BPE).count() == 0


def test_query_counts_like_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    from marketweave.llm.queries import QUERIES

    for r in QUERIES["op3_token_counts"](spark, "/root/testdata/sf0.001").collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)


SP_TEXTS = ["", " ", "Hello world", "  two  spaces ", "tab\tnew\nline", "日本語 😀 é", "▁ marker", "​\x00x", "a" * 300, "</s> <unk> <0x41>", "१२ Ⅷ ﬁ", "x " * 50]


def test_rebuilt_model_has_parity_and_round_trip():
    codec, original = spiece.Codec(open(PIECES, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(2)
    texts = SP_TEXTS + ["".join(rng.choices(PARTS, k=rng.randrange(1, 12))) for _ in range(400)]
    for text, (ids, fallbacks, back) in zip(texts, codec.encode(texts), strict=True):
        assert not fallbacks and ids.tolist() == original.encode(text), text
        assert back == (codec.decode(ids.tolist()) == text), text
        if "▁" not in text:
            assert codec.decode(ids.tolist()) == text == original.decode(ids.tolist()), text
        assert codec.tokenizer.encode(text, add_special_tokens=False).ids == ids.tolist(), text  # whole, not by stretches


def field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, bytes):
        return varint(number * 8 + 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number * 8 + 5) + struct.pack("<f", value)
    return varint(number * 8) + varint(value)


def unigram_model(fold=0, fallback=1):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + ([(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else [])
    scored = {"▁": -3.0, "a": -4.0, "b": -4.5, "c": -5.0, "ab": -5.5, "▁ab": -4.2, "abc": -6.0, "▁a": -5.1, "bc": -6.2, "▁▁": -6.5, "d": -7.0, ",": -4.1}
    body = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in [*pieces, *((p, s, 1) for p, s in scored.items())])
    return body + field(2, field(3, 1) + field(35, fallback)) + field(3, field(1, b"identity") + field(3, 1) + field(4, fold) + field(5, 1))


@pytest.mark.parametrize("fold", [0, 1])
def test_unigram_scores_are_rebuilt(fold):
    content = unigram_model(fold)
    codec, original = spiece.Codec(content), sentencepiece.SentencePieceProcessor(model_proto=content)
    rng = random.Random(4)
    texts = ["", "abc", "ab abc", "a  b", "é", *("".join(rng.choices("abcd ,é", k=rng.randrange(14))) for _ in range(300))]
    for text, (ids, fallbacks, back) in zip(texts, codec.encode(texts), strict=True):
        assert not fallbacks and ids.tolist() == original.encode(text), text
        assert back == (codec.decode(ids.tolist()) == text), text
    assert codec.model.kind == spiece.UNIGRAM and codec.model.byte_fallback


def test_frames(spark):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, n_tokens int")
    original = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in spiece.checked(docs, PIECES).collect():
        text = next(t or "" for d, t in ROWS if d == r["doc_id"])
        ids = original.encode(text)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()) and r["parity"] and r["round_trip"] and r["n_fallback"] == 0
    encoded = spiece.encode(docs, PIECES)
    assert encoded.columns == ["doc_id", "text", "input_ids", "n_tokens", "parity", "n_fallback"]
    assert all(r["input_ids"] == original.encode(r["text"] or "") for r in encoded.collect())
    assert sorted(map(tuple, spiece.decode(encoded, PIECES).collect()), key=repr) == sorted(((d, t or "") for d, t in ROWS), key=repr)
    assert spiece.checked(docs.limit(0), PIECES).count() == spiece.encode(docs.limit(0), PIECES).count() == 0


@pytest.mark.parametrize("run", [128, 3, 1])
def test_runs_of_stretches_are_cut_as_they_stand(monkeypatch, run):
    monkeypatch.setattr(spiece, "RUN", run)
    codec, original = spiece.Codec(open(PIECES, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(5)
    texts = ["".join(rng.choices([*PARTS, " ", " a", "▁", " ▁b", "the"], k=rng.randrange(0, 30))) for _ in range(300)]
    for text, (ids, fallbacks, _) in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == original.encode(text) and not fallbacks, text


def test_a_broken_rebuild_is_counted_and_replaced():
    codec, original = spiece.Codec(open(PIECES, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["the cat sat on the mat", "nothing here", "the theatre", ""]
    whole = codec.inner.encode_batch_fast

    class Broken:
        """Gives other ids for whatever holds a word that begins with "the"."""

        def encode_batch_fast(self, texts, add_special_tokens=False):
            return [type("E", (), {"ids": [5] if "▁the" in t else e.ids})() for t, e in zip(texts, whole(texts, add_special_tokens=False), strict=True)]

        def __getattr__(self, name):
            return getattr(inner, name)

    inner, codec.inner = codec.inner, Broken()
    got = list(codec.encode(texts))
    assert [ids.tolist() for ids, _, _ in got] == [original.encode(t) for t in texts]
    assert [n for _, n, _ in got] == [2, 0, 2, 0]


def test_a_codec_forgets_what_it_has_not_met(monkeypatch):
    monkeypatch.setattr(spiece, "ENTRIES", 3)
    codec, original = spiece.Codec(open(PIECES, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in ("one two three four five", "six seven", "one two", "eight nine ten eleven", "one two", "twelve"):
        assert next(codec.encode([text]))[0].tolist() == original.encode(text)
        assert len(codec.ids_of) + len(codec.older) <= 14
    assert " five" not in codec.ids_of and " five" not in codec.older
