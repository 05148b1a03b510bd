"""Toxicity and language: accuracy on rows that taught nothing, and odd rows."""

import random
import zlib

import pyarrow as pa
import pytest

pytest.importorskip("marketweave.llm")

import numpy as np  # noqa: E402

from marketweave.llm import langid, toxicity  # noqa: E402

SYLLABLES = {"aa": ["ka", "to", "mi", "re"], "bb": ["zur", "wek", "lis", "ghu"], "cc": ["ká", "tó", "ñi", "ré"]}
SLURS = ["grumbolax", "snirquet", "vlodbrok"]


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    rows, marks = [], []
    for i in range(900):
        lang = rng.choice(list(SYLLABLES))
        own = text(rng, lang, rng.randrange(20, 120)).split()
        toxic = int(rng.random() < 0.25)
        for _ in range(max(2, len(own) // 20) * toxic):
            own.insert(rng.randrange(len(own) + 1), rng.choice(SLURS) + rng.choice(["", "s", "er"]))
        rows.append((i, " ".join(own), lang if i % 7 else None, "src"))
        marks.append((i, 1, toxic if i % 5 else None))
    return rows, marks


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_toxicity_on_held_out_rows(spark, corpus):
    rows, marks = corpus
    docs = spark.createDataFrame([*rows, (2000, None, "aa", "s"), (2001, "", "aa", "s"), (None, "ka to", None, None), (5, rows[5][1], None, None)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([*marks, (7, 0, 0), (99999, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + 4
    by = {r["doc_id"]: r for r in got}
    truth = {i: sum(w.startswith(tuple(SLURS)) for w in t.split()) > 0 for i, t, _, _ in rows}
    held = [i for i in truth if crc(i, 5) == 0]
    assert all(by[i]["held_out"] == (crc(i, 5) == 0) for i in truth) and by[None]["held_out"]
    assert np.mean([by[i]["predicted"] == truth[i] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert by[2000]["score"] == by[2001]["score"] and by[2000]["predicted"] == 0
    # other columns and held-out labels are no inputs
    turned = [(i, q, (1 - t if t is not None else None) if crc(i, 5) == 0 else t) for i, q, t in marks]
    again = toxicity.toxicity(docs.withColumn("lang", docs.source).withColumn("score", docs.doc_id), spark.createDataFrame([*turned, (7, 0, 0), (99999, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int"))
    assert {(r["doc_id"], r["score"]) for r in again.collect()} == {(r["doc_id"], r["score"]) for r in got}
    docs = docs.withColumn("score", docs.doc_id * 2)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and all(r["score"] == (r["doc_id"] and r["doc_id"] * 2) for r in kept.collect())
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in got if not r["predicted"])


@pytest.mark.parametrize("marks,score", [([], 0.0), ([(i, 0) for i in range(20)], 0.0), ([(i, 1) for i in range(20)], 1.0)])
def test_toxicity_with_one_class_or_none(spark, marks, score):
    docs = spark.createDataFrame([(i, f"w{i} x y") for i in range(20)] + [(30, None)], "doc_id long, text string")
    got = toxicity.toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    assert {round(r["score"], 6) for r in got} == {score}


@pytest.mark.parametrize("caps", [(4000, 8000), (100, 200), (100, 8000)])
def test_the_bounded_sample_keeps_the_odds_of_all_labels(spark, monkeypatch, caps):
    monkeypatch.setattr(toxicity, "TOXIC", caps[0])
    monkeypatch.setattr(toxicity, "ORDINARY", caps[1])
    rng = random.Random(3)
    rows = [(i, text(rng, "aa", 12), int(rng.random() < 0.1)) for i in range(4000)]  # texts tell nothing, so every score is the share of toxic ones
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic")).collect()
    assert abs(np.mean([r["score"] for r in got]) - 0.1) < 0.05


def test_toxicity_of_an_empty_table(spark, corpus):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.toxicity(docs, spark.createDataFrame(corpus[1], "doc_id long, quality int, toxic int")).count() == 0


def test_copies_teach_no_more_than_one(spark):
    shared = " ".join(f"ordinary{i}" for i in range(60))
    rows = [(i, shared if i % 2 else f"a{i} b{i} c{i} trashword d{i} e{i}", int(i < 40)) for i in range(80)]
    toxic, _ = toxicity.dictionaries(spark.createDataFrame([(t if i >= 40 or i % 2 else t, y) for i, t, y in rows], "text string, toxic int"))
    assert b"ordinary5" not in toxic.split(b"trashword")[-1]


def test_language_on_held_out_rows(spark, corpus):
    rows, _ = corpus
    odd = [(3000, None, "aa", "s"), (3001, "", "aa", "s"), (3002, "12 34 !!", "bb", "s"), (None, "zur wek lis ghu zur wek", None, None), (3003, "漢字", "aa", "s"), (4, rows[4][1], None, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, lang_pred string")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    held = [i for i, *_ in rows if crc(i, 3) == 1]
    assert all(by[i]["held_out"] for i in held) and sum(r["held_out"] for r in got) >= len(held)
    named = [i for i, _, lang, _ in rows if crc(i, 3) == 1 and lang]
    right = {i: lang for i, _, lang, _ in rows}
    assert np.mean([by[i]["lang_pred"] == right[i] for i in named]) > 0.97
    assert {by[i]["lang_pred"] for i in (3000, 3001, 3002)} == {"und"} and {by[i]["score"] for i in (3000, 3001, 3002)} == {0.0}
    assert by[3003]["lang_pred"] in SYLLABLES and by[None]["lang_pred"] == "bb"
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_without_learning_rows(spark):
    docs = spark.createDataFrame([(1, "ka to", None), (2, None, "aa")], "doc_id long, text string, lang string").where("lang is null")
    assert [tuple(r) for r in langid.identify(docs).collect()] == [(1, crc(1, 3) == 1, "und", 0.0)]
    assert langid.identify(docs.limit(0)).count() == 0


def test_more_languages_than_bits(spark):
    letters = lambda k: chr(97 + k // 26) * 2 + chr(97 + k % 26) * 2
    rows = [(i, f"{letters(k)}x y{letters(k)} " * 6, f"l{k:02d}") for i, k in enumerate([*range(70)] * 6)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert np.mean([r["lang_pred"] == rows[r["doc_id"]][2] for r in got]) > 0.95


def test_grams_stay_within_rows_and_words():
    value, row = langid.grams(pa.array(["Ab", "", None, "a1b", "xyz"]))
    as_text = [(int(r), int(v).to_bytes(4, "big")) for v, r in zip(value, row)]
    assert as_text == [(0, b" ab "), (3, b" a b"), (3, b"a b "), (4, b" xyz"), (4, b"xyz ")]


def test_false_positives_are_taken_off():
    table = np.full((1, 1 << 10), 1, np.uint64)  # the first language's filter says yes to everything
    table[0, langid.slots_of(langid.grams(pa.array(["hello"]))[0], 1 << 10).ravel()] |= np.uint64(2)
    lang, share = langid.score(pa.array(["hello"]), ["full", "real"], table, np.array([1.0, 0.0]))
    assert lang == ["real"] and share[0] > 0.9
