"""Near copies against all pairs, on small tables with groups, chains and odd rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("marketweave.llm")

from marketweave.llm import minhash as mh  # noqa: E402
from marketweave.llm.common import shingles, words  # noqa: E402

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    own = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not own:
        return set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)}


def brute(rows, percent=85):
    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            same = len(x & y)
            if same and 100 * same >= percent * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return sorted(((d, len(shingle_set(t)), root(d) if d is not None else None, root(d) == d if d is not None else True) for d, t in rows), key=repr)


def run(spark, rows):
    return sorted((tuple(r) for r in mh.near_copies(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)


def edited(rng, words_, k):
    out = list(words_)
    for i in rng.sample(range(len(out)), k):
        out[i] = f"x{rng.randrange(10**6)}"
    return out


def test_groups_chains_and_odd_rows(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE  two"), (5, "one two three"), (6, "ÄB c d e f"), (7, "äb c d e f")]
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 160))]
        for _ in range(14):
            rows.append((len(rows), " ".join(edited(rng, base, rng.randrange(0, 5)))))
            base = edited(rng, base, 1) if rng.random() < 0.4 else base  # a chain
    rng.shuffle(rows)
    rows += [rows[20], (None, "one two"), (None, None)]
    assert run(spark, rows) == brute(rows)


def test_large_group_with_members_far_from_its_centre(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(140)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0, 0, 1, 2, 3, 6])))) for i in range(150)]
    far = edited(rng, base, 8)
    rows += [(1000 + i, " ".join(edited(rng, far, 1))) for i in range(5)]  # similar to one another, not to the base
    assert run(spark, rows) == brute(rows)


def test_same_id_with_different_texts_is_one_document(spark):
    rows = [(5, "a b c d e f"), (5, "p q r s t u"), (3, "p q r s t u"), (9, "a b c d e f")]
    assert {r[2] for r in run(spark, rows)} == {3}


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = spark.createDataFrame([(1, "a b c d e f", 7, "x", 1), (2, "a b c d e f", 8, "y", 2)], "doc_id long, text string, bucket int, component string, n_shingles int")
    assert [tuple(r) for r in mh.near_copies(rows).orderBy("doc_id").collect()] == [(1, 2, 1, True), (2, 2, 1, False)]
    assert [r["bucket"] for r in mh.keep_one(rows).collect()] == [7]


def test_keep_one_keeps_one_row_of_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (4, None)], SCHEMA)
    assert sorted((r[0] or -1) for r in mh.keep_one(rows).collect()) == [-1, 1, 4]


def test_keep_one_keeps_unlike_texts_of_one_id(spark):
    rows = spark.createDataFrame([(5, "a b c d e f", 1), (5, "p q r s t u", 2), (3, "p q r s t u", 3), (9, "a b c d e f", 4), (5, "k l m n o p", 5), (5, "k l m n o p", 5), (5, None, 6)], SCHEMA + ", n int")
    assert sorted(r["n"] for r in mh.keep_one(rows).collect()) == [1, 3, 5, 6]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in mh.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(np.concatenate((common[:2400], rng.integers(0, 2**63, 300).astype(np.uint64)))) for _ in range(2)]
    sets += [common[:1], common[:7]]
    bounds = np.cumsum([0, *map(len, sets)])
    got = mh.sketch(np.concatenate(sets), bounds, 256)
    assert (got != mh._EMPTY).all()
    assert abs((got[0] == got[1]).mean() - 0.8) < 0.1
    alone = mh.sketch(sets[3], np.array([0, 7]), 256)
    assert (alone[0] == got[3]).all()


def test_words_and_shingles_are_cut_like_the_pattern():
    texts = ["Ab  cD\x0be\n\nf g h", "", None, "x", "é É z", "a b c d e"]
    hashed, row, first, end = words(pa.array(texts))
    assert [(r, texts[r].encode()[a:b].decode().lower()) for r, a, b in zip(row, first, end)] == [(i, w.lower()) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0d]+", t or "")]
    assert len(set(hashed.tolist())) == len({w.replace("É", "E!") for t in texts for w in re.findall(r"[^\x20\x09-\x0d]+", (t or "").replace("A", "a").replace("D", "d"))})
    values, bounds = shingles(pa.array(texts), 5)
    assert np.diff(bounds).tolist() == [len(shingle_set(t)) for t in texts]


def test_hashes_do_not_depend_on_the_place():
    few = words(pa.array(["x y x", "y x"]))[0]
    many = words(pa.array(["pad " * 400_000 + "x y"]))[0]
    assert few[0] == few[2] == few[4] == many[-2] and few[1] == few[3] == many[-1] and few[0] != few[1]


def test_shipped_functions_are_small():
    from pyspark import cloudpickle

    words(pa.array(["pad " * 400_000]))
    assert len(cloudpickle.dumps(mh._sketched)) < 100_000


@pytest.mark.parametrize("dealt", [1, 3])
def test_pairs_of_a_busy_document_are_dealt(spark, monkeypatch, dealt):
    monkeypatch.setattr(mh, "DEALT", dealt)
    rng = random.Random(21)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(0, 2)))) for i in range(25)] + [(100 + i, " ".join(f"u{rng.randrange(900)}" for _ in range(30))) for i in range(10)] + [(3, "another text under this id")]
    plain = [r for r in run(spark, rows[:-1])]
    assert plain == brute(rows[:-1])
    monkeypatch.setattr(mh, "DEALT", 10**6)
    many = run(spark, rows)
    monkeypatch.setattr(mh, "DEALT", dealt)
    assert run(spark, rows) == many


def test_input_texts_are_read_twice(spark, tmp_path, monkeypatch):
    """Once for the sketches and once to move those that share a bucket; all comparisons read the moved ones."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i % 3 :])) for i in range(6)] + [(9, "none of this is elsewhere at all"), (10, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    readers = []
    original = mh.staged

    def recorded(df, name):
        if any(str(tmp_path) in f for f in df.inputFiles()):
            readers.append(name)
        return original(df, name)

    monkeypatch.setattr(mh, "staged", recorded)
    got = {r.doc_id: r.component_id for r in mh.near_copies(spark.read.parquet(str(tmp_path / "docs"))).collect()}
    assert got == {**{i: 0 for i in range(6)}, 9: 9, 10: 10}
    assert readers == ["sketches", "texts"]


def test_texts_and_buckets_that_meet_no_other_are_not_moved(spark, monkeypatch):
    """Also where ids and buckets are too many for Spark to broadcast on its own; before, all texts and all buckets were shuffled to pick them."""
    rng = random.Random(31)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(edited(rng, base, i % 3))) for i in range(12)] + [(100 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(30))) for i in range(60)]
    moved, plans = [], {}
    original, filtered = mh.staged, mh._maybe_among

    def recorded(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return original(df, name)

    def counted(rows, column, keys):
        out = filtered(rows, column, keys)
        moved.append((column, rows.count(), out.count(), out.join(keys.toDF(column).distinct(), column).count()))
        return out

    monkeypatch.setattr(mh, "staged", recorded)
    monkeypatch.setattr(mh, "_maybe_among", counted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plans["texts"] and "BroadcastHashJoin" in plans["texts"]
    buckets, texts = moved[:2]
    assert buckets[0] == "bucket" and buckets[1] > 60 * mh.BANDS and buckets[2] < 15 * mh.BANDS
    assert texts[0] == "doc_id" and texts[1] == 72 and texts[2] < 15
    assert all(let >= among > 0 for _, _, let, among in moved[:2])


def test_a_full_filter_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(mh, "FILTER_WORDS", 1)
    rng = random.Random(33)
    base = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(0, 9)))) for i in range(30)] + [(100 + i, " ".join(f"u{rng.randrange(900)}" for _ in range(30))) for i in range(30)] + [(None, "w1 w2"), (200, None)]
    assert run(spark, rows) == brute(rows)
