"""Periodic runs, repeated strings and hard negatives against plain versions."""

import hashlib
import math
import random
import zlib

import pytest

pytest.importorskip("marketweave.llm")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marketweave.llm import hardneg, periodic, suffixes  # noqa: E402


def plain_runs(words, least=6, times=4):
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            a = i
            while i < n and words[i] == words[i - q]:
                i += 1
            s, size = a - q, i - a + q
            if size >= max(least, times * q) and not any(all(words[k] == words[k - p] for k in range(s + p, s + size)) for p in range(1, q)):
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng, kinds, n):
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    while n and rng.random() < 0.6:
        part, at = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, 12))], rng.randrange(n)
        words[at:at] = (part * rng.randrange(2, 8))[: rng.randrange(4, 60)]
    return words


ODD_TEXTS = [None, "", " \n", "one", "a a a a a", "a a a a a a", "A a A a A a A a", "x x " * 30, "é\vé\té  é é\fé é\r\né", "same " * 3000, "ab cd ef " * 2000 + "gh", "\x00 \x00 \x00 \x00 \x00 \x00"]


def test_runs_of_many_small_texts(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(periodic_words(rng, rng.randrange(1, 5), rng.randrange(0, 70)))) for i in range(400)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a " * 9), (7, "b " * 9), (7, "b " * 9)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, runs int, collapsed string")
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(frame).collect()), key=repr)
    want = []
    for i, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = plain_runs(words) if len(words) < 500 else {"same": [(0, 3000, 1)], "ab": [(0, 6000, 3)]}[words[0]]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(words), runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert got == sorted(want, key=repr)
    assert periodic.periodic_runs(frame.limit(0)).collect() == []


def test_planted_runs_and_digests(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 120)))) for i in range(150)] + [(200 + i, t) for i, t in enumerate(ODD_TEXTS)]
    frame = spark.createDataFrame([*rows, (None, "q " * 6)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in periodic.digests(periodic.periodic_runs(periodic.planted(frame))).collect()}
    assert len(got) == len(rows) + 1 and got[None][:5] == (1, 0, 6, 1, 6000)
    planted = 0
    for i, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
            planted += 1
        if n > 500:
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert got[i] == (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(listed), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))
    assert planted > 5


def test_steps_do_not_grow_with_repeated_words():
    many = np.zeros(200_000, np.uint64)
    start, length, period = periodic.runs_of(many, np.zeros(len(many), np.int64))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [200_000], [1])


def plain_repeats(rows, length=50):
    first = {}
    for d, b in rows:
        for p in range(len(b) - length + 1):
            if d is not None:
                first[b[p : p + length]] = min(first.get(b[p : p + length], d), d)
    out = []
    for d, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if d is not None and first[b[p : p + length]] < d:
                gone[p : p + length] = True
        out.append((d, b, gone))
    return out


def shared_texts(rng, alphabet, n):
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30, 200))) for _ in range(5)]
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randrange(0, 5)):
            text += "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60)))
            if rng.random() < 0.7:
                part = rng.choice(passages)
                text += part[rng.randrange(0, 20) : len(part) - rng.randrange(0, 20)]
        texts.append(rng.choice(texts) if texts and rng.random() < 0.2 else text)
    return texts


ALPHABETS = ["a", "ab", "abcdefgh \n", "abcdefghijklmnopqrstuvwxyzé 日\x00"]


@pytest.mark.parametrize("bucket,windows", [(1 << 20, 1 << 19), (700, 64)])
def test_strings_of_earlier_documents_go(spark, monkeypatch, bucket, windows):
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    monkeypatch.setattr(suffixes, "GROUP", 2 * bucket)
    monkeypatch.setattr(suffixes, "WINDOWS", windows)
    monkeypatch.setattr(suffixes, "REGIONS", 1)
    monkeypatch.setattr(suffixes, "SUFFIXES", 1)
    rng = random.Random(3)
    texts = [t for a in ALPHABETS for t in shared_texts(rng, a, 15)]
    rows = [(rng.randrange(-5, 60), t) for t in texts] + [(None, texts[20]), (None, texts[-1]), (70, None), (71, ""), (72, "x" * 49), (73, "x" * 50), (74, "y" + "x" * 50), (75, "y" + "x" * 50), (75, "y" + "x" * 50)]
    frame = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, key int, spans string")
    got = sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"] or ()], bytes(r["kept"])) for r in suffixes.without_repeats(frame).collect()), key=repr)
    want = []
    for d, b, gone in plain_repeats([(d, (t or "").encode()) for d, t in rows]):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        want.append((d, len(b), list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)), bytes(np.frombuffer(b, np.uint8)[~gone])))
    assert got == sorted(want, key=repr)
    assert suffixes.without_repeats(frame.limit(0)).collect() == []


@pytest.mark.parametrize("hot,classes", [(True, False), (True, True)])
def test_hot_tokens_are_dealt_by_longer_strings(hot, classes):
    rng = random.Random(5)
    for alphabet in ALPHABETS:
        rows = [(i % 17, t.encode()) for i, t in enumerate(shared_texts(rng, alphabet, 24))]
        batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows]), pa.array(range(len(rows)), pa.int64()), pa.array([b.decode() for _, b in rows])], ["doc_id", "key", "text"])
        routes = suffixes.Routes(7)
        data, offsets = suffixes.text_bytes(batch.column("text"))
        own = suffixes.suffix_rows(data, *suffixes.anchors(data, offsets)[1:])
        routes.hot = np.unique(suffixes.leading(own))[:: 1 if hot else 2]
        if classes:
            routes.hot_class = np.unique(np.concatenate((suffixes.class_keys(own, False), suffixes.class_keys(own, True))))[::2]
        dealt = pa.Table.from_batches([b for part in (batch.slice(0, 9), batch.slice(9)) for b in suffixes._emitted(routes)(iter([part]))])
        each = lambda t, c: [t.filter(pa.compute.equal(t.column(c), x)) for x in set(t.column(c).to_pylist())]
        lost = pa.concat_tables([suffixes._sorted_bucket(t) for t in each(dealt, "bucket")])
        spans = {r["key"]: r["spans"] for t in each(lost, "group") for r in suffixes._by_document(t).to_pylist()}
        for k, (_, b, gone) in enumerate(plain_repeats(rows)):
            mine = np.zeros(len(b), bool)
            for s in spans.get(k, ()):
                mine[s["start"] : s["end"]] = True
            assert (mine == gone).all()


def test_multikey_order_is_the_order_of_the_rows():
    words = np.random.default_rng(1).integers(0, 3, (2000, 5)).astype(np.uint64)
    assert [tuple(r) for r in words[suffixes.multikey_order(words)]] == sorted(map(tuple, words))


def plain_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    good = [(i, label, tuple(math.floor(scale * x) for x in v)) for i, label, v in rows if None not in (i, label) and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, v in sorted(set(good)):
        if not is_anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in good if j != i and len(w) == len(v)))
        for place, (minus, p, _) in enumerate([s for s in scored if s[2] == label][:positives]):
            fit = [s for s in scored if s[2] != label and low * -minus <= 100 * -s[0] <= high * -minus]
            out += [(i, p, r + 1, j, -minus, -s, place + 1) for r, (s, j, _) in enumerate(fit[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("block,pairs", [(1 << 18, 1 << 18), (300, 50)])
def test_hard_negatives(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(hardneg, "BLOCK", block)
    monkeypatch.setattr(hardneg, "PAIRS", pairs)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 20))
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in centres[i % 4] + rng.normal(size=20)]) for i in range(220)]
    rows += [(i, 1, rows[3][2]) for i in range(300, 330)] + [(i, 2, [x / 2 for x in rows[3][2]]) for i in range(400, 415)]  # ties
    rows += [(500, None, rows[0][2]), (None, 1, rows[0][2]), (510, 1, None), (520, 1, []), (521, 1, []), (522, 2, []), (530, 1, [None] * 20), (540, 1, [float("nan")] * 20), (550, 1, [1.0, 2.0]), (551, 1, [0.5, 2.0]), (552, 2, [0.5, 1.0])]
    rows += [rows[10], rows[10], (20, 2, rows[11][2]), (560, 1, [0.0] * 20), (600, 9, rows[5][2]), (570, 1, [1e-9] * 20)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, label int, embedding array<double>, anchor int, slot int")
    got = sorted(map(tuple, hardneg.hard_negatives(frame, F.col("vec_id") % 10 == 0).collect()))
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    assert got == want and len({r[0] for r in want}) > 20
    assert hardneg.hard_negatives(frame.limit(0), F.col("vec_id") % 10 == 0).collect() == hardneg.hard_negatives(frame, F.col("vec_id") < 0).collect() == []


def test_intervals_hold_every_score():
    rng = np.random.default_rng(6)
    whole = rng.integers(-300, 300, (60, 37)).astype(np.float64)
    anchors = hardneg.Planes(whole)
    norm, codes, agree, rest = hardneg.encode(whole)
    a, c = (x.ravel() for x in np.indices((60, 60)))
    estimate = np.zeros(len(a))
    for level in range(hardneg.LEVELS):
        on = anchors.on_code(a, codes[c, level])
        estimate += agree[c, level] * on
        reach = rest[c, level] * np.sqrt(np.maximum(anchors.square[a] - on * on, 0)) + anchors.off[a]
        assert (np.abs(estimate * norm[c] - (whole[a] * whole[c]).sum(axis=1)) <= reach * norm[c] + 1e-3).all()
    assert (np.diff(rest, axis=1) <= 1e-12).all() and rest[:, -1].mean() < 0.25


def test_scores_of_large_components():
    a = np.array([[2**40, -3], [2**62, 2**62]])
    assert hardneg.scores(a, a).tolist() == [2**63 - 1, 2**63 - 1] and hardneg.scores(a[:1] // 2**20, a[:1] // 2**20).tolist() == [2**40 + 1]
