"""Top-k, archives and decontamination against brute force."""

import base64
import hashlib
import math
import random

import pytest

pytest.importorskip("marketweave.llm")

import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marketweave.llm import decontam, topk, warc  # noqa: E402


def brute_top(rows, k=5, scale=256):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % 3 == 0}):
        found = [(-min(max(sum(a * b for a, b in zip(v, w)), -(2**63) + 2), 2**63 - 1), i) for v in {tuple(v) for j, v in good if j == q} for i, w in good if i != q and len(w) == len(v)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("block,dimensions", [(4096, 16), (4, 3)])
def test_top_k(spark, monkeypatch, block, dimensions):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "DIMENSIONS", dimensions)
    monkeypatch.setattr(topk, "COMPONENTS", 200)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=10)]) for i in range(90)]
    rows += [(i, rows[2][1]) for i in range(200, 230)]  # a common vector: ties
    rows += [(300, None), (303, []), (306, [1.0, None] * 5), (309, [float("nan")] * 10), (312, [float("inf")] + [0.0] * 9), (None, rows[1][1]), (315, [1.0, 2.0]), (318, [0.5, -2.0]), (321, [3.0])]
    rows += [(9, rows[4][1]), (9, rows[9][1]), (5, rows[5][1])]  # repeated ids
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 3 == 0).collect())) == sorted(brute_top(rows))


def test_top_k_of_large_components(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.randrange(0, 12) for _ in range(6)]) for i in range(20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 3 == 0).collect())) == sorted(brute_top(rows))


def test_top_k_without_queries_or_rows(spark):
    frame = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(frame, F.col("vec_id") % 3 == 0).collect() == []
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 3 == 0).collect() == []


PAGES = [
    (5, "http://a/5", "<p>x</p>"), (3, "http://a/3", "<p>x</p>"), (4, None, None), (9, "u\r\nX: y", ""), (7, "http://a/7", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (8, "é", "naïve 日本\r\n\r\n\n"), (1, "u", "only"), (1, "u", "only"), (2, "u", "only"), (None, "n", "<p>x</p>"), (None, "n", "none"), (None, "m", "none"), (11, "l", "long " * 50_000), (12, "l", "long " * 50_000),
]


def brute_pages(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        revisit = len(data) >= least and ids and i != min(ids)
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", min(ids) if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 10])
def test_archive_round_trip(spark, least):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, payload string")
    assert sorted(map(tuple, warc.deduplicate(pages, least_bytes=least).collect()), key=repr) == brute_pages(PAGES, least)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archive_files(spark, tmp_path, compression):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumnRenamed("html", "payload")
    resolved = warc.resolve(pages)
    path = str(tmp_path / "a")
    warc.write_archive(resolved, path, file_records=2, compression=compression)
    files = [f for f in (tmp_path / "a").iterdir() if f.name.startswith("part-")]
    found = [r for f in files for r in warc.parse_records(f.read_bytes())]
    assert all(sum(1 for _ in warc.parse_records(f.read_bytes())) <= 2 for f in files)
    assert len(found) == len(PAGES) == len({h["warc-record-id"] for h, _ in found})
    assert sorted(h["warc-type"] for h, _ in found) == sorted(x[3] for x in brute_pages(PAGES))
    for headers, block in found:
        assert int(headers["content-length"]) == len(block) and headers["warc-payload-digest"].startswith("sha1:")
        assert headers["warc-type"] == "response" or not block
    texts = {r["payload"].decode() for r in warc.read_archive(spark, path, with_payload=True).where("record_type = 'response'").collect()}
    assert texts == {(h or "") for _, _, h in PAGES}


def test_files_are_bounded_by_bytes(spark, tmp_path):
    rng = random.Random(4)
    sizes = [rng.choice([0, 10, 300, 1500, 5000, 40_000]) for _ in range(300)] + [200_000]
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"{i:06d}" + "z\r\n\r\nWARC/1.1\r\n"[:15] * (n // 15)) for i, n in enumerate(sizes)], "page_id long, url string, html string")
    path = str(tmp_path / "a")
    warc.write_archive(warc.resolve(pages.withColumnRenamed("html", "payload")), path, file_records=32, file_bytes=64_000)
    files = [[block for _, block in warc.parse_records(f.read_bytes())] for f in (tmp_path / "a").rglob("part-*")]
    assert sum(map(len, files)) == len(sizes)
    assert all(len(f) <= 32 and (len(f) == 1 or sum(map(len, f)) <= 64_000) for f in files if f)
    assert len(files) < len(sizes) / 2
    read = warc.read_archive(spark, path, with_payload=True).select("page_id", F.decode("payload", "utf-8")).collect()
    assert sorted(map(tuple, read)) == sorted(map(tuple, pages.select("page_id", "html").collect()))


def test_revisits_resolve_by_the_standard_headers_alone(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, "other"), (4, "http://d", "other"), (5, "http://e", "alone"), (6, "http://f", "twice"), (6, "http://g", "twice"), (7, "http://h", "twice")]
    warc.write_archive(warc.resolve(spark.createDataFrame(rows, "page_id long, url string, payload string")), str(tmp_path / "a"))
    found = [r for f in (tmp_path / "a").rglob("part-*") for r in warc.parse_records(f.read_bytes())]
    blocks = {h["warc-record-id"]: (h, b) for h, b in found if h["warc-type"] == "response"}
    assert len({h["warc-record-id"] for h, _ in found}) == len(rows)
    number = lambda h: int(h["warc-page-id"].rsplit(":", 1)[1])
    revisits = {number(h): h for h, _ in found if h["warc-type"] == "revisit"}
    assert set(revisits) == {2, 4, 7}
    for page, original, text in ((2, 1, b"same"), (4, 3, b"other")):
        named, block = blocks[revisits[page]["warc-refers-to"]]
        assert number(named) == original and block == text and revisits[page]["warc-refers-to-date"] == named["warc-date"]
        assert revisits[page].get("warc-refers-to-target-uri") == named.get("warc-target-uri")
    assert "warc-refers-to" not in revisits[7]


def test_empty_archive(spark):
    assert warc.deduplicate(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def plain_alignment(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(8)
    for _ in range(60):
        item = rng.integers(0, 6, rng.integers(1, 20)).astype(np.uint64)
        windows = [rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint64) for _ in range(5)]
        best, end = decontam.align([item] * len(windows), windows)
        assert best.tolist() == [plain_alignment(item, w) for w in windows]
        assert all(plain_alignment(item, w[:e]) == s for w, e, s in zip(windows, end, best))


@pytest.mark.parametrize("items_in_a_block", [10_000, 5])
def test_planted_items_are_found_and_clean_documents_left(spark, monkeypatch, items_in_a_block):
    monkeypatch.setattr(decontam, "ITEMS", items_in_a_block)
    rng = random.Random(2)
    common = [f"c{i}" for i in range(40)]
    item = lambda: [rng.choice(common) if rng.random() < 0.5 else f"r{rng.randrange(3000)}" for _ in range(rng.randrange(15, 50))]
    items = {i: item() for i in range(24)}
    docs, planted, fragments = [], {}, set()
    for d in range(300):
        own = [rng.choice(common) if rng.random() < 0.5 else f"r{rng.randrange(3000)}" for _ in range(rng.randrange(0, 300))]
        if d % 3 == 0:
            k = rng.randrange(24)
            copy = list(items[k])
            for i in rng.sample(range(len(copy)), len(copy) // 6 if d % 2 else 0):
                copy[i] = rng.choice(["changed", "", "two words"])
            at = rng.randrange(len(own) + 1)
            own[at:at] = " ".join(copy).upper().split() if d % 4 == 0 else " ".join(copy).split()
            planted[d] = k
        elif d % 3 == 1:
            k = rng.randrange(24)
            own += items[k][3:8]
            fragments.add(d)
        docs.append((d, (" ".join(own) if d % 5 else ", ".join(own)).replace("r1", "R1")))
    docs += [(900, None), (901, ""), (902, "..."), (None, " ".join(items[3])), (903, " ".join(items[4])), (903, " ".join(items[4]))]
    planted[903] = 4
    bench = [(i, " ".join(w), "x") for i, w in items.items()] + [(50, None, "x"), (51, "", "x"), (52, "...", "x"), (None, "a b c", "x"), (3, " ".join(items[3]), "x")]
    docs_frame = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, score int")
    bench_frame = spark.createDataFrame(bench, "item_id long, text string, doc_id string")
    got = decontam.contaminated(docs_frame, bench_frame).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(found) == len(got)
    assert {(d, k) for d, k in planted.items()} | {(None, 3)} <= found
    assert {d for d, _ in found} <= set(planted) | {None}
    assert all(r["score"] == 1.0 for r in got if r["doc_id"] in (903, None))
    for r in got:
        if r["doc_id"] == 903:
            assert (r["first_word"], r["end_word"]) == (0, len(items[4]))
    kept = decontam.keep_clean(docs_frame, bench_frame)
    assert kept.columns == docs_frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in docs if d is not None and d not in planted)


def test_seeds_of_an_item_that_is_everywhere(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"n{i} {text} m{i}") for i in range(200)] + [(500, "other words here")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, text), (2, "zz yy")], "item_id long, text string")
    assert {tuple(r) for r in decontam.contaminated(docs, bench).select("doc_id", "item_id", "score").collect()} == {(i, 1, 1.0) for i in range(200)}
    assert decontam.contaminated(docs, bench.limit(0)).count() == decontam.contaminated(docs.limit(0), bench).count() == 0
    assert decontam.keep_clean(docs, bench.limit(0)).count() == 201


def every(k):
    """Places of every k-th word."""
    return lambda rng, n: range(k - 1, n, k)


def some(share):
    """Places of a share of the words, anywhere."""
    return lambda rng, n: rng.sample(range(n), int(share * n))


@pytest.mark.parametrize("places", [every(3), every(4), every(5), some(0.2), some(0.3)])
def test_copies_with_many_edits_are_found(spark, places):
    rng = random.Random(4)
    items = [[f"i{rng.randrange(10**6)}" for _ in range(rng.randrange(15, 40))] for _ in range(40)]
    docs, planted = [], set()
    for d in range(240):
        k, own = d % 40, [f"d{rng.randrange(10**6)}" for _ in range(60)]
        copy = list(items[k])
        if d >= 40 and d % 3 == 0:  # else: other copies of the item are whole or missing
            for i in places(rng, len(copy)):
                copy[i] = f"x{rng.randrange(10**6)}"
        elif d % 3 == 1:
            copy = own[:5]
        own[30:30] = copy
        docs.append((d, " ".join(own)))
        if plain_alignment(items[k], own) >= decontam.LEAST * 2 * len(items[k]):
            planted.add((d, k))
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == planted


def test_changed_words_break_no_seven_words():
    for n in range(7, 15):
        for bits in range(1 << n):
            kept = [bits >> i & 1 for i in range(n)]
            if 3 * sum(kept) - n < decontam.LEAST * 2 * n:
                continue
            assert any(all(kept[i + j] for j in shape) for shape in decontam.SHAPES for i in range(n - shape[-1])), (n, bits)


@pytest.mark.parametrize("hits,cells", [(7, 1), (100, 300)])
def test_bounded_parts_find_the_same(monkeypatch, hits, cells):
    import pyarrow as pa

    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(12)}" for _ in range(n))
    items = decontam.Items(np.arange(20), pa.array([text(rng.randrange(1, 20)) for _ in range(20)]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(15)), pa.array([text(rng.randrange(0, 60)) for _ in range(15)])], ["doc_id", "text"])
    rows = lambda: sorted(tuple(r.values()) for out in decontam._aligned(items, decontam.LEAST)(iter([batch])) for r in out.to_pylist())
    whole = rows()
    monkeypatch.setattr(decontam, "HITS", hits)
    monkeypatch.setattr(decontam, "CELLS", cells)
    assert whole and rows() == whole


def test_items_of_different_lengths_are_aligned_together():
    rng = np.random.default_rng(9)
    items = [rng.integers(0, 6, rng.integers(1, 20)).astype(np.uint64) for _ in range(200)]
    windows = [rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint64) for _ in items]
    best, end = decontam.align(items, windows)
    assert best.tolist() == [plain_alignment(i, w) for i, w in zip(items, windows)]
    assert all(plain_alignment(i, w[:e]) == s for i, w, s, e in zip(items, windows, best, end))


def test_a_phrase_of_all_items_costs_little(spark):
    import time

    import pyarrow as pa

    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(30_000)}"
    texts = [[word() for _ in range(16)] for _ in range(3000)]
    docs = [[word() for _ in range(110)] for _ in range(150)]
    for k in range(0, 150, 10):
        docs[k][40:40] = [w if i % 5 else word() for i, w in enumerate(texts[7 * k])]
    took, found = {}, {}
    for hot in (False, True):
        phrase = "one of the most".split() if hot else []
        items = decontam.Items(np.arange(len(texts)), pa.array([" ".join(t[:6] + phrase + t[6:]) for t in texts]))
        column = pa.array([" ".join(d[:20] + phrase + d[20:40] + phrase + d[40:]) for d in docs])
        started = time.process_time()
        out = decontam.found_in(items, column, decontam.LEAST)
        took[hot], found[hot] = time.process_time() - started, set(zip(out[0].tolist(), out[1].tolist()))
    want = {(k, 7 * k) for k in range(0, 150, 10)}
    assert found[False] == found[True] == want
    assert took[True] < 2 * took[False] + 2.0


def test_common_seeds_find_what_rare_ones_would(monkeypatch):
    import pyarrow as pa

    rng = random.Random(13)
    text = lambda n: " ".join(f"w{rng.randrange(25)}" for _ in range(n))
    ids, own, docs = np.arange(60), pa.array([text(rng.randrange(1, 20)) for _ in range(60)]), pa.array([text(rng.randrange(0, 90)) for _ in range(40)])
    rows = lambda: sorted(zip(*(x.tolist() for x in decontam.found_in(decontam.Items(ids, own), docs, decontam.LEAST))))
    monkeypatch.setattr(decontam, "COMMON", 10**6)
    whole = rows()
    for common, bits in ((0, 1024), (0, 64), (3, 1024)):
        monkeypatch.setattr(decontam, "COMMON", common)
        monkeypatch.setattr(decontam, "BITS", bits)
        assert {r[:3] for r in rows()} == {r[:3] for r in whole} and whole


def test_columns_named_like_helpers_stay(spark):
    item = " ".join(f"i{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"a {item}", 5, {"k": 1}), (2, "clean", 6, {"k": 2})], "doc_id long, text string, bad_doc_id long, bad map<string,int>")
    kept = decontam.keep_clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "clean", 6, {"k": 2})]


def test_clean_rows_stay_beside_others_of_their_id(spark):
    item = " ".join(f"i{i}" for i in range(20))
    docs = spark.createDataFrame([(None, "clean one"), (None, f"x {item}"), (None, None), (None, "clean two"), (1, item), (1, "clean three"), (0, "clean one")], "doc_id long, text string")
    kept = decontam.keep_clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(None, "clean one"), (None, None), (None, "clean two"), (1, "clean three"), (0, "clean one")]))


def test_items_without_an_id_are_searched_for(spark):
    items = [" ".join(f"{c}{i}" for i in range(20)) for c in "pq"]
    docs = spark.createDataFrame([(1, f"x {items[0]}"), (2, f"y {items[1]}"), (3, "z")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, items[0]), (7, items[1]), (None, None)], "item_id long, text string")
    assert {tuple(r) for r in decontam.contaminated(docs, bench).select("doc_id", "item_id", "score").collect()} == {(1, None, 1.0), (2, 7, 1.0)}
    assert [r["doc_id"] for r in decontam.keep_clean(docs, bench).collect()] == [3]
