"""Near copies by fast similarity sketching, banding and exact verification.

``near_copies`` links documents whose sets of word shingles have a Jaccard
similarity of at least ``percent`` / 100 and returns each one's component.

* Documents with equal sets are one class from the start; only its smallest
  doc_id is sketched further, so thousands of copies cost one row each.
* A sketch has ``BANDS * ROWS`` coordinates. In round i every shingle falls
  into one bin with a value in [i, i+1); a bin keeps its least value. The
  rounds end once every bin is filled, and the later half of the rounds
  fills bin after bin, so no coordinate stays empty.
* Documents that share a whole band are candidates. Within a bucket all are
  first held against one centre, the document that meets most others, and
  links are confirmed on the full sets. That joins the bulk of a large group
  with one pair for each member.
* What is left are documents that share a bucket with another component. Two
  such sets can only be similar enough if they share one of their rarest
  shingles: with a and b shingles they need an overlap of
  percent * (a + b) / (100 + percent), so one of the first a - overlap + 1 in
  any common order must be among the first b - overlap + 1 of the other. Only
  such pairs of different components are confirmed. No link is lost by a cap,
  and no bucket turns into all of its pairs.

With similarity 0.85 a link shares no band with probability
(1 - 0.85**5)**32 < 1e-8.

Null or blank texts have an empty set and link with nothing. Rows that share
a doc_id count as one document. Rows without a doc_id link with nothing and
are kept, with a null component. An empty table gives no rows. Other columns
of the input play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketweave.llm.common import discard, mix, pieces, seeds, shingles, staged, unused

BANDS, ROWS = 32, 5
#: Pairs of one document that a task confirms; of a document with more, the pairs are dealt to several and its text goes to each.
DEALT = 512
#: Words of 64 bits that a filter of keys has at most. With more keys it lets more rows pass; none is lost.
FILTER_WORDS = 1 << 18
_BINS = BANDS * ROWS
_EMPTY = np.uint64(2**64 - 1)


def sketch(values: np.ndarray, bounds: np.ndarray, bins: int = _BINS) -> np.ndarray:
    """One row of ``bins`` coordinates for each set; rows of empty sets stay all ones."""
    rows = len(bounds) - 1
    sizes = np.diff(bounds)
    out = np.full(rows * bins, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(rows), sizes)
    round_seed, spread = seeds(2 * bins, 37), seeds(1, 41)[0]
    for i in range(2 * bins):
        if not len(values):
            break
        x = mix(values ^ round_seed[i])
        to = ((x >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else np.int64(i - bins)
        np.minimum.at(out, owner * bins + to, np.uint64(i) << np.uint64(50) | (x * spread) >> np.uint64(14))
        if i < bins or i == 2 * bins - 1:
            open_rows = (out.reshape(rows, bins) == _EMPTY).any(axis=1)
            left = open_rows[owner]
            if not left.all():
                values, owner = values[left], owner[left]
    return out.reshape(rows, bins)


def band_hashes(sketches: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    factors = seeds(rows, 43)
    folded = (sketches.reshape(len(sketches), bands, rows) * factors).sum(axis=2, dtype=np.uint64)
    return mix(folded + seeds(bands, 47)).view(np.int64)


def _sketched(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            values, bounds = shingles(piece.column("text"), n)
            bands = band_hashes(sketch(values, bounds))
            sizes = np.diff(bounds)
            keys = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel(), pa.int64()), BANDS).cast(pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )


def _confirmed(n: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept_a, kept_b = [], []
        for outer in pieces(batch, "text_a"):
            for piece in pieces(outer, "text_b"):
                ids = [piece.column(c).to_numpy() for c in ("a", "b")]
                sets = []
                for k, column in enumerate(("text_a", "text_b")):
                    unique, where = np.unique(ids[k], return_index=True) if _one_text_per_id(piece, column, ids[k]) else (None, np.arange(piece.num_rows))
                    values, bounds = shingles(piece.column(column).take(pa.array(where)), n)
                    at = np.searchsorted(unique, ids[k]) if unique is not None else where
                    sets.append([values[bounds[i] : bounds[i + 1]] for i in at])
                for a, b, x, y in zip(*ids, *sets, strict=True):
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    if same and 100 * same >= percent * (len(x) + len(y) - same):
                        kept_a.append(a)
                        kept_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(kept_a, pa.int64()), pa.array(kept_b, pa.int64())], ["a", "b"])


def _exploded(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            values, bounds = shingles(piece.column("text"), n)
            row = np.repeat(np.arange(piece.num_rows), np.diff(bounds))
            kinds = np.array([int(np.bitwise_xor.reduce(values[a:b])) >> 1 for a, b in zip(bounds, bounds[1:], strict=False)], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c).take(pa.array(row)) for c in ("doc_id", "component")), pa.array(kinds[row]), pa.array(np.diff(bounds)[row]), pa.array(values.view(np.int64))],
                ["doc_id", "component", "text_key", "n", "shingle"],
            )


def _maybe_among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``column`` is among those of ``keys``, and a few others. Rows are not moved for it, however many keys there are: only one bit for a key is broadcast."""

    def place(name: str):
        hashed = F.xxhash64(name)
        return F.pmod(hashed, F.lit(FILTER_WORDS)), F.pmod(F.shiftright(hashed, 32), F.lit(64)).cast("int")

    word, bit = place(column)
    own_word, own_bit = place(keys.columns[0])
    bits = keys.select(own_word.alias("filter_word"), F.call_function("shiftleft", F.lit(1).cast("long"), own_bit).alias("filter_bit"))
    bits = bits.groupBy("filter_word").agg(F.bit_or("filter_bit").alias("filter_bits"))
    # at most FILTER_WORDS rows
    return rows.join(F.broadcast(bits), (word == F.col("filter_word")) & (F.getbit("filter_bits", bit) == 1), "left_semi")


def _rare_pairs(placed: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components of ``placed`` (doc_id, component) whose rarest shingles meet as similar sets' must."""
    held = texts.join(placed, "doc_id").select("doc_id", "component", "text").mapInArrow(partial(_exploded, n), "doc_id long, component long, text_key long, n long, shingle long")
    held = staged(held, "held")
    seen = staged(held.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "seen")
    own = Window.partitionBy("doc_id", "text_key")
    ranked = held.join(seen, "shingle").withColumns({"rank": F.row_number().over(own.orderBy("df", "shingle")), "common": F.count("*").over(own)})
    reach = ranked.withColumn("most", F.expr(f"(common - rank + 1) * {100 + percent} div {percent} - n")).where(f"most * 100 >= n * {percent}")
    rare = reach.select("shingle", "doc_id", "component", "n", "most")
    rare = staged(rare, "rare")
    discard(held, seen)
    mixed = staged(rare.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("shingle"), "mixed")
    rare = staged(rare.join(mixed, "shingle", "left_semi"), "rare")
    x, y = (rare.select("shingle", *(F.col(c).alias(f"{c}_{k}") for c in ("doc_id", "component", "n", "most"))) for k in "xy")
    met = x.join(y, "shingle").where("component_x < component_y and n_y <= most_x and n_x <= most_y")
    return met.select(F.least("doc_id_x", "doc_id_y").alias("a"), F.greatest("doc_id_x", "doc_id_y").alias("b")).distinct()


def _one_text_per_id(piece: pa.RecordBatch, column: str, ids: np.ndarray) -> bool:
    """Whether equal ids have equal texts here, so that one set for each id does."""
    return len(pa.Table.from_arrays([pa.array(ids), piece.column(column)], ["id", "text"]).group_by(["id", "text"]).aggregate([])) == len(np.unique(ids))


def _with_text(pairs: DataFrame, texts: DataFrame, side: str, other: str) -> DataFrame:
    """``pairs`` with the text of ``side``, the pairs of a document that is in many dealt by their other side."""
    # at most one row for DEALT pairs
    busy = pairs.groupBy(side).agg(F.count("*").alias("n")).where(F.col("n") > DEALT).select(side, F.ceil(F.col("n") / DEALT).cast("int").alias("parts"))
    busy = staged(busy, "busy")
    own = texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))
    if busy.isEmpty():
        return pairs.join(own, side)
    parts = F.coalesce("parts", F.lit(1))
    dealt = pairs.join(busy, side, "left").withColumn("part", F.pmod(F.xxhash64(other), parts).cast("int")).drop("parts")
    copies = own.join(busy, side, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(copies, [side, "part"]).drop("part")


def _links(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    texts = _maybe_among(texts, "doc_id", pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    both = _with_text(_with_text(pairs, texts, "a", "b"), texts, "b", "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(partial(_confirmed, n, percent), "a long, b long")


def _size_fits(percent: int):
    """Sets this different in size can't be similar enough."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b); large-star and small-star rounds on staged tables."""
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        wide, large = least, staged(large, "large")
        discard(wide)
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        before_edges, edges = edges, staged(small.distinct(), "edges")
        discard(before_edges, large, least)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots.select("v", "v"))


def near_copies(docs: DataFrame, n: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id linked directly or through others), kept (doc_id = component_id) for each row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = staged(texts.mapInArrow(partial(_sketched, n), "doc_id long, n_shingles long, set_key binary, bands array<long>"), "sketches")
    # what is joined back to its groups is staged, so that the join's own stage can split a group of a third of all rows
    firsts = staged(sketched.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("first")), "firsts")
    # of a class, only the first's bands go on
    classes = sketched.join(firsts, "set_key", "left").select("doc_id", "n_shingles", "first", F.when(F.col("doc_id") == F.col("first"), F.col("bands")).alias("bands"))
    classes = staged(classes, "classes")
    discard(sketched, firsts)
    ranked = classes.select("doc_id", "n_shingles", "first")

    unique = classes.where("bands is not null").select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    busy = staged(unique.groupBy("bucket").agg(F.count("*").alias("held"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("bucket", "held"), "busy")
    members = staged(_maybe_among(unique, "bucket", busy.select("bucket")).join(busy, "bucket").distinct(), "members")
    # all that is compared below is among these, so the other texts are never moved
    texts = staged(_maybe_among(texts, "doc_id", members.select("doc_id")), "texts")

    reach = members.groupBy("doc_id").agg(F.sum("held").alias("reach"))
    centres = staged(members.join(reach, "doc_id").groupBy("bucket").agg(F.max_by(F.struct("doc_id", "n_shingles"), F.struct("reach", -F.col("doc_id"))).alias("c")), "centres")
    pairs = (
        members.join(centres, "bucket").select(F.col("doc_id").alias("x"), F.col("c.doc_id").alias("y"), F.col("n_shingles").alias("n_a"), F.col("c.n_shingles").alias("n_b"))
        .where(F.col("x") != F.col("y")).where(_size_fits(percent)).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    )
    pairs = staged(pairs, "pairs")
    discard(busy, centres)
    shared = ranked.where("first is not null").groupBy("doc_id").agg(F.min("first").alias("a"), F.max("first").alias("b")).where("a < b").select("doc_id")
    shared = ranked.join(shared, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    links = staged(_links(pairs, texts, n, percent).unionAll(shared), "links")
    joined = components(links)

    placed = members.join(joined, members.doc_id == joined.node, "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    placed = staged(placed, "placed")
    discard(members, joined)
    mixed = staged(placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket"), "mixed")
    placed = placed.join(mixed, "bucket", "left_semi").select("doc_id", "component").distinct()
    rest = _rare_pairs(placed, texts, n, percent).join(pairs, ["a", "b"], "left_anti")
    more = staged(_links(staged(rest, "rest"), texts, n, percent), "links")
    discard(texts)
    joined = components(links.unionAll(more))

    out = ranked.join(joined, F.col("first") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each component of rows, that of the smallest doc_id and of rows that share it the first by the hash of its text, or of equal texts by their other columns, written as JSON.

    Each row is linked by its own text, so unlike texts under one doc_id both stay. Rows without a doc_id all stay.
    """
    key, chosen, rank = (unused(docs.columns, c) for c in ("kept_key", "chosen_key", "kept_rank"))
    keyed = docs.where("doc_id is not null").withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    copies = near_copies(keyed.select(F.col(key).alias("doc_id"), "text"), n, percent).select(F.col("doc_id").alias("of_key"), "component_id").distinct()
    copies = staged(copies, "copies")
    # ids move here, texts only below
    ids = keyed.select(F.col(key).alias("of_key"), F.col("doc_id").cast("long").alias("id")).distinct().join(copies, "of_key")
    kept = staged(ids.groupBy("component_id").agg(F.min_by("of_key", F.struct("id", "of_key")).alias(chosen)).select(chosen), "chosen")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    first = Window.partitionBy(key).orderBy(F.to_json(F.struct(*rest)) if rest else F.lit(0))
    rows = keyed.join(kept, F.col(key) == F.col(chosen), "left_semi").withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
    return rows.select(docs.columns).unionAll(docs.where("doc_id is null"))
