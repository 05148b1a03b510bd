"""Secrets in texts: patterns that speak for themselves, and weak parts that only count together.

``scan`` finds the base spans (assign, access, hex) and the weak candidates of
each text. A weak candidate alone is no finding: an access identifier (weak_id),
a secret (weak_secret) or an endpoint is reported only when complementary
parts co-occur in its scope. A scope is a stretch of text between blank lines,
and within it parts count up to ``reach`` code points away. ``link`` does
that as an interval join on (doc_id, scope): each part is a point, each
weak candidate an interval of ``reach`` around it, and the nearest part of
each other role before and after it is carried along the sorted parts of the
scope, which yields the same answer as the join of all pairs without forming
them. A scope with thousands of parts costs a sort of that scope.

A group needs an identifier and a secret, base parts included; an endpoint is
added to such a group when it is in reach of one of its parts.

Null texts count as empty. Rows that repeat are scanned each for itself. Rows
without a doc_id are returned with what was found in them. An empty table gives
no rows. Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketweave.llm.common import large_text, pieces, staged, unused
from marketweave.llm.spans import Span, joined, outside, rendered, sha256

#: The base patterns; letters of the key words in either case.
_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
ORDER = {k: i for i, k in enumerate(KINDS)}
#: What a part contributes to a credential.
ROLE = {"assign": "secret", "hex": "secret", "weak_secret": "secret", "access": "id", "weak_id": "id", "endpoint": "endpoint"}

_assign = re.compile(_ASSIGN)
# A greedy run that is long enough begins where its run begins, so the length can stand in the pattern.
_access = re.compile(_ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4))
_hex = re.compile(_HEX[:-1] + "{%d,}" % LEAST["hex"])
_weak_id = re.compile(r"""(?<![A-Za-z0-9_])(?:AKIA[A-Z0-9]{8,13}(?![A-Z0-9])|(?:[Uu]ser(?:name)?|[Ll]ogin|[Cc]lient_?[Ii]d|[Aa]ccess_?(?:[Kk]ey_?)?[Ii]d)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,64})""")
_weak_secret = re.compile(r"""(?<![A-Za-z0-9_])(?:(?:[Pp]ass(?:word|wd)?|[Pp]wd|[Ss]ecret|[Tt]oken|[Aa]pi_?[Kk]ey)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=!@#$%-]{6,64}|[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=]))""")
_endpoint = re.compile(r"(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ftp)://[A-Za-z0-9.-]+(?::[0-9]{1,5})?(?:/[A-Za-z0-9._~/%-]*)?")
_blank = re.compile(r"\n[\x20\t\r]*\n")
_letter_and_digit = re.compile(r"(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])")


def base_spans(text: str) -> list[Span]:
    found = [("assign", m.start(), m.end()) for m in _assign.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _access.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in _hex.finditer(text)]


def weak_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak identifiers and secrets that overlap no base span, and endpoints, which may: an address stays one when a key stands in its path."""
    free = outside(base)
    found: list[Span] = []
    if "=" in text or ":" in text or "AKIA" in text:
        found += [("weak_id", m.start(), m.end()) for m in _weak_id.finditer(text) if free(m.start(), m.end())]
    if "://" in text:
        found += [("endpoint", m.start(), m.end()) for m in _endpoint.finditer(text)]
    for m in _weak_secret.finditer(text):
        if free(m.start(), m.end()) and (re.search("[:=]", m.group()) or _letter_and_digit.match(m.group())):
            found.append(("weak_secret", m.start(), m.end()))
    return found


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())])
    for batch in batches:
        for piece in pieces(batch, "text"):
            base_out, weak_out, sums = [], [], []
            for text in large_text(piece.column("text")).to_pylist():
                base = base_spans(text)
                weak = weak_spans(text, base)
                cuts = [m.end() for m in _blank.finditer(text)] if weak else []
                base_out.append(_scoped(base, cuts))
                weak_out.append(_scoped(weak, cuts))
                sums.append(sha256(joined(base, ORDER)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("text_key"), pa.array(base_out, pa.list_(span)), pa.array(weak_out, pa.list_(span)), pa.array(sums)], ["doc_id", "text_key", "base", "weak", "base_sha256"])


def _scoped(spans: list[Span], cuts: list[int]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b, "scope": bisect_right(cuts, a)} for k, a, b in spans]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text), base and weak spans with their scopes, base_sha256."""
    part = "array<struct<kind:string,start:long,end:long,scope:long>>"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    return texts.mapInArrow(_scanned, f"doc_id long, text_key long, base {part}, weak {part}, base_sha256 string")


def _near(role: str, order: Window, reach: int) -> Column:
    """Whether a part of ``role`` is in reach of this row's part: the interval join with the nearest on either side."""
    at = F.col("role") == role
    before = F.max(F.when(at, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(F.when(at, F.col("start")), ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    return F.coalesce(F.col("start") - before <= reach, F.lit(False)) | F.coalesce(after - F.col("end") <= reach, F.lit(False))


def link(parts: DataFrame, reach: int = 400) -> DataFrame:
    """The weak parts of ``parts`` (key, kind, start, end, scope, weak) that complementary parts in their scope and reach confirm."""
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])[F.col("kind")]
    order = Window.partitionBy("key", "scope").orderBy("start", "end", "kind")
    near = parts.withColumn("role", role).withColumns({f"near_{r}": _near(r, order, reach) for r in ("id", "secret")})
    near = near.withColumn("grouped", F.when(F.col("role") == "id", F.col("near_secret")).when(F.col("role") == "secret", F.col("near_id")).otherwise(False))
    part = lambda r: F.when((F.col("role") == r) & F.col("grouped"), True)
    in_scope = Window.partitionBy("key", "scope")
    group_near = near.withColumns({"ids": F.max(part("id")).over(in_scope), "secrets": F.max(part("secret")).over(in_scope)})
    endpoint = (F.col("role") == "endpoint") & (F.col("near_id") | F.col("near_secret")) & F.col("ids").isNotNull() & F.col("secrets").isNotNull()
    return group_near.where(F.col("weak") & (F.col("grouped") | endpoint)).select("key", "kind", "start", "end")


def _found(docs: DataFrame, reach: int) -> DataFrame:
    """The rows of :func:`scan`, staged, with the weak spans that linking confirms."""
    found = staged(scan(docs).withColumn("key", F.monotonically_increasing_id()), "secrets")
    part = lambda weak: lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"), s.scope.alias("scope"), F.lit(weak).alias("weak"))
    parts = found.where(F.size("weak") > 0).select("key", F.explode(F.concat(F.transform("base", part(False)), F.transform("weak", part(True)))).alias("p")).select("key", "p.*")
    linked = link(parts, reach).groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
    return found.join(linked, "key", "left")


def find_secrets(docs: DataFrame, reach: int = 400) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked (weak spans that linking added) for each row of ``docs`` (doc_id, text)."""
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return _found(docs, reach).select(
        "doc_id", count("assign"), count("access"), count("hex"), "base_sha256", rendered(KINDS, "base", "linked").alias("spans"), F.coalesce(F.size("linked"), F.lit(0)).cast("long").alias("n_linked")
    )


def masked(text: str, spans: str, mask: str) -> str:
    """``text`` with every stretch that ``spans`` cover replaced."""
    out, at = [], 0
    for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, reach: int = 400, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in their texts replaced; n_chars, if there is one, is that of the new text."""
    columns = docs.columns
    own_id, own_key, own_spans = (unused(columns, c) for c in ("found_id", "found_key", "found_spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column("text").to_pylist(), batch.column(own_spans).to_pylist(), strict=True)
            done = pa.array([masked(t, s, mask) if s else t for t, s in texts], pa.string())
            yield pa.RecordBatch.from_arrays([done if c == "text" else batch.column(c) for c in columns], columns)

    found = _found(docs, reach).select("doc_id", "text_key", rendered(KINDS, "base", "linked").alias(own_spans)).where(F.col(own_spans) != "")
    found = found.select(F.coalesce("doc_id", F.lit(0)).alias(own_id), F.col("text_key").alias(own_key), own_spans).distinct()
    keyed = docs.withColumns({own_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), own_key: F.xxhash64(F.col("text").cast("string"))})
    joined = keyed.join(found, [own_id, own_key], "left")
    clean = joined.where(F.col(own_spans).isNull()).select(docs.columns)
    masked_rows = joined.where(F.col(own_spans).isNotNull()).mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked_rows = masked_rows.withColumn("n_chars", F.length("text").cast(kind))
    return clean.unionAll(masked_rows)
