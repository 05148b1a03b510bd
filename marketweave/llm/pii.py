"""Personal data: base patterns, and further spans chosen by boosted trees.

``scan`` finds the base spans (email, ip, card, phone) of each text and, with
generous generators, candidates that may overlap one another and the base.
Every candidate carries numbers that describe its format (length, groups of
digits, separators, brackets) and its context (words before it, characters
around it), but not the checks that make a base span (check digit, leading
plus, ranges). Gradient-boosted trees (MLlib) learn on two thirds of all
candidates, split by a hash of document and place, to tell those that equal a
base span from the rest; on all others a threshold for each kind is
calibrated, the least level of scores at which the share of right ones reaches
``precision``. Candidates at or above it
become spans of their own, next to the base spans, which all stay. A kind for
which no threshold reaches that precision adds nothing.

Alike candidates are fitted and counted as one row with a weight, and the
counts of right and wrong ones by kind and level are all that reaches the
driver. All candidates of all documents are scored.

Null texts count as empty. Repeated rows are handled each for itself. Rows
without a doc_id are returned with what was found. An empty table gives no
rows. Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import large_text, pieces, staged
from marketweave.llm.spans import Span, joined, rendered, sha256

KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}
#: Levels of a score between which thresholds lie.
LEVELS = 10_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NUMBER = re.compile(r"(?:\(?\+|\()?[0-9](?:[\x20().,/_-]{0,2}[0-9]){6,24}")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}){1,8}")
#: Words before a candidate that tell what it is.
CUES = ("mail", "phone", "tel", "call", "mobile", "fax", "card", "visa", "credit", "pay", "ip", "host", "server", "contact", "order", "id", "no", "account", "date", "version")
_cue = re.compile("|".join(f"(?P<c{i}>{c})" for i, c in enumerate(CUES)))
_digits = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """What the pattern ``local@domain`` matches from left to right, found from the @ signs, so that long words cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            done = end.end()
            yield "email", start, done
        at = text.find("@", max(done, at + 1))


def _ips(text: str) -> Iterator[Span]:
    """Four groups of digits with dots between, from left to right within each run of digits and dots."""
    for m in _DOTTED.finditer(text):
        run = m.group()
        if run.count(".") < 3:
            continue
        groups, at = run.split("."), m.start()
        starts = [at]
        for g in groups:
            starts.append(starts[-1] + len(g) + 1)
        i = 0
        while i + 3 < len(groups):
            four = groups[i : i + 4]
            if not all(four):
                i += 1
                continue
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in four):
                yield "ip", starts[i], starts[i + 4] - 1
            i += 4


def base_spans(text: str) -> list[Span]:
    found = list(_emails(text)) if "@" in text else []
    found += _ips(text)
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= sum(map(len, _digits.findall(m.group()))) <= 15]
    return found


def features(text: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate, in numbers."""
    own = text[start:end]
    groups = [len(g) for g in _digits.findall(own)] or [0]
    seps = [own.count(c) for c in " -./()@,"]
    before, after = text[max(0, start - 24) : start].lower(), text[end : end + 1]
    cues = [0.0] * len(CUES)
    for m in _cue.finditer(before):
        cues[m.lastindex - 1] = 1.0
    near = text[start - 1 : start] if start else ""
    around = [float(c.isalpha()) for c in (near, after)] + [float(c.isspace()) for c in (near, after)] + [float(near == "="), float(near == ":")]
    tail = own.rsplit(".", 1)[-1]
    return [float(x) for x in (len(own) - own.count("+"), sum(groups), len(groups), max(groups), min(groups), groups[0], groups[-1], max([int(g) for g in _digits.findall(own) if len(g) <= 4] or [9999]), sum(map(str.isalpha, own)), len(tail) if "@" in own else 0)] + [float(x) for x in seps] + cues + around


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) that may be personal data; one stretch can stand for several kinds."""
    if "@" in text or "at)" in text or "at]" in text or "at}" in text:
        for m in _MAIL.finditer(text):
            yield "email", m.start(), m.end()
    for m in _NUMBER.finditer(text):
        start, digits = m.start(), sum(map(len, _digits.findall(m.group())))
        if digits <= 12 and m.group().count(".") == 3:
            yield "ip", start, m.end()
        if 13 <= digits <= 19:
            yield "card", start, m.end()
        if 7 <= digits <= 15:
            yield "phone", start, m.end()


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_CANDIDATE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("is_base", pa.bool_()), ("features", pa.list_(pa.float32()))])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            base_out, proposed, sums = [], [], []
            for text in large_text(piece.column("text")).to_pylist():
                base = base_spans(text)
                known = set(base)
                base_out.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
                proposed.append([{"kind": k, "start": a, "end": b, "is_base": (k, a, b) in known, "features": features(text, a, b)} for k, a, b in candidates(text)])
                sums.append(sha256(joined(base, ORDER)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), pa.array(base_out, pa.list_(_SPAN)), pa.array(proposed, pa.list_(_CANDIDATE)), pa.array(sums)], ["doc_id", "base", "proposed", "base_sha256"])


def scan(docs: DataFrame) -> DataFrame:
    span = "kind:string,start:long,end:long"
    schema = f"doc_id long, base array<struct<{span}>>, proposed array<struct<{span},is_base:boolean,features:array<float>>>, base_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scanned, schema)


def place() -> Column:
    """A hash of a candidate's document and place, which deals it to learning or calibrating."""
    return F.xxhash64("doc_id", "start", "end", "kind")


def smallest_of_each_kind(rows: DataFrame, most: int) -> DataFrame:
    """Of each kind, the ``most`` rows of smallest place.

    Kinds are counted first: of a common kind only the places below four times the share that is wanted are sorted, so what meets in one
    task is bounded whatever the corpus holds. That so few of ``most`` rows lie there that the sample is smaller has no noticeable chance.
    """
    out = rows.limit(0)
    for kind, n in sorted((r["kind"], r["count"]) for r in rows.groupBy("kind").count().collect()):
        near = F.col("place") <= F.lit(min(2**63 - 1, 2**64 * 4 * most // n - 2**63))
        out = out.unionAll(rows.where((F.col("kind") == kind) & near).orderBy("place", "label").limit(most))
    return out


def fit(proposed: DataFrame, precision: float = 0.98) -> tuple[GBTClassificationModel | None, dict[str, int]]:
    """Boosted trees and the calibrated threshold of each kind, from every row of ``proposed`` (doc_id, kind, start, end, is_base, features).

    Alike candidates are one row with their number as weight.
    """
    rows = proposed.select("kind", F.col("is_base").cast("double").alias("label"), "features", (F.pmod(place(), F.lit(3)) == 0).alias("calibrates"))
    rows = rows.groupBy("kind", "label", "features", "calibrates").agg(F.count("*").cast("double").alias("weight"))
    rows = staged(rows, "weighted")
    learning, calibrating = (rows.where(c).withColumn("vector", vector_of("kind", "features")) for c in ("not calibrates", "calibrates"))
    if {r[0] for r in learning.select("label").distinct().collect()} != {0.0, 1.0}:
        return None, {}
    model = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=7, featuresCol="vector", weightCol="weight").fit(learning)
    level = F.floor(F.col("score") * LEVELS).cast("int").alias("level")
    # at most LEVELS + 1 rows for each kind
    counted = scores(model, calibrating).groupBy("kind", level).agg(F.sum("weight").alias("all"), F.sum(F.col("weight") * F.col("label")).alias("right")).toPandas()
    thresholds = {}
    for kind, own in counted.groupby("kind"):
        own = own.sort_values("level", ascending=False)
        above = own["all"].cumsum()
        good = own.level[(own["right"].cumsum() >= precision * above) & (above >= 20)]
        if len(good):
            thresholds[kind] = int(good.iloc[-1])
    return model, thresholds


def vector_of(kind: str, column: str):
    one_hot = F.array(*[F.when(F.col(kind) == k, 1.0).otherwise(0.0) for k in KINDS])
    return array_to_vector(F.concat(F.col(column).cast("array<double>"), one_hot)).alias("vector")


def scores(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1])


def find_personal_data(docs: DataFrame, precision: float = 0.98) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for each row of ``docs`` (doc_id, text)."""
    found = staged(scan(docs).withColumn("key", F.monotonically_increasing_id()), "personal")
    proposed = found.select("doc_id", "key", F.explode("proposed").alias("p")).select("doc_id", "key", "p.*")
    model, thresholds = fit(proposed, precision)
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    if thresholds:
        least = F.create_map(*[F.lit(x) for kv in thresholds.items() for x in kv])
        chosen = scores(model, proposed.where(~F.col("is_base")).withColumn("vector", vector_of("kind", "features"))).where(F.floor(F.col("score") * LEVELS) >= least[F.col("kind")])
        added = chosen.groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
        found = found.join(added, "key", "left")
    else:
        found = found.withColumn("added", F.lit(None).cast("array<struct<kind:string,start:long,end:long>>"))
    return found.select("doc_id", *map(count, KINDS), "base_sha256", rendered(KINDS, "base", "added").alias("spans"), F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"))
