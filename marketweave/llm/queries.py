"""The operators' queries over the given tables, and the SQL that checks them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketweave.llm.decontam import contaminated
from marketweave.llm.hardneg import hard_negatives
from marketweave.llm.langid import identify
from marketweave.llm.minhash import near_copies
from marketweave.llm.periodic import digests, periodic_runs, planted
from marketweave.llm.pii import find_personal_data
from marketweave.llm.secrets import find_secrets
from marketweave.llm.spiece import checked
from marketweave.llm.suffixes import without_repeats
from marketweave.llm.token_prefix import count_tokens
from marketweave.llm.topk import top_k
from marketweave.llm.toxicity import toxicity
from marketweave.llm.warc import deduplicate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
""")
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of five-word shingles are similar by 0.85 or more."""
    return near_copies(table(spark, folder, "documents"))


@query()
def op2_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets that patterns find, and weak parts of credentials that complementary parts confirm."""
    return find_secrets(table(spark, folder, "documents"))


@query()
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of whole texts, from the exact counts of all prefixes."""
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids under the rebuilt model, held against sentencepiece's and decoded again."""
    return checked(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data that patterns find, and candidates that boosted trees choose."""
    return find_personal_data(table(spark, folder, "documents"))


@query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of each text by bit-sliced n-gram filters."""
    return identify(table(spark, folder, "documents"))


@query("""
WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM u q JOIN u c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
""")
def op9_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best inner products of every fiftieth vector, exactly."""
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


_HEX = "sha1(coalesce(html, ''))"
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {1 + 5 * k}, 5))::BIGINT >> {shift}) & 31) + 1, 1)" for k in range(8) for shift in (15, 10, 5, 0))


@query(f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, {_HEX} AS h FROM pages),
d AS (SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d
""")
def op10_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as an archive without repeated payloads, and read back."""
    return deduplicate(table(spark, folder, "pages"))


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of whole texts by compression under two learnt dictionaries."""
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items, copied or edited."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("""
WITH u AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM u a JOIN u c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank FROM s WHERE same QUALIFY positive_rank <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_rank ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score, CAST(positive_rank AS INTEGER) AS positive_rank
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with every seventh label moved on by one."""
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


@query(r"""
WITH RECURSIVE crc_step AS (SELECT range::BIGINT AS b, range::BIGINT AS v, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc_step WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM crc_step WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
  xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT), lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) AS h FROM documents, crc),
e AS (SELECT *, len(ws) AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM e),
w AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
  THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE ws END AS ws FROM f),
t AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(ws) AS word FROM w),
met AS (SELECT y.doc_id, y.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 4 * (y.i - x.i) <= y.n),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM met),
stretch AS (SELECT doc_id, q, min(i) - q AS s, count(*) + q AS len FROM isle GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT * FROM stretch r WHERE NOT EXISTS (FROM stretch x WHERE x.doc_id = r.doc_id AND x.q < r.q AND x.s <= r.s AND x.s + x.len >= r.s + r.len)),
summed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed, min_by({'s': s, 'len': len, 'q': q}, (-len, s, q)) AS best FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS text FROM t ANTI JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY t.doc_id)
SELECT documents.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.len AS length, best.q AS period, 1000 * best.len // best.q AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN summed USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words, those of planted repetitions included, and the texts without what they repeat."""
    return digests(periodic_runs(planted(table(spark, folder, "documents"))))


@query("""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
s AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY substr(h, 2 * p + 1, 100)) AS first FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d)),
c AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER w + 50 OR lag(p) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM s WHERE doc_id > first WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
g AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM c),
r AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY doc_id, k),
e AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
k AS (SELECT d.doc_id, sum(b - a) AS removed, count(*) AS spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM e JOIN d USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
""")
def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without the strings of 50 bytes that an earlier document holds as well."""
    found = without_repeats(table(spark, folder, "documents"))
    removed = F.aggregate(F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")), F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
