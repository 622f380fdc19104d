"""Queries of the pipeline operators over the tables, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.url_filter import Rule, url_filter

    #: The rules that this query applies.
    rules = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]
    return url_filter(table(spark, sf_dir, "pages"), rules)


@query
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.fingerprint import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.common import new_dir
    from strataframe.llm.warc import read_archives, write_archives

    out = new_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), out)
    return read_archives(spark, out, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")




ORACLES["op3_warc_round_trip"] = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT *, list_transform([1, 11, 21, 31], lambda i: CAST('0x' || substr(hex, i, 10) AS BIGINT)) AS parts FROM p),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes,
  list_aggregate(flatten(list_transform(parts, lambda v: list_transform([35, 30, 25, 20, 15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((v >> s) & 31) + 1 AS BIGINT), 1)))), 'string_agg', '') AS payload_digest,
  row_number() OVER w AS k, first_value(page_id) OVER w AS response FROM b WINDOW w AS (PARTITION BY body ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN response END AS refers_to FROM d
"""


@query
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.kdtree import scaled, search_all

    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("v"))
    return search_all(vectors, vectors.where("vec_id % 50 = 0"), k=5)


ORACLES["op5_exact_top_k"] = """
WITH e AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM e q JOIN e c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.mixing import mix_digest

    return mix_digest(table(spark, sf_dir, "documents"))


ORACLES["op8_source_mixing"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap, list_extract([5, 2, 1], (place - 1) % 3 + 1) AS weight FROM s),
l AS (SELECT *, cap / weight AS filled_at, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
  / (sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS own_level FROM w),
f AS (SELECT own_level AS level FROM l WHERE own_level <= filled_at ORDER BY filled_at, place LIMIT 1),
t AS (SELECT source, place, source_size, cap, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(cap::DOUBLE, level * weight) END AS target FROM l, f),
q AS (SELECT *, least(cap, floor(target + 0.5)::BIGINT) AS quota FROM t),
o AS (SELECT d.*, (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size, rid ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS o FROM d),
k AS (SELECT greatest(1, least(256, sum(quota)::BIGINT // greatest(1, 64 * count(*) FILTER (quota > 0)))) AS b FROM q),
c AS (SELECT place, (quota + b - 1) // b AS slots, sum((quota + b - 1) // b) OVER (ORDER BY place)::BIGINT AS upto FROM q, k),
n AS (SELECT max(upto) AS n, round(max(upto) * (sqrt(5) - 1) / 2)::BIGINT AS near FROM c),
g AS (SELECT n, g FROM (SELECT n, v AS d, unnest([near + v, near - v]) AS g FROM n, range(1000) r(v)) WHERE g BETWEEN 1 AND greatest(1, n) AND gcd(g, n) = 1 ORDER BY d, g DESC LIMIT 1),
x AS (SELECT slot, slot * g % n AS cell FROM g, range((SELECT n FROM g)) r(slot)),
r AS (SELECT slot, place, row_number() OVER (PARTITION BY place ORDER BY slot) - 1 AS rank FROM x JOIN c ON cell >= upto - slots AND cell < upto),
p AS (SELECT rid, place, o + e * source_size AS a, least(o + e * source_size + size, quota) AS z FROM o JOIN q ON o.source IS NOT DISTINCT FROM q.source, range(3) v(e) WHERE size > 0 AND o + e * source_size < quota),
m AS (SELECT rid, place, a, z, unnest(range(a // b, (z - 1) // b + 1)) AS block, b FROM p, k),
y AS (SELECT rid, sum(least(z, (block + 1) * b) - greatest(a, block * b))::BIGINT AS taken, min(slot) AS first_slot, max(slot) AS last_slot, count(*) AS n_slots FROM m JOIN r ON m.place = r.place AND block = rank GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot, last_slot, coalesce(n_slots, 0) AS n_slots
FROM o JOIN q ON o.source IS NOT DISTINCT FROM q.source LEFT JOIN y ON y.rid = o.rid
"""


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts. The vocabulary is a merge-order one, so the table of each prefix holds the last piece of its
    admissible chain; a unigram vocabulary would have the best scores in it (tests/llm/test_pieces.py)."""
    from strataframe.llm.pieces import encode_documents, load

    return encode_documents(table(spark, sf_dir, "documents"), load())


@query
def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.pii import replace_pii

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = replace_pii(docs, key="corpus key")
    return found.select("doc_id", "text", F.size("__found").cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct(F.transform("__found", lambda e: e["kind"]))), ",").alias("kinds"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.language import fit, held_out, predict

    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataframe.llm.licenses import scan_licenses

    found = scan_licenses(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("findings", lambda f: f["license"])))
    best = F.array_max(F.transform("findings", lambda f: f["coverage"]))
    return found.select("doc_id", "n_words", F.array_join(names, ",").alias("licenses"), F.coalesce(best, F.lit(0.0)).alias("coverage"), F.size("findings").cast("long").alias("n_findings"))


ORACLES["op10_near_dedup"] = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT y, root FROM reach JOIN links ON node = x),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN least ON node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
