"""Queries of the engine's operators over the tables, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.functions import text
from strataframe.operators import attempts, catalog, manifest, pixels
from strataframe.plans import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query with its SQL; None where SQL cannot express it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- attempt log -------------------------------------------------------------------------------

LOG_SQL = """
WITH e AS (SELECT *, user_id * 100 + day(ts) AS key FROM events),
a AS (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS INTEGER) AS n, event_type <> 'error' AS record,
  event_type <> 'error' AND value >= 5 AS promoted, CASE WHEN event_id % 3 = 0 THEN 'edit' ELSE 'redraw' END AS workflow FROM e),
r AS (SELECT key, n AS attempt, value >= 20 AS accepted, CASE WHEN event_id % 2 = 0 THEN 'geometry' ELSE 'review' END AS source, 'value ' || CAST(floor(value) AS BIGINT) AS issue FROM a
  WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC) = 1),
s AS (SELECT key, max(n) AS latest, count(*) FILTER (record) AS records, max(n) FILTER (record) AS last_record, arg_max(record, n) AS latest_recorded,
  arg_max(promoted, n) FILTER (record) AS last_record_promoted, arg_max(promoted, n) AS latest_promoted, max(n) FILTER (promoted) AS last_promoted FROM a GROUP BY key)"""

STATUS_SQL = (
    LOG_SQL
    + """,
g AS (SELECT u * 100 + d AS key, u % 7 = 0 AS output_missing, u FROM range(150) t(u), range(1, 31) v(d)),
st AS (SELECT g.key, g.u, CASE WHEN latest IS NULL THEN 'new'
  WHEN records >= 4 AND (NOT last_record_promoted OR (NOT accepted AND attempt >= last_record) IS TRUE) THEN 'stuck'
  WHEN NOT latest_recorded THEN 'failed'
  WHEN NOT latest_promoted OR (NOT accepted AND attempt >= latest) IS TRUE THEN 'rejected'
  WHEN output_missing THEN 'missing' ELSE 'done' END AS status, coalesce(latest, 0) AS latest, coalesce(records, 0) AS records
  FROM g LEFT JOIN s ON g.key = s.key LEFT JOIN r ON r.key = s.key AND r.attempt <= s.latest)"""
)


def _log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events as an attempt log of items (user, day), and the review in each item's latest view."""
    e = read(spark, sf_dir, "events").withColumn("key", F.col("user_id") * 100 + F.dayofmonth("ts"))
    a = attempts.numbered(e, "key", "ts", F.asc_nulls_last("event_id")).withColumns(
        {"record": F.col("event_type") != "error", "promoted": (F.col("event_type") != "error") & (F.col("value") >= 5), "workflow": F.when(F.col("event_id") % 3 == 0, "edit").otherwise("redraw")}
    )
    seen = a.where("event_type = 'view'").groupBy("key").agg(F.max_by(F.struct("n", "value", "event_id"), "n").alias("r"))
    accepted = F.col("r.value") >= 20
    issue = F.concat(F.lit("value "), F.floor("r.value").cast("string"))
    r = seen.select("key", F.col("r.n").alias("attempt"), accepted.alias("accepted"), F.when(accepted, F.array().cast("array<string>")).otherwise(F.array(issue)).alias("issues"), F.when(F.col("r.event_id") % 2 == 0, "geometry").otherwise("review").alias("source"))
    return a, r


def _items(users: DataFrame) -> DataFrame:
    """Days 1 to 30 of each user u."""
    return users.select("u", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("d")).select((F.col("u") * 100 + F.col("d")).alias("key"), (F.col("u") % 7 == 0).alias("output_missing"), "u")


def _fixed_users(spark: SparkSession) -> DataFrame:
    """Users 0 to 149, which the SQL has."""
    return spark.range(150).withColumnRenamed("id", "u")


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users 0 to 149, whether or not they have events, and all others that have."""
    seen = read(spark, sf_dir, "events").select(F.col("user_id").cast("long").alias("u")).where("u IS NOT NULL")
    return _fixed_users(spark).union(seen).distinct()


@query(STATUS_SQL + " SELECT key, status, latest, records FROM st")
def q01_item_status(spark, sf_dir):
    a, r = _log(spark, sf_dir)
    return attempts.item_status(_items(_users(spark, sf_dir)), a, r)


@query(LOG_SQL + " SELECT s.key, CASE WHEN accepted OR coalesce(last_promoted, 0) > attempt THEN '' WHEN source = 'geometry' THEN 'keep the layout' ELSE issue END AS corrections FROM s JOIN r ON s.key = r.key AND attempt <= latest")
def q02_corrections(spark, sf_dir):
    a, r = _log(spark, sf_dir)
    return attempts.corrections(a, r, "keep the layout").withColumn("corrections", F.array_join("corrections", ";"))


@query(LOG_SQL + " SELECT key, string_agg(DISTINCT workflow, ',' ORDER BY workflow) AS used, CASE WHEN bool_or(workflow = 'edit') AND NOT bool_or(workflow = 'redraw') THEN 'redraw' ELSE 'edit' END AS workflow FROM a WHERE record GROUP BY key")
def q03_fallback(spark, sf_dir):
    a, _ = _log(spark, sf_dir)
    flows = spark.createDataFrame([("edit", "redraw"), ("redraw", None)], "name string, fallback string")
    return attempts.next_workflow(a, flows, "edit").withColumn("used", F.array_join("used", ","))


@query(
    STATUS_SQL
    + """, rt AS (SELECT CASE WHEN u % 11 = 0 THEN 'copy' WHEN status IN ('done', 'stuck') THEN status WHEN key % 13 = 0 THEN 'uncaptioned' ELSE 'work' END AS route FROM st)
SELECT k.route, count(rt.route) AS n FROM (VALUES ('copy'), ('done'), ('stuck'), ('uncaptioned'), ('work'), ('never')) k(route) LEFT JOIN rt ON rt.route = k.route GROUP BY k.route"""
)
def q04_route_work(spark, sf_dir):
    a, r = _log(spark, sf_dir)
    st = attempts.item_status(_items(_users(spark, sf_dir)), a, r)
    copied = F.pmod("key", F.lit(1100)) < 100  # each eleventh user; a quotient of long keys would be rounded
    routed = st.select(attempts.route(F.col("status"), copied, F.col("key") % 13 == 0).alias("route")).groupBy("route").agg(F.count("*").alias("n"))
    return attempts.zero_filled(routed, "route", ["copy", "done", "stuck", "uncaptioned", "work", "never"])


@query("SELECT c_custkey AS key, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 4 END IS DISTINCT FROM CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey % 4 END AS stale FROM customer")
def q05_stale_objects(spark, sf_dir):
    key = F.col("c_custkey")
    was, now = F.when(key % 5 != 0, key % 4), F.when(key % 10 != 0, F.col("c_nationkey") % 4)
    return read(spark, sf_dir, "customer").select(key.alias("key"), attempts.stale(was, now).alias("stale"))


VERIFY_SQL = """SELECT o_orderkey AS key, CASE WHEN o_orderkey % 17 = 0 THEN 'BADPLACE' WHEN o_totalprice < 20000 THEN 'MISSING' WHEN o_orderkey % 23 = 0 THEN 'UNREADABLE' WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN 'WRONGSIZE'
  WHEN o_custkey % 19 = 0 THEN 'WRONGMODE' WHEN o_custkey % 29 = 0 THEN 'WRONGALPHA' WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderkey % 31 = 0 THEN 'UNRECORDED' WHEN o_orderkey % 37 = 0 THEN 'STALE' END AS code FROM orders"""


@query(VERIFY_SQL)
def q06_verify_codes(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    skip = F.col("o_orderpriority") == "5-LOW"
    code = attempts.first_code(
        ("BADPLACE", k % 17 == 0), ("MISSING", F.col("o_totalprice") < 20000), ("UNREADABLE", k % 23 == 0), ("WRONGSIZE", (F.col("o_orderstatus") == "P") & (c % 2 == 0)),
        ("WRONGMODE", c % 19 == 0), ("WRONGALPHA", c % 29 == 0), ("UNRECORDED", ~skip & (k % 31 == 0)), ("STALE", ~skip & (k % 37 == 0)),
    )
    return read(spark, sf_dir, "orders").select(k.alias("key"), code.alias("code"))


@query(
    STATUS_SQL
    + """ SELECT c_custkey AS key, CASE WHEN c_custkey % 33 = 0 THEN 'bad' WHEN c_custkey % 10 = 0 THEN 'copy' WHEN rs.status <> 'done' THEN 'waiting' WHEN os.status IN ('done', 'stuck') THEN os.status ELSE 'work' END AS route
FROM customer JOIN st rs ON rs.key = c_nationkey * 100 + 1 JOIN st os ON os.key = c_nationkey * 100 + 1 + c_custkey % 30"""
)
def q07_object_route(spark, sf_dir):
    a, r = _log(spark, sf_dir)
    st = attempts.item_status(_items(_fixed_users(spark)), a, r).select("key", "status")
    c = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") * 100 + 1).alias("room_key"), (F.col("c_nationkey") * 100 + 1 + F.col("c_custkey") % 30).alias("own_key"))
    rooms, own = st.select(F.col("key").alias("room_key"), F.col("status").alias("room_status")), st.select(F.col("key").alias("own_key"), "status")
    out = c.join(rooms, "room_key").join(own, "own_key")
    return out.select(F.col("c_custkey").alias("key"), attempts.object_route(F.col("c_custkey") % 33 == 0, F.col("c_custkey") % 10 == 0, F.col("room_status"), F.col("status")).alias("route"))


# ---- manifest ----------------------------------------------------------------------------------

ASSET_SQL = """WITH d AS (SELECT doc_id, lang AS family, source, CASE WHEN doc_id % 5 <> 0 THEN doc_id END AS frame, 'doc' || doc_id AS name, coalesce(octet_length(encode(text)), 0) AS size, text FROM documents),
s AS (SELECT *, CASE WHEN frame IS NULL THEN concat_ws(':', family, name) ELSE concat_ws(':', family, lower(source), lpad(CAST(frame AS VARCHAR), CAST(greatest(5, length(CAST(frame AS VARCHAR))) AS INTEGER), '0')) END AS id FROM d)"""


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("family"), "source", F.when(F.col("doc_id") % 5 != 0, F.col("doc_id")).alias("frame"), F.concat(F.lit("doc"), "doc_id").alias("name"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"), "text")
    return d.withColumn("id", manifest.asset_id(F.col("family"), F.col("source"), F.col("frame"), F.col("name")))


@query(ASSET_SQL + " SELECT id, row_number() OVER (PARTITION BY source ORDER BY coalesce(frame, -1), id) AS ord, CASE WHEN frame IS NULL THEN '{\"id\":\"' || id || '\",\"size\":' || size || ',\"frame\":null}' ELSE '{\"id\":\"' || id || '\",\"frame\":' || frame || ',\"size\":' || size || '}' END AS record FROM s")
def q10_asset_manifest(spark, sf_dir):
    record = manifest.asset_json("id", "frame", "size", always=("frame",))
    rows = _assets(spark, sf_dir).select("source", F.coalesce("frame", F.lit(-1)).alias("at"), "id", record.alias("record"))
    return manifest.numbered(rows, "source", ["at", "id"], "ord").select("id", (F.col("ord") + 1).alias("ord"), "record")


@query("SELECT k.kind, count(d.lang) AS n FROM (VALUES ('en'), ('de'), ('fr'), ('none')) k(kind) LEFT JOIN documents d ON CASE d.lang WHEN 'es' THEN 'fr' ELSE d.lang END = k.kind GROUP BY k.kind")
def q11_counts_zero_filled(spark, sf_dir):
    folded = read(spark, sf_dir, "documents").groupBy(F.when(F.col("lang") == "es", "fr").otherwise(F.col("lang")).alias("kind")).agg(F.count("*").alias("n"))
    return attempts.zero_filled(folded, "kind", ["en", "de", "fr", "none"])


@query(ASSET_SQL + " SELECT split_part(id, ':', 1) AS family, count(*) AS n, CAST(sum(size) AS BIGINT) AS total FROM s GROUP BY 1")
def q12_family_totals(spark, sf_dir):
    return manifest.family_totals(_assets(spark, sf_dir))


@query("SELECT sha256(text) AS hash, count(*) AS uses FROM documents GROUP BY 1")
def q13_palette_dedupe(spark, sf_dir):
    return manifest.palettes(read(spark, sf_dir, "documents"), "text")


@query("SELECT source AS bundle, sha256(string_agg('doc' || doc_id || chr(10) || n_chars || chr(10), '' ORDER BY 'doc' || doc_id, n_chars)) AS hash FROM documents GROUP BY 1")
def q14_bundle_hash(spark, sf_dir):
    files = read(spark, sf_dir, "documents").select(F.col("source").alias("bundle"), F.concat(F.lit("doc"), "doc_id").alias("path"), F.col("n_chars").alias("size"))
    return manifest.bundle_hash(files, "bundle", "\n")


@query("""WITH e AS (SELECT 'user' || user_id AS source, CAST(floor(value) AS BIGINT) AS "offset", event_id AS ord, props AS reason FROM events WHERE event_type = 'error')
SELECT source, CAST(row_number() OVER w AS INTEGER) AS rank, "offset", reason, greatest(count(*) OVER (PARTITION BY source) - 5, 0) AS more FROM e WINDOW w AS (PARTITION BY source ORDER BY "offset", ord) QUALIFY row_number() OVER w <= 5""")
def q15_error_sort_limit(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("event_type = 'error'").select(F.concat(F.lit("user"), "user_id").alias("source"), F.floor("value").alias("offset"), F.col("event_id").alias("ord"), F.col("props").alias("reason"))
    return manifest.shown_errors(e)


@query("SELECT 'supplier' AS kind, s_suppkey AS id, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT 'customer', c_custkey, c_name, c_mktsegment FROM customer")
def q16_union_records(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = read(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    return manifest.union_records(s, c)


# ---- catalog -----------------------------------------------------------------------------------

ROOM_SQL = "SELECT n_nationkey AS room, 8 * (12 + n_nationkey) AS room_w, 60 + 3 * n_nationkey AS room_h FROM nation"
OBJECT_SQL = "SELECT c_custkey AS key, CASE WHEN c_custkey % 33 = 0 THEN 99 ELSE c_nationkey END AS room, CAST(c_custkey % 120 - 4 AS INTEGER) AS x, CAST(c_custkey % 70 - 2 AS INTEGER) AS y, CAST(8 + c_custkey % 40 AS INTEGER) AS w, CAST(8 + c_custkey % 30 AS INTEGER) AS h FROM customer"


def _rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return read(spark, sf_dir, "nation").select(n.alias("room"), (8 * (12 + n)).alias("room_w"), (60 + 3 * n).alias("room_h"))


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    whole = lambda c, name: c.cast("int").alias(name)
    return read(spark, sf_dir, "customer").select(k.alias("key"), F.when(k % 33 == 0, 99).otherwise(F.col("c_nationkey")).alias("room"), whole(k % 120 - 4, "x"), whole(k % 70 - 2, "y"), whole(8 + k % 40, "w"), whole(8 + k % 30, "h"))


@query(f"WITH r AS ({ROOM_SQL}), o AS ({OBJECT_SQL}) SELECT key, o.room, CASE WHEN r.room IS NULL THEN 'unknown room' WHEN x < 0 OR y < 0 OR x + w > room_w OR y + h > room_h THEN 'outside' ELSE 'ok' END AS place FROM o LEFT JOIN r ON o.room = r.room")
def q20_placement(spark, sf_dir):
    return catalog.placement(_objects(spark, sf_dir), _rooms(spark, sf_dir))


@query("SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'missing' ELSE 'extra' END AS problem FROM (SELECT DISTINCT o_custkey AS key FROM orders) a FULL JOIN (SELECT c_custkey AS key FROM customer WHERE c_acctbal > 0) b ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL")
def q21_coverage(spark, sf_dir):
    return catalog.coverage(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), read(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key")))


@query("SELECT c_custkey % 9 AS key, c_nationkey AS room FROM customer WHERE c_custkey % 9 IN (SELECT s_suppkey % 9 FROM supplier WHERE s_nationkey = c_nationkey)")
def q22_skip_list_semi(spark, sf_dir):
    entries = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("room")).agg(F.collect_set(F.col("s_suppkey") % 9).alias("skip"))
    return catalog.listed(read(spark, sf_dir, "customer").select((F.col("c_custkey") % 9).alias("key"), F.col("c_nationkey").alias("room")), entries)


@query("SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def q23_duplicates(spark, sf_dir):
    return manifest.duplicates(read(spark, sf_dir, "part"), "p_name", "p_brand")


@query("""WITH a AS (SELECT o_custkey AS key, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS n, o_orderkey % 3 AS sha, o_totalprice > 100000 AS promoted, o_orderkey AS input FROM orders)
SELECT a.key, max(n) AS n, CAST(arg_max(input, n) AS VARCHAR) AS input_sha FROM a JOIN customer ON c_custkey = key AND sha = c_custkey % 3 WHERE promoted GROUP BY a.key""")
def q24_latest_promoted_asof(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("key", F.col("o_custkey"))
    a = attempts.numbered(o, "key", "o_orderdate", "o_orderkey").select("key", "n", (F.col("o_orderkey") % 3).alias("sha"), F.lit(True).alias("record"), (F.col("o_totalprice") > 100000).alias("promoted"), F.col("o_orderkey").cast("string").alias("input_sha"))
    return attempts.latest_promoted(a, read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), (F.col("c_custkey") % 3).alias("sha")))


@query("""WITH a AS (SELECT o_orderkey AS at, o_custkey AS w, o_orderstatus AS s FROM orders), b AS (SELECT CASE WHEN o_orderkey % 101 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS at, CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_custkey END AS w, CASE WHEN o_orderkey % 11 = 0 THEN '?' ELSE o_orderstatus END AS s FROM orders)
SELECT coalesce(a.at, b.at) AS at, CASE WHEN a.at IS NULL THEN 'long' WHEN b.at IS NULL THEN 'short' WHEN a.w <> b.w THEN 'w' ELSE 's' END AS difference FROM a FULL JOIN b ON a.at = b.at WHERE a.at IS NULL OR b.at IS NULL OR a.w <> b.w OR a.s <> b.s""")
def q25_zip_compare(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("at"), F.col("o_custkey").alias("w"), F.col("o_orderstatus").alias("s"))
    b = o.select(F.when(F.col("at") % 101 == 0, -1 - F.col("at")).otherwise(F.col("at")).alias("at"), F.when(F.col("at") % 7 == 0, -1).otherwise(F.col("w")).alias("w"), F.when(F.col("at") % 11 == 0, "?").otherwise(F.col("s")).alias("s"))
    return catalog.first_difference(o, b, "at", ["w", "s"])


@query("SELECT l_returnflag || l_linestatus AS tag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS total, CAST(min(l_quantity) AS BIGINT) AS least, CAST(max(l_quantity) AS BIGINT) AS most FROM lineitem GROUP BY 1")
def q26_tag_census(spark, sf_dir):
    chunks = read(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("t"), F.col("l_quantity").cast("long").alias("size"))
    return manifest.census(chunks, "t", "size")


BLOCK_SQL = "SELECT l_orderkey AS room, l_linenumber * 10 + l_orderkey AS start, 10 AS size, l_linenumber * 8 + CASE WHEN l_partkey % 900 = 0 THEN 1 ELSE 0 END AS width FROM lineitem"


@query(f"WITH b AS ({BLOCK_SQL}), n AS (SELECT *, lead(start) OVER (PARTITION BY room ORDER BY start, size) AS after FROM b) SELECT room, bool_and(coalesce(after = start + size, TRUE)) AS contiguous, bool_and(width % 8 = 0) AS strips_fit FROM n GROUP BY 1")
def q27_invariants(spark, sf_dir):
    blocks = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("room"), (F.col("l_linenumber") * 10 + F.col("l_orderkey")).alias("start"), F.lit(10).alias("size"), (F.col("l_linenumber") * 8 + F.when(F.col("l_partkey") % 900 == 0, 1).otherwise(0)).alias("width"))
    return manifest.contiguous(blocks, "room")


@query("SELECT room, batch, string_agg(CAST(key AS VARCHAR), ',' ORDER BY key) AS keys FROM (SELECT c_nationkey AS room, c_custkey AS key, CAST((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 8 AS INTEGER) AS batch FROM customer) GROUP BY 1, 2")
def q28_batches_of_8(spark, sf_dir):
    return manifest.batches(read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("room"), F.col("c_custkey").alias("key")), "room", "key")


@query("SELECT p_partkey AS key FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def q29_anti_required(spark, sf_dir):
    return catalog.absent(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key")), read(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("key")), "key")


# ---- text --------------------------------------------------------------------------------------

CAPTION_SQL = "SELECT p_partkey, p_size, concat('SCENE: ', p_name, chr(10), '**MEDIUM:** ', CASE WHEN p_size % 5 = 0 THEN 'pre-rendered 3D ' ELSE '' END, p_type, chr(10), 'TEXT: ', CASE WHEN p_size % 3 = 0 THEN 'none.' ELSE p_brand END) AS caption, p_name, CASE WHEN p_size % 5 = 0 THEN 'pre-rendered 3D ' ELSE '' END || p_type AS medium, CASE WHEN p_size % 3 = 0 THEN 'none.' ELSE p_brand END AS lettering FROM part"


def _captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    caption = F.concat(F.lit("SCENE: "), "p_name", F.lit("\n**MEDIUM:** "), F.when(size % 5 == 0, "pre-rendered 3D ").otherwise(""), "p_type", F.lit("\nTEXT: "), F.when(size % 3 == 0, "none.").otherwise(F.col("p_brand")))
    return read(spark, sf_dir, "part").select("p_partkey", "p_size", caption.alias("caption"))


@query(f"SELECT p_partkey, trim(p_name) AS scene, trim(medium) AS medium, NULL::VARCHAR AS layout, CASE WHEN lettering <> 'none.' THEN lettering END AS lettering FROM ({CAPTION_SQL})")
def q30_sections(spark, sf_dir):
    c = F.col("caption")
    return _captions(spark, sf_dir).select("p_partkey", text.section(c, "SCENE").alias("scene"), text.section(c, "MEDIUM").alias("medium"), text.section(c, "LAYOUT").alias("layout"), text.lettering(c).alias("lettering"))


@query(f"SELECT p_partkey, 'SCENE: ' || trim(p_name) || chr(10) || 'MEDIUM: ' || trim(medium) || chr(10) || 'TEXT: ' || lettering AS caption FROM ({CAPTION_SQL})")
def q31_roomwide(spark, sf_dir):
    return _captions(spark, sf_dir).select("p_partkey", text.room_wide(F.col("caption")).alias("caption"))


@query(f"SELECT p_partkey, CASE WHEN regexp_matches(medium, '(?i)pre-?rendered|\\b3d\\b|\\bcgi\\b|computer[- ]generated') THEN 'rendered' ELSE 'painted' END AS style FROM ({CAPTION_SQL})")
def q32_style(spark, sf_dir):
    return _captions(spark, sf_dir).select("p_partkey", text.style(F.col("caption")).alias("style"))


WORDING = text.Wording("Paint {reference}.", "Render {reference}.", "An insert.", "An insert that says {text}.", "OBSERVED:", "CORRECT:", "The reference wins.", "the picture")


@query(f"""SELECT p_partkey, concat_ws(chr(10) || chr(10), CASE WHEN p_size % 5 = 0 THEN 'Render the picture.' ELSE 'Paint the picture.' END,
  CASE WHEN p_size % 2 = 0 THEN CASE WHEN p_size % 3 = 0 THEN 'An insert.' ELSE 'An insert that says ' || lettering || '.' END END,
  CASE WHEN p_size % 7 = 0 THEN 'from ' || p_size || '% to 100% of the room''s width' END, 'OBSERVED:' || chr(10) || caption,
  CASE WHEN p_partkey % 4 = 0 THEN 'CORRECT:' || chr(10) || 'a' || chr(10) || 'b' END, 'The reference wins.') AS prompt FROM ({CAPTION_SQL})""")
def q33_prompt(spark, sf_dir):
    size, c = F.col("p_size"), F.col("caption")
    note = F.when(size % 7 == 0, text.window_note(size, F.lit(100), F.lit(0), F.lit(100)))
    said = F.when(F.col("p_partkey") % 4 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    return _captions(spark, sf_dir).select("p_partkey", text.prompt(c, F.when(size % 2 == 0, "insert").otherwise("scene"), said, note, text.style(c), WORDING).alias("prompt"))


@query("SELECT doc_id, sha256(regexp_replace(regexp_replace(text || '  ' || chr(10) || 'x' || chr(9) || chr(10) || chr(10), '[ \\t]+($|\\n)', '\\1', 'g'), '\\n+$', '')) AS hash FROM documents")
def q34_normalize(spark, sf_dir):
    raw = F.concat("text", F.lit("  \nx\t\n\n"))
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(text.normalized(raw).cast("binary"), 256).alias("hash"))


ANSWER = "CASE WHEN event_id % 4 = 0 THEN 'Sure: ' ELSE '' END || '{\"accepted\": ' || CASE WHEN event_id % 3 = 0 THEN 'true' WHEN event_id % 3 = 1 THEN 'false' ELSE '1' END || ', \"issues\": [' || CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN '\" \"' ELSE '\"late\"' END || ']}'"


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 OR event_id % 5 = 1 OR (event_id % 3 = 0) <> (event_id % 5 = 0) THEN NULL ELSE event_id % 3 = 0 END AS accepted, CASE WHEN event_id % 3 = 1 AND event_id % 5 > 1 THEN 'late' WHEN event_id % 3 = 0 AND event_id % 5 = 0 THEN '' END AS issues FROM events")
def q35_verdicts(spark, sf_dir):
    v = text.verdict(F.expr(ANSWER))
    return read(spark, sf_dir, "events").select("event_id", v["accepted"].alias("accepted"), F.array_join(v["issues"], ";").alias("issues"))


@query("SELECT event_id, 'k' || k AS key, k = 1 AS accepted FROM events, range(4) t(k) WHERE k IN (1, 2) AND NOT (k = 2 AND event_id % 3 = 0)")
def q36_object_verdict_map(spark, sf_dir):
    two = F.when(F.col("event_id") % 3 == 0, '"issues": []').otherwise('"issues": ["x"]')
    answer = F.concat(F.lit('```json\n{"objects": {"k0": {"accepted": true, "issues": []}, "k1": {"accepted": true, "issues": []}, "k2": {"accepted": false, '), two, F.lit('}, "k3": {"issues": ["y"]}}}\n```'))
    found = text.object_verdicts(answer, F.array(*[F.lit(f"k{i}") for i in (1, 2, 3)]))
    return read(spark, sf_dir, "events").select("event_id", F.explode(found).alias("key", "v")).select("event_id", "key", F.col("v.accepted").alias("accepted"))


@query("SELECT p_partkey, coalesce(list_transform(string_split(v, '.'), lambda x: TRY_CAST(x AS INTEGER)) >= [0, 20, 3] AND NOT list_contains(list_transform(string_split(v, '.'), lambda x: TRY_CAST(x AS INTEGER) IS NULL), TRUE), FALSE) AS fits FROM (SELECT p_partkey, '0.' || p_size || CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 4 = 1 THEN '.x' ELSE '.' || p_partkey % 7 END AS v FROM part)")
def q37_version_gate(spark, sf_dir):
    k = F.col("p_partkey")
    v = F.concat(F.lit("0."), "p_size", F.when(k % 4 == 0, "").when(k % 4 == 1, ".x").otherwise(F.concat(F.lit("."), k % 7)))
    return read(spark, sf_dir, "part").select("p_partkey", catalog.at_least(v, (0, 20, 3)).alias("fits"))


@query(f"SELECT p_partkey, rpad('part' || p_partkey, CAST(greatest(12, length('part' || p_partkey)) AS INTEGER), ' ') || CASE WHEN p_size % 2 = 0 THEN 'insert' ELSE 'scene' END || CASE WHEN p_size % 4 > 1 OR p_size % 3 = 0 THEN ' (' || concat_ws('; ', CASE WHEN p_size % 4 > 1 THEN p_size % 4 || ' windows' END, CASE WHEN p_size % 3 = 0 THEN 'wraps at ' || p_size END) || ')' ELSE '' END AS line FROM ({CAPTION_SQL})")
def q38_plan_line(spark, sf_dir):
    size = F.col("p_size")
    line = text.plan_line(F.concat(F.lit("part"), "p_partkey"), F.when(size % 2 == 0, "insert").otherwise("scene"), size % 4, F.when(size % 3 == 0, size), F.lit(1))
    return read(spark, sf_dir, "part").select("p_partkey", line.alias("line"))


# ---- rasters -----------------------------------------------------------------------------------

E8_SQL = "SELECT vec_id AS img, CAST(p // 8 AS INTEGER) AS y, CAST(p % 8 AS INTEGER) AS x, CAST(floor(CAST(list_extract(embedding, CAST(p + 1 AS BIGINT)) AS DOUBLE) * 128 + 128) AS INTEGER) AS v FROM embeddings, range(64) t(p)"
L64_SQL = "SELECT 0 AS img, CAST(l_orderkey // 64 % 48 AS INTEGER) AS y, CAST(l_orderkey % 64 AS INTEGER) AS x, CAST(sum(l_linenumber * 17 % 256) AS INTEGER) AS v FROM lineitem GROUP BY 2, 3"


def _e8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding of 64 floats as an 8 by 8 image."""
    px = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img"), F.posexplode("embedding").alias("p", "e"))
    return px.select("img", F.floor(F.col("p") / 8).cast("int").alias("y"), (F.col("p") % 8).alias("x"), F.floor(F.col("e").cast("double") * 128 + 128).cast("int").alias("v"))


def _l64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One image of 64 by 48 from sums of line numbers."""
    k = F.col("l_orderkey")
    px = read(spark, sf_dir, "lineitem").select((F.floor(k / 64) % 48).cast("int").alias("y"), (k % 64).cast("int").alias("x"), (F.col("l_linenumber") * 17 % 256).alias("v"))
    return px.groupBy("y", "x").agg(F.sum("v").cast("int").alias("v")).select(F.lit(0).alias("img"), "y", "x", "v")


STAT_SQL = "SELECT img, count(*) AS n, CAST(sum(v) AS BIGINT) AS total, CAST(sum(v * v) AS BIGINT) AS squares FROM p GROUP BY 1"


@query(f"WITH p AS ({E8_SQL}), s AS ({STAT_SQL}) SELECT img, n, total, squares, round(total / n, 6) AS mean, round(sqrt((n * squares - total * total) / (n * n)), 6) AS std FROM s")
def q40_channel_stats(spark, sf_dir):
    return pixels.statistics(_e8(spark, sf_dir), "img").withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(f"""WITH p AS ({E8_SQL}), s AS ({STAT_SQL}), t AS (SELECT img, total / n AS m, sqrt((n * squares - total * total) / (n * n)) AS s FROM s)
SELECT p.img, y, x, v, round(v + 0.5 * ((v - a.m) * CASE WHEN a.s > 1e-6 THEN b.s / a.s ELSE 1 END + b.m - v), 4) AS moved FROM p JOIN t a ON a.img = p.img JOIN t b ON b.img = CASE WHEN p.img % 2 = 0 THEN p.img + 1 ELSE p.img - 1 END""")
def q41_colour_transfer(spark, sf_dir):
    px = _e8(spark, sf_dir)
    guide = px.withColumn("img", F.when(F.col("img") % 2 == 0, F.col("img") + 1).otherwise(F.col("img") - 1))
    return pixels.transferred(px, guide, "img", 0.5).withColumn("moved", F.round("moved", 4))


@query(f"WITH p AS ({E8_SQL}) SELECT img, CAST(y // 4 AS INTEGER) AS y, CAST(x // 4 AS INTEGER) AS x, CAST(sum(v) AS BIGINT) AS total, count(*) AS n FROM p GROUP BY 1, 2, 3")
def q42_box_downscale(spark, sf_dir):
    return pixels.box_sums(_e8(spark, sf_dir), 4, "img")


@query(f"WITH p AS ({E8_SQL}) SELECT img, CAST(y * 4 + b AS INTEGER) AS y, CAST(x * 4 + a AS INTEGER) AS x, v FROM p, range(4) s(a), range(4) t(b)")
def q43_nearest_upscale(spark, sf_dir):
    return pixels.enlarged(_e8(spark, sf_dir), 4)


SOBEL_SQL = "SELECT c.img, c.y, c.x, sum(q.v * (q.x - c.x) * (2 - abs(q.y - c.y)))::INTEGER AS gx, sum(q.v * (q.y - c.y) * (2 - abs(q.x - c.x)))::INTEGER AS gy FROM {p} c JOIN {p} q ON q.img = c.img AND q.y BETWEEN c.y - 1 AND c.y + 1 AND q.x BETWEEN c.x - 1 AND c.x + 1 GROUP BY 1, 2, 3"


@query(f"WITH p AS ({L64_SQL}), s AS ({SOBEL_SQL.format(p='p')}) SELECT img, y, x, gx, gy, gx * gx + gy * gy AS gg FROM s WHERE x BETWEEN 1 AND 62 AND y BETWEEN 1 AND 46")
def q44_sobel(spark, sf_dir):
    return pixels.sobel(_l64(spark, sf_dir), replicate=False).where("x BETWEEN 1 AND 62 AND y BETWEEN 1 AND 46").select("img", "y", "x", "gx", "gy", "gg")


PADDED = "SELECT p.img, b AS y, a AS x, p.v FROM range(-1, 9) s(a), range(-1, 9) t(b) JOIN p ON p.x = least(7, greatest(0, a)) AND p.y = least(7, greatest(0, b))"


@query(f"WITH p AS ({E8_SQL}), q AS ({PADDED}), s AS ({SOBEL_SQL.format(p='q')}) SELECT img, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, gx * gx + gy * gy AS gg FROM s WHERE x BETWEEN 0 AND 7 AND y BETWEEN 0 AND 7")
def q44b_sobel_border(spark, sf_dir):
    return pixels.sobel(_e8(spark, sf_dir)).select("img", "y", "x", "gg")


@query(f"WITH p AS ({E8_SQL}) SELECT c.img, c.y, c.x, bool_or(q.v > 170) AS near FROM p c JOIN p q ON q.img = c.img AND abs(q.y - c.y) < 2 AND abs(q.x - c.x) < 2 GROUP BY 1, 2, 3")
def q45_dilate(spark, sf_dir):
    return pixels.grown(_e8(spark, sf_dir).withColumn("near", F.col("v") > 170), "near").select("img", "y", "x", "near")


@query(f"""WITH p AS ({E8_SQL}), q AS ({PADDED}), g AS (SELECT img, y, x, gx * gx + gy * gy AS gg FROM ({SOBEL_SQL.format(p='q')}) WHERE x BETWEEN 0 AND 7 AND y BETWEEN 0 AND 7),
r AS (SELECT img + CASE WHEN img % 2 = 0 THEN 1 ELSE -1 END AS img, y, x, gg > 3600 AS hit FROM g), k AS (SELECT c.img, c.y, c.x, bool_or(q.hit) AS kept FROM r c JOIN r q ON q.img = c.img AND abs(q.y - c.y) < 2 AND abs(q.x - c.x) < 2 GROUP BY 1, 2, 3)
SELECT g.img, count(*) FILTER (gg > 6400) AS strong, CASE WHEN count(*) FILTER (gg > 6400) < 10 THEN 1.0::DOUBLE ELSE round(count(*) FILTER (gg > 6400 AND kept) / count(*) FILTER (gg > 6400), 4) END AS share FROM g JOIN k ON g.img = k.img AND g.y = k.y AND g.x = k.x GROUP BY 1""")
def q46_edge_agreement(spark, sf_dir):
    px = _e8(spark, sf_dir)
    other = px.withColumn("img", F.col("img") + F.when(F.col("img") % 2 == 0, 1).otherwise(-1))
    maps = pixels.edge_maps(px, other)
    return maps.groupBy("img").agg(F.count_if("strong").alias("strong"), F.round(pixels.kept_share(F.col("strong"), F.col("kept"), 10), 4).alias("share"))


@query(f"""WITH p AS ({L64_SQL}), s AS (SELECT a.x, sum(abs(a.v - b.v)) / count(*) AS step FROM p a JOIN p b ON a.y = b.y AND a.x = b.x + 1 GROUP BY 1)
SELECT 0 AS img, round(least((SELECT step FROM s WHERE x = 30) / (SELECT median(step) FROM s WHERE x BETWEEN 14 AND 46 AND x <> 30), 999), 3) AS ratio""")
def q47_seam_ratio(spark, sf_dir):
    return pixels.seam_ratio(pixels.column_steps(_l64(spark, sf_dir)), 30, 16)


MARGIN_SQL = "SELECT img, y, x, CASE WHEN x < img % 9 THEN 7 ELSE v END AS v FROM p"


@query(f"WITH p AS ({E8_SQL}), m AS ({MARGIN_SQL}), l AS (SELECT img, x, min(v) AS low, max(v) AS high FROM m GROUP BY 1, 2), f AS (SELECT img, min(low) FILTER (x = 0 AND low = high) AS first FROM l GROUP BY 1) SELECT l.img, coalesce(min(x) FILTER (first IS NULL OR low <> high OR low <> first), 8) AS run FROM l JOIN f ON l.img = f.img GROUP BY 1")
def q48_flat_margins(spark, sf_dir):
    px = _e8(spark, sf_dir).withColumn("v", F.when(F.col("x") < F.col("img") % 9, 7).otherwise(F.col("v")))
    return pixels.flat_run(px, "x")


@query("SELECT n_nationkey AS img, CAST(5 + n_nationkey % 7 AS INTEGER) AS period FROM nation")
def q49_wrap_period(spark, sf_dir):
    img = F.col("n_nationkey")
    rows = read(spark, sf_dir, "nation").select(img.alias("img"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("y"))
    px = rows.select("img", "y", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("x"))
    at = F.col("x") % (5 + F.col("img") % 7)
    return pixels.wrap_period(px.withColumn("v", (at * at * 37 + F.col("y") * 11 + F.col("img")) % 251), 40, least=4, span=8)


GRID_SQL = """WITH RECURSIVE rooms AS (SELECT n_nationkey AS room, 8 * (n_nationkey % 4) AS l, 8 * (40 + 11 * n_nationkey) AS r, 0 AS t, 8 * (20 + 5 * n_nationkey) AS b FROM nation),
axis AS (SELECT room, 'x' AS axis, l AS a, r AS b, 320 AS size FROM rooms UNION ALL SELECT room, 'y', t, b, 240 FROM rooms),
tried AS (SELECT *, ceil((b - a - 64) / (size - 64))::INTEGER + k::INTEGER AS n FROM axis, range(8) t(k) WHERE b - a > size),
placed AS (SELECT tried.*, i, CASE WHEN i = n - 1 THEN b - size ELSE a + 8 * ((i * (b - a - size) // (n - 1)) // 8) END AS s FROM tried, range(64) t(i) WHERE i < n),
fits AS (SELECT room, axis, n, bool_and(coalesce(s - before <= size - 64, TRUE)) AS ok FROM (SELECT *, lag(s) OVER (PARTITION BY room, axis, n ORDER BY i) AS before FROM placed) GROUP BY 1, 2, 3),
best AS (SELECT room, axis, min(n) AS n FROM fits WHERE ok GROUP BY 1, 2),
spans AS (SELECT p.room, p.axis, s AS lo, s + size AS hi FROM placed p JOIN best USING (room, axis, n) UNION ALL SELECT room, axis, a, b FROM axis WHERE b - a <= size),
grid AS (SELECT x.room, CAST(row_number() OVER (PARTITION BY x.room ORDER BY y.lo, x.lo) - 1 AS INTEGER) AS "window", x.lo::INTEGER AS x0, x.hi::INTEGER AS x1, y.lo::INTEGER AS y0, y.hi::INTEGER AS y1 FROM spans x JOIN spans y ON x.room = y.room AND x.axis = 'x' AND y.axis = 'y')"""


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    rooms = read(spark, sf_dir, "nation").select(n.alias("room"), (8 * (n % 4)).alias("left"), (8 * (40 + 11 * n)).alias("right"), F.lit(0).alias("top"), (8 * (20 + 5 * n)).alias("bottom"))
    return windows.window_grid(rooms)


@query(GRID_SQL + ', n AS (SELECT *, lag(x1) OVER (PARTITION BY room, y0 ORDER BY x0) AS left_x1, lag(y1) OVER (PARTITION BY room, x0 ORDER BY y0) AS up_y1 FROM grid) SELECT *, CAST(CASE WHEN left_x1 IS NULL THEN x0 ELSE x0 + (left_x1 - x0) // 2 END AS INTEGER) AS stitch_x, CAST(CASE WHEN up_y1 IS NULL THEN y0 ELSE y0 + (up_y1 - y0) // 2 END AS INTEGER) AS stitch_y FROM n')
def q50_neighbours(spark, sf_dir):
    return windows.with_neighbours(_grid(spark, sf_dir))


@query(GRID_SQL + " SELECT * FROM grid")
def q51_window_grid(spark, sf_dir):
    return _grid(spark, sf_dir)


def _context_sql(at: str, length: str, whole: str) -> str:
    limit = f"(ceil({whole} / 8) * 8)"
    a = f"greatest(0, floor(({at} - 32) / 8) * 8)"
    b = f"least({limit}, ceil(({at} + {length} + 32) / 8) * 8)"
    a2 = f"CASE WHEN {b} - {a} >= 128 THEN {a} ELSE greatest(0, {a} - 8 * ceil((128 - ({b} - {a})) / 2 / 8)) END"
    b2 = f"CASE WHEN {b} - {a} >= 128 THEN {b} ELSE least({limit}, greatest({b}, {a2} + 128)) END"
    a3 = f"CASE WHEN {b} - {a} >= 128 THEN {a} ELSE greatest(0, least({a2}, {b2} - 128)) END"
    return f"CAST({a3} AS INTEGER) AS {at}0, CAST({b2} AS INTEGER) AS {at}1"


@query(f"WITH r AS ({ROOM_SQL}), o AS ({OBJECT_SQL}) SELECT key, {_context_sql('x', 'w', 'room_w')}, {_context_sql('y', 'h', 'room_h')} FROM o JOIN r ON o.room = r.room WHERE x >= 0 AND y >= 0 AND x + w <= room_w AND y + h <= room_h")
def q52_context_box(spark, sf_dir):
    ok = catalog.placement(_objects(spark, sf_dir), _rooms(spark, sf_dir)).where("place = 'ok'").select("key")
    o = _objects(spark, sf_dir).join(ok, "key").join(_rooms(spark, sf_dir), "room")
    spans = o.select("key", windows.context_span(F.col("x"), F.col("w"), F.col("room_w")).alias("xs"), windows.context_span(F.col("y"), F.col("h"), F.col("room_h")).alias("ys"))
    return spans.select("key", F.col("xs.a").alias("x0"), F.col("xs.b").alias("x1"), F.col("ys.a").alias("y0"), F.col("ys.b").alias("y1"))


@query(f"WITH p AS ({E8_SQL}), o AS (SELECT img, CASE WHEN img % 2 = 0 THEN img + 1 ELSE img - 1 END AS room, img % 3 AS ox, img % 4 AS oy, y, x, CASE WHEN img % 7 < 3 THEN r ELSE v END AS v FROM (SELECT p.*, q.v AS r FROM p LEFT JOIN p q ON q.img = CASE WHEN p.img % 2 = 0 THEN p.img + 1 ELSE p.img - 1 END AND q.x = p.x + p.img % 3 AND q.y = p.y + p.img % 4) WHERE x < 4 AND y < 4) SELECT o.img, bool_or(o.v IS DISTINCT FROM p.v) AS differs FROM o LEFT JOIN p ON p.img = o.room AND p.x = o.x + ox AND p.y = o.y + oy GROUP BY 1")
def q53_classify_diff(spark, sf_dir):
    px = _e8(spark, sf_dir)
    img = F.col("img")
    o = px.where("x < 4 AND y < 4").withColumns({"room": F.when(img % 2 == 0, img + 1).otherwise(img - 1), "ox": (img % 3).cast("int"), "oy": (img % 4).cast("int")})
    rooms = px.select(img.alias("room"), "y", "x", "v")
    beneath = rooms.select("room", F.col("y").alias("ry"), F.col("x").alias("rx"), F.col("v").alias("r"))
    copied = o.withColumns({"ry": F.col("y") + F.col("oy"), "rx": F.col("x") + F.col("ox")}).join(beneath, ["room", "ry", "rx"], "left").drop("ry", "rx")
    return pixels.differs(copied.withColumn("v", F.when(img % 7 < 3, F.col("r")).otherwise(F.col("v"))).drop("r"), rooms, ["img"])


STITCH_SQL = "SELECT img // 4 AS img, CAST(img % 4 AS INTEGER) AS win, CAST(img % 4 // 2 * 5 + y AS INTEGER) AS y, CAST(img % 2 * 5 + x AS INTEGER) AS x, v, CAST(img % 4 // 2 * 6 AS INTEGER) AS from_y, CAST(img % 2 * 6 AS INTEGER) AS from_x FROM p"


@query(f"WITH p AS ({E8_SQL}), w AS ({STITCH_SQL}) SELECT img, y, x, arg_max(v, win) AS v FROM w WHERE y >= from_y AND x >= from_x GROUP BY 1, 2, 3")
def q54_stitch_last_wins(spark, sf_dir):
    img = F.col("img")
    row, col = F.floor(img % 4 / 2).cast("int"), (img % 2).cast("int")
    renders = _e8(spark, sf_dir).select(F.floor(img / 4).alias("img"), (img % 4).cast("int").alias("window"), (row * 5 + F.col("y")).alias("y"), (col * 5 + F.col("x")).alias("x"), "v", (row * 6).alias("from_y"), (col * 6).alias("from_x"))
    return pixels.stitched(renders)


@query(f"WITH p AS ({E8_SQL}), q AS ({PADDED}) SELECT c.img, c.y, c.x, c.v, sum(q.v) FILTER (abs(q.v - c.v) <= 64)::INTEGER AS total, count(*) FILTER (abs(q.v - c.v) <= 64)::INTEGER AS n FROM p c JOIN q ON q.img = c.img AND q.y BETWEEN c.y - 1 AND c.y + 1 AND q.x BETWEEN c.x - 1 AND c.x + 1 GROUP BY 1, 2, 3, 4")
def q55_smoothed(spark, sf_dir):
    return pixels.smoothed(_e8(spark, sf_dir), 64)


@query("SELECT o_orderkey AS img, CASE WHEN o_custkey % 5 = 0 THEN 4294967295 ELSE o_orderkey % 256 * 65536 + o_custkey % 256 * 256 + 7 END AS key, CAST((299 * (o_orderkey % 256) + 587 * (o_custkey % 256) + 114 * 7) // 1000 AS INTEGER) AS luma FROM orders")
def q56_colour_keys(spark, sf_dir):
    r, g, b = F.col("o_orderkey") % 256, F.col("o_custkey") % 256, F.lit(7)
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("img"), pixels.colour_key(r, g, b, F.col("o_custkey") % 5).alias("key"), pixels.luminance(r, g, b).alias("luma"))


@query("SELECT o_orderkey AS key, CAST(n AS INTEGER) AS n, 41 + CAST(n AS INTEGER) AS seed, CAST(count(*) FILTER (o_orderstatus <> 'P') OVER (PARTITION BY o_custkey ORDER BY n) AS BIGINT) AS judged FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)")
def q72_seed_schedule(spark, sf_dir):
    a = attempts.numbered(read(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey")
    judged = F.count_if(F.col("o_orderstatus") != "P").over(Window.partitionBy("o_custkey").orderBy("n"))
    return a.select(F.col("o_orderkey").alias("key"), "n", attempts.seed(F.col("n")).alias("seed"), judged.alias("judged"))


# ---- containers and codecs ---------------------------------------------------------------------


@query("SELECT l_orderkey AS file, 'LI0' || l_linenumber AS tag, CAST(8 + length(CAST(l_partkey AS VARCHAR)) AS BIGINT) AS size, CAST(l_partkey AS VARCHAR) AS payload FROM lineitem")
def q60_chunk_roundtrip(spark, sf_dir):
    from strataframe.sources.container import register_chunks

    register_chunks(spark)
    payload = F.col("l_partkey").cast("string").cast("binary")
    size = F.unhex(F.lpad(F.hex(F.length(payload) + 8), 8, "0"))
    chunk = F.concat(F.concat(F.lit("LI0"), F.col("l_linenumber")).cast("binary"), size, payload)
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file"), F.hex(chunk).alias("chunk"))
    files = lines.groupBy("file").agg(F.unhex(F.array_join(F.array_sort(F.collect_list("chunk")), "")).alias("content"))
    return spark.sql("SELECT file, c.tag, c.size, CAST(substring(content, c.off + 9, c.size - 8) AS STRING) AS payload FROM {files}, LATERAL chunks(content, true, false) c", files=files)


def _names(spark, sf_dir, there_and_back):
    def run(frames):
        for f in frames:
            yield f.assign(p_name=[there_and_back(n.encode()).decode() for n in f["p_name"]])

    return read(spark, sf_dir, "part").select("p_partkey", "p_name").mapInPandas(run, "p_partkey long, p_name string")


@query("SELECT p_partkey, p_name FROM part")
def q61_rle_roundtrip(spark, sf_dir):
    from strataframe.sources import codecs, encoders

    return _names(spark, sf_dir, lambda b: codecs.run_length_rows(encoders.run_length_rows(b, len(b)), 0, len(b), 1).tobytes())


@query("SELECT p_partkey, p_name FROM part")
def q62_span_roundtrip(spark, sf_dir):
    from strataframe.sources import codecs, encoders

    return _names(spark, sf_dir, lambda b: codecs.span_rows(encoders.span_rows(b, len(b), b[0]), len(b), 1, b[0]).tobytes())


def _pixel_rows(spark, sf_dir, back):
    """E8 pixels after back(img, 64 bytes) -> 64 bytes or an error text."""

    def run(frames):
        import pandas as pd

        for f in frames:
            rows = []
            for img, values in zip(f["img"], f["v"], strict=True):
                try:
                    rows += [(img, i // 8, i % 8, v, None) for i, v in enumerate(back(img, bytes(values.tolist())))]
                except ValueError as e:
                    rows.append((img, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["img", "y", "x", "v", "error"]).astype({"y": "Int32", "x": "Int32", "v": "Int32"})

    v = F.transform("embedding", lambda e: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(e.cast("double") * 128 + 128))).cast("int"))
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img"), v.alias("v")).mapInPandas(run, "img long, y int, x int, v int, error string")


CLAMPED_SQL = f"SELECT img, y, x, least(255, greatest(0, v)) AS v FROM ({E8_SQL})"


def _strip_block(code: int, raster: bytes) -> bytes:
    import numpy as np

    from strataframe.sources import codecs, encoders

    codec = codecs.STRIP_CODECS[code]
    flat = np.frombuffer(raster, np.uint8).reshape(8, 8).T.tobytes() if codec.by_column else raster
    return encoders.block([bytes([code]) + {codecs.stepped: encoders.stepped, codecs.spread: encoders.spread}.get(codec.pixels, bytes)(flat)])


@query(f"SELECT img, y, x, CASE WHEN img % 8 IN (3, 4, 6, 7) AND v = 128 THEN 0 ELSE v END AS v FROM ({CLAMPED_SQL})")
def q63_bitpack_roundtrip(spark, sf_dir):
    from strataframe.sources import codecs

    codes = (1, 18, 28, 38, 48, 68, 88, 128)
    return _pixel_rows(spark, sf_dir, lambda img, b: codecs.strips(_strip_block(codes[img % 8], b), 8, 8, 128)[0].tobytes()).drop("error")


@query(f"SELECT img, y, x, CAST(v // 16 AS INTEGER) AS v FROM ({CLAMPED_SQL})")
def q64_column_rle_roundtrip(spark, sf_dir):
    from strataframe.sources import codecs, encoders

    def back(img, b):
        low = bytes(p // 16 for p in b)
        return codecs.column_runs(encoders.nibbles(b"".join(low[x::8] for x in range(8)), 16), 0, 8, 8, 16).tobytes()

    return _pixel_rows(spark, sf_dir, back).drop("error")


@query("SELECT vec_id AS img, CASE WHEN vec_id % 7 = 0 THEN 'unsupported SMAP codec' WHEN vec_id % 7 = 1 THEN 'SMAP strip offset out of range' END AS error, CASE WHEN vec_id % 7 > 1 THEN 64 ELSE 0 END::BIGINT AS pixels FROM embeddings")
def q65_dead_letter(spark, sf_dir):
    from strataframe.sources import codecs

    def back(img, b):
        block = bytearray(_strip_block(28, b))
        if img % 7 == 0:
            block[12] = 134
        if img % 7 == 1:
            block[8:12] = b"\xff\xff\x00\x00"
        return codecs.strips(bytes(block), 8, 8, 255)[0].tobytes()

    return _pixel_rows(spark, sf_dir, back).groupBy("img").agg(F.max("error").alias("error"), F.count("v").alias("pixels"))


@query(f"WITH p AS ({CLAMPED_SQL}) SELECT img, count(*) FILTER (v = first) AS transparent, TRUE AS same_colours FROM (SELECT *, first_value(v) OVER (PARTITION BY img ORDER BY y, x) AS first FROM p) GROUP BY 1")
def q66_transparent_swap(spark, sf_dir):
    from strataframe.sources import codecs

    palette = bytes((i * 7 + c * 85) % 256 for i in range(256) for c in range(3))

    def back(img, b):
        index, colours = codecs.without_transparent_colour(b, palette, b[0])
        same = all(palette[3 * o : 3 * o + 3] == colours[3 * n : 3 * n + 3] for o, n in zip(b, index, strict=True) if o != b[0])
        return bytes(n + 0 if same else 255 for n in index)

    px = _pixel_rows(spark, sf_dir, back)
    return px.groupBy("img").agg(F.count_if(F.col("v") == 0).alias("transparent"), (F.min("v") == 0).alias("same_colours"))


@query("""WITH c(code, name) AS (SELECT 1, 'raw' UNION ALL SELECT f + i, n FROM (VALUES (14, 'stepped by column'), (24, 'stepped'), (34, 'stepped by column, holes'), (44, 'stepped, holes')) t(f, n), range(5) r(i))
SELECT p_size AS code, p_size || ' ' || coalesce(name, '?') AS label, count(*) AS n FROM part LEFT JOIN c ON c.code = p_size GROUP BY 1, 2""")
def q67_codec_histogram(spark, sf_dir):
    from strataframe.sources.codecs import STRIP_CODECS

    names = spark.createDataFrame([(code, c.name) for code, c in STRIP_CODECS.items()], "code int, name string")
    return manifest.histogram(read(spark, sf_dir, "part"), "p_size", names)


@query('SELECT event_id, user_id AS source, CAST(least(255, greatest(0, (100 * 128 + sum(CAST(floor(value) AS BIGINT) * 7 - 400) OVER (PARTITION BY user_id ORDER BY ts, event_id))::BIGINT >> 7)) AS BIGINT) AS level FROM events')
def q70_palette_delta_state(spark, sf_dir):
    from strataframe.streaming.frames import palette_levels

    e = read(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").alias("source"), (F.floor("value") * 7 - 400).alias("delta"))
    return palette_levels(e, "source", ["ts", "event_id"], F.lit(100)).select("event_id", "source", "level")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS shown FROM events")
def q71_frame_carry(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return read(spark, sf_dir, "events").select("event_id", F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(w).alias("shown"))


from strataframe import image_queries  # noqa: E402, F401  (its queries register here)
