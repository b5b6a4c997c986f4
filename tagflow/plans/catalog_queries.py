"""Queries on catalogues, rules, quotas and assets. Paths are made of line items, assets of documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.functions import names as N
from tagflow.operators import catalog as C
from tagflow.operators import filters as L
from tagflow.operators import joins as J
from tagflow.plans.registry import query, table
from tagflow.sources.catalog import catalog_from_paths, filter_category, filter_extensions


def raw_paths(spark, d, suffix: str = "jpg") -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.concat(F.lit("/c/"), "l_returnflag", F.lit("/"), "l_linestatus", F.col("l_linenumber").cast("string"), F.lit("/P"), F.col("l_partkey").cast("string"), F.lit(f".{suffix}")).alias("path")).distinct()


def images(spark, d) -> DataFrame:
    return catalog_from_paths(raw_paths(spark, d), root="/c")


PATHS = """WITH c AS (SELECT DISTINCT '/c/' || l_returnflag || '/' || l_linestatus || l_linenumber || '/P' || l_partkey || '.jpg' AS path,
 'P' || l_partkey AS name, l_returnflag AS category, l_linestatus || l_linenumber AS subcategory FROM lineitem)
"""
DUPS = PATHS + """, d AS (SELECT category, name, count(*) AS occurrences, count(DISTINCT subcategory) AS distinct_subcats,
 string_agg(subcategory || '=' || path, ' ' ORDER BY path) AS occ FROM c GROUP BY ALL HAVING count(*) > 1)
"""


@query(PATHS + "SELECT path, substr(path, 4) AS rel_path, name, 'jpg' AS ext, category, subcategory FROM c")
def catalog_paths(spark, d):
    return images(spark, d).select("path", "rel_path", "name", "ext", "category", "subcategory")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'JPG' ELSE 'webp' END AS ext FROM part WHERE p_partkey % 3 < 2""")
def extensions(spark, d):
    kind = F.when(F.col("p_partkey") % 3 == 0, "JPG").when(F.col("p_partkey") % 3 == 1, "webp").otherwise("txt")
    return filter_extensions(table(spark, d, "part").select("p_partkey", kind.alias("ext")))


@query(PATHS + "SELECT name, path FROM c WHERE category = 'R'")
def category_images(spark, d):
    return filter_category(images(spark, d), "R").select("name", "path")


@query("""SELECT p_partkey, regexp_replace(p_name, '[ ]', '.', 'g') || '.JPG' AS file, regexp_replace(p_name, '[ ]', '.', 'g') AS stem, 'jpg' AS ext FROM part""")
def stem_and_ext(spark, d):
    file = F.concat(F.regexp_replace("p_name", " ", "."), F.lit(".JPG"))
    return table(spark, d, "part").select("p_partkey", file.alias("file"), N.stem(F.concat(F.lit("a/b/"), file)).alias("stem"), N.ext(file).alias("ext"))


def _occ(df):
    return df.withColumn("occ", F.array_join(F.transform("occ", lambda x: F.concat(x["subcat"], F.lit("="), x["path"])), " "))


@query(DUPS + "SELECT * FROM d")
def duplicate_stems(spark, d):
    return _occ(C.duplicate_stems(images(spark, d))).drop("chunk")  # 0: no stem here has a thousand images


@query(DUPS + "SELECT category, count(*) AS duplicate_stems, CAST(sum(occurrences) AS BIGINT) AS copies FROM d GROUP BY ALL")
def duplicate_summary(spark, d):
    return C.duplicate_summary(C.duplicate_counts(images(spark, d)))


@query(PATHS + """, r AS (SELECT category, name, subcategory, path, row_number() OVER (PARTITION BY category, name ORDER BY path) - 1 AS i, count(*) OVER (PARTITION BY category, name) AS n FROM c)
SELECT category, name, i // 2 AS chunk, string_agg(path, ' ' ORDER BY path) AS paths FROM r WHERE n > 1 GROUP BY ALL""")
def duplicate_chunks(spark, d):
    """Lists in chunks of two: stems with more images have several rows."""
    dups = C.duplicate_stems(images(spark, d), chunk=2)
    return dups.select("category", "name", "chunk", F.array_join(F.transform("occ", lambda x: x["path"]), " ").alias("paths"))


@query(PATHS + """, r AS (SELECT *, row_number() OVER (PARTITION BY category, name ORDER BY path) AS i, count(*) OVER (PARTITION BY category, name) AS n FROM c)
SELECT name AS stem, category, max(n) AS occurrences, max(CASE WHEN i = 1 THEN subcategory END) AS subcat_1, max(CASE WHEN i = 2 THEN subcategory END) AS subcat_2,
 max(CASE WHEN i = 1 THEN path END) AS path_1, max(CASE WHEN i = 2 THEN path END) AS path_2 FROM r WHERE n > 1 GROUP BY name, category""")
def duplicates_wide(spark, d):
    return C.widen_duplicates(C.duplicate_stems(images(spark, d)), 2)


@query(PATHS + """, q AS (SELECT c.category, name AS stem, subcategory AS subcat, '/q/' || name || '__' || subcategory || '.jpg' AS quarantine_path, path AS original_path, '' AS action
 FROM c JOIN (SELECT category, name FROM c GROUP BY ALL HAVING count(*) > 1) USING (category, name))
SELECT *, count(*) OVER (PARTITION BY quarantine_path) > 1 AS clash FROM q""")
def quarantine_plan(spark, d):
    return C.quarantine_plan(C.duplicate_rows(images(spark, d)), "/q")


@query(PATHS + "SELECT name, min(path) AS path, count(*) AS n_paths, 'unknown' AS \"Class\" FROM c GROUP BY name")
def first_by_stem(spark, d):
    return C.first_by_stem(images(spark, d))


CLASS = "CASE category WHEN 'R' THEN 'returned' ELSE category END"


@query(PATHS + f"SELECT {CLASS} AS \"Class\", name, min(path) AS path FROM c GROUP BY ALL")
def manifest_from_folders(spark, d):
    return C.manifest_from_folders(images(spark, d), {"R": "returned"})


@query(PATHS + f", m AS (SELECT {CLASS} AS k, name, path, min(path) OVER (PARTITION BY {CLASS}, name) AS kept FROM c) SELECT name, k AS \"Class\", kept AS kept_path, path AS skipped_path FROM m WHERE path <> kept")
def manifest_duplicates(spark, d):
    return C.manifest_duplicates(images(spark, d), {"R": "returned"})


@query(PATHS + """SELECT category AS label, subcategory AS folder, name || '.jpg' AS file,
 category || '_' || lpad(CAST(row_number() OVER (PARTITION BY category ORDER BY subcategory, name || '.jpg') AS VARCHAR), 7, '0') AS new_name FROM c""")
def number_per_label(spark, d):
    df = images(spark, d).select(F.col("category").alias("label"), F.col("subcategory").alias("folder"), F.concat("name", F.lit(".jpg")).alias("file"))
    return C.number_per_label(df, 7).select("label", "folder", "file", "new_name")


@query(PATHS + """, l AS (SELECT 'P' || p_partkey AS name, p_brand AS label FROM part)
SELECT l.name, label, min(path) AS path FROM l LEFT JOIN c ON l.name = c.name GROUP BY l.name, label""")
def resolve_images(spark, d):
    labels = table(spark, d, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_brand").alias("label"))
    return J.resolve_images(labels, images(spark, d))


RULES = [L.Rule("warm", ("red",), ("ring",)), L.Rule("tool", ("gear",)), L.Rule("tool", ("bolt",)), L.Rule("red", ("red",)), L.Rule("cold", ("blue",))]
RULE_SQL = """SELECT p_partkey, p_name, CASE WHEN n LIKE '%nut%' OR n = 'green_gear' THEN NULL WHEN n LIKE '%red%' AND n NOT LIKE '%ring%' THEN 'warm' WHEN n LIKE '%gear%' OR n LIKE '%bolt%' THEN 'tool'
 WHEN n LIKE '%red%' THEN 'red' WHEN n LIKE '%blue%' THEN 'cold' END AS label FROM (SELECT *, translate(lower(p_name), '- ', '__') AS n FROM part)"""


def _ruled(spark, d):
    return L.classify_by_rules(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", ["nut"], ["Green-Gear"], RULES)


@query(RULE_SQL)
def classify_by_rules(spark, d):
    return _ruled(spark, d)


@query(f"WITH r AS ({RULE_SQL}) SELECT * FROM r WHERE label IN (SELECT label FROM r GROUP BY label HAVING count(*) >= 200)")
def min_class_size(spark, d):
    return C.min_class_size(_ruled(spark, d), 200)


@query("""WITH a AS (SELECT * FROM events WHERE event_type <> 'view'), f AS (SELECT user_id, arg_min(event_type, event_id) AS event_type, min(event_id) AS event_id FROM a GROUP BY user_id)
SELECT * FROM (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rank FROM f) WHERE rank <= 5""")
def quota_per_group(spark, d):
    events = table(spark, d, "events").where("event_type <> 'view'").select("user_id", "event_type", "event_id")
    return C.quota_per_group(events, "event_type", "user_id", 5, "event_id").select("user_id", "event_type", "event_id", F.col("rank").cast("long").alias("rank"))


@query("SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def exclude_drawings(spark, d):
    photo = table(spark, d, "customer").select(F.col("c_custkey").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "drawing").otherwise("photo").alias("prediction"))
    return J.exclude_drawings(table(spark, d, "events").select("event_id", "user_id"), photo, "user_id")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'sketch' WHEN c_custkey % 3 = 1 THEN 'photo' END AS folder, replace(c_name, '#', '-plus') AS file FROM customer""")
def route_photo(spark, d):
    kind = F.when(F.col("c_custkey") % 3 == 0, "drawing").when(F.col("c_custkey") % 3 == 1, "photo").otherwise("other")
    return table(spark, d, "customer").select("c_custkey", N.route_photo(kind).alias("folder"), N.routed_name(F.replace("c_name", F.lit("#"), F.lit("+"))).alias("file"))


@query("SELECT c_custkey, replace(c_name, '#', 'plus') AS file FROM customer")
def safe_name(spark, d):
    return table(spark, d, "customer").select("c_custkey", N.safe_name(F.replace("c_name", F.lit("#"), F.lit("+"))).alias("file"))


def assets(spark, d):
    docs = table(spark, d, "documents")
    return docs.select(F.coalesce("source", F.lit("none")).alias("category"), F.col("doc_id").alias("pos"), F.md5("text").alias("md5"), (F.col("n_chars") % 1000 + 200).alias("width"), ((F.col("doc_id") % 7 + 1) * 150).alias("height"))


ASSETS = """WITH a AS (SELECT coalesce(source, 'none') AS category, doc_id AS pos, md5(text) AS md5, n_chars % 1000 + 200 AS width, (doc_id % 7 + 1) * 150 AS height FROM documents),
q AS (SELECT *, CASE WHEN width < 300 OR height < 300 THEN 'too_small(' || width || 'x' || height || ')' WHEN width / height > 2.5 OR width / height < 0.25 THEN 'bad_aspect' ELSE '' END AS reason FROM a),
u AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY category, md5 ORDER BY pos) = 1)
"""


@query(ASSETS + "SELECT category, pos, width, height, reason, reason = '' AS ok FROM q")
def quality_gate(spark, d):
    return L.quality_gate(assets(spark, d)).drop("md5")


@query(ASSETS + "SELECT category, md5, pos, width, height FROM u")
def dedup_by_content(spark, d):
    return C.dedup_by_content(assets(spark, d))


@query(ASSETS + """, n AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY pos) AS number FROM u WHERE reason = '')
SELECT category, md5, pos, width, height, number, category || '_ff_' || lpad(CAST(number AS VARCHAR), 4, '0') AS name FROM n WHERE number <= 20""")
def curate_assets(spark, d):
    return C.curate_assets(assets(spark, d), 20).withColumn("number", F.col("number").cast("long"))


@query("SELECT md5(text) AS md5, count(*) AS n FROM documents GROUP BY ALL")
def content_hash(spark, d):
    return table(spark, d, "documents").groupBy(N.content_hash(F.col("text")).alias("md5")).agg(F.count("*").alias("n"))


SIZED = "regexp_replace(url, '[?#].*$', '') || '_' || (page_id % 5) || '00.jpg?w=' || page_id"


def _sized():
    return F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("_"), (F.col("page_id") % 5).cast("string"), F.lit("00.jpg?w="), F.col("page_id").cast("string"))


@query(f"SELECT page_id, regexp_replace(regexp_replace({SIZED}, '\\?.*$', ''), '_\\d+\\.jpg$', '') AS base FROM pages")
def base_url(spark, d):
    return table(spark, d, "pages").select("page_id", N.base_url(_sized()).alias("base"))


@query(f"SELECT page_id, regexp_replace(regexp_replace({SIZED}, '_\\d+\\.jpg$', '_1000.jpg'), '\\?.*$', '') AS normal, regexp_replace({SIZED}, '\\?.*$', '') || '?imwidth=762' AS sized FROM pages")
def normalise_url(spark, d):
    return table(spark, d, "pages").select("page_id", N.normalise_url(_sized()).alias("normal"), N.sized_url(_sized(), 762).alias("sized"))


@query("""WITH p AS (SELECT page_id AS pos, split_part(split_part(url, '://', 2), '/', 1) AS category, regexp_replace(url, '\\?.*$', '') AS base_url FROM pages)
SELECT category, base_url, min(pos) AS pos FROM p GROUP BY ALL""")
def dedup_by_base_url(spark, d):
    host = F.get(F.split(F.get(F.split("url", "://"), F.lit(1)), "/"), F.lit(0))
    return C.dedup_by_base_url(table(spark, d, "pages").select(host.alias("category"), N.base_url(F.col("url")).alias("base_url"), F.col("page_id").alias("pos")))


@query("""WITH u AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="[^"]*"')) AS link, generate_subscripts(regexp_extract_all(html, 'href="[^"]*"'), 1) - 1 AS pos FROM pages)
SELECT page_id, regexp_replace(link, '\\?.*$', '') AS base_url, CAST(min(pos) AS BIGINT) AS pos FROM u GROUP BY ALL""")
def extract_urls(spark, d):
    links = table(spark, d, "pages").select("page_id", F.posexplode(N.extract_urls(F.col("html"), 'href="[^"]*"')).alias("pos", "link"))
    return C.dedup_by(links.select("page_id", N.strip_query(F.col("link")).alias("base_url"), F.col("pos").cast("long").alias("pos")), ["page_id", "base_url"], "pos")


@query("SELECT p_partkey, p_type || '_zal_' || lpad(CAST(p_size AS VARCHAR), 4, '0') AS name FROM part")
def asset_name(spark, d):
    return table(spark, d, "part").select("p_partkey", N.asset_name(F.col("p_type"), F.col("p_size"), "zal").alias("name"))


@query("""WITH s AS (SELECT doc_id, n_chars AS w, doc_id % 3000 + 1 AS h FROM documents), t AS (SELECT *, 1568.0::DOUBLE / greatest(w, h) AS k FROM s)
SELECT doc_id, CASE WHEN greatest(w, h) > 1568 THEN CAST(floor(w * k) AS INTEGER) ELSE CAST(w AS INTEGER) END AS width, CASE WHEN greatest(w, h) > 1568 THEN CAST(floor(h * k) AS INTEGER) ELSE CAST(h AS INTEGER) END AS height FROM t""")
def resize_dims(spark, d):
    size = N.resize_dims(F.col("n_chars"), F.col("doc_id") % 3000 + 1, 1568)
    return table(spark, d, "documents").select("doc_id", size.alias("s")).select("doc_id", "s.width", "s.height")
