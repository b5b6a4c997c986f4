"""Queries on labels, tags, answers, annotations, joins of tables, scores of vectors, and the intake stream."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from tagflow.functions import annotations as A
from tagflow.functions import names as N
from tagflow.functions import prompts as P
from tagflow.functions import responses as R
from tagflow.operators import evaluation as E
from tagflow.operators import filters as L
from tagflow.operators import joins as J
from tagflow.operators import pixels as X
from tagflow.operators import scoring as S
from tagflow.operators import summaries as M
from tagflow.operators import tagging as T
from tagflow.plans.registry import query, table
from tagflow.sources import tables as B

# ---- joins of documents and labels


def docs(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("name"), "source", "lang", "n_chars")


def labels(spark, d):
    return table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("name"), "quality", "toxic")


@query("SELECT CAST(doc_id AS VARCHAR) AS name, lang, quality FROM documents JOIN labels USING (doc_id)")
def join_gt_pred(spark, d):
    return J.join_gt_pred(labels(spark, d), docs(spark, d)).select("name", "lang", "quality")


@query("SELECT (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS matched, (SELECT count(*) FROM labels) AS gt_rows, (SELECT count(*) FROM documents) AS pred_rows")
def match_counts(spark, d):
    return J.match_counts(labels(spark, d), docs(spark, d))


@query("SELECT CAST(doc_id AS VARCHAR) AS name, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def pending(spark, d):
    return J.pending(docs(spark, d).select("name", "lang"), labels(spark, d), True, F.col("quality") == 0)


@query("SELECT CAST(doc_id AS VARCHAR) AS name, quality FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def restrict_to_present(spark, d):
    return J.restrict_to_present(labels(spark, d).select("name", "quality"), docs(spark, d).where("lang = 'en'"))


@query("""WITH c AS (SELECT doc_id FROM documents WHERE lang = 'en'), o AS (SELECT doc_id FROM documents WHERE doc_id % 4 = 0), x AS (SELECT l.doc_id, c.doc_id IS NOT NULL AS have, o.doc_id IS NOT NULL AS done FROM labels l LEFT JOIN c USING (doc_id) LEFT JOIN o USING (doc_id))
SELECT count(*) AS n_labels, count(*) FILTER (done) AS already_done, count(*) FILTER (have AND NOT done) AS to_process, count(*) FILTER (NOT have AND NOT done) AS missing, (SELECT count(*) FROM c) AS images FROM x""")
def coverage(spark, d):
    return J.coverage(labels(spark, d), docs(spark, d).where("lang = 'en'"), table(spark, d, "documents").where("doc_id % 4 = 0").select(F.col("doc_id").cast("string").alias("name")))


@query("SELECT CAST(doc_id AS VARCHAR) AS name, toxic, toxic IS NOT NULL AS grounded FROM documents LEFT JOIN labels USING (doc_id)")
def attach_tags(spark, d):
    return J.attach_tags(docs(spark, d).select("name"), labels(spark, d).select("name", "toxic", F.lit(0).alias("pos")))


@query("SELECT CAST(doc_id AS VARCHAR) AS name, quality, coalesce(source, '') AS description, lang = 'en' AS grounded FROM labels LEFT JOIN documents USING (doc_id)")
def attach_descriptions(spark, d):
    described = docs(spark, d).select("name", F.col("source").alias("description"), (F.col("lang") == "en").alias("grounded"), F.lit(0).alias("pos"))
    return J.attach_descriptions(labels(spark, d).select("name", "quality"), described)


CASCADE = """WITH x AS (SELECT CAST(doc_id AS VARCHAR) AS name, coalesce(CASE WHEN l.doc_id IS NOT NULL THEN CASE quality WHEN 1 THEN 'good' ELSE 'bad' END END, 'unknown') AS category, coalesce(CASE WHEN l.doc_id IS NOT NULL THEN round((doc_id % 100) / 100.0::DOUBLE, 4) END, 0.0::DOUBLE) AS category_conf,
 coalesce(CASE WHEN lang = 'en' THEN source END, 'unknown') AS subcategory, coalesce(CASE WHEN lang = 'en' THEN round((n_chars % 100) / 100.0::DOUBLE, 4) END, 0.0::DOUBLE) AS subcategory_conf FROM documents LEFT JOIN labels l USING (doc_id))
"""


def cascade(spark, d):
    one = labels(spark, d).select("name", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("prediction"), F.round(F.col("name").cast("long") % 100 / F.lit(100.0), 4).alias("confidence"))
    two = docs(spark, d).where("lang = 'en'").select("name", F.col("source").alias("prediction"), F.round(F.col("n_chars") % 100 / F.lit(100.0), 4).alias("confidence"))
    return J.assemble_cascade(docs(spark, d), one, two)


@query(CASCADE + "SELECT * FROM x")
def assemble_cascade(spark, d):
    return cascade(spark, d)


@query(CASCADE + "SELECT * FROM x WHERE category = 'good' AND category_conf >= 0.2 AND category_conf <= 0.9 ORDER BY name LIMIT 100")
def filter_cascade(spark, d):
    return L.filter_cascade(cascade(spark, d), "good", None, 0.2, 0.9, 100)


@query(CASCADE + "SELECT category, count(*) AS n, avg(category_conf) AS mean_category_conf, avg(subcategory_conf) AS mean_subcategory_conf, count(*) FILTER (category_conf < 0.7) AS n_low FROM x GROUP BY ROLLUP (category)")
def cascade_summary(spark, d):
    return M.cascade_summary(cascade(spark, d))


@query("SELECT CAST(doc_id AS VARCHAR) AS name, coalesce(replace(replace(lower(o_orderpriority), ' ', '-'), '_', '|'), '') AS label FROM documents LEFT JOIN orders ON o_orderkey = doc_id")
def label_catalog(spark, d):
    raw = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("name"), F.col("o_orderpriority").alias("label"))
    return J.label_catalog(docs(spark, d), raw)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS name FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM documents)")
def labels_not_found(spark, d):
    return J.labels_not_found(docs(spark, d), table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("name")))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS name, p_partkey AS pos FROM part WHERE (p_name LIKE 'red %' OR p_name LIKE '% bolt') AND p_partkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
 AND p_partkey NOT IN (SELECT doc_id FROM labels) ORDER BY p_partkey LIMIT 40""")
def select_candidates(spark, d):
    raw = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("name"), F.col("p_partkey").alias("pos"), F.split("p_name", " ").alias("labels"))
    pool = table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").cast("string").alias("name"))
    return J.select_candidates(raw, pool, labels(spark, d), ["red", "bolt"], 40).drop("labels")


@query("SELECT CAST(doc_id AS VARCHAR) AS name, lang, NULL::INTEGER AS quality FROM documents UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, quality FROM labels")
def append_results(spark, d):
    return T.append_results(docs(spark, d).select("name", "lang"), labels(spark, d).select("name", "quality"))


@query("SELECT CAST(doc_id AS VARCHAR) AS name, coalesce(CASE WHEN quality = 1 THEN 'good' END, '') AS label FROM documents LEFT JOIN labels USING (doc_id)")
def filter_valid_multi(spark, d):
    joined = docs(spark, d).join(labels(spark, d), "name", "left").select("name", F.when(F.col("quality") == 1, "good").alias("label"))
    return L.filter_valid_multi(joined, "label")


@query("""SELECT count(*) FILTER (t AND g) AS n_grounded, count(*) FILTER (t AND NOT g) AS n_ungrounded, count(*) FILTER (NOT t) AS n_failed FROM (SELECT coalesce(source, '') <> '' AND doc_id % 9 > 0 AS t, coalesce(lang = 'en', false) AS g FROM documents)""")
def description_summary(spark, d):
    x = table(spark, d, "documents").select(F.when(F.col("doc_id") % 9 > 0, F.col("source")).otherwise("").alias("description"), (F.col("lang") == "en").alias("grounded"))
    return M.description_summary(x)


# ---- labels as text

RAW = "CASE WHEN p_partkey % 9 = 0 THEN 'no-spec' ELSE upper(p_name) || '_' || p_brand END"
CLEAN = f"CASE WHEN lower({RAW}) = 'no-spec' THEN '' ELSE replace(replace(lower({RAW}), ' ', '-'), '_', '|') END"


def raw_labels(spark, d):
    raw = F.when(F.col("p_partkey") % 9 == 0, "no-spec").otherwise(F.concat(F.upper("p_name"), F.lit("_"), "p_brand"))
    return table(spark, d, "part").select("p_partkey", raw.alias("raw"))


@query(f"SELECT p_partkey, {CLEAN} AS label FROM part")
def clean_raw_labels(spark, d):
    return raw_labels(spark, d).select("p_partkey", N.clean_raw_labels(F.col("raw")).alias("label"))


@query(f"SELECT DISTINCT label FROM (SELECT unnest(string_split({CLEAN}, '|')) AS label FROM part) WHERE label <> ''")
def label_vocabulary(spark, d):
    return B.label_vocabulary(raw_labels(spark, d).select(N.clean_raw_labels(F.col("raw")).alias("label")), "label")


@query("SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 'first' WHEN 'Brand#2' THEN 'second' ELSE p_brand END AS brand FROM part")
def map_label(spark, d):
    return table(spark, d, "part").select("p_partkey", N.map_label(F.col("p_brand"), {"Brand#1": "first", "Brand#2": "second"}).alias("brand"))


HOT = ["red", "green", "bolt", "gear"]


@query("SELECT p_partkey, concat_ws('', " + ", ".join(f"CAST(list_contains(string_split(p_name, ' '), '{w}') AS INTEGER)" for w in HOT) + ") AS bits FROM part")
def multi_hot(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(N.multi_hot(F.col("p_name"), HOT, " ").cast("array<string>"), "").alias("bits"))


@query("SELECT p_partkey, replace(p_name, ' ', '|') AS tokens FROM part")
def pred_tokens(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(N.pred_tokens(F.replace("p_name", F.lit(" "), F.lit(" , "))), "|").alias("tokens"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 WHEN 'P' THEN 2 END AS idx FROM orders")
def class_index(spark, d):
    return table(spark, d, "orders").select("o_orderkey", N.class_index(F.col("o_orderstatus"), ["O", "F", "P"]).alias("idx"))


@query("SELECT p_partkey, p_size > 20 AS as_bool, p_size % 3 <> 0 AS as_number, p_size > 30 AS as_text FROM part")
def is_true(spark, d):
    text = F.when(F.col("p_size") > 30, " TRUE ").when(F.col("p_size") > 20, "no").otherwise(F.lit(None))
    return table(spark, d, "part").select("p_partkey", N.is_true(F.col("p_size") > 20).alias("as_bool"), N.is_true(F.col("p_size") % 3).alias("as_number"), N.is_true(text).alias("as_text"))


# ---- tags

FLAGS = {"strappy": "p_size % 2 = 0", "platform": "p_size % 3 = 0", "bow": "p_size % 5 = 0", "fur": "CASE WHEN p_size % 7 > 0 THEN p_size % 11 = 0 END"}
TAGS = "WITH t AS (SELECT CAST(p_partkey AS VARCHAR) AS name, CASE WHEN p_partkey % 50 = 0 THEN '_invalid:x' ELSE p_type END AS toe_shape, p_brand AS heel_type, " + ", ".join(f"{e} AS {a}" for a, e in FLAGS.items()) + " FROM part)\n"


def tags(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("name"), F.when(F.col("p_partkey") % 50 == 0, "_invalid:x").otherwise(F.col("p_type")).alias("toe_shape"), F.col("p_brand").alias("heel_type"),
        *[F.expr(e).alias(a) for a, e in FLAGS.items()])


def tags_long(spark, d):
    return B.long_form(tags(spark, d), list(FLAGS))


@query(TAGS + "SELECT name, toe_shape, heel_type FROM t WHERE bow AND heel_type = 'Brand#2' ORDER BY name LIMIT 30")
def filter_tags(spark, d):
    return L.filter_tags(tags(spark, d), "bow", None, "Brand#2", 30).select("name", "toe_shape", "heel_type")


def _top(column: str, kind: str) -> str:
    return f"SELECT * FROM (SELECT '{kind}' AS kind, {column} AS value, count(*) AS n FROM t GROUP BY {column} ORDER BY n DESC, value LIMIT 1)"


@query(TAGS + f"SELECT 'rows' AS kind, '' AS value, count(*) AS n FROM t UNION ALL {_top('toe_shape', 'toe')} UNION ALL {_top('heel_type', 'heel')}")
def tag_summary(spark, d):
    return M.tag_summary(tags(spark, d))


@query(TAGS + "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS attr, count(*) FILTER ({a}) AS n, round(100.0::DOUBLE * count(*) FILTER ({a}) / count(*), 2) AS percent FROM t" for a in FLAGS) + ") WHERE n > 0")
def attribute_prevalence(spark, d):
    return E.attribute_prevalence(tags_long(spark, d))


BADGES = {k: "concat_ws('|', " + ", ".join(f"CASE WHEN {a} THEN '{a}' END" for a in v) + ")" for k, v in (("construction", ["strappy", "platform"]), ("embellishment", ["bow", "fur"]))}


@query(TAGS + f"SELECT name, concat_ws('|', toe_shape, heel_type, nullif({BADGES['construction']}, '')) AS model_details, {BADGES['embellishment']} AS embellishments FROM t")
def tags_to_nested(spark, d):
    nested = B.tags_to_nested(tags(spark, d), ["toe_shape", "heel_type"], ["strappy", "platform"], ["bow", "fur"])
    return nested.select("name", F.array_join("model_details", "|").alias("model_details"), F.array_join("embellishments", "|").alias("embellishments"))


@query(TAGS + f"""SELECT name, md5(concat_ws(chr(10), 'Toe shape: ' || toe_shape, 'Heel type: ' || heel_type, 'Construction: ' || nullif(replace({BADGES['construction']}, '|', ', '), ''), 'Embellishments: ' || nullif(replace({BADGES['embellishment']}, '|', ', '), ''))) AS block FROM t""")
def grounded_prompt(spark, d):
    t = tags(spark, d)
    cols = {a: F.col(a) for a in FLAGS}
    block = P.tag_block(F.col("toe_shape"), F.col("heel_type"), P.true_names(["strappy", "platform"], cols), P.true_names(["bow", "fur"], cols))
    return t.select("name", F.md5(block).alias("block"))


@query(TAGS + f"""SELECT t.name, toe_shape, heel_type, toe_shape LIKE '\\_invalid%' ESCAPE '\\' OR heel_type LIKE '\\_invalid%' ESCAPE '\\' AS invalid, {BADGES['construction']} AS construction, {BADGES['embellishment']} AS embellishment,
 coalesce(source, '') AS description, lang = 'en' AS grounded, l.doc_id IS NOT NULL AS image_found FROM t LEFT JOIN documents d ON CAST(d.doc_id AS VARCHAR) = name LEFT JOIN labels l ON CAST(l.doc_id AS VARCHAR) = name""")
def review_cards(spark, d):
    described = docs(spark, d).select("name", F.col("source").alias("description"), (F.col("lang") == "en").alias("grounded"))
    cards = M.review_cards(tags(spark, d), described, labels(spark, d), ["strappy", "platform"], ["bow", "fur"])
    return cards.withColumns({c: F.array_join(c, "|") for c in ("construction", "embellishment")})


# ---- answers of models

ANSWER = """CASE event_id % 5 WHEN 0 THEN '{"toe_shape": "' || event_type || '", "bow": true, "fur": "false"}' WHEN 1 THEN '```json' || chr(10) || '{"toe_shape": "' || event_type || '", "bow": ' || (event_id % 2) || '}' || chr(10) || '```'
 WHEN 2 THEN 'no answer' WHEN 3 THEN '{}' ELSE '[1, 2]' END"""
TOES = "('click', 'view')"


def answers(spark, d):
    return table(spark, d, "events").select(F.col("event_id").cast("string").alias("name"), F.expr(ANSWER.replace("chr(10)", "char(10)")).alias("raw"))


@query("""SELECT CAST(event_id AS VARCHAR) AS name, CASE event_id % 5 WHEN 2 THEN 'failed' WHEN 3 THEN 'empty' WHEN 4 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN event_id % 5 < 2 THEN event_type END AS toe FROM events""")
def parse_model_json(spark, d):
    parsed = answers(spark, d).withColumn("j", R.parse_model_json(F.col("raw")))
    return parsed.select("name", R.parse_status(F.col("raw"), F.col("j")).alias("status"), F.try_element_at("j", F.lit("toe_shape")).alias("toe"))


@query(f"SELECT event_id, CASE WHEN event_type IN {TOES} THEN event_type ELSE '_invalid:' || event_type END AS choice, CASE WHEN event_type IN {TOES} THEN event_type ELSE 'flat-heel' END AS fallback FROM events")
def validate_choice(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select("event_id", R.validate_choice(kind, ["click", "view"]).alias("choice"), R.validate_choice(kind, ["click", "view"], "flat-heel").alias("fallback"))


@query(f"""SELECT CAST(event_id AS VARCHAR) AS name, CASE WHEN event_id % 5 < 2 THEN CASE WHEN event_type IN {TOES} THEN event_type ELSE '_invalid:' || event_type END END AS toe_shape, NULL::VARCHAR AS heel_type,
 CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN event_id % 2 = 1 END AS bow, CASE WHEN event_id % 5 < 2 THEN false END AS fur, CASE event_id % 5 WHEN 2 THEN 'failed' WHEN 3 THEN 'empty' WHEN 4 THEN 'failed' ELSE 'ok' END AS parse_status FROM events""")
def coerce_flags(spark, d):
    return T.parse_tags(answers(spark, d), ["click", "view"], ["flat"], ["bow", "fur"])


# ---- annotation tasks, made of conversations: a task a conversation, a widget a role


def tasks(spark, d):
    turns = table(spark, d, "conversations")
    choice = F.concat(F.lit("t"), (F.length("text") % 10).cast("string"))
    lists = turns.groupBy("conv_id", "role").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", choice.alias("c")))), lambda x: x["c"]).alias("choices"))
    widget = F.when(F.col("role") == "user", "construction").when(F.col("role") == "assistant", "embellishment").otherwise("toe_shape")
    result = lists.withColumn("from_name", widget).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("from_name", F.struct("choices").alias("value")))).alias("result"))
    none = F.array().cast("array<struct<result:array<struct<from_name:string,value:struct<choices:array<string>>>>>>")
    return result.select("conv_id", F.when(F.col("conv_id") % 4 == 0, none).otherwise(F.array(F.struct("result"))).alias("annotations"))


CHOICES = "WITH t AS (SELECT *, 't' || (length(text) % 10) AS c FROM conversations), g AS (SELECT conv_id, string_agg(c, '|' ORDER BY turn) FILTER (role = 'user') AS construction, string_agg(c, '|' ORDER BY turn) FILTER (role = 'assistant') AS embellishment, arg_min(c, turn) FILTER (role NOT IN ('user', 'assistant')) AS toe_shape FROM t GROUP BY 1)\n"


@query(CHOICES + "SELECT conv_id, CASE WHEN conv_id % 4 > 0 THEN coalesce(toe_shape, '') ELSE '' END AS toe_shape, '' AS heel_type, CASE WHEN conv_id % 4 > 0 THEN coalesce(construction, '') ELSE '' END AS construction FROM g")
def annotation_single(spark, d):
    return tasks(spark, d).select("conv_id", A.annotation_single(F.col("annotations")).alias("a")).select("conv_id", "a.*")


@query(CHOICES + "SELECT conv_id, CASE WHEN conv_id % 4 > 0 THEN coalesce(embellishment, '') ELSE '' END AS embellishment FROM g")
def annotation_multi(spark, d):
    return tasks(spark, d).select("conv_id", A.annotation_multi(F.col("annotations")).alias("embellishment"))


MERGED = CHOICES + ", m AS (SELECT conv_id, string_agg(DISTINCT c, '_' ORDER BY c) FILTER (role IN ('user', 'assistant')) AS attributes, arg_min(c, turn) FILTER (role NOT IN ('user', 'assistant')) AS quality FROM t WHERE conv_id % 4 > 0 GROUP BY 1)\n"


@query(MERGED + "SELECT conv_id, coalesce(attributes, '') AS attributes, coalesce(quality, '') AS quality FROM m")
def annotation_attributes(spark, d):
    found = tasks(spark, d).select("conv_id", A.annotation_attributes(F.col("annotations"), ["construction", "embellishment"], "toe_shape").alias("a"))
    return found.where("a IS NOT NULL").select("conv_id", F.array_join("a.attributes", "_").alias("attributes"), "a.quality")


@query(MERGED + "SELECT conv_id, coalesce(attributes, '') AS choices FROM m")
def merge_choices(spark, d):
    result = A.first_result(F.col("annotations"))
    return tasks(spark, d).where(result.isNotNull()).select("conv_id", F.array_join(A.merge_choices(result, ["construction", "embellishment"]), "_").alias("choices"))


@query(MERGED + "SELECT count(*) FILTER (conv_id % 4 > 0 AND coalesce(quality, '') <> 't3') AS n_annotated, count(*) FILTER (conv_id % 4 = 0) AS n_without, count(*) FILTER (conv_id % 4 > 0 AND quality = 't3') AS n_rejected FROM (SELECT DISTINCT conv_id FROM t) LEFT JOIN m USING (conv_id)")
def annotation_summary(spark, d):
    result = A.first_result(F.col("annotations"))
    quality = F.coalesce(F.get(A.choices_of(result, "toe_shape"), F.lit(0)), F.lit(""))
    return M.annotation_summary(tasks(spark, d), result.isNotNull(), quality == "t3")


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'page' || page_id WHEN page_id % 3 = 1 THEN 'img ' || page_id ELSE 'x' || page_id END AS name FROM pages")
def annotation_name(spark, d):
    n = F.col("page_id").cast("string")
    url = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("/data/local-files/?d=01-RAW%5Cdir%5Cimg%20"), n, F.lit(".JPG"))).otherwise(F.concat(F.lit("http://h/a/x"), n, F.lit(".png?v=1")))
    name = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("page"), n)).when(F.col("page_id") % 3 == 1, "local-files").otherwise("")
    return table(spark, d, "pages").select("page_id", A.annotation_name(url, name).alias("name"))


@query("SELECT CAST(doc_id AS VARCHAR) || '.jpg' AS file, 'http://h/' || doc_id || '.jpg' AS image, CAST(doc_id AS VARCHAR) AS name FROM documents")
def annotation_tasks(spark, d):
    made = B.annotation_tasks(docs(spark, d).withColumn("ext", F.lit("jpg")), "http://h/")
    return made.select("file", "data.image", "data.name")


@query(TAGS + "SELECT name, 'http://h/' || name || '.jpg' AS image, concat_ws('|', CASE WHEN fur THEN 'fur' END, CASE WHEN bow THEN 'bow' END) AS choices, CAST(coalesce(fur, false) OR coalesce(bow, false) AS INTEGER) AS n FROM t")
def preannotation_tasks(spark, d):
    predicted = tags_long(spark, d).select("name", F.concat("name", F.lit(".jpg")).alias("file"), "attr", F.coalesce("value", F.lit(False)).cast("int").alias("pred"))
    made = B.preannotation_tasks(predicted, ["fur", "bow"], "http://h/", "embellishment")
    chosen = A.choices_of(A.first_result(F.col("annotations")), "embellishment")
    return made.select("data.name", "data.image", F.array_join(chosen, "|").alias("choices"), F.size("annotations").alias("n"))


# ---- scores of vectors

HEAD = S.LinearHead(["a", "b", "c"], np.array([[((7 * i + 3 * k) % 11 - 5) / 10 for k in range(3)] for i in range(64)]), np.array([0.1, 0.0, -0.1]))
SECOND = {"a": S.LinearHead(["x", "y"], HEAD.weights[:, 1:], HEAD.bias[1:]), "b": S.LinearHead(["z"], HEAD.weights[:, :1], HEAD.bias[:1])}


def dot(k: int) -> str:
    return "CAST(list_dot_product(CAST(embedding AS DOUBLE[]), [" + ", ".join(f"{float(w)!r}" for w in HEAD.weights[:, k]) + f"]) + {float(HEAD.bias[k])!r} AS DOUBLE)"


LOGITS = f"WITH z AS (SELECT vec_id, {dot(0)} AS z0, {dot(1)} AS z1, {dot(2)} AS z2 FROM embeddings), m AS (SELECT *, greatest(z0, z1, z2) AS top, exp(z0 - greatest(z0, z1, z2)) + exp(z1 - greatest(z0, z1, z2)) + exp(z2 - greatest(z0, z1, z2)) AS total FROM z)\n"


def vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"))


@query(LOGITS + "SELECT vec_id, CASE WHEN z0 = top THEN 'a' WHEN z1 = top THEN 'b' ELSE 'c' END AS prediction, round(1 / total, 4) AS confidence, round(exp(z0 - top) / total, 4) AS prob_a, round(exp(z1 - top) / total, 4) AS prob_b, round(exp(z2 - top) / total, 4) AS prob_c FROM m")
def score_single(spark, d):
    got = S.score_single(vectors(spark, d), HEAD, HEAD.classes, "vec_id")
    return got.select("vec_id", "prediction", "confidence", *[F.get("probs", F.lit(i)).alias(f"prob_{c}") for i, c in enumerate(HEAD.classes)])


@query(LOGITS + "SELECT vec_id, unnest(['a', 'b', 'c']) AS attr, round(unnest([1 / (1 + exp(-z0)), 1 / (1 + exp(-z1)), 1 / (1 + exp(-z2))]), 4) AS score, unnest([CAST(1 / (1 + exp(-z0)) >= 0.5 AS INTEGER), CAST(1 / (1 + exp(-z1)) >= 0.5 AS INTEGER), CAST(1 / (1 + exp(-z2)) >= 0.5 AS INTEGER)]) AS pred FROM z")
def score_multi(spark, d):
    return S.score_multi(vectors(spark, d), HEAD, HEAD.classes, 0.5, "vec_id")


@query(LOGITS + """, c AS (SELECT *, CASE WHEN z0 = top THEN 'a' WHEN z1 = top THEN 'b' ELSE 'c' END AS category, round(1 / total, 4) AS category_conf FROM m)
SELECT vec_id, category, category_conf, CASE category WHEN 'a' THEN CASE WHEN z1 >= z2 THEN 'x' ELSE 'y' END WHEN 'b' THEN 'z' ELSE 'unknown' END AS subcategory,
 CASE category WHEN 'a' THEN round(1 / (1 + exp(least(z1, z2) - greatest(z1, z2))), 4) WHEN 'b' THEN 1.0 ELSE 0.0 END::DOUBLE AS subcategory_conf FROM c""")
def score_cascade(spark, d):
    return S.score_cascade(vectors(spark, d), HEAD, SECOND, "vec_id")


@query("SELECT vec_id, round(1 / (1 + exp(CAST(embedding[2] - embedding[1] AS DOUBLE))), 4) AS score FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings)")
def contrastive_prob(spark, d):
    x = F.col("features")
    return vectors(spark, d).select("vec_id", F.round(R.contrastive_prob(F.get(x, F.lit(0)), F.get(x, F.lit(1))), 4).alias("score"))


@query("""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), p AS (SELECT vec_id, 1 / (1 + exp(-20 * (v[1] - v[2]) / sqrt(list_dot_product(v, v)))) AS a, 1 / (1 + exp(-20 * (v[3] - v[4]) / sqrt(list_dot_product(v, v)))) AS b FROM e)
SELECT vec_id, 'first' AS attr, round(a, 4) AS score, CAST(a >= 0.5 AS INTEGER) AS pred FROM p UNION ALL SELECT vec_id, 'second', round(b, 4), CAST(b >= 0.5 AS INTEGER) FROM p""")
def zero_shot(spark, d):
    axis = np.eye(64)
    return S.zero_shot(vectors(spark, d), {"first": (axis[0], axis[1]), "second": (axis[2], axis[3])}, 20.0, 0.5, "vec_id", "features")


def _halves(e: str) -> str:
    return f"[list_avg(list_transform(list_filter(v, lambda x, i: i % 2 = 1), lambda x: {e})), list_avg(list_transform(list_filter(v, lambda x, i: i % 2 = 0), lambda x: {e}))]"


@query(f"""WITH s AS (SELECT {_halves("x")} AS m, {_halves("x * x")} AS q FROM (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings))
SELECT round(avg(m[1]), 6) AS mean_0, round(avg(m[2]), 6) AS mean_1, round(sqrt(avg(q[1]) - avg(m[1]) * avg(m[1])), 6) AS std_0, round(sqrt(avg(q[2]) - avg(m[2]) * avg(m[2])), 6) AS std_1 FROM s""")
def channel_stats(spark, d):
    """Each vector as an image of two channels, whose values alternate."""
    own = lambda c: F.filter("features", lambda x, i: i % 2 == c)
    mean = lambda c, f: F.aggregate(own(c), F.lit(0.0), lambda a, x: a + f(x)) / F.size(own(c))
    means = vectors(spark, d).select(F.array(*[mean(c, lambda x: x) for c in (0, 1)]).alias("sums"), F.array(*[mean(c, lambda x: x * x) for c in (0, 1)]).alias("squares"))
    stats = X.channel_stats(means, 2)
    return stats.select(*[F.round(F.get(k, F.lit(c)), 6).alias(f"{k}_{c}") for k in ("mean", "std") for c in (0, 1)])


MOST_LABELS = 1000  # a head has a column for each


@query()
def fit_head(spark, d):
    """vec_id, label and the prediction of a head fitted on three quarters of the labelled vectors.

    Vectors without a label are scored too; their split is null. More than MOST_LABELS labels is an error.
    """
    data = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"), F.col("label").cast("string").alias("label"))
    data = data.withColumn("split", F.when(F.col("label").isNull(), None).when(F.col("vec_id") % 4 == 0, "val").otherwise("train"))
    classes = sorted(r[0] for r in data.where("label IS NOT NULL").select("label").distinct().limit(MOST_LABELS + 1).collect())
    if len(classes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    head = S.fit_head(data, "label", classes, column="features", split="split")
    return S.score_single(data, head, classes, "vec_id").join(data.select("vec_id", "label", "split"), "vec_id").select("vec_id", "label", "split", "prediction", "confidence")


@query("SELECT CASE WHEN vec_id % 4 = 0 THEN 'val' ELSE 'train' END AS split, count(*) AS n, true AS accurate FROM embeddings GROUP BY ALL")
def fit_head_separable(spark, d):
    """Whether a head learns labels that a plane parts: of each split the rows, and whether 4 of 5 are predicted (a guess: 1 of 2)."""
    side = F.when(F.get("features", F.lit(0)) > F.get("features", F.lit(1)), "first").otherwise("second")
    data = vectors(spark, d).withColumn("label", side).withColumn("split", F.when(F.col("vec_id") % 4 == 0, "val").otherwise("train"))
    head = S.fit_head(data, "label", ["first", "second"], column="features", split="split")
    scored = S.score_single(data, head, head.classes, "vec_id").join(data.select("vec_id", "label", "split"), "vec_id")
    return scored.groupBy("split").agg(F.count("*").alias("n"), (F.avg((F.col("prediction") == F.col("label")).cast("double")) >= 0.8).alias("accurate"))


KINDS = ("click", "error", "purchase", "signup", "view")
MULTI = ("large", "third", "even")
_own = "SELECT event_type, CAST(value > 50 AS INTEGER) AS large, CAST(user_id % 3 = 0 AS INTEGER) AS third, CAST(event_id % 2 = 0 AS INTEGER) AS even FROM events"


def grouped_rows(spark, d):
    """Events as vectors that name their type, with attributes."""
    events = table(spark, d, "events")
    flags = {"large": F.col("value") > 50, "third": F.col("user_id") % 3 == 0, "even": F.col("event_id") % 2 == 0}
    own = F.filter(F.array(*[F.when(f, F.lit(a)) for a, f in flags.items()]), lambda x: x.isNotNull())
    return events.select("event_id", "event_type", F.array(*[(F.col("event_type") == k).cast("double") for k in KINDS]).alias("features"), own.alias("labels"))


# the best head on vectors that name a group gives each group its weighted share of positives, which SQL can count
_parts = "WITH e AS (" + _own + "), x AS (" + " UNION ALL ".join(f"SELECT event_type, '{a}' AS attr, {a} AS y FROM e" for a in MULTI) + "), w AS (SELECT attr, (count(*) - sum(y)) / sum(y) AS w FROM x GROUP BY 1), g AS (SELECT event_type, attr, count(*) AS n, sum(y) AS pos FROM x GROUP BY ALL), p AS (SELECT g.*, w, w * pos / (w * pos + n - pos) AS p FROM g JOIN w USING (attr)) "


@query(_parts + "SELECT event_type, attr, round(p, 3) AS score FROM p")
def fit_multi_head(spark, d):
    """A head of several attributes with positive weights: its scores by group."""
    data = grouped_rows(spark, d)
    n = data.count()
    held = {r.attr: r.f for r in data.select(F.explode("labels").alias("attr")).groupBy("attr").agg(F.count("*").alias("f")).collect()}
    head = S.fit_multi_head(data, "labels", MULTI, {a: (n - f) / f for a, f in held.items()}, "features", tolerance=1e-9)
    one = data.groupBy("event_type").agg(F.first("features").alias("features"))
    cells = F.explode(F.arrays_zip(F.array(*[F.lit(a) for a in MULTI]).alias("attr"), F.col("logits").alias("z")))
    return S.logits(one, head, "event_type").select("event_type", cells.alias("c")).select("event_type", "c.attr", F.round(R.sigmoid(F.col("c.z")), 3).alias("score"))


@query(_parts + ", l AS (SELECT attr, sum(-w * pos * ln(p) - (n - pos) * ln(1 - p)) / sum(n) AS loss FROM p GROUP BY 1) SELECT attr, round(loss, 4) AS loss FROM l")
def fit_multi_head_loss(spark, d):
    """The mean loss that the fit reaches, by attribute."""
    data = grouped_rows(spark, d)
    n = data.count()
    held = {r.attr: r.f for r in data.select(F.explode("labels").alias("attr")).groupBy("attr").agg(F.count("*").alias("f")).collect()}
    weight = {a: (n - f) / f for a, f in held.items()}
    head = S.fit_multi_head(data, "labels", MULTI, weight, "features")
    z = S.logits(data.select(F.struct("event_id", "labels").alias("key"), "features"), head, "key").select("key.labels", F.posexplode("logits").alias("i", "z"))
    attr = F.element_at(F.array(*[F.lit(a) for a in MULTI]), F.col("i") + 1)
    soft = F.log1p(F.exp(-F.abs("z")))
    loss = F.when(F.array_contains("labels", F.col("attr")), F.col("w") * (soft + F.greatest(-F.col("z"), F.lit(0.0)))).otherwise(soft + F.greatest("z", F.lit(0.0)))
    weights = F.element_at(F.create_map(*[x for a in MULTI for x in (F.lit(a), F.lit(weight[a]))]), F.col("attr"))
    return z.withColumn("attr", attr).withColumn("w", weights).groupBy("attr").agg(F.round(F.avg(loss), 4).alias("loss"))


@query("WITH g AS (SELECT event_type AS k, user_id % 3 AS label, count(*) AS n FROM events GROUP BY ALL) SELECT k, CAST(label AS VARCHAR) AS label, round(n / sum(n) OVER (PARTITION BY k), 3) AS prob FROM g")
def fit_head_shares(spark, d):
    """A head of one label on vectors that name a group: its probabilities are the group's shares."""
    data = table(spark, d, "events").select("event_type", F.array(*[(F.col("event_type") == k).cast("double") for k in KINDS]).alias("features"), (F.col("user_id") % 3).cast("string").alias("label"))
    classes = ["0", "1", "2"]
    head = S.fit_head(data, "label", classes, column="features", tolerance=1e-12)
    one = data.groupBy("event_type").agg(F.first("features").alias("features"))
    cells = F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in classes]).alias("label"), R.softmax(F.col("logits")).alias("p")))
    return S.logits(one, head, "event_type").select(F.col("event_type").alias("k"), cells.alias("c")).select("k", "c.label", F.round("c.p", 3).alias("prob"))


@query("SELECT DISTINCT source, CAST(doc_id AS VARCHAR) AS name FROM documents WHERE source IS NOT NULL")
def commit_results(spark, d):
    """A commit for each of two halves; the second is made twice, a third writer dies before its end."""
    from tagflow.sources.results import commit_results as commit
    from tagflow.sources.results import read_results
    from tagflow.sources.scratch import shared_dir

    path = f"{shared_dir(spark)}/results-{uuid.uuid4().hex}"
    rows = table(spark, d, "documents").where("source IS NOT NULL").select("source", F.col("doc_id").cast("string").alias("name")).distinct()
    half = F.crc32("name") % 2
    for k in (0, 1, 1):
        commit(rows.where(half == k), path, f"half {k}")
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/commit=killed/attempt=0")
    return read_results(spark, path)


@query("SELECT DISTINCT CAST(doc_id AS VARCHAR) AS name, lang FROM documents")
def incremental_intake(spark, d):
    """The documents as a stream, each name tagged once; a second run finds nothing new."""
    from tagflow.sources.scratch import shared_dir
    from tagflow.streaming.intake import incremental_intake as intake
    from tagflow.streaming.intake import read_results

    place = f"{shared_dir(spark)}/intake-{uuid.uuid4().hex}"
    schema = table(spark, d, "documents").schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{d}/documents.parque[t]").select(F.col("doc_id").cast("string").alias("name"), "lang")
    for _ in range(2):
        intake(stream, lambda df: df, f"{place}/done", f"{place}/checkpoint").awaitTermination()
    return read_results(spark, f"{place}/done")
