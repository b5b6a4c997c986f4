"""Queries on predictions, splits, terms and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagflow.operators import evaluation as E
from tagflow.operators import filters as L
from tagflow.operators import joins as J
from tagflow.operators import sampling as S
from tagflow.operators import summaries as M
from tagflow.plans.registry import query, table
from tagflow.sources.tables import pivot_wide

NEXT = "CASE event_type WHEN 'click' THEN 'view' WHEN 'view' THEN 'purchase' ELSE 'click' END"
PRED = f"""WITH p AS (SELECT CAST(event_id AS VARCHAR) AS name, event_type AS gt, CASE WHEN event_id % 7 = 0 THEN {NEXT} ELSE event_type END AS pred,
 round(CAST(event_id % 1000 AS DOUBLE) / 1000, 4) AS confidence FROM events), n AS (SELECT gt, pred, count(*) AS n FROM p GROUP BY ALL)
"""
PER_LABEL = """, g AS (SELECT gt AS label, CAST(sum(n) AS BIGINT) AS support, sum(CASE WHEN gt = pred THEN n ELSE 0 END) AS tp FROM n GROUP BY 1), q AS (SELECT pred AS label, sum(n) AS predicted FROM n GROUP BY 1),
s AS (SELECT label, coalesce(support, 0) AS support, coalesce(tp / nullif(predicted, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall FROM g FULL JOIN q USING (label)),
l AS (SELECT label, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support FROM s)
"""
CLASSES = ["click", "purchase", "signup", "view", "error", "logout"]


def predictions(spark, d):
    follow = F.when(F.col("event_type") == "click", "view").when(F.col("event_type") == "view", "purchase").otherwise("click")
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("name"), F.col("event_type").alias("gt"), F.when(F.col("event_id") % 7 == 0, follow).otherwise(F.col("event_type")).alias("pred"),
        F.round((F.col("event_id") % 1000).cast("double") / 1000, 4).alias("confidence"))


def counts(spark, d):
    return E.pair_counts(predictions(spark, d))


GRID = ", ".join(f"('{c}')" for c in CLASSES)


@query(PRED + f""", c(k) AS (VALUES {GRID}), f AS (SELECT a.k AS gt, b.k AS pred, coalesce(n.n, 0) AS n FROM c a CROSS JOIN c b LEFT JOIN n ON n.gt = a.k AND n.pred = b.k)
SELECT gt, pred, n, n / greatest(sum(n) OVER (PARTITION BY gt), 1) AS share FROM f""")
def confusion_matrix(spark, d):
    return E.confusion_matrix(counts(spark, d), CLASSES)


REPORT = PER_LABEL + """, m AS (SELECT avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf, sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf, CAST(sum(support) AS BIGINT) AS n FROM l)
SELECT * FROM l UNION ALL SELECT 'macro avg', mp, mr, mf, n FROM m UNION ALL SELECT 'weighted avg', wp, wr, wf, n FROM m UNION ALL SELECT 'accuracy', wr, wr, wr, n FROM m"""


@query(PRED + REPORT)
def classification_report(spark, d):
    return E.classification_report(counts(spark, d))


@query(PRED + "SELECT sum(CASE WHEN gt = pred THEN n ELSE 0 END) / sum(n) AS accuracy, CAST(sum(n) AS BIGINT) AS n FROM n")
def accuracy(spark, d):
    return E.accuracy(counts(spark, d))


@query(PRED + """SELECT coalesce(gt, 'OVERALL') AS label, CAST(sum(n) AS BIGINT) AS n_samples, sum(CASE WHEN gt = pred THEN n ELSE 0 END) / sum(n) AS accuracy FROM n GROUP BY ROLLUP (gt)""")
def per_class_accuracy(spark, d):
    return E.per_class_accuracy(counts(spark, d))


@query(PRED + "SELECT * FROM n WHERE gt <> pred ORDER BY n DESC, gt, pred LIMIT 10")
def top_confusions(spark, d):
    return E.top_confusions(counts(spark, d), 10)


@query(PRED + "SELECT name, gt AS true_label, pred AS pred_label FROM p WHERE gt <> pred")
def misclassified(spark, d):
    return E.misclassified(predictions(spark, d))


@query(PRED + "SELECT gt AS label FROM n UNION SELECT pred FROM n")
def label_universe(spark, d):
    return E.label_universe(counts(spark, d))


@query(PRED + "SELECT name, confidence FROM p WHERE confidence < 0.8")
def low_confidence(spark, d):
    return L.low_confidence(predictions(spark, d).select("name", "confidence"))


@query(PRED + "SELECT count(*) AS n, avg(confidence) AS mean_confidence, count(*) FILTER (confidence < 0.8) AS n_low FROM p")
def prediction_summary(spark, d):
    return M.prediction_summary(predictions(spark, d))


@query(PRED + "SELECT name, gt, pred FROM p WHERE gt IN ('click', 'view')")
def filter_valid_single(spark, d):
    return L.filter_valid_single(predictions(spark, d).select("name", "gt", "pred"), "gt", ["click", "view"])


# ---- multi-label: flags and scores of line items

ATTRS = {"big": ("l_returnflag = 'R'", "l_quantity / 50"), "cheap": ("l_linestatus = 'O'", "l_discount * 10"), "late": ("l_returnflag = 'A'", "(l_linenumber - 1) / 7.0D"), "never": ("l_quantity < 0", "l_tax / 10")}
NAME = "concat(l_orderkey, '-', l_linenumber)"
LONG = "WITH e AS (" + " UNION ALL ".join(
    f"SELECT {NAME} AS name, '{a}' AS attr, CAST({g} AS INTEGER) AS gt, {s.replace('7.0D', '7.0::DOUBLE')} AS score FROM lineitem" for a, (g, s) in ATTRS.items()) + "), x AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS pred FROM e)"
TALLY = LONG + """, t AS (SELECT attr, count(*) FILTER (gt = 1 AND pred = 1) AS tp, count(*) FILTER (gt = 0 AND pred = 1) AS fp, count(*) FILTER (gt = 1 AND pred = 0) AS fn, count(*) FILTER (gt = 0 AND pred = 0) AS tn, count(*) AS n FROM x GROUP BY 1)"""
MULTI = TALLY + """, r AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp / nullif(tp + fn, 0), 0.0) AS q FROM t), f AS (SELECT *, CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0.0 END AS f FROM r),
mm AS (SELECT attr, round(p, 3) AS precision, round(q, 3) AS recall, round(f, 3) AS f1, tp + fn AS support, tp + fp AS pred_positives, round((tp + fn) / n, 4) AS gt_rate, round((tp + fp) / n, 4) AS pred_rate,
 CASE WHEN round(f, 3) >= 0.8 THEN 'ships' WHEN round(f, 3) >= 0.65 THEN 'fine-tune' ELSE 'needs work' END AS signal FROM f)"""


def scores_long(spark, d):
    cells = F.array(*[F.struct(F.lit(a).alias("attr"), F.expr(f"CAST({g} AS INT)").alias("gt"), F.expr(f"CAST({s} AS DOUBLE)").alias("score")) for a, (g, s) in ATTRS.items()])
    return table(spark, d, "lineitem").select(F.expr(NAME).alias("name"), F.explode(cells).alias("c")).select("name", "c.*").withColumn("pred", (F.col("score") >= 0.5).cast("int"))


@query(MULTI + " SELECT * FROM mm")
def multilabel_metrics(spark, d):
    return E.multilabel_metrics(scores_long(spark, d), 0.5)


@query(MULTI + " SELECT round(avg(f1), 4) AS macro_f1, count(*) AS n_attrs FROM mm")
def macro_f1(spark, d):
    return E.macro_f1(E.multilabel_metrics(scores_long(spark, d)))


@query(TALLY + " SELECT attr, tp, fp, fn, tn FROM t")
def error_breakdown(spark, d):
    return E.error_breakdown(scores_long(spark, d))


@query(TALLY + """, b AS (SELECT attr, 'present' AS class, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, tp + fn AS support FROM t
 UNION ALL SELECT attr, 'absent', coalesce(tn / nullif(tn + fn, 0), 0.0), coalesce(tn / nullif(tn + fp, 0), 0.0), tn + fp FROM t)
SELECT attr, class, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support FROM b""")
def binary_report(spark, d):
    return E.binary_report(scores_long(spark, d))


SWEEP = ", ".join(f"({t}::DOUBLE)" for t in E.THRESHOLDS)


@query(LONG + f""", th(t) AS (VALUES {SWEEP}), w AS (SELECT attr, t, count(*) FILTER (gt = 1 AND score >= t) AS tp, count(*) FILTER (gt = 0 AND score >= t) AS fp, count(*) FILTER (gt = 1) AS pos FROM x CROSS JOIN th GROUP BY 1, 2),
f AS (SELECT attr, t, coalesce(2.0 * tp / nullif(tp + fp + pos, 0), 0.0)::DOUBLE AS f1 FROM w), b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY attr ORDER BY f1 DESC, t) = 1)
SELECT attr, CASE WHEN f1 > 0 THEN t ELSE 0.5::DOUBLE END AS threshold, f1 FROM b""")
def threshold_sweep(spark, d):
    return E.threshold_sweep(scores_long(spark, d))


@query(LONG + """, a AS (SELECT attr, count(*) FILTER (pred = 1) AS n_positive, 100.0::DOUBLE * count(*) FILTER (pred = 1) / count(*) AS share, avg(score) AS mean, stddev_samp(score) AS std FROM x GROUP BY 1)
SELECT attr, n_positive, round(share, 2) AS pct_positive, round(mean, 4) AS mean_score, round(std, 4) AS std_score,
 CASE WHEN mean > 0.65 OR mean < 0.35 THEN 'STRONG' WHEN std < 0.04 THEN 'FLAT' WHEN std < 0.07 THEN 'WEAK' ELSE 'OK' END AS signal FROM a""")
def audit_summary(spark, d):
    return E.audit_summary(scores_long(spark, d))


@query(LONG + " SELECT attr FROM (SELECT DISTINCT attr FROM x) WHERE attr NOT IN (SELECT attr FROM x WHERE gt = 1)")
def zero_positive_attrs(spark, d):
    return E.zero_positive_attrs(scores_long(spark, d), list(ATTRS))


@query(LONG + " SELECT name FROM x WHERE attr = 'cheap' AND pred = 1")
def positives(spark, d):
    return L.positives(scores_long(spark, d), "cheap")


@query(LONG + ", w AS (SELECT name, " + ", ".join(f"max(CASE WHEN attr = '{a}' THEN {c} END) AS {p}_{a}" for a in ATTRS for c, p in (("score", "prob"), ("pred", "pred"))) + " FROM x GROUP BY 1) SELECT * FROM w")
def wide_predictions(spark, d):
    return pivot_wide(scores_long(spark, d), list(ATTRS), {"score": "prob_", "pred": "pred_"})


CASES = LONG + """, g AS (SELECT name, string_agg(attr, '|' ORDER BY attr) FILTER (gt = 1) AS gl, max(gt) FILTER (attr = 'big') AS g, max(pred) FILTER (attr = 'big') AS p FROM x GROUP BY 1)
SELECT name, CASE WHEN g = 1 AND p = 1 THEN 'TP' WHEN p = 1 THEN 'FP' WHEN g = 1 THEN 'FN' ELSE 'TN' END AS badge, coalesce(gl, '') AS gt_labels FROM g"""


@query(f"WITH cases AS ({CASES}) SELECT * FROM cases WHERE badge IN ('FP', 'FN')")
def error_cases(spark, d):
    # names may repeat: how often a name has each label is counted, and lists are made of the counts of the cases that stay
    pred = F.expr(f"CAST({ATTRS['big'][1]} AS DOUBLE)") >= 0.5
    counted = [F.count_if(F.expr(g)).alias(f"n_{a}") for a, (g, _) in ATTRS.items()]
    by_name = table(spark, d, "lineitem").groupBy(F.expr(NAME).alias("name")).agg(*counted, F.count_if(pred).alias("p_big"))
    wrong = by_name.where((F.col("n_big") > 0) != (F.col("p_big") > 0))
    true = F.flatten(F.array(*[F.array_repeat(F.lit(a), F.col(f"n_{a}").cast("int")) for a in sorted(ATTRS)]))
    return J.badged(wrong.select("name", true.alias("g"), F.array_repeat(F.lit("big"), F.col("p_big").cast("int")).alias("p")), "big", "both")


# ---- terms

TERMS = """WITH a(alias, canonical) AS (SELECT DISTINCT lower(split_part(p_name, ' ', 2)), upper(split_part(p_name, ' ', 2)) FROM part WHERE p_partkey % 10 < 9 AND split_part(p_name, ' ', 2) < 'p'),
r AS (SELECT p_partkey, ' ' || upper(split_part(p_name, ' ', 2)) || ' ' AS gt, CASE WHEN p_partkey % 5 = 0 THEN split_part(p_name, ' ', 1) ELSE split_part(p_name, ' ', 2) END AS pred FROM part),
t AS (SELECT r.*, coalesce(x.canonical, '_unknown') AS gt_norm, coalesce(y.canonical, '_unknown') AS pred_norm FROM r LEFT JOIN a x ON lower(trim(gt)) = x.alias LEFT JOIN a y ON lower(trim(pred)) = y.alias)
"""


def terms(spark, d):
    part = table(spark, d, "part")
    word = lambda i: F.get(F.split("p_name", " "), F.lit(i))
    aliases = part.where((F.col("p_partkey") % 10 < 9) & (word(1) < "p")).select(F.lower(word(1)).alias("alias"), F.upper(word(1)).alias("canonical")).distinct()
    pairs = part.select("p_partkey", F.concat(F.lit(" "), F.upper(word(1)), F.lit(" ")).alias("gt"), F.when(F.col("p_partkey") % 5 == 0, word(0)).otherwise(word(1)).alias("pred"))
    return E.taxonomy_pairs(pairs, aliases)


@query(TERMS + "SELECT * FROM t")
def normalize_terms(spark, d):
    return terms(spark, d)


@query(TERMS + """SELECT avg(CAST(gt_norm = pred_norm AS INTEGER)) AS raw_rate, avg(CAST(gt_norm = pred_norm AS INTEGER)) FILTER (gt_norm <> '_unknown' AND pred_norm <> '_unknown') AS clean_rate, count(*) AS n,
 count(*) FILTER (gt_norm <> '_unknown' AND pred_norm <> '_unknown') AS n_clean, count(*) FILTER (gt_norm = '_unknown' OR pred_norm = '_unknown') AS n_excluded FROM t""")
def taxonomy_accuracy(spark, d):
    return E.taxonomy_accuracy(terms(spark, d))


@query(TERMS + "SELECT gt_norm, avg(CAST(gt_norm = pred_norm AS DOUBLE)) AS accuracy, count(*) AS n FROM t WHERE gt_norm <> '_unknown' GROUP BY 1")
def taxonomy_per_class(spark, d):
    return E.taxonomy_per_class(terms(spark, d))


@query(TERMS + "SELECT 'gt' AS side, gt AS term, count(*) AS n FROM t WHERE gt_norm = '_unknown' GROUP BY gt UNION ALL SELECT 'pred', pred, count(*) FROM t WHERE pred_norm = '_unknown' GROUP BY pred")
def unknown_terms(spark, d):
    return E.unknown_terms(terms(spark, d))


@query("""WITH x AS (SELECT 'p_brand' AS kind, p_brand AS term FROM part UNION ALL SELECT 'words', unnest(string_split(p_name, ' ')) FROM part) SELECT kind, term, count(*) AS n FROM x WHERE term <> '' GROUP BY ALL""")
def term_frequency(spark, d):
    return E.term_frequency(table(spark, d, "part").select("p_brand", F.split("p_name", " ").alias("words")), ["p_brand"], ["words"])


# ---- samples, splits, weights

@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3")
def class_distribution(spark, d):
    return S.class_distribution(table(spark, d, "orders"), "o_orderpriority", 3)


STATUS = ["F", "O", "P", "X"]


@query("""WITH c(o_orderstatus) AS (VALUES ('F'), ('O'), ('P'), ('X')), n AS (SELECT c.o_orderstatus, count(o_orderkey) AS n FROM c LEFT JOIN orders USING (o_orderstatus) GROUP BY 1)
SELECT o_orderstatus, n, (1 / greatest(n, 1)) / sum(1 / greatest(n, 1)) OVER () AS weight FROM n""")
def class_weights(spark, d):
    return S.class_weights(table(spark, d, "orders"), "o_orderstatus", STATUS)


WORDS = ["red", "green", "bolt", "gear", "ring", "nothing"]


@query("WITH n AS (SELECT count(*) AS n FROM part)" + " UNION ALL ".join(
    f" SELECT '{w}' AS label, (n.n - f) / f AS weight FROM n, (SELECT greatest(count(*) FILTER (contains(p_name, '{w}')), 1) AS f FROM part)" for w in WORDS))
def pos_weights(spark, d):
    return S.pos_weights(table(spark, d, "part"), "p_name", WORDS)


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 400")
def cap_rows(spark, d):
    return S.cap_rows(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), 400, 42, "o_orderkey")


RANDOM = "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) <= ceil(0.25 * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split FROM orders"


@query(RANDOM)
def random_split(spark, d):
    return S.random_split(table(spark, d, "orders").select("o_orderkey"), 0.25, 42, "o_orderkey")


@query(f"WITH s AS ({RANDOM}) SELECT * FROM s WHERE split = 'val'")
def select_split(spark, d):
    return S.select_split(random_split(spark, d), "val")


@query("""WITH c AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1), w AS (SELECT *, ceil(0.2 * sum(n) OVER ()) AS want, ceil(0.2 * sum(n) OVER ()) * n / sum(n) OVER () AS exact FROM c),
l AS (SELECT *, floor(exact) AS low FROM w), e AS (SELECT *, want - sum(low) OVER () AS short, row_number() OVER (ORDER BY round(exact - low, 9) DESC, label) AS i FROM l), q AS (SELECT label, low + CASE WHEN i <= short THEN 1 ELSE 0 END AS n_val FROM e)
SELECT o_orderkey, o_orderpriority, CASE WHEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42|' || o_orderkey), o_orderkey) <= n_val THEN 'val' ELSE 'train' END AS split FROM orders JOIN q ON label = o_orderpriority""")
def stratified_split(spark, d):
    return S.stratified_split(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", 0.2, 42, "o_orderkey").select("o_orderkey", "o_orderpriority", "split")


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 25")
def head_rows(spark, d):
    return S.head_rows(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), 25, "o_orderkey")
