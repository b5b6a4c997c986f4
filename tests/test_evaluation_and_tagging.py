import hashlib
import math
import os
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagflow.functions import annotations as A
from tagflow.functions import prompts as P
from tagflow.functions import responses as R
from tagflow.operators import evaluation as E
from tagflow.operators import joins as J
from tagflow.operators import sampling as S
from tagflow.operators import scoring as M
from tagflow.operators import tagging as T
from tagflow.plans import flows
from tagflow.streaming.intake import incremental_intake, read_done, read_results
from tests.test_names_and_catalog import one


def counts(spark, pairs):
    return E.pair_counts(spark.createDataFrame(pairs, "gt string, pred string"))


def test_report_by_hand(spark):
    c = counts(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("b", "d")])
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in E.classification_report(c).collect()}
    assert got["a"] == (0.5, 0.5, 0.5, 2) and got["c"] == (0, 0, 0, 1) and got["d"] == (0, 0, 0, 0)
    assert got["accuracy"][0] == pytest.approx(0.4) and got["macro avg"][0] == pytest.approx(0.25) and got["weighted avg"][1] == pytest.approx(0.4)
    assert {(r.label, r.n_samples, r.accuracy) for r in E.per_class_accuracy(c).collect()} == {("a", 2, 0.5), ("b", 2, 0.5), ("c", 1, 0.0), ("OVERALL", 5, 0.4)}
    assert [(r.gt, r.pred) for r in E.top_confusions(c, 2).collect()] == [("a", "b"), ("b", "d")]
    grid = {(r.gt, r.pred): (r.n, r.share) for r in E.confusion_matrix(c, ["a", "b", "z"]).collect()}
    assert len(grid) == 9 and grid["a", "a"] == (1, 0.5) and grid["z", "z"] == (0, 0.0)
    assert E.classification_report(counts(spark, [])).where("label = 'accuracy'").first().recall == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 1), st.floats(0, 1)), max_size=40))
def test_sweep_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows or [("a", 0, 0.0)], "attr string, gt int, score double")
    for r in E.threshold_sweep(df).collect():
        own = [x for x in rows or [("a", 0, 0.0)] if x[0] == r.attr]
        best = (0.5, 0.0)
        for t in E.THRESHOLDS:
            tp, fp, fn = (sum(1 for x in own if x[1] == g and (x[2] >= t) == p) for g, p in ((1, True), (0, True), (1, False)))
            f = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
            if f > best[1] + 1e-12:
                best = (t, f)
        assert (r.threshold, r.f1) == pytest.approx(best)


def test_attribute_metrics(spark):
    rows = [("x", 1, 1, 0.5), ("x", 1, 0, 0.2), ("x", 0, 1, 0.9), ("x", 0, 0, 0.1), ("none", 0, 0, 0.0)]
    df = spark.createDataFrame(rows, "attr string, gt int, pred int, score double")
    m = {r.attr: r for r in E.multilabel_metrics(df).collect()}
    assert (m["x"].precision, m["x"].recall, m["x"].f1, m["x"].support, m["x"].signal) == (0.5, 0.5, 0.5, 2, "needs work") and m["none"].f1 == 0
    assert [r.pred for r in df.withColumn("pred", (F.col("score") >= 0.5).cast("int")).collect()][0] == 1
    assert [r.attr for r in E.zero_positive_attrs(df, ["x", "none", "other"]).orderBy("attr").collect()] == ["none", "other"]
    gt = spark.createDataFrame([(i, ["a"] if g else []) for i, (_, g, _, _) in enumerate(rows)], "name long, labels array<string>")
    pred = spark.createDataFrame([(i, ["a"] if p else []) for i, (_, _, p, _) in enumerate(rows)], "name long, labels array<string>")
    for kind, want in {"fp": {"FP"}, "fn": {"FN"}, "tp": {"TP"}, "tn": {"TN"}, "pred": {"TP", "FP"}, "both": {"FP", "FN"}, "all": {"TP", "FP", "FN", "TN"}}.items():
        assert {r.badge for r in J.error_cases(gt, pred, "a", kind).collect()} == want


@pytest.mark.parametrize("frac,n", [(0.2, 101), (0.25, 40), (0.2, 1), (0.5, 3)])
def test_splits_are_whole_and_exact(spark, frac, n):
    df = spark.createDataFrame([(f"n{i}", "a" if i % 7 else "b") for i in range(n)], "name string, label string")
    for out in (S.random_split(df, frac), S.stratified_split(df, "label", frac)):
        rows = out.collect()
        assert len({r.name for r in rows}) == len(rows) == n
        assert sum(r.split == "val" for r in rows) == math.ceil(round(frac * n, 9))
    again = {(r.name, r.split) for r in S.stratified_split(df.repartition(3), "label", frac).collect()}
    assert again == {(r.name, r.split) for r in rows}
    assert S.cap_rows(df, 5).count() == min(5, n)


def test_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("ankle_length",), (None,)], "label string")
    w = {r.label: r.weight for r in S.class_weights(df, "label", ["a", "b", "z"]).collect()}
    assert w == pytest.approx({"a": 0.2, "b": 0.4, "z": 0.4})
    assert {r.label: r.weight for r in S.pos_weights(df, "label", ["a", "zz"]).collect()} == pytest.approx({"a": 2 / 3, "zz": 4.0})
    assert {r.label: r.weight for r in S.pos_weights(df, "label", ["a"], exact=True).collect()} == pytest.approx({"a": 1.5})


RESPONSES = {
    "plain": ('{"toe_shape": "round", "bow": true}', "round", True, "ok"), "fenced": ('```\n{"toe_shape": "odd", "bow": "false"}\n```', "_invalid:odd", False, "ok"),
    "json": ('```json\n{"bow": 1}\n```', None, True, "ok"), "broken": ('{"bow": ', None, None, "failed"), "empty": ("{}", None, None, "empty"), "list": ("[1]", None, None, "failed"),
    "missing": (None, None, None, "missing"), "no key": ('{"x": 1}', None, False, "ok")}


def test_responses(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in RESPONSES.items()], "name string, raw string")
    got = {r.name: (r.toe_shape, r.bow, r.parse_status) for r in T.parse_tags(df, ["round"], ["flat"], ["bow"]).collect()}
    assert got == {k: v[1:] for k, v in RESPONSES.items()}


def test_annotations(spark):
    schema = A.TASK_SCHEMA.split("annotations ")[1]
    results = lambda *r: [([(w, (c,)) for w, c in r],)]
    rows = [("two", results(("toe_shape", ["round"]), ("toe_shape", ["square", "x"]), ("construction", ["b", "a"]), ("construction2", ["a", "c"]))), ("none", []), ("bare", [([],)]),
            ("reject", results(("quality", ["reject"]))), ("null", None)]
    df = spark.createDataFrame(rows, f"name string, annotations {schema}")
    s = {r.name: r.a for r in df.select("name", A.annotation_single(F.col("annotations")).alias("a")).collect()}
    assert tuple(s["two"]) == ("square", "", "b|a") and tuple(s["none"]) == ("", "", "") == tuple(s["null"])
    m = {r.name: r.a for r in df.select("name", A.annotation_attributes(F.col("annotations"), ["construction", "construction2"]).alias("a")).collect()}
    assert m["two"].attributes == ["a", "b", "c"] and m["none"] is None and m["reject"] is None and m["bare"].attributes == []
    assert one(spark, A.annotation_name(F.lit("/d/?d=01-RAW%5Cdir%5Cstem.JPG"), F.lit("local-files"))) == "stem" and one(spark, A.annotation_name(F.lit("u"), F.lit("given"))) == "given"


def test_prompts(spark):
    cols = {"strappy": F.lit(True), "bow": F.lit("True"), "fur": F.lit(None)}
    block = lambda toe, c, e: one(spark, P.tag_block(F.lit(toe).cast("string"), F.lit(""), c, e))
    assert block("round", P.true_names(["strappy"], cols), P.true_names(["fur", "bow"], cols)) == "Toe shape: round\nConstruction: strappy\nEmbellishments: bow"
    assert block(None, P.true_names([], cols) if False else F.array().cast("array<string>"), F.array().cast("array<string>")) == "(no tags available)"


def test_null_labels_are_a_label(spark):
    c = counts(spark, [("a", "a"), (None, None), (None, "a"), ("a", None), ("b", "a")])
    rows = {r.label: r for r in E.classification_report(c).collect()}
    assert set(rows) == {"a", "b", None, "macro avg", "weighted avg", "accuracy"} and E.classification_report(c).count() == 6
    assert (rows[None].precision, rows[None].recall, rows[None].support) == (0.5, 0.5, 2) and rows["b"].support == 1
    assert rows["accuracy"].f1 == pytest.approx(0.4) and E.accuracy(c).first().accuracy == pytest.approx(0.4)
    assert rows["macro avg"].recall == pytest.approx((0.5 + 0.5 + 0) / 3)
    assert E.top_confusions(c).count() == 3
    assert {r.label for r in E.per_class_accuracy(c).collect()} == {"a", "b", "OVERALL"}


def test_a_grid_of_many_classes_is_made_in_tasks(spark):
    classes = [f"c{i}" for i in range(300)]
    grid = E.confusion_matrix(counts(spark, [("c1", "c2"), ("c1", "c2"), ("c1", "c1"), ("zz", "c1")]), classes)
    assert grid.count() == 90_000 and sorted((r.gt, r.pred, r.n, round(r.share, 3)) for r in grid.where("n > 0").collect()) == [("c1", "c1", 1, 0.333), ("c1", "c2", 2, 0.667)]


class Flaky:
    """Answers at the second try; never for the row bad."""

    def __init__(self):
        self.tries = {}

    def __call__(self, row, prompt):
        n = self.tries[row["name"]] = self.tries.get(row["name"], 0) + 1
        if row["name"] == "bad" or n < 2:
            raise ValueError("busy")
        return '{"description": "Round shoe", "heel_name": "cone", "heel_alternative_names": ["c1"]}'


def test_client_batches_keep_failed_rows(spark):
    rows = spark.createDataFrame([("a", True), ("bad", False)], "name string, grounded boolean")
    out = {r.name: r for r in T.tag_batch(rows, Flaky, "p", attempts=3, delay=0.0, partitions=2).collect()}
    assert out["a"].attempts == 2 and out["a"].error is None and out["bad"].raw is None and out["bad"].attempts == 3
    d = {r.name: (r.description, r.grounded, r.prompt_version) for r in T.describe_batch(rows, Flaky, F.lit("g"), F.lit("u"), "v2", delay=0.0).collect()}
    assert d == {"a": ("Round shoe", True, "v2"), "bad": ("", False, "v2")}
    p = {r.name: (r.heel_name, r.heel_alternative_names, r.toe_name) for r in T.probe_batch(rows, Flaky, "heel", delay=0.0).collect()}
    assert p == {"a": ("cone", ["c1"], None), "bad": (None, None, None)}


def test_pending_twice_is_once(spark):
    catalog = spark.createDataFrame([("a", "x/a.jpg"), ("a", "y/a.jpg"), ("b", "x/b.jpg"), ("f", "x/f.jpg")], "name string, path string")
    done = spark.createDataFrame([("b", "t"), ("f", "")], "name string, text string")
    assert [tuple(r) for r in J.pending(catalog, done).collect()] == [("a", "x/a.jpg")]
    assert sorted(r.name for r in J.pending(catalog, done, True, F.col("text") == "").collect()) == ["a", "f"]
    assert J.pending(catalog, catalog).count() == 0


def test_scoring_heads(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 4))
    head, sub = M.LinearHead(["p", "q"], rng.normal(size=(4, 2)), np.zeros(2)), M.LinearHead(["u", "v", "w"], rng.normal(size=(4, 3)), np.zeros(3))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "name long, features array<double>")
    got = {r.name: r for r in M.score_cascade(df, head, {"p": sub}).collect()}
    for i, r in enumerate(x):
        k = (r @ head.weights).argmax()
        assert got[i].category == head.classes[k]
        assert got[i].subcategory == (sub.classes[(r @ sub.weights).argmax()] if k == 0 else "unknown") and (got[i].subcategory_conf == 0) == (k == 1)
    labelled = df.withColumn("label", F.when(F.get("features", F.lit(0)) > 0, "pos").otherwise("neg"))
    fitted = M.fit_head(labelled, "label", ["neg", "pos"], column="features")
    assert np.mean([(fitted(r[None])[0].argmax() == 1) == (r[0] > 0) for r in x]) > 0.95
    s = one(spark, R.softmax_predict(F.array(F.lit(1.0), F.lit(1.0)), ["a", "b"]))
    assert (s.prediction, s.confidence, s.probs) == ("a", 0.5, [0.5, 0.5]) and one(spark, R.sigmoid_predict(F.lit(0.0))).pred == 1


def test_fit_head_scores_all_and_refuses_too_many_labels(spark, tmp_path):
    from tagflow.plans.label_queries import fit_head

    schema = "vec_id long, embedding array<float>, label int"
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    rows = [(i, [float(i % 2), 1.0 - i % 2], None if i >= 40 else i % 2) for i in range(50)]
    spark.createDataFrame(rows, schema).write.parquet(f"{few}/embeddings.parquet")
    out = {r.vec_id: r for r in fit_head(spark, few).collect()}
    assert set(out) == set(range(50)) and all(r.prediction == str(i % 2) for i, r in out.items())
    assert all((r.label, r.split) == ((None, None) if i >= 40 else (str(i % 2), "train" if i % 4 else "val")) for i, r in out.items())
    spark.createDataFrame([(i, [1.0], i) for i in range(1001)], schema).write.parquet(f"{many}/embeddings.parquet")
    with pytest.raises(ValueError, match="more than 1000 labels"):
        fit_head(spark, many)


def numpy_fit(x, y, positive, reg, steps=4000):
    """The same objective by Newton's method for each attribute alone."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    out = np.zeros((x1.shape[1], y.shape[1]))
    shrink = reg * np.append(np.ones(x.shape[1]), 0.0)
    for a in range(y.shape[1]):
        w = np.where(y[:, a] == 1, positive[a], 1.0)
        for _ in range(60):
            p = 1 / (1 + np.exp(-x1 @ out[:, a]))
            gradient = x1.T @ (w * (p - y[:, a])) / len(x) + shrink * out[:, a]
            hessian = (x1 * (w * p * (1 - p))[:, None]).T @ x1 / len(x) + np.diag(shrink)
            out[:, a] -= np.linalg.solve(hessian, gradient)
    return out


def test_multi_head_equals_a_numpy_fit(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 5))
    true = rng.normal(size=(5, 3))
    y = (x @ true + rng.logistic(size=(300, 3)) - [0, 2, 1] > 0).astype(float)
    attrs, positive = ["a", "b", "c"], [1.0, 4.0, 0.5]
    rows = [(i, r.tolist(), [a for a, f in zip(attrs, f_) if f] if i % 50 or f_.any() else None) for i, (r, f_) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*rows, (999, None, ["a"])], "id long, embedding array<double>, labels array<string>").repartition(6)
    head = M.fit_multi_head(df, "labels", attrs, dict(zip(attrs, positive)), steps=(0.01,))
    want = numpy_fit(x, y, positive, 0.01)
    assert np.abs(np.vstack([head.weights, head.bias]) - want).max() < 1e-3  # the stated tolerance
    # differences of the loss
    theta = rng.normal(size=(6, 3))
    value, slope = M.multi_loss(x, y, np.array(positive), theta)
    for at in [(0, 0), (3, 1), (5, 2)]:
        step = np.zeros_like(theta)
        step[at] = 1e-6
        assert slope[at] == pytest.approx((M.multi_loss(x, y, np.array(positive), theta + step)[0] - M.multi_loss(x, y, np.array(positive), theta - step)[0]) / 2e-6, rel=1e-4, abs=1e-4)
    # shrinkage by val, thresholds by the sweep
    parted = df.withColumn("split", F.when(F.col("id") % 3 == 0, "val").otherwise("train"))
    chosen = M.fit_multi_head(parted, "labels", attrs, steps=(100.0, 0.01), split="split")
    assert np.abs(chosen.weights).max() > 0.3  # not the one that shrinks all to nothing
    found = {r.attr: (r.threshold, r.f1) for r in M.head_thresholds(parted.where("split = 'val' AND embedding IS NOT NULL"), chosen, "labels").collect()}
    assert set(found) == set(attrs) and all(0.1 <= t <= 0.9 and f > 0.5 for t, f in found.values())


def test_multi_head_of_no_rows_and_of_one_kind(spark):
    df = spark.createDataFrame([([1.0, 2.0], ["a"]), ([0.0, 1.0], ["a"])], "embedding array<double>, labels array<string>")
    head = M.fit_multi_head(df, "labels", ["a", "b"], steps=(0.1,))
    z = head(np.array([[1.0, 2.0]]))[0]
    assert z[0] > 2 and z[1] < -2
    assert M.fit_multi_head(df.limit(0), "labels", ["a"]).bias.tolist() == [0.0]


def test_splits_keep_rows_with_null_labels_and_names(spark):
    rows = [(f"n{i}" if i % 11 else None, "a" if i % 3 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "name string, label string")
    out = S.stratified_split(df, "label").collect()
    assert sorted(((r.name, r.label) for r in out), key=repr) == sorted(rows, key=repr)
    assert sum(r.split == "val" for r in out) == 10 and sum(r.split == "val" for r in out if r.label is None) in (3, 4)
    assert sum(r.split == "val" for r in S.random_split(df).collect()) == 10 and S.random_split(df).count() == 50


def by_rank(rows, frac, seed=42):
    """Of rows (name, label), how many of each class are val by largest remainder, and which by rank of md5."""
    order = lambda n: ("" if n is None else hashlib.md5(f"{seed}|{n}".encode()).hexdigest(), n or "")
    classes = sorted({x for _, x in rows}, key=lambda x: (x is not None, x))
    want = -(-len(rows) * round(frac * 100) // 100)
    exact = {c: want * sum(x == c for _, x in rows) / len(rows) for c in classes}
    quota = {c: int(exact[c]) for c in classes}
    for c in sorted(classes, key=lambda c: (-round(exact[c] - quota[c], 9), classes.index(c)))[: want - sum(quota.values())]:
        quota[c] += 1
    return {c: [order(n) for n in sorted((n for n, x in rows if x == c), key=order)[: quota[c]]] for c in classes}


@pytest.mark.parametrize("cell", [3, 10_000])
def test_split_cuts_equal_ranks(spark, monkeypatch, cell):
    monkeypatch.setattr(S, "CELL_ROWS", cell)  # several rounds of digits
    rows = [(f"n{i}" if i % 13 else None, ["a", "b", None, "a", "a"][i % 5]) for i in range(400)] + [("twin", "b")] * 150 + [("one", "c")]
    df = spark.createDataFrame(rows, "name string, label string").repartition(5)
    order = lambda n: ("" if n is None else hashlib.md5(f"42|{n}".encode()).hexdigest(), n or "")
    for frac in (0.0, 0.2, 0.5):
        got = S.stratified_split(df, "label", frac).collect()
        assert sorted(((r.name, r.label) for r in got), key=repr) == sorted(rows, key=repr)
        for label, names in by_rank(rows, frac).items():
            assert sorted(order(r.name) for r in got if r.label == label and r.split == "val") == names
        flat = S.random_split(df, frac).collect()
        names = sorted(order(n) for n, _ in rows)[: -(-len(rows) * round(frac * 100) // 100)]
        assert len(flat) == len(rows) and sorted(order(r.name) for r in flat if r.split == "val") == names


def test_splits_do_not_shuffle_rows(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("name"), (F.col("id") % 3).cast("string").alias("label"))
    for out in (S.random_split(df), S.stratified_split(df, "label")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"(?<!Broadcast)Exchange|Sort|Window", plan), plan


def test_scratch_on_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tagflow.sources.scratch import shared_dir

    session = lambda **c: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: c.get(k.split(".")[1], d)))
    for master in ("local-cluster[2,1,1024]", "spark://h:7077", "yarn"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master=master))
        assert shared_dir(session(master=master, checkpoint="s3a://b/c")) == "s3a://b/c"
    assert shared_dir(session(master="local[2]")).startswith("file:/") and shared_dir(session(master="local")) == shared_dir(session(master="local[2]"))


def test_intake_runs_once_per_name(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    add = lambda rows: spark.createDataFrame(rows, "name string, v int").coalesce(1).write.mode("append").parquet(src)
    add([("a", 2), ("a", 1), ("b", 3), (None, 7)])
    stream = spark.readStream.schema("name string, v int").parquet(src)
    worked = []

    def work(df):
        worked.append(sorted(((r.name, r.v) for r in df.collect()), key=repr))
        return df

    def run(checkpoint=ck):
        query = incremental_intake(stream, work, out, checkpoint)
        query.awaitTermination()
        return query

    assert read_done(spark, out) is None
    run()
    run()
    assert worked == [[("a", 1), ("b", 3), (None, 7)]]
    add([("b", 9), ("c", 4)])
    query = run()
    assert worked[1:] == [[("c", 4)]]
    seeds = [s["numInputRows"] for p in query.recentProgress for s in p["sources"] if "/seed/" in s["description"]]
    assert seeds and sum(seeds) == 0  # no done row is read
    run(ck + "-new")  # a lost checkpoint repeats no work: the new one is seeded
    assert worked[2:] in ([], [[]])
    add([("a", 5), ("d", 6)])
    run(ck + "-new")
    assert worked[-1] == [("d", 6)]
    assert sorted((repr(r.name), r.v) for r in read_results(spark, out).collect()) == [("'a'", 1), ("'b'", 3), ("'c'", 4), ("'d'", 6), ("None", 7)]


def test_a_repeated_batch_writes_in_its_own_place(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.createDataFrame([(str(i), i) for i in range(20)], "name string, v int").write.parquet(src)
    stream = spark.readStream.schema("name string, v int").parquet(src)
    stages = []

    def work(df):
        stages.append(1)
        if len(stages) == 1:  # its rows arrive, but the batch is not committed
            df.write.parquet(f"{out}/intake_run=dead/intake_batch=0")
            import shutil

            shutil.rmtree(f"{out}/intake_run=dead")
            raise RuntimeError("lost")
        return df

    with pytest.raises(Exception, match="lost"):
        incremental_intake(stream, work, out, ck).awaitTermination()
    for _ in range(2):
        incremental_intake(stream, work, out, ck).awaitTermination()
    assert sorted(int(r.name) for r in read_results(spark, out).collect()) == list(range(20))
    # the last batch once more, as after a driver that died between its write and its commit
    os.remove(max((str(p) for p in (tmp_path / "ck" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(os.path.basename(p))))
    for crc in (tmp_path / "ck" / "commits").glob(".*.crc"):
        os.remove(crc)
    incremental_intake(stream, work, out, ck).awaitTermination()
    assert len(stages) == 3 and sorted(int(r.name) for r in read_results(spark, out).collect()) == list(range(20))


def test_flows(spark):
    from tagflow.sources.catalog import catalog_from_paths

    images = catalog_from_paths(spark.createDataFrame([(f"r/{c}/s/{c}{i}.jpg",) for c in "xy" for i in range(10)], "path string"), root="r")
    built = flows.dataset_build(images, ["x", "y"], {})
    assert built["manifest"].where("split = 'val'").count() == 4 and {r.weight for r in built["class_weights"].collect()} == {0.5}
    aliases = spark.createDataFrame([("a", "A"), ("aa", "A"), ("b", "B")], "alias string, canonical string")
    gt, pred = spark.createDataFrame([("1", "a"), ("2", "b")], "name string, gt string"), spark.createDataFrame([("1", "AA "), ("2", "zz")], "name string, pred string")
    out = flows.evaluation(gt, pred, aliases)
    t = out["taxonomy"].first()
    assert (t.raw_rate, t.clean_rate, t.n_clean, t.n_excluded) == (0.5, 1.0, 1, 1)
