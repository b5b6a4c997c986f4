import random

import pytest

from tagflow.llm.prefix_join import _candidates, jaccard_components, keep_one
from tagflow.llm.shared import components
from tests.llm.conftest import make_text


def shingle_set(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, percent=80):
    sets = [shingle_set(t) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and None not in (rows[a][0], rows[b][0]) and 100 * len(x & y) >= percent * len(x | y):
                p, q = top(rows[a][0]), top(rows[b][0])
                root[max(p, q)] = min(p, q)
    return sorted(((i, len(s), top(i) if i is not None else None) for (i, _), s in zip(rows, sets, strict=True)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def family(rng, start, n, length, edits):
    base = make_text(rng, length).split()
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        out.append((start + k, " ".join(w[: len(w) - rng.randrange(6)])))
    return out


@pytest.mark.parametrize("few,block", [(1, 2000), (2, 100_000), (16, 4 << 20)])
def test_components_equal_brute_force(spark, few, block):
    rng = random.Random(few)
    rows = family(rng, 100, 25, 80, 5) + family(rng, 200, 12, 30, 2) + family(rng, 300, 6, 200, 12)
    passage = make_text(rng, 60)
    rows += [(400 + i, passage + " " + make_text(rng, 60)) for i in range(20)]  # share much, but too little
    rows += [(500 + i, make_text(rng, 50)) for i in range(20)] + [(600, rows[3][1]), (601, rows[3][1])]
    stock = make_text(rng, 70).split()  # nine tenths of the text are the same in many, and nearly all of them unlinked
    rows += [(700 + i, " ".join(f"own{i}x{k}" for k in range(12)) + " " + " ".join(stock)) for i in range(60)]
    rows += family(rng, 800, 50, 60, 6)[1:]  # near copies without their original
    # same prefix and size, different sets: whether grouped or not, the links are the same
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(jaccard_components(df, few=few, block_bytes=block, sketch_bits=16)) == brute(rows)


def test_threshold_is_inclusive(spark):
    a = [f"w{i}" for i in range(13)]  # 9 shingles
    b = a[:12]  # 8 of them: 8 / 9 links
    c = [f"v{i}" for i in range(8)]  # 4 shingles
    d = c + ["new"]  # 5, of which 4 are shared: exactly 80 percent
    rows = [(i, " ".join(x)) for i, x in enumerate((a, b, c, d), 1)]
    out = {r.doc_id: r.component_id for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=16).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 3}


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(jaccard_components(odd_docs, sketch_bits=16)) == brute(rows)
    assert jaccard_components(no_docs, sketch_bits=16).count() == 0


def test_keep_one_keeps_columns_and_one_row_of_each_component(odd_docs):
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    first = {c for _, _, c in brute([(r.doc_id, r.text) for r in odd_docs.collect()]) if c is not None}
    assert ids == sorted([*first, None, None], key=repr)


def test_texts_of_one_id_are_one_document(spark):
    rng = random.Random(41)
    a, b, c = (make_text(rng, 60) for _ in range(3))
    rows = [(5, a, "x"), (5, b, "y"), (5, b, "w"), (3, a, "z"), (9, b, "v"), (2, c, "q"), (2, c, "p"), (None, c, "n"), (None, c, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert got(jaccard_components(df, sketch_bits=16)) == brute([r[:2] for r in rows])
    # 5 and 9 go with 3; of the equal rows of 2 the least stays, rows without an id stay
    assert sorted(map(tuple, keep_one(df).collect()), key=repr) == sorted([(3, a, "z"), (2, c, "p"), (None, c, "n"), (None, c, "n")], key=repr)
    alone = spark.createDataFrame([(5, a, "x"), (5, b, "y"), (6, c, None)], df.schema)
    assert sorted(map(tuple, keep_one(alone).collect()), key=repr) == sorted(map(tuple, alone.collect()), key=repr)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (None, 5), (7, 7)], "a long, b long")
    out = {r.node: r.component for r in components(links).collect()}
    assert out == {i: 0 for i in range(201)} | {900: 900, 901: 900}


def test_keep_one_with_columns_that_have_no_order(spark):
    rows = [(1, "a b c d e f g", {"k": 2}, "x"), (1, "a b c d e f g", {"k": 1}, "y"), (2, "other words here now", None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, `a.b` string")
    assert sorted((r.doc_id, r.tags, r["a.b"]) for r in keep_one(docs).collect()) == [(1, {"k": 1}, "y"), (2, None, "z")]


def test_candidates_in_a_worker_that_has_run_nothing_before(spark, monkeypatch):
    monkeypatch.setitem(spark.sparkContext.environment, "TAGFLOW_TEST_WORKERS", "new")  # workers of another environment are not reused
    members = spark.createDataFrame([(1, 1, 1, 10, 0, 0), (1, 2, 2, 10, 0, 1), (1, 1, 1, 10, 0, 1)], "at long, id long, comp long, n long, pos long, side int")
    assert [tuple(r) for r in members.groupBy("at").applyInArrow(_candidates(80), "at long, a long, b long").collect()] == [(1, 1, 2)]
