import random
from collections import Counter

import pytest

import corpus_pipeline as P
from tests.llm.conftest import make_text
from tests.llm.test_near import brute, shingle_set


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, junk, near copies and documents with a test item, as tables in a folder."""
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(300):
        rows.append((i, make_text(rng, rng.randrange(20, 90)), "en", f"s{i % 4}", "clean"))
    for i in range(300, 360):
        rows.append((i, make_text(rng, 60).upper().replace(" ", "!! "), "en", "s0", "junk"))
    for i in range(360, 380):
        w = rows[i - 360][1].split()
        w[-1] = "last"
        rows.append((i, " ".join(w), "en", "s1", "copy"))
    items = [(k, make_text(rng, 30)) for k in range(5)]
    for i in range(380, 395):
        rows.append((i, f"{make_text(rng, 40)} {items[i % 5][1]} {make_text(rng, 40)}", "en", "s2", "leak"))
    rows += [(400, None, None, None, "empty"), (401, "", "en", "s1", "empty")]
    labels = [(r[0], int(r[4] != "junk"), 0) for r in rows]
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r[:4], len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, {r[0]: r for r in rows}, items


def test_stages_keep_columns_and_take_effect(spark, corpus):
    d, rows, items = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    left = []
    for k, (_, stage) in enumerate(P.STAGES):
        out = P.written(stage(spark, docs, d), "stage")
        if k < len(P.STAGES) - 1:
            assert out.columns == docs.columns
            left.append([r.doc_id for r in out.collect()])
            docs = out
    kinds = [Counter(rows[i][4] for i in ids) for ids in left]
    assert kinds[0]["junk"] <= 3 and kinds[0]["clean"] >= 295 and kinds[0]["copy"] >= 18
    first = [(i, rows[i][1]) for i in left[0]]
    assert sorted(left[1]) == sorted({c for _, _, c in brute(first)})
    hit = lambda t: any(100 * len(shingle_set(t) & shingle_set(q)) >= 80 * len(shingle_set(q)) for _, q in items)
    assert sorted(left[2]) == sorted(i for i in left[1] if not hit(rows[i][1])) and kinds[2]["leak"] == 0
    assert max(Counter(left[3]).values()) <= 3 and set(left[3]) <= set(left[2]) and kinds[3]["empty"] == 0
    assert Counter(r.doc_id for r in out.collect()) == Counter(left[3])
    assert sorted(map(tuple, P.run(spark, d).collect())) == sorted(map(tuple, out.collect()))


def test_stages_take_odd_and_empty_tables(spark, corpus, odd_docs, no_docs):
    d = corpus[0]
    for docs in (odd_docs, no_docs):
        for k, (_, stage) in enumerate(P.STAGES):
            out = P.written(stage(spark, docs, d), "stage")
            assert k == len(P.STAGES) - 1 or out.columns == docs.columns
            docs = out if k < len(P.STAGES) - 1 else docs
