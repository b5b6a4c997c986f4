import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagflow.llm import byte_cnn, language_id
from tagflow.llm.deleted_interpolation import BUCKETS, frequency_bucket, interpolated_scores, learn_weights
from tagflow.llm.queries import remainder
from tests.llm.conftest import make_text


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def tokens(text):
    return [*(text or "").encode().lower().split(), "END"]


def brute_counts(texts):
    one, two = Counter(), Counter()
    for text in texts:
        t = tokens(text)
        one.update(t)
        two.update(zip(["START", *t], t))
    one["START"] = one["END"]
    return one, two


def exact_weights(tuning, one, two, steps=200):
    """EM over the tokens of the tuning texts, one by one, with the counts of the other texts."""
    n = sum(c for w, c in one.items() if w != "START")
    seen = []
    for text in tuning:
        t = tokens(text)
        for h, w in zip(["START", *t], t):
            parts = (two[h, w] / one[h] if one[h] else 0.0, one[w] / max(n, 1), float(one[w] == 0))
            seen.append((int(frequency_bucket(np.array([one[h]]))[0]), parts))
    weights = {k: [0.0, 0.5, 0.5] if k == 0 else [1 / 3] * 3 for k in range(BUCKETS)}
    for _ in range(steps):
        got = {k: [0.0 if k == 0 else 0.5, 0.5, 0.5] for k in range(BUCKETS)}
        for k, parts in seen:
            share = [a * b for a, b in zip(weights[k], parts)]
            total = sum(share)
            for j in range(3):
                got[k][j] += share[j] / total if total else 0.0
        weights = {k: [x / sum(v) for x in v] for k, v in got.items()}
    return weights


def brute_scores(rows):
    """The same model by dictionaries, with weights by exact EM on counts from which the tuning texts are left out."""
    held = {k: k[0] is None or crc(k[0], 10) == 0 for k in rows}
    tune = {k: not held[k] and crc(k[0], 10) == 1 for k in rows}
    one, two = brute_counts([t for i, t in rows if not held[i, t]])
    weights = exact_weights([t for i, t in rows if tune[i, t]], *brute_counts([t for i, t in rows if not held[i, t] and not tune[i, t]]))
    n, v = sum(c for w, c in one.items() if w != "START"), len([w for w in one if w != "START" and one[w]])
    out = []
    for k in rows:
        t = tokens(k[1])
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = 0.0
        for h, w in zip(["START", *t], t):
            lam = weights[int(frequency_bucket(np.array([one[h]]))[0])]
            p = lam[0] * (two[h, w] / one[h] if one[h] else 0) + lam[1] * one[w] / max(n, 1) + lam[2] * (one[w] == 0)
            score += math.log10(p) if n else 0.0
        out.append((k[0], held[k], len(t), sum(one[w] > 0 for w in t), n, base, score))
    return out, tune, weights


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_lm_scores_equal_dictionaries(spark, odd_docs, monkeypatch, bits):
    """With trees of many levels and of one. Estimates are quantised for EM, so weights and scores differ a little."""
    import tagflow.llm.deleted_interpolation as D

    rng = random.Random(3)
    more = [(i, make_text(rng, rng.randrange(60))) for i in range(100, 220)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).repartition(3)
    learned = []
    monkeypatch.setattr(D, "learn_weights", lambda *a: learned.append(learn_weights(*a)) or learned[0])
    got = [tuple(r) for r in interpolated_scores(docs, remainder(10) == 0, remainder(10) == 1, block_bytes=3000, bits=bits).collect()]
    want, tune, weights = brute_scores([(r.doc_id, r.text) for r in docs.collect()])
    assert any(tune.values())
    assert learned[0] == pytest.approx(np.array([weights[k] for k in range(BUCKETS)]), abs=0.03)
    key = lambda r: repr(r[:5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6], rel=0.01, abs=0.01)
    held = [r for r in got if r[1] and r[2] > 20]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_lm_without_rows_or_training(no_docs, odd_docs):
    assert interpolated_scores(no_docs, F.lit(False), F.lit(False)).count() == 0
    assert {(r.train_tokens, r.n_known, r.score, r.base_score) for r in interpolated_scores(odd_docs, F.lit(True), F.lit(False)).collect()} == {(0, 0, 0.0, 0.0)}


def test_em_finds_the_mixture():
    rng = np.random.default_rng(1)
    # one context bucket; tokens explained by the bigram, the unigram or neither
    kinds = rng.choice(3, 20_000, p=[0.6, 0.3, 0.1])
    two, one = np.where(kinds == 0, 1, 0), np.where(kinds == 2, 0, 21)
    code = (5 * 1024 + two) * 1024 + one
    values, counts = np.unique(code, return_counts=True)
    w = learn_weights(values, counts.astype(float))[5]
    assert w.sum() == pytest.approx(1) and w[2] == pytest.approx(0.1, abs=0.01) and w[0] > 0.55
    assert learn_weights(np.zeros(0, np.int64), np.zeros(0)).shape == (BUCKETS, 3)


def quality_rows(rng, n):
    rows = []
    for i in range(n):
        good = rng.random() < 0.8
        text = make_text(rng, rng.randrange(5, 90))
        rows.append((i, text if good else text.upper().replace(" ", "!! "), int(good)))
    return rows


def test_classifier_learns_and_scores_every_row(spark, odd_docs, no_docs):
    rows = quality_rows(random.Random(2), 500)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows] + [(1, None, 0), (None, 1, 0), (2, 7, 0), (10**6, 1, 0)], "doc_id long, quality int, toxic int")
    out = byte_cnn.quality_scores(docs, labels, remainder(5) == 0, rows_each=60, epochs=6).collect()
    assert sorted(r.doc_id for r in out) == list(range(500)) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) for r in out) and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert byte_cnn.quality_scores(odd_docs, labels, remainder(5) == 0, rows_each=60, epochs=1).count() == odd_docs.count()
    assert byte_cnn.quality_scores(no_docs, labels, remainder(5) == 0, rows_each=60, epochs=1).count() == 0
    assert {r.score for r in byte_cnn.quality_scores(odd_docs, labels.limit(0), remainder(5) == 0).collect()} == {0.5}
    assert byte_cnn.keep_good(odd_docs, labels.limit(0), remainder(5) == 0).columns == odd_docs.columns


def test_quality_learns_from_long_texts(spark):
    rng = random.Random(23)
    rows = [(i, (f"{make_text(rng, 3000)} " if i % 2 else "@@ ## !! $$ " * 1200), i % 2) for i in range(60)]
    assert all(len(t.encode()) > 12_288 for _, t, _ in rows)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    kept = {r.doc_id for r in byte_cnn.keep_good(docs, labels, remainder(5) == 0, epochs=40).collect()}
    assert kept == {r[0] for r in rows if r[2]}
    few = byte_cnn.fit(docs, labels, F.lit(True), bytes_each=40_000, epochs=1)
    assert few.constant is None
    with pytest.raises(ValueError, match="label 0 fits"):
        byte_cnn.fit(docs, labels, F.lit(True), bytes_each=12_288)


def test_gradients_equal_differences():
    rng = np.random.default_rng(5)
    model = byte_cnn.Model(rng.normal(0, 0.3, (byte_cnn.WIDTH, 256, byte_cnn.FILTERS)), rng.normal(0, 0.3, byte_cnn.FILTERS), rng.normal(0, 0.5, 2 * byte_cnn.FILTERS), 0.2)
    model.trace = True
    texts = [b"one two three", b"", b"abcdef" * 300, b"zz"]
    y, weight = np.array([1.0, 0.0, 1.0, 0.0]), np.array([1.0, 2.0, 0.5, 1.0])

    def loss():
        at = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        best, chunk_at, _ = byte_cnn._chunk_features(model, np.frombuffer(b"".join(texts), np.uint8), at)
        _, feature = byte_cnn._document(model, best.astype(float), chunk_at)
        p = 1 / (1 + np.exp(-(feature @ model.out + model.out_bias)))
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean() + byte_cnn.PENALTY * (model.out**2).sum() / 2

    grad = byte_cnn.gradients(model, texts, y, weight)
    assert np.count_nonzero(grad["tables"]) > 50
    for name in ("tables", "bias", "out"):
        part = getattr(model, name)
        flat = np.flatnonzero(grad[name])
        for k in rng.choice(flat, min(12, len(flat)), replace=False):
            where = np.unravel_index(k, part.shape)
            old = part[where]
            got = []
            for step in (1e-3, -1e-3):
                part[where] = old + step
                got.append(loss())
            part[where] = old
            assert grad[name][where] == pytest.approx((got[0] - got[1]) / 2e-3, rel=0.05, abs=1e-3), (name, where)
    losses = []
    for _ in range(30):
        losses.append(loss())
        for name, g in byte_cnn.gradients(model, texts, y, weight).items():
            setattr(model, name, getattr(model, name) - 0.1 * g)
    assert losses[-1] < losses[0]


def test_a_text_of_many_steps():
    """A text longer than a step has the features of its chunks, wherever a sign stands."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    model = byte_cnn.Model(rng.normal(0, 0.3, (byte_cnn.WIDTH, 256, byte_cnn.FILTERS)).astype(np.float32), np.zeros(byte_cnn.FILTERS, np.float32), rng.normal(0, 1, 2 * byte_cnn.FILTERS), 0.1)
    raw = rng.integers(97, 123, 700_000).astype(np.uint8)
    raw[byte_cnn.STEP - 3 : byte_cnn.STEP + 3] = np.frombuffer(b"#!?#!?", np.uint8)
    text = raw.tobytes().decode()
    padded = np.concatenate([raw, np.zeros(byte_cnn.WIDTH - 1, np.uint8)])
    acts = sum(model.tables[k][padded[k : k + len(raw)]] for k in range(byte_cnn.WIDTH))
    chunks = np.tanh(np.array([acts[i : i + byte_cnn.CHUNK].max(0) for i in range(0, len(acts), byte_cnn.CHUNK)]))
    want = 1 / (1 + np.exp(-(np.concatenate([chunks.mean(0), chunks.max(0)]) @ model.out + model.out_bias)))
    assert byte_cnn.probabilities(model, pa.array(["short", text, None])).tolist()[1] == pytest.approx(want, abs=1e-5)


def test_odd_rows_get_defined_scores(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (7, 1), (8, 0), (11, 0), (12, 0)], "doc_id long, quality int")
    scores = byte_cnn.quality_scores(odd_docs, labels, F.lit(False), epochs=2).collect()
    assert len(scores) == odd_docs.count() and all(r.predicted == int(r.score >= 0.3) for r in scores)
    # a null text scores as an empty one, equal texts as each other, a null id like any other
    empty = [r.score for r in scores if r.doc_id in (4, 5)]
    assert len(set(empty)) == 1 and len({r.score for r in scores if r.doc_id in (1, 2)}) == 1 and len({r.score for r in scores if r.doc_id == 7}) == 1
    by_null = sorted(r.score for r in scores if r.doc_id is None)
    assert set(by_null) == {empty[0], next(r.score for r in scores if r.doc_id == 1)}
    kept = byte_cnn.keep_good(odd_docs, labels, F.lit(False), threshold=-1.0, epochs=1)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, odd_docs.collect()))
    lang = {r.doc_id: (r.held_out, r.lang_pred) for r in language_id.predict(odd_docs.where("doc_id IS NOT NULL"), F.lit(True)).collect()}
    assert [lang[i][1] for i in (4, 5, 6)] == ["und"] * 3 and lang[1] == (False, "en") and lang[8] == lang[9] and {x for _, x in lang.values()} <= {"en", "de", "fr", "und"}


def test_chunks_cover_the_whole_text():
    """A sign anywhere in a long text is seen, and the features equal a plain loop's."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    model = byte_cnn.Model(rng.normal(0, 0.3, (byte_cnn.WIDTH, 256, byte_cnn.FILTERS)).astype(np.float32), np.zeros(byte_cnn.FILTERS, np.float32), rng.normal(0, 1, 2 * byte_cnn.FILTERS), 0.1)
    texts = ["", "a", "abc" * 400, "x" * byte_cnn.CHUNK, "y" * (byte_cnn.CHUNK + 1), None, "z" * 3000 + "!?" + "z" * 50]

    def plain(text):
        raw = (text or "").encode() + b"\0" * (byte_cnn.WIDTH - 1)
        if len(raw) < byte_cnn.WIDTH:
            raw = raw + b"\0"
        acts = np.array([sum(model.tables[k][raw[i + k]] for k in range(byte_cnn.WIDTH)) for i in range(max(1, len(raw) - byte_cnn.WIDTH + 1))])
        chunks = np.tanh(np.array([acts[i : i + byte_cnn.CHUNK].max(0) for i in range(0, len(acts), byte_cnn.CHUNK)]))
        return 1 / (1 + np.exp(-(np.concatenate([chunks.mean(0), chunks.max(0)]) @ model.out + model.out_bias)))

    assert byte_cnn.probabilities(model, pa.array(texts, pa.string())) == pytest.approx([plain(t) for t in texts], abs=1e-5)


def test_language_learns_only_from_its_part(spark, odd_docs, no_docs):
    rng = random.Random(4)
    syllables = {"aa": "ba lo ki".split(), "bb": "tsch ön grz".split(), "cc": "ñu qué lle".split()}
    rows = [(i, " ".join("".join(rng.choice(syllables[x]) for _ in range(3)) for _ in range(rng.randrange(1, 30))), x) for i in range(300) for x in [rng.choice(list(syllables))]]
    rows += [(1000, None, "aa"), (1001, "12 34 !", "aa"), (1002, "", None), (None, "balo", "aa"), (1003, "ba\x00lo\x00", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id.predict(docs, remainder(4) != 2).collect()}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out.values())
    assert [out[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"]
    truth = {r[0]: r[2] for r in rows[:300]}
    held = [i for i in range(300) if crc(i, 4) == 2]
    assert all(out[i].held_out == (crc(i, 4) == 2) for i in range(300)) and np.mean([out[i].lang_pred == truth[i] for i in held]) > 0.98
    lied = docs.withColumn("lang", F.when(remainder(4) == 2, "zz").otherwise(F.col("lang")))
    assert {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(lied, remainder(4) != 2).collect()} == {k: (r.lang_pred, r.score) for k, r in out.items()}
    assert language_id.predict(odd_docs, remainder(4) != 2).count() == odd_docs.count() and language_id.predict(no_docs, remainder(4) != 2).count() == 0
    assert {r.lang_pred for r in language_id.predict(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()} == {"und"}


def naive_bayes(rows):
    """Multinomial naive Bayes by dictionaries of hashed n-grams: doc_id -> (language or und, posterior)."""
    def grams(text):
        spaced = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
        letters = [ord(c) for c in " " + " ".join(spaced.split()) + " "]
        if not spaced.strip():
            return []
        out = []
        for size in language_id.SIZES:
            for i in range(len(letters) - size + 1):
                if size == 1 and letters[i] == 32:
                    continue
                h = size
                for x in letters[i : i + size]:
                    h = (h ^ x) * 0x9E3779B1 % 2**32
                    h ^= h >> 15
                out.append(h >> (32 - language_id.BITS))
        return out

    counts = {}
    for i, text, lang in rows:
        if i is not None and crc(i, 4) != 2 and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    log = {x: (lambda c, n: lambda g: math.log((c[g] + 0.1) / n))(c, sum(c.values()) + 0.1 * language_id.CELLS) for x, c in counts.items()}
    out = []
    for i, text, _ in rows:
        own = grams(text)
        total = {x: sum(map(f, own)) for x, f in log.items()}
        best = min(total, key=lambda x: (-total[x], x))
        out.append((i, best, 1 / sum(math.exp(t - total[best]) for t in total.values())) if own else (i, "und", 0.0))
    return out


def test_language_equals_naive_bayes_by_dictionaries(spark):
    rng = random.Random(14)
    syllables = {"aa": "ba lo ki en".split(), "bb": "tsch ön grz en".split(), "cc": "ñu qué lle en".split()}
    rows = [(i, " ".join("".join(rng.choice(syllables[x]) for _ in range(3)) for _ in range(rng.randrange(9))) + rng.choice(["", " ", "!1", "\n"]), x) for i in range(120) for x in [rng.choice(list(syllables))]]
    rows += [(500, None, "aa"), (501, "12", "bb"), (None, "balo", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs.repartition(1), remainder(4) != 2).collect()}
    many = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs.repartition(40), remainder(4) != 2).collect()}
    assert one == many
    for i, lang, score in naive_bayes(rows):
        assert one[i][0] == lang and one[i][1] == pytest.approx(score, abs=1e-3), i


def test_language_scores_do_not_depend_on_the_batch():
    """Not even over the bound between two steps."""
    rng = np.random.default_rng(0)
    matrix = np.rint(np.log(rng.dirichlet(np.ones(language_id.CELLS), 2).T) * 2**20).astype(np.int32)
    texts = ["Hello there", "x", "", "wörter und mehr " * 50, "?", "a long text of many steps " * 12_000]
    assert len(texts[-1]) > language_id.STEP
    alone = [language_id._score(["a", "b"], matrix, [t]) for t in texts]
    together = language_id._score(["a", "b"], matrix, texts)
    assert together[0] == [a[0][0] for a in alone] and together[1].tolist() == [a[1][0] for a in alone]
    small, language_id.STEP = language_id.STEP, 1 << 10
    assert language_id._score(["a", "b"], matrix, texts)[1].tolist() == together[1].tolist()
    language_id.STEP = small


def test_language_counts_of_many_languages(spark):
    rows = [(i, f"word{chr(97 + i % 26)} x", f"l{i % 300}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    langs, matrix = language_id.fit(docs, F.lit(True))
    assert len(langs) == 300 and matrix.shape == (language_id.CELLS, 300)
    with pytest.raises(ValueError, match="more than 299"):
        language_id.fit(docs, F.lit(True), 299)


def test_cnn_learns_from_labels_of_documents_that_are_here(spark):
    rng = random.Random(31)
    texts = [(i, make_text(rng, 30) if i % 2 else "### $$$ %%% " * 20) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1000 + i, i % 2) for i in range(3000)], "doc_id long, quality int")
    out = {r.doc_id: r.score for r in byte_cnn.quality_scores(docs, labels, F.lit(False), rows_each=30).collect()}
    assert min(out[i] for i in range(1, 40, 2)) > max(out[i] for i in range(0, 40, 2))
    with pytest.warns(UserWarning, match="labels of both kinds"):
        assert {r.score for r in byte_cnn.quality_scores(docs.where("doc_id % 2 = 1"), labels, F.lit(False)).collect()} == {1.0}
