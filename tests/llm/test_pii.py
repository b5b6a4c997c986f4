import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tagflow.llm import pii_crf as P
from tagflow.llm.pii_crf import KINDS, NONE, Field, base_spans, fit, labelled_table, private_spans, shown, train, viterbi, words_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARDS = ["4984250489669609", "4337166598464399", "4111 1111 1111 1111", "5500-0000-0000-0004"]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    """The patterns as they stand."""
    digits = lambda x: re.sub("[^0-9]", "", x)
    ok = [lambda x: True, lambda x: all(int(p) <= 255 for p in x.split(".")), lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x)), lambda x: 9 <= len(digits(x)) <= 15]
    return [(k, m.start(), m.end()) for k, p in enumerate((EMAIL, IP, CARD, PHONE)) for m in p.finditer(text) if ok[k](m[0])]


def person(rng):
    kind = rng.randrange(4)
    return (kind, [f"user{rng.randrange(99)}.x@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)), rng.choice(CARDS[:2]), f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"][kind])


def test_rules_equal_their_patterns():
    rng = random.Random(2)
    alphabet = "aZ09..@@--+ ()%_,é12345\n"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(8000)]
    made += ["a@b@c.d", "a@b.c@d.e", "@x.y", "a.b@c..d", "1.2.3.4.5.6.7.8", "001.2.3.255 256.1.1.1", "1" * 20 + " 4111 1111 1111 1111", "4111-1111-1111-1111.5", "+1 (5) " + "2" * 9, "+1++12345678 9", "a@b.c-", *CARDS]
    for text in made:
        assert sorted(base_spans(text)[0]) == sorted(plain(text)), text
    assert sum(len(plain(t)) for t in made) > 200


def test_rules_stay_linear_on_long_runs():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "1 " * 100_000, "+1" + " " * 200_000, "a@" * 100_000):
        base_spans(text)


def test_viterbi_equals_all_ways():
    rng = np.random.default_rng(3)
    for gap in (0.0, 4.0):
        field = Field(np.zeros((3, P.CELLS, P.LABELS)), rng.normal(size=(P.LABELS, P.LABELS)))
        lens = [1, 0, 3, 5, 4, 1]
        text = np.repeat(np.arange(len(lens)), lens)
        emission = rng.normal(size=(len(text), P.LABELS))
        emission[:, NONE] += gap * rng.integers(0, 3, len(text))  # some words that can be nothing else
        got = viterbi(field, emission, text)
        for i, n in enumerate(lens):
            own = emission[text == i]
            value = lambda way: sum(own[k, y] for k, y in enumerate(way)) + sum(field.moves[a, b] for a, b in itertools.pairwise(way))  # noqa: B023, E731
            if n:
                best = max(itertools.product(range(P.LABELS), repeat=n), key=value)
                assert value(got[text == i]) == pytest.approx(value(best))
    assert len(viterbi(field, emission[:0], text[:0])) == 0


def test_slopes_equal_differences():
    rng = np.random.default_rng(4)
    w = words_of(pa.array(["a 12 b", "", "+1 (2) x y", "z"]))
    gold = rng.integers(0, P.LABELS, len(w.begins))
    emission, field = rng.normal(size=(len(gold), P.LABELS)), Field(np.zeros((3, P.CELLS, P.LABELS)), rng.normal(size=(P.LABELS, P.LABELS)))
    _, by_word, by_move = P._gradient(field, w, gold, emission)
    for x, slope, at in [(emission, by_word, (i, j)) for i in range(len(gold)) for j in range(P.LABELS)] + [(field.moves, by_move, (i, j)) for i in range(P.LABELS) for j in range(P.LABELS)]:
        values = []
        for d in (1e-5, -1e-5):
            x[at] += d
            values.append(P._gradient(field, w, gold, emission)[0])
            x[at] -= d
        assert slope[at] == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-5)


def test_equal_shapes_have_equal_features():
    words = ["abc", "x", "Ab.", "Éa", "1-22", "22-1", "+1", "(988)", "555-2485", "a@b.c", "9" * 25, "9" * 40, "ab12cd", "--a", "-a", "z" * 5000 + "1"]
    w = words_of(pa.array([" ".join(words)]))
    by_shape = {}
    for word, k in zip(words, w.around[0].tolist(), strict=True):
        own = P.features(P._shortened(word.encode()))
        assert by_shape.setdefault(k, own) == own or word.startswith("--")
    assert len(by_shape) == len({tuple(sorted(x)) for x in by_shape.values()})


def make_docs(rng, n, first=0):
    words = "the and of stone river Cloud märz is in on. to, 4.0 v2 chapter 12".split()
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        if i % 2:
            text.insert(rng.randrange(len(text)), person(rng)[1])
        rows.append((first + i, " ".join(text)))
    return rows


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.createDataFrame(make_docs(random.Random(8), 400), "doc_id long, text string")
    table = labelled_table(docs, sample_docs=10_000, each=60)
    assert {r.kind: r["count"] for r in table.groupBy("kind").count().collect()} == {0: pytest.approx(50, abs=20), 1: pytest.approx(50, abs=20), 2: pytest.approx(50, abs=20), 3: pytest.approx(50, abs=20), NONE: 60}
    return fit(table)


def test_spans_hold_the_rules_and_forms_that_they_do_not_know(spark, odd_docs, field):
    rng = random.Random(9)
    rows = make_docs(rng, 200, 1000)
    new = [(5000, "call (312) 555-1234 or 312-555-9876 now"), (5001, "card 4984/2504/8966/9609, thanks\nand +1 (988) 555-2485."), (5002, "not 4984250489669608 nor 300.1.1.1 nor 12-13 or (42)")]
    docs = odd_docs.select("doc_id", "text", "n_chars").union(spark.createDataFrame([(*r, 0) for r in rows + new], "doc_id long, text string, n_chars int")).repartition(3)
    got = private_spans(docs, field).collect()
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    by_id = {i: t for i, t in texts if i is not None and i not in (4, 5)}
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id in by_id:
            base = plain(by_id[r.doc_id])
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
            assert r.base_sha256 == hashlib.sha256(shown(base).encode()).hexdigest()
            assert set(shown(base).split(",")) - {""} <= set(r.spans.split(",")) and r.n_added == len(r.spans.split(",")) * bool(r.spans) - len(base)
            assert r.spans == shown([(KINDS.index(k), int(i), int(j)) for k, i, j in (s.split(":") for s in r.spans.split(",") if s)])
    spans = {r.doc_id: r.spans for r in got}
    assert spans[5000] == "phone:5:19,phone:23:35" and spans[5001] == "card:5:24,phone:37:54" and spans[5002] == ""
    assert sum(r.n_added for r in got if 1000 <= (r.doc_id or 0) < 1200) == 0  # clean texts stay clean
    assert [(r.spans, r.base_sha256) for r in got if r.doc_id == 4] == [("", hashlib.sha256(b"").hexdigest())]


def test_without_documents_or_labels(spark, no_docs):
    assert fit(labelled_table(no_docs)) is None
    assert private_spans(no_docs, None).collect() == []
    assert train([("nothing here", [])]) is None
    one = spark.createDataFrame([(None, "a@b.c")], "doc_id long, text string")
    assert [(r.doc_id, r.spans) for r in private_spans(one, None).collect()] == [(None, "email:0:5")]


def test_the_labelled_table_is_bounded_whatever_the_copies(spark):
    docs = spark.createDataFrame([(None, "same text with 1.2.3.4 in it")] * 500 + [(i, f"text {i} of a@b{i}.c") for i in range(300)], "doc_id long, text string")
    found = labelled_table(docs, sample_docs=100, each=20).collect()
    assert sum(r.kind == 1 for r in found) <= 1 and 0 < sum(r.kind == 0 for r in found) <= 20
