import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tagflow.llm import collocations as C
from tagflow.llm.automata import build, union, unpacked
from tagflow.llm.collocations import collocations


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, low = lang or "und", (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, found in f.items():
        frequent = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in frequent.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and found[p[i:j]] <= a}
        scored = []
        for p, a in frequent.items():
            score, k = min((1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("top,block", [(3, 16 << 20), (1000, 2000)])
def test_collocations_equal_counters(spark, odd_docs, monkeypatch, top, block):
    monkeypatch.setattr(C, "RANGE_WORDS", 500)  # several parts of a range
    rng = random.Random(4)
    words = "red Red fox,fox the. of of\tof é É naïve :x; a!b stop\x0bgo".split(" ")
    more = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(80))), rng.choice(["en", "de", None, "und"])) for i in range(60)]
    docs = odd_docs.select("doc_id", "text", "lang", "size").union(spark.createDataFrame([(*r, "clash") for r in more], "doc_id long, text string, lang string, size string")).repartition(3)
    got = collocations(docs, least=4, top=top, block_bytes=block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute([(r.lang, r.text) for r in docs.collect()], 4, top)
    assert any(len(r[2].split(" ")) == 5 for r in want) and {r[0] for r in want} >= {"en", "und"}
    assert sorted(map(tuple, got.collect())) == want


def test_collocations_of_nothing_and_of_rare_words(spark, no_docs, odd_docs):
    assert collocations(no_docs).collect() == []
    assert collocations(odd_docs, least=10**6).collect() == []


def test_score_is_exact_beyond_64_bits(spark):
    """As in collocations(): 1000 * a * n and l * r as decimals of 38 digits."""
    a, n, left, right = 10**13, 10**14 + 7, 10**13 + 3, 3 * 10**13
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").selectExpr(C.SCORE).first()
    assert row[0] == 1000 * a * n // (left * right)


def test_automata_share_states_and_sum_exactly():
    rng = np.random.default_rng(1)
    for length in (1, 2, 3, 5):
        total, automata = Counter(), []
        for _ in range(5):
            c = Counter(map(tuple, rng.integers(0, 5, (300, length)).tolist()))
            total.update(c)
            grams = np.array(sorted(c), np.uint64)
            made = unpacked(build(grams, np.array([c[tuple(x)] for x in grams.tolist()])).packed())
            assert (union([made])[0] == grams).all()
            automata.append(made)
        grams, n = union(automata)
        assert dict(zip(map(tuple, grams.tolist()), n.tolist(), strict=True)) == dict(total)
    # all pairs of ten words, each once: the second layer has one state
    pairs = np.array([(i, j) for i in range(10) for j in range(10)], np.uint64)
    made = build(pairs, np.ones(100, np.int64))
    assert len(made.begin[1]) == 2 and len(made.label[1]) == 10 and (union([made])[0] == pairs).all()
