import numpy as np
import pyarrow as pa

from tagflow.llm.words import shingles, word_hashes


def names(texts):
    h, at = word_hashes(pa.array(texts, pa.string()))
    return [h[at[i] : at[i + 1]].tolist() for i in range(len(texts))]


def test_words_are_split_and_folded_like_bytes_split():
    texts = ["Ab  c\tD\x0b\x0ce", None, "", "  ", "x y é É", "tail ", " head", "ab"]
    got = names(texts)
    want = [(t or "").encode().lower().split() for t in texts]
    assert [len(x) for x in got] == [len(x) for x in want]
    seen = {}
    for g, w in zip(got, want, strict=True):
        for a, b in zip(g, w, strict=True):
            assert seen.setdefault(b, a) == a
    assert len(set(seen.values())) == len(seen)


def test_hash_does_not_depend_on_place_or_step(monkeypatch):
    import tagflow.llm.words as W

    text = " ".join(f"word{i % 97}" for i in range(3000))
    whole = names([text, "word5 word6"])
    monkeypatch.setattr(W, "STEP", 100)
    assert names([text, "word5 word6"]) == whole


def test_sliced_columns_count_only_their_own_texts():
    column = pa.array(["a b", "c", "d e f"]).slice(1, 2)
    h, at = word_hashes(column)
    assert at.tolist() == [0, 1, 4] and len(h) == 4


def test_shingles_of_short_texts_are_the_whole_sequence():
    h, at = shingles(*word_hashes(pa.array(["a b c", "c b a", "a b c d e f", "", "a b c d e"])))
    assert np.diff(at).tolist() == [1, 1, 2, 0, 1]
    assert h[0] != h[1] and h[2] == h[4]


def test_batches_are_bounded_by_bytes(spark):
    from tagflow.llm.shared import ARROW_BYTES, BATCH_BYTES, text_batches

    before, docs = spark.conf.get(ARROW_BYTES), spark.range(1)
    try:
        for given, want in (("64MB", str(BATCH_BYTES)), ("1m", "1m"), ("1024", "1024")):
            spark.conf.set(ARROW_BYTES, given)
            assert text_batches(docs) is docs and spark.conf.get(ARROW_BYTES) == want
    finally:
        spark.conf.set(ARROW_BYTES, before)
