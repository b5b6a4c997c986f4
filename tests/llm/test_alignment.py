import hashlib
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tagflow.llm import alignment as A
from tagflow.llm.alignment import Encoders, aligned, coalesced

FILES = [f"/opt/tokenizers/{x}" for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
pytestmark = pytest.mark.skipif(not all(map(os.path.exists, FILES)), reason="no tokenizers here")
ODD = [
    "a", " a", "a ", "  two  spaces  ", "\n", " \n x", "x\n\ny z", "it's o'clock don't", "été à  la ñandú", "日本 語 text", " a b  c", "▁a ▁ b", "a ▁", "<s>x</s> <unk> <0x41>",
    "<|endoftext|> b<|endoftext|>", "a\x00b \x00", "\U0001f600 \U0001f600x", "é é", "tab\tx \t y", "x" * 300 + " " + "9" * 200, "a.b,c (d) 3.14 !!!", "ÿ à", "Ã Ã b", " x   y", "end. "]


@pytest.fixture(scope="module")
def encoders():
    return Encoders(*(open(x, "rb").read() for x in FILES))


def plain_encodings(texts):
    """Each whole text by the two libraries, with the bytes of its tokens by their own decoders."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = iter(range(256, 512))
    byte_of = {c if c in plain else next(odd): c for c in range(256)}
    for text in texts:
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        x_bytes = [bytes(byte_of[ord(c)] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in x]
        y_bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in y)]
        yield x, x_bytes, y, y_bytes


def brute(texts):
    found, links = [], Counter()
    for text, (x, xb, y, yb) in zip(texts, plain_encodings(t or "" for t in texts), strict=True):
        want = (" " + (text or "")).encode()
        if not text or b"".join(xb) != want or b"".join(yb) != want:
            found.append(None)
            continue
        spans = []
        for ids, parts in ((x, xb), (y, yb)):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            spans.append([(i, e - len(p), e) for i, p, e in zip(ids, parts, ends, strict=True)])
        both = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for high in both:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in spans))
            low = high
        own = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        links.update(own)
        found.append((len(x), len(y), len(groups), own, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, j), n in links.items():
        most[j] = max(n, most.get(j, 0))
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (*f[:3], len(f[3]), sum(links[p] == most[p[1]] for p in f[3]), sum(links[p] for p in f[3]), f[4]) for f in found]


@pytest.mark.parametrize("block", [8 << 20, 700])
def test_alignment_equals_whole_texts(spark, odd_docs, block):
    rng = random.Random(6)
    bits = ["the ", "naïve", " ", "  ", "\n", "x.", "É", "-", "ing ", "123", "日", "don't ", "été ", "▁" * (block < 1000)]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(60)]
    docs = odd_docs.select("doc_id", "text", "n_chars").union(spark.createDataFrame([(100 + i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")).repartition(3)
    rows = docs.collect()
    got = aligned(docs, *FILES, block_bytes=block)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = brute([r.text for r in rows])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((r.doc_id, *w)) for r, w in zip(rows, want, strict=True))
    assert sum(w[2] > 0 for w in want) > 40 and any(t and not w[0] for t, w in zip((r.text for r in rows), want, strict=True))


def test_alignment_of_nothing(spark, no_docs):
    assert aligned(no_docs, *FILES).collect() == []


def test_groups_break_where_a_start_reaches_the_maximum():
    start, end = np.array([0, 2, 5, 0, 3, 5]), np.array([2, 5, 6, 3, 5, 6])
    assert coalesced(start, end, np.array([0, 0, 0, 1, 1, 1])).tolist() == [0, 0, 1, 0, 0, 1]
    assert len(coalesced(start[:0], end[:0], end[:0])) == 0


def test_pieces_are_cut_only_between_visible_characters(encoders):
    for text in ODD:
        raw = np.frombuffer((" " + text).encode(), np.uint8)
        begins = A.cut_pieces(raw, np.array([0, len(raw)])).tolist()
        parts = [raw[i:j].tobytes() for i, j in zip(begins, [*begins[1:], len(raw)])]
        assert b"".join(parts) == raw.tobytes()
        whole = encoders.encode(raw.tobytes())
        alone = [encoders.encode(p) for p in parts]
        for k in (0, 1):
            assert np.concatenate([x[k] for x in alone]).tolist() == whole[k].tolist(), text
    made = A.align(encoders, pa.array([b" a", b" b "], pa.large_binary()))
    assert made.spelled.all() and made.n_groups.tolist() == [1, 2]
