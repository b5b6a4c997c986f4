import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tagflow.llm.host_rules import beta_prior, host_verdicts, judge
from tagflow.llm.slots import MAP_CONF, plain_map, rebalanced, sharded, stored_map
from tagflow.llm.source_mix import mix, mixed
from tests.llm.conftest import make_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measure(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen = Counter(windows)
    inside = {i + k for i, g in enumerate(windows) if seen[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_measures_equal_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(1)
    few = "a b c d".split()
    rows = [(100 + i, " ".join(rng.choice(few) for _ in range(rng.randrange(60))), f"s{i % 3}") for i in range(60)] + [(300 + i, "\n".join(rng.choice(["x y", "", " ", "z|"]) for _ in range(9)), None) for i in range(10)]
    docs = odd_docs.select("doc_id", "text", "source").union(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    out = judge(docs).collect()
    key = lambda r: repr(r)
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out), key=key)
    want = sorted(((r.doc_id, *(m := brute_measure(r.text)), m[0] < 10 or 100 * m[4] > 20 * m[0]) for r in docs.collect()), key=key)
    assert got == want and not any(r.kept for r in out if r.base_failed)
    assert judge(odd_docs).count() == odd_docs.count() and judge(no_docs).count() == 0


def test_bad_hosts_lose_all_and_small_ones_are_shrunk(spark):
    good, bad = "word " + "and other nice words that follow on from here to there", "one two"
    rng = random.Random(9)
    rows = [(f"s{h}", make_text(rng, 20) if rng.random() > 0.1 else bad) for h in range(30) for _ in range(40)]
    rows += [("junk", bad)] * 95 + [("junk", good)] * 5 + [("tiny", bad)]
    docs = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], "doc_id long, source string, text string")
    out = judge(docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    assert not any(r.kept for r in out if r.source == "junk")
    assert all(r.kept for r in out if r.source.startswith("s") and r.text != bad)
    rates = {r.source: r.host_rate for r in out}
    assert rates["tiny"] < 0.9 and rates["junk"] > 0.8


def test_prior_of_equal_hosts_is_strong(spark):
    hosts = spark.createDataFrame([("a", 100, 10), ("b", 100, 10)], "host string, n long, failures long")
    a, b = beta_prior(hosts)
    assert a / (a + b) == pytest.approx(0.1) and a + b == 1e6
    assert beta_prior(hosts.limit(0)) == (0.5, 0.5)
    assert host_verdicts(spark.createDataFrame([(None, True), (None, False)], "host string, failed boolean")).count() == 1


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        if not free:
            break
        level = (total - sum(3 * sizes[s] for s in full)) / sum(w[s] for s in free)
        above = {s for s in free if w[s] * level > 3 * sizes[s]}
        if not above:
            break
        full |= above
    return {s: 3 * sizes[s] if s in full else w[s] * level for s in names}


def test_mix_meets_targets(spark, odd_docs, no_docs):
    rng = random.Random(7)
    rows = [(i, make_text(rng, rng.randrange(1, 120)), rng.choice(["a", "b", "c", "d", None])) for i in range(600)]
    rows += [(1000 + i, make_text(rng, 40), "aa") for i in range(3)] + [(2000, None, "empty"), (2001, "", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixed(docs).collect()
    assert len(out) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size and r.size == len(WORD.findall(dict((x[0], x[1]) for x in rows)[r.doc_id] or ""))
    assert all(r.source_size == sizes[r.source] for r in out)
    want = brute_targets(sizes)
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 48 for s in want)
    again = {r.doc_id: r.taken for r in mixed(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in out}
    assert mixed(odd_docs).count() == odd_docs.count() and mixed(no_docs).count() == 0
    assert mix(odd_docs).columns == odd_docs.columns
    copies = Counter(r.doc_id for r in mix(docs).collect())
    assert all(copies[r.doc_id] == int(r.taken / r.size + 0.5) for r in out if r.size)


def test_mix_meets_the_targets_of_many_small_sources(spark):
    rng = random.Random(19)
    for words in ([10], range(5, 16), [33]):
        rows = [(i, make_text(rng, rng.choice(words)), f"s{i:04d}") for i in range(1500)]
        out = mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
        assert sum(r.taken for r in out) == pytest.approx(sum(r.size for r in out), rel=0.05)
        for r in out:
            block = -(-r.size // -(-r.size // 32))
            assert abs(r.taken - r.target) <= 1.5 * block and r.taken <= 3 * r.size
            assert r.taken or r.target < 1.5 * block


def test_golden_points_are_all_numbers_once(spark):
    from tagflow.llm.source_mix import golden_point, golden_step

    for n in (1, 2, 3, 8, 100, 4096, 4099):
        got = [r[0] for r in spark.range(n).select(golden_point(F.col("id"), n)).collect()]
        assert sorted(got) == list(range(n)) and math.gcd(golden_step(n), n) == 1
    for n in ((1 << 40) + 1, (1 << 43) - 1):
        for k in (0, 1, n // 3, n - 1):
            assert spark.range(1).select(golden_point(F.lit(k), n)).first()[0] == k * golden_step(n) % n


def test_mix_takes_rows_without_an_id(spark):
    rng = random.Random(17)
    rows = [(None if i % 3 else i, make_text(rng, rng.randrange(1, 120)), rng.choice(["a", "b", None])) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, None, "a"), (None, " \t", "b")], "doc_id long, text string, source string")
    size = {t: len(WORD.findall(t)) for _, t, _ in rows}
    took = {(r.doc_id, r.source, r.size): r.taken for r in mixed(docs).collect()}
    names = Counter((i, s, size[t]) for i, t, s in rows)
    copies = Counter((r.doc_id, r.source, r.text) for r in mix(docs).collect())
    plain = [(i, t, s) for i, t, s in rows if names[i, s, size[t]] == 1]
    assert sum(i is None for i, _, _ in plain) > 20 and any(copies[i, s, t] for i, t, s in plain if i is None)
    assert all(copies[i, s, t] == int(took[i, s, size[t]] / size[t] + 0.5) for i, t, s in plain)
    words, want = Counter(), brute_targets({s: sum(size[t] for _, t, x in rows if x == s) for s in ("a", "b", None)})
    for (_, s, t), n in copies.items():
        words[s] += n * size[t]
    assert all(abs(words[s] - want[s]) < 0.05 * want[s] for s in want)


def test_very_long_texts(spark):
    rng = random.Random(43)
    long = make_text(rng, 60_000)
    docs = spark.createDataFrame([(1, long, "a"), (2, long + " end\n" + long, "a"), (3, "x y", "b")], "doc_id long, text string, source string")
    rules = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in judge(docs).collect()}
    assert rules == {r.doc_id: brute_measure(r.text) for r in docs.collect()}
    assert {r.doc_id: r.size for r in mixed(docs).collect()} == {1: 60_000, 2: 120_001, 3: 2}
    assert {(r.doc_id, r.size, r.text_crc32) for r in sharded(docs).collect()} == {(r.doc_id, len(r.text.encode()) + 1, zlib.crc32(r.text.encode())) for r in docs.collect()}


def test_odd_rows_are_mixed_and_sharded_whole(odd_docs):
    rows = odd_docs.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = brute_targets(sizes)
    out = mixed(odd_docs).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in rows)
    assert sorted({(r.source_size, round(r.target, 6)) for r in out}) == sorted({(sizes[s], round(want[s], 6)) for s in sizes})
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    put = sharded(odd_docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in put) == Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert len({(r.shard, r.slot) for r in put}) == len(rows)


@pytest.mark.parametrize("sizes", [{}, {"a": 0}, {"a": 5}, {"a": 1, "b": 1000, "c": 3, "d": 70, None: 2}, {f"s{i}": (i * 37) % 50 for i in range(60)}])
def test_fill_equals_rounds(spark, sizes):
    from tagflow.llm.source_mix import fill, weighted

    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    out = fill(weighted(df, (5, 2, 1))).collect()
    assert {r.source: r.target for r in out} == pytest.approx(brute_targets(sizes)) and len(out) == len(sizes)


def test_shards(spark, odd_docs, no_docs):
    rng = random.Random(8)
    rows = [(i, make_text(rng, rng.randrange(300))) for i in range(3000)] + [(5, "repeated")] * 50 + [(None, None)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharded(docs).collect()
    size, places = Counter(), defaultdict(list)
    for r in out:
        size[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert len(out) == len(rows) and set(size) == set(range(16))
    assert max(size.values()) - min(size.values()) < 0.02 * max(size.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    text = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == text
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)}
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, sharded(docs.repartition(5)).collect()), key=repr)
    assert sharded(odd_docs).count() == odd_docs.count() and sharded(no_docs).count() == 0


def loads(pairs, sizes):
    out = Counter()
    for s, k in pairs:
        out[k] += sizes.get(s, 0)
    return out


def test_rebalancing_moves_few_slots_and_evens_bytes():
    rng = random.Random(2)
    sizes = {s: rng.randrange(1, 1000) for s in range(512)}
    moved_bytes = lambda old, new: sum(sizes[s] for (s, a), (_, b) in zip(old, new, strict=True) if a != b)
    even = rebalanced(plain_map(8, 512), sizes, 8)
    total = sum(sizes.values())
    assert max(loads(even, sizes).values()) < 1.01 * total / 8 and moved_bytes(plain_map(8, 512), even) < 0.2 * total
    grown = rebalanced(even, sizes, 9)
    assert {k for _, k in grown} == set(range(9)) and max(loads(grown, sizes).values()) < 1.05 * total / 9
    assert moved_bytes(even, grown) < 1.2 * total / 9
    assert sum(sizes[s] for (s, a), (_, b) in zip(even, grown, strict=True) if a != b != 8) < 0.02 * total
    shrunk = rebalanced(grown, sizes, 7)
    assert {k for _, k in shrunk} == set(range(7)) and max(loads(shrunk, sizes).values()) < 1.05 * total / 7
    assert moved_bytes(grown, shrunk) < 1.5 * 2 * total / 9
    assert rebalanced(even, sizes, 8) == even


def test_copies_of_one_row_take_places_without_a_gap(spark):
    docs = spark.createDataFrame([(1, "same")] * 10_000 + [(None, None)] * 300 + [(2, "other")], "doc_id long, text string")
    out = sharded(docs, shards=3).collect()
    places = defaultdict(list)
    for r in out:
        places[r.shard].append(r.slot)
    assert Counter(r.doc_id for r in out) == {1: 10_000, None: 300, 2: 1} and all(sorted(p) == list(range(len(p))) for p in places.values())


def test_a_second_run_edits_the_stored_map(spark, tmp_path):
    from tagflow.llm.queries import op9_virtual_slots

    rng = random.Random(4)
    path, rows = str(tmp_path / "map"), [(i, make_text(rng, rng.randrange(300))) for i in range(1000)]
    for name, n in (("first", 600), ("grown", 1000)):
        spark.createDataFrame(rows[:n], "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
    spark.conf.set(MAP_CONF, path)
    try:
        one = op9_virtual_slots(spark, f"{tmp_path}/first").collect()
        version, old = stored_map(spark, path)
        assert version == 2 and len(old) == 4096 and {r.map_version for r in one} == {2} and all(dict(old)[r.virtual_slot] == r.shard for r in one)
        two = op9_virtual_slots(spark, f"{tmp_path}/grown").collect()
        version, new = stored_map(spark, path)
        size = Counter()
        for r in two:
            size[r.virtual_slot] += r.size
        assert version == 3 and new == rebalanced(old, size, 16) != old and {r.map_version for r in two} == {3}
        assert all(dict(new)[r.virtual_slot] == r.shard for r in two) and len(two) == 1000
        moved = sum(size[s] for (s, a), (_, b) in zip(old, new, strict=True) if a != b)
        assert 0 < moved < 0.15 * sum(size.values())
        again = op9_virtual_slots(spark, f"{tmp_path}/grown").collect()
        assert stored_map(spark, path)[1] == rebalanced(new, size, 16) and len(again) == 1000
    finally:
        spark.conf.unset(MAP_CONF)
    assert {r.map_version for r in op9_virtual_slots(spark, f"{tmp_path}/grown").collect()} == {2}
    with pytest.raises(ValueError, match="64 slots"):
        sharded(spark.read.parquet(f"{tmp_path}/first/documents.parquet"), slots=64, map_path=path)


def test_copies_of_a_third_of_all_rows_are_spread(spark):
    from tagflow.llm.shared import copies

    df = spark.createDataFrame([(1, 200_000), (2, 1), (3, 0), (4, 4097)], "id long, n long").coalesce(1)
    out = copies(df, "n", block=1000)
    assert sorted((r.id, r.n, r.low, r.high) for r in out.groupBy("id").agg(F.count("*").alias("n"), F.min("copy").alias("low"), F.max("copy").alias("high")).collect()) == [(1, 200_000, 0, 199_999), (2, 1, 0, 0), (4, 4097, 0, 4096)]
    per_task = [r[0] for r in out.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
    assert len(per_task) > 2 and max(per_task) < 2 * 204_098 / len(per_task)
