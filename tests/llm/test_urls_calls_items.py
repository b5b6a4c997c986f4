import fnmatch
import json
import random

import pytest

from tagflow.llm.decontamination import contained_items, without_items
from tagflow.llm.tool_calls import CHAT_TOOLS, Tool, argument_error, chat_calls, depths, linked_calls, parsed
from tagflow.llm.url_globs import Automaton, Rule, filter_urls
from tests.llm.conftest import make_text
from tests.llm.test_near import shingle_set


def test_automaton_equals_fnmatch():
    rng = random.Random(6)
    rules = tuple(Rule("block", "".join(rng.choice("ab*.") for _ in range(rng.randrange(1, 6))), "/" + "".join(rng.choice("ab*") for _ in range(rng.randrange(5))), False) for _ in range(40))
    urls = [("".join(rng.choice("ab.") for _ in range(rng.randrange(7))), "/" + "".join(rng.choice("ab") for _ in range(rng.randrange(7)))) for _ in range(300)]
    got = Automaton(rules).fits([f".{h}\0{p}".encode() for h, p in urls])
    for (h, p), row in zip(urls, got, strict=True):
        for r, hit in zip(rules, row, strict=True):
            host = r.host if r.host.startswith("*") else "." + r.host
            assert hit == (fnmatch.fnmatchcase("." + h, host) and fnmatch.fnmatchcase(p, r.path)), (h, p, r)


def test_url_rules(spark):
    urls = {
        1: ("https://EXAMPLE.org/es/1", "block", "example.org/es/"), 2: ("http://a.example.org/en/1x?q", "block", "example.org/en/1"), 3: ("http://b.org", "allow", None),
        4: ("http://b.org/", "allow", "org/"), 5: ("http://x.com/fr/", "allow", "com/fr/"), 6: ("http://x.com/de/#a", "block", "com/de/"), 7: ("http://x.com/DE/", "allow", None),
        8: (None, "allow", None), 9: ("no scheme.org/", "allow", None), 10: ("http://q.net/a.org/es/", "allow", None), 11: ("http://spam-farm.net/x", "block", None),
        12: ("x://notexample.org/es/", "allow", "org/"), 13: ("", "allow", None), 14: ("http://é.org/é", "allow", "org/"), 15: ("http://w.net/login?x", "block", None)}
    df = spark.createDataFrame([(k, v[0], "h", "clash") for k, v in urls.items()] + [(1, urls[1][0], None, None)], "page_id long, url string, html string, rule string")
    out = filter_urls(df).collect()
    assert len(out) == len(urls) + 1
    assert {r.page_id: (r.verdict, r.rule) for r in out} == {k: v[1:] for k, v in urls.items()}
    parts = {r.page_id: (r.host, r.path) for r in out}
    assert parts[1] == ("example.org", "/es/1") and parts[2] == ("a.example.org", "/en/1x") and parts[3] == ("b.org", "") and parts[8] == ("", "") == parts[9]
    assert filter_urls(df.limit(0)).count() == 0


def test_rules_in_any_letters_and_very_long_urls(spark):
    rules = (Rule("block", "é.org", "/ü/"), Rule("allow", "org", "/"))
    urls = [(1, "http://a.é.org/ü/x"), (2, "http://é.org/u/x"), (3, "http://org/" + "y" * 200_000), (4, "http://" + "z." * 50_000 + "org/")]
    out = {r.page_id: (r.verdict, r.rule, r.glob) for r in filter_urls(spark.createDataFrame(urls, "page_id long, url string"), rules, (Rule("block", "*", "*", False),)).collect()}
    assert out == {1: ("block", "é.org/ü/", None), 2: ("allow", "org/", None), 3: ("allow", "org/", None), 4: ("allow", "org/", None)}
    assert {r.glob for r in filter_urls(spark.createDataFrame([(1, "http://x.net")], "page_id long, url string"), rules, (Rule("block", "*ß*", "*", False), Rule("block", "*", "*", False))).collect()} == {"* *"}


def test_items_equal_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(12)
    items = [(i, make_text(rng, rng.randrange(5, 90))) for i in range(60)] + [(100, "one two"), (101, None), (102, "")]
    docs = [(i, make_text(rng, rng.randrange(400))) for i in range(40)]
    for i in range(40, 140):
        w = make_text(rng, rng.randrange(2000)).split()
        t = items[rng.randrange(60)][1].split()
        if rng.random() < 0.4:
            t[rng.randrange(len(t))] = "edited"
        at = rng.randrange(len(w) + 1)
        docs.append((i, " ".join(w[:at] + [x.encode().upper().decode() for x in t] + w[at:])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = set()
    for d, t in docs:
        s = shingle_set(t)
        for i, q in items:
            qs = shingle_set(q) if len((q or "").split()) >= 5 else set()
            if qs and 100 * len(s & qs) >= 80 * len(qs):
                want.add((d, i, len(qs), len(s & qs)))
    assert len(want) > 60
    assert {tuple(r) for r in contained_items(df, bench).collect()} == want
    bad = {x[0] for x in want}
    assert {r.doc_id for r in without_items(df, bench).collect()} == {d for d, _ in docs} - bad
    assert without_items(odd_docs, bench).count() == odd_docs.count() and contained_items(no_docs, bench).count() == 0
    assert without_items(odd_docs, odd_docs.selectExpr("doc_id AS item_id", "text").where("item_id = 1")).columns == odd_docs.columns
    assert contained_items(df, bench.limit(0)).count() == 0


def test_short_items_in_long_documents_are_all_found(spark):
    rng = random.Random(31)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(5 + k % 8)) for k in range(3000)]
    docs = []
    for begin in range(0, 3000, 100):
        parts = [f"{make_text(rng, rng.randrange(1, 40))} {t}" for t in texts[begin : begin + 100]]
        docs += [" ".join(parts).upper(), "", None]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contained_items(df, bench).collect()} == {(3 * (k // 100), k) for k in range(3000)}


def test_items_in_repeated_and_nameless_rows(spark):
    rng = random.Random(33)
    item, clean = make_text(rng, 40), make_text(rng, 80)
    rows = [(1, f"a b {item} c"), (1, f"a b {item} c"), (1, clean), (2, clean), (None, f"x {item}"), (None, clean), (None, None), (3, None), (4, "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, item), (7, item), (7, make_text(rng, 30)), (None, make_text(rng, 30))], "item_id long, text string")
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_common) for r in contained_items(df, bench).collect()), key=repr) == sorted([(1, 7, 36, 36)] * 2 + [(None, 7, 36, 36)], key=repr)
    kept = without_items(df, bench)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(2, clean), (None, clean), (None, None), (3, None), (4, "")], key=repr) and kept.columns == df.columns


def test_an_item_anywhere_in_a_very_long_text(spark):
    """Over the bounds of the steps in which bytes are hashed."""
    rng = random.Random(35)
    items = [make_text(rng, 20) for _ in range(12)]
    filler = make_text(rng, 60_000)
    text = " ".join(f"{filler[k * 40_000 : (k + 1) * 40_000]} {t}" for k, t in enumerate(items))
    assert len(text) > 1 << 18
    df = spark.createDataFrame([(1, text), (2, filler)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contained_items(df, bench).collect()} == {(1, k) for k in range(12)}


TOOLS = {"add": Tool({"a": "integer", "b": "number"}, ("a",)), "free": Tool({}, (), True)}


@pytest.mark.parametrize("name,text,error", [
    ("add", '{"a": 1}', None), ("add", '{"a": true}', "a is no integer"), ("add", '{"b": 1.5}', "missing a"), ("add", '{"a": 1, "c": 2}', "unexpected c"),
    ("add", "[1]", "arguments are not an object"), ("add", "{", "arguments are not JSON"), ("add", None, "arguments are not JSON"), ("none", "{}", "unknown tool"), ("free", '{"z": []}', None)])
def test_argument_errors(name, text, error):
    assert argument_error(TOOLS, name, *parsed(text)) == error


def test_calls_are_linked_and_ordered(spark):
    calls = [("c", f"k{i}", f"k{i - 1}" if i else None, 1000 - i, "add", '{"b":2.0,"a":%d}' % i) for i in range(40)]
    calls += [("d", "x", "y", 1, "add", "{}"), ("d", "y", "x", 2, "add", '{"a": 1}'), ("d", "z", "gone", 3, "free", '{"é": "ü"}'), ("d", "z", None, 9, "add", "{}"), (None, "n", None, 0, "add", "{}")]
    results = [("c", f"k{i}", f"r{i}") for i in range(0, 40, 2)] + [("c", "k0", "a later one"), ("e", "k0", "of none"), ("d", "z", None)]
    cs = spark.createDataFrame(calls, "conv_id string, call_id string, after string, turn long, name string, arguments string")
    rs = spark.createDataFrame(results, "conv_id string, call_id string, content string")
    one = cs.where("conv_id = 'c'").selectExpr("conv_id", "call_id", "array(after) AS after")
    assert {(r.conv_id, r.call_id): r.depth for r in depths(one).collect()} == {("c", f"k{i}"): i for i in range(40)}
    out = {(r.conv_id, r.call_id): r for r in linked_calls(cs, rs, TOOLS).collect()}
    assert len(out) == 43
    assert all(out["c", f"k{i}"].position == i and out["c", f"k{i}"].linked == (i % 2 == 0) for i in range(40))
    assert out["c", "k1"].json == '{"arguments":{"a":1,"b":2.0},"conversation":"c","id":"k1","name":"add"}'
    assert out["c", "k0"].json.endswith('"result":"a later one"}')
    assert out["d", "z"].position == 0 and out["d", "z"].json == '{"arguments":{"é":"ü"},"conversation":"d","id":"z","name":"free","result":null}'
    assert out["d", "x"].error == out["d", "y"].error == "cycle" and out["d", "x"].depth is None
    assert linked_calls(cs.limit(0), rs, TOOLS).count() == 0


def brute_depths(calls):
    """(conv, call) -> longest chain of calls before it, None in or behind a cycle; by walking all ways."""
    after = {(c, i): [(c, a) for a in (up or []) if a is not None] for c, i, up in calls}

    def walk(x, above):
        if x in above:
            return None
        found = [walk(u, above | {x}) for u in after[x] if u in after]
        return None if None in found else max((d + 1 for d in found), default=0)

    return {x: walk(x, frozenset()) for x in after}


def test_calls_with_several_predecessors(spark):
    rng = random.Random(19)
    calls = []
    for c in range(12):
        for i in range(14):  # one of three conversations has ways back, so cycles
            ups = [f"k{rng.randrange(14 if c % 3 == 0 and rng.random() < 0.3 else max(1, i))}" for _ in range(rng.randrange(4))] if i else []
            calls.append((f"c{c}", f"k{i}", rng.choice([ups, [*ups, None], [*ups, "gone"]]) if ups else rng.choice([[], None])))
    df = spark.createDataFrame(calls, "conv_id string, call_id string, after array<string>")
    want = brute_depths(calls)
    assert None in want.values() and max(d for d in want.values() if d is not None) > 5
    assert {(r.conv_id, r.call_id): r.depth for r in depths(df).collect()} == want
    full = df.selectExpr("*", "bigint(substr(call_id, 2)) AS turn", "'free' AS name", "'{}' AS arguments")
    out = linked_calls(full, spark.createDataFrame([], "conv_id string, call_id string, content string"), TOOLS).collect()
    place = {(r.conv_id, r.call_id): r.position for r in out}
    for c in range(12):
        assert sorted(p for (k, _), p in place.items() if k == f"c{c}") == list(range(14))
    for c, i, ups in calls:
        for u in ups or []:
            if u in {f"k{k}" for k in range(14)} and want[c, i] is not None:
                assert place[c, u] < place[c, i]


def brute_chats(turns):
    """conv -> list of (user turn, prompt, system, result), by a plain loop over the turns in order."""
    rank = {"system": 0, "user": 1, "tool": 2, "assistant": 3}
    texts = {}
    for c, t, role, text in turns:
        if c is not None and t is not None and role in rank:
            old = texts.get((c, t, rank[role]), (True, None))
            new = (text is None, text)
            texts[c, t, rank[role]] = min(old, new, key=lambda x: (x[0], x[1] or ""))
    out, system = {}, {}
    for (c, t, r), (_, text) in sorted(texts.items()):
        calls = out.setdefault(c, [])
        if r == 0:
            system.setdefault(c, []).append(text)
        elif r == 1:
            calls.append([t, text or "", [x for x in system.pop(c, []) if x is not None], None])
        elif calls:
            calls[-1][3] = [*(calls[-1][3] or []), *([] if text is None else [text])]
    return out


def test_chats_equal_a_plain_loop(spark):
    """Conversations of all lengths, one of them with a third of all rows, in more ranges than conversations."""
    rng = random.Random(29)
    turns = [(0 if rng.random() < 0.35 else rng.randrange(1, 40), rng.randrange(400), rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([None, "", "x", "long text " * 3])) for _ in range(1500)]
    turns += [(50, 0, "user", "word " * 60_000)]
    out = linked_calls(*chat_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)), CHAT_TOOLS).collect()
    got = {}
    for r in sorted(out, key=lambda r: r.position):
        j = json.loads(r.json)
        got.setdefault(r.conv_id, []).append((j["arguments"]["turn"], j["arguments"]["prompt"], j["arguments"].get("system"), j.get("result"), r.linked, r.depth))
    want = {c: [(t, p, "\n".join(s) if s else None, "\n".join(a) if a else None, a is not None, k) for k, (t, p, s, a) in enumerate(calls)] for c, calls in brute_chats(turns).items() if calls}
    assert got == want


def test_plain_chats(spark):
    turns = [(1, 0, "system", "be\nbrief"), (1, 1, "user", 'say "é"'), (1, 2, "assistant", "é"), (1, 3, "user", None), (2, 0, "user", ""), (2, 0, "user", ""), (None, 0, "user", "x"), (3, None, "user", "x"), (3, 0, None, "x")]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, name string")
    out = {(r.conv_id, r.call_id): r for r in linked_calls(*chat_calls(df), CHAT_TOOLS).collect()}
    assert set(out) == {(1, "turn-1"), (1, "turn-3"), (2, "turn-0")} and all(r.error is None for r in out.values())
    assert json.loads(out[1, "turn-1"].json) == {"conversation": 1, "id": "turn-1", "name": "reply", "arguments": {"prompt": 'say "é"', "system": "be\nbrief", "turn": 1}, "result": "é"}
    assert [out[1, k].position for k in ("turn-1", "turn-3")] == [0, 1] and not out[1, "turn-3"].linked


def test_chats_with_gaps_and_turns_in_a_row(spark):
    turns = [
        (1, 0, "assistant", "hello"), (1, 2, "system", "s1"), (1, 5, "system", "s2"), (1, 9, "user", "a"), (1, 14, "tool", "t"), (1, 15, "assistant", "x"), (1, 16, "assistant", "y"),
        (1, 17, "user", "b"), (1, 30, "user", "c"), (1, 31, "system", "s3"), (1, 40, "assistant", "z"), (1, 41, "user", "d"), (1, 42, "system", "s4"),
        (2, 0, "system", "s"), (2, 0, "user", "p"), (2, 0, "assistant", "q"), (2, 1, "user", "r"), (2, 1, "assistant", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = {(r.conv_id, r.call_id): (r.depth, r.position, r.error, json.loads(r.json)) for r in linked_calls(*chat_calls(df.repartition(3)), CHAT_TOOLS).collect()}
    got = {k: (d, p, e, j["arguments"].get("system"), j["arguments"]["prompt"], j.get("result", "none")) for k, (d, p, e, j) in rows.items()}
    assert got == {
        (1, "turn-9"): (0, 0, None, "s1\ns2", "a", "t\nx\ny"), (1, "turn-17"): (1, 1, None, None, "b", "none"), (1, "turn-30"): (2, 2, None, None, "c", "z"),
        (1, "turn-41"): (3, 3, None, "s3", "d", "none"), (2, "turn-0"): (0, 0, None, "s", "p", "q"), (2, "turn-1"): (1, 1, None, None, "r", None)}


def test_arguments_that_are_no_json_in_utf8_kill_no_task(spark):
    texts = [r'{"a":"\ud800"}', "[" * 100_000, '{"a":' * 5000 + "1" + "}" * 5000, '{"a":NaN}', '{"a":1e999}', '{"a":-Infinity}', "9" * 5000, None, "", r'{"a":"\ud83d\ude00"}']
    calls = spark.createDataFrame([("c", f"k{i}", None, i, "reply", t) for i, t in enumerate(texts)], "conv_id string, call_id string, after string, turn long, name string, arguments string")
    out = {r.call_id: r for r in linked_calls(calls, spark.createDataFrame([], "conv_id string, call_id string, content string"), CHAT_TOOLS).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts[:-1]):
        assert out[f"k{i}"].error == "arguments are not JSON" and json.loads(out[f"k{i}"].json)["arguments"] == t
    assert json.loads(out["k9"].json)["arguments"] == {"a": "\U0001f600"} and out["k9"].error == "missing prompt"


def test_nesting_of_arguments_has_one_limit_for_every_python():
    from tagflow.llm.tool_calls import DEEPEST, parsed

    nested = lambda n: ("[" * n + "]" * n, '{"a":' * n + "1" + "}" * n, '[{"a":' * (n // 2) + "[]" * (n % 2) + ("" if n % 2 else "1") + "}]" * (n // 2))
    assert all(parsed(t) == (True, json.loads(t)) for n in (1, 2, DEEPEST - 1, DEEPEST) for t in nested(n) if t)
    assert all(parsed(t) == (False, t) for n in (DEEPEST + 1, 5000) for t in nested(n))
    wide = json.dumps({"a": [[{}]] * 2000, "b": "[" * 2000})
    assert parsed(wide) == (True, json.loads(wide))


def test_turns_without_a_call_are_given_with_a_reason(spark):
    from tagflow.llm.tool_calls import turns_without_call

    turns = [
        (1, 0, "assistant", "early"), (1, 1, "tool", "early too"), (1, 2, "system", "s"), (1, 3, "user", "u"), (1, 4, "tool", "t"), (1, 5, "system", "late"), (2, 0, "assistant", "alone"), (None, 0, "user", "x"),
        (1, None, "user", "x"), (1, 6, "judge", "x"), (1, 7, None, "x"), (1, 3, "user", "v"), (1, 3, "user", "u"), (1, 4, "tool", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn, r.role, r.text): r.reason for r in turns_without_call(df).collect()}
    assert got == {
        (1, 0, "assistant", "early"): "before the first user turn", (1, 1, "tool", "early too"): "before the first user turn", (1, 5, "system", "late"): "after the last user turn",
        (2, 0, "assistant", "alone"): "no user turn", (None, 0, "user", "x"): "no conversation", (1, None, "user", "x"): "no turn", (1, 6, "judge", "x"): "other role", (1, 7, None, "x"): "other role",
        (1, 3, "user", "v"): "repeated", (1, 4, "tool", None): "repeated"}
    out = linked_calls(*chat_calls(df), CHAT_TOOLS).collect()
    assert [json.loads(r.json).get("result") for r in out] == ["t"]
