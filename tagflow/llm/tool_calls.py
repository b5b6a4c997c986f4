"""Chat formatting by tool-call linking.

Calls and results are hash-joined by identifier. Calls of a conversation that wait for other calls
are put in topological order: the depth of each call comes from doubling the steps to the calls
it waits for, so a chain of n calls takes log n joins. Arguments are checked against schemas, and each
call is serialised as canonical JSON (sorted keys, no blanks, UTF-8).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.llm.shared import discard, written
from tagflow.operators.joins import join_same
from tagflow.operators.ranking import place_in


@dataclass(frozen=True)
class Tool:
    """Arguments by name: "string", "integer", "number", "boolean", "array" or "object"."""

    arguments: dict[str, str]
    required: tuple[str, ...] = ()
    more: bool = False  # whether other arguments are allowed


#: Of plain chat turns: the call is what the user asks.
CHAT_TOOLS = {"reply": Tool({"prompt": "string", "system": "string", "turn": "integer"}, ("prompt", "turn"))}
DEEPEST = 500  # arrays and objects within each other; Python's own limit differs between versions, from under 1,000 to 10,000
_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def _no_json(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def _too_deep(value: object) -> bool:
    level = [value]
    for _ in range(DEEPEST + 1):
        level = [x for x in level if isinstance(x, (dict, list))]
        if not level:
            return False
        level = [y for x in level for y in (x.values() if isinstance(x, dict) else x)]
    return True


def parsed(arguments: str | None) -> tuple[bool, object]:
    """(whether the text is JSON, its value or the text as it is). What cannot be written again as JSON in UTF-8 is none: NaN and infinite numbers,
    halves of surrogate pairs; nor are more than DEEPEST arrays and objects within each other."""
    try:
        value = json.loads(arguments or "", parse_constant=_no_json)
        if _too_deep(value):
            return False, arguments
        canonical(value).encode()
        return True, value
    except (ValueError, RecursionError):
        return False, arguments


def argument_error(tools: dict[str, Tool], name: str | None, valid: bool, given: object) -> str | None:
    """What is wrong with a call's parsed arguments, or None. The first by argument name: of required ones that are missing, else of those given."""
    tool = tools.get(name or "")
    if tool is None:
        return "unknown tool"
    if not valid:
        return "arguments are not JSON"
    if not isinstance(given, dict):
        return "arguments are not an object"
    missing = sorted({*tool.required} - {*given})
    if missing:
        return f"missing {missing[0]}"
    for key in sorted(given):
        kind = tool.arguments.get(key)
        if kind is None:
            if not tool.more:
                return f"unexpected {key}"
        elif not isinstance(given[key], _KINDS[kind]) or (isinstance(given[key], bool) and kind in ("integer", "number")):
            return f"{key} is no {kind}"
    return None


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


ID = ["conv_id", "call_id"]


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth of distinct calls(conv_id, call_id, after): the longest chain of calls before it; null in and behind a cycle.

    after: identifiers of the calls whose results this one waits for; null ones, and such as are not there, count as
    none. Steps to earlier calls are doubled: each round replaces a call's step to another by that call's own
    steps, of several ways to one call the longest, until each way ends at a call that waits for none.
    """
    named = calls.select(*ID, F.explode("after").alias("up")).where("up IS NOT NULL").distinct()
    there = calls.select("conv_id", F.col("call_id").alias("up"))
    # a way: from a call to one before it, or with a null up to the beginning
    ways = written(named.join(there.hint("shuffle_hash"), ["conv_id", "up"]).select(*ID, "up", F.lit(1).cast("long").alias("steps")), "ways")
    most, reach = calls.groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0, 1
    while reach <= most and not ways.where("up IS NOT NULL").isEmpty():
        on = ways.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        far = ways.where("up IS NOT NULL").join(on.hint("shuffle_hash"), ["conv_id", "up"], "left").select(*ID, F.col("next").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        after = written(far.unionByName(ways.where("up IS NULL")).groupBy(*ID, "up").agg(F.max("steps").alias("steps")), "ways")
        discard(ways)
        ways, reach = after, 2 * reach
    longest = ways.groupBy(*ID).agg(F.max("steps").alias("steps"), F.max(F.col("up").isNotNull()).alias("endless"))
    found = calls.select(*ID).join(longest.hint("shuffle_hash"), ID, "left")
    return found.select(*ID, F.when(~F.coalesce("endless", F.lit(False)), F.coalesce("steps", F.lit(0).cast("long"))).alias("depth"))


def linked_calls(calls: DataFrame, results: DataFrame, tools: dict[str, Tool]) -> DataFrame:
    """One row per call: conv_id, call_id, position, depth, name, linked, error, json.

    calls: conv_id, call_id, after (an array of identifiers, or one), turn, name, arguments (JSON text). results:
    conv_id, call_id, content; of several results of a call the least content counts, of repeated calls the one of
    the least turn. position: the call's place in its conversation, from 0, by depth, then turn,
    then identifier: a call comes after those it waits for; calls in or behind a cycle (depth
    null) come last, with the error "cycle". A call without a result has linked false and no result
    in its json; results without a call are left out. Rows without conv_id or call_id are left out.
    """
    if dict(calls.dtypes)["after"] == "string":
        calls = calls.withColumn("after", F.array("after"))
    clean = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    once = clean.groupBy(*ID).agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("c")).select(*ID, "c.*")
    once = written(once, "once")
    answer = results.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy(*ID).agg(F.min("content").alias("content"), F.lit(True).alias("linked"))
    # calls in or behind a cycle last; the sort key is never null
    deep = depths(once.select(*ID, "after")).withColumn("level", F.coalesce("depth", F.lit(1 << 62)))
    order = place_in(once.select(*ID, "turn").join(deep.hint("shuffle_hash"), ID), ["conv_id"], ["level", "turn", "call_id"], "position")
    joined = once.join(order.select(*ID, "depth", "position").hint("shuffle_hash"), ID).join(answer.hint("shuffle_hash"), ID, "left").withColumn("linked", F.coalesce("linked", F.lit(False)))

    @F.arrow_udf("struct<error:string,json:string>")
    def render(conv: pa.Array, call: pa.Array, name: pa.Array, arguments: pa.Array, linked: pa.Array, content: pa.Array) -> pa.Array:
        errors, out = [], []
        for cv, i, n, a, ok, c in zip(*(x.to_pylist() for x in (conv, call, name, arguments, linked, content)), strict=True):
            valid, given = parsed(a)
            errors.append(argument_error(tools, n, valid, given))
            out.append(canonical({"conversation": cv, "id": i, "name": n, "arguments": given} | ({"result": c} if ok else {})))
        return pa.StructArray.from_arrays([pa.array(errors, pa.string()), pa.array(out, pa.string())], ["error", "json"])

    shown = joined.withColumn("r", render("conv_id", "call_id", "name", "arguments", "linked", "content"))
    return shown.select(
        *ID, F.col("position").cast("long").alias("position"), "depth", "name", "linked",
        F.when(F.col("depth").isNull(), "cycle").otherwise(F.col("r.error")).alias("error"), F.col("r.json").alias("json"))


def role_place() -> Column:
    """The order of the roles in a turn; null for other roles."""
    place = F.array_position(F.array(*[F.lit(x) for x in ("system", "user", "tool", "assistant")]), F.col("role"))
    return F.when(place > 0, place - 1)


def turns_without_call(conversations: DataFrame) -> DataFrame:
    """The rows that chat_calls() leaves out, with a reason: no conversation, no turn, other role, repeated (another text of its turn and role
    stands), before the first user turn (assistant and tool), after the last (system), no user turn."""
    users = conversations.where("role = 'user' AND turn IS NOT NULL AND conv_id IS NOT NULL").groupBy("conv_id").agg(F.min("turn").alias("__low"), F.max("turn").alias("__high"))
    least = conversations.groupBy("conv_id", "turn", "role").agg(F.min("text").alias("__least"), F.count("*").alias("__n"))
    marked = join_same(join_same(conversations, users, ["conv_id"], how="left"), least, ["conv_id", "turn", "role"], how="left")
    answer, place = F.col("role").isin("assistant", "tool"), role_place()
    reason = (
        F.when(F.col("conv_id").isNull(), "no conversation").when(F.col("turn").isNull(), "no turn").when(place.isNull(), "other role")
        .when(~F.col("text").eqNullSafe(F.col("__least")), "repeated").when(F.col("__low").isNull(), "no user turn")
        .when(answer & (F.col("turn") < F.col("__low")), "before the first user turn").when((F.col("role") == "system") & (F.col("turn") > F.col("__high")), "after the last user turn"))
    return marked.withColumn("reason", reason).where("reason IS NOT NULL").select(*conversations.columns, "reason")


def chat_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of plain chats: each user turn is a call, which waits for the user turn before it; the
    assistant and tool turns that follow it, up to the next user turn, are its result, and the system turns before it,
    from the user turn before on, an argument: their texts in order, one line break between. What comes before and
    after goes by turn, gaps or not; in one turn by role: system, user, tool, assistant. Several texts of
    one turn and role: the least. Left out, as they belong to no call, are what turns_without_call() gives."""
    place = role_place()
    turns = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL").where(place.isNotNull()).groupBy("conv_id", "turn", "role").agg(F.min("text").alias("text"))
    named = lambda turn: F.concat(F.lit("turn-"), turn.cast("string"))
    # last: the user turn before; number: how many there are. They are sought among the user turns in one range of turns, and
    # before it in the ranges' own sums, so that a conversation of any length is split
    user = F.when(F.col("role") == "user", F.col("turn"))
    ranges = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(turns.withColumn("place", place).repartitionByRange(ranges, "conv_id", "turn", "place").withColumn("part", F.spark_partition_id()), "ranged_turns")
    earlier = lambda *keys: W.partitionBy("conv_id", *keys[:-1]).orderBy(*keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    sums = ranged.groupBy("conv_id", "part").agg(F.max(user).alias("top"), F.count(user).alias("users"))
    carried = sums.select("conv_id", "part", F.max("top").over(earlier(["part"])).alias("top"), F.coalesce(F.sum("users").over(earlier(["part"])), F.lit(0)).alias("users"))
    inside = earlier("part", ["turn", "place"])
    linked = written(
        ranged.withColumn("own", F.last(user, ignorenulls=True).over(inside)).withColumn("count", F.count(user).over(inside)).join(carried, ["conv_id", "part"])
        .select("conv_id", "turn", "place", "role", "text", F.coalesce("own", "top").alias("last"), (F.col("count") + F.col("users")).alias("number")), "turns")
    lines = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("turn", "place", "text"))))
    joined = F.when(F.size(lines) > 0, F.array_join(F.transform(lines, lambda x: x["text"]), "\n"))
    system = linked.where("role = 'system'").groupBy("conv_id", "number").agg(joined.alias("system"))
    arguments = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("prompt"), F.col("system"), F.col("turn")))
    calls = linked.where("role = 'user'").join(system.hint("shuffle_hash"), ["conv_id", "number"], "left").select(
        "conv_id", named(F.col("turn")).alias("call_id"), named(F.col("last")).alias("after"), "turn", F.lit("reply").alias("name"), arguments.alias("arguments"))
    results = linked.where("role IN ('assistant', 'tool') AND last IS NOT NULL").groupBy("conv_id", "last").agg(joined.alias("content"))
    return calls, results.select("conv_id", named(F.col("last")).alias("call_id"), "content")
