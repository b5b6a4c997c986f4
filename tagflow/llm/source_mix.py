"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame functions alone.

Each source's documents are shuffled by a hash and laid end to end; the words of that stream
are cut into blocks of equally many, all but the last. A schedule deals slots to sources: slot k goes to the
source in whose share of all slots the k-th golden-ratio point falls. A slot's rank
among its source's slots names the block it takes, over and over from the first. A source's share is as many slots as its blocks need to reach
its target, whatever their size. The points are the multiples of a golden number modulo their count,
so each whole number below it is a point once, and a source gets its share to one slot.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.llm.host_rules import BLANKS
from tagflow.llm.shared import copies, written
from tagflow.operators.joins import join_same
from tagflow.operators.ranking import earlier_sums

GOLDEN = 2718142227965  # the golden ratio's fraction of 2**42
MOST_TIMES = 3  # what a document may at most be taken
LANE_ROWS = 50_000  # about so many documents are laid end to end on their own
CHUNK = 1 << 16  # slots whose ranks are counted together
CHUNKS = 1 << 12


def word_count(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[ \t-\r]+"))).cast("long")


def weighted(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """sources with rank, by code point, null last, and weight: weights in turn by rank."""
    ordered = sources.withColumns({"none": F.col("source").isNull(), "one": F.lit(1)})
    ranked = earlier_sums(ordered, ["none", "source"], {"rank": F.col("one")}).drop("none", "one")
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", weight)


def fill(sources: DataFrame, most_times: int = MOST_TIMES) -> DataFrame:
    """sources(rank, source_size, weight) with the column target: shares of all words by weight, at most most_times the size.

    What is cut off is shared again by weight among the sources below their limit until none is above. In the order
    of limit / weight the sources at their limit come first: with the limits and weights of those before a source known,
    the level of the others follows, and the first source whose limit is not below its level settles all.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    all_weight = sources.agg(F.sum("weight")).first()[0] or 0.0
    limit = F.col("source_size") * most_times
    ordered = earlier_sums(sources.withColumns({"limit": limit, "ratio": limit / F.col("weight")}), ["ratio", "rank"], {"limits": F.col("limit"), "weights": F.col("weight")})
    level = (F.lit(total) - F.col("limits")) / (F.lit(all_weight) - F.col("weights"))
    settled = ordered.withColumn("level", level).where("ratio >= level").agg(F.min_by("level", F.struct("ratio", "rank"))).first()[0]
    # no source: none has room, which needs most_times < 1
    return sources.withColumn("target", limit.cast("double") if settled is None else F.least(F.col("weight") * F.lit(settled), limit.cast("double")))


def cut_blocks(targets: DataFrame, block_words: int) -> DataFrame:
    """targets(source_size, target) with blocks, how many a source's words are cut into; words, of a block but the last; share, the slots that take the target.

    All blocks of a source once are its size; what the target has beyond that is in blocks of words.
    """
    blocks = F.ceil(F.col("source_size") / F.lit(block_words))
    cut = targets.withColumn("blocks", blocks).withColumn("words", F.greatest(F.ceil(F.col("source_size") / F.greatest("blocks", F.lit(1))), F.lit(1)))
    passes = F.floor(F.col("target") / F.col("source_size"))
    share = passes * F.col("blocks") + F.least(F.col("blocks"), (F.col("target") - passes * F.col("source_size")) / F.col("words"))
    return cut.withColumn("share", F.when(F.col("source_size") > 0, share).otherwise(0.0))


def golden_step(n: int) -> int:
    """A number near n times the golden ratio's fraction without a common divisor with n: its multiples modulo n are all numbers below n."""
    near = n * GOLDEN >> 42
    return next(near + d for k in range(n + 1) for d in (-k, k) if math.gcd(near + d, n) == 1)


def schedule(targets: DataFrame, slots: int | None = None) -> DataFrame:
    """Blocks to take: source, block (from 0), times. targets: source, rank, blocks, share.

    Slot k belongs to the source whose part of the cumulative shares holds the k-th point of
    the golden-ratio sequence; the r-th slot of a source takes block r modulo its blocks. Points and
    parts are whole numbers below the number of slots, so that slots of any number are dealt exactly.
    """
    spark = targets.sparkSession
    total, n_sources = targets.agg(F.sum("share"), F.count("*")).first()
    n = int(round(total or 0.0)) if slots is None else slots
    if not total or not n:
        return spark.createDataFrame([], "source string, block long, times long")
    # a slot looks for its source among those of its cell, an equal part of all points
    width = -(-n // min(n, 1 << min(20, max(10, (4 * n_sources).bit_length()))))
    bound = lambda x: F.round(x / F.lit(total) * n).cast("long")
    spans = earlier_sums(targets, ["rank"], {"upto": F.col("share")}).where("share > 0").select(
        "source", "rank", "blocks", bound(F.col("upto")).alias("low"), bound(F.col("upto") + F.col("share")).alias("high"))
    in_cells = spans.where("high > low").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    points = spark.range(n).select("id", golden_point(F.col("id"), n).alias("point")).withColumn("cell", F.floor(F.col("point") / width))
    dealt = points.join(in_cells, "cell").where("point >= low AND point < high").select("id", "source", "blocks", F.floor(F.col("id") / CHUNK).alias("chunk"))
    # the rank of a slot: the source's slots in earlier chunks, and its place in its chunk
    per_chunk = written(dealt.groupBy("source", "chunk").agg(F.count("*").alias("c")), "slot_chunks")
    # chunks by thousands, so that no task has all chunks of a source
    far, near = F.floor(F.col("chunk") / CHUNKS), W.partitionBy("source", "far").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    fars = per_chunk.groupBy("source", far.alias("far")).agg(F.sum("c").alias("c"))
    before = W.partitionBy("source").orderBy("far").rowsBetween(W.unboundedPreceding, -1)
    begun = fars.select("source", "far", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("begun"))
    starts = join_same(per_chunk.withColumn("far", far), begun, ["source", "far"]).select("source", "chunk", (F.col("begun") + F.coalesce(F.sum("c").over(near), F.lit(0))).alias("start"))
    ranked = join_same(dealt.withColumn("place", F.row_number().over(W.partitionBy("source", "chunk").orderBy("id")) - 1), starts, ["source", "chunk"])
    slot_rank, blocks = F.col("start") + F.col("place"), F.col("blocks")
    return ranked.where(slot_rank < MOST_TIMES * blocks).select("source", F.pmod(slot_rank, blocks).alias("block")).groupBy("source", "block").agg(F.count("*").alias("times"))


def golden_point(k: Column, n: int) -> Column:
    """k * golden_step(n) modulo n without overflow, for n up to 2**43: the digits of k to the base 2**20 apart."""
    step = golden_step(n)
    digits = [F.pmod(F.shiftright(k, 20 * i), F.lit(1 << 20)) * F.lit((step << (20 * i)) % n) % n for i in range(3 if n > 1 << 40 else 2)]
    return F.pmod(sum(digits[1:], digits[0]), F.lit(n))


def row_key(doc_id: Column, text: Column) -> Column:
    """A key of a row that rows without an id have too: md5 of the id and the text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), block_words: int = 32) -> DataFrame:
    """One row per row of docs(doc_id, text, source): doc_id, source, size, source_size, target, taken.

    size: words of the text (null: 0). target: its source's. taken: words of it in the blocks
    that the schedule takes, repeats counted, at most three times its size; a text without
    words takes part with 0. Of each source its target is taken to one and a half blocks
    at most; a block has at most block_words words, and no more than the source. Equal rows are dealt alike in any order; a rerun gives the same
    result. A source without words has target 0. Other columns are ignored.
    """
    return _dealt(docs, weights, block_words).select("doc_id", "source", "size", "source_size", "target", "taken")


def _dealt(docs: DataFrame, weights: tuple[int, ...], block_words: int) -> DataFrame:
    """The rows of mixed() with their row_key as key."""
    # documents in an order of their own: by hash of id and text, the lane being its leading part
    key = row_key(F.col("doc_id"), F.col("text"))
    # equal rows are one row with their number: a third of all rows may be copies of one without an id
    each = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"))
    made = written(each.groupBy("doc_id", "source", "size", "key").agg(F.count("*").alias("n")).withColumn("all", F.col("size") * F.col("n")), "sized")
    digits = 2 + max(0, (made.count() // (256 * LANE_ROWS)).bit_length() + 3) // 4  # a digit more: sixteen times the lanes
    sized = made.withColumn("lane", F.substring("key", 1, digits))
    per_lane = written(sized.groupBy("source", "lane").agg(F.sum("all").alias("words")), "lanes")
    sources = per_lane.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = written(cut_blocks(fill(written(weighted(sources, weights), "weighted")), block_words), "targets")
    # lanes by their first two digits, so that no task has all lanes of a source
    before = lambda *keys: W.partitionBy(*keys).orderBy("lane").rowsBetween(W.unboundedPreceding, -1)
    head = F.substring("lane", 1, 2)
    heads = per_lane.groupBy("source", head.alias("lane")).agg(F.sum("words").alias("words")).select("source", F.col("lane").alias("head"), F.coalesce(F.sum("words").over(before("source")), F.lit(0)).alias("begun"))
    inner = per_lane.withColumn("head", head).withColumn("inner", F.coalesce(F.sum("words").over(before("source", "head")), F.lit(0)))
    offsets = join_same(inner, heads, ["source", "head"]).withColumn("start", F.col("begun") + F.col("inner"))
    within = F.sum("all").over(W.partitionBy("source", "lane").orderBy("key", "size", "doc_id").rowsBetween(W.unboundedPreceding, 0)) - F.col("all")
    placed = join_same(sized.withColumn("within", within), offsets.select("source", "lane", "start"), ["source", "lane"])
    first = F.col("start") + F.col("within") + F.col("copy") * F.col("size")
    streams = written(copies(placed, "n").select("doc_id", "source", "size", "key", first.alias("first")), "streams")
    end = F.col("first") + F.col("size")
    pieces = join_same(streams.where("size > 0"), targets.select("source", "words"), ["source"]).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("first") / F.col("words")), F.floor((end - 1) / F.col("words")))))
    words_in = F.least(end, (F.col("block") + 1) * F.col("words")) - F.greatest("first", F.col("block") * F.col("words"))
    taken = join_same(pieces, schedule(targets), ["source", "block"]).groupBy("source", "first").agg(F.sum(words_in * F.col("times")).alias("taken"))
    # a place in a source's stream names the document that begins there, if it has words
    with_taken = join_same(streams.where("size > 0"), taken, ["source", "first"], how="left").select("doc_id", "source", "size", "key", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    every = with_taken.unionByName(streams.where("size = 0").select("doc_id", "source", "size", "key", F.lit(0).cast("long").alias("taken")))
    return join_same(every, targets.select("source", "source_size", "target"), ["source"]).select("doc_id", "source", "size", "key", "source_size", "target", "taken")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), block_words: int = 32) -> DataFrame:
    """docs with each row as often as the mix takes it: taken / size, rounded; rows without words go.

    A row with a null doc_id is taken like any other. Rows of a source that share doc_id (or have
    none) and text share their takes evenly.
    """
    takes = _dealt(docs, weights, block_words).where("size > 0").groupBy(F.col("source").alias("__source"), F.col("key").alias("__id")).agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias("__times")).where("__times > 0")
    # rows without words have no take: were they joined, those without an id would all meet in one task
    keyed = docs.where(F.btrim("text", F.lit(BLANKS)) != "").withColumn("__key", row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(takes, (F.col("__key") == F.col("__id")) & keyed["source"].eqNullSafe(takes["__source"])).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*[F.col(f"`{c}`") for c in docs.columns])
