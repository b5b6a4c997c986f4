"""N-gram Jaccard join: grouped prefix join over word shingles, exact.

1. A fixed-size sketch counts shingles over all documents; it only orders them (rare
   first), so its collisions cost time, never links.
2. Each document keeps the prefix of its ordered set that any partner at the threshold
   must share. Documents with the same set form a class (the least doc_id stands for
   it); classes with the same prefix and size form a group.
3. Groups meet on prefix shingles. A shingle held by few groups gives pairs, which
   stay if sizes and the number of shared prefix shingles still allow the threshold.
   A shingle held by many groups, a group of several classes and a pair of large groups give
   no pairs but lists of classes. A list's pivots (of each band of sizes the class in
   which nothing rarer stands before the shingle) meet all its classes.
4. Pairs are expanded to classes and verified on whole sets. Classes that are connected by then
   need not be compared. Of a list whose classes are connected nothing is left to
   do; of any other the classes outside its largest component meet all its classes, in
   blocks of bounded size. The places of the shingle tell which pairs may still link: few ones
   are verified like others, in a block with many all sets are compared and only a forest
   of links leaves the task.
For each pair at the threshold the first shingle that both have, in the common order, lies in both
prefixes, and early in that of the smaller set; so it is met by step 3 or 4.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.llm.shared import components, discard, text_batches, written
from tagflow.llm.words import shingles, slices, word_hashes

CHUNK_BITS = 16
BAND = 1.25  # sizes of one band of a list differ by less than this factor
PRODUCT = 256  # pairs of classes that a pair of groups may give; beyond, it is a list


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The sorted set of shingles of each text."""
    h, at = shingles(*word_hashes(batch.column("text")), width)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    edges = np.searchsorted(doc, np.arange(len(at)))
    for i in range(len(at) - 1):
        yield h[edges[i] : edges[i + 1]]


def shingle_sketch(docs: DataFrame, width: int, bits: int) -> np.ndarray:
    """Counts of all shingles of all documents in 2**bits cells: of the same size for any corpus."""
    chunks = 1 << max(0, bits - CHUNK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(1 << bits, np.uint32)
        for batch in slices(batches, "text"):
            h, _ = shingles(*word_hashes(batch.column("text")), width)
            np.add.at(total, (h >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
        task = TaskContext.get().partitionId()
        parts = total.reshape(chunks, -1)
        full = [i for i in range(chunks) if parts[i].any()]
        if full:
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([task % 256] * len(full), pa.int32()), pa.array([zlib.compress(parts[i].tobytes(), 1) for i in full], pa.binary())],
                ["chunk", "lane", "counts"])

    def add(found: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x), np.uint32).astype(np.uint64) for x in found.column("counts").to_pylist())
        first = found.slice(0, 1)
        packed = zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)
        return pa.table({"chunk": first.column("chunk"), "lane": pa.array([0], pa.int32()), "counts": pa.array([packed], pa.binary())})

    schema = "chunk int, lane int, counts binary"
    lanes = text_batches(docs).select("text").mapInArrow(count, schema).groupBy("chunk", "lane").applyInArrow(add, schema)
    out = np.zeros((chunks, (1 << bits) // chunks), np.uint32)
    for row in lanes.groupBy("chunk").applyInArrow(add, schema).toLocalIterator():
        out[row.chunk] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return out.reshape(-1)


def prefixes(docs: DataFrame, width: int, percent: int, sketch_bits: int) -> DataFrame:
    """doc_id, n (set size), sig (hash of the set), prefix (its rarest shingles, rare first)."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(shingle_sketch(docs, width, sketch_bits))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = counts.value
        for batch in slices(batches, "text"):
            sizes, sigs, kept = [], [], []
            for s in _sets(batch, width):
                n = len(s)
                sizes.append(n)
                with np.errstate(over="ignore"):
                    sigs.append(int(np.bitwise_xor.reduce(s * (s | np.uint64(1)) + (s >> np.uint64(29)), initial=np.uint64(n)).astype(np.int64)))
                p = n - -(-percent * n // 100) + 1 if n else 0
                if p < n:
                    cell = weight[(s >> np.uint64(64 - sketch_bits)).astype(np.int64)].astype(np.int64)
                    cut = np.partition(cell, p - 1)[p - 1]
                    s, cell = s[cell <= cut], cell[cell <= cut]
                    s = s[np.argsort(cell, kind="stable")][:p]
                else:
                    s = s[np.argsort(weight[(s >> np.uint64(64 - sketch_bits)).astype(np.int64)], kind="stable")]
                kept.append(s.view(np.int64))
            at = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int32)
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int64()))],
                ["doc_id", "n", "sig", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(features, "doc_id long, n long, sig long, prefix array<long>")


def bit_table(rows: DataFrame, hash64: Column, most_bits: int = 27, each: int = 16) -> tuple[int, np.ndarray]:
    """(bits, table): a table of 2**bits bits, packed in bytes, in which the upper bits of each row's hash name a bit that is set.

    About each bits a row, but at most 2**most_bits in all (16 MB): with more rows more and more others share a bit.
    """
    bits = min(most_bits, max(15, (each * rows.count()).bit_length()))
    cell = F.shiftrightunsigned(hash64, 64 - bits) + 1
    maps = rows.select(F.bitmap_bucket_number(cell).alias("bucket"), F.bitmap_bit_position(cell).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in maps.toLocalIterator():
        out[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    return bits, out


def is_set(bits: int, table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _posts(heads: DataFrame, wanted: DataFrame) -> DataFrame:
    """token, g, n, pos for the prefix shingles of heads that are among wanted(token), and a few others."""
    bits, table = bit_table(wanted, F.col("token"))
    shared = heads.sparkSession.sparkContext.broadcast(table)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            count = prefix.value_lengths().to_numpy()
            token = prefix.flatten().to_numpy()
            row = np.repeat(np.arange(len(count)), count)
            pos = np.arange(len(token)) - np.repeat(np.cumsum(count) - count, count)
            keep = is_set(bits, shared.value, token)
            of = lambda c: pa.array(batch.column(c).to_numpy()[row[keep]])
            yield pa.RecordBatch.from_arrays([pa.array(token[keep]), of("id"), of("n"), pa.array(pos[keep].astype(np.int32))], ["token", "g", "n", "pos"])

    return text_batches(heads).select("id", "n", "prefix").mapInArrow(emit, "token long, g long, n long, pos int")


def set_table(docs: DataFrame, key: Column, wanted: DataFrame, width: int) -> DataFrame:
    """id (key) and whole set (packed sorted hashes) of the rows of docs whose key is among wanted(id), and of a few others.

    The wanted keys go to the tasks as bits: texts need not be shuffled, and a document that shares a
    bit with a wanted one does no harm. A null key has no row.
    """
    bits, table = bit_table(wanted, F.xxhash64("id"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.filter(pa.array(is_set(bits, shared.value, batch.column("hash").to_numpy())))
            for part in slices(iter([own]), "text"):
                sets = [s.tobytes() for s in _sets(part, width)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    keyed = text_batches(docs).select(key.alias("id"), "text").where("id IS NOT NULL")
    return keyed.select("id", "text", F.xxhash64("id").alias("hash")).mapInArrow(pack, "id long, shingles binary")


def _may_link(percent: int, n: np.ndarray, pos: np.ndarray, m: int, at: int) -> np.ndarray:
    """Whether a class of m shingles with a common shingle at place at may link with those of n shingles with it at pos, if no earlier one is common."""
    need = -(-percent * (n + m) // (100 + percent))
    small, large = np.minimum(n, m), np.maximum(n, m)
    return (100 * small >= percent * large) & (np.minimum(n - pos, m - at) >= need)


def _candidates(percent: int, most_each: int = 8):
    """Pairs (a, b) of a meeting's left and right members that may link and are not connected; if they are
    more than most_each a member, one row without them: that meeting needs the whole sets."""

    def find(rows: pa.Table) -> pa.Table:
        import pyarrow.compute  # noqa: F401  here, for a worker in which nothing else has imported it

        left, right = (rows.filter(pa.compute.equal(rows.column("side"), k)) for k in (0, 1))
        own = {c: right.column(c).to_numpy() for c in ("id", "comp", "n", "pos")}
        found_a, found_b, total, most = [], [], 0, most_each * len(rows)
        for i, comp, m, at in zip(*(left.column(c).to_pylist() for c in ("id", "comp", "n", "pos")), strict=True):
            hit = own["id"][_may_link(percent, own["n"], own["pos"], m, at) & (own["comp"] != comp)]
            total += len(hit)
            if total > most:
                break
            found_a.append(np.full(len(hit), i))
            found_b.append(hit)
        dense = total > most
        a, b = (np.zeros(0, np.int64) if dense or not x else np.concatenate(x) for x in (found_a, found_b))
        if not dense and not len(a):
            return pa.table({"at": rows.column("at").slice(0, 0), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        one = pa.array([0] * max(1, len(a)))
        return pa.table({"at": rows.column("at").combine_chunks().take(one), "a": pa.array([None] if dense else a, pa.int64()), "b": pa.array([None] if dense else b, pa.int64())})

    return find


def _meeting_links(percent: int):
    """Links between the left and the right classes of a meeting that are not connected yet, as a forest."""

    def links(rows: pa.Table) -> pa.Table:
        ids, comps, pos = (rows.column(c).to_numpy() for c in ("id", "comp", "pos"))
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        is_left = rows.column("side").to_numpy() == 0
        left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            sizes = np.array([len(x) for x in sets], np.int64)
            n = sizes[right]
            names, code = np.unique(np.concatenate([sets[j] for j in right]), return_inverse=True)
            holders = np.repeat(np.arange(len(right)), n)[np.argsort(code, kind="stable")]
            begin = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(names)))])
            _, group = np.unique(comps, return_inverse=True)
            label = np.arange(group.max() + 1)  # of each component, as far as they are joined here
            for i in left:
                m = sizes[i]
                near = _may_link(percent, n, pos[right], m, pos[i]) & (label[group[right]] != label[group[i]])
                if not near.any():
                    continue
                place = np.searchsorted(names, sets[i])
                place = place[(place < len(names)) & (names[np.minimum(place, len(names) - 1)] == sets[i])]
                common = np.bincount(np.concatenate([holders[begin[k] : begin[k + 1]] for k in place]) if len(place) else np.zeros(0, np.int64), minlength=len(right))
                for j in np.flatnonzero(near & (100 * common >= percent * (n + m - common))):
                    a, b = label[group[i]], label[group[right[j]]]
                    if a != b:
                        label[label == b] = a
                        found.append((ids[i], ids[right[j]]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return links


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, sketch_bits: int = 22, few: int = 16, block_bytes: int = 4 << 20, block_rows: int = 20_000) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_shingles, component_id.

    Two documents link if 100 * |A and B| >= percent * |A or B| over their sets of
    distinct width-word shingles; component_id is the least doc_id reachable by links.
    Null and empty texts have the empty set: n_shingles 0, linked with nothing.
    Rows of one doc_id are one document. A null doc_id links with nothing and has a null
    component_id; that of an empty text is its own doc_id. Columns of docs other than doc_id and text are ignored.
    few: a prefix shingle held by more groups than this makes a list, not pairs.
    block_bytes and block_rows: sets and classes in a block of a list. They change the work, not the result.
    """
    feats = written(prefixes(docs, width, percent, sketch_bits), "prefixes")
    sets_of = feats.where("doc_id IS NOT NULL AND n > 0")
    classes = written(
        sets_of.groupBy("n", "sig").agg(F.min("doc_id").alias("id"), F.min_by("prefix", "doc_id").alias("prefix"))
        .withColumn("prefix_hash", F.xxhash64("prefix")), "classes")
    groups = classes.groupBy("n", "prefix_hash").agg(F.min("id").alias("g"), F.count("*").alias("members"))
    # most groups have one class, itself; only the others need a membership table
    wide = written(groups.where("members > 1"), "wide_groups")
    more = written(classes.join(wide, ["n", "prefix_hash"]).select("g", "id", "n"), "more_members")
    heads = classes.join(more.where("id <> g").select("id"), "id", "left_anti")

    posts = heads.select(F.col("id").alias("g"), "n", F.explode("prefix").alias("token"))
    tokens = written(
        posts.groupBy("token").agg(F.count("*").alias("k"), F.min("g").alias("low"), F.max("g").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"))
        .where("k > 1").where(f"k > 2 OR 100 * least >= {percent} * most"), "tokens")
    more_than_two = tokens.where("k > 2").select("token", "k")
    shared = written(_posts(heads, more_than_two).join(more_than_two, "token").select("token", "g", "n", "pos", "k"), "shared_posts")

    # pairs from shingles held by few groups, with the number of prefix shingles they share
    part = shared.where(f"k <= {few}")
    other = part.select("token", F.col("g").alias("g2"), F.col("n").alias("n2"))
    met = part.join(other, "token").where("g < g2").where(f"100 * least(n, n2) >= {percent} * greatest(n, n2)").select(F.col("g").alias("a"), F.col("g2").alias("b"))
    two = tokens.where("k = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    counted = met.unionByName(two).groupBy("a", "b").agg(F.count("*").alias("met"))
    # often: prefix shingles of a group that are held by many, which are not counted above
    often = shared.where(f"k > {few}").groupBy("g").agg(F.count("*").alias("often"))
    size = heads.select(F.col("id").alias("g"), "n", F.size("prefix").alias("p")).join(often, "g", "left").join(wide.select("g", "members"), "g", "left").select(
        "g", F.struct("n", "p", F.coalesce("often", F.lit(0)).alias("often"), F.coalesce("members", F.lit(1)).alias("members")).alias("x"))
    # a shared shingle that lies in no shared prefix comes after the end of one of the two prefixes
    both = lambda f, c: f(F.col(f"x.{c}"), F.col(f"y.{c}"))
    rest = F.greatest(F.col("x.n") - F.col("x.p"), F.col("y.n") - F.col("y.p"))
    need = F.ceil(F.lit(percent) * (F.col("x.n") + F.col("y.n")) / F.lit(100 + percent))
    pairs = written(
        counted.join(size.withColumnRenamed("g", "a"), "a").join(size.select(F.col("g").alias("b"), F.col("x").alias("y")), "b")
        .where(F.least(F.col("met") + both(F.least, "often") + rest, both(F.least, "n")) >= need)
        .select("a", "b", (F.col("x.members") * F.col("y.members")).alias("product")), "pairs")

    # lists of classes: kind, key, key2, id, n, pos; a pair meets first at a shingle that is early in one of the two
    early = F.col("pos") <= F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent))
    frequent = shared.where(f"k > {few}")
    used = frequent.groupBy("token").agg(F.max(early).alias("some")).where("some").select("token")
    none = F.lit(0).cast("long").alias("key2")
    by_token = frequent.join(used, "token").join(more.select("g", "id"), "g", "left").select(
        F.lit(0).alias("kind"), F.col("token").alias("key"), none, F.coalesce("id", "g").alias("id"), "n", "pos")
    by_group = more.select(F.lit(1).alias("kind"), F.col("g").alias("key"), none, "id", "n", F.lit(0).alias("pos"))
    large = pairs.where(F.col("product") > PRODUCT).select("a", "b", F.explode(F.array("a", "b")).alias("g"))
    by_pair = large.join(more, "g", "left").join(heads.select(F.col("id").alias("g"), F.col("n").alias("own")), "g").select(
        F.lit(2).alias("kind"), F.col("a").alias("key"), F.col("b").alias("key2"), F.coalesce("id", "g").alias("id"), F.coalesce("n", "own").alias("n"), F.lit(0).alias("pos"))
    lists = written(by_token.unionByName(by_group).unionByName(by_pair).withColumn("band", F.floor(F.log("n") / F.log(F.lit(BAND))).cast("int")), "lists")
    key = ["kind", "key", "key2"]
    member = F.struct("id", "n", "pos")
    pivots = written(lists.groupBy(*key, "band").agg(F.min_by(member, F.struct("pos", "id")).alias("y")), "pivots")
    next_band = F.lead("y").over(W.partitionBy(*key).orderBy("band"))
    star = lists.join(pivots, [*key, "band"]).select(member.alias("x"), "y").unionByName(pivots.select(F.col("y").alias("x"), next_band.alias("y")))
    star = star.where(F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= need).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))

    # group pairs become class pairs; with the pivots they are verified on whole sets
    expanded = pairs.where(F.col("product") <= PRODUCT).join(more.select(F.col("g").alias("a"), F.col("id").alias("ia")), "a", "left").join(
        more.select(F.col("g").alias("b"), F.col("id").alias("ib")), "b", "left").select(F.coalesce("ia", "a").alias("a"), F.coalesce("ib", "b").alias("b"))
    class_pairs = written(expanded.unionByName(star).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "class_pairs")
    wanted = written(class_pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(lists.select("id")).distinct(), "wanted")
    sets = written(set_table(docs, F.col("doc_id").cast("long"), wanted, width), "sets")

    def verified(some: DataFrame) -> DataFrame:
        both = some.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
        return both.mapInArrow(_verify(percent), "a long, b long")

    first = written(verified(class_pairs), "first_links")
    joined = components(first)

    # lists whose classes are not connected: those outside the largest component meet all, first without their sets
    named = written(lists.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component", "band"), "named")
    parts = named.groupBy(*key, "comp").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    blocks_of = lambda n, c: F.ceil(F.greatest(n * 8 / block_bytes, c / block_rows)).cast("int")
    open_lists = written(
        parts.groupBy(*key).agg(F.max_by(F.struct("comp", "n", "c"), F.struct("c", "comp")).alias("main"), F.count("*").alias("comps"), F.sum("n").alias("n"), F.sum("c").alias("c"))
        .where("comps > 1").select(*key, F.col("main.comp").alias("main"), blocks_of(F.col("n"), F.col("c")).alias("blocks"),
                                   blocks_of(F.col("n") - F.col("main.n"), F.col("c") - F.col("main.c")).alias("loose_blocks")), "open_lists")
    own = named.join(open_lists, key)
    block = lambda of: F.pmod(F.xxhash64("id"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    cells = ["id", "comp", "n", "pos", *key]
    loose = own.where("comp <> main").select(*cells, F.lit(0).alias("side"), block("loose_blocks").alias("i"), every("blocks").alias("j"))
    whole = own.select(*cells, F.lit(1).alias("side"), every("loose_blocks").alias("i"), block("blocks").alias("j"))
    meets = loose.unionByName(whole).select(F.struct(*key, "i", "j").alias("at"), "id", "comp", "n", "pos", "side")
    at = "at struct<kind: int, key: long, key2: long, i: int, j: int>"
    found = written(meets.groupBy("at").applyInArrow(_candidates(percent), f"{at}, a long, b long"), "candidates")
    rest_pairs = found.where("a IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    dense = meets.join(found.where("a IS NULL").select("at"), "at", "left_semi").join(sets, "id")
    second = verified(rest_pairs).unionByName(dense.groupBy("at").applyInArrow(_meeting_links(percent), "a long, b long"))

    # several texts of one doc_id are one document: their classes are linked through it
    several = sets_of.groupBy("doc_id").agg(F.min(F.struct("n", "sig")).alias("x"), F.max(F.struct("n", "sig")).alias("y")).where("x <> y").select("doc_id")
    same = sets_of.select("doc_id", "n", "sig").join(several, "doc_id").join(classes.select("n", "sig", "id"), ["n", "sig"]).select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    tree = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    links = written(tree.unionByName(second).unionByName(same), "links")
    linked = components(links)
    labels = classes.select("n", "sig", "id").join(linked.withColumnRenamed("node", "id"), "id", "left").select("n", "sig", F.coalesce("component", "id").alias("component_id"))
    result = feats.select("doc_id", "n", "sig").join(labels, ["n", "sig"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    out = written(result.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))), "result")
    discard(feats, classes, wide, more, tokens, shared, pairs, lists, pivots, class_pairs, wanted, sets, first, joined, named, open_lists, found, links, linked)
    return out


def _verify(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return check


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs without near copies: of each component the rows of its least doc_id stay.

    Of equal texts of one doc_id the row stays whose other columns, as JSON, are least; different texts of one
    doc_id are one document and stay all. Documents with a null doc_id stay: they link with nothing.
    """
    found = jaccard_components(docs, width, percent)
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("component_id").alias("least"))
    named = written(ids.where("least < doc_id OR rows > 1").select(F.col("doc_id").alias("__id"), (F.col("least") < F.col("doc_id")).alias("__gone")), "named_ids")
    others, doubtful = _split(docs, named)
    plain = doubtful.join(named, F.col("doc_id") == F.col("__id"), "left_anti")
    again = doubtful.join(named.where("NOT __gone").select("__id"), F.col("doc_id") == F.col("__id"), "left_semi")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    others_of = F.struct(*[F.col(f"`{c}`") for c in rest])  # JSON, unlike the struct, has an order whatever the columns' types
    once = again.groupBy("doc_id", "text").agg(F.min_by(others_of, F.to_json(others_of)).alias("__r") if rest else F.count("*").alias("__r"))
    once = once.select(*[F.col(f"__r.`{c}`").alias(c) if c in rest else F.col(c) for c in docs.columns])
    return others.unionByName(plain).unionByName(once)


def _split(docs: DataFrame, ids: DataFrame, cells: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(rows of docs whose doc_id is surely not among ids(__id), null ones too; the others).

    Hashes of the ids, at most cells numbers, are broadcast: a document whose own is not among them needs no join on its id.
    """
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(cells)).cast("int")
    marked = ids.select(cell("__id").alias("__cell")).distinct()
    on = cell("doc_id") == F.col("__cell")
    named = docs.where("doc_id IS NOT NULL")
    return named.join(F.broadcast(marked), on, "left_anti").unionByName(docs.where("doc_id IS NULL")), named.join(F.broadcast(marked), on, "left_semi")
