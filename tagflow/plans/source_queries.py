"""Queries on sources, sinks, pixels, prompts and clients.

What a source reads is first written to the shared folder from a table, in the format that it
reads: CSV, JSON, YAML, images.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tagflow.functions import annotations as A
from tagflow.functions import prompts as P
from tagflow.operators import joins as J
from tagflow.operators import pixels as X
from tagflow.operators import tagging as T
from tagflow.operators.calls import Journal, call_batch
from tagflow.operators.calls import read_journal as journal_rows
from tagflow.plans.evaluation_queries import ATTRS, LONG, scores_long
from tagflow.plans.label_queries import FLAGS, TAGS, tags
from tagflow.plans.registry import query, table
from tagflow.sources import tables as B
from tagflow.sources.catalog import IMAGE_COUNTS, image_catalog, read_images
from tagflow.sources.listing import list_files as files_below
from tagflow.sources.listing import opened
from tagflow.sources.scratch import shared_dir


def place(spark, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/tagflow/{uuid.uuid4().hex}/{name}"


# ---- label tables, annotations, taxonomies, wide sinks


@query("SELECT CAST(p_partkey AS VARCHAR) AS name, CASE WHEN p_partkey % 4 > 0 THEN p_name END AS label, CAST(p_size AS INTEGER) AS size FROM part")
def read_label_csv(spark, d):
    """A manifest in which missing labels stand as different words."""
    words = F.when(F.col("p_partkey") % 12 == 0, "NA").when(F.col("p_partkey") % 12 == 4, "nan").when(F.col("p_partkey") % 12 == 8, "None")
    path = place(spark, "labels")
    table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("name"), F.coalesce(words, "p_name").alias("label"), F.col("p_size").cast("int").alias("size")).write.csv(path, header=True)
    return B.read_label_csv(spark, path, "name string, label string, size int")


TASKS_A_FILE = 200


@query("""WITH c AS (SELECT conv_id, string_agg('t' || (length(text) % 10), '|' ORDER BY turn) FILTER (role = 'user') AS users FROM conversations GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS name, 'http://h/' || conv_id || '.jpg' AS image, coalesce(users, '') AS choices FROM c""")
def read_annotations(spark, d):
    """Exported tasks, a JSON array of at most TASKS_A_FILE tasks in each file; conversations are the tasks, choices come from users' turns."""
    choice = F.when(F.col("role") == "user", F.concat(F.lit("t"), (F.length("text") % 10).cast("string")))
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.when(choice.isNotNull(), F.struct("turn", choice.alias("c"))))), lambda x: x["c"]).alias("choices"))
    name = F.col("conv_id").cast("string")
    result = F.array(F.struct(F.lit("construction").alias("from_name"), F.struct("choices").alias("value")))
    task = F.struct(F.struct(F.concat(F.lit("http://h/"), name, F.lit(".jpg")).alias("image"), name.alias("name")).alias("data"), F.array(F.struct(result.alias("result"))).alias("annotations"))
    files = turns.groupBy(F.floor(F.col("conv_id") / TASKS_A_FILE).alias("part")).agg(F.to_json(F.collect_list(task)).alias("value"))
    path = place(spark, "tasks")
    files.write.partitionBy("part").text(path)
    found = B.read_annotations(spark, path)
    return found.select("data.name", "data.image", F.array_join(A.choices_of(A.first_result(F.col("annotations")), "construction"), "|").alias("choices"))


TAXONOMY = {"_note": ["kept as a note"], "steel": ["bolt", "nut"], "wheel": ["Gear", "ring"], "cable": None}


@query("""SELECT p_partkey, CASE WHEN w IN ('bolt', 'nut', 'steel') THEN 'steel' WHEN w IN ('gear', 'ring', 'wheel') THEN 'wheel' WHEN w = 'cable' THEN 'cable' ELSE '_unknown' END AS canonical
 FROM (SELECT p_partkey, lower(split_part(p_name, ' ', 2)) AS w FROM part)""")
def alias_table(spark, d):
    """The second word of each part by a taxonomy, which is written as YAML and read as an alias table."""
    path = place(spark, "taxonomy")
    spark.createDataFrame([(json.dumps(TAXONOMY),)], "value string").coalesce(1).write.text(path)  # JSON is YAML
    parts = table(spark, d, "part").select("p_partkey", F.upper(F.get(F.split("p_name", " "), F.lit(1))).alias("term"))
    return J.normalize_terms(parts, "term", B.alias_table(spark, path), "canonical").select("p_partkey", "canonical")


@query(LONG + " SELECT name, " + ", ".join(f"max(CASE WHEN attr = '{a}' THEN {c} END) AS {p}_{a}" for a in ATTRS for c, p in (("score", "prob"), ("pred", "pred"))) + " FROM x GROUP BY 1")
def write_wide_csv(spark, d):
    path = place(spark, "wide")
    B.write_wide_csv(scores_long(spark, d), list(ATTRS), {"score": "prob_", "pred": "pred_"}, path)
    return spark.read.csv(path, header=True, schema="name string, " + ", ".join(f"prob_{a} double, pred_{a} int" for a in ATTRS))


@query("SELECT DISTINCT 'flag=' || l_returnflag AS category, 'status=' || l_linestatus AS subcategory, 'parquet' AS ext, 0 AS n_empty FROM lineitem", name="image_catalog")
def image_catalog_files(spark, d):
    """Folders of files that Spark wrote, listed as a catalogue of the suffix parquet."""
    path = place(spark, "catalogue")
    table(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).write.partitionBy("flag", "status").parquet(path)
    found = image_catalog(spark, path, ("parquet",))
    return found.groupBy("category", "subcategory", "ext").agg(F.count_if(F.col("length") == 0).cast("int").alias("n_empty"))


# ---- pixels: an image a supplier, 4 wide, 2 to 4 high, of one colour

COLOURS = {"red": "s_suppkey % 50", "green": "s_suppkey % 40 + 10", "blue": "s_suppkey % 30 + 60"}
SIDE = 4


def bitmap():
    """The bytes of a supplier's bitmap, as text: all are below 128."""
    byte = lambda c: F.char(c.cast("long"))
    number = lambda c: F.concat(byte(c), F.lit("\0\0\0"))
    high = F.col("s_suppkey") % 3 + 2
    pixel = F.concat(*[byte(F.expr(COLOURS[c])) for c in ("blue", "green", "red")])
    head = F.concat(F.lit("BM"), number(high * 12 + 54), F.lit("\0\0\0\0"), number(F.lit(54)), number(F.lit(40)), number(F.lit(SIDE)), number(high), F.lit("\1\0"), byte(F.lit(24)), F.lit("\0" * 25))
    return F.concat(head, F.repeat(pixel, (high * SIDE).cast("int")))


def write_images(images: DataFrame, path: str) -> None:
    """images(s_suppkey, value) as files below path that tasks write, 1,000 in a folder: the driver neither writes nor renames any."""
    tasks = int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base, _ = opened(path)
        for batch in batches:
            for key, value in zip(batch.column("s_suppkey").to_pylist(), batch.column("value").to_pylist(), strict=True):
                folder = f"{base}/{key // 1000}"
                own = f"{folder}/_{uuid.uuid4().hex}"
                system.create_dir(folder, recursive=True)
                with system.open_output_stream(own) as f:  # a repeated task replaces whole files
                    f.write(value)
                system.move(own, f"{folder}/{key}.bmp")
            yield batch.select(["s_suppkey"])

    rows = images.select(F.col("s_suppkey").cast("long"), F.col("value").cast("binary"))
    rows.repartition(tasks, "s_suppkey").mapInArrow(write, "s_suppkey long").write.format("noop").mode("overwrite").save()


def supplier_images(spark, d) -> DataFrame:
    """Bitmaps in files of their own."""
    path = place(spark, "images")
    write_images(table(spark, d, "supplier").select("s_suppkey", bitmap().alias("value")), path)
    return read_images(spark, path)


def _supplier():
    return F.col("name").cast("long").alias("s_suppkey")


@query("SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, 4 AS width, CAST(s_suppkey % 3 + 2 AS INTEGER) AS height, 3 AS channels, lower(hex(chr(CAST(s_suppkey % 30 + 60 AS INTEGER)))) AS first_blue FROM supplier", name="read_images")
def read_images_files(spark, d):
    return supplier_images(spark, d).select(_supplier(), "width", "height", "channels", F.lower(F.hex(F.substring("data", 1, 1))).alias("first_blue"))


@query("SELECT count(*) FILTER (s_suppkey % 5 > 0) AS decoded, count(*) FILTER (s_suppkey % 5 = 0) AS failed, 0::BIGINT AS unsupported FROM supplier")
def read_images_counts(spark, d):
    """Every fifth file holds words, not an image: what the reading query counts."""
    path = place(spark, "images")
    value, names = bitmap(), table(spark, d, "supplier")
    write_images(names.select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, "no image").otherwise(value).alias("value")), path)
    counts = Observation("images")
    read_images(spark, path, counts=counts).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(counts.get[c] for c in IMAGE_COUNTS)], ", ".join(f"{c} long" for c in IMAGE_COUNTS))


@query("SELECT count(DISTINCT l_returnflag) AS folders, count(DISTINCT l_returnflag) FILTER (l_returnflag LIKE 'A%') AS kept FROM lineitem")
def list_files(spark, d):
    """Folders listed in tasks, and those whose paths begin in one way."""
    path = place(spark, "listed")
    table(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("mode")).write.partitionBy("mode").parquet(path)
    conf = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "true")
    try:
        found = files_below(spark, path)
        folder = F.regexp_extract("path", "mode=([^/]*)/", 1)
        some = found.where(F.startswith("path", F.lit("file:" + path.split("://")[-1] + "/mode=A")))
        n, kept = (df.agg(F.count_distinct(folder)).first()[0] for df in (found, some))
    finally:
        spark.conf.set(conf, before)
    return spark.createDataFrame([(n, kept)], "folders long, kept long")


def _prepared(spark, d) -> DataFrame:
    return X.prepare_pixels(supplier_images(spark, d), SIDE)


_mean = lambda c: f"(({COLOURS[c]}) * h + 255 * (4 - h)) / 4.0::DOUBLE"
_square = lambda c: f"(({COLOURS[c]}) * ({COLOURS[c]}) * h + 255 * 255 * (4 - h)) / 4.0::DOUBLE"


@query("SELECT CAST(s_suppkey AS VARCHAR) AS name, 4 AS height, 4 AS width, 192 AS n_bytes, " + ", ".join(f"{_mean(c)} AS mean_{c}, {_square(c)} AS square_{c}" for c in COLOURS) + " FROM (SELECT *, s_suppkey % 3 + 2 AS h FROM supplier)")
def prepare_pixels(spark, d):
    cells = [F.get(k, F.lit(i)).alias(f"{n}_{c}") for i, c in enumerate(COLOURS) for k, n in (("sums", "mean"), ("squares", "square"))]
    return _prepared(spark, d).select("name", "height", "width", F.length("pixels").alias("n_bytes"), *cells)


STATS = ([128.0, 100.0, 90.0], [10.0, 20.0, 25.0])  # the means are then whole multiples of 1/400


@query("SELECT CAST(s_suppkey AS VARCHAR) AS name, " + ", ".join(f"round(({_mean(c)} - {m}) / {s}, 5) AS mean_{c}" for c, m, s in zip(COLOURS, *STATS)) + " FROM (SELECT *, s_suppkey % 3 + 2 AS h FROM supplier)")
def normalise_pixels(spark, d):
    """The channel means of the normalised pixels."""

    @F.arrow_udf("array<double>")
    def means(pixels: pa.Array) -> pa.Array:
        import numpy as np

        return pa.array([np.frombuffer(x, np.float32).reshape(3, -1).mean(1, dtype=np.float64).tolist() for x in pixels.to_pylist()], pa.list_(pa.float64()))

    found = X.normalise_pixels(_prepared(spark, d), *STATS).select("name", means("pixels").alias("m"))
    return found.select("name", *[F.round(F.get("m", F.lit(i)), 5).alias(f"mean_{c}") for i, c in enumerate(COLOURS)])


# ---- prompts

UNGROUNDED = "Describe only what the picture shows of the product, in at most 60 words.\nAnswer as JSON with the key \"description\"."
GROUNDED = ("Describe the product in the picture in at most 60 words. These tags are checked; agree with them:\n", "\nAnswer as JSON with the key \"description\".")
_text = lambda x: "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@query(TAGS + f"SELECT name, md5(CASE WHEN fur THEN {_text(GROUNDED[0])} || 'Toe shape: ' || toe_shape || {_text(GROUNDED[1])} ELSE {_text(UNGROUNDED)} END) AS prompt FROM t")
def ungrounded_prompt(spark, d):
    """The prompt of each image: with its tags where they are checked (here: fur), else without."""
    none = F.array().cast("array<string>")
    block = P.tag_block(F.col("toe_shape"), F.lit(None).cast("string"), none, none)
    return tags(spark, d).select("name", F.md5(F.when(F.col("fur"), P.grounded_prompt(block)).otherwise(P.ungrounded_prompt())).alias("prompt"))


@query("SELECT event_id, md5('Choose one value for each key and answer as JSON.' || chr(10) || 'toe_shape: round, pointed' || chr(10) || 'heel_type: flat' || chr(10) || event_type) AS prompt FROM events")
def choice_prompt(spark, d):
    prompt = P.choice_prompt({"toe_shape": ["round", "pointed"], "heel_type": ["flat"]})
    return table(spark, d, "events").select("event_id", F.md5(F.concat(F.lit(prompt + "\n"), "event_type")).alias("prompt"))


@query(TAGS + f"SELECT name, md5('Answer as JSON with true or false for each name.' || chr(10) || 'all: {', '.join(FLAGS)}' || chr(10) || name) AS prompt FROM t")
def flags_prompt(spark, d):
    return tags(spark, d).select("name", F.md5(F.concat(F.lit(P.flags_prompt({"all": list(FLAGS)}) + "\n"), "name")).alias("prompt"))


# ---- clients


class PatternClient:
    """Stands for a vendor's client: what it answers, and when it fails, follows from the row's number.

    Of ten rows one always fails, one only at the first try, one answers in words, one in code fences.
    """

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def __call__(self, row: dict, prompt: str) -> str:
        n, tries = int(row["name"]), self.seen.get(row["name"], 0)
        self.seen[row["name"]] = tries + 1
        if n % 10 == 0 or (n % 10 == 1 and not tries):
            raise TimeoutError("busy")
        if n % 10 == 2:
            return "I cannot say."
        kind = row["event_type"]
        answer = json.dumps({"toe_shape": kind, "description": f"{prompt} {kind}", "heel_name": f"heel {kind}", "heel_alternative_names": [kind, "heel"], "toe_name": "round", "toe_alternative_names": []})
        return f"```json\n{answer}\n```" if n % 10 == 3 else answer


def calls(spark, d) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").cast("string").alias("name"), "event_type", (F.col("event_id") % 2 == 0).alias("grounded"))


@query("""SELECT CAST(event_id AS VARCHAR) AS name, event_type, CASE event_id % 10 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS attempts, CASE WHEN event_id % 10 = 0 THEN 'TimeoutError: busy' END AS error,
 CASE WHEN event_id % 10 = 2 THEN 'I cannot say.' WHEN event_id % 10 > 0 THEN event_type END AS answer FROM events""")
def tag_batch(spark, d):
    answers = T.tag_batch(calls(spark, d).drop("grounded"), PatternClient, "Tag the picture.", delay=0.0, in_flight=4)
    from tagflow.functions.responses import parse_model_json

    toe = F.try_element_at(parse_model_json(F.col("raw")), F.lit("toe_shape"))
    return answers.select("name", "event_type", "attempts", "error", F.coalesce(toe, "raw").alias("answer"))


@query("""SELECT CAST(event_id AS VARCHAR) AS name, CASE WHEN event_id % 10 IN (0, 2) THEN '' ELSE CASE WHEN event_id % 2 = 0 THEN 'With tags:' ELSE 'Without:' END || ' ' || event_type END AS description,
 event_id % 2 = 0 AS grounded, 'v3' AS prompt_version FROM events""")
def describe_batch(spark, d):
    return T.describe_batch(calls(spark, d), PatternClient, F.lit("With tags:"), F.lit("Without:"), "v3", delay=0.0, in_flight=4)


@query("""SELECT CAST(event_id AS VARCHAR) AS name, CASE WHEN event_id % 10 NOT IN (0, 2) THEN 'heel ' || event_type END AS heel_name, CASE WHEN event_id % 10 NOT IN (0, 2) THEN event_type || '|heel' END AS heel_alternative_names,
 NULL::VARCHAR AS toe_name FROM events""")
def probe_batch(spark, d):
    found = T.probe_batch(calls(spark, d), PatternClient, "heel", delay=0.0, in_flight=4)
    return found.select("name", "heel_name", F.array_join("heel_alternative_names", "|").alias("heel_alternative_names"), "toe_name")


class NoClient:
    """Stands where no call may be made."""

    def __call__(self, row: dict, prompt: str) -> str:
        raise AssertionError("a call that was paid for is made again")


@query("""SELECT CAST(event_id AS VARCHAR) AS name, CASE event_id % 10 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS attempts, event_id % 10 = 0 AS failed FROM events""")
def tag_batch_journal(spark, d):
    """Tags with a journal, then once more without a client: all answers, failed ones too, come from the journal."""
    journal = Journal(place(spark, "journal"), buckets=64, every=500)
    rows = calls(spark, d).select("name", "event_type")
    T.tag_batch(rows, PatternClient, "Tag the picture.", delay=0.0, in_flight=4, journal=journal).write.format("noop").mode("overwrite").save()
    again = T.tag_batch(rows, NoClient, "Tag the picture.", attempts=1, journal=journal)
    return again.select("name", "attempts", F.col("raw").isNull().alias("failed"))


@query("SELECT count(DISTINCT event_type) AS prompts, count(*) AS answers, count(DISTINCT event_id) AS names FROM events")
def read_journal(spark, d):
    """A journal by itself: each key, of name and prompt, once."""
    journal = Journal(place(spark, "journal"), buckets=64, every=500)
    rows = calls(spark, d)
    twice = rows.unionByName(rows)  # repeated rows are asked for once
    call_batch(twice, PatternClient, F.col("event_type"), delay=0.0, in_flight=4, journal=journal).write.format("noop").mode("overwrite").save()
    kept = journal_rows(spark, journal)
    return kept.join(rows.select("name", "event_type"), "name").agg(F.count_distinct("event_type").alias("prompts"), F.count_distinct("key").alias("answers"), F.count_distinct("name").alias("names"))
