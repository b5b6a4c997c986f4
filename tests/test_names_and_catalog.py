import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tagflow.functions import names as N
from tagflow.operators import catalog as C
from tagflow.operators import filters as L
from tagflow.operators import joins as J
from tagflow.operators import pixels as X
from tagflow.sources.catalog import catalog_from_paths, filter_category, image_catalog, read_images
from tagflow.sources.tables import alias_pairs, alias_table, label_vocabulary, na_to_null, preannotation_tasks, read_annotations, read_label_csv, tags_to_nested, write_wide_csv


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


@pytest.mark.parametrize("path,stem,ext", [("a/b.c.jpg", "b.c", "jpg"), ("/x/.jpg", ".jpg", ""), ("X.JPG", "X", "jpg"), ("a/b", "b", ""), ("file:/r/é 1.png", "é 1", "png")])
def test_stem_and_ext(spark, path, stem, ext):
    assert (one(spark, N.stem(F.lit(path))), one(spark, N.ext(F.lit(path)))) == (stem, ext)


def test_scalars(spark):
    assert [one(spark, N.is_true(F.lit(v))) for v in (True, " TRUE", "1", 0, "no", "", 2.5)] == [True, True, True, False, False, False, True]
    assert one(spark, N.is_true(F.lit(None))) is False
    assert [one(spark, N.clean_raw_labels(F.lit(v))) for v in ("No-Spec", None, "Ankle Strap_platform")] == ["", "", "ankle-strap|platform"]
    assert one(spark, N.multi_hot(F.lit("ankle-strap | platform"), ["platform", "strap", "ankle-strap"])) == [1, 0, 1]
    assert one(spark, N.multi_hot(F.lit(None).cast("string"), ["a"])) == [0]
    assert one(spark, N.pred_tokens(F.lit("a, b|c"))) == ["a", "b", "c"]
    assert one(spark, N.class_index(F.lit("b"), ["a", "b"])) == 1
    with pytest.raises(Exception, match="not a class: z"):
        one(spark, N.class_index(F.lit("z"), ["a", "b"]))
    assert one(spark, N.normalise_url(F.lit("http://h/p_480.jpg"))) == "http://h/p_1000.jpg" and one(spark, N.base_url(F.lit("http://h/p_480.jpg?x=1"))) == "http://h/p"
    assert one(spark, N.asset_name(F.lit("boots"), F.lit(7), "ff")) == "boots_ff_0007"
    assert tuple(one(spark, N.resize_dims(F.lit(4000), F.lit(1001), 1568))) == (1568, 392) and tuple(one(spark, N.resize_dims(F.lit(9), F.lit(5), 1568))) == (9, 5)
    assert [one(spark, N.route_photo(F.lit(v))) for v in ("photo", "drawing", "other")] == ["photo", "sketch", None]


PATHS = ["r/c1/s1/a.jpg", "r/c1/s1/x/a.jpg", "r/c1/s2/b.jpg", "r/c2/s1/b.jpg", "r/c1/a.jpg", "r/a-b/z.png", "r/a/b/z.png", "r/infer/q.jpg", "r/infer.v1/q.jpg", "r/c1/s1/t.txt", "r/top.jpg", "r/c1/s1/U.JPG"]


@pytest.fixture(scope="module")
def images(spark):
    return catalog_from_paths(spark.createDataFrame([(p,) for p in PATHS], "path string"), root="r")


def test_catalog_of_paths(images):
    got = {r.path: (r.name, r.ext, r.category, r.subcategory) for r in images.collect()}
    assert got["r/c1/s1/x/a.jpg"] == ("a", "jpg", "c1", "s1") and got["r/c1/a.jpg"] == ("a", "jpg", "c1", None) and got["r/top.jpg"] == ("top", "jpg", None, None)
    assert "r/infer/q.jpg" not in got and "r/infer.v1/q.jpg" in got and "r/c1/s1/t.txt" not in got and got["r/c1/s1/U.JPG"][1] == "jpg"
    with pytest.raises(ValueError):
        filter_category(images, "none")


def test_duplicates_and_quarantine(images):
    dups = C.duplicate_stems(images).collect()
    assert [(d.category, d.name, d.occurrences, d.distinct_subcats) for d in dups] == [("c1", "a", 2, 1)]
    assert [o.path for o in dups[0].occ] == ["r/c1/s1/a.jpg", "r/c1/s1/x/a.jpg"]
    plan = C.quarantine_plan(C.duplicate_stems(images), "/q/").collect()
    assert {p.quarantine_path for p in plan} == {"/q/a__s1.jpg"} and all(p.clash and p.action == "" for p in plan)


def test_first_paths_compare_by_parts(images):
    first = {r.name: r.path for r in C.first_by_stem(images).collect()}
    assert first["z"] == "r/a/b/z.png" and first["a"] == "r/c1/a.jpg"
    best = {r.name: r.path for r in J.best_paths(images).collect()}
    assert best["top"] == "r/top.jpg"
    manifest = C.manifest_from_folders(images, {"c1": "first"}, ["c1"]).collect()
    assert {(m.Class, m.name, m.path) for m in manifest} == {("first", "a", "r/c1/a.jpg"), ("first", "b", "r/c1/s2/b.jpg"), ("first", "U", "r/c1/s1/U.JPG")}
    assert {(m.kept_path, m.skipped_path) for m in C.manifest_duplicates(images).collect()} == {("r/c1/a.jpg", "r/c1/s1/a.jpg"), ("r/c1/a.jpg", "r/c1/s1/x/a.jpg")}


def test_rules(spark):
    rules = [L.Rule("parka", ("parka",)), L.Rule("fur jacket", ("fur",)), L.Rule("bomber", ("flight",), ("flight_suit",)), L.Rule("biker", ("moto",))]
    names = ["Faux_Fur_Hood_Parka", "Fur Jacket", "Flight_Suit", "Moto-Jacket", "Moto_Top", "Waffle-Textured_Moto_Jacket", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.label for r in L.classify_by_rules(df, "name", ["top"], ["Waffle-Textured_Moto_Jacket"], rules).collect()}
    assert got == dict(zip(names, ["parka", "fur jacket", None, "biker", None, None, None]))


def test_quality_gate_bounds(spark):
    df = spark.createDataFrame([(300, 300), (299, 400), (750, 300), (751, 300), (300, 1200), (300, 1201), (-1, -1), (None, 5)], "width int, height int")
    assert [r.reason for r in L.quality_gate(df).collect()] == ["", "too_small(299x400)", "", "bad_aspect", "", "bad_aspect", "decode_error", "decode_error"]


def test_numbering_quota_and_curation(spark):
    df = spark.createDataFrame([("fur jacket", f, n) for f, n in (("b", "2"), ("a", "9"), ("a", "1"))] + [("x", "a", "1")], "label string, folder string, file string")
    assert {(r.folder, r.file): r.new_name for r in C.number_per_label(df).where("label = 'fur jacket'").collect()} == {("a", "1"): "fur_jacket_00001", ("a", "9"): "fur_jacket_00002", ("b", "2"): "fur_jacket_00003"}
    items = spark.createDataFrame([(0, "k1", "g"), (1, "k1", "h"), (2, "k2", "h"), (3, "k3", "h"), (4, "k4", "h"), (5, "k5", "no")], "pos int, key string, grp string")
    got = C.quota_per_group(items, "grp", "key", 2, "pos", ["g", "h"]).collect()
    assert sorted((r.key, r.grp) for r in got) == [("k1", "g"), ("k2", "h"), ("k3", "h")]
    assets = spark.createDataFrame([("c", 0, b"x", 400, 400), ("c", 1, b"x", 400, 400), ("d", 2, b"x", 400, 400), ("c", 3, b"y", 10, 10), ("c", 4, b"z", 400, 500)], "category string, pos int, content binary, width int, height int")
    assert sorted((r.category, r.pos, r.name) for r in C.curate_assets(assets, 5).collect()) == [("c", 0, "c_ff_0001"), ("c", 4, "c_ff_0002"), ("d", 2, "d_ff_0001")]
    assert C.dedup_by_content(C.dedup_by_content(assets)).count() == C.dedup_by_content(assets).count() == 4


def test_numbering_keeps_null_folders_and_labels(spark):
    rows = [("a", None, "2"), ("a", None, "1"), ("a", "b", "0"), ("a", "b", None), (None, "b", "1"), (None, None, "1"), ("z z", "f", "x"), ("a", "b", "0")]
    out = C.number_per_label(spark.createDataFrame(rows, "label string, folder string, file string"), 2).collect()
    assert sorted(((r.label, r.folder, r.file) for r in out), key=repr) == sorted(rows, key=repr)
    got = sorted((r.new_name, r.folder, r.file) for r in out if r.label == "a")
    assert got == [("a_01", None, "1"), ("a_02", None, "2"), ("a_03", "b", None), ("a_04", "b", "0"), ("a_05", "b", "0")]
    assert [r.new_name for r in out if r.label is None] == [None, None] and [r.new_name for r in out if r.label == "z z"] == ["z_z_01"]
    assert C.number_per_label(spark.createDataFrame([], "label string, folder string, file string")).count() == 0


def test_numbering_splits_a_large_folder(spark):
    rows = [("a", "f", f"{i:05d}") for i in range(3000)] + [("b", "f", f"{i:05d}") for i in range(10)]
    df = spark.createDataFrame(rows, "label string, folder string, file string").repartition(7)
    out = C.number_per_label(df)
    assert sorted((r.label, r.file, r.new_name) for r in out.collect()) == [(a, f, f"{a}_{int(f) + 1:05d}") for a, _, f in rows]


def test_earlier_sums_and_places(spark):
    import random

    from tagflow.operators.ranking import earlier_sums, place_in

    rng = random.Random(3)
    rows = [(None if i % 13 == 0 else i % 3, rng.randrange(1000) * 1000 + i, rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, o long, v long").repartition(5)
    got = {r.o: (r.s, r.n) for r in earlier_sums(df, ["o"], {"s": F.col("v"), "n": F.lit(1)}).collect()}
    assert got == {o: (sum(v for _, p, v in rows if p < o), sum(p < o for _, p, _ in rows)) for _, o, _ in rows}
    places = {r.o: r.place for r in place_in(df, ["g"], ["o"]).collect()}
    assert places == {o: sum(p < o for h, p, _ in rows if h == g) for g, o, _ in rows}
    assert earlier_sums(df.limit(0), ["o"], {"s": F.col("v")}).columns == ["g", "o", "v", "s"] and place_in(df.limit(0), ["g"], ["o"]).count() == 0


@pytest.mark.parametrize("height,width,channels,size", [(7, 13, 3, 5), (1100, 30, 1, 16), (3, 2, 4, 8), (40, 40, 3, 40)])
def test_pixels_equal_a_plain_resize(height, width, channels, size):
    import numpy as np

    data = np.random.default_rng(1).integers(0, 256, (height, width, channels), np.uint8)
    got = X.square_pixels(data.tobytes(), height, width, channels, size)
    side = max(height, width)
    square = np.full((side, side, 3), 255.0)
    top, left = (side - height) // 2, (side - width) // 2
    square[top : top + height, left : left + width] = np.repeat(data, 3, 2) if channels == 1 else data[:, :, 2::-1]
    w = X._weights(side, size).astype(float)
    assert got.dtype == np.float32 and np.abs(got - np.einsum("ij,jkc,lk->ilc", w, square, w)).max() < 0.01


def png(width, height, rgb):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    row = b"\0" + bytes(rgb) * width
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(row * height)) + chunk(b"IEND", b"")


def test_files_images_and_pixels(spark, tmp_path):
    for place, data in (("c/s/a.png", png(4, 2, (10, 20, 30))), ("c/s/bad.png", b"junk"), ("infer/z.png", png(2, 2, (1, 1, 1)))):
        (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / place).write_bytes(data)
    found = {r.name: (r.category, r.subcategory, r.length > 0) for r in image_catalog(spark, str(tmp_path)).collect()}
    assert found == {"a": ("c", "s", True), "bad": ("c", "s", True)}
    images = read_images(spark, str(tmp_path / "c"))
    assert [(r.name, r.width, r.height) for r in images.collect()] == [("a", 4, 2)]
    row = X.prepare_pixels(images, 4).first()
    import numpy as np

    px = np.frombuffer(row.pixels, np.float32).reshape(4, 4, 3)
    assert px[0].tolist() == [[255] * 3] * 4 and px[1].tolist() == [[10, 20, 30]] * 4 and px[2].tolist() == [[10, 20, 30]] * 4
    assert row.sums == pytest.approx([(10 + 255) / 2, (20 + 255) / 2, (30 + 255) / 2])


def test_area_resize_equals_a_plain_loop():
    import numpy as np

    rng = np.random.default_rng(0)
    img = rng.integers(0, 256, (6, 6, 3), dtype=np.uint8)
    small = X.square_pixels(img[:, :, ::-1].tobytes(), 6, 6, 3, 3)
    want = img.astype(float).reshape(3, 2, 3, 2, 3).mean((1, 3))
    assert small == pytest.approx(want, abs=1e-4)
    gray = X.square_pixels(bytes([7] * 15), 5, 3, 1, 5)
    assert gray[0, 1].tolist() == [7, 7, 7] and gray[0, 0].tolist() == [255] * 3 and gray[0, 4].tolist() == [255] * 3
    assert X.square_pixels(bytes([1, 2, 3, 99] * 4), 2, 2, 4, 2)[0, 0].tolist() == [3, 2, 1]
    assert X.normalise_array(np.zeros((2, 2, 3)), np.full(3, 128.0), np.full(3, 50.0))[0, 0, 0] == pytest.approx(-2.56)


def test_label_csv_and_taxonomy(spark, tmp_path):
    (tmp_path / "l.csv").write_text('name,label\na,NA\nb,""\nc,belted_cropped\nd,null\ne,chest_pocket\n')
    got = {r.name: r.label for r in read_label_csv(spark, str(tmp_path / "l.csv"), "name string, label string").collect()}
    assert got == {"a": None, "b": None, "c": "belted_cropped", "d": None, "e": "chest_pocket"}
    assert one(spark, na_to_null(F.lit("nan"))) is None
    assert alias_pairs({"A-heel": ["X", "y"], "_note": ["q"], "B-heel": ["x"], "C": None}) == {"a-heel": "A-heel", "x": "B-heel", "y": "A-heel", "b-heel": "B-heel", "c": "C"}
    (tmp_path / "t.yaml").write_text("stiletto-heel:\n- needle heel\n")
    aliases = alias_table(spark, str(tmp_path / "t.yaml"))
    terms = spark.createDataFrame([(" Needle Heel ",), (None,), ("what",)], "gt string")
    assert {r.gt: r.norm for r in J.normalize_terms(terms, "gt", aliases, "norm").collect()} == {" Needle Heel ": "stiletto-heel", None: "_unknown", "what": "_unknown"}
    assert {r.label for r in label_vocabulary(spark.createDataFrame([("a | b",), ("no-spec",), (None,)], "l string"), "l").collect()} == {"a", "b"}


def test_annotation_files_and_sinks(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"data": {"image": "/d/local-files/?d=01%5Cx.JPG", "name": "n"}, "annotations": [{"result": [{"from_name": "toe_shape", "value": {"choices": ["round"]}}]}]}, {"data": {"image": "u", "name": "m"}, "annotations": []}]')
    tasks = read_annotations(spark, str(tmp_path / "a.json"))
    assert tasks.count() == 2 and tasks.select("data.name").collect()[0].name == "n"
    long = spark.createDataFrame([("n", "a", 0.5, 1), ("n", "b", 0.1, 0), ("m", "a", 0.2, 0)], "name string, attr string, score double, pred int")
    write_wide_csv(long, ["a", "b"], {"score": "prob_", "pred": "pred_"}, str(tmp_path / "w"))
    back = {r["name"]: r for r in spark.read.csv(str(tmp_path / "w"), header=True).collect()}
    assert back["n"].prob_a == "0.5" and back["n"].pred_b == "0" and back["m"].prob_b is None
    nested = tags_to_nested(spark.createDataFrame([("n", "round", "", True, None)], "name string, toe string, heel string, `a-b` boolean, bow boolean"), ["toe", "heel"], ["a-b"], ["bow"]).first()
    assert nested.model_details == ["round", "a-b"] and nested.embellishments == []
    made = {r.data.name: r.annotations for r in preannotation_tasks(long.withColumn("file", F.concat("name", F.lit(".jpg"))), ["b", "a"], "u/", "w").collect()}
    assert made["m"] == [] and made["n"][0].result[0].value.choices == ["a"]


def test_stems_of_many_images_are_listed_in_chunks(spark):
    paths = [f"r/c/s{i % 3}/many/{i:04d}/x.jpg" for i in range(2500)] + ["r/c/s0/one.jpg", "r/c/s1/two.jpg", "r/c/s1/a/two.jpg"]
    images = catalog_from_paths(spark.createDataFrame([(p,) for p in paths], "path string"), root="r")
    assert {(r.name, r.occurrences, r.distinct_subcats) for r in C.duplicate_counts(images).collect()} == {("x", 2500, 3), ("two", 2, 1)}
    dups = C.duplicate_stems(images).collect()
    assert sorted((r.name, r.chunk, len(r.occ), r.occurrences) for r in dups) == [("two", 0, 2, 2), ("x", 0, 1000, 2500), ("x", 1, 1000, 2500), ("x", 2, 500, 2500)]
    listed = [o.path for r in sorted(dups, key=lambda r: r.chunk) if r.name == "x" for o in r.occ]
    assert listed == sorted(p for p in paths if "/many/" in p)
    assert {(r.category, r.duplicate_stems, r.copies) for r in C.duplicate_summary(C.duplicate_stems(images)).collect()} == {("c", 2, 2502)}
    plan = C.quarantine_plan(C.duplicate_rows(images), "/q")
    assert sorted(map(repr, plan.collect())) == sorted(map(repr, C.quarantine_plan(C.duplicate_stems(images), "/q").collect()))
    assert plan.count() == 2502 and plan.where("NOT clash").count() == 0


def test_small_chunks_of_short_lists_need_no_ranges(spark, monkeypatch):
    paths = [f"r/c/s{i % 3}/{i:04d}/x.jpg" for i in range(7)] + [f"r/c/s{i % 2}/y{i}/y.jpg" for i in range(4)] + ["r/c/s0/one.jpg"]
    images = catalog_from_paths(spark.createDataFrame([(p,) for p in paths], "path string"), root="r")
    with monkeypatch.context() as m:
        m.setattr(C, "place_in", lambda *a: pytest.fail("placed by ranges"))
        short = C.duplicate_stems(images, chunk=3).collect()
    monkeypatch.setattr(C, "CHUNK", 1)
    ranged = C.duplicate_stems(images, chunk=3).collect()  # x by ranges: the same rows
    assert sorted(map(repr, short)) == sorted(map(repr, ranged))
    assert sorted((r.name, r.chunk, len(r.occ)) for r in short) == [("x", 0, 3), ("x", 1, 3), ("x", 2, 1), ("y", 0, 3), ("y", 1, 1)]
    for n in ("x", "y"):
        assert [o.path for r in sorted(short, key=lambda r: r.chunk) if r.name == n for o in r.occ] == sorted(p for p in paths if p.endswith(f"/{n}.jpg"))
