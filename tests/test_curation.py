import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix.functions import strings
from curatrix.functions.hashes import average_hash
from curatrix.operators import dedup, findings, lineage, revisions, split
from curatrix.operators.components import connected_components
from curatrix.plans import ingest, preflight


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def classes(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    return {n: find(n) for n in nodes}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == classes(nodes, [e for e in edges if e[0] != e[1]])


def test_components_of_long_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(200)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(path + star + [(None, 5)], "a long, b long")).collect()}
    assert set(found.values()) == {0, 1000} and len(found) == 501


def test_components_of_strings_take_the_smallest(spark):
    found = connected_components(spark.createDataFrame([("b", "c"), ("a", "c")], "a string, b string"))
    assert {r.node: r.component for r in found.collect()} == dict.fromkeys("abc", "a")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=12), st.lists(st.integers(0, 63), max_size=5))
def test_hash_pairs(spark, values, flips):
    values = values + [v ^ 1 << b for v in values[:3] for b in flips] + [v ^ (0b11111 << 20) for v in values[:2]]
    found = dedup.hash_pairs(spark.createDataFrame([(signed(v),) for v in values], "h long"), 4)
    distinct = sorted({signed(v) for v in values})
    want = {(a, b, ((a ^ b) & (1 << 64) - 1).bit_count()) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert {tuple(r) for r in found.collect()} == want


def test_duplicate_groups(spark):
    rows = [("c", "s1", 0), ("a", "s1", 7 << 40), ("b", "s2", 0b1111), ("d", "s3", -1), ("e", "s4", None), ("f", "s5", -1 ^ 0b11111)]
    found = dedup.duplicate_groups(spark.createDataFrame(rows, "id string, sha256 string, h long"))
    assert {r.id: r.group_id for r in found.collect()} == {"a": "group-a", "b": "group-a", "c": "group-a", "d": "group-d", "e": "group-e", "f": "group-f"}


def test_average_hash(spark):
    rows = spark.createDataFrame([([float(k) for k in range(64)],), ([1.0] * 64,), ([1.0],), (None,)], "t array<double>")
    assert [r.h for r in rows.select(average_hash(F.col("t")).alias("h")).collect()] == [signed(((1 << 64) - 1) ^ ((1 << 32) - 1)), -1, None, None]


def loop_split(groups, pairs, scope, seed, share):
    names = sorted(groups, key=lambda g: hashlib.sha256(f"{scope}:{seed}:{g}".encode()).hexdigest())
    of = {g: {c for x, c in pairs if x == g} for g in names}
    train = set()
    for c in {c for _, c in pairs}:
        train.add(next(g for g in names if c in of[g]))
    goal = max(len(train), min(len(names) - 1, round(len(names) * share)))
    for g in names:
        if len(train) < goal:
            train.add(g)
    if len(train) == len(names):
        movable = [g for g in names if all(sum(c in of[x] for x in names) > 1 for c in of[g])]
        train.discard((movable or names)[-1])
    return {g: "train" if g in train else "validation" for g in names}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcde"), max_size=3), min_size=2, max_size=9), st.sampled_from([0.2, 0.5, 0.8]), st.integers(0, 3))
def test_split(spark, content, share, seed):
    groups = [f"g{k}" for k in range(len(content))]
    pairs = [(g, c) for g, cs in zip(groups, content) for c in cs]
    found = split.assign_splits(spark.createDataFrame([(g,) for g in groups], "group_id string"), spark.createDataFrame(pairs, "group_id string, class_id string"), "ds", seed, share)
    assert {r.group_id: r.split for r in found.collect()} == loop_split(groups, pairs, "ds", seed, share)


def test_split_falls_back_to_a_group_that_can_be_spared(spark):
    groups, pairs = ["g0", "g1", "g2"], [("g0", "a"), ("g1", "b"), ("g2", "c"), ("g2", "a")]
    for seed in range(6):
        found = split.assign_splits(spark.createDataFrame([(g,) for g in groups], "group_id string"), spark.createDataFrame(pairs, "group_id string, class_id string"), "ds", seed, 0.9)
        assert {r.group_id: r.split for r in found.collect()} == loop_split(groups, pairs, "ds", seed, 0.9)


def test_split_refuses_one_group_and_odd_shares(spark):
    one, none = spark.createDataFrame([("g",)], "group_id string"), spark.createDataFrame([], "group_id string, class_id string")
    with pytest.raises(Exception, match="at least two"):
        split.assign_splits(one, none, "ds").collect()
    with pytest.raises(ValueError):
        split.assign_splits(one, none, "ds", train_fraction=1.0)


def test_chains(spark):
    rows = [("a", None), ("b", "a"), ("c", "b"), ("x", "lost"), ("y", "x"), ("p", "q"), ("q", "p"), ("r", "p"), ("s", "s")]
    rows += [("n0", None)] + [(f"n{k}", f"n{k - 1}") for k in range(1, 150)]
    found = {r.id: (r.root, r.depth, r.state) for r in revisions.walk_chains(spark.createDataFrame(rows, "id string, supersedes string")).collect()}
    assert found["a"] == ("a", 0, "complete") and found["c"] == ("a", 2, "complete") and found["n149"] == ("n0", 149, "complete")
    assert found["x"] == ("x", 0, "missing") and found["y"] == ("x", 1, "missing")
    assert all(found[k] == (None, None, "cycle") for k in "pqrs")


def test_timestamps(spark):
    stamps = {"2024-01-01T00:00:00Z": True, "2024-01-01T00:00:00.123456789012345678901Z": True, "2024-02-30T00:00:00Z": False, "2024-01-01T00:00:60Z": False, "2024-01-01T24:00:00Z": False, "2024-01-01T00:00:00+00:00": False, "2024-01-01 00:00:00Z": False, "": False, "2024-01-01T00:00:00.Z": False}
    rows = spark.createDataFrame([(s,) for s in stamps] + [(None,)], "s string").select("s", strings.is_utc_timestamp(F.col("s")).alias("ok")).collect()
    assert {r.s: r.ok for r in rows} == stamps | {None: False}


@pytest.mark.parametrize(("early", "late", "bad"), [("00.10Z", "00.1Z", False), ("00.1Z", "00.10Z", False), ("00.00000002Z", "00.00000001Z", True), ("00.1Z", "00Z", True), ("00Z", "00.0Z", False), ("01Z", "00.9Z", True), ("61Z", "00Z", False)])
def test_time_order_is_exact(spark, early, late, bad):
    at = [F.lit("2024-01-01T00:00:" + x) for x in (early, late)]
    assert spark.range(1).select(strings.out_of_order(*at).alias("x")).first().x is bad


def test_paths_pointers_numbers(spark):
    paths = {"a/b.png": True, "/a": False, "a//b": False, "a/./b": False, "a/../b": False, "a\\b": False, "c:/a": False, "a/": False, "": False, "a\0": False}
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select("p", strings.is_clean_path(F.col("p")).alias("ok")).collect()
    assert {r.p: r.ok for r in rows} == paths
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(strings.pointer_escape(F.lit("a/b~c"))) == "a~1b~0c"
    assert one(strings.numbered("image-", 6, F.lit(12345678))) == "image-12345678"
    assert one(strings.suffix_of(F.lit("a.b/c.D.JPG"))) == ".jpg" and one(strings.stem_of(F.lit("x/c.d.jpg"))) == "c.d"
    digest = hashlib.sha256(b"x").hexdigest()
    assert one(strings.sha256_mod(F.lit(digest), 9)) == int(digest, 16) % 9
    for text, bad in (("/home", True), ("~x", True), ("C:\\x", True), ("d:/x", True), ("a/b", False), ("http://x", False)):
        assert one(strings.is_machine_path(F.lit(text))) is bad


OBJECT = "image_id long, pos int, class_id string, x1 double, y1 double, x2 double, y2 double"


def preflight_rules(spark, images, objects, classes=("a", "b"), **limits):
    items = spark.createDataFrame([(k, s, f"g{k}") for k, s in enumerate(images)], "image_id long, split string, group_id string")
    rows = spark.createDataFrame([(i, k, c, 0.0, 0.0, float(w), float(w)) for k, (i, c, w) in enumerate(objects)], OBJECT)
    ontology = spark.createDataFrame([(c,) for c in classes], "class_id string")
    found = preflight.preflight_findings(items, rows, ontology, **limits)
    return {(r.rule, r.class_id) for r in found.collect()}, preflight.is_blocked(found)


def test_preflight(spark):
    few = {"min_train_images": 1, "min_train_instances": 1}
    assert preflight_rules(spark, ["train", "validation"], []) == ({("train_without_objects", None), ("small_train_split", None), ("unused_class", "a"), ("unused_class", "b")}, True)
    found, blocked = preflight_rules(spark, ["train", "train", "validation"], [(0, "a", 50), (2, "b", 50), (2, "a", 50)], **few)
    assert found == {("class_without_train_instances", "b")} and blocked
    found, blocked = preflight_rules(spark, ["train", "validation"], [(0, "a", 50), (0, "b", 50), (1, "a", 50)], **few)
    assert found == {("no_negative_train_images", None), ("class_not_evaluated", "b")} and not blocked
    found, _ = preflight_rules(spark, ["test"], [(0, "z", 5)] * 20, **few)
    assert found == {("missing_train_split", None), ("missing_validation_split", None), ("small_object_dominant", None), ("dominant_class", None), ("unused_class", "a"), ("unused_class", "b"), ("class_without_train_instances", "z")}
    found, _ = preflight_rules(spark, ["train", "validation", "train"], [(0, "a", 50)] * 3 + [(1, "a", 50)], ("a",))
    assert ("class_below_min_train_instances", "a") in found and ("small_train_split", None) in found


def test_a_report_names_findings_and_the_reason_to_go_on(spark):
    import json

    items = spark.createDataFrame([(0, "train", "g0"), (1, "validation", "g1")], "image_id long, split string, group_id string")
    rows = spark.createDataFrame([], OBJECT)
    found = preflight.preflight_findings(items, rows, spark.createDataFrame([("a",)], "class_id string"))
    tables = {"splits": preflight.distribution(items, rows), "totals": preflight.totals(items, rows)}
    with pytest.raises(ValueError, match="blocks"):
        preflight.report_file(tables, found, "preflight.json")
    row = preflight.report_file(tables, found, "preflight.json", "a trial").first()
    doc = json.loads(bytes(row.content))
    assert row.path == "preflight.json" and set(doc) == {"report", "findings", "override_reason"} and doc["override_reason"] == "a trial"
    assert doc["report"]["totals"][0]["images"] == 2 and {x["rule"] for x in doc["findings"]} == {r.rule for r in found.collect()}
    none = found.limit(0)
    assert json.loads(bytes(preflight.report_file(tables, none, "p.json").first().content))["findings"] == []


def test_exit_statuses(spark):
    def broken():
        raise ValueError("no such folder")

    one = spark.createDataFrame([("d", "/", "rule", "m")], findings.FINDING)
    assert [findings.exit_status(x) for x in (one.limit(0), one, lambda: one, broken, lambda: spark.read.parquet("/nowhere"))] == [0, 1, 1, 2, 2]


def source(spark, tmp_path, images=4):
    import json

    doc = {
        "images": [{"id": k, "file_name": f"{k}.jpg", "width": 40, "height": 30, "license": None} for k in range(1, images + 1)],
        "categories": [{"id": 1, "name": "Bottle"}, {"id": 2, "name": "Can"}, {"id": 3, "name": "Sky"}],
        "annotations": [{"id": 10, "image_id": 1, "category_id": 1, "bbox": [1, 2, 10, 10]}, {"id": 9, "image_id": 1, "category_id": 2, "bbox": [0, 0, 5, 5]}, {"id": 11, "image_id": 1, "category_id": 3, "bbox": [0, 0, 5, 5]}, {"id": 12, "image_id": 2, "category_id": 1, "bbox": [35, 0, 10, 5]}, {"id": 13, "image_id": 2, "category_id": 1, "bbox": [0, 0, 40.4, 30]}, {"id": 14, "image_id": 3, "category_id": 2, "bbox": [0, 0, 4, 4]}, {"id": 15, "image_id": 4, "category_id": 1, "bbox": [0, 0, 4, 4]}],
    }
    path = tmp_path / "source.json"
    path.write_text(json.dumps(doc, indent=1))
    return ingest.read_source(spark, str(path))


DECODED = "file_name string, ok boolean, oriented boolean, sha256 string, h long"
PRINTS = [0, 0x0F0F0F0F0F0F0F0F, 0x00FF00FF00FF00FF, 0x3333333333333333, 0x5555555555555555]


def take(spark, tmp_path, rows, **options):
    mapping, ignored = ingest.mapping_tables(spark, {"Bottle": "plastic", "Can": "metal"}, ["Sky"], ["plastic", "metal"])
    return ingest.ingest(source(spark, tmp_path, options.pop("images", 4)), spark.createDataFrame(rows, DECODED), mapping, ignored, "ds", **options)


def test_ingest_counts(spark, tmp_path):
    done = take(spark, tmp_path, [(f"{k}.jpg", True, False, f"s{k}", PRINTS[k]) for k in range(1, 5)])
    tables = ingest.report(done)
    totals = tables["totals"].first()
    assert (totals.images, totals.objects, totals.groups) == (4, 5, 4)
    assert {r.dropped: r.n for r in tables["dropped"].collect()} == {"ignored_category": 1, "unrepresentable_box": 1}
    first = done.objects.where("image_id = 1").orderBy("annotation_id").collect()
    assert [(r.id, r.class_id) for r in first] == [("object-0000", "metal"), ("object-0001", "plastic")]
    assert done.objects.where("annotation_id = 13").first().bbox == [0, 0, 40, 30]
    assert {r.split for r in done.items.select("split").collect()} == {"train", "validation"}
    again = take(spark, tmp_path, [(f"{k}.jpg", True, False, f"s{k}", PRINTS[k]) for k in range(1, 5)])
    assert sorted(map(tuple, again.items.collect())) == sorted(map(tuple, done.items.collect()))
    docs = ingest.annotation_documents(done, "ds", "ont", "1", "me", "run", "1", "2024-01-01T00:00:00Z").collect()
    assert len(docs) == 4 and all(r.doc.status == "approved" and r.doc.review.reviewer_id == "me" for r in docs)
    assert findings.exit_status(ingest.released_findings(done.items)) == 0


def test_each_image_has_one_outcome(spark, tmp_path):
    rows = [("1.jpg", True, False, "s", 1), ("2.jpg", True, False, "s", 2), ("3.jpg", True, True, "t", 3), ("4.jpg", False, None, None, None)]
    ends = {r.id: r.reason for r in ingest.outcomes(source(spark, tmp_path, 5).images, spark.createDataFrame(rows, DECODED)).collect()}
    assert ends == {1: None, 2: "duplicate_image", 3: "exif_orientation", 4: "decode_failed", 5: "missing_source"}
    with pytest.raises(ValueError, match="cannot be used"):
        take(spark, tmp_path, rows, images=5)


def test_near_frames_share_a_group_and_split(spark, tmp_path):
    done = take(spark, tmp_path, [(f"{k}.jpg", True, False, f"s{k}", PRINTS[k] if k > 2 else PRINTS[1] ^ k) for k in range(1, 5)])
    groups = {r.image_id: (r.group_id, r.split) for r in done.items.collect()}
    assert groups[1] == groups[2] and len({g for g, _ in groups.values()}) == 3
    assert ingest.report(done)["groups"].first().multi_image == 1


def test_unmapped_categories_and_bad_mappings(spark, tmp_path):
    mapping, ignored = ingest.mapping_tables(spark, {"Bottle": "plastic"}, [], ["plastic"])
    with pytest.raises(ValueError, match="Can"):
        ingest.ingest(source(spark, tmp_path), spark.createDataFrame([], DECODED), mapping, ignored, "ds")
    for categories, ignore in (({"A": "x"}, []), ({"A": "plastic"}, ["A"])):
        with pytest.raises(ValueError):
            ingest.mapping_tables(spark, categories, ignore, ["plastic"])


def test_sets_of_runs_and_first_best_row(spark):
    edges = spark.createDataFrame([("r1", "inputs", "a"), ("r1", "outputs", "a"), ("r2", "inputs", "a"), ("r2", "outputs", "b"), ("r3", "inputs", "a")], "run string, side string, sha256 string")
    assert {r.run for r in lineage.unequal_sets(edges, "run").collect()} == {"r2", "r3"}
    rows = spark.createDataFrame([("g", 0, None), ("g", 1, 2.0), ("g", 2, 2.0), ("h", 0, None)], "run string, pos int, m double")
    assert {(r.run, r.pos) for r in lineage.best_row(rows, ["run"], "m", ["pos"]).collect()} == {("g", 1), ("h", 0)}


def test_leaks_follow_the_previous_item(spark):
    rows = [("d", f"/{k}", "g", s, k) for k, s in enumerate(["train", "validation", "validation", "train"])]
    found = findings.split_leaks(spark.createDataFrame(rows, "document string, field string, group_id string, split string, pos int"))
    assert sorted(r.field for r in found.collect()) == ["/1", "/3"]
