import json
import random

import pytest
from pyspark.sql import functions as F

from curatrix.plans import ingest
from curatrix.sources import large_json as lj

HARD = ["plain", 'say "hi"', "back\\slash", "\\", '\\"', "]}[{", "é漢🙂", '","', "\\\\\"", "a\nb", "\u0001", ""]


def document(seed, n=40):
    rng = random.Random(seed)
    images = [{"id": k, "file_name": rng.choice(HARD) + rng.choice(HARD), "width": 10, "height": 20, "more": [[k, {"x": "}"}], []]} for k in range(n)]
    notes = [{"id": k, "image_id": rng.randrange(n), "category_id": 1, "bbox": [0, 1.5, 2, 3], "segmentation": {"counts": rng.choice(HARD), "size": [1, 2]}} for k in range(2 * n)]
    return {"info": {"images": [{"id": "not these"}], "text": rng.choice(HARD)}, "licenses": [], "images": images, "numbers": [1, 2], "annotations": notes, "we\"ird\\": [[1], [2]], "categories": [{"id": 1, "name": "}]"}]}


def test_any_cut_gives_the_same_summary():
    text = json.dumps(document(1, 3), ensure_ascii=False).encode()
    whole = lj.summarise(text, 0)
    assert whole[lj.OUTSIDE][:3] == [lj.OUTSIDE, 0, 0]
    for cut in range(len(text)):
        assert lj.compose(lj.summarise(text[:cut], 0), lj.summarise(text[cut:], cut))[lj.OUTSIDE] == whole[lj.OUTSIDE]


@pytest.mark.parametrize("state", [lj.OUTSIDE, lj.INSIDE, lj.ESCAPED])
def test_lexing_against_a_plain_loop(state):
    rng = random.Random(state)
    for _ in range(400):
        text = bytes(rng.choice(b'\\\\"[]{}a') for _ in range(rng.randrange(12)))
        now, depth, lowest = state, 0, 0
        for byte in text:
            if now == lj.ESCAPED:
                now = lj.INSIDE
            elif byte == lj.BACKSLASH and now == lj.INSIDE:
                now = lj.ESCAPED
            elif byte == lj.QUOTE:
                now = lj.OUTSIDE if now == lj.INSIDE else lj.INSIDE
            elif now == lj.OUTSIDE:
                if byte == lj.BACKSLASH:
                    break
                depth += (byte in b"[{") - (byte in b"]}")
                lowest = min(lowest, depth)
        else:
            assert lj.summarise(text, 0)[state][:3] == [now, depth, lowest], text


@pytest.mark.parametrize("ranges", [1, 3, 17])
@pytest.mark.parametrize("indent", [None, 2])
def test_the_same_rows_at_any_number_of_ranges(spark, tmp_path, ranges, indent):
    want = []
    for seed in (1, 2):
        doc = document(seed)
        text = json.dumps(doc, ensure_ascii=seed == 1, indent=indent).encode()
        (tmp_path / f"{seed}.json").write_bytes(text)
        want += [(f"{seed}.json", name, e) for name in ("images", "annotations", 'we"ird\\', "categories") for e in doc[name]]
    size = -(-max(p.stat().st_size for p in tmp_path.iterdir()) // ranges)
    rows = lj.array_elements(spark, str(tmp_path), ["images", "annotations", "categories", 'we"ird\\'], size, block_ranges=4).orderBy("path", "offset").collect()
    assert [(r.path.rsplit("/", 1)[1], r.name, json.loads(r.text)) for r in rows] == want


def test_ranges_smaller_than_elements_and_names(spark, tmp_path):
    doc = document(3, 4)
    (tmp_path / "d.json").write_text(json.dumps(doc))
    rows = lj.array_elements(spark, str(tmp_path), ["images", "annotations"], 7, block_ranges=16).orderBy("offset").collect()
    assert [json.loads(r.text) for r in rows] == doc["images"] + doc["annotations"]


@pytest.mark.parametrize("text", ['{"images": [{"id": 1}', '{"images": [{"id": "1}]}', '{"images": [{"id": 1},, {"id": 2}]}', '{"images": [{"id": 1} {"id": 2}]}', '{"images": [{"id": 1}, 5]}', '{"images": [{"id": 1},]}', ']{"images": []}['])
@pytest.mark.parametrize("size", [6, 1000])
def test_broken_documents_are_refused(spark, tmp_path, text, size):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception, match="no whole JSON document|no element|ends inside"):
        lj.array_elements(spark, str(tmp_path), ["images"], size).collect()


def test_a_source_read_in_ranges(spark, tmp_path):
    doc = document(4)
    (tmp_path / "d.json").write_text(json.dumps(doc))
    source = ingest.read_source(spark, str(tmp_path / "d.json"), range_bytes=500)
    assert sorted(r.file_name for r in source.images.collect()) == sorted(i["file_name"] for i in doc["images"])
    assert [(r.id, list(r.bbox)) for r in source.annotations.orderBy("id").collect()] == [(a["id"], a["bbox"]) for a in doc["annotations"]]
    assert [tuple(r) for r in source.categories.collect()] == [(1, "}]")]
    for broken in ({"images": [], "annotations": []}, doc | {"images": [{"id": "x"}]}):
        (tmp_path / "b.json").write_text(json.dumps(broken))
        with pytest.raises(Exception, match="needed|not of the form"):
            ingest.read_source(spark, str(tmp_path / "b.json")).images.collect()


def test_ranges_of_few_bytes_are_read_by_many_tasks(spark, tmp_path):
    """Adaptive execution takes rows that name ranges for one task's work; each stands for a range that is read, and its elements."""
    (tmp_path / "d.json").write_text(json.dumps(document(5, 400)))
    size = (tmp_path / "d.json").stat().st_size // 64
    ranges = lj._ranges(spark, str(tmp_path / "d.json"), size)
    parts = lj.array_parts(spark, str(tmp_path / "d.json"), ["images", "annotations"], size)
    for rows in (ranges, parts):
        held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert len(held) == 4 and max(held) < sum(held) / 2


def test_an_element_is_parsed_once(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(document(6)))
    plan = ingest.read_source(spark, str(tmp_path / "d.json")).annotations._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
