import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curatrix.functions import pixels
from curatrix.operators import decode, nms

SCHEMA = "frame string, pos int, class_id string, confidence double, x1 double, y1 double, x2 double, y2 double"


def frame(spark, rows, name="f"):
    return spark.createDataFrame([(name, k, c, s, *map(float, b)) for k, (c, s, *b) in enumerate(rows)], SCHEMA)


def kept(df):
    return [r.pos for r in sorted(df.collect(), key=lambda r: r["rank"])]


A, B, C, D, E_ = ("c", 0.9, 0, 0, 10, 10), ("c", 0.8, 0, 0, 10, 5), ("k", 0.7, 0, 0, 10, 10), ("c", 0.25, 0, 0, 10, 10), ("c", 0.249, 50, 50, 60, 60)


def test_threshold_is_strict_and_confidence_inclusive(spark):
    rows = frame(spark, [A, B, C, D, E_])
    assert kept(nms.suppress(rows, "frame", 0.25, 0.5)) == [0, 1, 2]
    assert kept(nms.suppress(frame(spark, [D, C, A]), "frame", 0.25, 0.5, "none")) == [0, 1, 2]
    assert kept(nms.suppress(frame(spark, [D, A]), "frame", 0.25, 1.0)) == [1, 0]
    with pytest.raises(ValueError):
        nms.suppress(rows, "frame", mode="other")


def test_ties_keep_the_order_of_arrival(spark):
    same = [("c", 0.5, 0, 0, 10, 10), ("c", 0.5, 1, 0, 11, 10), ("c", 0.5, 100, 0, 110, 10)]
    assert kept(nms.suppress(frame(spark, same), "frame", 0.25, 0.5)) == [0, 2]


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    i = max(0.0, w) * max(0.0, h)
    u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i
    return i / u if u > 0 else 0.0


boxes = st.tuples(st.sampled_from("ck"), st.sampled_from([0.2, 0.3, 0.5, 0.9]), st.integers(0, 6), st.integers(0, 6), st.integers(1, 6), st.integers(1, 6)).map(lambda t: (t[0], t[1], t[2], t[3], t[2] + t[4], t[3] + t[5]))


@settings(max_examples=25, deadline=None)
@given(st.lists(boxes, min_size=1, max_size=14))
def test_suppression_against_a_loop(spark, rows):
    left = sorted((k for k, r in enumerate(rows) if r[1] >= 0.25), key=lambda k: (-rows[k][1], k))
    want = []
    for k in left:
        if not any(rows[j][0] == rows[k][0] and overlap(rows[j][2:], rows[k][2:]) > 0.4 for j in want):
            want.append(k)
    assert kept(nms.suppress(frame(spark, rows), "frame", 0.25, 0.4)) == want


@settings(max_examples=20, deadline=None)
@given(st.lists(boxes, min_size=1, max_size=8), st.lists(boxes, min_size=1, max_size=8))
def test_matching_against_a_loop(spark, refs, rows):
    order = lambda x: sorted(range(len(x)), key=lambda k: (-x[k][1], k))
    used, want = set(), []
    for i in order(refs):
        best, at = -1.0, None
        for j in order(rows):
            if j not in used and rows[j][0] == refs[i][0] and overlap(refs[i][2:], rows[j][2:]) > best:
                best, at = overlap(refs[i][2:], rows[j][2:]), j
        if at is not None and best >= 0.3:
            used.add(at)
            want.append((i, at))
    found = nms.greedy_matches(frame(spark, refs), frame(spark, rows), "frame", accept=0.3)
    assert sorted((r.ref_pos, r.pos) for r in found.collect()) == sorted(want)


def test_decode_rows(spark):
    labels = spark.createDataFrame([(0, "c1"), (2, "c2")], "output_index int, class_id string")
    rows = [[6.4, 8.0, 19.2, 24.0, 0.9, 2.0], [64.0, 0.0, 70.0, 5.0, 0.5, 0.0]]
    raw = lambda r: spark.createDataFrame([("f", 100, 80, r)], "frame string, width int, height int, rows array<array<double>>")
    found = decode.decode_rows(raw(rows), labels, 64, 64).collect()
    assert [(r.pos, r.class_id, r.confidence) for r in found] == [(0, "c2", 0.9)]
    assert [found[0][c] for c in ("x1", "y1", "x2", "y2")] == pytest.approx([10, 10, 30, 30])
    for bad in ([1.0, 1, 2, 2, 0.5, 1.0], [1.0, 1, 2, 2, 0.5, 0.5], [1.0, 1, 2, 2, 1.5, 0.0], [2.0, 1, 1, 2, 0.5, 0.0]):
        with pytest.raises(Exception):
            decode.decode_rows(raw([[float(x) for x in bad]]), labels, 64, 64).collect()


def test_detection_findings(spark):
    labels = spark.createDataFrame([("c1",)], "class_id string")
    rows = spark.createDataFrame([("d", "/0", "c1", 0.5, 10, 10, 0.0, 0.0, 5.0, 5.0), ("d", "/1", "zz", 1.5, 10, 10, 0.0, 0.0, 50.0, 5.0)], "document string, field string, class_id string, confidence double, width int, height int, x1 double, y1 double, x2 double, y2 double")
    assert sorted((r.field, r.rule) for r in decode.detection_findings(rows, labels).collect()) == [("/1", "box_out_of_bounds"), ("/1", "confidence_range"), ("/1", "unknown_class")]


def test_stretch_and_normalise():
    row = np.zeros((1, 2, 3), np.uint8)
    row[0, 1, 0] = 2
    assert pixels.stretch(row, 4, 1)[0, :, 0].tolist() == [0, 0.5, 1.5, 2]
    pixel = np.array([[[10, 20, 30]]], np.uint8)
    out = pixels.tensor(pixel, 1, 1, 0.5, [1, 2, 3], [2, 1, 0.5], bgr=True)
    assert out.shape == (1, 3, 1, 1) and out.ravel().tolist() == [7, 8, 4]
    assert pixels.tensor(pixel, 1, 1, 1, [0, 0, 0], [1, 1, 1], channels_last=True).shape == (1, 1, 1, 3)


def test_kernels_keep_plain_images_plain():
    flat = np.full((40, 30, 3), 77, np.uint8)
    assert (pixels.lanczos(flat, 7, 9) == 77).all()
    boxed, left, top, ratio = pixels.letterbox(flat, 80, 80)
    assert (left, top, ratio) == (10, 0, 2.0) and boxed[0, 0, 0] == pixels.BORDER and boxed[40, 40, 0] == 77
    assert pixels.grey_thumbnail(flat).shape == (8, 8)
    clear = np.zeros((2, 2, 4), np.uint8)
    assert (pixels.flatten_alpha(clear) == 255).all() and pixels.flatten_alpha(np.zeros((2, 2), np.uint8)).shape == (2, 2, 3)


def test_tensors_and_inference_in_tasks(spark):
    frames = spark.createDataFrame([(1, 2, 1, bytes([0, 0, 0, 2, 0, 0]))], "frame long, width int, height int, pixels binary")
    made = pixels.tensors(frames, 4, 1, 1.0, [0, 0, 0], [1, 1, 1])
    assert made.first().tensor[:4] == [0, 0.5, 1.5, 2]
    found = decode.infer(made, lambda: lambda x: np.array([[0, 0, float(x.max()), 1, 0.5, 0]]), (1, 3, 1, 4))
    assert found.first().rows == [[0, 0, 2, 1, 0.5, 0]]


def test_run_comparison(spark):
    a, b = frame(spark, [A, B]), frame(spark, [A, C])
    matches = nms.greedy_matches(a, b, "frame")
    row = decode.compare_runs(a, b, matches, nms.nearest_matches(a, b, ["frame", "class_id"], "frame")).first()
    assert (row.n_references, row.n_decoded, row.n_matched, row.least_iou) == (2, 2, 1, 1.0)


def test_only_the_best_of_a_frame_are_near(spark):
    """Of 25 a side the 20 with the highest scores count: the five exact partners of the best row rank below."""
    kind = "frame int, " + ", ".join(f"{c} {t}" for c, t in zip(nms.DETECTION, ("long", "string", *["double"] * 5), strict=True))
    own = [(1, k, "a", 1 - k / 100, 10.0 * k, 0.0, 10.0 * k + 5, 5.0) for k in range(25)]
    refs = [(1, k, "a", 1 - k / 100, 10.0 * (24 - k), 0.0, 10.0 * (24 - k) + 5, 5.0) for k in range(25)]
    found = {r.pos: (r.best_iou, r.least_delta) for r in nms.nearest_matches(spark.createDataFrame(refs, kind), spark.createDataFrame(own, kind), ["frame", "class_id"], "frame").collect()}
    assert sorted(found) == list(range(20))
    assert found[0] == (0.0, 50.0) and found[4] == (0.0, 10.0) and found[5] == (1.0, 0.0)
