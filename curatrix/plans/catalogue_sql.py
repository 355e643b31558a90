"""The catalogue's queries as DuckDB SQL over the same tables."""

from __future__ import annotations

OBJECTS = """objects AS (
  SELECT l_orderkey AS image_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS pos,
         l_returnflag AS class_id, l_discount * 10 AS confidence, l_quantity AS x1,
         l_linenumber * CAST(8 AS DOUBLE) AS y1, l_quantity + (l_partkey % 60) - 1 AS x2,
         l_linenumber * CAST(8 AS DOUBLE) + (l_suppkey % 40) - 1 AS y2
  FROM lineitem)"""
VALID = OBJECTS + """, valid AS (
  SELECT * FROM objects WHERE x1 < x2 AND y1 < y2 AND x1 >= 0 AND y1 >= 0 AND x2 <= 100 AND y2 <= 80)"""
ITEMS = """items AS (
  SELECT doc_id AS item_id, sha256(text) AS image_sha256, source || '-' || lang AS group_id,
         CASE WHEN substr(sha256(CAST(doc_id AS VARCHAR)), 1, 1) < 'c' THEN 'train' ELSE 'validation' END AS split
  FROM documents)"""
ORDER_ITEMS = """order_items AS (
  SELECT o_orderkey AS image_id, CAST(o_custkey AS VARCHAR) AS group_id,
         CASE WHEN substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 1) < 'c' THEN 'train' ELSE 'validation' END AS split
  FROM orders)"""
HASHES = """thumbs AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS v FROM embeddings),
means AS (SELECT vec_id, label, v, list_reduce(list_prepend(CAST(0 AS DOUBLE), v), lambda a, x: a + x) / 64 AS m FROM thumbs),
bits AS (SELECT vec_id, label, array_to_string(list_reverse(list_transform(v, lambda x: CASE WHEN x >= m THEN '1' ELSE '0' END)), '') AS b FROM means),
hashes AS (SELECT vec_id, label, b, CAST(CAST(b AS BIT) AS BIGINT) AS h FROM bits)"""
IOU = """CASE WHEN {u} > 0 THEN {i} / {u} ELSE 0 END"""


def iou_of(a: str, b: str) -> str:
    both = f"(greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"
    union = f"(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) + ({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1) - {both})"
    return IOU.format(u=union, i=both)


DISTRIBUTION = """per_image AS (SELECT image_id, class_id, count(*) AS n FROM objects GROUP BY ALL),
sums AS (SELECT image_id, sum(n) AS n FROM per_image GROUP BY image_id),
distribution AS (
  SELECT split, class_id, count(*) AS images, CAST(sum(n) AS BIGINT) AS objects, CAST(0 AS BIGINT) AS negative_images
  FROM order_items JOIN per_image USING (image_id) GROUP BY split, class_id
  UNION ALL
  SELECT split, NULL, count(*), CAST(coalesce(sum(n), 0) AS BIGINT), count(*) - count(n)
  FROM order_items LEFT JOIN sums USING (image_id) GROUP BY split)"""


def _split_sql(groups: str, classes: str, scope: str, seed: int, share: float) -> str:
    """CTEs that end in ``splits``; ``groups`` and ``classes`` are queries for group_id (and class_id)."""
    return f"""ranked AS (SELECT group_id, row_number() OVER (ORDER BY sha256('{scope}:{seed}:' || group_id), group_id) AS ord FROM (SELECT DISTINCT group_id FROM ({groups}))),
pairs AS (SELECT DISTINCT group_id, class_id, ord FROM ({classes}) JOIN ranked USING (group_id)),
covering AS (SELECT DISTINCT group_id FROM (SELECT group_id, row_number() OVER (PARTITION BY class_id ORDER BY ord) AS k FROM pairs) WHERE k = 1),
flags AS (SELECT r.group_id, ord, c.group_id IS NOT NULL AS covers FROM ranked r LEFT JOIN covering c USING (group_id)),
sizes AS (SELECT count(*) AS n, sum(CAST(covers AS INT)) AS covered FROM flags),
goal AS (SELECT greatest(covered, least(n - 1, CAST(round_even(n * {share}, 0) AS BIGINT))) - covered AS free FROM sizes),
first_pass AS (SELECT group_id, ord, covers OR sum(CAST(NOT covers AS INT)) OVER (ORDER BY ord) <= free AS trains FROM flags, goal),
spare AS (SELECT group_id, min(CAST(n > 1 AS INT)) AS ok FROM (SELECT p.group_id, count(*) OVER (PARTITION BY class_id) AS n FROM pairs p JOIN first_pass f USING (group_id) WHERE trains) GROUP BY group_id),
moved AS (SELECT coalesce(max(CASE WHEN trains AND coalesce(ok, 1) = 1 THEN ord END), max(ord)) AS last_ord, min(CAST(trains AS INT)) AS none FROM first_pass LEFT JOIN spare USING (group_id)),
splits AS (SELECT group_id, CASE WHEN NOT trains OR (none = 1 AND ord = last_ord) THEN 'validation' ELSE 'train' END AS split FROM first_pass, moved)"""


def preflight_sql(objects: str, items: str) -> str:
    """All findings of a preflight over the CTEs ``objects`` and ``order_items``."""
    return f"""WITH {objects}, {items}, {DISTRIBUTION},
one AS (SELECT coalesce(max(images) FILTER (split = 'train'), 0) AS ti, coalesce(max(objects) FILTER (split = 'train'), 0) AS tob, coalesce(max(negative_images) FILTER (split = 'train'), 0) AS tn,
               coalesce(max(images) FILTER (split = 'validation'), 0) AS vi, coalesce(sum(objects), 0) AS n FROM distribution WHERE class_id IS NULL),
met AS (SELECT class_id, count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation FROM objects JOIN order_items USING (image_id) GROUP BY class_id),
cls AS (SELECT coalesce(d.class_id, m.class_id) AS class_id, coalesce(total, 0) AS total, coalesce(train, 0) AS train, coalesce(validation, 0) AS validation FROM (VALUES ('A'), ('N'), ('R'), ('Z')) d(class_id) FULL JOIN met m ON d.class_id = m.class_id),
top AS (SELECT max(total) AS top, count(*) AS k FROM cls),
tiny AS (SELECT count(*) AS small FROM objects JOIN order_items USING (image_id) WHERE least(x2 - x1, y2 - y1) < 32),
w AS (SELECT * FROM one, top, tiny)
SELECT 'blocking' AS severity, 'missing_train_split' AS rule, '' AS class_id FROM w WHERE ti = 0
UNION ALL SELECT 'blocking', 'missing_validation_split', '' FROM w WHERE vi = 0
UNION ALL SELECT 'blocking', 'train_without_objects', '' FROM w WHERE ti > 0 AND tob = 0
UNION ALL SELECT 'warning', 'small_train_split', '' FROM w WHERE ti > 0 AND ti < 100
UNION ALL SELECT 'warning', 'no_negative_train_images', '' FROM w WHERE ti > 0 AND vi > 0 AND tn = 0
UNION ALL SELECT 'warning', 'small_object_dominant', '' FROM w WHERE n > 0 AND small / n > 0.5
UNION ALL SELECT 'warning', 'dominant_class', '' FROM w WHERE n > 0 AND top / n > 0.9 AND k > 1
UNION ALL SELECT 'warning', 'unused_class', class_id FROM cls WHERE total = 0
UNION ALL SELECT 'blocking', 'class_without_train_instances', class_id FROM cls WHERE total > 0 AND train = 0
UNION ALL SELECT 'warning', 'class_below_min_train_instances', class_id FROM cls WHERE train > 0 AND train < 10
UNION ALL SELECT 'warning', 'class_not_evaluated', class_id FROM cls WHERE train > 0 AND validation = 0"""


ORACLE_SQL = {
    "q1_split_class_distribution": f"WITH {OBJECTS}, {ORDER_ITEMS}, {DISTRIBUTION} SELECT split, coalesce(class_id, '*') AS class_id, images, objects, negative_images FROM distribution",
    "q2_duplicate_content": f"WITH {ITEMS} SELECT item_id, image_sha256, CAST(k AS INTEGER) AS occurrence FROM (SELECT *, row_number() OVER (PARTITION BY image_sha256 ORDER BY item_id) AS k FROM items) WHERE k > 1",
    "q3_time_order": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE date_trunc('second', l_shipdate) < date_trunc('second', o_orderdate)",
    "q4_frame_order": """WITH f AS (
  SELECT 'arrival' AS ordering, event_type, user_id, event_id, lag(event_id) OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS previous_id FROM events
  UNION ALL
  SELECT 'mixed', event_type, user_id, event_id, lag(event_id) OVER (PARTITION BY event_type, user_id ORDER BY sha256(CAST(event_id AS VARCHAR)), event_id) FROM events)
SELECT * FROM f WHERE event_id <= previous_id""",
    "q5_split_leakage": f"WITH {ITEMS} SELECT * FROM (SELECT item_id, group_id, split, lag(split) OVER (PARTITION BY group_id ORDER BY item_id) AS previous_split FROM items) WHERE previous_split <> split",
    "q6_average_hash": f"WITH {HASHES} SELECT vec_id, h FROM hashes",
    "q7_hamming_pairs": f"WITH {HASHES}, d AS (SELECT DISTINCT h FROM hashes) SELECT a.h AS a, b.h AS b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance FROM d a, d b WHERE a.h < b.h AND bit_count(xor(a.h, b.h)) <= 20",
    "q8_box_rules": f"WITH {OBJECTS} SELECT image_id, pos, 'box_inverted' AS rule FROM objects WHERE x1 >= x2 OR y1 >= y2 UNION ALL SELECT image_id, pos, 'box_out_of_bounds' FROM objects WHERE x1 < 0 OR y1 < 0 OR x2 > 100 OR y2 > 80",
    "q9_scaled_boxes": f"""WITH {OBJECTS}, s AS (
  SELECT image_id, pos, (x1 - 2) * f AS a, (y1 - CAST(8.3 AS DOUBLE)) * f AS b, ((x1 - 2) + (x2 - x1)) * f AS c, ((y1 - CAST(8.3 AS DOUBLE)) + (y2 - y1)) * f AS d FROM objects, (SELECT CAST(0.8 AS DOUBLE) AS f)),
k AS (SELECT *, c - a > 0 AND d - b > 0 AND a >= -0.5 AND b >= -0.5 AND c <= 80.5 AND d <= 64.5 AS kept FROM s)
SELECT image_id, pos, kept, CASE WHEN kept THEN round(least(greatest(a, 0), 80), 6) END AS x1, CASE WHEN kept THEN round(least(greatest(b, 0), 64), 6) END AS y1,
       CASE WHEN kept THEN round(least(greatest(c, 0), 80), 6) END AS x2, CASE WHEN kept THEN round(least(greatest(d, 0), 64), 6) END AS y2 FROM k""",
    "q10_normalised_boxes": f"WITH {VALID} SELECT image_id, pos, round((x1 + x2) / 200, 9) AS cx, round((y1 + y2) / 160, 9) AS cy, round((x2 - x1) / 100, 9) AS w, round((y2 - y1) / 80, 9) AS h FROM valid",
    "q11_pairwise_iou": f"WITH {VALID}, p AS (SELECT a.image_id, a.class_id, a.pos, b.pos AS other_pos, round({iou_of('a', 'b')}, 9) AS iou FROM valid a JOIN valid b ON a.image_id = b.image_id AND a.class_id = b.class_id AND a.pos < b.pos) SELECT * FROM p WHERE iou > 0",
    "q12_suppression": f"""WITH RECURSIVE {VALID}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY confidence DESC, pos) AS k FROM valid WHERE confidence >= 0.25),
fold AS (
  SELECT image_id, class_id, k, [{{'pos': pos, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] AS kept FROM ranked WHERE k = 1
  UNION ALL
  SELECT r.image_id, r.class_id, r.k, CASE WHEN len(list_filter(f.kept, lambda o: ({iou_of('o', 'r')}) > 0.3)) > 0 THEN f.kept ELSE list_append(f.kept, {{'pos': r.pos, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}}) END
  FROM fold f JOIN ranked r ON r.image_id = f.image_id AND r.class_id = f.class_id AND r.k = f.k + 1),
done AS (SELECT image_id, class_id, unnest(kept).pos AS pos FROM fold QUALIFY row_number() OVER (PARTITION BY image_id, class_id ORDER BY k DESC) = 1)
SELECT v.image_id, v.pos, v.class_id, v.confidence, CAST(row_number() OVER (PARTITION BY v.image_id ORDER BY v.confidence DESC, v.pos) - 1 AS INTEGER) AS rank FROM done d JOIN valid v ON v.image_id = d.image_id AND v.pos = d.pos""",
    "q13_groups_and_split": f"""WITH RECURSIVE {HASHES}, named AS (SELECT printf('%06d', vec_id) AS id, h, label FROM hashes),
links AS (SELECT a.id AS a, b.id AS b FROM named a, named b WHERE bit_count(xor(a.h, b.h)) <= 20),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
grouped AS (SELECT a AS id, 'group-' || min(b) AS group_id FROM reach GROUP BY a),
{_split_sql("SELECT group_id FROM grouped", "SELECT group_id, label AS class_id FROM grouped JOIN named USING (id)", "thumbnails", 42, 0.8)}
SELECT id, group_id, split FROM grouped JOIN splits USING (group_id)""",
    "q14_preflight": preflight_sql(OBJECTS, ORDER_ITEMS),
    "q15_open_properties": "SELECT event_id, k, k >= 50 AS high FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)",
    "q16_clean_paths": r"""WITH p AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages)
SELECT page_id, NOT regexp_matches(path, '[\\:\x00]') AND len(list_filter(string_split(path, '/'), lambda s: s IN ('', '.', '..'))) = 0 AS clean,
       NOT starts_with(path, '/') AND NOT contains(path, '\') AND NOT contains(path, ':') AND NOT list_contains(string_split(path, '/'), '..') AND length(path) > 0 AS schema_path,
       lower(regexp_extract(regexp_extract(path, '^[^?#]*'), '[^/](\.[^./]+)$', 1)) AS suffix FROM p""",
    "q17_revision_chains": """WITH RECURSIVE t AS (SELECT DISTINCT conv_id, turn FROM conversations),
r AS (SELECT conv_id || '/' || turn AS id, conv_id || '/' || lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS supersedes FROM t),
w AS (SELECT id, id AS here, supersedes AS nxt, CAST(0 AS BIGINT) AS depth FROM r UNION ALL SELECT w.id, r.id, r.supersedes, w.depth + 1 FROM w JOIN r ON r.id = w.nxt)
SELECT id, here AS root, depth, 'complete' AS state FROM w WHERE nxt IS NULL""",
    "q18_lineage_sets": """WITH s AS (SELECT l_orderkey, list_sort(list(DISTINCT sha256(CAST(l_suppkey AS VARCHAR)))) AS i, coalesce(list_sort(list(DISTINCT sha256(CAST(l_suppkey AS VARCHAR))) FILTER (l_linenumber <= 3)), []) AS o FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CAST(len(i) AS BIGINT) AS n_inputs, CAST(len(o) AS BIGINT) AS n_outputs FROM s WHERE i <> o""",
    "q19_best_row": "SELECT o_custkey, o_orderkey, CAST(p AS BIGINT) AS price FROM (SELECT *, floor(o_totalprice / 50000) AS p FROM orders) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY p DESC NULLS LAST, o_orderkey) = 1",
    "q20_nearest_matches": f"""WITH {VALID}, top AS (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY image_id, pos % 2 ORDER BY confidence DESC, pos) <= 20), m AS (
  SELECT a.image_id, a.class_id, a.pos, max(CASE WHEN b.pos IS NOT NULL THEN {iou_of('b', 'a')} END) AS best,
         min(CASE WHEN b.pos IS NOT NULL THEN greatest(abs(b.x1 - a.x1), abs(b.y1 - a.y1), abs(b.x2 - a.x2), abs(b.y2 - a.y2)) END) AS delta
  FROM top a LEFT JOIN top b ON a.image_id = b.image_id AND a.class_id = b.class_id AND b.pos % 2 = 0 WHERE a.pos % 2 = 1 GROUP BY ALL)
SELECT class_id, count(*) AS n, count(best) AS matched, round(median(best), 6) AS median_iou, round(median(delta), 6) AS median_delta, round(max(best), 6) AS greatest_iou FROM m GROUP BY class_id""",
    "q21_mapping_closure": "SELECT DISTINCT p_type AS field, 'unmapped_category' AS rule FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size = 1 AND p_brand = 'Brand#1')",
    "q22_stable_order": f"WITH {_split_sql('SELECT c_name AS group_id FROM customer', 'SELECT c_name AS group_id, c_mktsegment AS class_id FROM customer', 'customers', 7, 0.7)} SELECT group_id, split FROM splits",
    "q23_unapproved": f"WITH {ITEMS}, s AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id), j AS (SELECT item_id, CASE quality WHEN 1 THEN 'approved' WHEN 0 THEN 'rejected' ELSE 'candidate' END AS status FROM items LEFT JOIN s ON item_id = doc_id) SELECT * FROM j WHERE status <> 'approved'",
    "q25_digest_mod": f"WITH {ITEMS} SELECT item_id, CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(image_sha256, ''), lambda c: CAST(strpos('0123456789abcdef', c) - 1 AS BIGINT))), lambda a, d: (a * 16 + d) % 9) AS BIGINT) AS palette FROM items",
    "q26_first_of_each": f"WITH {ITEMS} SELECT item_id, CASE WHEN row_number() OVER (PARTITION BY image_sha256 ORDER BY item_id) = 1 THEN 'kept' ELSE 'duplicate_image' END AS outcome FROM items",
    "q27_downscale": "SELECT p_partkey, CAST(greatest(1, round_even(w * s, 0)) AS INTEGER) AS width, CAST(greatest(1, round_even(h * s, 0)) AS INTEGER) AS height FROM (SELECT *, least(CAST(1 AS DOUBLE), CAST(640 AS DOUBLE) / greatest(w, h)) AS s FROM (SELECT p_partkey, p_size * 37 + 1 AS w, p_partkey % 1500 + 1 AS h FROM part))",
    "q28_inverse_stretch": f"""WITH {OBJECTS}, b AS (SELECT image_id, pos, least(greatest(x1 * 100 / 64, 0), 100) AS a, least(greatest(y1 * 80 / 64, 0), 80) AS b, least(greatest(x2 * 100 / 64, 0), 100) AS c, least(greatest(y2 * 80 / 64, 0), 80) AS d FROM objects WHERE x1 <= x2 AND y1 <= y2),
k AS (SELECT *, c - a > 0 AND d - b > 0 AS kept FROM b)
SELECT image_id, pos, kept, CASE WHEN kept THEN round(a, 6) END AS x1, CASE WHEN kept THEN round(b, 6) END AS y1, CASE WHEN kept THEN round(c, 6) END AS x2, CASE WHEN kept THEN round(d, 6) END AS y2 FROM k""",
    "q29_export_reconciliation": f"WITH {OBJECTS}, {ORDER_ITEMS} SELECT split, count(*) AS declared, count(*) FILTER (image_id IN (SELECT image_id FROM objects)) AS exported FROM order_items GROUP BY split",
}
