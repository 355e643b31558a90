"""The document queries as DuckDB SQL: what the planted faults must give, said from the tables."""

from __future__ import annotations

from .catalogue_sql import OBJECTS, ORDER_ITEMS, VALID, iou_of, preflight_sql


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else f"'{x}'" for x in row) + ")" for row in rows)


#: (fault, field) of annotations that break their schema; two fields of one object lack where a row stands twice.
SCHEMA = [
    (0, "/objects/0/bbox"), (1, "/objects/0/bbox/0"), (2, "/objects/0/bbox/0"), (3, "/objects/0/bbox/0"), (4, "/objects"), (5, "/objects/0/id"), (6, "/objects/0"), (7, "/objects/0/confidence"), (8, "/source"), (8, "/source"), (9, "/source"), (9, "/source"),
    (10, "/source/kind"), (11, "/review"), (12, ""), (13, "/review"), (13, "/review"), (14, "/image_sha256"), (15, "/status"), (16, ""),
]
#: (fault, place: annotation, earlier revision or item of the manifest, field, rule).
AUDIT = [
    (1, "a", "/status", "annotation_not_approved"), (2, "a", "/item_id", "annotation_mismatch"), (3, "a", "/ontology_version", "annotation_mismatch"), (4, "a", "/objects/0/class_id", "unknown_class"), (5, "a", "/objects/0/bbox", "box_inverted"), (6, "a", "/objects/0/bbox", "box_out_of_bounds"),
    (7, "a", "/objects/0/bbox", "box_inverted"), (7, "a", "/objects/0/bbox", "box_out_of_bounds"), (8, "a", "/review/reviewed_at", "time_order"), (9, "a", "/created_at", "utc_timestamp"), (10, "a", "/review/reviewed_at", "utc_timestamp"), (11, "a", "", "schema"), (11, "a", "/review", "missing_review"),
    (12, "a", "/objects/1/id", "duplicate_id"), (13, "a", "/supersedes", "annotation_cycle"), (13, "a", "/supersedes", "annotation_cycle"), (14, "a", "/supersedes", "audit_incomplete"), (15, "a", "/supersedes", "audit_incomplete"), (16, "i", "/image/path", "artifact_missing"), (17, "i", "/image/sha256", "hash_mismatch"),
    (18, "i", "/image/path", "invalid_path"), (19, "i", "/annotation/artifact/sha256", "hash_mismatch"), (20, "i", "/image/path", "path_escape"), (21, "i", "/image/sha256", "artifact_io"), (22, "i", "/provenance/acquired_at", "utc_timestamp"), (24, "a", "/supersedes", "annotation_mismatch"), (25, "a", "/created_at", "time_order"),
    (26, "a", "/supersedes", "annotation_cycle"), (27, "a", "/supersedes", "audit_incomplete"), (28, "b", "/created_at", "utc_timestamp"), (29, "b", "/status", "schema"),
]
EVENTS = [
    (1, "/captured_at", "utc_timestamp"), (2, "/emitted_at", "time_order"), (3, "/detections/0/bbox", "box_inverted"), (4, "/detections/0/bbox", "box_out_of_bounds"), (5, "/model", "model_mismatch"), (6, "/detections/0/class_id", "unknown_class"), (7, "/detections/0/confidence", "schema"), (8, "", "strict_json"),
]
#: (fault, file of the package, field, rule) in preflight, and what the audit adds.
PREFLIGHT = [
    (1, "manifest.json", "/created_at", "utc_timestamp"), (2, "manifest.json", "/task", "schema"), (3, "manifest.json", "/model/adapter", "unsupported_adapter"), (4, "manifest.json", "/model/format", "unsupported_format"), (5, "manifest.json", "/model/adapter/config/max_det", "unsupported_adapter_config"),
    (6, "records/training.json", "/config/where", "non_portable_config"), (7, "manifest.json", "/model/artifact/path", "artifact_missing"), (8, "manifest.json", "/preprocessing/sha256", "hash_mismatch"), (9, "manifest.json", "/labels/classes/1", "labels_ontology_mismatch"), (10, "manifest.json", "/labels/classes/1/output_index", "duplicate_id"),
    (11, "manifest.json", "/trace/dataset", "record_identity"), (12, "records/export.json", "/id", "record_identity"), (13, "records/export.json", "/outputs/1/artifact", "hash_cycle"), (19, "dataset.json", "/items/1/group_id", "split_leakage"), (20, "manifest.json", "/labels", "labels_ontology_mismatch"),
    (21, "records/training.json", "/outputs/0/artifact/path", "invalid_path"), (22, "manifest.json", "", "manifest_hash_expected"), (23, "manifest.json", "/model/artifact/path", "invalid_path"), (24, "records/training.json", "/created_at", "utc_timestamp"), (25, "manifest.json", "/labels/classes/1/id", "duplicate_id"), (25, "manifest.json", "/labels/classes/1/label", "duplicate_id"),
]
AUDITED = PREFLIGHT + [
    (7, "records/export.json", "/outputs/0/artifact", "artifact_unresolved"), (14, "records/training.json", "/inputs/0/artifact/sha256", "hash_mismatch"), (15, "manifest.json", "/trace/evaluation", "lineage_mismatch"), (16, "manifest.json", "/trace/export", "export_mismatch"), (17, "manifest.json", "/trace/evaluation", "evaluation_metrics"),
    (18, "manifest.json", "/trace/evaluation/config/sample_count", "evaluation_config"),
]


def _package_sql(rows: list[tuple]) -> str:
    return f"""WITH faults(f, file, field, rule) AS (VALUES {_values(rows)})
SELECT 'p' || s_suppkey || '/' || file AS document, field, rule FROM supplier JOIN faults ON s_suppkey % 27 = f"""


_ALL_VALIDATE = ORDER_ITEMS.replace("THEN 'train'", "THEN 'validation'")
_ALL_TRAIN = ORDER_ITEMS.replace("ELSE 'validation'", "ELSE 'train'")
_FEW_TRAIN = "order_items AS (SELECT o_orderkey AS image_id, CAST(o_custkey AS VARCHAR) AS group_id, CASE WHEN o_orderkey % 400 = 1 THEN 'train' ELSE 'validation' END AS split FROM orders)"
_NO_OBJECTS = OBJECTS.replace("objects AS", "given AS") + ", objects AS (SELECT * REPLACE (-image_id - 1 AS image_id) FROM given)"
_ALIKE = OBJECTS.replace("objects AS", "given AS") + """, objects AS (
  SELECT * REPLACE (CASE WHEN image_id % 400 <> 1 THEN CASE WHEN image_id % 97 = 0 THEN 'N' ELSE 'A' END WHEN pos = 1 THEN 'R' ELSE 'A' END AS class_id, x1 + 5 AS x2) FROM given)"""
CASES = {"untrained": (OBJECTS, _ALL_VALIDATE), "bare": (_NO_OBJECTS, _ALL_TRAIN), "few": (_ALIKE, _FEW_TRAIN)}

SOURCE = """decoded AS (SELECT o_orderkey AS id, o_orderkey % 50 AS f, o_custkey || ' ' || CAST(round(o_totalprice, -5) AS BIGINT) AS same FROM orders),
firsts AS (SELECT same, min(id) AS first FROM decoded WHERE f > 2 GROUP BY same),
outcomes AS (SELECT id, CASE f WHEN 0 THEN 'missing_source' WHEN 1 THEN 'decode_failed' WHEN 2 THEN 'exif_orientation' ELSE CASE WHEN id <> first THEN 'duplicate_image' END END AS reason FROM decoded LEFT JOIN firsts USING (same))"""

#: The parts of the data sets that are built, and of those without a fault.
BUILT = r"""built AS (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos, 'image-' || lpad(CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS VARCHAR), 6, '0') AS stem,
    CASE WHEN p_size % 10 = 0 THEN 'validation' ELSE 'train' END AS split,
    CASE WHEN CAST(regexp_extract(p_brand, '(\d+)$', 1) AS INTEGER) % 5 = 1 AND p_partkey % 7 = 0 THEN (p_partkey // 7) % 3 ELSE -1 END AS fault FROM part),
good AS (SELECT * FROM built WHERE p_brand NOT IN (SELECT p_brand FROM built WHERE fault >= 0))"""

ORACLE_SQL = {
    "q24_greedy_matches": f"""WITH RECURSIVE {VALID},
refs AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, pos) AS k FROM valid WHERE pos % 2 = 0 QUALIFY k <= 20),
decs AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, pos) AS k FROM valid WHERE pos % 2 = 1 QUALIFY k <= 20),
packed AS (SELECT image_id, list({{'k': k, 'pos': pos, 'class_id': class_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY k) AS rows FROM decs GROUP BY image_id),
fold AS (
  SELECT image_id, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS ref_pos, CAST(NULL AS BIGINT) AS pos, CAST(NULL AS DOUBLE) AS iou FROM packed
  UNION ALL
  SELECT image_id, k, CASE WHEN best.o >= 0.2 THEN list_append(used, best.k) ELSE used END, CAST(ref_pos AS BIGINT), CASE WHEN best.o >= 0.2 THEN CAST(best.pos AS BIGINT) END, CASE WHEN best.o >= 0.2 THEN best.o END
  FROM (SELECT f.image_id, r.k, f.used, r.pos AS ref_pos, list_sort(list_transform(list_filter(p.rows, lambda d: d.class_id = r.class_id AND NOT list_contains(f.used, d.k)), lambda d: {{'n': -({iou_of('d', 'r')}), 'k': d.k, 'pos': d.pos, 'o': {iou_of('d', 'r')}}}))[1] AS best
        FROM fold f JOIN packed p ON p.image_id = f.image_id JOIN refs r ON r.image_id = f.image_id AND r.k = f.k + 1))
SELECT image_id, ref_pos, pos, round(iou, 9) AS iou FROM fold WHERE pos IS NOT NULL""",
    "q30_strict_json": "SELECT CAST(p_partkey AS VARCHAR) AS document, '' AS field, 'strict_json' AS rule FROM part WHERE p_partkey % 10 < 7",
    "q31_document_kinds": "SELECT CAST(p_partkey AS VARCHAR) AS document, CASE p_partkey % 10 WHEN 0 THEN 'event' WHEN 1 THEN 'package' WHEN 2 THEN 'dataset' WHEN 3 THEN 'annotation' WHEN 4 THEN 'record' WHEN 5 THEN 'preprocessing' WHEN 6 THEN 'labels' WHEN 7 THEN 'ontology' END AS contract FROM part",
    "q32_schema": f"WITH faults(f, field) AS (VALUES {_values(SCHEMA)}) SELECT CAST(p_partkey AS VARCHAR) AS document, field, 'schema' AS rule FROM part JOIN faults ON p_partkey % 18 = f",
    "q33_dataset_audit": f"""WITH faults(f, place, field, rule) AS (VALUES {_values(AUDIT)}),
p AS (SELECT p_partkey AS k, p_brand AS b, p_size AS z, p_partkey % 32 AS f, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos FROM part),
s AS (SELECT *, CASE WHEN z % 10 = 0 AND k % 2 = 1 THEN 'validation' ELSE 'train' END AS split FROM p),
firsts AS (SELECT b, min(k) % 4 AS f FROM p GROUP BY b)
SELECT CASE place WHEN 'i' THEN b || '/dataset.json' WHEN 'a' THEN b || '/annotations/' || k || '.json' ELSE b || '/annotations/' || k || '-before.json' END AS document, CASE place WHEN 'i' THEN '/items/' || pos || field ELSE field END AS field, rule FROM p JOIN faults USING (f)
UNION ALL SELECT b || '/dataset.json', '/items/' || pos || '/group_id', 'split_leakage' FROM (SELECT *, lag(split) OVER (PARTITION BY b, z ORDER BY pos) AS previous FROM s) WHERE previous <> split
UNION ALL SELECT b || '/dataset.json', '/items/' || pos || '/image/sha256', 'duplicate_id' FROM (SELECT *, row_number() OVER (PARTITION BY b ORDER BY pos) AS n FROM p WHERE f = 30) WHERE n > 1
UNION ALL SELECT b || '/dataset.json', CASE f WHEN 1 THEN '/created_at' WHEN 2 THEN '/ontology/classes/1/label' ELSE '/ontology/classes/2/id' END, CASE f WHEN 1 THEN 'utc_timestamp' ELSE 'duplicate_id' END FROM firsts WHERE f > 0""",
    "q34_history": """WITH t AS (SELECT DISTINCT conv_id, turn FROM conversations),
r AS (SELECT conv_id, turn, CASE WHEN (conv_id + 3 * turn) % 7 = 0 THEN 'moved' ELSE 'i' || conv_id END AS item, CASE WHEN (conv_id + turn) % 11 = 0 THEN 2023 ELSE 2024 END AS year FROM t),
w AS (SELECT *, lag(turn) OVER o AS before, lag(item) OVER o AS old_item, lag(year) OVER o AS old_year, max(turn) OVER (PARTITION BY conv_id) AS last FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY turn))
SELECT 'c' || conv_id || '-' || last AS document, '/supersedes' AS field, 'annotation_mismatch' AS rule FROM w WHERE item <> old_item
UNION ALL SELECT 'c' || conv_id || '-' || last, '/created_at', 'time_order' FROM w WHERE year < old_year""",
    "q35_events": f"WITH faults(f, field, rule) AS (VALUES {_values(EVENTS)}) SELECT 'e' || event_id AS document, field, rule FROM events JOIN faults ON event_id % 10 = f",
    "q36_package_preflight": _package_sql(PREFLIGHT),
    "q37_package_audit": _package_sql(AUDITED),
    "q38_decoded_rows": f"""WITH {OBJECTS}, o AS (SELECT *, CAST(row_number() OVER (PARTITION BY image_id ORDER BY pos) - 1 AS INTEGER) AS p FROM objects WHERE x1 <= x2 AND y1 <= y2),
b AS (SELECT *, least(greatest(x1 * 100 / 64, 0), 100) AS a, least(greatest(y1 * 80 / 64, 0), 80) AS b, least(greatest(x2 * 100 / 64, 0), 100) AS c, least(greatest(y2 * 80 / 64, 0), 80) AS d FROM o)
SELECT image_id AS frame, p AS pos, CASE pos % 3 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'two' END AS class_id, round(confidence / 10, 9) AS confidence, round(a, 6) AS x1, round(b, 6) AS y1, round(c, 6) AS x2, round(d, 6) AS y2 FROM b WHERE c - a > 0 AND d - b > 0""",
    "q39_inverse_letterbox": f"""WITH {OBJECTS}, n AS (SELECT *, CAST(0.8 AS DOUBLE) AS r FROM objects), b AS (SELECT image_id, pos, least(greatest((x1 - 8) / r, 0), 100) AS a, least(greatest((y1 - 4) / r, 0), 80) AS b, least(greatest((x2 - 8) / r, 0), 100) AS c, least(greatest((y2 - 4) / r, 0), 80) AS d FROM n),
k AS (SELECT *, c - a > 0 AND d - b > 0 AS kept FROM b)
SELECT image_id, pos, kept, CASE WHEN kept THEN round(a, 6) END AS x1, CASE WHEN kept THEN round(b, 6) END AS y1, CASE WHEN kept THEN round(c, 6) END AS x2, CASE WHEN kept THEN round(d, 6) END AS y2 FROM k""",
    "q40_detection_findings": f"""WITH {OBJECTS}, n AS (SELECT *, CAST(image_id AS VARCHAR) AS document, '/' || pos AS field FROM objects)
SELECT document, field, 'box_inverted' AS rule FROM n WHERE x1 >= x2 OR y1 >= y2 UNION ALL SELECT document, field, 'box_out_of_bounds' FROM n WHERE x1 < 0 OR y1 < 0 OR x2 > 100 OR y2 > 80
UNION ALL SELECT document, field, 'unknown_class' FROM n WHERE class_id NOT IN ('A', 'N') UNION ALL SELECT document, field, 'confidence_range' FROM n WHERE confidence * 1.5 > 1""",
    "q41_candidates": f"""WITH {OBJECTS}, bad AS (SELECT image_id FROM objects GROUP BY image_id HAVING image_id % 9 = 0 OR bool_or(class_id = 'R' OR x1 >= x2 OR y1 >= y2 OR x1 < 0 OR y1 < 0 OR x2 > 100 OR y2 > 80))
SELECT CAST(image_id AS VARCHAR) AS document, printf('object-%04d', pos - 1) AS object_id, lower(class_id) AS class_id FROM objects WHERE image_id NOT IN (SELECT image_id FROM bad)""",
    "q42_ingest_outcomes": f"WITH {SOURCE} SELECT id, reason FROM outcomes",
    "q43_skip_counts": f"WITH {SOURCE} SELECT reason, count(*) AS n FROM outcomes WHERE reason IS NOT NULL GROUP BY reason",
    "q44_converted_objects": f"""WITH {OBJECTS}, {SOURCE}, s AS (SELECT o.*, image_id * 100 + pos AS annotation_id, x1 * f AS a, y1 * f AS b, (x1 + (x2 - x1)) * f AS c, (y1 + (y2 - y1)) * f AS d FROM objects o, (SELECT CAST(0.8 AS DOUBLE) AS f) WHERE image_id IN (SELECT id FROM outcomes WHERE reason IS NULL)),
k AS (SELECT *, CASE WHEN class_id = 'R' THEN 'ignored_category' WHEN NOT (c - a > 0 AND d - b > 0 AND a >= -0.5 AND b >= -0.5 AND c <= 80.5 AND d <= 64.5) THEN 'unrepresentable_box' END AS dropped FROM s)
SELECT image_id, annotation_id, CASE WHEN dropped IS NULL THEN printf('object-%04d', row_number() OVER (PARTITION BY image_id, dropped IS NULL ORDER BY annotation_id) - 1) END AS object_id, CASE class_id WHEN 'A' THEN 'a' WHEN 'N' THEN 'b' END AS class_id, dropped FROM k""",
    "q45_dataset_totals": f"""WITH {OBJECTS}, {ORDER_ITEMS}, c AS (SELECT image_id, count(*) AS n, count(*) FILTER (least(x2 - x1, y2 - y1) < 32) AS small FROM objects GROUP BY image_id)
SELECT count(*) AS images, count(*) - count(n) AS images_without_objects, CAST(coalesce(sum(n), 0) AS BIGINT) AS objects, CAST(coalesce(sum(small), 0) AS BIGINT) AS small_objects, count(DISTINCT group_id) AS groups FROM order_items LEFT JOIN c USING (image_id)""",
    "q46_json_lines": """SELECT event_id, CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type,
  'label': ['NaN', 'a,NaN,b', 'x:Infinity]', '"-Infinity"', 'plain'][event_id % 5 + 1], 'source': {'raw': props, 'score': [user_id / CAST(4 AS DOUBLE)]}}) AS VARCHAR) AS line FROM events""",
    "q47_label_files": f"""WITH {OBJECTS}, {ORDER_ITEMS}, l AS (SELECT image_id, pos, CASE class_id WHEN 'R' THEN '0' WHEN 'A' THEN '1' ELSE '2' END || printf(' %.17g %.17g %.17g %.17g', (x1 + x2) / CAST(200 AS DOUBLE), (y1 + y2) / CAST(160 AS DOUBLE), (x2 - x1) / CAST(100 AS DOUBLE), (y2 - y1) / CAST(80 AS DOUBLE)) || chr(10) AS line FROM objects),
t AS (SELECT image_id, string_agg(line, '' ORDER BY pos) AS text FROM l GROUP BY image_id) SELECT image_id AS item_id, split, coalesce(text, '') AS text FROM order_items LEFT JOIN t USING (image_id)""",
    "q48_multi_image_groups": "SELECT count(*) AS total, count(*) FILTER (n > 1) AS multi_image FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)",
    "q49_metric_keys": "SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) = coalesce(list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'O')), []) AS same FROM orders GROUP BY o_custkey",
    "q50_training_metrics": """WITH e AS (SELECT p_brand AS run, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS DOUBLE) AS epoch, CAST(count(*) OVER (PARTITION BY p_brand) AS DOUBLE) AS n, CAST(floor(p_retailprice / 100) AS DOUBLE) AS share, CAST(p_size AS DOUBLE) AS size FROM part)
SELECT run, size AS "P", share + 1 AS "mAP50", share AS "mAP", epoch AS best_epoch, n AS epochs_recorded, size / 2 AS train_loss FROM e QUALIFY row_number() OVER (PARTITION BY run ORDER BY share DESC, epoch) = 1""",
    "q52_preflight_cases": " UNION ALL ".join(f"SELECT '{name}' AS \"case\", severity, rule, class_id FROM ({preflight_sql(*tables)})" for name, tables in CASES.items()),
    "q51_machine_paths": r"""WITH v AS (SELECT p_partkey, ['/', '~', 'C:\', 'd:/', '', 'x/', 'c:'][p_partkey % 7 + 1] || p_name AS value FROM part)
SELECT p_partkey, regexp_matches(value, '^([/~]|[A-Za-z]:[\\/])') AS machine, replace(replace(value, '~', '~0'), '/', '~1') AS pointer, regexp_replace(regexp_extract(value || '.tar.gz', '([^/]*)$', 1), '\.[^.]*$', '') AS stem FROM v""",
    "q53_dataset_build": f"""WITH {BUILT}
SELECT p_brand || '/images/' || stem || '.png' AS path, sha256('image ' || p_partkey) AS detail FROM good
UNION ALL SELECT p_brand || '/annotations/' || stem || '-approved.json', 'ann-' || p_partkey || ' approved' FROM good
UNION ALL SELECT p_brand || '/annotations/' || stem || '-candidate.json', 'ann-' || p_partkey || '-before candidate' FROM good
UNION ALL SELECT p_brand || '/dataset.json', CAST(count(*) AS VARCHAR) FROM good GROUP BY p_brand
UNION ALL SELECT p_brand || '/dataset.json/items/' || pos || ['/image/sha256', '/annotation', '/split'][fault + 1], ['hash_mismatch', 'annotation_not_approved', 'unknown_split'][fault + 1] FROM built WHERE fault >= 0""",
    "q54_training_folders": f"""WITH {BUILT},
both_splits AS (SELECT p_brand FROM good GROUP BY p_brand HAVING count(DISTINCT split) = 2),
own AS (SELECT *, CASE split WHEN 'train' THEN 'train' ELSE 'val' END AS folder FROM good JOIN both_splits USING (p_brand)),
labelled AS (SELECT *, '0 ' || printf('%.17g %.17g %.17g %.17g', (p_size + 2) / CAST(200 AS DOUBLE), CAST(42.5 AS DOUBLE) / 160, p_size / CAST(100 AS DOUBLE), CAST(40.5 AS DOUBLE) / 80) || chr(10)
  || '1 ' || printf('%.17g %.17g %.17g %.17g', 10 / CAST(200 AS DOUBLE), 10 / CAST(160 AS DOUBLE), 10 / CAST(100 AS DOUBLE), 10 / CAST(80 AS DOUBLE)) || chr(10) AS text FROM own),
lines AS (SELECT p_brand, pos, '{{"item_id":"item-' || p_partkey || '","image":"images/' || folder || '/' || stem || '.png","annotation_id":"ann-' || p_partkey || '"}}' AS line FROM own)
SELECT p_brand || '/images/' || folder || '/' || stem || '.png' AS path, sha256('image ' || p_partkey) AS detail FROM own
UNION ALL SELECT p_brand || '/labels/' || folder || '/' || stem || '.txt', sha256(text) FROM labelled
UNION ALL SELECT p_brand || '/mapping/' || lpad(CAST(pos // 10000 AS VARCHAR), 5, '0') || '.jsonl', sha256(string_agg(line, chr(10) ORDER BY pos) || chr(10)) FROM lines GROUP BY p_brand, pos // 10000
UNION ALL SELECT p_brand || '/data.yaml', sha256('{{"train":"images/train","val":"images/val","names":["one","two"]}}' || chr(10)) FROM both_splits
UNION ALL SELECT p_brand || '/mapping.json', 'ds-' || p_brand FROM both_splits
UNION ALL SELECT DISTINCT p_brand || '/dataset.json/items', 'missing_split' FROM good WHERE p_brand NOT IN (FROM both_splits)""",
    "q55_run_records": """WITH r AS (SELECT CAST(p_partkey AS VARCHAR) AS run, p_partkey % 16 AS fault, p_partkey % 3 = 2 AS later FROM part)
SELECT run, '' AS field, CASE WHEN later THEN '0.5 2 ' ELSE '0.25 1 ' END || sha256('best ' || run) AS detail FROM r WHERE fault NOT BETWEEN 1 AND 6
UNION ALL SELECT run, ['/weights/last.pt', '/config/dataset.json', '/results.csv', '/results.csv', '/results.csv', '/config/config_file'][fault],
  ['artifact_missing', 'hash_mismatch', 'results_invalid', 'results_invalid', 'results_invalid', 'non_portable_config'][fault] FROM r WHERE fault BETWEEN 1 AND 6""",
    "q56_source_reader": f"""WITH {OBJECTS} SELECT image_id * 100 + pos AS id, 'o "' || image_id || '" }}].jpg' AS file_name, CASE class_id WHEN 'A' THEN 'first' WHEN 'N' THEN 'second' ELSE 'th]ird' END AS name,
  x1, y1, x2, y2 FROM objects JOIN orders ON image_id = o_orderkey""",
    "q57_canonical_images": """WITH v AS (SELECT vec_id, vec_id % 9 NOT IN (1, 2, 3) AS ok, list_sum(list_transform(embedding, lambda x: least(255, greatest(0, floor((CAST(x AS DOUBLE) + 1) * 127))))) AS grey FROM embeddings)
SELECT vec_id AS file_name, ok, CASE WHEN ok THEN 8 ELSE 0 END AS width, CASE WHEN ok THEN 8 ELSE 0 END AS height, CASE WHEN ok THEN CAST(grey AS BIGINT) ELSE 0 END AS grey FROM v""",
}
