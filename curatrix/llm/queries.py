"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, exact_topk, fill_in_middle, hard_negatives, license_scan, mixing, ogg_media, sentencepiece_fst, sharding, simhash, toxicity, training_order, url_filter

#: Where the public tokenizers' files are; both paths may be given by the session's settings.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-tokeniser of the byte-level BPE vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The rules of the url filter's contract.
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def _file(spark: SparkSession, key: str, name: str) -> str:
    return spark.conf.get(f"spark.curatrix.{key}", None) or f"{TOKENIZERS}/{name}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text decoded from them."""
    model = _file(spark, "sentencepiece", "piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents")
    return sentencepiece_fst.decode_tokens(sentencepiece_fst.encode_texts(docs, model), model)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest rule that fits and verdict of every page; null urls have empty parts and the default verdict."""
    found = url_filter.filter_urls(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, RULES), "page_id")
    return found.select("page_id", "host", "path", "rule", "verdict")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, places of base phrases, labels, score and licence expressions of every document; null texts are empty."""
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer products of every query vector with all other vectors; unusable vectors take no part."""
    return exact_topk.top_k(_table(spark, sf_dir, "embeddings"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and shard after growth of every document under the law ``key``; null texts have size 1."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target, taken words and first training position of every document; null texts have size 0 and are not taken."""
    plan = mixing.in_training_order(mixing.curriculum_plan(_table(spark, sf_dir, "documents")))
    return plan.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 12).alias("position"))


def op7_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored in Ogg, read back, with digests and features of both; null texts are one unit of spaces."""
    return ogg_media.read_media(ogg_media.encode_texts_as_media(_table(spark, sf_dir, "documents")))


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the corpus at its slot, shard by shard."""
    vocabulary = _file(spark, "byte_bpe", "byte_bpe_50k.tiktoken")
    records = training_order.token_records(_table(spark, sf_dir, "documents"), vocabulary, PATTERN)
    return training_order.training_order(records)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; texts without words have the fingerprint 0 and link to each other."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and prediction of every document by a model of the labels outside the held-out fold; null texts score as empty."""
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score_texts(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.REJECT_FROM).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item, and the items; null texts have no words."""
    return decontamination.contamination_digests(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive; rows without label or usable vector take no part."""
    return hard_negatives.mine_hard_negatives(hard_negatives.contract_labels(_table(spark, sf_dir, "embeddings")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's fill-in-the-middle text and of the text restored from it; null texts are empty."""
    return fill_in_middle.fim_digests(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_url_filter, op3_license_scan, op4_exact_topk, op5_sharding, op6_mixing, op7_ogg_media, op8_training_order, op9_simhash, op10_toxicity, op11_decontamination, op12_hard_negatives, op13_fill_in_middle)}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

ORACLE_SQL = {
    "op2_url_filter": f"""WITH rules(rule_host, rule_path, action) AS (VALUES {_RULE_ROWS}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT row_number() OVER () AS k, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY k ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) = 1""",
    "op4_exact_topk": """WITH usable AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.k, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.k <> c.k WHERE q.vec_id % 100 = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10""",
    "op6_mixing": r"""WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM totals),
weighed AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS capacity FROM placed),
ratios AS (SELECT *, CAST(capacity AS DOUBLE) / weight AS ratio FROM weighed),
levels AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(capacity) OVER before, 0) AS DOUBLE) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM ratios WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT coalesce((SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, place LIMIT 1), 0) AS level),
targets AS (SELECT source, place, source_size, least(CAST(capacity AS DOUBLE), w.level * weight) AS target FROM levels, water w),
asked AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS asked FROM targets),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN asked // source_size ELSE 0 END AS epochs FROM asked),
laid AS (SELECT s.doc_id, s.size, e.*, CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source),
parts AS (SELECT *, greatest(0, least(size, asked - epochs * source_size - start)) AS part, least(CAST(1 AS DOUBLE), (start + CAST(size AS DOUBLE) / 2) / target) AS share,
  CASE place % 3 WHEN 0 THEN CAST(1.5 AS DOUBLE) WHEN 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS a, CASE place % 3 WHEN 0 THEN CAST(0.5 AS DOUBLE) WHEN 1 THEN CAST(1 AS DOUBLE) ELSE CAST(1.5 AS DOUBLE) END AS b FROM laid)
SELECT doc_id, size, source_size, target, CAST(epochs * size + part AS BIGINT) AS taken,
  CASE WHEN size > 0 AND (epochs > 0 OR part > 0) THEN round(CASE WHEN a = b THEN share ELSE (sqrt(greatest(0, a * a + 2 * (b - a) * (share * (a + b) / 2))) - a) / (b - a) END, 12) END AS position
FROM parts""",
    "op11_decontamination": r"""WITH doc AS (SELECT row_number() OVER () AS k, doc_id,
  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT DISTINCT item, l, array_to_string(w[a : a + l - 1], ' ') AS said
  FROM (SELECT item, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS a FROM item WHERE len(w) > 0)),
places AS (SELECT k, l, a, array_to_string(w[a : a + l - 1], ' ') AS said
  FROM (SELECT k, w, l, unnest(range(1, len(w) - l + 2)) AS a FROM doc, (SELECT DISTINCT l FROM windows))),
met AS (SELECT k, a, p.l, item FROM places p JOIN windows USING (l, said)),
hit AS (SELECT k, count(DISTINCT place) AS n_hit FROM (SELECT k, unnest(range(a, a + l)) AS place FROM (SELECT DISTINCT k, a, l FROM met)) GROUP BY k),
held AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM met) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (k) LEFT JOIN held USING (k)""",
    "op12_hard_negatives": """WITH usable AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.k, a.vec_id AS anchor_id, c.k AS other, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.k <> c.k WHERE a.vec_id % 100 = 0),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) <= 5),
mined AS (SELECT p.k, p.other, p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
  row_number() OVER (PARTITION BY p.k, p.other ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives p JOIN scored n ON p.k = n.k AND NOT n.same WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM mined WHERE place <= 5""",
    "op13_fill_in_middle": r"""WITH cut AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
drawn AS (SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda x: CAST('0x' || substr(d, x, 8) AS BIGINT)) AS h FROM cut),
formed AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(u[1 : low], '') AS prefix, array_to_string(u[low + 1 : high], '') AS middle, array_to_string(u[high + 1 : n], '') AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts""",
}
