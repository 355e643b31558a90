import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from curatrix.llm import toxicity
from curatrix.llm.queries import ORACLE_SQL, QUERIES

from .test_mixing import brute_targets, size
from .test_near_texts import brute_kept


def test_stages_against_plain_loops(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r for r in docs.collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {i: r for i, r in texts.items() if model.probability(*model.traits(*model.passages(r.text or ""))) < 0.7}
    # the stage's rule, five-word sets alike to 0.8 or more, over all pairs
    alone = set(brute_kept([(i, r.text) for i, r in kept.items()]))
    kept = {i: r for i, r in kept.items() if i in alone}
    sizes = {}
    for r in kept.values():
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    targets = brute_targets(sizes)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    taken = {}
    for r in rows:
        assert r.doc_id in kept and list(r.token_ids) == library.encode(kept[r.doc_id].text or "")
        s = kept[r.doc_id].source
        taken[s] = taken.get(s, 0) + size(kept[r.doc_id].text)
    for s, target in targets.items():
        longest = max(size(r.text) for r in kept.values() if r.source == s)
        assert abs(taken.get(s, 0) - target) <= longest / 2 + 1


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, sf_dir, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours = QUERIES[name](spark, sf_dir)
    names = sorted(ours.columns)
    found = db.execute(ORACLE_SQL[name])
    columns, theirs = [c[0] for c in found.description], found.fetchall()
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    clean = lambda rows: sorted(repr([None if x is None or x != x else round(float(x), 9) if isinstance(x, float) else x if isinstance(x, str) else int(x) for x in r]) for r in rows)
    assert clean([tuple(r[c] for c in names) for r in ours.collect()]) == clean([r[k] for k in at] for r in theirs)


def test_stages_on_nulls_repeats_clashes_and_nothing(spark, sf_dir, make_docs, words):
    a, b = words(60), words(60)
    docs = make_docs([None, "", a, a, b, b, "one two"], sources=["s", None, "s", "t", None, "t", "s"], ids=[None, 1, 2, 2, None, 7, 8])
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        sizes[name] = stage(spark, docs, sf_dir).count()
    # clean texts stay; one row of the empty texts, of each copied text and of the short one; the mix leaves empty ones out
    assert sizes["toxicity"] == 7 and sizes["simhash_near_dedup"] == 4 and sizes["sentencepiece"] == 7
    mixed = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    assert mixed.columns == docs.columns and mixed.where("text is null or text = ''").count() == 0
