import duckdb
import pytest

import __spark_entry__ as registered
from curatrix.plans import catalogue, document_queries
from curatrix.plans.catalogue_sql import ORACLE_SQL as CATALOGUE_SQL
from curatrix.plans.document_sql import ORACLE_SQL as DOCUMENT_SQL

QUERIES = catalogue.QUERIES | document_queries.QUERIES
ORACLE_SQL = CATALOGUE_SQL | DOCUMENT_SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    value = lambda x: None if x is None or x != x else round(float(x), 9) if isinstance(x, float) else x if isinstance(x, str) else int(x)
    return sorted(repr([value(x) for x in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours, theirs = QUERIES[name](spark, sf_dir), db.execute(ORACLE_SQL[name]).df()
    names = sorted(ours.columns)
    assert names == sorted(theirs.columns)
    assert plain([tuple(r[c] for c in names) for r in ours.collect()]) == plain(theirs[names].itertuples(index=False, name=None))


def test_registration():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_runs(spark):
    assert registered.entry(spark).count() > 0
