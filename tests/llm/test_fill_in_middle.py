import hashlib
import re

import pytest
from pyspark.sql import functions as F

from curatrix.llm import fill_in_middle as fim

from .conftest import EDGE_TEXTS

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h[3] % 100 < 80:
        return n, "spm", prefix, middle, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", prefix, middle, f"<P>{prefix}<S>{suffix}<M>{middle}"


HARD = [*EDGE_TEXTS, "a<P>b c d", "<S>", "x <", "<P", "P> S> M>", "< < <P S> >", "<M> in it", "\x1c a\x85b c d e", "🙂 🙂🙂  é́ z\r\n", "\t\t lead and tail \n\n"]


def test_forms_and_outputs_against_a_plain_loop(spark, make_docs, words):
    texts = HARD + [words(k % 40) for k in range(300)]
    rows = {r.doc_id: r.fim for r in fim.fill_in_middle(make_docs(texts)).collect()}
    assert {r.form for r in rows.values()} == {"plain", "psm", "spm"}
    for k, text in enumerate(texts):
        r = rows[k + 1]
        assert (r.n, r.form, r.prefix, r.middle, r.output) == brute(k + 1, text)
        assert r.form == "plain" or r.prefix + r.middle + r.suffix == text


def test_every_hard_text_comes_back_from_every_form(spark):
    rows = [(i, t, "x", "y") for i in range(60) for t in HARD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fim string, n string")
    made = fim.fill_in_middle(docs)
    assert made.columns == ["doc_id", "text", "fim", "n", "fim_"]
    found = made.select("text", "fim_.form", fim.restored(F.col("fim_.output"), F.col("fim_.form")).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in found)
    assert {r.form for r in found if r.text and "<" not in r.text} == {"plain", "psm", "spm"}


def test_digests_null_and_repeated_ids_and_an_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (5, None), (5, "")], "doc_id long, text string")
    rows = fim.fim_digests(docs).collect()
    assert len(rows) == 4
    n, form, prefix, middle, output = brute(None, "a b c")
    named = [r for r in rows if r.doc_id is None]
    assert {(r.n, r.form, r.output_sha256, r.restored_sha256) for r in named} == {(n, form, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(b"a b c").hexdigest())}
    assert {(r.n, r.form, r.prefix_chars, r.restored_sha256) for r in rows if r.doc_id == 5} == {(0, "plain", None, hashlib.sha256(b"").hexdigest())}
    assert fim.fim_digests(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("output", "form"), [("no sentinels", "psm"), ("<S>a<P>b", "spm"), ("<S>a<P>b<M>c", "psm")])
def test_outputs_that_are_not_whole_are_refused(spark, output, form):
    rows = spark.createDataFrame([(output, form)], "output string, form string")
    with pytest.raises(Exception, match="sentinels are missing"):
        rows.select(fim.restored(F.col("output"), F.col("form"))).collect()


def test_no_python_runs(spark, make_docs):
    plan = fim.fim_digests(make_docs(["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Arrow", "Pandas", "Exchange"))
