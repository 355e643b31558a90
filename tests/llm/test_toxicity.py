import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix.llm import toxicity as tox

from .conftest import EDGE_TEXTS


def brute_segments(scores):
    """Maximal scoring segments by their definition: the best contiguous run, then the same on both sides."""

    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                # of equal sums the shortest, then the first
                if total > 1e-9 and (top is None or total > top[0] + 1e-9):
                    top = (total, i, j)
        if top is None:
            return []
        return best(lo, top[1]) + [(top[1], top[2], round(top[0], 6))] + best(top[2] + 1, hi)

    return best(0, len(scores))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-1.03, -1.03, -1.03, 2.17, 3.71, 1.31]), max_size=25))
def test_segments_are_the_maximal_ones(scores):
    places = [k for k, s in enumerate(scores) if s > 0]
    found = [(a, b, round(s, 6)) for a, b, s in tox.segments(places, [scores[k] for k in places], 1.03)]
    assert found == brute_segments(scores)


def test_decay_solves_its_equation():
    import math

    masses = [(3.0, 0.01), (1.0, 0.05), (-0.5, 0.94)]
    x = tox.solve_decay(masses)
    assert sum(p * math.exp(x * s) for s, p in masses) == pytest.approx(1.0, abs=1e-6)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    plain = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(900):
        words = rng.choices(plain, k=rng.randint(5, 120))
        toxic = k % 9 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "awful"]))
        rows.append((k, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t, "en", "s", "clash") for i, t, _ in rows], "doc_id long, text string, lang string, source string, toxic string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in rows], "doc_id long, quality int, toxic int")
    return docs, labels, rows


def test_held_out_accuracy(corpus):
    docs, labels, rows = corpus
    model = tox.fit(docs, labels)
    found = {r.doc_id: r for r in tox.score_texts(docs, model).collect()}
    held = [(i, x) for i, _, x in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    wrong = sum((found[i].score >= tox.REJECT_FROM) != bool(x) for i, x in held)
    assert len(held) > 200 and wrong <= len(held) // 50
    text = dict((i, t.split()) for i, t, _ in rows)
    i = next(i for i, x in held if x)
    assert any({"vile", "nasty", "awful"} & set(text[i][p.first_word : p.last_word + 1]) for p in found[i].passages)


def test_held_out_labels_do_not_matter(corpus):
    docs, labels, _ = corpus
    fold = tox.held_out(F.col("doc_id"))
    other = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tox.fit(docs, labels).weights == tox.fit(docs, other).weights


def test_edges(corpus, make_docs):
    docs, labels, _ = corpus
    model = tox.fit(docs, labels)
    rows = tox.score_texts(make_docs(EDGE_TEXTS + ["vile nasty awful"] * 2), model).collect()
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.score >= 0.7 for r in rows) == 2
    assert tox.score_texts(make_docs(["x"]).limit(0), model).count() == 0


def test_labels_of_one_kind_or_none_reject_nothing(corpus, spark):
    docs, labels, _ = corpus
    for some in (labels.where("toxic = 0"), labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert tox.fit(docs, some).weights == {}
    assert tox.reject_toxic(docs, labels.limit(0)).count() == docs.count()


def test_rejecting_keeps_columns_and_clean_rows(corpus):
    docs, labels, rows = corpus
    kept = tox.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    clean = {i for i, _, x in rows if not x}
    assert len(clean - ids) <= 2 and len(ids - clean) <= 3


def test_every_place_of_a_word_scores(corpus):
    docs, labels, _ = corpus
    model = tox.fit(docs, labels)
    gap = " ".join(["w1 w2 w3 w4 w5"] * 20)
    passage = "vile nasty awful"
    scattered = f"vile {gap} nasty {gap} awful {gap} {passage} {gap}"
    n, found = model.passages(scattered)
    strong = [p for p in found if p[3] <= tox.MAX_EXPECTED]
    assert any((a, b) == (303, 305) for a, b, *_ in strong)
    assert model.probability(*model.traits(n, found)) >= tox.REJECT_FROM
    twice = [p[:2] for p in model.passages(f"{passage} {gap} {passage}")[1] if p[3] <= tox.MAX_EXPECTED]
    assert twice == [(0, 2), (103, 105)]
    once, many = (max(p[2] for p in model.passages(t)[1]) for t in ("vile", "vile " * 10))
    assert many > once


def test_the_scan_takes_linear_time():
    import time

    def seconds(n):
        began = time.perf_counter()
        found = tox.segments(list(range(0, 40 * n, 40)), [3.0] * n, 0.2)
        assert len(found) == n
        return time.perf_counter() - began

    assert seconds(20_000) < 1
    rising = [(10 * k, 1.0 + k % 3) for k in range(50_000)]
    began = time.perf_counter()
    tox.segments([p for p, _ in rising], [s for _, s in rising], 0.11)
    assert time.perf_counter() - began < 2


def brute_model(rows):
    """Weights, decay, rate and traits of labelled training texts, (text, toxic) once each, in plain loops."""
    import math

    seen = {True: {}, False: {}}
    for text, toxic in rows:
        for trait in {t for w in tox.words_of(text) for t in tox.traits_of(w)}:
            seen[toxic][trait] = seen[toxic].get(trait, 0) + 1
    total = {k: sum(v.values()) for k, v in seen.items()}
    weights = {}
    for trait in set(seen[True]) | set(seen[False]):
        t, c = seen[True].get(trait, 0), seen[False].get(trait, 0)
        prior = tox.EVEN_PRIOR + tox.SHARED_PRIOR * (t + c) / (total[True] + total[False])
        odds = math.log((t + prior) / (total[True] + tox.SHARED_PRIOR - t + 1)) - math.log((c + prior) / (total[False] + tox.SHARED_PRIOR - c + 1))
        score = odds - tox.MARGIN * math.sqrt(1 / (t + prior) + 1 / (c + prior))
        if score >= tox.LEAST_SCORE:
            weights[trait] = score
    scored = []
    for text, toxic in rows:
        words = [max((weights[t] for t in tox.traits_of(w) if t in weights), default=-tox.DRIFT) for w in tox.words_of(text)]
        scored.append((toxic, words, [s for *_, s in brute_segments(words)]))
    clean = [x for x in scored if not x[0]]
    counts = {s: 0.5 for s in weights.values()}
    for _, words, _ in clean:
        for s in words:
            if s > 0:
                counts[s] += 1
    n = sum(len(w) for _, w, _ in clean)
    masses = [(s, k / n) for s, k in counts.items()]
    masses.append((-tox.DRIFT, 1 - sum(p for _, p in masses)))
    decay = tox.solve_decay(masses)
    rate = len(clean) / sum(len(w) * math.exp(-decay * max(s, default=0)) for _, w, s in clean)
    return weights, decay, rate, scored


def test_model_and_scores_against_plain_loops(spark):
    import math

    rng = random.Random(8)
    rows = []
    for k in range(240):
        words = rng.choices([f"w{i}" for i in range(40)], k=rng.randint(4, 25))
        if k % 6 == 0:
            words[1:1] = rng.choices(["vile", "nasty", "awfully"], k=2)
        rows.append((k, " ".join(words) + f" t{k}", k % 6 == 0))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in rows], "doc_id long, toxic int")
    model = tox.fit(docs, labels)
    training = [(t, x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    weights, decay, rate, scored = brute_model(training)
    assert weights and model.weights == pytest.approx(weights)
    assert (model.decay, model.rate) == (pytest.approx(decay), pytest.approx(rate))

    def traits(words, segments):
        expected = [rate * max(1, len(words)) * math.exp(-decay * s) for s in segments]
        strength = min(40.0, max(0.0, -math.log(1 - math.exp(-min(expected))))) if expected else 0.0
        return strength, math.log(1 + sum(e <= tox.MAX_EXPECTED for e in expected))

    a, b, c = tox.fit_curve(tox.np.array([(1.0, *traits(w, s)) for _, w, s in scored]), tox.np.array([float(x) for x, _, _ in scored]))
    found = {r.doc_id: r.score for r in tox.score_texts(docs, model).collect()}
    for i, text, _ in rows:
        words = [max((weights[t] for t in tox.traits_of(w) if t in weights), default=-tox.DRIFT) for w in tox.words_of(text)]
        strength, count = traits(words, [s for *_, s in brute_segments(words)])
        assert found[i] == pytest.approx(1 / (1 + math.exp(-(a + b * strength + c * count))), abs=1e-4)
