import hashlib
import random
import re

import pytest

from curatrix.llm import decontamination as d

from .conftest import EDGE_TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items, window=10):
    out = []
    for text in texts:
        words, hit, held = plain_words(text), set(), set()
        for item, own in items:
            own = plain_words(own)
            length = min(window, len(own))
            for k in range(len(own) - length + 1 if own else 0):
                for at in range(len(words) - length + 1):
                    if words[at : at + length] == own[k : k + length]:
                        hit |= set(range(at, at + length))
                        held.add("" if item is None else str(item))
        out.append((len(words), sorted(hit), sorted(held)))
    return out


def run(spark, make_docs, texts, items, **how):
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")
    rows = d.find_contamination(make_docs(texts), bench, **how).orderBy("doc_id").collect()
    return [(r.n_words, [k for s in r.spans for k in range(s.start, s.end)], list(r["items"])) for r in rows]


def cases(seed):
    rng = random.Random(seed)
    pool = ["a", "b", "cé", "d9"]
    speak = lambda n: " ".join(rng.choices(pool, k=n))
    items = [(k, speak(rng.choice([0, 1, 2, 3, 9, 10, 11, 25]) + 3 * (k % 2))) for k in range(12)] + [(2, "b b b"), (None, speak(11)), (10, None), (11, "?!")]
    texts = [speak(rng.randint(0, 60)) for _ in range(30)] + ["x, " + (t or "").upper().replace(" ", "--") + "." for _, t in items] + EDGE_TEXTS[:-1]
    return texts, items


@pytest.mark.parametrize("seed", [1, 2])
def test_all_occurrences_against_a_plain_loop(spark, make_docs, seed):
    texts, items = cases(seed)
    assert run(spark, make_docs, texts, items) == brute(texts, items)


def test_a_benchmark_beyond_the_bound_is_searched_in_groups(spark, make_docs, monkeypatch):
    texts, items = cases(3)
    monkeypatch.setattr(d, "PIECE_WORDS", 4)
    assert run(spark, make_docs, texts, items, max_windows=20) == brute(texts, items)


def test_pieces_of_a_long_item_hold_its_windows_once(spark):
    words = " ".join(f"w{k}" for k in range(57))
    bench = spark.createDataFrame([(1, words)], "item_id long, text string")
    rows = d.item_pieces(bench, piece_words=10).orderBy("piece").collect()
    windows = [tuple(r.words.split()[k : k + 10]) for r in rows for k in range(r.windows)]
    assert windows == [tuple(words.split()[k : k + 10]) for k in range(48)]


def test_overlapping_items_of_many_lengths_and_repeats():
    pieces = [("long", "a b c d e f g h i j k l"), ("again", "a b c d e f g h i j"), ("one", "j"), ("two", "j j")]
    spans, items = d.Searcher(pieces).search("x a b c d e f g h i j j y a b c d e f g h i".encode().split())
    assert spans == [(1, 12)]
    assert items == {"long", "again", "one", "two"}


def test_the_search_skips_positions():
    patterns = d.Patterns(10, [b"p%d" % k for k in range(10)], [0])
    seen = []

    class Watched(list):
        def __getitem__(self, at):
            seen.append(at)
            return list.__getitem__(self, at)

    assert list(patterns.occurrences(Watched([b"q"] * 9_000))) == []
    assert len(seen) <= 1_001


def test_digests_and_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([(9, "one two"), (10, "two three")], "item_id long, text string")
    rows = {r.doc_id: r for r in d.contamination_digests(make_docs(["zero One, TWO three", None]), bench).collect()}
    assert (rows[1].n_words, rows[1].n_hit, rows[1].n_items, rows[1].contaminated) == (4, 3, 2, True)
    assert rows[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest()
    assert (rows[2].n_hit, rows[2].items_sha256, rows[2].contaminated) == (0, hashlib.sha256(b"").hexdigest(), False)
    assert d.contamination_digests(make_docs(["a"]), bench.limit(0)).first().n_items == 0
    assert d.contamination_digests(make_docs(["a"]).limit(0), bench).count() == 0


def test_a_very_long_text(spark, make_docs):
    text = "word " * 200_000 + "the planted passage of ten words stands right here now " + "word " * 1000
    assert run(spark, make_docs, [text], [(1, "The planted passage of ten words stands right here, now!")]) == [(201_010, list(range(200_000, 200_010)), ["1"])]
