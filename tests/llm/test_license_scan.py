import re

from hypothesis import given, settings
from hypothesis import strategies as st

from curatrix.llm import license_scan as ls

from .conftest import EDGE_TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    hits = [(k, label) for p, label in ls.BASE_PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["MIT", "License", "cc", "BY", "-", "gnu general public", "license", "apache", "mit license", "é", " ", "\n", "x9"]), max_size=14))
def test_base_places(parts):
    text = " ".join(parts)
    assert ls.Scanner(ls.BASE_PHRASES, ls.MORE_PHRASES).scan(text)[:5] == brute(text)


def test_documents(make_docs):
    texts = [*EDGE_TEXTS, "Under the MIT License.\nSPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nmore", "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", "cc by cc by CC-BY", "SPDX-License-Identifier: MIT AND (", "cc b\u00fdy cc by"]
    rows = {r.doc_id: r for r in ls.scan_licenses(make_docs(texts)).collect()}
    for k, t in enumerate(texts):
        r = rows[k + 1]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    n = len(EDGE_TEXTS)
    assert rows[n + 1].labels == "apache,gpl,mit" and rows[n + 1].permissive is True and rows[n + 1].n_expressions == 1
    assert rows[n + 2].labels == "gpl" and rows[n + 2].permissive is False
    assert rows[n + 3].n_base == 3 and rows[n + 4].n_expressions == 0 and rows[1].labels == ""


def test_expressions():
    assert ls.parse_expression("mit or gpl-2.0 and isc") == ["mit", "gpl-2.0", "isc", "and", "or"]
    assert ls.parse_expression("(mit or gpl-2.0) and isc") == ["mit", "gpl-2.0", "or", "isc", "and"]
    assert ls.parse_expression("gpl-2.0 with x and mit") == ["gpl-2.0", "x", "with", "mit", "and"]
    for bad in ("", "mit or", "and mit", "(mit", "mit)", "mit isc", "()"):
        assert ls.parse_expression(bad) is None
    assert ls.evaluate(ls.parse_expression("mit or gpl-2.0")) == ({"mit", "gpl"}, True)
    assert ls.evaluate(ls.parse_expression("mit and gpl-2.0")) == ({"mit", "gpl"}, False)


def test_comment_ends_and_prose_after_a_tag():
    scan = lambda text: ls.Scanner(ls.BASE_PHRASES, ls.MORE_PHRASES).scan(text)[5:]
    for text, labels, n, free in (
        ("<!-- SPDX-License-Identifier: MIT -->", "mit", 1, True),
        ("/* SPDX-License-Identifier: GPL-2.0-only */ int x;", "gpl", 1, False),
        ("SPDX-License-Identifier: MIT. This file is part of x", "mit", 1, True),
        ("SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND ISC (see the file)", "gpl,isc,mit", 1, True),
        ("(SPDX-License-Identifier: MIT) more", "mit", 1, True),
        ("SPDX-License-Identifier: MIT AND (see the file", "mit", 1, True),
        ("SPDX-License-Identifier: MIT more SPDX-License-Identifier: GPL-2.0-only -- x", "gpl,mit", 2, False),
        ("SPDX-License-Identifier: MIT OR\nISC", "", 0, None),
        ("SPDX-License-Identifier: -->", "", 0, None),
    ):
        found = scan(text)
        assert (found[0], found[2], found[3]) == (labels, n, free), text


def test_families_of_identifiers():
    known = {
        "mit": "mit", "mit-0": "mit", "gpl-2.0-only": "gpl", "gplv3": "gpl", "apache2": "apache", "apache-2.0": "apache", "bsd-3-clause": "bsd", "0bsd": "bsd", "busl-1.1": "busl", "sspl-1.0": "sspl", "lgpl-2.1+": "lgpl",
        "cc-by-4.0": "cc-by", "cc-by-nc-sa-4.0": "cc-by-nc-sa", "cc-by-sa-3.0-de": "cc-by-sa", "cc0-1.0": "public-domain", "mpl": "mpl",
    }
    assert {i: ls.family(i) for i in known} == known
    assert {ls.family(i) for i in ("mitre-x", "gplx", "iscsi", "cc-bye", "licenseref-own")} == {None}


def test_slashes_exceptions_and_full_stops():
    scan = lambda text: ls.Scanner(ls.BASE_PHRASES, ls.MORE_PHRASES).scan(text)
    assert scan("SPDX-License-Identifier: MIT / Apache-2.0.")[5] == "apache,mit"
    found = scan("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 OR BUSL-1.1")
    assert found[5] == "busl,gpl" and found[8:] == (False, "classpath-exception-2.0")
    assert ls.exceptions(["mit"]) == set()
    assert scan("mit license " * 5000)[6] == 1.0


def brute_value(text):
    """Whether an expression may be free, by Python's own grammar over the same operators."""
    words = re.findall(r"[()]|[a-z0-9.-]+", text)
    return eval(" ".join(w if w in ("and", "or", "(", ")") else str(ls.family(w) not in ls.RESTRICTED) for w in words))  # noqa: S307


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.sampled_from(["mit", "gpl-2.0", "isc", "mpl-2.0"]), lambda inner: st.tuples(inner, st.sampled_from(["and", "or"]), inner).map(lambda t: f"({t[0]} {t[1]} {t[2]})"), max_leaves=8))
def test_expressions_against_brute_force(text):
    assert ls.evaluate(ls.parse_expression(text))[1] == brute_value(text)


def test_empty_table(make_docs):
    assert ls.scan_licenses(make_docs(["x"]).limit(0)).count() == 0
