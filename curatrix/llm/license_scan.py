"""License scans: an Aho-Corasick automaton finds notice phrases and identifier tags, and a
shunting-yard parser evaluates the and/or/with expressions that follow the tags.

Phrases are matched on words: the text in UTF-8 with A-Z lower-cased, cut at all ASCII characters but
letters and digits, joined by one space. A phrase between spaces is then one string to find, and the
spaces before a hit number its first word. Tags are matched on the lower-cased text itself, as their
expressions hold punctuation; one expression ends with its line, or before it with the first token that
cannot go on: a comment end or prose.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices

#: The notice phrases of the contract and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases of common licences.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "all rights reserved": "proprietary",
    "public domain": "public-domain",
}
#: Identifier tags, before a licence expression.
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Stems of public licence identifiers and the labels of their families. A version and suffixes follow.
FAMILIES = {
    "0bsd": "bsd",
    "afl": "afl",
    "agpl": "agpl",
    "apache": "apache",
    "apsl": "apsl",
    "artistic": "artistic",
    "blueoak": "blueoak",
    "bsd": "bsd",
    "bsl": "bsl",
    "busl": "busl",
    "cc-pddc": "public-domain",
    "cc0": "public-domain",
    "cddl": "cddl",
    "cecill": "cecill",
    "cpal": "cpal",
    "cpl": "cpl",
    "ecl": "ecl",
    "elastic": "elastic",
    "epl": "epl",
    "eupl": "eupl",
    "ftl": "freetype",
    "gfdl": "gfdl",
    "gpl": "gpl",
    "hpnd": "hpnd",
    "isc": "isc",
    "json": "json",
    "lgpl": "lgpl",
    "libpng": "libpng",
    "lppl": "lppl",
    "mit": "mit",
    "mpl": "mpl",
    "ms-pl": "ms-pl",
    "ms-rl": "ms-rl",
    "mulanpsl": "mulan",
    "ncsa": "ncsa",
    "odbl": "odbl",
    "odc-by": "odc-by",
    "ofl": "ofl",
    "openssl": "openssl",
    "osl": "osl",
    "pddl": "public-domain",
    "php": "php",
    "polyform": "polyform",
    "postgresql": "postgresql",
    "psf": "psf",
    "python": "psf",
    "qpl": "qpl",
    "ruby": "ruby",
    "sissl": "sissl",
    "sspl": "sspl",
    "unicode": "unicode",
    "unlicense": "public-domain",
    "upl": "upl",
    "vim": "vim",
    "w3c": "w3c",
    "wtfpl": "public-domain",
    "x11": "x11",
    "zlib": "zlib",
    "zpl": "zpl",
}
#: What may follow a stem: a version or suffixes after a dash, a dot or a plus, a number, or a v and a number.
AFTER_STEM = re.compile(r"(?:[-.+]|v?\d|$)")
#: Attribution licences name their terms one by one; each stays in the label.
ATTRIBUTION = re.compile(r"cc-by(?:-(?:nc|nd|sa))*(?=[-.+]|\d|$)")
#: Families that bind derived works or their use; what may be used under one of them alone is restricted.
RESTRICTED = frozenset({
    "agpl", "apsl", "busl", "cddl", "cecill", "cpal", "cpl", "elastic", "epl", "eupl", "gfdl", "gpl", "lgpl", "mpl", "ms-rl", "odbl", "osl", "polyform", "proprietary", "qpl", "sissl", "sspl",
    "cc-by-nc", "cc-by-nd", "cc-by-sa", "cc-by-nc-nd", "cc-by-nc-sa",
})
#: An operator binds tighter the higher it stands; ``with`` joins an exception to its licence.
BINDS = {"or": 1, "and": 2, "with": 3}
#: How much one place, one labelled phrase and one parsed expression show that a licence is stated.
PLACE_WEIGHT, EXPRESSION_WEIGHT = 0.5, 0.9

#: Bytes of words to themselves, A-Z to a-z, others to a space. Bytes from 0x80 belong to words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
TOKEN = re.compile(r"[()/]|[a-z0-9.+\-:]+|[\r\n]")
#: What a token must hold to be an identifier: dashes alone are the end of a comment.
NAMED = re.compile(r"[a-z0-9]")


def family(identifier: str) -> str | None:
    """The label of an identifier such as ``gpl-2.0-only``: of the longest stem that a version, a suffix or nothing
    follows; None for unknown identifiers."""
    if terms := ATTRIBUTION.match(identifier):
        return terms.group()
    return max(((len(k), v) for k, v in FAMILIES.items() if identifier.startswith(k) and AFTER_STEM.match(identifier, len(k))), default=(0, None))[1]


def parse_expression(text: str, start: int = 0, whole: bool = True) -> list[str] | None:
    """A licence expression in postfix order, by two stacks; None if it is not well formed.

    The expression ends with its line; a slash between identifiers is an ``or``. Unless it must be ``whole``, other text
    may follow: the longest well-formed start counts, up to the first token that cannot go on. An expression whose line
    ends too early is ill formed.
    """
    out: list[str] = []
    held: list[str] = []
    operand, depth = True, 0
    # the last place where all was well formed; outside brackets three operators at most are held
    best: tuple[int, list[str]] | None = None
    for match in TOKEN.finditer(text, start):
        # a full stop ends a sentence, not an identifier
        token = match.group().rstrip(".:") or match.group()
        token = "or" if token == "/" else token
        if token in "\r\n":
            break
        named = token in "()" or NAMED.search(token)
        if not named and operand and not whole:
            continue
        if not named or (operand and (token == ")" or token in BINDS)) or (not operand and token not in BINDS and token != ")") or (token == ")" and not depth):
            return None if whole or best is None else out[: best[0]] + best[1]
        if token == "(":
            held.append(token)
            depth += 1
        elif token == ")":
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            depth -= 1
        elif token in BINDS:
            while held and held[-1] != "(" and BINDS[held[-1]] >= BINDS[token]:
                out.append(held.pop())
            held.append(token)
            operand = True
        else:
            out.append(token)
            operand = False
        if not operand and not depth:
            best = len(out), held[::-1]
    return None if operand or depth else out + held[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """(families named, whether some choice of the ``or`` branches avoids every restricted family)."""
    stack: list[tuple[set[str], bool]] = []
    for token in postfix:
        if token in BINDS:
            right, left = stack.pop(), stack.pop()
            free = left[1] or right[1] if token == "or" else left[1] and right[1] if token == "and" else left[1]
            stack.append((left[0] | right[0] if token != "with" else left[0], free))
        else:
            label = family(token)
            stack.append(({label} if label else set(), label is not None and label not in RESTRICTED))
    return stack[0]


def exceptions(postfix: list[str]) -> set[str]:
    """The exceptions that a ``with`` joins to a licence."""
    return {postfix[k - 1] for k, token in enumerate(postfix) if token == "with" and postfix[k - 1] not in BINDS}


def automaton(strings: dict[str, object]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for key, value in strings.items():
        found.add_word(key, value)
    found.make_automaton()
    return found


class Scanner:
    def __init__(self, base: dict[str, str], more: dict[str, str]) -> None:
        # a hit keeps one space on either side: neighbours share it
        self.phrases = automaton({f" {p} ": (len(p) + 1, label, p in base) for p, label in {**more, **base}.items()})
        self.tags = automaton({t: t for t in TAGS})

    def scan(self, text: str) -> tuple:
        raw = text.encode()
        words = raw.translate(WORD_BYTES).split()
        line = f" {b' '.join(words).decode('latin-1')} "
        starts: list[int] = []
        base: set[str] = set()
        more: set[str] = set()
        n_more = 0
        for end, (size, label, is_base) in self.phrases.iter(line):
            if is_base:
                starts.append(end - size)
                base.add(label)
            else:
                n_more += 1
                more.add(label)
        first, last = (line.count(" ", 0, f(starts)) for f in (min, max)) if starts else (None, None)
        free, n_expressions = None, 0
        joined: set[str] = set()
        lower = raw.translate(LOWER_BYTES).decode("latin-1")
        for end, _ in self.tags.iter(lower):
            if postfix := parse_expression(lower, end + 1, whole=False):
                labels, may = evaluate(postfix)
                joined |= exceptions(postfix)
                more |= labels
                n_expressions += 1
                free = may if free is None else free and may
        weak = 1.0 - (1.0 - PLACE_WEIGHT) ** (len(starts) + n_more)
        score = 1.0 - (1.0 - weak) * (1.0 - EXPRESSION_WEIGHT) ** n_expressions
        return len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | more)), score, n_expressions, free, ",".join(sorted(joined))


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_expressions long, permissive boolean, exceptions string"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """One row per document: id_col; n_words; n_base, first_word and last_word, the number of places of
    base phrases and their smallest and largest first word (from 0, else null); base_labels and labels,
    distinct, sorted and comma-joined ('' for none); score from 0 to 1, the strength of what was found;
    n_expressions, the well-formed expressions after tags; permissive, whether each of them leaves a
    choice without restricted families (null without expressions); exceptions, those that expressions join to their
    licences, sorted and comma-joined.

    Places overlap freely. Whole texts are read; null counts as empty: 0 words, no labels, score 0. Ill
    formed expressions are left out. Repeated rows give equal rows; other columns are not read.
    """
    base, more = BASE_PHRASES if base is None else base, MORE_PHRASES if more is None else more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, more)
        names = [x.split()[0] for x in COLUMNS.split(", ")]
        kinds = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}[x.split()[1]] for x in COLUMNS.split(", ")]
        for batch in slices(batches, "text"):
            rows = [scanner.scan(t or "") for t in batch.column("text").to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.record_batch([batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["id", *names])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, {COLUMNS}").withColumnRenamed("id", id_col)
