"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled once a worker into three parts: a normaliser (the model's rewrite rules,
dummy prefix and escaped spaces), a piece automaton (a trie whose final states emit piece ids) and a
byte fallback for characters that no piece covers. Composed with an input they give a lattice whose
states are text positions; encoding is its shortest path in the tropical semiring.

* Unigram models: an arc weighs minus the piece's score.
* BPE models: merges are not a sum of scores, so the piece automaton is composed with a bigram
  acceptor. The arc of piece ``r`` after piece ``l`` weighs 0 if merging ``l + r`` alone gives
  exactly ``l, r``, and infinity otherwise. A sequence of pieces is the BPE encoding just if all its
  neighbours pass, so the one path of finite weight is the encoding, and each prefix has exactly one.
  The acceptor is composed on the fly: a pair is decided when first met, then kept.

Decoding inverts the piece transducer: ids to bytes, bytes to text.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices

SPACE = "▁"
#: Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Fixed value of the library: an unknown character scores this much under the worst piece.
UNKNOWN_PENALTY = 10.0
#: The score of a merge that is not possible.
NEVER = float("-inf")
#: What a worker keeps at most: encoded words and decided pairs. Full tables start afresh.
MAX_WORDS, MAX_PAIRS, MAX_WORD = 400_000, 600_000, 40
#: Model files over this size are refused rather than sent to every executor.
MAX_MODEL_BYTES = 64 << 20

ENCODED = "token_ids array<int>, n_tokens long, n_byte_tokens long"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if key & 7 == 1 else (4, at) if key & 7 == 5 else _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharsMap:
    """The normaliser's rewrite rules: a double-array trie of source bytes, then zero-ended targets."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0]
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
        self.targets = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and rewriting of the longest rule that fits at ``at``."""
        jump = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node, found = jump(self.units[0]), None
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(self.units) or self.units[node] & 0x800000FF != data[k]:
                break
            unit = self.units[node]
            node ^= jump(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.targets[start : self.targets.index(0, start)]
        return found

    def apply(self, text: str) -> str:
        data, out, at = text.encode(), bytearray(), 0
        while at < len(data):
            if hit := self.longest(data, at):
                at += hit[0]
                out += hit[1]
            else:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                out += data[at : at + size]
                at += size
        return out.decode()


class PieceTransducer:
    """A compiled model. Models with user-defined or unused pieces, or with spaces as suffixes, are refused."""

    def __init__(self, model: bytes) -> None:
        pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        norm: dict = {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE) or trainer.get(24) or any(k in (USER_DEFINED, UNUSED) for _, _, k in pieces):
            raise ValueError("only unigram and BPE models without user-defined or unused pieces are supported")
        self.chars_map = CharsMap(norm[2]) if norm.get(2) else None
        self.dummy_prefix, self.one_space, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        self.pieces = [p for p, _, _ in pieces]
        self.scores = {p: s for p, s, k in pieces if k == NORMAL}
        self.normal = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.unknown = next(i for i, x in enumerate(pieces) if x[2] == UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.byte_ids = frozenset(self.bytes.values())
        self.unknown_weight = UNKNOWN_PENALTY - min(self.scores.values(), default=0.0)
        #: No arc is longer, so that a position looks at so many characters and not at the whole rest of a long word.
        self.reach = max(map(len, self.normal), default=1)
        #: Characters of a piece; the last but one stands for the fallback of one character.
        self.lengths = [len(p) for p in self.pieces] + [1, 0]
        #: No piece has a space mark after another character: words are encoded each for itself.
        cut = not any(SPACE in p.lstrip(SPACE) for p in self.normal)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if cut else "(?s).+")
        kept = {CONTROL: b"", UNKNOWN: " ⁇ ".encode()}
        self.outputs = [bytes([int(p[3:5], 16)]) if k == BYTE else kept.get(k, p.replace(SPACE, " ").encode()) for p, _, k in pieces]
        self.known: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.made: dict[int, tuple | None] = {}

    @cached_property
    def trie(self) -> dict[str, tuple]:
        """By character the id of the piece that ends there, or -1, and what follows; workers that decode do not build it."""
        return self._trie(self.normal)

    @staticmethod
    def _trie(pieces: dict[str, int]) -> dict[str, tuple]:
        below: dict[str, dict] = {"": {}}
        for piece in sorted(pieces, key=len, reverse=True):
            for k in range(len(piece), 0, -1):
                inner = below.setdefault(piece[:k], {})
                known = piece[k - 1] in below.setdefault(piece[: k - 1], {})
                below[piece[: k - 1]][piece[k - 1]] = (pieces.get(piece[:k], -1), inner)
                if known:
                    break
        return below[""]

    def normalise(self, text: str) -> str:
        if self.chars_map:
            text = self.chars_map.apply(text)
        if self.one_space:
            text = re.sub(" {2,}", " ", text.strip(" "))
        if self.dummy_prefix and text:
            text = " " + text
        return text.replace(" ", SPACE) if self.escape else text

    def merges(self, piece: int) -> tuple[list[float], list[str], list[str]] | None:
        """How BPE makes a piece of its characters, the best score first, then the leftmost: each merge's score,
        and the first and last part before each and at the end. None if it does not make the piece."""
        if piece not in self.made:
            parts, score = list(self.pieces[piece]), self.scores.get
            scores, firsts, lasts = [], [parts[0]], [parts[-1]]
            gains = [score(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            while gains and (best := max(gains)) > NEVER:
                at = gains.index(best)
                merged = parts[at] = parts[at] + parts.pop(at + 1)
                del gains[at]
                if at:
                    gains[at - 1] = score(parts[at - 1] + merged, NEVER)
                if at < len(gains):
                    gains[at] = score(merged + parts[at + 1], NEVER)
                scores.append(best)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            self.made[piece] = ([*scores, NEVER], firsts, lasts) if len(parts) == 1 else None
        return self.made[piece]

    def follows(self, left: int, right: int) -> bool:
        """Whether the bigram acceptor lets ``right`` follow ``left`` (-1: the start of a word)."""
        key = (left + 1) * len(self.pieces) + right
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self.merges(right) is not None if left < 0 else self.stay_apart(left, right)
        return got

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether BPE of both together makes just the two. Until a merge crosses their border, each is made as it is
        alone, and the merges of both interleave by score; of equal ones the leftmost comes first."""
        a, b = self.merges(left), self.merges(right)
        if a is None or b is None:
            return False
        (scores_a, _, lasts), (scores_b, firsts, _) = a, b
        i = j = 0
        across = self.scores.get(lasts[0] + firsts[0], NEVER)
        while True:
            next_a, next_b = scores_a[i], scores_b[j]
            if across > next_a and across >= next_b:
                return False
            if next_a == next_b == NEVER:
                return True
            if next_a >= next_b:
                i += 1
                changed = lasts[i] != lasts[i - 1]
            else:
                j += 1
                changed = firsts[j] != firsts[j - 1]
            if changed:
                across = self.scores.get(lasts[i] + firsts[j], NEVER)

    def fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in char.encode()) if len(self.bytes) == 256 else (self.unknown,)

    def bpe_path(self, word: str) -> tuple[int, ...]:
        """The one path of finite weight, searched depth first, longest arcs first.

        Any path of finite weight from the start encodes its prefix, so a position that was left in
        vain lies on no accepted path and is not entered again.
        """
        n, root, reach, lengths, pairs, follows, width = len(word), self.trie, self.reach, self.lengths, self.pairs, self.follows, len(self.pieces)
        dead: set[int] = set()
        path: list[int] = []  # pieces, or -2 for the fallback
        arcs: list[list[int]] = []  # the pieces still to try at each position, the longest last
        i, left = 0, -1
        while i < n:
            todo: list[int] = []
            below = root
            for char in word[i : i + reach]:
                hit = below.get(char)
                if hit is None:
                    break
                piece, below = hit
                if piece >= 0:
                    todo.append(piece)
            if not todo or lengths[todo[0]] > 1:
                todo.insert(0, -2)
            arcs.append(todo)
            while True:
                if not todo:
                    arcs.pop()
                    dead.add(i)
                    i -= lengths[path.pop()]
                    todo, left = arcs[-1], path[-1] if path else -1
                    continue
                piece = todo.pop()
                if dead and i + lengths[piece] in dead:
                    continue
                if piece < 0:
                    ok = True
                else:
                    before = -1 if left < 0 else left
                    ok = pairs.get((before + 1) * width + piece)
                    if ok is None:
                        ok = follows(before, piece)
                if ok:
                    path.append(piece)
                    i += lengths[piece]
                    left = piece
                    break
        if -2 not in path:
            return tuple(path)
        out: list[int] = []
        at = 0
        for piece in path:
            out.extend((piece,) if piece >= 0 else self.fallback(word[at]))
            at += lengths[piece]
        return tuple(out)

    def unigram_path(self, word: str) -> tuple[int, ...]:
        n = len(word)
        best: list[tuple[float, int, int]] = [(0.0, 0, -1)] + [(float("inf"), 0, -2)] * n
        for i in range(n):
            weight, below, j = best[i][0], self.trie, i
            for char in word[i : i + self.reach]:
                hit = below.get(char)
                if hit is None:
                    break
                piece, below = hit
                j += 1
                if piece >= 0 and weight - self.scores[word[i:j]] < best[j][0]:
                    best[j] = weight - self.scores[word[i:j]], i, piece
            if word[i] not in self.normal and weight + self.unknown_weight < best[i + 1][0]:
                best[i + 1] = weight + self.unknown_weight, i, -2
        out: list[int] = []
        while n:
            _, at, piece = best[n]
            out.extend((piece,) if piece >= 0 else self.fallback(word[at:n])[::-1])
            n = at
        return tuple(out[::-1])

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, path = self.known, self.bpe_path if self.kind == BPE else self.unigram_path
        for word in self.words.findall(self.normalise(text)):
            ids = known.get(word)
            if ids is None:
                ids = path(word)
                if len(word) <= MAX_WORD:
                    if len(known) >= MAX_WORDS:
                        known.clear()
                    known[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        outputs = self.outputs
        text = b"".join([outputs[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_compiled: dict[int, PieceTransducer] = {}


def transducer(model: bytes) -> PieceTransducer:
    """The worker's compiled model."""
    key = hash(model)
    if key not in _compiled:
        _compiled[key] = PieceTransducer(model)
    return _compiled[key]


def model_bytes(path: str) -> bytes:
    """The model file, read where the job is defined; its size is checked, as every executor gets it."""
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is over {MAX_MODEL_BYTES} bytes")
    return data


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, token_ids, n_tokens, n_byte_tokens (ids that stand for single bytes).

    Whole texts are encoded, however long. Null and empty texts give an empty array. Repeated rows and
    equal texts give equal arrays; other columns are not read. An empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model_bytes(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(sent.value)
        for batch in slices(batches, "text"):
            ids, ends, n_bytes = array("i"), [0], []
            for text in batch.column("text").to_pylist():
                got = fst.encode(text or "")
                ids.extend(got)
                ends.append(len(ids))
                n_bytes.append(0 if fst.byte_ids.isdisjoint(got) else sum(i in fst.byte_ids for i in got))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(memoryview(ids) if ids else [], pa.int32()))
            counts = pa.array([b - a for a, b in zip(ends, ends[1:], strict=False)], pa.int64())
            yield pa.record_batch([batch.column("id"), lists, counts, pa.array(n_bytes, pa.int64())], ["id", "token_ids", "n_tokens", "n_byte_tokens"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, {ENCODED}").withColumnRenamed("id", id_col)


def decode_tokens(tokens: DataFrame, model: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``tokens`` and ``out_col``, the text of ``ids_col`` (null for a null array).

    Control ids give nothing, the unknown id its mark; byte ids that are not UTF-8 give U+FFFD. Ids
    outside the vocabulary raise IndexError. A column named like ``out_col`` is replaced.
    """
    sent = tokens.sparkSession.sparkContext.broadcast(model_bytes(model))

    @F.pandas_udf("string")
    def text(ids):  # noqa: ANN001, ANN202
        fst = transducer(sent.value)
        return ids.map(lambda x: None if x is None else fst.decode(x.tolist()))

    return tokens.withColumn(out_col, text(F.col(ids_col)))
