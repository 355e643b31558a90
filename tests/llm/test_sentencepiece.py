import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from curatrix.llm import sentencepiece_fst as fst

from .conftest import EDGE_TEXTS

MODEL = public_tokenizers.path("piece_bpe_32k.model")
OURS = fst.PieceTransducer(fst.model_bytes(MODEL))
THEIRS = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" ▁abething\n\t.,0123éñ漢字🙂\x00ß-=_(){}"), max_size=60))
def test_random_texts_encode_and_decode_like_the_library(text):
    ids = OURS.encode(text)
    assert ids == THEIRS.encode(text)
    assert OURS.decode(ids) == THEIRS.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_unicode(text):
    assert OURS.encode(text) == THEIRS.encode(text)


def test_documents_match_the_library_and_come_back(spark, make_docs):
    docs = make_docs(EDGE_TEXTS)
    rows = fst.decode_tokens(fst.encode_texts(docs, MODEL), MODEL).collect()
    assert len(rows) == len(EDGE_TEXTS)
    for r in rows:
        text = EDGE_TEXTS[r.doc_id - 1] or ""
        assert list(r.token_ids) == THEIRS.encode(text) and r.n_tokens == len(r.token_ids)
        assert r.decoded == text
        assert r.n_byte_tokens == sum(THEIRS.is_byte(i) for i in r.token_ids)


def test_words_without_spaces_take_linear_time():
    for text in ("abcdefghij" * 40_000, "漢字🙂x" * 100_000):
        began = time.process_time()
        ids = OURS.encode(text)
        # a copy of the rest at each position would take minutes
        assert time.process_time() - began < 30
        assert ids == THEIRS.encode(text)


def test_empty_table(make_docs, spark):
    assert fst.encode_texts(make_docs(["x"]).limit(0), MODEL).count() == 0


def _varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number, value):
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        import struct

        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _unigram(pieces, chars_map=b""):
    body = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in pieces)
    return body + _field(2, _field(3, fst.UNIGRAM)) + _field(3, _field(2, chars_map) + _field(3, 0) + _field(4, 0))


def test_unigram_models_take_the_best_sum():
    model = fst.PieceTransducer(_unigram([("<unk>", 0.0, fst.UNKNOWN), ("a", -1.0, 1), ("b", -1.0, 1), ("ab", -1.5, 1), ("bb", -1.2, 1), ("abb", -9.0, 1)]))

    def brute(text):
        if not text:
            return 0.0, []
        best = (float("-inf"), [])
        for k in range(1, len(text) + 1):
            if text[:k] in model.scores:
                score, rest = brute(text[k:])
                best = max(best, (score + model.scores[text[:k]], [text[:k], *rest]))
        return best

    for text in ("abb", "abab", "bbbb", "a"):
        assert [model.pieces[i] for i in model.encode(text)] == brute(text)[1]
    assert model.encode("z") == [0]


def test_normaliser_rules_rewrite_the_longest_match():
    # a double array by hand: the one rule "A" to "xy"
    units = [0] * 400
    root = 1
    units[0] = root << 10
    at = root ^ ord("A")
    below = 130
    units[at] = ord("A") | 1 << 8 | (below ^ at) << 10
    units[below] = 1 << 31
    import struct

    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"xy\0"
    assert fst.CharsMap(blob).apply("bAAé") == "bxyxyé"


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError):
        fst.PieceTransducer(_unigram([("<unk>", 0.0, fst.UNKNOWN), ("a", 0.0, fst.USER_DEFINED)]))
