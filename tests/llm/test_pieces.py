"""The score-ordered agenda against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids long, decoded string, agrees long, _encoded_text string"


@pytest.fixture(scope="module")
def known():
    return pieces.Encoder(MODEL)


def test_equal_scores_merge_the_leftmost_pair():
    assert pieces.agenda("aaaaa", {"aa": -1.0}) == ["aa", "aa", "a"]
    assert pieces.agenda("abcab", {"ab": -2.0, "bc": -1.0, "abc": -3.0}) == ["abc", "ab"]
    assert pieces.agenda("", {}) == []


@given(st.lists(st.text(st.sampled_from("abc"), min_size=1, max_size=4), min_size=1, max_size=12), st.lists(st.text(st.sampled_from("abcd"), max_size=4), max_size=20))
@settings(max_examples=150, deadline=None)
def test_matrix_and_heap_agree(vocabulary, segments):
    scores = {piece: float(-(i // 2)) for i, piece in enumerate(dict.fromkeys([*"abc", *vocabulary]))}
    pairs = pieces.Pairs(scores)
    segments = [s for s in segments if s]
    if segments:
        symbols, there = pairs.merge(segments, 4)
        for row, inside, segment in zip(symbols, there, segments):
            assert [pairs.alphabet[x] if x >= 0 else chr(-2 - x) for x in row[inside]] == pieces.agenda(segment, scores)


@given(st.lists(st.text(st.sampled_from("the in er▁  \t\n\x00éß漢😀<s>/0xA"), max_size=50), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_library(known, texts):
    ids, same = known.encode(texts)
    assert [x.tolist() for x in ids] == known.library.encode(texts) and all(same)


def test_long_texts(known):
    r = random.Random(3)
    for text in (" " * 200_000, "ab" * 50_000, "".join(r.choice("the rain é漢") for _ in range(200_000)), "▁" * 999, "\n" * 70_000):
        ids, same = known.encode([text])
        assert ids[0].tolist() == known.library.encode(text) and same == [True]


def test_forgetting_segments_changes_nothing(known, monkeypatch):
    monkeypatch.setattr(pieces, "SEGMENTS", 2)
    for text in ("one two three", "one two three four", "one"):
        assert known.encode([text])[0][0].tolist() == known.library.encode(text)


def test_known_segments_are_not_walked_through(known, monkeypatch):
    """A chunk looks its own segments up; what is remembered is not gone through for it."""

    class Remembered(dict):
        def keys(self):
            raise AssertionError("all that is remembered was asked for")

    monkeypatch.setattr(known, "known", Remembered())
    for text in ("one two", "two three four"):
        assert known.encode([text])[0][0].tolist() == known.library.encode(text)
    assert len(known.known) == 4


def test_rows_and_digests(spark, known):
    texts = ["plain words", None, "", "plain words", "  spaced\tout ", "漢字😀", "x" * 40_000]
    docs = spark.createDataFrame([(i if i != 5 else None, t, 7, "d", 1, "e") for i, t in enumerate(texts)], SCHEMA)
    found = pieces.encode(docs, MODEL, "doc_id")
    rows = {r["doc_id"]: r for r in found.collect()}
    short = {r["doc_id"]: r for r in pieces.digests(found).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = known.library.encode(text or "")
        row, digest = rows[i if i != 5 else None], short[i if i != 5 else None]
        assert row["ids"] == ids and row["decoded"] == known.library.decode(ids) and row["agrees"]
        assert digest["n_tokens"] == len(ids)
        assert digest["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digest["decoded_sha256"] == hashlib.sha256(known.library.decode(ids).encode()).hexdigest()
    assert pieces.digests(pieces.encode(docs.where("false"), MODEL, "doc_id")).count() == 0


def test_other_vocabularies_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(pieces.UnsupportedVocabulary):
        pieces.Encoder(str(path))
