"""Encoding by forced boundaries against encoding of whole texts."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tiktoken = pytest.importorskip("tiktoken")
from framemill.llm import tokens  # noqa: E402
from framemill.llm.tokens import FragmentEncoder, token_ids, vocabulary_file  # noqa: E402


@pytest.fixture(scope="module")
def encoder():
    return FragmentEncoder(vocabulary_file())


def ids_of(encoder, texts):
    ids, offsets = encoder.encode([t.encode() for t in texts])
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]


_ODD = ["a", "b", "é", "'", "'s", "'ll", " ", "  ", "\n", "\t", "　", " ", " ", "\u0085", " ", "1", "२", "!", "…", "가", "中", "👩‍🔧", "́", "\x1c", "﻿", "​", "ſ", "\r\n", "\U0010ffff", "\x00", "<|endoftext|>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_ODD) | st.characters(codec="utf-8"), max_size=30).map("".join), max_size=8))
def test_fragments_give_what_the_whole_gives(texts):
    encoder = _shared()
    assert ids_of(encoder, texts) == [encoder.encoding.encode_ordinary(t) for t in texts]


_made = []


def _shared():
    if not _made:
        _made.append(FragmentEncoder(vocabulary_file()))
    return _made[0]


def test_long_texts_and_forgetting(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    monkeypatch.setattr(tokens, "BLOCK", 64)
    rng = random.Random(1)
    words = ["word" + str(i) * (i % 9) for i in range(300)] + ["x" * 40, "ß" * 30]
    texts = [" ".join(rng.choice(words) for _ in range(2000)), "z" * 50_000, "", " " * 3000]
    assert ids_of(encoder, texts) == [encoder.encoding.encode_ordinary(t) for t in texts]


def test_cuts_never_fall_inside_a_token(encoder):
    import numpy as np

    text = "The gripper's state isn't ready… 다음 근무 전에 선반을 정리해 주세요. 请在下一班之前把架子整理好。".encode()
    cuts = set(encoder.cuts(np.frombuffer(text, np.uint8)).tolist())
    at, ends = 0, set()
    for i in encoder.encoding.encode_ordinary(text.decode()):
        at += len(encoder.encoding.decode_single_token_bytes(i))
        ends.add(at)
    assert cuts and cuts <= ends


def test_bytes_that_are_no_text(encoder):
    ids, offsets = encoder.encode([b"ok \xff\xfe", b"fine"])
    assert ids[: offsets[1]].tolist() == encoder.encoding.encode_ordinary("ok ��")
    assert ids[offsets[1] :].tolist() == encoder.encoding.encode_ordinary("fine")


def test_rows_with_nulls_empties_repeats_and_other_columns(spark, encoder):
    schema = "doc_id bigint, text string, ids string, text_bytes string"
    df = spark.createDataFrame([(1, "hello there", "x", "y"), (2, "", "x", "y"), (3, None, None, None), (None, "a", "x", "y"), (1, "hello there", "x", "y"), (4, "  \n", "", "")], schema)
    out = sorted(((r["doc_id"] or 0, list(r["ids"])) for r in token_ids(df).collect()), key=repr)
    want = [(0, "a"), (1, "hello there"), (1, "hello there"), (2, ""), (3, ""), (4, "  \n")]
    assert out == sorted(((i, encoder.encoding.encode_ordinary(t)) for i, t in want), key=repr)
    assert token_ids(df).dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert token_ids(df.limit(0)).count() == 0


def test_a_large_vocabulary_is_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError, match="too large"):
        vocabulary_file()
