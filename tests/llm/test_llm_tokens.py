"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pytest
import sentencepiece
from helpers import DOCS, corpus, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casefeatures.llm import tokens

with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    MODEL = f.read()
SP = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
KNOWN = tokens.proof(MODEL)
COUNT = tokens._counter(SP, KNOWN)


def test_proof():
    assert KNOWN.divides and len(KNOWN.whole) > 10_000 and "\n" in KNOWN.lone
    for x in random.Random(1).sample(sorted(KNOWN.whole), 300):
        assert len(SP.encode(x[1:].replace("▁", " "))) == 1


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("ab e\n\t▁  　é<s>/|", max_size=40), st.lists(st.sampled_from(["the", " ", "  ", "\n", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "ing", "한", "\0", "é"]), max_size=25).map("".join)))
def test_like_the_library(text):
    assert COUNT(text) == len(SP.encode(text))


def test_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 7)
    for _, text, *_ in corpus():
        assert COUNT(text or "") == len(SP.encode(text or ""))


def test_undivided_model_is_encoded_whole():
    count = tokens._counter(SP, tokens.Proof(False, frozenset(), ""))
    assert count("a  b\nc") == len(SP.encode("a  b\nc"))


def test_rows(spark):
    rows = [*corpus(), (None, "null id", None, None, 0), (7, "again", None, None, 0), (7, "again", None, None, 0)]
    out = tokens.token_counts(frame(spark, rows).withColumn("n_tokens", F.lit("x")), MODEL)
    want = sorted(((i, len((t or "").encode()), n := len(SP.encode(t or "")), n > 4096) for i, t, *_ in rows), key=str)
    assert sorted((tuple(r) for r in out.collect()), key=str) == want
    assert any(r[3] for r in want)
    assert tokens.token_counts(spark.createDataFrame([], DOCS), MODEL).collect() == []


@pytest.mark.parametrize("text", ["", " ", "\n", "▁", "a" * 5000, "the " * 3000, "\n" * 50])
def test_edges(text):
    assert COUNT(text) == len(SP.encode(text))
