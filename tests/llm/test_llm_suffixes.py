"""Repeated passages against brute force."""

import random

import pytest
from helpers import corpus, frame, prose, words
from pyspark.sql import functions as F

from casefeatures.llm import suffixes


def brute(rows, least):
    """Stretches, and for each row the words that are repeats."""
    seen = {}
    for i, (_, text, *_) in enumerate(rows):
        w = words(text)
        for p in range(len(w) - least + 1):
            seen.setdefault(tuple(w[p : p + least]), []).append((i, p))
    marks = {}
    for at in seen.values():
        if len(at) > 1:
            for k, (i, p) in enumerate(sorted(at)):
                marks.setdefault((i, k == 0), []).append(p)
    out = []
    for (i, original), places in marks.items():
        run = []
        for p in sorted(places):
            if run and p > run[-1] + least:
                out.append((rows[i][0], run[0], run[-1] - run[0] + least, original))
                run = []
            run.append(p)
        out.append((rows[i][0], run[0], run[-1] - run[0] + least, original))
    return sorted(out)


@pytest.mark.parametrize(("least", "head"), [(50, 30), (8, 4), (5, 5)])
def test_like_brute_force(spark, least, head):
    rows = corpus()
    out = suffixes.repeated_passages(frame(spark, rows), least, head)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, least)


def test_repeats_within_a_text(spark):
    rng = random.Random(2)
    a, b = prose(rng, 60), prose(rng, 12)
    rows = [(0, f"{a} {b} {a} {b} {a}", None, None, 0), (1, "z " * 300, None, None, 0)]
    out = suffixes.repeated_passages(frame(spark, rows))
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 50)


def test_long_text_beyond_a_piece(spark, monkeypatch):
    rng = random.Random(4)
    a = prose(rng, 5000, 10**6)
    rows = [(0, a + " " + prose(rng, 300), None, None, 0), (1, prose(rng, 10) + " " + a, None, None, 0)]
    from casefeatures.llm import words as w

    monkeypatch.setattr(w, "PIECE", 1000)
    out = suffixes.repeated_passages(frame(spark, rows))
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 50)


@pytest.mark.parametrize("limit", [suffixes.BROADCAST_CUTS, -1])
def test_cut(spark, monkeypatch, limit):
    monkeypatch.setattr(suffixes, "BROADCAST_CUTS", limit)
    rows = corpus()
    df = frame(spark, rows).withColumns({"id": F.lit(3), "cuts": F.lit("c")})
    out = suffixes.without_repeats(df)
    assert out.columns == df.columns
    left = {r["doc_id"]: r for r in out.collect()}
    gone = {}
    for i, first, n, original in brute(rows, 50):
        if not original:
            gone.setdefault(i, set()).update(range(first, first + n))
    for i, text, *_ in rows:
        kept = [x for p, x in enumerate(words(text)) if p not in gone.get(i, ())]
        if i not in gone:
            assert left[i]["text"] == text
        elif kept:
            assert words(left[i]["text"]) == kept and left[i]["n_chars"] == len(left[i]["text"])
        else:
            assert i not in left
    again = suffixes.repeated_passages(out.select("doc_id", "text"))
    assert again.where("NOT original").count() == 0


def test_null_and_repeated_ids(spark):
    rng = random.Random(9)
    a = prose(rng, 60)
    rows = [(None, a, None, None, 0), (None, a, None, None, 0), (4, a, None, None, 0), (4, a, None, None, 0), (5, None, None, None, None)]
    out = suffixes.repeated_passages(frame(spark, rows)).collect()
    assert len(out) == 4 and sum(r["original"] for r in out) == 1
    assert suffixes.without_repeats(frame(spark, rows)).count() == 2


def test_empty(spark):
    assert suffixes.repeated_passages(frame(spark, [])).collect() == []
    assert suffixes.without_repeats(frame(spark, [])).collect() == []


def test_cut_spares_overlapped_originals(spark):
    rng = random.Random(5)
    line = prose(rng, 10)
    rows = [(0, " ".join([line] * 6), None, None, 0), (1, "z " * 300, None, None, 0), (2, "end " + " ".join([line] * 6), None, None, 0)]
    left = {r["doc_id"]: words(r["text"]) for r in suffixes.without_repeats(frame(spark, rows)).collect()}
    assert left[0][:50] == words(rows[0][1])[:50] and left[1] == ["z"] * 50 and left[2] == ["end"]
