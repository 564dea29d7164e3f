"""Fingerprints by locally consistent parsing."""

import random
from hashlib import sha256

import numpy as np
from helpers import DOCS, corpus, frame

from casefeatures.llm import parsing as P


def sample(seed, many=120):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    return [" ".join(rng.choice(known) for _ in range(rng.choice([0, 1, 3, 8, 30, 100, 500]))) for _ in range(many)]


def plain_phrases(names):
    """One level of the parse, symbol by symbol: lists of names as tuples."""
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    mask = (1 << 64) - 1

    def mix(z):
        z ^= z >> 30
        z = z * 0xBF58476D1CE4E5B9 & mask
        z ^= z >> 27
        z = z * 0x94D049BB133111EB & mask
        return z ^ z >> 31

    odd, fold = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
    names = [x if n == 1 else mix((x + n * fold) & mask) for x, n in runs]
    labels, bits = names, 64
    for _ in range(3):
        out = [labels[0] & 1]
        for a, b in zip(labels, labels[1:]):
            differ = a ^ b
            place = (differ & -differ).bit_length() - 1 if differ else bits
            out.append(2 * place + (b >> min(place, bits - 1) & 1))
        labels, bits = out, 8
    begins = [0] + [i for i in range(2, len(names) - 1) if labels[i] < labels[i - 1] and labels[i] <= labels[i + 1]]
    made = []
    for s, e in zip(begins, [*begins[1:], len(names)]):
        h = names[s]
        for x in names[s + 1 : e]:
            h = (h * fold + x) & mask
        made.append(mix((h + (e - s) * odd) & mask))
    return made


def test_phrases_against_plain_python():
    for text in [t.encode() for t in sample(1)] + [b"a", b"aaaa", b"ab" * 50, b"\x00" * 9 + b"abc"]:
        if not text:
            continue
        names = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
        want = [x + 1 for x in text]
        for _ in range(4):
            names, _ = P.phrases(names, np.array([0]))
            want = plain_phrases(want)
            assert names.tolist() == want


def test_a_text_is_parsed_alike_among_others():
    texts = [t.encode() for t in sample(2)]
    assert (P.signatures(texts) == np.concatenate([P.signatures([t]) for t in texts])).all()


def test_equal_substrings_share_interior_phrases():
    rng = random.Random(3)
    for text in [t.encode() for t in sample(3) if len(t) > 300][:20]:
        names = []
        for around in (b"", bytes(rng.randrange(97, 123) for _ in range(rng.randrange(1, 40)))):
            x = np.frombuffer(around + text + around, np.uint8).astype(np.uint64) + np.uint64(1)
            for _ in range(2):
                x, _ = P.phrases(x, np.array([0]))
            names.append(set(x.tolist()))
        assert len(names[0] - names[1]) <= 16


def test_likeness():
    texts = sample(4, 300)
    signed = P.signatures([t.encode() for t in texts])
    changed = P.signatures([P.edited(a, b).encode() for a, b in zip(texts, texts[1:] + texts[:1])])
    long_ = np.array([len(t) > 300 for t in texts])
    near, far = P.likeness(signed, changed)[long_], P.likeness(signed, np.roll(signed, -1, 0))[long_ & np.roll(long_, -1)]
    assert near.min() > 0.5 > far.max() and 0.65 < near.mean() < 0.95
    assert (P.likeness(signed, signed) == 1).all()
    empty = P.signatures([b""])
    assert P.likeness(empty, empty).tolist() == [1.0] and P.likeness(empty, P.signatures([b"a"])).tolist() == [0.0]


def expected(rows):
    """By one walk over the rows in order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, text, *_), (_, following, *_) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        a, b, c = (P.signatures([x.encode()]) for x in (text, changed, following))
        out.append((i, len(text), sha256(changed.encode()).hexdigest(), P.written_out(a)[0], P.written_out(b)[0], float(P.likeness(a, b)[0]), float(P.likeness(a, c)[0])))
    return out


def test_edit_likeness(spark):
    rows = corpus()
    df = frame(spark, rows).selectExpr("*", "'x' AS fingerprint", "1 AS piece", "2 AS `_h`")
    got = sorted(map(tuple, P.edit_likeness(df).collect()))
    assert got == sorted(expected(rows))
    fingerprints = {r["doc_id"]: r["fingerprint"] for r in P.fingerprints(df).collect()}
    assert fingerprints == {r[0]: r[3] for r in got}
    assert fingerprints[0] == fingerprints[1] != fingerprints[2]


def test_few_and_no_rows(spark):
    assert P.edit_likeness(spark.createDataFrame([], DOCS)).collect() == []
    one = [(7, "alone " * 30, "en", "s", 1)]
    assert [tuple(r) for r in P.edit_likeness(spark.createDataFrame(one, DOCS)).collect()] == expected(one)
    same = [(None, "x y z", "en", "s", 1), (None, "x y z", "en", "s", 1), (3, None, None, None, None)]
    assert sorted(map(str, map(tuple, P.edit_likeness(spark.createDataFrame(same, DOCS)).collect()))) == sorted(map(str, expected(same)))
