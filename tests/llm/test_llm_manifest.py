"""The Merkle manifest against plain Python."""

import random
import re
import zlib
from hashlib import sha256

import pytest
from helpers import DOCS, frame

from casefeatures.llm import manifest as M


def h(text):
    return sha256(text.encode()).hexdigest()


def levels(x):
    out = [x]
    while len(x) > 1:
        x = [h("".join(x[i : i + 8])) for i in range(0, len(x), 8)]
        out.append(x)
    return out


def sides(tree, i):
    for row in tree[:-1]:
        s = i // 8 * 8
        yield "".join(row[s:i]), "".join(row[i + 1 : s + 8])
        i //= 8


def expected(docs):
    def leaf(i, text, lang, source, n):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))

    by = {}
    for d in docs:
        by.setdefault(d[2], []).append((d[0] is not None, d[0] or 0, leaf(*d), d))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([r[2] for r in sorted(by[x], key=lambda r: r[:3])]) for x in langs}
    crown, out = levels([trees[x][-1][0] for x in langs]), []
    for j, x in enumerate(langs):
        for i, (_, _, own, d) in enumerate(sorted(by[x], key=lambda r: r[:3])):
            way = [*sides(trees[x], i), *sides(crown, j)]
            folded = own
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0:
                folded = leaf(d[0], d[1] and re.sub("[A-Z]", lambda m: m[0].lower(), d[1]), *d[2:])
            for a, b in way:
                folded = h(a + folded + b)
            out.append((d[0], own, trees[x][-1][0], crown[-1][0], h("".join(a + b for a, b in way)), folded, folded == crown[-1][0]))
    return out


def documents(seed, many, langs):
    rng = random.Random(seed)
    return [(i, rng.choice([None, "", "Äb C", f"Text {rng.random()}", "low"]), rng.choice(langs), rng.choice([None, "s:1", ""]), rng.choice([None, i])) for i in range(many)]


def same(df, docs):
    assert sorted(map(str, map(tuple, M.documents_proved(df).collect()))) == sorted(map(str, expected(docs)))


def test_addresses():
    """A node's address is its place in the log, for every size."""
    for n in [*range(1, 140), 511, 512, 513, 600]:
        top, log = M.height(n), M.appended([str(i) for i in range(n)], M.height(n))
        tree = levels([str(i) for i in range(n)])
        assert len(log) == sum(map(len, tree)) and log[-1] == tree[-1][0]
        for level, row in enumerate(tree):
            assert [log[M.address(n, level, i, top)] for i in range(len(row))] == row


@pytest.mark.parametrize("langs", [[None, "en", "de", "é"], ["en"], [f"x{i}" for i in range(70)] + [None]])
def test_proofs(spark, langs):
    docs = documents(1, 230, langs)
    same(frame(spark, docs).selectExpr("*", "1 AS place", "2 AS n", "'x' AS tree", "3 AS id"), docs)


@pytest.mark.parametrize("many", [63, 64, 65, 700])
def test_several_rounds(spark, monkeypatch, many):
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "BLOCK", 8)
    docs = documents(2, many, ["en", "en", "en", "de", None])
    same(frame(spark, docs), docs)
    made = M.rounds(M.placed(M.document_leaves(frame(spark, docs)), ["tree"], ["doc_id", "digest"]).withColumnRenamed("doc_id", "id"))
    log = {}
    for r in M.append_log(made).collect():
        assert log.setdefault(r["tree"], {}).setdefault(r["position"], r["digest"]) == r["digest"]
    for lang in {d[2] for d in docs}:
        own = sorted([r for r in expected(docs) if next(d[2] for d in docs if d[0] == r[0]) == lang])
        whole = M.appended([r[1] for r in own], M.height(len(own)))
        assert [log[lang][i] for i in range(len(log[lang]))] == whole and whole[-1] == own[0][2]


def test_repeated_rows_null_ids_and_none(spark):
    docs = documents(3, 20, ["en", None]) * 2 + [(None, "A", "en", None, None), (None, "B", "en", None, 2), (None, "A", "en", None, None)]
    same(frame(spark, docs), docs)
    assert M.documents_proved(spark.createDataFrame([], DOCS)).collect() == []
    same(spark.createDataFrame([(1, None, None, None, None)], DOCS), [(1, None, None, None, None)])
