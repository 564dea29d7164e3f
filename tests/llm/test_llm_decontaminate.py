"""Benchmark windows against brute force."""

import random
import re
from hashlib import sha256

import pytest
from helpers import DOCS, frame, lower, prose
from pyspark.sql import functions as F

from casefeatures.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def brute(rows, items):
    sought = {}
    for i, text in items:
        w = WORD.findall(lower(text))
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            sought.setdefault(tuple(w[p : p + n]), set()).add(str(i))
    out = []
    for doc, text, *_ in rows:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for s, who in sought.items():
            for p in range(len(w) - len(s) + 1):
                if tuple(w[p : p + len(s)]) == s:
                    hit.update(range(p, p + len(s)))
                    found |= who
        out.append((doc, len(w), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    items = [(1, prose(rng, 25)), (10, prose(rng, 12)), (2, "Short Ünit item"), (3, "x9"), (4, None), (5, " .,"), (6, prose(rng, 10))]
    items.append(items[0])
    rows = [(i, prose(rng, 60), None, None, 0) for i in range(20)]
    rows += [(100, "so " + items[0][1].upper().replace(" ", ", ") + " end", None, None, 0), (101, items[1][1][:-3], None, None, 0)]
    rows += [(102, "a short.ünit item-short ÜNIT item", None, None, 0), (103, "a short ünit item", None, None, 0), (104, None, None, None, None), (105, "", None, None, 0)]
    rows += [(106, "x9 x9", None, None, 0), (107, items[6][1] + " " + items[6][1], None, None, 0), (103, "a short ünit item", None, None, 0)]
    rows.append((108, prose(rng, 5000) + " " + items[1][1] + " " + prose(rng, 3000), None, None, 0))
    return rows, items


@pytest.mark.parametrize("limit", [10**6, 20])
def test_like_brute_force(spark, case, limit):
    rows, items = case
    out = decontaminate.contamination(frame(spark, rows), spark.createDataFrame(items, ITEMS), limit=limit)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, items)


def test_windows_do_not_run_over_the_end_of_a_text(spark):
    rows = [(1, "one two", None, None, 0), (2, "three four", None, None, 0)]
    out = decontaminate.contamination(spark.createDataFrame(rows, DOCS).coalesce(1), spark.createDataFrame([(1, "two three")], ITEMS))
    assert not any(r["contaminated"] for r in out.collect())


def test_empty(spark, case):
    rows, items = case
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(frame(spark, []), none).collect() == []
    assert not any(r["contaminated"] for r in decontaminate.contamination(frame(spark, rows), none).collect())


def test_removed(spark, case):
    rows, items = case
    items = [x for x in items if x[0] != 3]
    df = frame(spark, rows).withColumns({"_items": F.lit("mine"), "_words": F.lit(0)})
    bench = spark.createDataFrame(items, ITEMS)
    hit = {r[0] for r in brute(rows, items) if r[5]}
    whole = decontaminate.removed(df, bench)
    assert whole.columns == df.columns and {r["doc_id"] for r in whole.collect()} == {r[0] for r in rows} - hit
    cut = decontaminate.removed(df, bench, share=None)
    assert cut.count() == len(rows)
    texts = {r["doc_id"]: r for r in cut.collect()}
    assert texts[100]["text"] == "so  end" and texts[100]["n_chars"] == 7 and texts[102]["text"] == "a short.ünit item-"
    assert all(texts[i]["text"] == t for i, t, *_ in rows if i not in hit)
    assert not any(r["contaminated"] for r in decontaminate.contamination(cut, bench).collect())
