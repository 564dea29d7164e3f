"""The n-gram Jaccard join against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from helpers import corpus, frame, prose, words
from pyspark.sql import functions as F

from casefeatures.llm import graph, jaccard


def brute(rows):
    sets = []
    for _, text, *_ in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    ids = [r[0] for r in rows]
    least = {}
    for i in range(len(rows)):
        if ids[i] is not None:
            least[find(i)] = min(ids[i], least.get(find(i), ids[i]))
    return sorted(((ids[i], len(sets[i]), least.get(find(i)) if sets[i] else ids[i]) for i in range(len(rows))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_like_brute_force(spark):
    rows = corpus()
    assert got(jaccard.jaccard_classes(frame(spark, rows))) == brute(rows)


def test_family_of_altered_copies(spark):
    """Copies altered more and more: some pairs link, some only over others, some not at all."""
    rng = random.Random(5)
    base = prose(rng, 100, 10**6).split()
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.sample(range(100), i % 7):
            w[k] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), None, None, 0))
    assert got(jaccard.jaccard_classes(frame(spark, rows))) == brute(rows)


def quick_brute(rows):
    """As brute, for many similar sets: all intersections by one product."""
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words(r[1]) for r in rows)]
    many = Counter(t for x in sets for t in x)
    number = {t: i for i, t in enumerate(t for t, n in many.items() if n > 1)}
    there = np.zeros((len(rows), len(number)), np.float32)
    for i, x in enumerate(sets):
        there[i, [number[t] for t in x if t in number]] = 1
    common, size = there @ there.T, np.array([len(x) for x in sets])
    a, b = np.nonzero(100 * common >= 80 * (size[:, None] + size[None, :] - common))
    root = np.arange(len(rows))
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        if (new == root).all():
            return sorted(zip(range(len(rows)), size.tolist(), root.tolist()), key=str)
        root = new


@pytest.mark.parametrize("seed", [1, 2])
def test_large_family_of_near_misses(spark, monkeypatch, seed):
    """2,000 copies altered so much that few pairs are similar, some with alterations in common: all links are found and few pairs looked at."""
    rng = random.Random(seed)
    base = prose(rng, 120, 10**6).split()
    passages = [[(k, f"z{rng.randrange(10**6)}") for k in rng.sample(range(120), 3)] for _ in range(150)]
    rows = []
    for i in range(2000):
        w = list(base)
        for k in rng.sample(range(120), rng.choice([1, 2, 4, 4, 4, 5, 5, 6])):
            w[k] = f"y{rng.randrange(10**6)}"
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            for k, x in rng.choice(passages):
                w[k] = x
        rows.append((i, " ".join(w), None, None, 0))
    looked_at, plain = [], jaccard.compared
    monkeypatch.setattr(jaccard, "compared", lambda d, c, pairs: looked_at.append(pairs.count()) or plain(d, c, pairs))
    assert got(jaccard.jaccard_classes(frame(spark, rows))) == quick_brute(rows)
    assert sum(looked_at) < len(rows) ** 2 / 20  # a tenth of all pairs; the lists of shared tokens would give nearly all


def test_drifting_copies(spark):
    """Every text drops the first words of the one before and goes on: one family, no word of which stands in most texts."""
    step, rng = 10, random.Random(10)
    long = prose(rng, 100 + step * 80, 10**6).split()
    texts = [" ".join(long[step * i : step * i + 100]) for i in range(80)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(rng.sample(texts, 80))]
    assert got(jaccard.jaccard_classes(frame(spark, rows))) == brute(rows)


def test_repeated_rows_null_ids_and_more_columns(spark):
    rows = corpus()[:14]
    rows += [rows[0], rows[0], (None, rows[0][1], None, None, 0), (None, "quite alone here it stands now", None, None, 0), (None, None, None, None, None)]
    df = frame(spark, rows).withColumns({"n": F.lit(1), "cls": F.lit("x"), "token": F.lit(2), "id": F.lit(7)})
    assert got(jaccard.jaccard_classes(df)) == brute(rows)


def test_empty(spark):
    assert jaccard.jaccard_classes(frame(spark, [])).collect() == []
    assert got(jaccard.jaccard_classes(frame(spark, [(1, None, None, None, None)]))) == [(1, 0, 1)]


def test_prefix_keeps_enough_tokens():
    tokens = np.arange(1, 101, dtype=np.uint64)
    k, prefix, short, *_ = jaccard.prefix_of(tokens, np.empty(0, np.uint64), np.empty(0, np.int64))
    assert k == 1 and short == 12 and list(prefix) == list(range(1, 22))
    often = np.arange(1, 90, dtype=np.uint64)
    k, prefix, *_ = jaccard.prefix_of(tokens, often, np.full(89, 50))
    assert len(prefix) == 20 + k and set(range(90, 101)) <= set(prefix.tolist())


def test_shuffled_and_broadcast_lookups_agree(spark, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    assert got(jaccard.jaccard_classes(frame(spark, rows))) == brute(rows)


def test_one_of_each(spark):
    rows = corpus()
    rows.append(rows[0])
    df = frame(spark, rows).withColumn("id", F.lit("mine"))
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    stay = {c for _, _, c in brute(rows)}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(stay)


@pytest.mark.parametrize("chain", [2, 17])
def test_components_of_a_chain(spark, chain):
    links = spark.createDataFrame([(i, i + 1) for i in range(chain)] + [(100, 101), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in graph.components(links).collect()}
    assert roots == {**dict.fromkeys(range(chain + 1), 0), 100: 100, 101: 100}


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_components_of_many_shapes(spark, monkeypatch, broadcast):
    """Random graphs, stars whose centre is not the smallest node and long chains, with nodes broadcast and shuffled, against union-find."""
    monkeypatch.setattr(graph, "BROADCAST_NODES", broadcast)
    monkeypatch.setattr(graph, "TASK_ROWS", 50)
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)]
    links += [(1500, n) for n in rng.sample(range(1000, 2000), 200)] + [(n + 1, n) for n in range(3000, 3060)]
    root = {n: n for link in links for n in link}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    linked = {n for a, b in links if a != b for n in (a, b)}
    found = graph.components(spark.createDataFrame(links + links[:50], "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((n, find(n)) for n in linked)


def test_small_graph_takes_few_tasks(spark):
    """A few links are not dealt over as many tasks as a shuffle has partitions, time and again."""
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("small graph", "")
        graph.components(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")).collect()
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("small graph") for s in tracker.getJobInfo(j).stageIds}
        assert sum(tracker.getStageInfo(s).numCompletedTasks for s in stages if tracker.getStageInfo(s)) < 4 * 97
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_words_of_a_batch_take_little_memory():
    """What words() holds beside its result is bounded well below the batch's own hashes, so that the workers of an executor stay small."""
    import tracemalloc

    import pyarrow as pa

    from casefeatures.llm.words import SPACES
    from casefeatures.llm.words import words as cut

    column = pa.array([prose(random.Random(i), 2000) for i in range(300)])
    tracemalloc.start()
    n = sum(len(w.hashes) for w in cut(column, SPACES))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 300 * 2000 and peak < 24 << 20
