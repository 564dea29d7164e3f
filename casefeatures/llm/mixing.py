"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size is how often it is read: every document is taken the whole part of that many times, and once more with a
probability of the rest. Which documents those are, the cube method's flight decides: it walks through the null space of the balancing
constraints (number of documents, number of words), so that both sums stay as they are while one probability after the other becomes 0
or 1. A block of any size ends with as many undecided documents as there are constraints. Blocks are flown side by side, what they leave
undecided is put into new blocks, and so on until one block per source is left: the landing problem of at most two documents, which is
settled by the choice that comes nearest to the source's target.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefeatures.llm.frames import clear
from casefeatures.sources.files import scratch_path, written

#: Documents flown in one block, about.
BLOCK = 4096
#: Most times a document is read.
MOST = 3
#: Sources, at most: their sizes are on the driver.
MAX_SOURCES = 1_000_000
_EDGE = 1e-9


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (1, 2, 3), most: int = MOST) -> dict[str | None, float]:
    """Target of each source. Sources by code point, null last, have the weights in turn and share all words; none gets more than
    ``most`` times its size, and what is over is shared again by weight."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, out = dict(order), {}
    left = float(sum(size.values()))
    free = [s for s, _ in order]
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * size[s]]
        if not over:
            out.update({s: left * weight[s] / total for s in free})
            break
        out.update({s: float(most * size[s]) for s in over})
        left -= sum(most * size[s] for s in over)
        free = [s for s in free if s not in out]
    return out


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities ``p`` to 0 or 1, keeping their sum and their sum with ``x``; at most two stay in between."""
    p = p.copy()
    scale = float(x.max()) or 1.0
    inside = [i for i in range(len(p)) if _EDGE < p[i] < 1 - _EDGE]
    active, rest = inside[:3], inside[3:]
    draws = iter(rng.random(len(inside) + 3).tolist())
    while len(active) == 3 or (len(active) == 2 and x[active[0]] == x[active[1]]):
        if len(active) == 3:
            a, b, c = (x[i] / scale for i in active)
            step = (b - c, c - a, a - b)  # orthogonal to (1, 1, 1) and to (a, b, c)
            if not any(step):
                step = (1.0, -1.0, 0.0)
        else:
            step = (1.0, -1.0)
        up = min((1 - p[i]) / u if u > 0 else p[i] / -u for i, u in zip(active, step, strict=True) if u)
        down = min(p[i] / u if u > 0 else (1 - p[i]) / -u for i, u in zip(active, step, strict=True) if u)
        far = up if next(draws) * (up + down) < down else -down
        for i, u in zip(active, step, strict=True):
            p[i] += far * u
        kept = [i for i in active if _EDGE < p[i] < 1 - _EDGE]
        for i in active:
            if i not in kept:
                p[i] = round(p[i])
        if len(kept) == len(active):  # rounding left all inside: settle the one nearest to an end
            i = min(active, key=lambda i: min(p[i], 1 - p[i]))
            p[i] = round(p[i])
            kept.remove(i)
        active = kept
        while rest and len(active) < 3:
            active.append(rest.pop(0))
    return p


def _flown(rows: DataFrame, salt: int) -> DataFrame:
    """One flight in every (``place``, ``block``); rows with their new ``p``."""
    schema = "row long, doc_id long, place int, size long, p double"

    def work(keys: tuple, block: pd.DataFrame) -> pd.DataFrame:
        # The order within a block follows the documents, not how Spark dealt them.
        block = block.sort_values(["draw", "doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
        rng = np.random.default_rng([int(keys[0]), int(keys[1]), salt])
        block["p"] = flight(block["p"].to_numpy(float), block["size"].to_numpy(float), rng)
        return block[["row", "doc_id", "place", "size", "p"]]

    drawn = rows.withColumn("draw", F.xxhash64("doc_id", "size", F.lit(salt)))
    spread = F.xxhash64("doc_id", "size", F.when(F.col("doc_id").isNull(), F.col("row")), F.lit(-1 - salt))
    counts = rows.groupBy("place").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = drawn.join(F.broadcast(counts), "place").withColumn("block", F.pmod(spread, F.col("blocks")).cast("int"))
    return blocks.drop("blocks").groupBy("place", "block").applyInPandas(work, schema)


def mixed(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` (words taken, repeats counted) of every row.

    ``size`` is the number of words; null and empty texts have none and are taken not at all. A null source is a source of its own.
    Repeated rows are documents of their own. The draw depends on ids and sizes only, so reruns agree. Further columns are not read.
    """
    return _mixed(docs.withColumn("_row", F.monotonically_increasing_id()), weights, most).drop("row")


def _mixed(docs: DataFrame, weights: tuple[float, ...], most: int) -> DataFrame:
    """As ``mixed``, with ``row``: the given ``_row``."""
    spark = docs.sparkSession
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = written(docs.select("doc_id", "source", size.alias("size"), F.col("_row").alias("row")), scratch_path(spark, "sizes"))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    found = [tuple(r) for r in sums.limit(MAX_SOURCES + 1).collect()]
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    goal = targets([(s, n) for s, n, _ in found], weights, most)
    known = [(i, s, n, goal[s], min(goal[s] / n, float(most)) if n else 0.0) for i, (s, n, _) in enumerate(sorted(found, key=lambda x: (x[0] is None, x[0] or "")))]
    known = spark.createDataFrame(known, "place int, of string, source_size long, target double, times double")
    rows = rows.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("of")))
    whole = F.floor("times").cast("long")
    drawn = rows.where("size > 0").select("row", "doc_id", "place", "size", (F.col("times") - whole).alias("p"))

    inside = (F.col("p") > _EDGE) & (F.col("p") < 1 - _EDGE)
    settled, salt, open_rows, before = [], 0, drawn, None
    while True:
        flown = written(_flown(open_rows, salt), scratch_path(spark, "flown"))
        settled.append(flown.where(~inside))
        open_rows = flown.where(inside)
        n = open_rows.groupBy("place").count().agg(F.max("count")).first()[0] or 0
        if n <= 2 or n == before:
            break
        salt, before = salt + 1, n
    # Landing: at most two documents of each source.
    done = settled[0]
    for x in settled[1:]:
        done = done.unionByName(x)
    left = _landed(open_rows, done.groupBy("place").agg(F.sum(F.col("size") * F.col("p")).alias("have")), drawn)
    extra = done.select("row", "p").unionByName(left)
    taken = F.col("size") * (whole + F.round(F.coalesce("p", F.lit(0.0))).cast("long"))
    return rows.join(extra, "row", "left").select("row", "doc_id", "size", "source_size", "target", taken.alias("taken"))


def _landed(open_rows: DataFrame, have: DataFrame, drawn: DataFrame) -> DataFrame:
    """Settle the last documents of each source so that its words come nearest to what was asked: ``row``, ``p``."""
    asked = drawn.groupBy("place").agg(F.sum(F.col("size") * F.col("p")).alias("asked"))
    rows = open_rows.join(F.broadcast(asked), "place").join(F.broadcast(have), "place", "left").withColumn("have", F.coalesce("have", F.lit(0.0)))

    def work(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["doc_id", "size"], na_position="last").reset_index(drop=True)
        size = block["size"].to_numpy(float)
        short = float(block["asked"].iloc[0]) - float(block["have"].iloc[0])
        if len(block) <= 10:
            p = min(product((0.0, 1.0), repeat=len(block)), key=lambda c: abs(short - float(np.dot(c, size))))
        else:  # equal rows that no null space could part: take as many as fit
            p = (np.cumsum(size) <= short).astype(float)
        return pd.DataFrame({"row": block["row"], "p": p})

    return rows.groupBy("place").applyInPandas(work, "row long, p double")


def taken_rows(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``docs`` as the mix takes it: every row as often as it is taken, columns as given."""
    docs, restored = clear(docs, "row", "_row", "_times", "_n")
    base = written(docs.withColumn("_row", F.monotonically_increasing_id()), scratch_path(docs.sparkSession, "docs"))
    mix = _mixed(base, weights, most).where("taken > 0")
    times = mix.select(F.col("row").alias("_row"), F.expr("taken div size").cast("int").alias("_times"))
    return restored(base.join(times, "_row").withColumn("_n", F.explode(F.sequence(F.lit(1), "_times"))))
