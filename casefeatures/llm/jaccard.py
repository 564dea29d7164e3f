"""Near-duplicate texts: a Jaccard self join on word n-grams with adaptive multi-match prefixes.

A text's set holds its distinct shingles of five words (fewer words: one shingle of all; none: an empty set that is linked
with nothing). Two sets that are similar enough and sorted by one common order share many of their first tokens: with at
least ``t`` common tokens, the first ``n - t + k`` tokens of both hold ``k`` common ones. Rare tokens come first in that order.
A text whose first tokens are frequent takes a longer prefix (a larger ``k``); ``k`` is the one with the lowest estimated cost of reading
lists and of comparing candidates. A pair is looked at only if it shares as many prefix tokens as the smaller ``k`` of the two asks for.

Equal sets are made one class first. A group of similar classes is never expanded into all pairs: every class is compared with
the hub (smallest class) of its lists. What is still unconnected goes to exact joins, in two parts:

- Classes near one hub (at least half alike) are a family, each described by what it lost of and added to the family's centre (the tokens of
  most of its classes). Two classes share the centre less both losses, plus their common losses and additions, so a similar pair must have a known
  number of these in common: if none, it is similar without a look; else the multi-match prefix join is made on losses and additions. Altered
  copies that are just not similar have few alterations in common and never meet.
- Pairs of different families meet in the lists of their own prefixes. In a list, the classes of its largest family meet the others only.

All steps are Spark joins and aggregations; a hub's set is sent to its classes in lots, so that no task gets all classes of a hub.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casefeatures.llm.frames import bounded_batches, clear, numbered
from casefeatures.llm.graph import components
from casefeatures.llm.words import SPACES, key, mix, sequence, windows, words
from casefeatures.sources.files import scratch_path, written

SHINGLE = 5
THRESHOLD = 80  # percent
#: Rows of a looked-up key table that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Frequent tokens known by count, at most; all other tokens count as rare. They set the order, not the result.
FREQUENT = 200_000
#: Tokens counted together in a task, and the count in such a block from which a token is reported.
BLOCK, BLOCK_LEAST = 2_000_000, 4
#: Prefixes are lengthened by at most so many tokens.
MOST_MATCHES = 8
#: Turns of comparing with hubs, at most; they end early when a turn links less than this share of the classes it compared.
HUB_TURNS, WORTH = 2, 0.02
#: Percent from which a class belongs to the family of its hub; classes that meet one copy of a hub's set; tokens that changes must have in common, at most (one changed word changes as many as a shingle has).
NEAR, LOT, MOST_ALTERED = 50, 256, 4 * SHINGLE + 1
#: What it costs to look at a pair, in rows read from lists of alterations.
LOOK = 100


def sets_of(column: pa.Array, k: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of every text."""
    for w in words(column, SPACES):
        all_of = windows(w.hashes, k)
        for i in range(w.last - w.first):
            s, e = int(w.at[i]), int(w.at[i + 1])
            if e - s >= k:
                yield w.first + i, np.unique(all_of[s : e - k + 1])
            elif e > s:
                short = np.array([sequence(w.hashes[s:e])], np.uint64)
                yield w.first + i, mix(short + np.uint64(e - s))
            else:
                yield w.first + i, np.empty(0, np.uint64)


def frequent_tokens(docs: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in many texts, sorted, and in how many: counted over all texts, block by block, and added up.

    A token that stands in at least BLOCK_LEAST texts of a block is reported; the ``limit`` most frequent come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(parts), return_counts=True)
            often = n >= BLOCK_LEAST
            return pa.RecordBatch.from_arrays([pa.array(token[often].view(np.int64)), pa.array(n[often])], ["token", "n"])

        held, size = [], 0
        for batch in batches:
            for _, x in sets_of(batch.column(0)):
                held.append(x)
                size += len(x)
                if size >= BLOCK:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    found = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "token").limit(limit).toPandas()
    tokens, n = top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(tokens)
    return tokens[order], n[order]


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


class Prefix(NamedTuple):
    """The first tokens of a set in the common order, ``k`` of which a partner must share; ``short`` of them do for a larger partner."""

    k: int
    tokens: np.ndarray
    short: int


def prefix_of(tokens: np.ndarray, often: np.ndarray, n_often: np.ndarray, percent: int = THRESHOLD) -> Prefix:
    """The prefix of a set with the k of the lowest estimated cost."""
    n = len(tokens)
    least = _ceil(percent * n, 100)  # common tokens that any partner needs
    larger = _ceil(2 * percent * n, 100 + percent)  # and one that is not smaller
    base = n - least + 1
    if len(often):
        place = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
        lists = np.where(often[place] == tokens, n_often[place], 1)
    else:
        lists = np.ones(n, np.int64)
    k, order = 1, np.arange(n)
    if lists.max() > 1:
        order = np.lexsort((tokens, lists))
        lists = lists[order]
        read = np.cumsum(lists)
        # A candidate of equal size is met at least k + spare times, once outside the k - 1 longest lists; comparing costs n.
        spare = larger - least
        most = min(MOST_MATCHES, least)
        costs = [read[base + k - 2] + n * min(read[base - 1], read[base + k - 2] / (k + spare)) for k in range(1, most + 1)]
        k = 1 + int(np.argmin(costs))
    return Prefix(k, tokens[order[: base + k - 1]], n - larger + k)


_PREFIXES = "doc_id long, n long, ka long, kb long, k int, short int, prefix array<long>"


def _prefixes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n``, ``ka``, ``kb`` (the set's name), ``k``, ``short`` and ``prefix`` of every row."""
    spark = docs.sparkSession
    often = spark.sparkContext.broadcast(frequent_tokens(docs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = often.value
        for batch in batches:
            rows, held, taken = [], [], 0

            def out() -> pa.RecordBatch:
                at = np.cumsum([0, *(len(p) for p in held)])
                prefix = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([*held, np.empty(0, np.uint64)]).view(np.int64)))
                i, n, a, b, k, short = zip(*rows, strict=True)
                longs = [pa.array(x, pa.int64()) for x in (n, a, b)]
                ints = [pa.array(x, pa.int32()) for x in (k, short)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i)), *longs, *ints, prefix], ["doc_id", "n", "ka", "kb", "k", "short", "prefix"])

            for i, x in sets_of(batch.column(1)):
                p = prefix_of(x, tokens, counts) if len(x) else Prefix(0, x, 0)
                rows.append((i, len(x), *key(x), p.k, p.short))
                held.append(p.tokens)
                taken += len(p.tokens)
                if taken >= BLOCK // 4:
                    yield out()
                    rows, held, taken = [], [], 0
            if rows:
                yield out()

    return docs.select("doc_id", "text").mapInArrow(work, _PREFIXES)


def _sets(docs: DataFrame, wanted: DataFrame, carry: list[str], most: int) -> DataFrame:
    """``carry`` and ``tokens`` for the rows of ``wanted`` (``doc_id``, ``ka``, ``kb`` of one member each, and ``carry``), ``most`` at most."""
    few = most <= BROADCAST_ROWS or wanted.count() <= BROADCAST_ROWS
    wanted = wanted.withColumnRenamed("doc_id", "_id")
    joined = docs.select("doc_id", "text").join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("_id")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            at, held, taken = [], [], 0

            def out() -> pa.RecordBatch:
                ends = np.cumsum([0, *(len(x) for x in held)])
                sets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held).view(np.int64)))
                rows = pa.array(at)
                return pa.RecordBatch.from_arrays([*(batch.column(3 + j).take(rows) for j in range(len(carry))), sets], [*carry, "tokens"])

            for i, x in sets_of(batch.column(0)):
                if len(x) and key(x) == names[i]:
                    at.append(i)
                    held.append(x)
                    taken += len(x)
                    if taken >= BLOCK // 4:
                        yield out()
                        at, held, taken = [], [], 0
            if at:
                yield out()

    schema = ", ".join([*(f"{c} long" for c in carry), "tokens array<long>"])
    return joined.select("text", "ka", "kb", *carry).mapInArrow(work, schema)


def _in_lots(rows: DataFrame, one: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (``one``, ``key``) with ``lot``, and the lots of every ``key``: what a key's rows share is copied for each lot of them."""
    lots = rows.groupBy(key).agg(F.ceil(F.count("*") / LOT).alias("lots"))
    dealt = rows.join(lots, key).select(one, key, F.pmod(F.xxhash64(one), F.col("lots")).alias("lot"))
    return dealt, lots.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot"))


def _with_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (``a``, ``b``) with the sets of both (``tokens``, ``others``)."""
    names = classes.select("cls", "doc_id", "ka", "kb")
    dealt, copies = _in_lots(pairs, "a", "b")
    most = pairs.count()  # a hub has no more lots than pairs
    left = _sets(docs, dealt.join(names.withColumnRenamed("cls", "a"), "a"), ["a", "b", "lot"], most)
    right = _sets(docs, copies.join(names.withColumnRenamed("cls", "b"), "b"), ["b", "lot"], most).withColumnRenamed("tokens", "others")
    return left.join(right, ["b", "lot"]).drop("lot")


def compared(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``common`` and ``union``, the sizes of the sets' intersection and union."""
    common = F.size(F.array_intersect("tokens", "others"))
    return _with_sets(docs, classes, pairs).select("a", "b", common.alias("common"), (F.size("tokens") + F.size("others") - common).alias("union"))


def _at_least(percent: int) -> F.Column:
    return F.lit(100) * F.col("common") >= F.lit(percent) * F.col("union")


def _long_enough(n: str, m: str, percent: int) -> F.Column:
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def _hub_pairs(tokens: DataFrame, percent: int, turn: int) -> DataFrame:
    """For every class the hub (of another component) it shares most tokens with.

    A list's hub is its class with the fewest tokens of its own, as the original of a group of altered copies has; on later
    turns it is one drawn by hash. One row per token and class comes up, never a pair within a list.
    """
    rank = F.col("alone") if turn == 0 else F.xxhash64("cls", F.lit(turn))
    hub = F.min(F.struct(rank.alias("rank"), "cls", "root", "n")).alias("hub")
    lists = tokens.groupBy("token").agg(hub, F.min("root").alias("first"), F.max("root").alias("last")).where("first < last")
    lists = lists.select("token", F.col("hub.cls").alias("b"), F.col("hub.root").alias("broot"), F.col("hub.n").alias("m"))
    met = tokens.join(lists, "token").where((F.col("root") != F.col("broot")) & _long_enough("n", "m", percent))
    counted = met.groupBy(F.col("cls").alias("a"), "b").agg(F.count("*").alias("shared"))
    return counted.groupBy("a").agg(F.max(F.struct("shared", (-F.col("b")).alias("b"))).alias("x")).select("a", (-F.col("x.b")).alias("b"))


def _across(tokens: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of two components and two families (``fam``, null for none) that share as many prefix tokens as a similar pair must.

    Of a pair the smaller set (of equal ones that with more tokens of its own) needs the shorter prefix only, since a larger
    partner must share more of it. Where a shared token stands bounds what the pair can have in common; a pair that one of its tokens rules out is not similar.
    """
    tokens = tokens.withColumn("fam", F.coalesce("fam", -F.col("cls") - 1))
    sizes = tokens.groupBy("token", "fam").agg(F.count("*").alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    lists = sizes.groupBy("token").agg(F.max(F.struct("c", "fam")).alias("x"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("fams"))
    lists = lists.where("lo < hi AND fams > 1").select("token", F.col("x.fam").alias("largest"))
    own = Window.partitionBy("cls")
    met = written(tokens.join(lists, "token").withColumn("seen", F.row_number().over(own.orderBy("pos")) - 1), scratch_path(tokens.sparkSession, "lists"))
    met = met.withColumns({"role": F.struct("n", (-F.col("alone")).alias("alone"), "cls"), "inner": F.col("fam") == F.col("largest")})
    # Classes of the largest family stand on the right of side 0, all others on that of side 1: two of the largest family never meet.
    sides = F.when(F.col("inner"), F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))
    left = met.where("pos < short").withColumn("side", F.explode(sides)).selectExpr(
        "token", "side", "cls AS a", "root AS aroot", "fam AS afam", "n AS an", "k AS ak", "role AS arole", "pos AS apos", "seen AS aseen"
    )
    right = met.selectExpr("token", "IF(inner, 0, 1) AS side", "cls AS b", "root", "fam", "n", "k", "role", "pos", "seen")
    common = F.expr(f"({percent} * (an + n) + {99 + percent}) div {100 + percent}")
    # Before this token the two share at most what each has in lists, after it at most the shorter rest.
    possible = F.least("aseen", "seen") + F.least(F.col("an") - F.col("apos"), F.col("n") - F.col("pos"))
    apart = (F.col("aroot") != F.col("root")) & (F.col("afam") != F.col("fam")) & (F.col("arole") < F.col("role"))
    near = left.alias("l").join(right.alias("r"), ["token", "side"]).where(apart & _long_enough("an", "n", percent) & (possible >= common))
    shared = near.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first(F.least("ak", "k")).alias("asked"))
    return shared.where("shared >= asked").select("a", "b")


def _within(docs: DataFrame, classes: DataFrame, families: DataFrame, roots: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of classes of one family and two components: links known without a look, and the pairs that share as many alterations as a similar pair must.

    The centre H holds the tokens of more than half of a family's classes. With losses and additions L and A, a pair has |H| - |La| - |Lb| and
    its common losses and additions in common. ``need`` of a class is its half of what that falls short of, times ``unit``; of a pair the sum. A pair
    that needs nothing is similar; so are then both to the family's class of least need, and linking these two suffices.
    """
    spark, unit = docs.sparkSession, 2 * (100 + percent)
    placed = families.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    open_ = placed.groupBy("fam").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members")).where("lo < hi").select("fam", "members")
    placed = written(placed.join(open_, "fam"), scratch_path(spark, "open"))
    dealt, copies = _in_lots(placed, "cls", "fam")
    sets = _sets(docs, dealt.join(classes.select("cls", "doc_id", "ka", "kb"), "cls"), ["cls", "fam", "lot"], placed.count())
    counts = sets.select("fam", F.explode("tokens").alias("token")).groupBy("fam", "token").agg(F.count("*").alias("n"))
    centres = counts.join(open_, "fam").where(F.col("n") * 2 > F.col("members")).groupBy("fam").agg(F.collect_list("token").alias("others"))
    # A family that drifts from text to text may have no token in most of its classes: its centre is empty, all tokens are additions.
    centres = copies.join(centres, "fam", "left").withColumn("others", F.coalesce("others", F.array().cast("array<long>")))
    centres = written(centres, scratch_path(spark, "centres"))
    lost, added = F.array_except("others", "tokens"), F.array_except("tokens", "others")
    sets = sets.join(centres, ["fam", "lot"]).select("cls", lost.alias("lost"), added.alias("added"), F.size("tokens").alias("n"), F.size("others").alias("h"))
    need = 2 * percent * F.col("n") + unit * F.size("lost") - (100 + percent) * F.col("h")
    altered = written(sets.withColumn("need", need.cast("long")).join(placed, "cls"), scratch_path(spark, "altered"))

    sizes = altered.groupBy("fam", "root").agg(F.count("*").alias("c"), F.min("need").alias("need"), F.min(F.struct("need", "cls")).alias("first"))
    home = sizes.groupBy("fam").agg(F.max(F.struct("c", "root")).alias("x"), F.min("first").alias("first"))
    home = home.select("fam", F.col("x.root").alias("home"), F.col("first.need").alias("least"), F.col("first.cls").alias("nearest"))
    outer = F.min(F.when(F.col("root") != F.col("home"), F.col("need"))).alias("outer_least")
    least = written(home.join(sizes.join(home, "fam").groupBy("fam").agg(outer), "fam"), scratch_path(spark, "least"))
    links = altered.join(least, "fam").where((F.col("need") + F.col("least") <= 0) & (F.col("cls") != F.col("nearest"))).select(F.col("cls").alias("a"), F.col("nearest").alias("b"))
    size = F.size("lost") + F.size("added")
    marks = F.concat(F.transform("lost", lambda t: F.xxhash64("fam", F.lit(0), t)), F.transform("added", lambda t: F.xxhash64("fam", F.lit(1), t)))
    marked = altered.select("cls", "fam", "root", "need", size.alias("size"), F.explode(marks).alias("mark"))
    many = marked.groupBy("mark").agg(F.count("*").alias("many")).where("many > 1")
    marked = marked.join(many, "mark")
    own = Window.partitionBy("cls")
    alone = F.col("size") - F.count("*").over(own)
    marked = marked.withColumn("pos", alone + F.row_number().over(own.orderBy("many", "mark")) - 1).join(least, "fam")

    def side(other: str) -> DataFrame:
        """The first marks of every class, as many as the least need of a partner asks for and ``k`` of the lowest estimated cost allows.

        A class whose shortest prefix holds marks of its own only has no partner.
        """
        first, asked = F.min("pos").over(own), F.greatest(F.lit(1), F.ceil((F.col("need") + F.col(other)) / unit))
        rows = marked.withColumns({"first": first, "read": F.sum("many").over(own.orderBy("pos")), "asked": asked}).withColumn("base", F.col("size") - F.col("asked"))
        k = F.col("pos") - F.col("base") + 1
        cost = F.when((k >= 1) & (k <= F.least(F.lit(MOST_ALTERED), "asked")), F.struct((F.col("read") * (1 + LOOK / k)).alias("cost"), k.alias("k")))
        return rows.where("base >= first").withColumn("k", F.min(cost).over(own)["k"]).where(F.col("pos") < F.col("base") + F.col("k"))

    marked = written(marked, scratch_path(spark, "marks"))
    left = side("outer_least").selectExpr("mark", "cls AS a", "root AS aroot", "k AS ak")
    right = side("least").where("root <> home").selectExpr("mark", "cls AS b", "root", "k")
    met = left.join(right, "mark").where("aroot <> root").groupBy("a", "b").agg(F.count("*").alias("shared"), F.first(F.least("ak", "k")).alias("asked"))
    return links, met.where("shared >= asked").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_classes(docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id reachable by links).

    Null and empty texts have an empty set, are linked with nothing and keep their own id. A null doc_id takes part; it is
    never the name of a component that has another. Repeated rows are equal sets, so one component. Further columns of
    ``docs`` are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = written(_prefixes(docs).withColumn("row", F.monotonically_increasing_id()), scratch_path(spark, "prefixes"))
    classes = written(
        rows.where("n > 0").groupBy("ka", "kb", "n").agg(F.min("row").alias("cls"), F.min("doc_id").alias("doc_id")), scratch_path(spark, "classes")
    )
    first = classes.select(F.col("cls").alias("row"))
    first = F.broadcast(first) if classes.count() <= BROADCAST_ROWS else first
    sets = rows.join(first, "row", "left_semi").withColumnRenamed("row", "cls")
    tokens = sets.select(F.posexplode("prefix").alias("pos", "token"), "cls")
    lists = tokens.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi").select("token")
    tokens = written(tokens.join(lists, "token"), scratch_path(spark, "tokens"))
    alone = tokens.groupBy("cls").agg(F.count("*").alias("met"))
    own = sets.select("cls", "n", "k", "short", F.size("prefix").alias("p")).join(alone, "cls").selectExpr("cls", "n", "k", "short", "p - met AS alone")
    tokens = written(tokens.join(own, "cls").withColumn("root", F.col("cls")), scratch_path(spark, "tokens"))

    found, left, roots = None, tokens, None
    for turn in range(HUB_TURNS):
        pairs = written(_hub_pairs(left, percent, turn), scratch_path(spark, "pairs"))
        new = written(compared(docs, classes, pairs).where(_at_least(min(NEAR, percent))), scratch_path(spark, "compared"))
        found = new if found is None else found.unionByName(new)
        links = found.where(_at_least(percent)).select("a", "b")
        n_found = new.where(_at_least(percent)).count()
        if n_found or roots is None:
            roots = components(links)
            left = tokens.drop("root").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        if n_found <= WORTH * pairs.count():
            break
    families = written(components(found.select("a", "b")).withColumnsRenamed({"node": "cls", "root": "fam"}), scratch_path(spark, "families"))
    near, pairs = _within(docs, classes, families, roots, percent)
    fams = families.select("cls", "fam")
    pairs = written(pairs.unionByName(_across(left.join(fams, "cls", "left"), percent)).distinct(), scratch_path(spark, "pairs"))
    more = compared(docs, classes, pairs).where(_at_least(percent)).select("a", "b")
    roots = components(links.unionByName(near).unionByName(more))

    named = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select("ka", "kb", "n", "component_id")
    out = rows.select("doc_id", "ka", "kb", "n").join(named, ["ka", "kb", "n"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (the first stored, where ids are null or not unique)."""
    docs, restored = clear(docs, "id")
    docs = numbered(docs)
    found = jaccard_classes(docs.select(F.col("id").alias("doc_id"), "text"), percent)
    gone = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("id")), scratch_path(docs.sparkSession, "gone"))
    few = gone.count() <= BROADCAST_ROWS
    return restored(docs.join(F.broadcast(gone) if few else gone, "id", "left_anti"))
