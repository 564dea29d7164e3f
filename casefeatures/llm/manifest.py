"""A Merkle manifest of a data set: postorder append logs, written by aligned builders, and proofs read from them by address.

A tree has eight children a node; a level's last run may be shorter, even a single node. Nodes are logged when they are complete, that
is in postorder, and a node's place in the log follows from the sizes of the subtrees before it (``address``), without a look at the log.
A builder takes an aligned block of 8^4 leaves and writes the block's nodes in completion order as one page of the log; the roots of a tree's
blocks are the leaves of the next round of builders, until one node is left. All blocks of a round are built independently, so the size
of a tree only sets the number of blocks and, by its logarithm, of rounds. Proofs go down again: a page knows, by address, the siblings of all its
leaves, and has those above it from the page of the round before.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefeatures.llm.order import placed
from casefeatures.sources.files import scratch_path, written

FAN = 8
#: Levels that a builder raises its block by, and the leaves of a block.
LEVELS = 4
BLOCK = FAN**LEVELS
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PAGES = "tree string, block long, n long, entries array<struct<place: long, digest: string, id: long, other: string>>, nodes array<string>, top string"
_PATHS = "tree string, block long, before array<string>, after array<string>, subroot string, root string"
_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def hashed(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as a part of a leaf: its bytes' number, a colon and the value; null is a hyphen."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    h = 0
    while FAN**h < n:
        h += 1
    return h


def address(n: int, level: int, index: int, top: int) -> int:
    """Postorder place of a node in the log of n leaves under ``top`` levels: how many nodes are complete before it is.

    Up to its own level these are all nodes over the leaves up to its last one, above it those over leaves before its first one.
    """
    end = min((index + 1) * FAN**level, n)
    upto = sum(-(-end // FAN**m) for m in range(level + 1))
    return upto + sum(index * FAN**level // FAN**m for m in range(level + 1, top + 1)) - 1


def appended(leaves: list[str], top: int) -> list[str]:
    """The log of a block: leaves in order, every other node as soon as its run is full, unfilled runs at the end."""
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(top + 1)]

    def add(level: int, digest: str) -> None:
        log.append(digest)
        runs[level].append(digest)
        if level < top and len(runs[level]) == FAN:
            close(level)

    def close(level: int) -> None:
        run = runs[level]
        runs[level] = []
        add(level + 1, hashed(*run))

    for x in leaves:
        add(0, x)
    for level in range(top):
        if runs[level]:
            close(level)
    return log


def _levels(n: int) -> int:
    """Levels in the page of a tree (or of its round) of n leaves."""
    return height(n) if n <= BLOCK else LEVELS


def paths(nodes: list[str], leaves: int, top: int) -> Iterator[tuple[list[str], list[str]]]:
    """Of each leaf of a page, level by level, its siblings before and after it, each run as one string, read by address."""
    sides = []
    for level in range(top):
        many = -(-leaves // FAN**level)
        row = [nodes[address(leaves, level, i, top)] for i in range(many)]
        sides.append([("".join(row[i - i % FAN : i]), "".join(row[i + 1 : i - i % FAN + FAN])) for i in range(many)])
    for i in range(leaves):
        here = [sides[level][i // FAN**level] for level in range(top)]
        yield [b for b, _ in here], [a for _, a in here]


def pages(leaves: DataFrame) -> DataFrame:
    """The log pages of one round: ``leaves`` has ``tree``, ``place``, ``n``, ``digest``, ``id``, ``other``. One row per aligned block."""
    entry = F.struct("place", "digest", "id", "other")
    blocks = leaves.groupBy("tree", F.expr(f"place div {BLOCK}").alias("block")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(entry)).alias("entries"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = [appended(d, _levels(n)) for d, n in zip(_digests(batch["entries"]), batch["n"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.list_(pa.string())), pa.array([x[-1] for x in logs], pa.string())], [*batch.schema.names, "nodes", "top"])

    return written(blocks.mapInArrow(build, _PAGES), scratch_path(leaves.sparkSession, "pages"))


def _digests(entries: pa.Array) -> Iterator[list[str]]:
    at, digests = entries.offsets.to_pylist(), entries.values.field("digest")
    for s, e in zip(at, at[1:], strict=False):
        yield digests[s:e].to_pylist()


def rounds(leaves: DataFrame) -> list[DataFrame]:
    """Pages of all rounds, the first over the leaves themselves. As many as the logarithm of the largest tree to the base of a block."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    out = [pages(leaves)]
    while most > BLOCK:
        most = -(-most // BLOCK)
        nones = [F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("other")]
        tops = out[-1].where(F.col("n") > BLOCK).select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("digest"), *nones)
        out.append(pages(tops))
    return out


def subroots(made: list[DataFrame]) -> DataFrame:
    """``tree``, ``subroot``."""
    out = None
    for round_ in made:
        part = round_.where(F.col("n") <= BLOCK).select("tree", F.col("top").alias("subroot"))
        out = part if out is None else out.unionByName(part)
    return out


def append_log(made: list[DataFrame]) -> DataFrame:
    """The whole log: ``tree``, ``position`` (postorder, from 0), ``level``, ``digest``; a tree's last position is its subroot's.

    The roots of a round's blocks are logged by the builders of that round, not again as leaves of the next.
    """

    def spread(r: int, leaves_of: str):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for tree, block, n, total, entries, nodes in zip(*(batch[c].to_pylist() for c in ("tree", "block", "n", leaves_of, "many", "nodes")), strict=True):
                    top, whole = _levels(n), height(total)
                    for level in range(1 if r else 0, top + 1):
                        for i in range(-(-entries // FAN**level)):
                            up = level + r * LEVELS
                            rows.append((tree, address(total, up, block * FAN ** (LEVELS - level) + i, whole), up, nodes[address(entries, level, i, top)]))
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], t) for j, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.string()))], ["tree", "position", "level", "digest"])

        return work

    totals = made[0].groupBy("tree").agg(F.max("n").alias("total")).withColumnRenamed("tree", "_tree")
    out = None
    for r, round_ in enumerate(made):
        part = round_.withColumn("many", F.size("entries").cast("long")).drop("entries")
        part = part.join(totals, F.col("tree").eqNullSafe(F.col("_tree"))).select("tree", "block", "n", "total", "many", "nodes")
        part = part.mapInArrow(spread(r, "total"), "tree string, position long, level int, digest string")
        out = part if out is None else out.unionByName(part)
    return out


def _with_paths(round_: DataFrame, above: DataFrame) -> DataFrame:
    """Pages joined with the way up from their root; ``above`` has the columns of _PATHS."""
    above = above.withColumnsRenamed({"tree": "_tree", "block": "_block"})
    return round_.join(above, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))).drop("_tree", "_block")


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str], list[str]]]:
    """Row, entry, and the siblings before and after on the whole way up, for all entries of a batch's pages."""
    names = ("n", "nodes", "before", "after")
    for row, (n, nodes, before, after, digests) in enumerate(zip(*(batch[c].to_pylist() for c in names), _digests(batch["entries"]), strict=True)):
        for i, (b, a) in enumerate(paths(nodes, len(digests), _levels(n))):
            yield row, i, b + before, a + after


def _below(round_: DataFrame, above: DataFrame) -> DataFrame:
    """The way up from each leaf of a round that is the root of a block below."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, subroot, root, entries = (batch[c].to_pylist() for c in ("tree", "subroot", "root", "entries"))
            rows = [(tree[r], entries[r][i]["place"], b, a, subroot[r], root[r]) for r, i, b, a in _each(batch)]
            kinds = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], t) for j, t in enumerate(kinds)], [x.split()[0] for x in _PATHS.split(", ")])

    return _with_paths(round_, above).mapInArrow(work, _PATHS)


def proved(leaves: DataFrame) -> DataFrame:
    """Per leaf: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``leaves`` has ``tree``, ``doc_id``, ``digest`` and ``other``: the digest that the leaf has now, null if unchanged. A tree's leaves ascend by
    doc_id (nulls first), then by digest; equal rows are equal leaves. Trees ascend by name, null first. The proof is the siblings on the way up, left to
    right, level by level; ``folded_root`` is what it gives with the leaf as it is now. No leaves give no rows.
    """
    spark = leaves.sparkSession
    leaves = written(leaves, scratch_path(spark, "leaves"))  # small; texts are hashed once, not again for the cut points of the order
    ordered = placed(leaves, ["tree"], ["doc_id", "digest"]).withColumnRenamed("doc_id", "id")
    made = rounds(ordered)
    tops = placed(subroots(made), [], ["tree"])
    crown = rounds(tops.select(F.lit(None).cast("string").alias("tree"), "place", "n", F.col("subroot").alias("digest"), F.col("place").alias("id"), F.lit(None).cast("string").alias("other")))
    none = F.array().cast("array<string>")
    last = crown[-1].select("tree", "block", none.alias("before"), none.alias("after"), F.lit(None).cast("string").alias("subroot"), F.col("top").alias("root"))
    for round_ in reversed(crown):
        last = _below(round_, last)
    ways = tops.withColumnRenamed("tree", "_tree").join(last.withColumnRenamed("block", "place").drop("subroot"), "place")
    ways = written(ways.select(F.col("_tree").alias("tree"), F.lit(0).cast("long").alias("block"), "before", "after", "subroot", "root"), scratch_path(spark, "ways"))
    above = None
    for r in range(len(made) - 1, -1, -1):
        # A tree that is finished in this round begins here; the others come from the round above.
        ended = made[r].where(F.col("n") <= BLOCK).select(F.col("tree").alias("_t"))
        start = ways.join(ended, F.col("tree").eqNullSafe(F.col("_t"))).drop("_t")
        here = start if above is None else start.unionByName(above)
        if r:
            above = written(_below(made[r], here), scratch_path(spark, "ways"))
        else:
            return _with_paths(made[0], here).mapInArrow(_prove, _PROOFS)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        entries, subroot, root, rows = batch["entries"].to_pylist(), batch["subroot"].to_pylist(), batch["root"].to_pylist(), []
        for r, i, before, after in _each(batch):
            e = entries[r][i]
            folded = e["other"] or e["digest"]
            for b, a in zip(before, after, strict=True):
                folded = hashed(b, folded, a)
            proof = hashed(*(x for pair in zip(before, after, strict=True) for x in pair))
            rows.append((e["id"], e["digest"], subroot[r], root[r], proof, folded, folded == root[r]))
        kinds = (pa.int64(), *[pa.string()] * 5, pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], t) for j, t in enumerate(kinds)], [x.split()[0] for x in _PROOFS.split(", ")])


def document_leaves(docs: DataFrame) -> DataFrame:
    """``tree`` (lang), ``doc_id``, ``digest`` and ``other`` of documents, of which those whose id's crc32 is divisible by 3 have their A-Z lower-cased now.

    Null values are leaves' hyphens; a document without an id is unchanged. Further columns are not read.
    """
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    low = F.translate("text", _UPPER, _UPPER.lower())
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(
        F.col("lang").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(*values, F.col("text")).alias("digest"),
        F.when(tampered & (low != F.col("text")), leaf(*values, low)).alias("other"),
    )


def documents_proved(docs: DataFrame) -> DataFrame:
    return proved(document_leaves(docs))
