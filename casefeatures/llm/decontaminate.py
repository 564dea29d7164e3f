"""Benchmark passages in texts: a broadcast hash set of the test items' word n-grams, scanned for in every text.

Words are the runs of letters, digits and non-ASCII characters of a text with A-Z in lower case. A window is ten consecutive
words of an item; an item of fewer words, but not none, is one window. The windows' hashes, of a bounded number at a time, go to
all tasks; every text's windows are looked up and each hit is compared word by word before it counts. Texts are never shuffled.
More windows than the bound are searched for in several passes over the texts, and the marked words are then joined by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.llm.frames import clear
from casefeatures.llm.words import MARKS, Words, windows, words
from casefeatures.sources.files import scratch_path, written

WINDOW = 10
#: Item words searched for in one pass, at most: about 100 bytes each in every task. One longer item is a pass of its own.
PASS_WORDS = 2_000_000
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))


class Windows(NamedTuple):
    """Windows of some items: per length in words the sorted hashes, and for each hash its (words, items)."""

    by_length: dict[int, tuple[np.ndarray, list[tuple[bytes, list[int]]]]]
    names: list[str]


def _text(w: Words, s: int, e: int) -> bytes:
    """Words s to e of a block, in lower case, one space between."""
    return b" ".join(w.data[w.starts[i] : w.ends[i]].tobytes() for i in range(s, e)).translate(_LOWER)


def item_windows(items: list[tuple[object, str | None]], size: int = WINDOW) -> Windows:
    """The windows of items given as (id, text). Items without words have none; ids are named as strings."""
    found: dict[int, dict[int, tuple[bytes, list[int]]]] = {}
    for w in words(pa.array([t for _, t in items], pa.large_string()), MARKS):
        for i in range(w.last - w.first):
            s, e = int(w.at[i]), int(w.at[i + 1])
            length = min(size, e - s)
            if not length:
                continue
            for j, h in enumerate(windows(w.hashes[s:e], length).tolist()):
                _, who = found.setdefault(length, {}).setdefault(h, (_text(w, s + j, s + j + length), []))
                if w.first + i not in who[-1:]:
                    who.append(w.first + i)
    return Windows(
        {n: (np.array(sorted(x), np.uint64), [x[h] for h in sorted(x)]) for n, x in found.items()}, [str(i) for i, _ in items]
    )


def _hits(w: Words, sought: Windows) -> Iterator[tuple[int, np.ndarray, set[int]]]:
    """Row in the block, mask of hit words, items, for rows with a verified hit."""
    rows: dict[int, tuple[np.ndarray, set[int]]] = {}
    for length, (hashes, what) in sought.by_length.items():
        here = windows(w.hashes, length)
        if not len(here):
            continue
        place = np.minimum(np.searchsorted(hashes, here), len(hashes) - 1)
        for s in np.flatnonzero(hashes[place] == here).tolist():
            row = int(np.searchsorted(w.at, s, "right")) - 1
            if s + length > w.at[row + 1]:
                continue  # runs over the text's end
            text, items = what[place[s]]
            if text != _text(w, s, s + length):
                continue
            if row not in rows:
                rows[row] = (np.zeros(int(w.at[row + 1] - w.at[row]), bool), set())
            rows[row][0][s - w.at[row] : s - w.at[row] + length] = True
            rows[row][1].update(items)
    for row, (mask, items) in rows.items():
        yield row, mask, items


def _passes(benchmark: DataFrame, limit: int) -> list[DataFrame]:
    """The items in lots of at most ``limit`` words, by the running sum of word counts per hash bucket."""
    sized = benchmark.select("item_id", "text").where("text IS NOT NULL")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lots = max(1, -(-total // (2 * limit)))  # a word has a separator, so two bytes at least
    if lots == 1:
        return [sized]
    lot = F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * lots))
    return [sized.where(lot == i) for i in range(2 * lots)]


def mark_windows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, limit: int = PASS_WORDS, without: tuple[str, ...] = ()) -> DataFrame:
    """All rows and columns of ``docs`` (but those of ``without``), and ``_words`` (long), ``_spans`` (array of first word, end and byte offsets of hit
    stretches), ``_items`` (sorted distinct names of the items with an occurring window).

    Null and empty texts have no words; a benchmark without words marks nothing; repeated items are one. Columns of these
    names must not be in ``docs``.
    """
    spark = docs.sparkSession
    spans = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("first", "end", "from_byte", "to_byte")]))
    added = T.StructType([T.StructField("_words", T.LongType()), T.StructField("_spans", spans), T.StructField("_items", T.ArrayType(T.StringType()))])
    at = docs.columns.index("text")
    lots = _passes(benchmark, limit)

    def scan(items: DataFrame):
        sought = spark.sparkContext.broadcast(item_windows([tuple(r) for r in items.collect()], size))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, found, names = [], [], []
                for w in words(batch.column(at), MARKS):
                    hit = {row: (mask, who) for row, mask, who in _hits(w, sought.value)}
                    n.extend(np.diff(w.at).tolist())
                    for row in range(w.last - w.first):
                        mask, who = hit.get(row, (None, ()))
                        names.append(sorted({sought.value.names[i] for i in who}))
                        if mask is None:
                            found.append([])
                            continue
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                        s, base = int(w.at[row]), int(w.heads[row])
                        found.append([(a, b, int(w.starts[s + a]) - base, int(w.ends[s + b - 1]) - base) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                extra = [pa.array(n, pa.int64()), pa.array(found, _SPANS), pa.array(names, pa.list_(pa.string()))]
                kept = [n for n in batch.schema.names if n not in without]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *extra], [*kept, "_words", "_spans", "_items"])

        return work

    schema = T.StructType([*(f for f in docs.schema.fields if f.name not in without), *added.fields])
    if len(lots) == 1:
        return docs.mapInArrow(scan(lots[0]), schema)
    # Each pass writes what it found; passes are put together by row of one written table.
    base = written(docs.withColumn("_row", F.monotonically_increasing_id()), scratch_path(spark, "rows"))
    parts = None
    for lot in lots:
        at, without = 1, ("text",)
        one = base.select("_row", "text").mapInArrow(scan(lot), T.StructType([base.schema["_row"], *added.fields])).where((F.size("_items") > 0) | F.lit(lot is lots[0]))
        one = written(one, scratch_path(spark, "pass"))
        parts = one if parts is None else parts.unionByName(one)
    merged = parts.groupBy("_row").agg(
        F.max("_words").alias("_words"), F.flatten(F.collect_list("_spans")).alias("_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items")
    )
    return base.join(merged.withColumn("_spans", _united("_spans")), "_row").drop("_row").select(*schema.names)


_SPANS = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "end", "from_byte", "to_byte")]))


def _united(column: str) -> F.Column:
    """Spans of several passes, in order, overlapping ones made one."""
    start = F.expr("cast(array() as array<struct<first:bigint,end:bigint,from_byte:bigint,to_byte:bigint>>)")

    def add(done: F.Column, x: F.Column) -> F.Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["first"].alias("first"), F.greatest(last["end"], x["end"]).alias("end"), last["from_byte"].alias("from_byte"), F.greatest(last["to_byte"], x["to_byte"]).alias("to_byte"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["first"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(column), start, add)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, limit: int = PASS_WORDS) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    marked = mark_windows(docs.select("doc_id", "text"), benchmark, size, limit, ("text",))
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return marked.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def removed(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, share: float | None = 0.0, limit: int = PASS_WORDS) -> DataFrame:
    """``docs`` without benchmark passages, columns as given.

    ``share``: texts of which more than this share of the words is hit go whole (0.0: every text that is hit goes); of the others, and
    of all with None, the hit stretches are cut out of the text. ``n_chars``, if there, follows the text.
    """
    given = docs.schema
    docs, restored = clear(docs, "_words", "_spans", "_items", "_row")
    marked = mark_windows(docs, benchmark, size, limit)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    if share is not None:
        marked = marked.where((hit == 0) | (hit <= F.lit(share) * F.col("_words")))
    if share != 0.0:
        marked = marked.withColumn("text", cut("text", "_spans"))
        if "n_chars" in given.names:
            marked = marked.withColumn("n_chars", F.length("text").cast(given["n_chars"].dataType))
    return restored(marked)


def cut(text: str, spans: str) -> F.Column:
    """A text without the byte stretches of its spans."""
    raw = F.col(text).cast("binary")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda x: x["to_byte"]))
    starts = F.concat(F.transform(spans, lambda x: x["from_byte"]), F.array(F.octet_length(text).cast("long")))
    kept = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda x: F.substring(raw, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")).cast("string"))
    return F.when(F.size(spans) > 0, F.array_join(kept, "")).otherwise(F.col(text))


def digest(names: list[str]) -> str:
    """What ``items_sha256`` holds for these items."""
    return sha256(",".join(sorted(names)).encode()).hexdigest()
