"""Repeated passages by a sparse suffix array over words.

Of every text only the suffixes at content-selected positions are kept: a suffix begins where the hash of its first ``HEAD`` words is the
smallest of ``LEAST - HEAD + 1`` neighbouring ones. So two equal passages of ``LEAST`` words keep the same suffixes, wherever they stand.
The kept suffixes are sorted by their first words, and neighbours that agree in them are a possible repeat. Only there texts are looked at
again: every passage of ``LEAST`` words around such a suffix, extended to the left and to the right of it, is compared with the others, which
gives exactly the passages that occur more than once. Overlapping ones are joined to maximal stretches.

A kept suffix and a passage are one row each; Spark sorts, joins and aggregates them. No group is gathered: counts combine early, and the
joins are plain ones whose skewed sides adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.llm.frames import bounded_batches, clear, numbered
from casefeatures.llm.words import SPACES, Words, windows, words
from casefeatures.sources.files import scratch_path, written

#: Words of a passage that counts as repeated, and words that sorted suffixes are compared by.
LEAST, HEAD = 50, 30
#: Stretches to cut out that are broadcast at most; more are joined by a shuffle.
BROADCAST_CUTS = 1_000_000
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _slide(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Minimum or maximum of ``width`` consecutive values, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def _minima(w: Words, least: int, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: head hashes x, and for every passage start its smallest head hash m (0 where no passage fits) and whether one fits."""
    n = len(w.hashes)
    x = np.full(n, _NONE)
    x[: max(0, n - head + 1)] = np.minimum(windows(w.hashes, head), _NONE - np.uint64(1))
    ends = np.repeat(w.at[1:], np.diff(w.at))
    place = np.arange(n)
    x[place + head > ends] = _NONE
    fits = place + least <= ends
    width = least - head + 1
    m = np.zeros(n, np.uint64)
    if n >= width:
        m[: n - width + 1] = _slide(x, width, np.minimum)
    m[~fits] = 0
    return x, m, fits


def _kept(x: np.ndarray, m: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the smallest of a passage."""
    padded = np.concatenate((np.zeros(width - 1, np.uint64), m))
    return np.flatnonzero((_slide(padded, width, np.maximum) == x) & (x != _NONE)) if len(x) else np.empty(0, np.int64)


def _suffixes(docs: DataFrame, least: int, head: int) -> DataFrame:
    """``h`` (hash of the first words), ``id``, ``pos`` of every kept suffix."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for w in words(batch.column(1), SPACES):
                x, m, _ = _minima(w, least, head)
                at = _kept(x, m, least - head + 1)
                row = np.searchsorted(w.at, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[at].view(np.int64)), pa.array(ids[w.first + row]), pa.array((at - w.at[row]).astype(np.int32))], ["h", "id", "pos"]
                )

    return docs.select("id", "text").mapInArrow(work, "h long, id long, pos int")


def _passages(docs: DataFrame, places: DataFrame, least: int, head: int) -> DataFrame:
    """``h`` (hash of the passage), ``id``, ``pos``, ``again`` (it stands earlier in the same text) of every passage whose suffix is shared."""
    joined = docs.select("id", "text").join(places, "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places = batch.column(0).to_numpy(), batch.column(2)
            for w in words(batch.column(1), SPACES):
                x, m, fits = _minima(w, least, head)
                shared = np.full(len(x), _NONE)
                for i in range(w.last - w.first):
                    at = places[w.first + i].values.to_numpy() + w.at[i]
                    shared[at] = x[at]
                width = least - head + 1
                if len(x) < width:
                    continue
                low = np.full(len(x), _NONE)
                low[: len(x) - width + 1] = _slide(shared, width, np.minimum)
                here = np.flatnonzero(fits & (low == m))
                if not len(here):
                    continue
                h = windows(w.hashes, least)[here]
                row = np.searchsorted(w.at, here, "right") - 1
                order = np.lexsort((here, h, row))
                again = np.zeros(len(here), bool)
                again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(ids[w.first + row]), pa.array((here - w.at[row]).astype(np.int32)), pa.array(again)], ["h", "id", "pos", "again"]
                )

    return joined.select("id", "text", "at").mapInArrow(work, "h long, id long, pos int, again boolean")


def _stretches(docs: DataFrame, least: int, head: int, *kinds: str) -> DataFrame:
    """``id``, ``original``, ``first_word``, ``n_words`` of every maximal stretch; with the kind ``own`` repeats of passages of the same text are apart."""
    spark = docs.sparkSession
    suffixes = written(_suffixes(docs, least, head), scratch_path(spark, "suffixes"))
    shared = suffixes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    places = suffixes.join(shared, "h", "left_semi").groupBy("id").agg(F.collect_list("pos").alias("at"))
    places = written(places, scratch_path(spark, "places"))
    passages = written(_passages(docs, places, least, head), scratch_path(spark, "passages"))
    groups = passages.groupBy("h").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    repeated = passages.join(groups.select("h", "first"), "h")
    repeated = repeated.select("id", "pos", ((F.col("id") == F.col("first")) & ~F.col("again")).alias("original"), ((F.col("id") == F.col("first")) & F.col("again")).alias("own"))
    kinds = ("id", "original", *kinds)
    run = Window.partitionBy(*kinds).orderBy("pos")
    apart = F.coalesce(F.col("pos") > F.lag("pos").over(run) + least, F.lit(True))
    runs = repeated.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    ends = runs.groupBy(*kinds, "run").agg(F.min("pos").alias("first_word"), F.max("pos").alias("last"))
    return ends.select(*kinds, "first_word", (F.col("last") - F.col("first_word") + least).alias("n_words"))


def repeated_passages(docs: DataFrame, least: int = LEAST, head: int = HEAD) -> DataFrame:
    """``doc_id``, ``first_word`` (from 0), ``n_words``, ``original`` of every maximal stretch of passages of ``least`` words that occur more than once.

    Words are runs of anything but white space, A-Z as a-z. A passage's occurrence is original if it stands first: in the smallest doc_id,
    and there at the first place (in the table's order where doc_id is null or not unique). Originals and repeats are stretches of their
    own. Texts of fewer words, empty and null ones have none; repeated rows repeat each other. Further columns are not read.
    """
    docs = numbered(docs.select("doc_id", "text"))
    found = _stretches(docs, least, head)
    names = docs.select("id", "doc_id")
    return found.join(names, "id").select("doc_id", "first_word", "n_words", "original")


def without_repeats(docs: DataFrame, least: int = LEAST, head: int = HEAD) -> DataFrame:
    """``docs``, columns as given, with every repeat cut out of its text; originals stay, also where a repeat of a passage of the same
    text overlaps them; words that repeat another text go. A text of which nothing but white space is left
    goes; one that had nothing else before stays as it is. ``n_chars``, if there, follows the text."""
    given = docs.schema
    bounded_batches(docs.sparkSession)
    docs, restored = clear(docs, "id", "cuts")
    docs = numbered(docs)
    found = _stretches(docs, least, head, "own").groupBy("id").agg(F.collect_list(F.struct("first_word", "n_words", "original", "own")).alias("cuts"))
    cuts = found.where(F.exists("cuts", lambda c: ~c["original"]))
    cuts = written(cuts, scratch_path(docs.sparkSession, "cuts"))
    total = cuts.agg(F.sum(F.size("cuts"))).first()[0] or 0
    joined = docs.join(F.broadcast(cuts) if total <= BROADCAST_CUTS else cuts, "id", "left")
    at = joined.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1)
            for i in np.flatnonzero(cuts.is_valid().to_numpy(zero_copy_only=False)).tolist():
                raw = texts[i].encode()
                w = next(words(batch.column(at).slice(i, 1), SPACES))
                cut = np.zeros(len(w.starts) + 1, np.int8)
                # Repeats of the same text, then its originals, then repeats of other texts.
                for c in sorted(cuts[i].as_py(), key=lambda c: 0 if c["own"] else 1 if c["original"] else 2):
                    cut[c["first_word"] : c["first_word"] + c["n_words"]] = not c["original"]
                bytes_kept, done = [], 0
                edges = np.flatnonzero(np.diff(cut, prepend=0))
                for first, after in zip(edges[::2], edges[1::2], strict=True):
                    bytes_kept.append(raw[done : int(w.starts[first])])
                    done = int(w.starts[after]) if after < len(w.starts) else len(raw)
                texts[i] = b"".join([*bytes_kept, raw[done:]]).decode()
            gone = pa.array([bool(c) and not t.strip() for c, t in zip(cuts.is_valid().to_pylist(), texts, strict=True)], pa.bool_())
            arrays = list(batch.columns[:-1])
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            out = pa.RecordBatch.from_arrays(arrays, batch.schema.names[:-1])
            yield out.filter(pa.compute.invert(gone))

    kept = joined.mapInArrow(work, T.StructType(joined.schema.fields[:-1])).drop("id")
    if "n_chars" in given.names:
        kept = kept.withColumn("n_chars", F.length("text").cast(given["n_chars"].dataType))
    return restored(kept)
