"""Fingerprints of texts by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases into longer ones, and so on up to one. Where a phrase ends is decided by deterministic coin
tossing: a symbol's label is the place and value of the lowest bit in which its name differs from its left neighbour's; three rounds of
this leave labels below 8, neighbours still unequal, and a phrase begins at every smallest label among neighbours. Runs of an equal symbol are one symbol first.
So a cut depends on a few symbols to its left and one to its right and nothing else: equal substrings are cut alike inside, wherever they stand,
and phrases of equal content have equal names (64-bit hashes), at every level.

A fingerprint keeps, for phrases of three sizes (level 2, level 3, and all above), the smallest name per bin of a fixed number of bins. Two
fingerprints agree in a bin about as often as the phrases of that size are shared. All work is done on whole arrays of bytes and names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefeatures.llm.frames import bounded_batches
from casefeatures.llm.words import PIECE, mix
from casefeatures.sources.files import scratch_path, written

#: Rounds of coin tossing: names of 64 bits give labels below 128, then 14, then 8.
TOSSES = 3
#: Sizes of phrases kept apart: level 2, level 3, level 4 and above; bins of each.
KINDS, BINS = 3, 32
_ODD, _FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_KIND = mix(np.arange(1, KINDS + 1, dtype=np.uint64) * _ODD)
#: A bin without a phrase.
NONE = 0xFFFF
_OUT = "piece int, kind int, doc_id long, n_chars long, text string, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _label(differ: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest set bit of ``differ``, and the bit of ``names`` at this place; no bit counts as the place after the last."""
    place = np.bitwise_count((differ & (~differ + differ.dtype.type(1))) - differ.dtype.type(1))
    bit = np.minimum(place, differ.dtype.itemsize * 8 - 1).astype(differ.dtype)
    return (2 * place + (names >> bit & differ.dtype.type(1)).astype(np.uint8)).astype(np.uint8)


_SMALL = np.arange(256, dtype=np.uint8)
#: The label of a label below 256, by its left neighbour and itself.
_AGAIN = _label(_SMALL[:, None] ^ _SMALL[None, :], np.broadcast_to(_SMALL, (256, 256))).ravel()


def tossed(names: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Labels after one toss. A text's first symbol has no left neighbour; its label is its own lowest bit."""
    if names.dtype == np.uint8:
        pair = names.astype(np.uint16)
        pair[1:] |= pair[:-1] << 8
        labels = _AGAIN[pair]
    else:
        differ = names.copy()
        differ[1:] ^= names[:-1]
        labels = _label(differ, names)
    labels[heads] = (names[heads] & names.dtype.type(1)).astype(np.uint8)
    return labels


def collapsed(names: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal names as one name that holds the run's length; heads are where texts begin."""
    first = np.ones(len(names), bool)
    first[1:] = names[1:] != names[:-1]
    first[heads] = True
    if first.all():
        return names, heads
    at = np.flatnonzero(first)
    lengths, out = np.diff(at, append=len(names)).astype(np.uint64), names[at]
    runs = lengths > 1
    out[runs] = mix(out[runs] + lengths[runs] * _FOLD)
    return out, np.searchsorted(at, heads)


def cuts(names: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where phrases begin: at heads, and at labels smaller than both neighbours'. A text's second and last symbols begin none."""
    labels = names
    for _ in range(TOSSES):
        labels = tossed(labels, heads)
    begins = np.zeros(len(names), bool)
    begins[1:-1] = (labels[1:-1] < labels[:-2]) & (labels[1:-1] <= labels[2:])
    after = heads + 1
    begins[after[after < len(names)]] = False
    begins[heads - 1] = False
    begins[heads] = True
    return np.flatnonzero(begins)


def phrases(names: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of all texts, and where texts begin among them."""
    names, heads = collapsed(names, heads)
    at = cuts(names, heads)
    ends = np.append(at[1:], len(names))
    made = names[at].copy()
    open_, left = np.arange(len(at)), ends - at
    for step in range(1, int(left.max())):
        open_ = open_[left[open_] > step]
        made[open_] = made[open_] * _FOLD + names[at[open_] + step]
    return mix(made + (ends - at).astype(np.uint64) * _ODD), np.searchsorted(at, heads)


def signatures(texts: list[bytes]) -> np.ndarray:
    """A row of KINDS * BINS 16-bit values per text. An empty text has no phrase; other texts' last phrase of all counts in the highest kind."""
    out = np.full((len(texts), KINDS * BINS), NONE, np.uint16)
    i = 0
    while i < len(texts):
        j, size = i + 1, len(texts[i])
        while j < len(texts) and size + len(texts[j]) <= PIECE:
            size += len(texts[j])
            j += 1
        _sign(texts[i:j], out[i:j])
        i = j
    return out


def _sign(texts: list[bytes], out: np.ndarray) -> None:
    lengths = np.array([len(t) for t in texts], np.int64)
    rows = np.flatnonzero(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    names, heads, level = data.astype(np.uint64) + np.uint64(1), (np.cumsum(lengths) - lengths)[rows], 0
    best = np.full((len(texts), KINDS * BINS), np.iinfo(np.uint64).max, np.uint64)
    while len(rows):
        names, heads = phrases(names, heads)
        level += 1
        many = np.diff(heads, append=len(names))
        last = many == 1
        if level > 1:
            _keep(best, np.repeat(rows, many), names, min(level - 2, KINDS - 1))
        if last.any():
            _keep(best, rows[last], names[heads[last]], KINDS - 1)
            names, rows = names[np.repeat(~last, many)], rows[~last]
            heads = np.cumsum(many[~last]) - many[~last]
    found = best != np.iinfo(np.uint64).max
    out[found] = np.minimum(best[found] & np.uint64(0xFFFF), NONE - 1)


def _keep(best: np.ndarray, rows: np.ndarray, names: np.ndarray, kind: int) -> None:
    drawn = mix(names + _KIND[kind])
    np.minimum.at(best.ravel(), rows * best.shape[1] + kind * BINS + (drawn >> np.uint64(16) & np.uint64(BINS - 1)).astype(np.int64), mix(drawn ^ _FOLD))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row the share of equal bins among those that hold a phrase in either, 1 for two without any: an estimate of the Jaccard
    similarity of the phrases, brought to the share of each text that the other holds (2 J / (1 + J))."""
    some = (a != NONE) | (b != NONE)
    equal = (some & (a == b)).sum(1)
    many = some.sum(1)
    return np.where(many == 0, 1.0, 2 * equal / np.maximum(many + equal, 1))


def packed(signature: np.ndarray) -> list[bytes]:
    """Fingerprints as bytes, two a bin."""
    return [row.tobytes() for row in signature.astype(">u2")]


def written_out(signature: np.ndarray) -> list[str]:
    """Fingerprints as hexadecimal text, four digits a bin."""
    return [x.hex() for x in packed(signature)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` of every row; a null text is empty. Equal texts have equal fingerprints. No rows give no rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(written_out(signatures(texts)), pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """A text whose last quarter is replaced by the beginning of another."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _compared(ids: list, texts: list[str], signed: np.ndarray, nexts: list[str], next_signed: np.ndarray) -> list[list]:
    """The result's columns for rows whose next rows are known."""
    changed = [edited(a, b).encode() for a, b in zip(texts, nexts, strict=True)]
    again = signatures(changed)
    return [ids, [len(t) for t in texts], [None] * len(ids), [sha256(x).digest() for x in changed], packed(signed), packed(again), likeness(signed, again).tolist(), likeness(signed, next_signed).tolist()]


_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * 3, pa.float64(), pa.float64())
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
#: Rows of the first pass: finished, the first of a piece, the last of a piece.
DONE, FIRST, LAST = 0, 1, 2


def _batch(piece: int, kind: int, columns: list[list]) -> pa.RecordBatch:
    n = len(columns[0])
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([[piece] * n, [kind] * n, *columns], _TYPES, strict=True)], _NAMES)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a piece, each with the next one; the first and the last text are passed on as well."""
    piece, held = TaskContext.get().partitionId(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        signed = signatures([t.encode() for t in texts])
        if held is None:
            yield _batch(piece, FIRST, [ids[:1], [len(texts[0])], texts[:1], [None], [None], [None], [None], [None]])
        else:
            ids, texts, signed = held[0] + ids, held[1] + texts, np.concatenate([held[2], signed])
        if len(ids) > 1:
            yield _batch(piece, DONE, _compared(ids[:-1], texts[:-1], signed[:-1], texts[1:], signed[1:]))
        held = ids[-1:], texts[-1:], signed[-1:]
    if held is not None:
        yield _batch(piece, LAST, [held[0], [len(held[1][0])], held[1], [None], [None], [None], [None], [None]])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, nexts = ([t or "" for t in batch.column(i).to_pylist()] for i in (1, 2))
        signed, next_signed = (signatures([t.encode() for t in x]) for x in (texts, nexts))
        yield _batch(0, DONE, _compared(batch.column(0).to_pylist(), texts, signed, nexts, next_signed))


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The next row is that of the next doc_id (nulls first, rows of one doc_id in the order of a hash of their texts and the texts), after the last the first; a single row is
    its own next. A null text is empty; no rows give no rows; further columns are not read.

    Texts are shuffled once, into range pieces in which every row but the last meets its next one. Each piece passes on its first and its last
    text; the last ones meet the first ones of the next pieces, as many rows as there are pieces.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    made = written(rows.mapInArrow(_pairs, _OUT), scratch_path(spark, "paired"))
    pieces = sorted(r["piece"] for r in made.where(F.col("kind") == LAST).select("piece").collect())
    result = ["doc_id", "n_chars", *[F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")], "near_edited", "near_next"]
    done = made.where(F.col("kind") == DONE).select(*result)
    if not pieces:
        return done
    following = spark.createDataFrame(list(zip(pieces, pieces[1:] + pieces[:1], strict=True)), "piece int, next int")
    first = made.where(F.col("kind") == FIRST).select(F.col("piece").alias("next"), F.col("text").alias("next_text"))
    last = made.where(F.col("kind") == LAST).select("piece", "doc_id", "text")
    ends = last.join(F.broadcast(following), "piece").join(first, "next").select("doc_id", "text", "next_text")
    return done.unionByName(ends.mapInArrow(_ends, _OUT).select(*result))
