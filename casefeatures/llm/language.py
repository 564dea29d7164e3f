"""Language of texts by bit-sliced Bloom filters of letter n-grams.

Each language's most frequent n-grams (two and three characters around every letter) go into a Bloom filter, and the filters of all
languages lie bit by bit beside each other: a slot is a bitmask of languages. The AND of an n-gram's slots is the set of all languages that
hold it. A text's score for a language is its count of n-grams with that bit, less the false positives its filter's fill predicts, over
what a text of the language is expected to have.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casefeatures.llm.frames import bounded_batches, clear, with_fields
from casefeatures.llm.words import mix
from casefeatures.sources.files import scratch_path, written

#: Documents per language that are learned from, about; n-grams of a filter; slots and probes.
SAMPLE, GRAMS, SLOTS, PROBES = 4000, 2000, 1 << 17, 3
#: Languages whose shares are broadcast; more are joined by a shuffle. Every language adds GRAMS n-grams and a bit a slot to what tasks hold.
BROADCAST_LANGUAGES = 4096
#: Characters taken at a time.
PIECE = 1 << 19
UNKNOWN = "und"


class Filters(NamedTuple):
    """``slots``: masks of 64 languages a word, (SLOTS, words); per language its false positive rate and expected share."""

    languages: list[str]
    slots: np.ndarray
    false: np.ndarray
    expected: np.ndarray


def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.array([0 if 0xD800 <= i < 0xE000 else chr(i).isalpha() for i in range(0x110000)], bool)


def _grams(text: str, letters: np.ndarray) -> Iterator[np.ndarray]:
    """The n-grams of a text, some at a time: for every letter it with both neighbours, and it with the next; what is no letter counts as 0."""
    text = text.lower()
    for p in range(0, len(text), PIECE):
        part = text[max(0, p - 1) : p + PIECE + 1]
        code = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        code = np.where(letters[np.minimum(code, 0x10FFFF)], code, 0)
        code = np.concatenate(([0] if p == 0 else [], code, [0] if p + PIECE >= len(text) else [])).astype(np.uint64)
        here = np.flatnonzero(code[1:-1]) + 1
        if len(here):
            three = (code[here - 1] << np.uint64(42)) | (code[here] << np.uint64(21)) | code[here + 1]
            two = (np.uint64(1) << np.uint64(63)) | (code[here] << np.uint64(21)) | code[here + 1]
            yield np.concatenate((three, two))


def _probes(grams: np.ndarray, slots: int, probes: int) -> list[np.ndarray]:
    h = mix(grams.copy())
    return [((h >> np.uint64(20 * i)) & np.uint64(slots - 1)).astype(np.int64) for i in range(probes)]


def learned(docs: DataFrame, sample: int = SAMPLE, n_grams: int = GRAMS, slots: int = SLOTS, probes: int = PROBES) -> Filters:
    """Filters from ``text`` and non-null ``lang``. Of a language with more than ``sample`` documents a share drawn by hash is read."""
    spark = docs.sparkSession
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("n")), scratch_path(spark, "languages"))
    many = counts.count()
    if not many:
        return Filters([], np.zeros((slots, 1), np.uint64), np.zeros(0), np.ones(0))
    parts = counts.select("lang", F.least(F.lit(1.0), sample / F.col("n")).alias("share"))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.col("share") * 1_000_000
    rows = rows.join(F.broadcast(parts) if many <= BROADCAST_LANGUAGES else parts, "lang").where(drawn)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()

        def flush(lang: str, held: list[np.ndarray]) -> pa.RecordBatch:
            gram, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            size: dict[str, int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for g in _grams(text, letters):
                    held.setdefault(lang, []).append(g)
                    size[lang] = size.get(lang, 0) + len(g)
                    if size[lang] > 4 * PIECE:
                        yield flush(lang, held.pop(lang))
                        size[lang] = 0
            for lang, found in held.items():
                yield flush(lang, found)

    found = rows.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("lang")
    best = found.withColumns({"all": F.sum("n").over(whole), "place": F.row_number().over(whole.orderBy(F.desc("n"), "gram"))})
    best = best.where(F.col("place") <= n_grams).toPandas()
    languages = sorted(set(best["lang"]))
    table = np.zeros((slots, -(-len(languages) // 64) or 1), np.uint64)
    false, expected = np.zeros(len(languages)), np.ones(len(languages))
    for i, (_, own) in enumerate(best.groupby("lang", sort=True)):
        bit = np.uint64(1) << np.uint64(i % 64)
        for p in _probes(own["gram"].to_numpy(np.int64).view(np.uint64), slots, probes):
            table[p, i // 64] |= bit
        false[i] = ((table[:, i // 64] & bit) != 0).mean() ** probes
        expected[i] = own["n"].sum() / own["all"].iloc[0]
    return Filters(languages, table, false, expected)


def identified(docs: DataFrame, filters: Filters, probes: int = PROBES) -> DataFrame:
    """Every row and column of ``docs`` with ``_lang`` and ``_score`` (0 to 1): the language whose share of the text's n-grams comes nearest to or
    most above what its own texts have, and that relation, 1 at most. Ties go to the first by code point. ``und`` and 0 for texts that are
    null or have no letter, and for all texts if no language was learned. Whole texts count, whatever their length."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        letters, n_lang = _letters(), len(f.languages)
        for batch in batches:
            names, scores = [], []
            for text in batch.column(at).to_pylist():
                n, bits = 0, np.zeros(n_lang)
                for g in _grams(text or "", letters) if n_lang else ():
                    first, *more = _probes(g, len(f.slots), probes)
                    masks = f.slots[first]
                    for p in more:
                        masks &= f.slots[p]
                    n += len(g)
                    for i in range(n_lang):
                        bits[i] += np.count_nonzero(masks[:, i // 64] & (np.uint64(1) << np.uint64(i % 64)))
                if not n:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                share = np.maximum(bits - n * f.false, 0) / (1 - f.false) / n / f.expected
                best = int(share.argmax())
                names.append(f.languages[best])
                scores.append(float(min(1.0, share[best])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "_lang", "_score"])

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(work, with_fields(docs, _lang="string", _score="double"))


def held_out(fold: int = 0, of: int = 5) -> F.Column:
    """Whether crc32 of the doc_id as text leaves this remainder; a null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == fold, F.lit(True))


def predicted(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row, learned from the rows that are not held out.

    Rows of null doc_id are held out; repeated rows count as often as they stand; no rows give no rows. Further columns are not read.
    """
    filters = learned(docs.where(~held_out()))
    found = identified(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out().alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def kept(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """``docs`` without texts of no learned language: those without a letter, and those whose score is below ``least``.

    Columns as given, whatever their names; repeated rows and rows of null doc_id are judged like others; no rows give no rows.
    """
    filters = learned(docs.where(~held_out()))
    docs, restored = clear(docs, "_lang", "_score")
    found = identified(docs, filters)
    return restored(found.where((F.col("_lang") != UNKNOWN) & (F.col("_score") >= least)))
