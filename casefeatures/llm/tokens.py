"""Token counts by a whole-token shortcut.

For a sentencepiece BPE model that leaves text as it is (no normalisation beyond spaces becoming a mark, one mark put in front), merges
never join a character with a mark that follows it, unless a vocabulary entry holds such a pair. So a text's tokens are those of its
pre-tokens: marks with what follows up to the next mark. ``proof`` checks these premises against the vocabulary and encodes every entry
once, offline: those that come out as one token count as one wherever they are a pre-token. Only other pre-tokens are merged, by the
library, each distinct one of a batch once. If the premises don't hold, whole texts are encoded.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
#: Counts of merged pre-tokens that a task remembers, and bytes of text split at a time.
REMEMBERED, PIECE = 500_000, 1 << 21
OVER = 4096


class Proof(NamedTuple):
    """Whether texts divide at marks, and the strings that encode alone as one token."""

    divides: bool
    whole: frozenset[str]
    lone: str  # characters that stand in no entry of more than one character


def proof(model: bytes) -> Proof:
    """Checked once per model, on the driver."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    entries = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    inner = any(MARK in x.lstrip(MARK) for x in entries)
    probe = "a  bé é ﬁ　x\t y\n z  가 Å  "
    plain = sp.normalize(probe) == MARK + probe.replace(" ", MARK)
    listed = any(sp.is_unused(i) for i in range(sp.get_piece_size()))
    if inner or listed or not plain:
        return Proof(False, frozenset(), "")
    whole = frozenset(x for x in entries if x.startswith(MARK) and len(sp.encode(x[1:].replace(MARK, " "))) == 1)
    joined = {c for x in entries if len(x) > 1 for c in x}
    lone = "".join(c for c in "\n\t\r" if c not in joined)
    return Proof(True, whole, lone)


def _counter(sp: sentencepiece.SentencePieceProcessor, known: Proof):
    """A function that counts the tokens of a text."""
    if not known.divides:
        return lambda text: len(sp.encode(text))
    # A pre-token begins with marks or with one lone character; neither joins with what stands before it.
    parts = re.compile(f"{MARK}+[^{MARK}{re.escape(known.lone)}]*|[{re.escape(known.lone)}][^{MARK}{re.escape(known.lone)}]*" if known.lone else f"{MARK}+[^{MARK}]*")
    whole, counts = known.whole, {}

    def merged(x: str) -> int:
        n = counts.get(x)
        if n is None:
            # The library puts a mark in front; where the pre-token has none, that mark is one token of its own.
            n = len(sp.encode(x[1:].replace(MARK, " "))) if x[0] == MARK else len(sp.encode(x)) - 1
            if x == MARK:
                n = 1
            if len(counts) >= REMEMBERED:
                counts.clear()
            counts[x] = n
        return n

    def count(text: str) -> int:
        if not text:
            return 0
        marked, total, at = MARK + text.replace(" ", MARK), 0, 0
        while at < len(marked):
            end = at + PIECE
            if end < len(marked):  # a piece ends before a mark that follows another character
                while end < len(marked) and not (marked[end] == MARK and marked[end - 1] != MARK):
                    end += 1
            seen = Counter(parts.findall(marked, at, end))
            total += sum(n if x in whole else n * merged(x) for x, n in seen.items())
            at = end
        return total

    return count


def token_counts(docs: DataFrame, model: bytes, over: int = OVER) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``over`` tokens) of every row.

    Tokens are those the library gives for the whole text, without begin and end. Null counts as empty: no bytes, no tokens. Repeated
    rows are counted each; further columns are not read. The model's bytes go to all tasks.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast((model, proof(model)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, known = shared.value
        count = _counter(sentencepiece.SentencePieceProcessor(model_proto=data), known)
        for batch in batches:
            n = [count(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    counted = docs.select("doc_id", "text", n_bytes).mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > over)
