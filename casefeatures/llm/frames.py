"""Rows and column names of any table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.sources.files import scratch_path, written

#: Bytes of a batch that goes to Python, at most (a single longer row is a batch of its own).
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold BATCH_BYTES at most: a number of rows alone does not bound what long texts take."""
    if not 0 < int(spark.conf.get(_BATCH).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def with_fields(docs: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``docs`` and more columns, whatever its names are."""
    more = T.StructType(list(docs.schema.fields))
    for name, kind in kinds.items():
        more.add(name, kind)
    return more


def clear(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` without columns of these names or with a backtick in theirs (they get others), and what gives a result the columns of ``docs`` again."""
    columns, taken, back, out = docs.columns, {c.lower() for c in docs.columns}, {}, docs
    for c in columns:
        if c.lower() in {n.lower() for n in names} or "`" in c:  # mapInArrow takes no backtick in a name
            new = f"_{c.replace('`', '')}"
            while new.lower() in taken or new.lower() in {n.lower() for n in names}:
                new = f"_{new}"
            taken.add(new.lower())
            back[new] = c
            out = out.withColumnRenamed(c, new)
    now = {v: k for k, v in back.items()}
    return out, lambda df: df.select(*[F.col(f"`{now.get(c, c).replace('`', '``')}`").alias(c) for c in columns])


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``id``: doc_id where that names every row, else a number by place in a written copy. ``docs`` has no column id."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if ids.isEmpty():
        return docs.withColumn("id", F.col("doc_id").cast("long"))
    return written(docs.withColumn("id", F.monotonically_increasing_id()), scratch_path(docs.sparkSession, "numbered"))
