"""Reading and writing tables: parquet, part files of unequal type, CSV."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.functions.schema import FLOAT_TYPES, INTEGER_TYPES, quoted

_LOCAL_FOLDERS: dict[str, str] = {}
# Folders of the runs that are open, the innermost last.
_RUNS: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="casefeatures-")
    return _LOCAL_FOLDERS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no other call gets: in the folder of the run that is open (``scratch_run``), else in the shared folder."""
    return os.path.join(_RUNS[-1] if _RUNS else shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def scratch_run(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Scratch tables and checkpoints made inside go to a folder of the run, which is removed at the end, also after a failure.

    Write what is to stay before the run ends, to a path taken outside of it: what still reads the run's tables cannot be read any more.
    Runs nest; two at the same time, in threads of one driver, would share the folder of the later one.
    """
    context = spark.sparkContext
    folder, before = scratch_path(spark, name), context.getCheckpointDir()
    context.setCheckpointDir(folder)
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        context.setCheckpointDir(_RUNS[-1] if _RUNS else os.path.dirname(before) if before else shared_folder(spark))
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Fix a result in the shared folder: every later branch reads the same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header; the schema is given, so no pass is spent on guessing it."""
    return spark.read.csv(path, header=True, schema=schema)


def sink_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def shared_warehouse(spark: SparkSession) -> str:
    """The warehouse folder; on a cluster it must have been set, for the default is a folder of the driver's machine."""
    if not spark.sparkContext.master.startswith("local") and "spark.sql.warehouse.dir" not in dict(spark.sparkContext.getConf().getAll()):
        raise ValueError("set spark.sql.warehouse.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir")


def sink_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "error") -> None:
    """Store a roll-up bucketed and sorted by the case key, so that later joins on it need no shuffle."""
    shared_warehouse(df.sparkSession)
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "error") -> DataFrame:
    """Store a table bucketed by the key and read it back."""
    sink_bucketed(df, table, key, buckets, mode)
    return df.sparkSession.table(table)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: the plan behind it ends here."""
    sink_parquet(df, path)
    return scan_parquet(df.sparkSession, path)


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in (found or []))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both fit in: the wider number, else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    order = INTEGER_TYPES + FLOAT_TYPES
    numbers = (*order, T.DecimalType)
    if isinstance(a, T.BooleanType) and isinstance(b, numbers):
        return b
    if isinstance(b, T.BooleanType) and isinstance(a, numbers):
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        whole, scale = max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, numbers) or isinstance(b, T.DecimalType) and isinstance(a, numbers):
        return T.DoubleType()
    if isinstance(a, order) and isinstance(b, order):
        wide = max(a, b, key=lambda t: order.index(type(t)))
        mixed = isinstance(a, INTEGER_TYPES) != isinstance(b, INTEGER_TYPES)
        return T.DoubleType() if mixed else wide
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def part_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Paths grouped by the schema in their footers, which tasks read; the driver gets the groups, in the order of their first paths.

    A folder counts by its first data file, as Spark reads it. What a task cannot tell (a folder of folders, a file system
    it has no access to, a damaged file) is a group of its own, and left to Spark.
    """

    def mark_of(path):
        import hashlib
        from urllib.parse import unquote, urlparse

        import pyarrow.parquet as pq
        from pyarrow import fs

        try:
            url = urlparse(path)
            store, place = (fs.LocalFileSystem(), unquote(url.path) if url.scheme else path) if url.scheme in ("", "file") else fs.FileSystem.from_uri(path)
            if store.get_file_info(place).type == fs.FileType.Directory:
                inside = [i for i in store.get_file_info(fs.FileSelector(place)) if not i.base_name.startswith(("_", "."))]
                if not inside or any(i.type == fs.FileType.Directory for i in inside):
                    return None
                place = min(i.path for i in inside)
            with store.open_input_file(place) as file:
                schema = pq.read_schema(file)
        except Exception:  # noqa: BLE001 - Spark's own reader reports what is wrong with the part
            return None
        noted = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
        text = schema.remove_metadata().to_string(truncate_metadata=False, show_field_metadata=False)
        return hashlib.sha256(text.encode() + b"\0" + noted).hexdigest()

    def marks(batches):
        for batch in batches:
            yield batch.assign(mark=[mark_of(p) for p in batch["path"]])

    listed = spark.createDataFrame(list(enumerate(paths)), "place long, path string")
    seen = listed.mapInPandas(marks, "place long, path string, mark string")
    apart = F.coalesce("mark", F.concat(F.lit("part "), F.col("place")))
    groups = seen.groupBy(apart.alias("mark")).agg(F.sort_array(F.collect_list("place")).alias("places"))
    return [[paths[i] for i in places] for places in sorted(r["places"] for r in groups.collect())]


def scan_parts(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """All parts of a table stacked, each column in a type common to the parts.

    The footers are read in tasks by one job. Parts of one schema are then read by one scan, so jobs and plan grow with the
    number of different schemas and not with the number of parts. A part may be a file or a folder of files.
    """
    paths = expand(spark, paths) if isinstance(paths, str) else list(paths)
    if not paths:
        raise FileNotFoundError("no part matches")
    by_schema: dict[str, list[str]] = {}
    schemas: dict[str, T.StructType] = {}
    for group in part_groups(spark, paths) if len(paths) > 1 else [paths]:
        schema = spark.read.parquet(group[0]).schema
        schemas[schema.json()] = schema
        by_schema.setdefault(schema.json(), []).extend(group)
    wanted: dict[str, T.DataType] = {}
    for schema in schemas.values():
        for f in schema.fields:
            wanted[f.name] = common_type(wanted.get(f.name, f.dataType), f.dataType)
    out = None
    for key, group in by_schema.items():
        have = set(schemas[key].names)
        part = spark.read.schema(schemas[key]).parquet(*group).select(
            *[(quoted(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in wanted.items()]
        )
        out = part if out is None else out.unionByName(part)
    return out
