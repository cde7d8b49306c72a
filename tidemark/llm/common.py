"""What the text operators share: the word rule, stored intermediate tables, checked broadcasts, joins with hot keys."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

#: The characters that separate words.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

#: Bytes, as measured when it was stored, up to which a table is broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 24 << 20
#: The same for joins in which no texts would move: shuffling narrow rows costs less than many copies of a large table.
NARROW_BYTES = 1 << 20
#: A key with more than one in so many of all rows is hot; there can be no more such keys than this.
HOT_KEYS = 1000
#: Rows of an Arrow batch of texts: Spark's own 10,000 suit numbers, not texts.
TEXTS_PER_BATCH = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a folder of our own on one machine (tests); on a cluster that is an error,
    since executors would write to their own disks."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most TEXTS_PER_BATCH rows for what runs inside; the session's own setting comes back."""
    own = spark.conf.get(_BATCH)
    if not 0 < int(own) <= TEXTS_PER_BATCH:
        spark.conf.set(_BATCH, TEXTS_PER_BATCH)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, own)


@dataclass(frozen=True)
class Stored:
    path: str
    rows: int
    bytes: int
    found: dict = field(default_factory=dict)


def _width(schema: StructType) -> Column | None:
    """Bytes of a row beyond 8 for each column."""
    size = {StringType: lambda c: F.octet_length(c), BinaryType: lambda c: F.octet_length(c), ArrayType: lambda c: F.size(c) * 8}
    parts = [F.coalesce(size[type(f.dataType)](F.col(f"`{f.name}`")), F.lit(0)) for f in schema if type(f.dataType) in size]
    return sum(parts[1:], parts[0]) if parts else None


def written(df: DataFrame, name: str, **found: Column) -> DataFrame:
    """The rows of df, written once to the shared folder and read back: later plans start there, also after a loss of executors.

    Their number and size, and the aggregates in found, are taken from the write itself and kept in .stored of the frame returned.
    """
    spark, path, seen = df.sparkSession, new_path(df.sparkSession, name), Observation()
    width = _width(df.schema)
    more = [F.sum(width).alias("__bytes")] if width is not None else []
    with text_batches(spark):
        df.observe(seen, F.count(F.lit(1)).alias("__rows"), *more, *[c.alias(k) for k, c in found.items()]).write.parquet(path)
    got = seen.get
    out = spark.read.schema(df.schema).parquet(path)
    out.stored = Stored(path, got["__rows"], got["__rows"] * (16 + 8 * len(df.columns)) + (got.get("__bytes") or 0), {k: got[k] for k in found})
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.stored.path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Deletes all that the text operators have stored in the shared folder. For callers that have taken their results."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tidemark")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_texts(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """df.mapInArrow(f, schema). To be stored by written(), whose batches hold a few MB of whole texts."""
    return df.mapInArrow(f, schema)


def fits(stored: DataFrame, limit: int | None = None) -> bool:
    return stored.stored.bytes <= (BROADCAST_BYTES if limit is None else limit)


def small_side(stored: DataFrame, df: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """A stored table, or df that was made of it with no more rows or wider ones, with a broadcast hint if its size was measured to fit;
    else as it is, for a shuffle join."""
    df = stored if df is None else df
    return F.broadcast(df) if fits(stored, limit) else df


def join_counted(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """rows left-joined on keys with groups, which has a row for each key and says in `count` how many of the `total` rows have it.

    Hot keys, of which there are HOT_KEYS at most whatever the data, are broadcast, so that their rows stay spread as they are; the
    rows of others are joined as Spark sees fit.
    """
    hot = groups.filter(F.col(count) * HOT_KEYS > total)
    at_hot = rows.join(F.broadcast(hot), keys)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(groups.filter(F.col(count) * HOT_KEYS <= total), keys, "left")
    return at_hot.unionByName(others)


def spare(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def key_of() -> Column:
    """What tells rows apart whose doc_id is null or repeated: a hash of doc_id and text. Rows alike in both are one document."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))
