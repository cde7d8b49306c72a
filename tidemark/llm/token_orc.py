"""Token ids in ORC: sorted by document, run-length encoded, with row indexes and Bloom filters on doc_id."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, new_path, text_batches
from tidemark.llm.tokens import encoder

END = 2
_FILE = "part int, pos long, doc_id long, n_tokens int, ids array<int>"
_ARROW = pa.schema([("part", pa.int32()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END, partitions: int | None = None, stripe_mb: int = 16, stride: int = 1000) -> None:
    """Writes the ids of each document's whole text, then end, as ORC in ascending doc_id order (null first; rows with equal ids by text).

    Each file holds one range of doc_id (part, pos say where a row is), so that stripes can be read in parallel and a lookup by
    doc_id skips files and stripes by their statistics and row groups of `stride` rows by row index and Bloom filter. The integer
    columns are run-length encoded by the ORC writer. Null texts count as empty and have the end id alone.
    """
    end_bytes = np.array([end], "<u4").tobytes()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, pos = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for b in batches:
            rows = [enc.ids(t) + end_bytes for t in b.column("text").to_pylist()]
            for at in range(0, len(rows), 500):
                some = rows[at : at + 500]
                n = np.array([len(x) // 4 for x in some], "i4")
                ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype("i4"), np.frombuffer(b"".join(some), "<i4"))
                where = np.arange(pos, pos + len(some))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), part, "i4")), pa.array(where), b.column("doc_id").slice(at, 500), pa.array(n), ids], schema=_ARROW)
                pos += len(some)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Rows with one doc_id, or none, may be many: the range is split further by how their texts begin, which agrees with the order by text.
    begin = F.substring("text", 1, 32).asc_nulls_first()
    rows = rows.repartitionByRange(*([partitions] if partitions else []), F.col("doc_id").asc_nulls_first(), begin).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": str(stride), "orc.stripe.size": str(stripe_mb << 20), "compression": "zstd"}
    with text_batches(docs.sparkSession):
        map_texts(rows, encode, _FILE).write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The rows of the files; with doc_ids those documents alone, by a predicate that the ORC reader prunes with."""
    rows = spark.read.schema(_FILE).orc(path)
    return rows.filter(F.col("doc_id").isin(doc_ids)) if doc_ids is not None else rows


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row of the files. Starts are running sums in each part, after the parts before it."""

    def crc(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            flat, off = np.ascontiguousarray(ids.values.to_numpy(), "<i4"), ids.offsets.to_numpy()
            n = np.diff(off)
            sums = [zlib.crc32(flat[x:y]) for x, y in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("pos"), b.column("doc_id"), pa.array(n.astype("i8")), pa.array(sums, pa.int64())], names=["part", "pos", "doc_id", "n_tokens", "ids_crc32"])

    rows = map_texts(read_tokens(spark, path), crc, "part int, pos long, doc_id long, n_tokens long, ids_crc32 long")
    # A row for each part, from the narrow counts in the files.
    parts = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return rows.join(parts, "part").select("doc_id", (F.col("before") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Writes docs to a new path in the shared folder and returns the digests of what the files hold."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens-orc")
    write_tokens(docs, path, tokenizer, end)
    return digests(spark, path)
