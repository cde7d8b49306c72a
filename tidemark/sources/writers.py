"""What writers of files share: work folders, sizes of files, retention. Tables are written by `sources.lake`."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that compaction aims at, and of a month's once it is seldom read.
FILE_BYTES, WARM_FILE_BYTES = 128 << 20, 256 << 20
#: Bytes of a shuffle, packed, that one task of a job reads.
PART_BYTES = 8 << 20


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def work_folder(spark: SparkSession) -> str:
    """A new folder for a job's own tables, in spark.checkpoint.dir; where that is unset, on one machine only, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    return f"{folder.rstrip('/')}/jobs/{uuid.uuid4().hex}"


@contextmanager
def in_parts(spark: SparkSession, part_bytes: int | None = PART_BYTES) -> Iterator[None]:
    """While a job's tables are written: tasks after a shuffle get part_bytes at most, as adaptive execution joins small ones up to 64 MB of packed rows, a GB or so once they are sorted;
    and no side is broadcast by its estimated size, which lineage columns that take no room in files make too small, so that whole tables go through the driver. Sides that are small
    whatever the input have a hint. Files are read in such parts too. Without part_bytes, parts are as large as adaptive execution wants them, not as many as there are cores. Sides that were both dealt by some of a join's keys are not dealt again by all of them. Generated methods that the JVM
    wouldn't compile give way to smaller ones."""
    wanted = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.requireAllClusterKeysForCoPartition": "false"} | {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} | ({"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(part_bytes), "spark.sql.files.maxPartitionBytes": str(part_bytes), "spark.sql.files.openCostInBytes": str(part_bytes // 8)} if part_bytes else {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a work folder once its tables have been read for the last time."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def file_rows(spark: SparkSession, paths: list[str], rows: int, file_bytes: int = FILE_BYTES) -> int:
    """Rows of a file of file_bytes, by what the rows at paths take now."""
    taken = sum(folder_bytes(spark, p) for p in paths)
    return max(1, int(file_bytes * rows / max(1, taken)))


def retained(quarantine: DataFrame, today: Column, keep_days: int = 30) -> DataFrame:
    """Rows of the quarantine that stay: unresolved ones, and those resolved no longer than keep_days ago."""
    return quarantine.filter(F.col("resolved_at").isNull() | (F.to_date("resolved_at") >= F.date_sub(today, keep_days)))
