"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, fits, forget, join_counted, text_or_empty, written


#: Bitmaps of 4,096 bytes each, as Spark's bitmap functions have them: 16 MB, 134 million bits. With 13 million keys in play a tenth of other texts are hashed too.
BITMAPS = 4096
_BITS = 8 * 4096


def _marked(rows: DataFrame, in_play: DataFrame, keys: list[str]) -> DataFrame:
    """rows with marked: true for all rows that have keys of in_play, and for others whose hash meets one of theirs."""
    number = F.pmod(F.xxhash64(F.lit("bitmap"), *keys), F.lit(BITMAPS * _BITS))
    bitmap, bit = F.floor(number / _BITS).cast("int").alias("bitmap"), (number % _BITS).cast("int").alias("bit")
    bits = in_play.select(bitmap, bit).groupBy("bitmap").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.getbit(byte, F.col("bit") % 8) == 1, F.lit(False))
    return rows.withColumns({"bitmap": bitmap, "bit": bit}).join(F.broadcast(bits), "bitmap", "left").withColumn("marked", marked)


def exact_groups(docs: DataFrame, prefix_chars: int = 256, hash_all: bool = False, broadcast_bytes: int | None = None) -> DataFrame:
    """Stored rows (doc_id, n_bytes, text_sha256, n_code_points, in_play, row); in_play: whether length and prefix left the row in play.

    One scan counts (length, prefix hash): a length that occurs once ends there, so does a prefix that occurs once in its length. A
    second scan hashes whole texts of the rows in play, or of all with hash_all. With few keys in play (by measured bytes) they are
    broadcast; with more, a bitmap of their hashes is, whose size is the same for any number of keys. Texts whose bit is not set are out of
    play and are not hashed; the few others that are out of play give their hash up in a join of narrow rows. Both ways return the same.
    """
    rows = docs.select("doc_id", F.regexp_replace(text_or_empty(), f"[{SPACE}]+", "").alias("norm"), F.char_length(text_or_empty()).cast("long").alias("n_code_points"))
    rows = rows.withColumns({"n_bytes": F.octet_length("norm").cast("long"), "prefix": F.xxhash64(F.substring("norm", 1, prefix_chars))})
    sizes = rows.groupBy("n_bytes", "prefix").agg(F.count("*").alias("n"))
    in_play = written(sizes.filter("n > 1").withColumn("hit", F.lit(True)), "exact-keys")
    digest, keys = F.sha2("norm", 256), ["n_bytes", "prefix"]
    if fits(in_play, broadcast_bytes):
        found = rows.join(F.broadcast(in_play), keys, "left").withColumn("text_sha256", digest if hash_all else F.when(F.col("hit"), digest))
    else:
        maybe = rows if hash_all else _marked(rows, in_play, keys)
        hashed = written(maybe.withColumn("text_sha256", digest if hash_all else F.when(F.col("marked"), digest)).select("doc_id", "n_code_points", *keys, "text_sha256"), "exact-hashes")
        found = join_counted(hashed, in_play, keys, "n", hashed.stored.rows)
        found = found if hash_all else found.withColumn("text_sha256", F.when(F.col("hit"), F.col("text_sha256")))
    found = found.select("doc_id", "n_bytes", "text_sha256", "n_code_points", F.coalesce("hit", F.lit(False)).alias("in_play"))
    out = written(found.withColumn("row", F.monotonically_increasing_id()), "exact-rows")
    forget(in_play)
    return out


def exact_dedup(docs: DataFrame, prefix_chars: int = 256, hash_all: bool = False, broadcast_bytes: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are once spaces, tabs and line ends (\\x20, \\x09-\\x0D) are deleted; null is empty, and all empty
    texts are equal. Of a group the longest original text stays, then the smallest doc_id; of rows that tie in both, the first
    read. A null doc_id loses ties. Without hash_all, text_sha256 is null for rows that length or prefix had already told apart.
    Other columns are ignored. No rows in, no rows out. A group of any size stays spread over tasks: its sizes are combined before
    the shuffle, and its rows are joined with what is known of it by broadcast.
    """
    rows = exact_groups(docs, prefix_chars, hash_all, broadcast_bytes)
    best = F.min(F.struct((-F.col("n_code_points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    groups = rows.filter("in_play").groupBy("n_bytes", "text_sha256").agg(F.count("*").alias("group_size"), best).filter("group_size > 1")
    groups = written(groups.select("n_bytes", "text_sha256", "group_size", F.col("best.doc_id").alias("first"), F.col("best.row").alias("best")), "exact-groups")
    keys = ["n_bytes", "text_sha256"]
    joined = rows.join(F.broadcast(groups), keys, "left") if fits(groups, broadcast_bytes) else join_counted(rows, groups, keys, "group_size", rows.stored.rows)
    alone = F.col("best").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
