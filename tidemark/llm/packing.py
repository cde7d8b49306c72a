"""Harmonic packing: pieces in classes of reciprocal capacity, each sequence of class k with k pieces."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, small_side, written
from tidemark.llm.tokens import encoder

CAPACITY, END = 2048, 1
#: A piece may waste this share of its slot; else its head is cut to fill the next smaller slot.
SLACK = 1 / 64
_PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, class int, part int, rank long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("class", pa.int32()), ("part", pa.int32()), ("rank", pa.int64())])


def cut(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of n tokens. Class k takes lengths up to capacity // k, of which k fit a sequence.

    Whole sequences come first. Of the rest, a head is cut to the largest slot that it fills, until what remains wastes little
    of its own slot: a slot of class k falls short of that of class k - 1 by capacity / k^2 only, so that this takes few cuts.
    """
    out, at = [], 0
    while at < n:
        left = min(n - at, capacity)
        k = capacity // left
        slot = capacity // k
        if slot - left > slack * slot:
            k += 1
            left = capacity // k
        out.append((at, left, k))
        at += left
    return out


def pieces(docs: DataFrame, tokenizer: str, end: int = END, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """A row for each piece of each document's ids and end, with its class and its rank in that class on its worker."""
    end_bytes = np.array([end], "<u4").tobytes()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, ranks = encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = memoryview(enc.ids(text) + end_bytes)
                n = len(ids) // 4
                for start, length, k in cut(n, capacity, slack):
                    for c, x in zip(cols, (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, k, part, ranks[k]), strict=True):
                        c.append(x)
                    ranks[k] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW, strict=True)], schema=_ARROW)

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), encode, _PIECES)


def first_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each length: from long to short, each goes to the first bin that has room."""
    bins, free, used = np.zeros(len(lengths), np.int64), np.full(len(lengths), capacity), 0
    for i in np.argsort(-lengths, kind="stable"):
        at = int((free[: used + 1] >= lengths[i]).argmax())
        bins[i], free[at], used = at, free[at] - lengths[i], max(used, at + 1)
    return bins


def rest_packed(rest: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(class, at, bin, place) of pieces (class, at, length), fewer than k of each class k.

    One task packs them: their number is bounded by the classes, whatever the input (lengths of up to 2048 have some 90 classes and less than 91
    sequences' tokens), so that it may be broadcast too.
    """

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        t = pa.Table.from_batches(found).sort_by([("class", "ascending"), ("at", "ascending")])
        bins = first_fit(t["length"].to_numpy(), capacity)
        place = np.arange(t.num_rows, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([t["class"].combine_chunks(), t["at"].combine_chunks(), pa.array(bins), pa.array(place)], names=["class", "at", "bin", "place"])

    return rest.coalesce(1).mapInArrow(fill, "class int, at long, bin long, place long")


def pack(docs: DataFrame, tokenizer: str, end: int = END, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Workers fill their classes without a word to each other. A count for each worker and class then says how many pieces of the
    class lie on the workers before, which turns ranks into sequences. What is left over, fewer than k pieces of each class k, is packed
    together at the end. A null text has the end id alone; rows with equal or null doc_id are packed like any other. Other
    columns are ignored. No rows in, no rows out.
    """
    rows = written(pieces(docs, tokenizer, end, capacity, slack), "pieces")
    here = rows.groupBy("class", "part").agg(F.count("*").alias("n"))
    here = here.withColumn("before", F.sum("n").over(Window.partitionBy("class").orderBy("part")) - F.col("n"))
    totals = here.groupBy("class").agg(F.floor(F.sum("n") / F.col("class")).alias("whole"))
    totals = totals.select("class", "whole", (F.sum("whole").over(Window.orderBy("class")) - F.col("whole")).alias("first"), F.sum("whole").over(Window.partitionBy()).alias("all"))
    place = written(here.join(totals, "class").select("class", "part", "before", "whole", "first", "all"), "pieces-before")
    rows = rows.join(small_side(place), ["class", "part"]).withColumn("at", F.col("before") + F.col("rank"))
    over = F.col("at") >= F.col("whole") * F.col("class")
    rest = written(rest_packed(rows.filter(over).select("class", "at", "length"), capacity), "pieces-rest")
    rows = rows.join(F.broadcast(rest), ["class", "at"], "left")
    in_class = F.col("first") + F.floor(F.col("at") / F.col("class"))
    rows = rows.withColumn("sequence_id", F.when(over, F.col("all") + F.col("bin")).otherwise(in_class).cast("long")).withColumn("turn", F.coalesce("place", "at"))
    before = Window.partitionBy("sequence_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset")
    )
