"""Toxicity: a linear classifier on character n-grams, scaled by their naive Bayes log-count ratios."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import forget, key_of, map_texts, small_side, spare, written

#: n-grams of 3 to 5 characters of lower-case words with their ends marked, hashed to so many features.
FEATURES, SIZES = 1 << 18, (3, 4, 5)
#: Labelled rows of each class that the weights are fitted on, about; counts for the ratios take all labelled rows.
FIT_ROWS = 3000
_WHITE = np.array([0x20, *range(0x09, 0x0E)], np.uint32)
_PLACE = np.random.default_rng(7).integers(0, 1 << 31, max(SIZES) + 1, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def features(text: str | None) -> np.ndarray:
    """The distinct features of a whole text, ascending: its runs of characters that have no white space but at their ends."""
    chars = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    white = np.isin(chars, _WHITE) if (chars < 0x20).any() else chars == 0x20
    chars = np.where(white, np.uint32(0x20), chars) * np.uint32(0x9E3779B1)
    flags = np.zeros(FEATURES, bool)
    for n in SIZES:
        count = len(chars) - n + 1
        if count < 1:
            continue
        total = np.full(count, n * 0x85EBCA6B & 0xFFFFFFFF, np.uint32)
        inside = np.zeros(count, bool)
        for j in range(n):
            total += (chars[j : j + count] ^ (chars[j : j + count] >> np.uint32(15))) * _PLACE[j]
            if 0 < j < n - 1:
                inside |= white[j : j + count]
        total ^= total >> np.uint32(16)
        total *= np.uint32(0xC2B2AE35)
        flags[(total >> np.uint32(14))[~inside]] = True
    return np.flatnonzero(flags).astype(np.int32)


def held_out(doc_id: Column) -> Column:
    """Whether the row stays out of training: crc32(doc_id as text) mod 5 is 0. A null doc_id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of labelled rows that are not held out; of several labels of a doc_id, 1 wins; null labels count for nothing."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = written(known.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("labelled"), "toxic"), "toxic-labels")
    ids = F.col("doc_id").cast("long")
    return docs.select(ids.alias("doc_id"), "text").join(small_side(known), F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "toxic")


def log_ratios(rows: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """ln(p / q) of each feature: p and q are its smoothed shares of the toxic and of the other rows' features. Counted over all rows."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, FEATURES), np.int64)
        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                sums[int(toxic > 0), features(text)] += 1
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype("i4")), pa.array(sums[1, some]), pa.array(sums[0, some])], names=["feature", "p", "q"])

    counted = written(map_texts(rows.select("text", "toxic"), count, "feature int, p long, q long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("q").alias("q")), "toxic-counts")
    got = counted.toPandas()
    forget(counted)
    p, q = np.full(FEATURES, smoothing), np.full(FEATURES, smoothing)
    p[got["feature"]] += got["p"]
    q[got["feature"]] += got["q"]
    return np.log((p / p.sum()) / (q / q.sum())).astype(np.float32)


def descend(data: list[tuple[np.ndarray, int]], ratios: np.ndarray, heavy: tuple[float, float], prior: float, epochs: int, rate: float, seed: int) -> tuple[np.ndarray, float]:
    """(weights, bias) by logistic regression with AdaGrad on rows (features, class), each class weighted by heavy. The order of data doesn't matter."""
    data = sorted(data, key=lambda r: (zlib.crc32(r[0].tobytes()), r[1]))
    w, b, gw, gb, order = np.zeros(FEATURES), prior, np.full(FEATURES, 1e-2), 1e-2, np.random.default_rng(seed)
    for _ in range(epochs):
        for at in order.permutation(len(data)):
            ids, y = data[at]
            x = ratios[ids]
            off = heavy[y] * (1 / (1 + np.exp(-np.clip(w[ids] @ x + b, -30, 30))) - y)
            step = off * x
            gw[ids] += step * step
            w[ids] -= rate * step / np.sqrt(gw[ids])
            gb += off * off
            b -= rate * off / np.sqrt(gb)
    return (w * ratios).astype(np.float32), float(b)


def fit(rows: DataFrame, ratios: np.ndarray, fit_rows: int = FIT_ROWS, epochs: int = 12, rate: float = 0.1, seed: int = 0) -> tuple[np.ndarray, float]:
    """(weights, bias) fitted on about fit_rows rows of each class, those of the smallest hashes of doc_id, in one task on an executor.

    Rows of a class stand for as many as the class has in all, so that scores keep to the labels' share. With rows of one class
    alone, or none, scores follow that share and nothing else.
    """
    counts = {int(r["toxic"] > 0): r["n"] for r in rows.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    prior = float(np.log(share / (1 - share)))
    plain = np.zeros(FEATURES, np.float32), prior
    if len(counts) < 2:
        return plain

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [features(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(ids, pa.binary())], names=["toxic", "ids"])

    # Chosen row by row where they are read: no sort, and no task sees more than its own.
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    some = rows.filter(place < F.when(F.col("toxic") > 0, F.lit(fit_rows / counts[1])).otherwise(F.lit(fit_rows / counts[0]))).select("text", "toxic")
    sample = written(map_texts(some, found, "toxic int, ids binary"), "toxic-sample", n1=F.count_if(F.col("toxic") > 0))
    n1 = sample.stored.found["n1"]
    n0 = sample.stored.rows - n1
    if not n0 or not n1:
        return plain
    heavy = tuple(counts[c] / n * sample.stored.rows / sum(counts.values()) for c, n in ((0, n0), (1, n1)))

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = [(np.frombuffer(x, np.int32), int(y > 0)) for b in batches for y, x in zip(b["toxic"].to_pylist(), b["ids"].to_pylist(), strict=True)]
        w, bias = descend(data, ratios, heavy, prior, epochs, rate, seed)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([bias])], names=["w", "b"])

    got = written(sample.repartition(1).mapInArrow(learn, "w binary, b double"), "toxic-model")
    model = got.first()
    forget(sample, got)
    return np.frombuffer(model["w"], np.float32), model["b"]


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    rows = training_rows(docs, labels)
    return fit(rows, log_ratios(rows), fit_rows)


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 if score >= 0.5, else 0); columns of these names are replaced. Rows are not shuffled.

    Null texts and texts without words have the score that the bias alone gives. The weights, FEATURES of them, are broadcast.
    """
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts):
        import pandas as pd

        w, b = sent.value
        logits = np.array([float(w[features(t)].sum(dtype=np.float64)) + b for t in texts])
        return pd.Series(1 / (1 + np.exp(-np.clip(logits, -500, 500))))

    plain = docs.drop("score", "predicted").withColumn("score", scores(F.col("text")))
    return plain.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Learns from labelled rows that are not held out, by their text alone.

    Repeated rows are scored each; a null doc_id counts as held out. No rows in, no rows out; without labels every score is 0.5.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return written(score(rows, train(docs, labels, fit_rows)).select("doc_id", "held_out", "score", "predicted"), "toxic-scores")


def drop_toxic(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """docs without those that the classifier rejects, in docs' own columns. Only hashes of the rejected ones are joined back."""
    key = spare(docs, "key")
    scored = score(docs.select(key_of().alias(key), "text"), train(docs, labels, fit_rows))
    bad = written(scored.filter("predicted = 1").select(key), "toxic-keys")
    return docs.withColumn(key, key_of()).join(small_side(bad), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
