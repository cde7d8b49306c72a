"""Quality: Bradley-Terry scores learned from preference pairs, by logistic loss on differences of features, cut at a quantile of scores."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, map_texts, small_side, written

#: Labelled rows of a block, about: each block is fitted in a task of its own, and all labelled rows are in one. RARE of them, about, are of the rarer class.
FIT_ROWS, RARE = 8000, 100
#: Cells in which strengths are counted on the way to their quantile, and rows that are left to sort at its end.
CELLS, LAST = 1000, 2000
#: Pairs of each step and steps of the fit, its rate, and the weight of the squared weights in the loss.
PAIRS, STEPS, RATE, RIDGE = 1024, 300, 0.05, 1e-4
#: Characters with a class of their own; others go by their kind.
_SINGLE = "\n.,;:!?|*$%#&<>()-'\"/"
_KINDS = 6 + len(_SINGLE)
_WORDS = 10
WIDTH = _KINDS * _KINDS + _WORDS
_ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _classes() -> np.ndarray:
    """The class of each code point of the first plane: lower case, upper case, digit, white space, other letter, sign; or its own."""
    out = np.full(1 << 16, 5, np.uint8)
    for code in range(1 << 16):
        kind = unicodedata.category(chr(code))
        out[code] = 0 if kind == "Ll" else 1 if kind in ("Lu", "Lt") else 2 if kind == "Nd" else 4 if kind[0] in "LM" else 3 if kind[0] == "Z" or 9 <= code <= 13 else 5
    for at, c in enumerate(_SINGLE):
        out[ord(c)] = 6 + at
    return out


def features(text: str | None) -> np.ndarray:
    """WIDTH numbers of a whole text: root shares of pairs of neighbouring character classes, and shares of repeated, long, short and capital words and of repeated
    lines. A null text counts as empty."""
    text = text or ""
    out = np.zeros(WIDTH, np.float32)
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _classes()[np.minimum(codes, 0xFFFF)].astype(np.int64)
    pairs = np.bincount(kinds[:-1] * _KINDS + kinds[1:], minlength=_KINDS * _KINDS)
    out[: _KINDS * _KINDS] = np.sqrt(pairs / max(1, len(codes) - 1))
    words = text.split()
    n = len(words)
    if n:
        lines = [x for x in text.split("\n") if x.strip()]
        places = {w: k for k, w in enumerate(dict.fromkeys(words))}
        ids = np.fromiter((places[w] for w in words), np.uint64, n)
        sizes = np.fromiter(map(len, words), np.int64, n)
        threes = np.unique((ids[:-2] * _ODD + ids[1:-1]) * _ODD + ids[2:]).size / (n - 2) if n > 2 else 1.0
        out[-_WORDS:] = (
            np.log1p(n) / 10, len(places) / n, len(places) / n**0.5 / 10, threes, np.mean(ids[1:] == ids[:-1]) if n > 1 else 0, sizes.mean() / 10, np.mean(sizes > 12), np.mean(sizes == 1),
            sum(map(str.isupper, words)) / n, 1 - len(set(lines)) / max(1, len(lines)),
        )
    return out


def held_out(doc_id: Column) -> Column:
    """Whether the row stays out of training: crc32(doc_id as text) mod 3 is 1. A null doc_id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def rank(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE, seed: int = 0) -> np.ndarray:
    """Weights w by which P(a is preferred to b) = 1 / (1 + exp(-w.(a - b))) fits pairs of a row of good and a row of bad best: steps of Adam, each on
    newly drawn pairs. Rows of either side are dealt in turn, shuffled anew each time around, and there are steps enough for each to be dealt once. Bradley and Terry's strength of a row is exp(w.row)."""
    draw, w, m, v = np.random.default_rng(seed), np.zeros(good.shape[1]), np.zeros(good.shape[1]), np.zeros(good.shape[1])
    hands = {True: np.empty(0, np.int64), False: np.empty(0, np.int64)}

    def deal(side: bool, n: int) -> np.ndarray:
        while len(hands[side]) < pairs:
            hands[side] = np.concatenate([hands[side], draw.permutation(n)])
        out, hands[side] = hands[side][:pairs], hands[side][pairs:]
        return out

    steps = max(steps, -(-max(len(good), len(bad)) // pairs))
    for t in range(1, steps + 1):
        d = (good[deal(True, len(good))] - bad[deal(False, len(bad))]).astype(np.float64)
        slope = -(d.T @ (1 / (1 + np.exp(np.clip(d @ w, -30, 30))))) / pairs + ridge * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        w = w - rate * (1 - 0.9 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def cut(strengths: np.ndarray, weights: np.ndarray, share: float) -> float:
    """The quantile of weighted strengths above which lies `share` of the weight: halfway between the two rows that it falls between."""
    order = np.argsort(-strengths, kind="stable")
    s, above = strengths[order], np.cumsum(weights[order])
    at = int(np.searchsorted(above, share * above[-1] - 1e-9))
    return float(s[at] if at + 1 >= len(s) else (s[at] + s[at + 1]) / 2)


def _quantile(strengths: DataFrame, above: int, low: float, high: float) -> float:
    """Halfway between the strengths numbers `above` and `above` + 1 from the top, of all rows of strengths (s double, from low to high): rows are counted in cells, those in the cells of the two again in finer
    ones, until few different strengths are left."""

    def at(rank: int) -> float:
        lo, hi, over = low, high, 0  # `over` rows are above hi
        while True:
            inside = strengths.filter(F.col("s").between(lo, hi))
            few = inside.groupBy("s").agg(F.count("*").alias("n")).orderBy(F.desc("s")).limit(LAST + 1).collect()
            if len(few) <= LAST:
                for r in few:
                    over += r["n"]
                    if over >= rank:
                        return r["s"]
            cell = F.least(F.floor((F.col("s") - lo) / ((hi - lo) / CELLS)), F.lit(CELLS - 1))
            cells = sorted((r for r in inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).collect()), key=lambda r: -r["cell"])
            for r in cells:
                if over + r["n"] >= rank:
                    lo, hi = r["lo"], r["hi"]
                    break
                over += r["n"]

    return (at(above) + at(above + 1)) / 2


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, seed: int = 0) -> tuple[np.ndarray, float]:
    """(weights of features, bias): score = 1 / (1 + exp(-(weights.features + bias))).

    Labels are those that are not held out; of several of a doc_id the better one counts, null ones don't. All labelled rows take part: they are dealt into blocks of about fit_rows by a hash of
    doc_id, a task of an executor draws and fits the pairs of its block, and the weights are the mean of the blocks', weighted by their rows of the rarer class. Features are scaled by their deviations
    over all rows, and the quantile is that of all rows' strengths. Where one class is so rare that few of its rows would be in a block, blocks are larger. With one class alone, or none, every score is the
    share of good labels.
    """
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.max("quality") > 0).cast("int").alias("good"))
    known = written(known.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("labelled"), "good"), "quality-labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(known), F.col("doc_id") == F.col("labelled"))

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("good"), pa.array([x.tobytes() for x in xs], pa.binary())], names=["doc_id", "good", "x"])

    table = written(map_texts(rows.select("doc_id", "good", "text"), found, "doc_id long, good int, x binary"), "quality-features", n1=F.count_if(F.col("good") > 0))
    n, n1 = table.stored.rows, table.stored.found["n1"]
    share = (n1 + 0.5) / (n + 1)
    if not 0 < n1 < n:
        forget(table, known)
        return np.zeros(WIDTH), float(np.log(share / (1 - share)))

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, WIDTH))
        for b in batches:
            for x in b["x"].to_pylist():
                x = np.frombuffer(x, np.float32).astype(np.float64)
                total += x, x * x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    # Partial results come in order of their bytes, so that sums don't depend on the order of tasks: one of WIDTH numbers for each task.
    first, second = sum(np.frombuffer(t, np.float64).reshape(2, WIDTH) for t in sorted(bytes(r["total"]) for r in table.select("x").mapInArrow(summed, "total binary").collect())) / n
    scale = 1 / np.maximum(np.sqrt(np.maximum(second - first * first, 0)), 1e-3)
    blocks = max(1, min(-(-n // fit_rows), min(n1, n - n1) // RARE))

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = sorted(((x, y, k) for b in batches for k, y, x in zip(b["block"].to_pylist(), b["good"].to_pylist(), b["x"].to_pylist(), strict=True)), key=lambda r: (r[2], zlib.crc32(r[0]), r))
        of = np.array([r[2] for r in data])
        for k in np.unique(of):
            mine = [data[i] for i in np.flatnonzero(of == k)]
            x, y = np.stack([np.frombuffer(r[0], np.float32) for r in mine]) * scale.astype(np.float32), np.array([r[1] for r in mine])
            rarer = int(min((y > 0).sum(), (y == 0).sum()))
            if rarer:
                w = rank(x[y > 0], x[y == 0], seed=seed) * scale
                yield pa.RecordBatch.from_arrays([pa.array([int(k)]), pa.array([w.tobytes()], pa.binary()), pa.array([rarer])], names=["block", "w", "n"])

    dealt = table.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(blocks)))
    fits = sorted((r["block"], r["n"], bytes(r["w"])) for r in dealt.repartition(blocks, "block").mapInArrow(learn, "block long, w binary, n long").collect())
    if not fits:
        forget(table, known)
        return np.zeros(WIDTH), float(np.log(share / (1 - share)))
    w = sum(np.frombuffer(x, np.float64) * k for _, k, x in fits) / sum(k for _, k, _ in fits)

    def strengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float(np.frombuffer(x, np.float32).astype(np.float64) @ w) for x in b["x"].to_pylist()], pa.float64())], names=["s"])

    got = written(table.select("x").mapInArrow(strengths, "s double"), "quality-strengths", low=F.min("s"), high=F.max("s"))
    bias = -_quantile(got, n1, got.stored.found["low"], got.stored.found["high"])
    forget(got, table, known)
    return w, bias


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """docs with score and predicted (1 if score >= 0.5, else 0); columns of these names are replaced. Rows are not shuffled; WIDTH weights are broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts):
        import pandas as pd

        w, b = sent.value
        at = np.array([float(features(t).astype(np.float64) @ w) + b for t in texts])
        return pd.Series(1 / (1 + np.exp(-np.clip(at, -500, 500))))

    return docs.drop("score", "predicted").withColumn("score", scores(F.col("text"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality_ranking(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted. Scores depend on the text alone; null and empty texts get one too.

    Repeated rows are scored each; a null doc_id counts as held out; other columns of docs and labels are not read. No rows in, no rows out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return written(score(rows, train(docs, labels, fit_rows)).select("doc_id", "held_out", "score", "predicted"), "quality-scores")


def keep_best(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of docs that score 0.5 or more, in docs' own columns and order of columns."""
    model = train(docs, labels, fit_rows)
    clash = [c for c in docs.columns if c.lower() in ("score", "predicted")]
    renamed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text") if clash else docs
    kept = score(renamed, model).filter("predicted = 1")
    return kept.select("row.*") if clash else kept.select(*[F.col(f"`{c}`") for c in docs.columns])
