"""Jaccard join on word shingles: MinHash candidates, pruned by Bayesian comparison of their values, the rest verified exactly."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fits, forget, join_counted, key_of, map_texts, small_side, spare, written
from tidemark.llm.components import components
from tidemark.llm.shingles import HASHES, set_hash, shingles, signature

WORDS, SIMILARITY = 5, 0.8
#: Values of a band. Of pairs at 0.8, 24 bands of 4 miss 3 in a million; at 0.9 and above, less than one in 10^11.
ROWS = 4
BANDS = HASHES // ROWS
#: MinHash values compared before each look at the posterior, and the probability below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-6
#: Texts and bytes of text of a block, about; a group has the texts of two blocks at most.
BLOCK, BLOCK_BYTES = 512, 4 << 20
#: Pairs compared at once.
PAIRS = 1 << 16
_GROUP = ["band_no", "band", "low", "high"]


def least_matches(threshold: float = SIMILARITY, tolerance: float = TOLERANCE, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m): of n values compared, fewer than m equal ones put P(similarity >= threshold) below tolerance.

    With a uniform prior the similarity after m equal values of n is Beta(m + 1, n - m + 1), and the probability that it is at least t is
    that of a binomial variable of n + 1 trials at t being m or less.
    """
    out = []
    for n in range(step, HASHES + 1, step):
        below = 0.0
        for m in range(n + 1):
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
        out.append((n, m))
    return out


def whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by _GROUP as (rows of whole groups, start of each group and the end); what is held is a batch and a group."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        if not t.num_rows:
            continue
        keys = np.stack([t[c].to_numpy().astype("i8") for c in _GROUP])
        starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])
        if len(starts) > 1:
            yield t.slice(0, starts[-1]).combine_chunks(), starts
        held = t.slice(starts[-1])
    if held is not None:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def pairs_of(starts: np.ndarray, side: np.ndarray, across: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j), about PAIRS at a time: within each group all pairs i < j, or in groups of two blocks (across) those between the blocks."""
    sizes = np.diff(starts)
    for m in range(2, 33):
        first = starts[:-1][sizes == m]
        a, b = np.triu_indices(m, 1)
        for some in np.array_split(first, max(1, len(first) * len(a) // PAIRS)):
            i, j = (some[:, None] + a).ravel(), (some[:, None] + b).ravel()
            stay = ~across[i] | (side[i] != side[j])
            if len(some):
                yield i[stay], j[stay]
    for at in np.flatnonzero(sizes > 32):
        rows = np.arange(starts[at], starts[at + 1])
        two = across[rows[0]]
        left = rows[side[rows] == side[rows[0]]] if two else rows
        right = rows[side[rows] != side[rows[0]]] if two else rows
        for some in np.array_split(left, max(1, len(left) * len(right) // PAIRS)) if len(right) else []:
            i, j = np.repeat(some, len(right)), np.tile(right, len(some))
            yield (i, j) if two else (i[i < j], j[i < j])


def candidates(values: np.ndarray, band_no: np.ndarray, i: np.ndarray, j: np.ndarray, looks: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs, those whose first common band is the one of their group, and that no look at their values drops."""
    bands = values.view(np.uint64)
    same = bands[i] == bands[j]
    first = same.argmax(axis=1)
    stay = (first == band_no[i]) & same[np.arange(len(i)), first]
    i, j, seen, at = i[stay], j[stay], 0, 0
    for n, least in looks:
        seen = seen + (values[i, at:n] == values[j, at:n]).sum(axis=1)
        stay = seen >= least
        i, j, seen, at = i[stay], j[stay], seen[stay], n
    return i, j


def common_sizes(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many shingles the sets of each pair have in common."""
    if len(i) <= 4 * len(sets):
        return np.array([np.intersect1d(sets[a], sets[b], assume_unique=True).size for a, b in zip(i, j, strict=True)], float)
    # One product for all of them, over stretches of the shingles that are there.
    used = np.unique(np.concatenate([i, j]))
    ids = np.unique(np.concatenate([sets[a] for a in used]), return_inverse=True)[1]
    row = np.repeat(np.arange(len(used)), [sets[a].size for a in used])
    i, j = np.searchsorted(used, i), np.searchsorted(used, j)
    width, both = max(64, (1 << 22) // len(used)), np.zeros((len(used), len(used)), np.float32)
    order = np.argsort(ids, kind="stable")
    ids, row = ids[order], row[order]
    for low in range(0, int(ids[-1]) + 1, width):
        a, b = np.searchsorted(ids, [low, low + width])
        found = np.zeros((len(used), width), np.float32)
        found[row[a:b], ids[a:b] - low] = 1
        both += found @ found.T
    return both[i, j].astype(float)


def linked(t: pa.Table, starts: np.ndarray, k: int, threshold: float, looks: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(node, copies, i, j, similarity) for each group of t with similar pairs: i and j are places in node, which ascends."""
    node, group = t["node"].to_numpy(), np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    # A text is there as often as rows are alike; one whose set is another than its node's has its key by chance.
    sets = [shingles(x or b"", k) for x in t["text"].cast(pa.binary()).to_pylist()]
    own = np.array([set_hash(s) == x for s, x in zip(sets, t["shape"].to_pylist(), strict=True)], bool)
    rows = np.lexsort([node, group])
    rows = rows[own[rows]]
    rows = rows[np.concatenate([[True], (np.diff(group[rows]) != 0) | (np.diff(node[rows]) != 0)])] if len(rows) else rows
    node, group, sets, t = node[rows], group[rows], [sets[r] for r in rows], t.select(["sig", "copies", "block", "band_no", "low", "high"]).take(pa.array(rows))
    values, copies, side = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(-1, HASHES), t["copies"].to_numpy(), t["block"].to_numpy()
    starts = np.searchsorted(group, np.arange(len(starts)))
    across, band_no = t["low"].to_numpy() != t["high"].to_numpy(), t["band_no"].to_numpy()
    found = [candidates(values, band_no, i, j, looks) for i, j in pairs_of(starts, side, across)]
    if not found:
        return
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(group[i], kind="stable")
    i, j = i[order], j[order]
    edges = np.flatnonzero(np.diff(group[i], prepend=-1)) if len(i) else []
    for a, b in zip(edges, [*edges[1:], len(i)], strict=True):
        g = group[i[a]]
        low, high = starts[g], starts[g + 1]
        x, y, own = i[a:b] - low, j[a:b] - low, sets[low:high]
        size, both = np.array([s.size for s in own]), common_sizes(own, x, y)
        similar = both / (size[x] + size[y] - both)
        stay = similar >= threshold
        if stay.any():
            yield node[low:high], copies[low:high], x[stay], y[stay], similar[stay]


def least_reach(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of the n places that each is linked with, directly or by others."""
    label = np.arange(n)
    while True:
        now = label.copy()
        np.minimum.at(now, i, label[j])
        np.minimum.at(now, j, label[i])
        now = now[now]
        if (now == label).all():
            return label
        label = now


def _members(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, key (of id and text), shape (128 bits of its set of shingles; null without words), length and signature of each row."""
    names = ["doc_id", "key", "shape", "length", "sig"]

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shapes, lengths, sigs = [], [], []
            for text in b.column("text").cast(pa.binary()).to_pylist():
                found = shingles(text or b"", k)
                shapes.append(set_hash(found) if found.size else None)
                lengths.append(len(text or b""))
                sigs.append(signature(found).tobytes() if found.size else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(shapes, pa.binary()), pa.array(lengths, pa.int32()), pa.array(sigs, pa.binary())], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key_of().alias("key"), "text")
    return written(map_texts(rows, sign, "doc_id long, key long, shape binary, length int, sig binary"), "ngram-members")


def _shapes(members: DataFrame) -> DataFrame:
    """A row for each set of shingles: node (a number for it), shape, copies, first (no_id, doc_id, key), length and sig."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    shapes = members.filter("shape is not null").groupBy("shape").agg(F.count("*").alias("copies"), first, F.max("length").alias("length"), F.first("sig").alias("sig"))
    return written(shapes.select(F.monotonically_increasing_id().alias("node"), "shape", "copies", "first", "length", "sig"), "ngram-shapes")


def _placed(shapes: DataFrame) -> DataFrame:
    """A row for each shape in each pair of blocks of each band that it shares with another shape."""
    values = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)])
    banded = shapes.withColumn("key", F.col("first.key")).select("node", "shape", "copies", "key", "length", "sig", F.posexplode(values).alias("band_no", "band"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
    shared = banded.groupBy("band_no", "band").agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).filter("n > 1")
    shared = written(shared.select("band_no", "band", blocks), "ngram-bands")
    if fits(shared):
        rows = banded.join(F.broadcast(shared), ["band_no", "band"])
    else:  # signatures are not moved with every band
        rows = banded.select("node", "band_no", "band").join(shared, ["band_no", "band"]).join(shapes.select("node", "shape", "copies", F.col("first.key").alias("key"), "sig"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("band_no", "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "key", "shape", "copies", "sig")


def _pruned(placed: DataFrame, looks: list[tuple[int, int]]) -> DataFrame:
    """The rows that have a partner in their group whose similarity may reach the threshold; signatures alone are moved."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches):
            values = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(-1, HASHES)
            side, across, band_no, hit = t["block"].to_numpy(), t["low"].to_numpy() != t["high"].to_numpy(), t["band_no"].to_numpy(), np.zeros(t.num_rows, bool)
            for i, j in pairs_of(starts, side, across):
                i, j = candidates(values, band_no, i, j, looks)
                hit[i] = hit[j] = True
            yield from t.filter(pa.array(hit)).to_batches()

    return written(placed.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(look, placed.schema), "ngram-candidates")


def _links(docs: DataFrame, shapes: DataFrame, k: int, threshold: float, tolerance: float, want_pairs: bool) -> DataFrame:
    """(node, other, amount). For pairs: nodes and their similarity. Else other is the smallest node that links have joined node with
    in its group, and amount the number of documents that it is linked with there: no more rows than texts compared."""
    looks = least_matches(threshold, tolerance)
    some = _pruned(_placed(shapes), looks)

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches):
            for node, copies, i, j, similar in linked(t, starts, k, threshold, looks):
                if want_pairs:
                    out = node[i], node[j], similar
                else:
                    n = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
                    hit = np.flatnonzero(n)
                    out = node[hit], node[least_reach(len(node), i, j)[hit]], n[hit]
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(out[2].astype(float))], names=["node", "other", "amount"])

    texts = docs.select(key_of().alias("key"), "text").join(small_side(some), "key").drop("key")
    found = written(map_texts(texts.repartition(*_GROUP).sortWithinPartitions(*_GROUP), verify, "node long, other long, amount double"), "ngram-links")
    forget(some)
    return found


def near_groups(docs: DataFrame, k: int = WORDS, threshold: float = SIMILARITY, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, key, class_id, copy_of, copies, n_links, kept.

    Two documents are linked if the sets of their runs of k words (\\x20, \\x09-\\x0D part words; fewer words make one run) have a Jaccard
    similarity of threshold or more. n_links: other documents linked with this one. class_id: the smallest doc_id in reach by links.
    copy_of, copies: the smallest doc_id and the number of documents with the very same set (by 128 bits of its hash); those are linked without
    comparison. Texts without words, null ones too, are linked with nothing and a class of their own. key is xxhash64 of doc_id and text; kept is
    true for the key of the class's smallest doc_id (of several, the smallest key). A null doc_id comes after all others. Other columns are
    ignored. No rows in, no rows out.

    Texts that share a band of MinHash values are compared, each pair in its first common band. A band's texts are split into blocks by number and
    bytes, and a task compares two blocks, so that neither its memory nor the number of rows depends on the pairs of a large group. First
    signatures alone are moved: pairs are dropped as soon as the posterior probability that they reach the threshold falls below
    tolerance. Texts are fetched for those that still have a partner, and verified on the sets themselves.
    """
    members = _members(docs, k)
    shapes = _shapes(members)
    found = _links(docs, shapes, k, threshold, tolerance, False)
    roots = components(found.select(F.col("node").alias("u"), F.col("other").alias("v")))
    links = found.groupBy("node").agg(F.sum("amount").cast("long").alias("links")).join(roots, "node")
    several = shapes.select("node", "shape", "copies", "first").join(links, "node", "left").filter("copies > 1 or links is not null")
    several = written(several.select("shape", "copies", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")), "ngram-several")
    forget(found, shapes)
    heads = several.groupBy("root").agg(F.min("first").alias("head"))
    info = several.join(heads, "root").select("shape", "copies", "links", F.col("first.doc_id").alias("copy_of"), F.col("head.doc_id").alias("class_id"), F.col("head.key").alias("head"), F.lit(True).alias("grouped"))
    info, rows = written(info, "ngram-classes"), members.select("doc_id", "key", "shape")
    forget(several)
    rows = rows.join(F.broadcast(info), "shape", "left") if fits(info) else join_counted(rows, info, ["shape"], "copies", members.stored.rows)
    alone = F.col("grouped").isNull()
    return rows.select(
        "doc_id",
        "key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("key") == F.col("head"), F.lit(True)).alias("kept"),
    )


def similar_pairs(docs: DataFrame, k: int = WORDS, threshold: float = SIMILARITY, tolerance: float = TOLERANCE) -> DataFrame:
    """(left_id, right_id, similarity) between the smallest doc_ids of different sets of shingles, as near_groups links them; left_id < right_id."""
    shapes = _shapes(_members(docs, k))
    found = _links(docs, shapes, k, threshold, tolerance, True)
    ids = shapes.select("node", F.col("first.doc_id").alias("id"))
    a, b = ids.select("node", F.col("id").alias("a")), ids.select(F.col("node").alias("other"), F.col("id").alias("b"))
    return found.join(a, "node").join(b, "other").select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id"), F.col("amount").alias("similarity"))


def drop_near_copies(docs: DataFrame, k: int = WORDS, threshold: float = SIMILARITY, tolerance: float = TOLERANCE) -> DataFrame:
    """docs with one document of each class of near_groups, that of the smallest doc_id, in docs' own columns. Rows alike in doc_id and text are one document."""
    groups = near_groups(docs, k, threshold, tolerance).filter("not kept or copies > 1")
    # Of rows alike in doc_id and text, which have one key, a single one stays.
    what = written(groups.groupBy("key").agg(F.bool_and("kept").alias("once"), F.count("*").alias("n")).filter("not once or n > 1"), "ngram-dropped", once=F.count_if("once"))
    key = spare(docs, "key")
    rows, side = docs.withColumn(key, key_of()), what.select(F.col("key").alias(key), "once")
    kept = rows.join(small_side(what, side.drop("once")), key, "left_anti")
    if what.stored.found["once"]:
        kept = kept.unionByName(rows.join(small_side(what, side.filter("once").drop("once")), key, "left_semi").dropDuplicates([key]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
