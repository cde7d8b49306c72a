"""Hard negatives: an exact inner-product join over Voronoi cells, whose bounds say which anchor groups a candidate might serve."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Positives of an anchor, negatives of a positive, and the share of the positive's score, in hundredths, that a negative has at least.
POSITIVES, NEGATIVES, SHARE = 5, 5, 80
#: Rows that the pivots are fitted on (about), rounds of that fit, pivots at most; all rows are assigned to them.
SAMPLE, ROUNDS, PIVOTS = 4096, 5, 512
#: Bounds are kept for each cell and remainder of labels.
LABELS = 64
#: Anchors of a group and candidates of a block: the range within which they follow the number of rows, which bounds a task's memory.
ANCHORS, BLOCK = (64, 16384), (1024, 16384)
#: Scores are worked out in float64, which is exact below.
EXACT = float(1 << 53)
#: Scores of a matrix at once.
_SCORES = 1 << 22
_VECTOR = "vec_id long, label long, vec binary, norm double, h long"


def _clamp(x: int, bounds: tuple[int, int]) -> int:
    return min(bounds[1], max(bounds[0], x))


def vectors(embeddings: DataFrame, labels: int = 10) -> DataFrame:
    """(vec_id, label, vec, norm, h) of the rows that take part: components floor(256 x) as 64-bit integers, their squared norm, and a hash of the row. Labels of ids divisible by 7 move on by one."""
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, (label + 1) % labels).otherwise(label).alias("label"), F.col("embedding").cast("array<double>").alias("x"))

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [np.clip(np.floor(256 * np.asarray(v, np.float64)), -(2.0**62), 2.0**62) for v in b["x"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["vec_id"], b["label"], pa.array([v.astype("<i8").tobytes() for v in x], pa.binary()), pa.array([float(v @ v) for v in x], pa.float64())], names=["vec_id", "label", "vec", "norm"])

    return rows.mapInArrow(packed, "vec_id long, label long, vec binary, norm double").withColumn("h", F.xxhash64("vec_id", "label", "vec"))


class Space:
    """Vectors of one length and their pivots. With a further component that makes all candidates equally long (0 for anchors), the larger an inner product is,
    the smaller is the distance, so that the triangle inequality bounds scores."""

    def __init__(self, dims: int, top: float, largest: int) -> None:
        self.dims, self.top = dims, top
        self.kind = next(k for k, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if largest < 1 << bits)
        self.pivots = np.zeros((0, dims + 1))
        self.slack = 1e-6 * (1 + top**0.5)

    def matrix(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), self.kind).reshape(-1, self.dims)

    def augmented(self, x: np.ndarray, anchors: bool = False) -> np.ndarray:
        last = np.zeros(len(x)) if anchors else np.sqrt(np.maximum(0, self.top - (x.astype(np.float64) ** 2).sum(axis=1)))
        return np.column_stack([x, last])

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, (x**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * x @ self.pivots.T))

    def fit(self, x: np.ndarray, pivots: int, seed: int = 0) -> None:
        """Pivots by a few rounds of k-means on a sample of candidates."""
        x = self.augmented(x)
        self.pivots = x[np.random.default_rng(seed).choice(len(x), min(pivots, len(x)), replace=False)].astype(np.float64)
        for _ in range(ROUNDS):
            near = self.distances(x).argmin(axis=1)
            self.pivots = np.stack([x[near == k].mean(axis=0) if (near == k).any() else p for k, p in enumerate(self.pivots)])


def space_of(rows: DataFrame) -> Space:
    """The space of stored vectors; those shorter than the longest one end in zeros."""
    found = rows.stored.found
    if found["top"] >= EXACT:
        raise ValueError(f"squared norm {found['top']:.3g} of 256 x: scores are exact below {EXACT:.3g} only")
    space = Space(max(1, (found["size"] or 0) // 8), found["top"], isqrt(int(found["top"])) + 1)
    share = min(1.0, SAMPLE / rows.stored.rows)
    some = rows.filter(F.pmod("h", F.lit(1 << 30)) / float(1 << 30) < share).orderBy("h").select("vec").collect() or rows.limit(1).select("vec").collect()
    space.fit(np.stack([_padded(r.vec, space) for r in some]), min(PIVOTS, max(8, isqrt(rows.stored.rows))))
    return space


def _padded(vec: bytes, space: Space) -> np.ndarray:
    v = np.frombuffer(vec, "<i8")
    return v if len(v) == space.dims else np.concatenate([v, np.zeros(space.dims - len(v), np.int64)])


def placed(rows: DataFrame, space: Space) -> DataFrame:
    """rows with the cell of each as a candidate (cell) and as an anchor (own_cell, own_dist); repeats within a batch go, others meet in the join."""
    sent = rows.sparkSession.sparkContext.broadcast(space)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        for b in batches:
            seen = dict.fromkeys(zip(b["vec_id"].to_pylist(), b["label"].to_pylist(), b["vec"].to_pylist(), b["norm"].to_pylist(), b["h"].to_pylist(), strict=True))
            if not seen:
                continue
            ids, labels, vecs, norms, h = (list(c) for c in zip(*seen, strict=True))
            x = np.stack([_padded(v, s) for v in vecs])
            own = s.distances(s.augmented(x, anchors=True))
            arrays = [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array([v.tobytes() for v in x.astype(s.kind)], pa.binary()), pa.array(norms, pa.float64()), pa.array(h, pa.int64())]
            arrays += [pa.array(s.distances(s.augmented(x)).argmin(axis=1).astype("i4")), pa.array(own.argmin(axis=1).astype("i4")), pa.array(own.min(axis=1))]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "vec", "norm", "h", "cell", "own_cell", "own_dist"])

    return rows.mapInArrow(place, f"{_VECTOR}, cell int, own_cell int, own_dist double")


def groups_of(counts: dict[int, int], pivots: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    """(cells, parts) of each group of anchors: neighbouring cells with about size anchors together, or one cell with more, dealt in parts."""
    out, left = [(([c], -(-n // size))) for c, n in sorted(counts.items()) if n > size], {c for c, n in counts.items() if n <= size}
    while left:
        cells, n, at = [], 0, min(left)
        while left and (not cells or n + counts[at] <= size):
            cells.append(at)
            n += counts[at]
            left.discard(at)
            if left:
                rest = sorted(left)
                at = rest[int(((pivots[rest] - pivots[cells[0]]) ** 2).sum(axis=1).argmin())]
        out.append((cells, 1))
    return out


def sent_to(rows: DataFrame, space: Space, groups: list[tuple[list[int], int]], salts: int, far: np.ndarray | None, near: np.ndarray | None = None, home: bool = False) -> DataFrame:
    """Candidates with group and salt, once for each group of anchors that they might serve.

    With home, the groups that have their cell. Else those with a cell whose pivot is no farther than far and no nearer than near, by remainder of the label and
    cell: no other candidate can be among the rows that an anchor there asks for. Without near, groups of their own cell are left out, as they were served before.
    """
    member = np.zeros((len(space.pivots), len(groups)), bool)
    for g, (cells, _) in enumerate(groups):
        member[cells, g] = True
    parts = np.array([p for _, p in groups])
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    sent = rows.sparkSession.sparkContext.broadcast((space, member, parts, first, far, near))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, member, parts, first, far, near = sent.value
        for whole in batches:
            for b in (whole.slice(k, 1024) for k in range(0, whole.num_rows, 1024)):
                at_home = member[b["cell"].to_numpy()]
                if home:
                    serves = at_home
                else:
                    d = s.distances(s.augmented(s.matrix(b["vec"])))
                    of = b["label"].to_numpy() % LABELS
                    might = d <= far[of]
                    if near is not None:
                        might &= d >= near[of]
                    serves = (might.astype(np.float32) @ member.astype(np.float32)) > 0
                    if near is None:
                        serves &= ~at_home
                row, group = np.nonzero(serves)
                again = np.repeat(np.arange(len(row)), parts[group])
                row, group = row[again], first[group][again] + np.concatenate([np.arange(p) for p in parts[group]]) if len(again) else group
                if not len(row):
                    continue
                got = b.take(pa.array(row))
                salt = got["h"].to_numpy().astype(np.uint64) % np.uint64(salts)
                yield pa.RecordBatch.from_arrays([pa.array(group.astype("i4")), pa.array(salt.astype("i4")), got["vec_id"], got["label"], got["vec"]], names=["group", "salt", "vec_id", "label", "vec"])

    return rows.mapInArrow(send, "group int, salt int, vec_id long, label long, vec binary")


def _distinct(c: pa.Table) -> pa.Table:
    """Candidates by vec_id, each row once."""
    keys = list(zip(c["vec_id"].to_pylist(), c["label"].to_pylist(), c["vec"].to_pylist(), strict=True))
    return c.take(pa.array(sorted({k: i for i, k in enumerate(keys)}.values(), key=lambda i: keys[i])))


def _scores(space: Space, anchors: pa.Table, c: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    a, b = space.matrix(anchors["vec"]).astype(np.float64), space.matrix(c["vec"]).astype(np.float64).T
    step = max(1, _SCORES // max(1, b.shape[1]))
    for k in range(0, len(a), step):
        yield from enumerate((a[k : k + step] @ b).astype(np.int64), k)


def nearest(candidates: DataFrame, anchors: DataFrame, space: Space, salts: int, most: int) -> DataFrame:
    """(anchor_id, anchor_h, positive_id, positive_score): of each anchor the best rows of its label in each block."""
    sent = anchors.sparkSession.sparkContext.broadcast(space)

    def join(a: pa.Table, c: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and c.num_rows:
            c = _distinct(c)
            ids, labels = c["vec_id"].to_numpy(), c["label"].to_numpy()
            own, of, h = a["vec_id"].to_pylist(), a["label"].to_pylist(), a["h"].to_pylist()
            for i, s in _scores(sent.value, a, c):
                some = np.flatnonzero((labels == of[i]) & (ids != own[i]))
                if len(some) > most:  # all that are as good as the last of the best, then ties by id
                    some = some[s[some] >= np.partition(s[some], -most)[-most]]
                out += [(own[i], h[i], int(ids[k]), int(s[k])) for k in some[np.argsort(-s[some], kind="stable")][:most]]
        return pa.table([pa.array(list(x), pa.int64()) for x in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4, names=["anchor_id", "anchor_h", "positive_id", "positive_score"])

    return _with_salts(anchors.select("vec_id", "label", "vec", "h", "group"), salts).cogroup(candidates.groupBy("group", "salt")).applyInArrow(join, "anchor_id long, anchor_h long, positive_id long, positive_score long")


def _with_salts(anchors: DataFrame, salts: int):
    return anchors.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).groupBy("group", "salt")


def best(found: DataFrame, most: int) -> DataFrame:
    """The first `most` of each anchor, with their place from 1."""
    order = Window.partitionBy("anchor_id", "anchor_h").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def harder(candidates: DataFrame, asked: DataFrame, space: Space, salts: int, most: int, share: int) -> DataFrame:
    """Of each anchor and positive the first rows of other labels, in each block, that score no more than the positive and no less than share hundredths of it."""
    sent = asked.sparkSession.sparkContext.broadcast(space)
    names = ["anchor_id", "anchor_h", "place", "positive_id", "positive_score", "negative_id", "negative_score"]

    def join(a: pa.Table, c: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and c.num_rows:
            c = _distinct(c)
            ids, labels = c["vec_id"].to_numpy(), c["label"].to_numpy()
            own, of, h, positives = (a[x].to_pylist() for x in ("vec_id", "label", "h", "positives"))
            for i, s in _scores(sent.value, a, c):
                scores = [p["positive_score"] for p in positives[i]]
                some = np.flatnonzero((labels != of[i]) & (100 * s >= share * min(scores)) & (s <= max(scores)))
                some = some[np.argsort(-s[some], kind="stable")]
                for p in positives[i]:
                    fit = some[(s[some] <= p["positive_score"]) & (100 * s[some] >= share * p["positive_score"])][:most]
                    out += [(own[i], h[i], p["place"], p["positive_id"], p["positive_score"], int(ids[k]), int(s[k])) for k in fit]
        return pa.table([pa.array(list(x), pa.int64()) for x in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 7, names=names)

    return _with_salts(asked.select("vec_id", "label", "vec", "h", "group", "positives"), salts).cogroup(candidates.groupBy("group", "salt")).applyInArrow(join, ", ".join(f"{n} long" for n in names))


def _bounds(rows: DataFrame, space: Space, **columns) -> dict[str, np.ndarray]:
    """Bounds by remainder of the label and cell; -inf where there are none."""
    got = rows.groupBy(F.pmod("label", F.lit(LABELS)).alias("of"), "own_cell").agg(*[c.alias(k) for k, c in columns.items()]).collect()
    out = {k: np.full((LABELS, len(space.pivots)), -np.inf) for k in columns}
    for r in got:
        for k in columns:
            out[k][r["of"], r["own_cell"]] = r[k]
    return out


def hard_negatives(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = SHARE, anchors: tuple[int, int] = ANCHORS, block: tuple[int, int] = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, whose vec_id is divisible by 100.

    Rows without vec_id, label or a wholly finite vector take no part; a vector shorter than others ends in zeros. Rows alike in id, label and vector are one; rows of one id that
    differ are rows of their own, and an anchor is no partner of rows with its id. A positive of negative score has no negatives. Extra columns are not read. No anchors, no rows.

    An anchor first meets the candidates of its own group's cells: its positives there bound the distance of the true ones, and only candidates within that distance of the group's
    cells follow. Its true positives then bound the scores that negatives may have. Groups, blocks and cells are bounded, so that a hot label or a group of copies is spread over blocks by a hash.
    """
    spark = embeddings.sparkSession
    rows = written(vectors(embeddings), "vectors", top=F.max("norm"), size=F.max(F.octet_length("vec")), anchors=F.count_if(F.col("vec_id") % 100 == 0))
    if not rows.stored.found["anchors"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    space = space_of(rows)
    places = written(placed(rows, space), "vector-places")
    n = places.stored.rows
    salts = -(-n // _clamp(n // 128, block))
    own = places.filter("vec_id % 100 = 0").dropDuplicates(["vec_id", "label", "vec"])
    counts = {r["own_cell"]: r["n"] for r in own.groupBy("own_cell").agg(F.count("*").alias("n")).collect()}
    groups = groups_of(counts, space.pivots, _clamp(rows.stored.found["anchors"] // 64, anchors))
    of, at = {}, 0
    for cells, parts in groups:
        of |= {c: (at, parts) for c in cells}
        at += parts
    where = F.create_map(*[F.lit(x) for c, (g, p) in of.items() for x in (c, f"{g} {p}")])[F.col("own_cell")]
    numbers = F.split(where, " ")
    own = written(own.withColumn("group", (numbers[0].cast("int") + F.pmod("h", numbers[1].cast("int"))).cast("int")).drop("cell"), "anchors")
    candidates = places.select("vec_id", "label", "vec", "h", "cell")

    home = written(nearest(sent_to(candidates, space, groups, salts, None, home=True), own, space, salts, positives), "positives-home")
    far = F.col("own_dist") + F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + space.top - 2 * F.col("score"))) + space.slack
    last = best(home, positives).groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_h").alias("h")).agg(F.min("positive_score").alias("score"), F.count("*").alias("n"))
    last = own.join(last, ["vec_id", "h"], "left")
    bound = _bounds(last, space, far=F.max(F.when(F.col("n") >= positives, far).otherwise(F.lit(float("inf")))))
    more = nearest(sent_to(candidates, space, groups, salts, bound["far"]), own, space, salts, positives)
    true = written(best(home.unionByName(more), positives), "positives")

    by = true.filter("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_h").alias("h")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    asked = written(own.join(by, ["vec_id", "h"]), "anchors-asked")
    if not asked.stored.rows:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    away = lambda score: F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + space.top - 2 * score))
    scores = F.transform("positives", lambda p: p["positive_score"])
    bound = _bounds(asked, space, far=F.max(F.col("own_dist") + away(F.array_min(scores) * (share / 100)) + space.slack), near=F.min(away(F.array_max(scores)) - F.col("own_dist") - space.slack))
    # A negative has another label: what counts is the loosest bound of a cell. Cells without anchors keep -inf and serve nobody.
    loosest = np.tile(bound["far"].max(axis=0), (LABELS, 1))
    closest = np.tile(np.where(np.isinf(bound["near"]), np.inf, bound["near"]).min(axis=0), (LABELS, 1))
    found = harder(sent_to(candidates, space, groups, salts, loosest, closest), asked, space, salts, negatives, share)
    order = Window.partitionBy("anchor_id", "anchor_h", "place").orderBy(F.desc("negative_score"), "negative_id")
    out = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
 p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
 SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
 FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
 WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5"""
