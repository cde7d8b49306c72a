"""Prefix trie, hard negatives and pair ranking against brute force and held-out labels."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, pair_ranking, prefix_trie
from tidemark.llm.common import table

TURNS = "conv_id long, turn long, role string, text string, n_convs int"
VECTORS = "vec_id long, embedding array<float>, label int, score string"


def trie(rows):
    by = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            by[c].append(((t is not None, t or 0), hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), (r, x)))
    own = {c: [z for _, _, z in sorted(v)] for c, v in by.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[c][h:])
    members, kids, below, out = defaultdict(list), defaultdict(list), {}, []
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        n = len(members[k])
        below[k] = sum(below[x][0] for x in kids[k]) or 1, sum(below[x][1] for x in kids[k]) + (n - 1) * (len(k[-1][1].encode()) if k else 0)
        ends = ",".join(map(str, sorted(c for c in members[k] if len(built[c]) == len(k))))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, n, len(kids[k]), *below[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", None, "a"]), rng.choice(["x", "yy", None, "é"]), 7) for c in range(-20, 200) for t in rng.sample([None, *range(12)], rng.randint(1, 9))]
    rows += [(1000 + k, t, "u", "same", 7) for k in range(150) for t in range(3)]  # a third of all are copies
    rows += [(5000, t, "u", "long " * t, 7) for t in range(400)] + [(5001, 1, "u", "x" * 100_000, 7)]
    return rows + [(None, 1, "u", "x", 7)] * 3 + rows[:20]


@pytest.mark.parametrize(("least", "fan"), [(1 << 18, 64), (2000, 2), (300, 3)])
def test_trie(spark, least, fan):
    rows = conversations(least)
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS), least_bytes=least, fan=fan)
    assert sorted(map(tuple, got.collect()), key=str) == trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "x", 7)], TURNS)).collect() == []
    one = prefix_trie.prefix_trie(spark.createDataFrame([(3, None, None, None, 7)], TURNS)).collect()
    assert sorted(map(tuple, one), key=str) == trie([(3, None, None, None, 7)])


def test_runs_merge_in_order_with_their_prefixes():
    rng = random.Random(3)
    rows = [(b"".join(bytes([rng.randint(0, 2)]) * 16 for _ in range(rng.randint(0, 6))), k, []) for k in range(500)]
    for size in (1, 7, 64, 500):
        got = list(prefix_trie.merged([prefix_trie.Run(rows[k : k + size]) for k in range(0, 500, size)]))
        assert [r for _, r in got] == sorted(rows)
        for (_, a), (n, b) in zip(got, got[1:], strict=False):
            same = [a[0][:d] == b[0][:d] for d in range(0, min(len(a[0]), len(b[0])) + 1, 16)]
            assert n == sum(same) - 1


def negatives(rows):
    seen = {}
    for v, x, label, *_ in rows:
        if v is not None and label is not None and x is not None and all(c is not None and np.isfinite(c) for c in x):
            q = tuple(int(np.floor(256 * float(np.float32(c)))) for c in x)
            seen[(v, (label + 1) % 10 if v % 7 == 0 else label, q)] = 1
    width, out = max([len(q) for _, _, q in seen], default=1), []
    every = [(v, label, np.array(q + (0,) * (width - len(q)), np.int64)) for v, label, q in sorted(seen)]
    for v, label, q in every:
        if v % 100 == 0:
            near = sorted((-int(q @ o), w, m) for w, m, o in every if w != v)
            for s, p, _ in [x for x in near if x[2] == label][:5]:
                fit = [(t, w) for t, w, m in near if m != label and 80 * -s <= 100 * -t <= 100 * -s][:5]
                out += [(v, p, k, w, -s, -t) for k, (t, w) in enumerate(fit, 1)]
    return sorted(out)


def embeddings(seed, clusters):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, 6))
    rows = [(int(k), [float(c) for c in np.float32(centres[k % clusters] + 0.05 * rng.normal(size=6))], int(k % 3), "x") for k in range(0, 6000, 5)]
    rows += [(20_000 + k, [1.0, 0.5, 0.0, 0.0, 0.25, 0.0], k % 2, "x") for k in range(400)]  # a group of copies, all ties
    rows += [(100, None, 1, "x"), (200, [1.0, None], 1, "x"), (300, [float("nan")] * 6, 1, "x"), (None, [1.0] * 6, 1, "x"), (400, [1.0] * 6, None, "x"), (500, [], 1, "x"), (600, [0.5, 0.5], 1, "x")]
    return rows + rows[:50]


@pytest.mark.parametrize(("anchors", "block"), [((64, 16384), (1024, 16384)), ((4, 4), (100, 100))])
def test_hard_negatives(spark, anchors, block):
    rows = embeddings(1, 12)
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(3), anchors=anchors, block=block)
    assert sorted(map(tuple, got.collect())) == negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    assert hard_negatives.hard_negatives(spark.createDataFrame([(100, [1.0], 1, "x")], VECTORS)).collect() == []
    with pytest.raises(ValueError, match="exact"):
        hard_negatives.hard_negatives(spark.createDataFrame([(100, [1e20], 1, "x")], VECTORS))


def test_bounds_keep_far_candidates_away(spark):
    """Where vectors form clusters, few groups get a candidate; on all of them the result is that of brute force (above)."""
    rows = spark.createDataFrame(embeddings(2, 12)[:1200], VECTORS)
    stored = hard_negatives.written(hard_negatives.vectors(rows), "v", top=F.max("norm"), size=F.max(F.octet_length("vec")))
    space = hard_negatives.space_of(stored)
    places = hard_negatives.written(hard_negatives.placed(stored, space), "p")
    cells = {r.own_cell: r.n for r in places.filter("vec_id % 100 = 0").groupBy("own_cell").agg(F.count("*").alias("n")).collect()}
    groups = hard_negatives.groups_of(cells, space.pivots, 4)
    assert sum(p for _, p in groups) >= 10
    far = np.full((hard_negatives.LABELS, len(space.pivots)), -np.inf)
    far[:, list(cells)] = 200.0
    sent = hard_negatives.sent_to(places, space, groups, 2, far).count() + hard_negatives.sent_to(places, space, groups, 2, None, home=True).count()
    assert places.stored.rows <= sent * 2 and sent < 0.5 * places.stored.rows * len(groups)


def test_registered_queries_agree_with_brute_force(spark):
    turns = table(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    con = duckdb.connect()
    con.execute("create view conversations as select * from '/root/testdata/sf0.01/conversations.parquet'")
    assert sorted(con.execute(prefix_trie.ORACLE).fetchall(), key=str) == trie(rows)
    vectors = [(r.vec_id, r.embedding, r.label) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    con.execute("create view embeddings as select * from '/root/testdata/sf0.1/embeddings.parquet'")
    want = negatives(vectors)
    assert sorted(con.execute(hard_negatives.ORACLE).fetchall()) == want
    got = hard_negatives.hard_negatives(table(spark, "/root/testdata/sf0.1", "embeddings"), anchors=(4, 4), block=(256, 256))
    assert sorted(map(tuple, got.collect())) == want


def test_ranking_on_held_out_labels(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    got = pair_ranking.quality_ranking(docs, labels).join(labels, "doc_id").filter("held_out")
    right = got.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("share"), F.min("score"), F.max("score")).collect()
    assert len(right) == 2 and all(r.share >= 0.97 for r in right)


def test_ranking_of_odd_rows(spark):
    docs = spark.createDataFrame([(k, t, "l", "s", 1.0) for k, t in [(1, None), (2, ""), (None, "good words here"), (3, "x " * 50_000), (3, "x " * 50_000), (4, "bad | bad | bad")]], "doc_id long, text string, lang string, source string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = pair_ranking.quality_ranking(docs, none).collect()
    assert len(got) == 6 and all(r.score == 0.5 for r in got) and [r.held_out for r in got if r.doc_id is None] == [True]
    some = spark.createDataFrame([(1, 1, None), (2, 0, None), (3, 1, 0), (3, None, 0), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = pair_ranking.quality_ranking(docs, some)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.collect())
    assert pair_ranking.keep_best(docs, some).columns == docs.columns
    assert pair_ranking.quality_ranking(docs.limit(0), some).count() == 0


def test_cut_and_rank():
    strengths, weights = np.array([3.0, 1.0, 2.0, 0.0]), np.ones(4)
    assert pair_ranking.cut(strengths, weights, 0.5) == 1.5 and pair_ranking.cut(strengths, np.array([1.0, 1.0, 1.0, 3.0]), 0.5) == 0.5
    rng = np.random.default_rng(0)
    good, bad = rng.normal(size=(300, 5)) + [1, 0, 0, 0, -1], rng.normal(size=(300, 5))
    w = pair_ranking.rank(good, bad)
    assert w[0] > 0.5 and w[4] < -0.5 and abs(w[1:4]).max() < 0.4


def test_ranking_learns_of_all_rows(spark):
    """Each labelled row takes part, whatever the size of a block: its pairs are drawn, and the quantile is that of all rows."""
    good, bad = np.zeros((3000, 2), np.float32), np.zeros((3, 2), np.float32)
    good[1234, 1] = 50.0  # one row alone has the second feature
    assert pair_ranking.rank(good, bad, pairs=10, steps=1)[1] != 0
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=9000), np.full(500, 0.25), np.full(500, 1e-9)])
    some = spark.createDataFrame([(float(x),) for x in values], "s double").repartition(7)
    down = np.sort(values)[::-1]
    for above in (1, 17, 4400, 5000, 9999):
        assert pair_ranking._quantile(some, above, float(values.min()), float(values.max())) == (down[above - 1] + down[above]) / 2
    docs = spark.createDataFrame([(k, ("well formed text, in words. " if k % 2 else "x#$% 77 | ## ") * (1 + k % 5)) for k in range(1500)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    for block in (200, 10_000):  # several blocks, and one
        got = pair_ranking.quality_ranking(docs, labels, block).join(labels, "doc_id").filter("held_out")
        assert got.filter("predicted = quality").count() > 0.99 * got.count()
