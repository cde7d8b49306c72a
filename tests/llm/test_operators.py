"""The text operators against brute force on small tables, and on rows that are odd."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import components, exact_dedup, license_scan, line_templates, mixing, ngram_join, quality, sharding, shingles, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, key string, n_chars long"


def near_texts():
    rnd = random.Random(3)
    base = [[f"w{rnd.randrange(500)}" for _ in range(120)] for _ in range(6)]
    out = []
    for words in base:
        for changes in range(6):
            w = list(words)
            for _ in range(changes):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(99)}"
            out.append(" ".join(w))
    return [*out, out[0], out[0].replace(" ", "\n"), "one two", "one  two", "one", "", " \n", None, "ä" * 30000, "long " * 30000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}", "k", 0) for i, t in enumerate(near_texts())]
    return spark.createDataFrame([*rows, rows[2], (None, "one two three", None, None, None, None)], SCHEMA).repartition(3)


def sets_of(rows):
    out = []
    for r in rows:
        w = WORDS.findall(r.text or "")
        k = min(5, len(w))
        out.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if k else frozenset())
    return out


def test_near_groups(spark, docs):
    rows = docs.collect()
    sets = sets_of(rows)
    links, top = Counter(), list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
            links[i] += 1
            links[j] += 1
            old, new = top[j], top[i]
            top = [new if t == old else t for t in top]
    ids = lambda at: min((rows[i].doc_id for i in at if rows[i].doc_id is not None), default=None)
    want = sorted(((r.doc_id, ids([j for j in range(len(rows)) if top[j] == top[i]]), links[i]) for i, r in enumerate(rows)), key=str)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join.near_groups(docs).collect()), key=str) == want
    left = ngram_join.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == len(set(top))
    assert ngram_join.near_groups(docs.limit(0)).collect() == []
    assert all(r.similarity >= 0.8 for r in ngram_join.similar_pairs(docs).collect())


def test_blocks(spark):
    """A group over many blocks has all of its links."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:100], f"n{i}", *words[100:]])) for i in range(400)]
    got = ngram_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 399)}


def test_least_matches():
    for n, m in ngram_join.least_matches(0.8, 1e-4):
        grid = np.linspace(0, 1, 20001)
        for k in range(m - 2 if m > 2 else 0, min(n, m + 2) + 1):
            density = grid**k * (1 - grid) ** (n - k)
            assert (density[grid >= 0.8].sum() / density.sum() >= 1e-4) == (k >= m)


def test_minhash():
    a, b = (shingles.mix(np.arange(x, x + 1000, dtype=np.uint64)) for x in (0, 200))
    assert abs((shingles.minhash(a) == shingles.minhash(b)).mean() - 800 / 1200) < 0.15


def test_components(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 1)]
    got = dict(components.components(spark.createDataFrame(pairs, "u long, v long")).collect())
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_lines(spark):
    texts = [f"my own {chr(97 + i)} line\nuser name{chr(97 + i)} logged in from host alpha today\nPage {i} of 20\n\nshared line here" for i in range(8)]
    rows = [(i, t, 1, 0) for i, t in enumerate(texts)] + [(90, None, 1, 0), (91, "", 1, 0), (92, "x " * 20000, 1, 0), (None, "alone", 1, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, line int, n_chars long")
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(df, leading=1).collect()}
    assert got[0].text == texts[0]
    assert all(got[i].text == f"my own {chr(97 + i)} line\n" and got[i].n_chars == len(got[i].text) for i in range(1, 8))
    assert (got[90].text, got[91].text, got[92].text, got[None].text) == (None, "", "x " * 20000, "alone")
    gone = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(df, leading=1, keep_first=False).collect()}
    assert gone[0] == "my own a line\n"
    assert {r.doc_id: r.n_dropped for r in line_templates.line_report(df, leading=1).collect()} == {0: 0, 90: 0, 91: 0, 92: 0, None: 0} | dict.fromkeys(range(1, 8), 3)
    assert line_templates.line_report(df.limit(0)).collect() == []


@pytest.mark.parametrize("n", [300, 3000])
def test_fields_at_any_size(spark, n):
    """Fields without digits vary at any size of the table, with production parameters; also among the first words and beside a template of other size."""
    rnd = random.Random(n)
    name = lambda: "".join(chr(97 + int(x)) for x in f"{rnd.randrange(200):03d}")
    lines = lambda: [f"the session of user {name()} was opened from city {name()} this morning", f"{name()} has left the building through the main door", "the session of user one has ended in {} way and nothing".format(rnd.choice(["good", "bad"]))]
    rows = [(i, "\n".join([*(lines()[:2]), *(lines()[2:] if i < 20 else [])])) for i in range(n)]
    got = line_templates.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).agg(F.sum("n_dropped")).first()[0]
    assert got >= 2 * n + 20 - 5


def test_long_lines(spark):
    """A line of 20 words goes from the second document on, one of 19 stays; both with production parameters."""
    passage = lambda n: " ".join(chr(97 + i) * 3 for i in range(n))
    rows = [(i, f"{'xyz'[i] * 4} own words\n{passage(20)}\n{passage(19)}\n{passage(21).replace('nnn', 'uvw'[i] * 5)}") for i in range(2)]
    got = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: rows[0][1], 1: f"yyyy own words\n{passage(19)}"}


def test_quality(spark, docs):
    for r in quality.quality(docs).join(docs.select(F.col("doc_id").alias("d"), "text").distinct(), F.col("doc_id").eqNullSafe(F.col("d"))).collect():
        text = r.text or ""
        w = WORDS.findall(text)
        seen = Counter(zip(w, w[1:], w[2:]))
        repeated = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 50 or 2 * len(repeated) > len(w)) and not (r.base_failed and r.kept)
    assert quality.quality(docs.limit(0)).collect() == []


def test_robust_distances(spark):
    """Outliers of an eighth of the rows neither move the centre nor hide."""
    rnd = np.random.default_rng(1)
    good = rnd.multivariate_normal([0, 0], [[1, 0.8], [0.8, 1]], 700)
    rows = [("g", float(a), float(b)) for a, b in [*good, *rnd.normal(9, 0.1, (100, 2)) * [1, -1]]]
    est = quality.robust_estimates(spark.createDataFrame(rows, "group string, a double, b double"), ["a", "b"]).first()
    assert abs(est.m_a) < 0.2 and abs(est.m_b) < 0.2
    p = np.linalg.inv(np.array([[est.p_0_0, est.p_1_0], [est.p_1_0, est.p_1_1]]))
    assert np.allclose(p / p[0, 0], [[1, 0.8], [0.8, 1]], atol=0.15)
    assert abs(quality.chi_square_quantile(0.95, 5) - 11.0705) < 1e-3


def least_determinant(x, core):
    """The same starts and steps in numpy: (mean, covariance) of the core share with the least determinant."""
    h, k = math.ceil(core * len(x)), x.shape[1]
    unit = x / np.maximum(np.linalg.norm(x, axis=1), 1e-6)[:, None]
    near = lambda m, c: np.argsort(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c + quality.SAFEGUARD * np.eye(k)), x - m), kind="stable")[:h]
    found = []
    for c in (np.eye(k), np.cov(unit.T, bias=True), np.cov(np.tanh(x).T, bias=True)):
        m = np.zeros(k)
        for _ in range(30):
            at = near(m, c)
            m, c = x[at].mean(axis=0), np.cov(x[at].T, bias=True)
        found.append((np.linalg.slogdet(c + quality.SAFEGUARD * np.eye(k))[1], m, c))
    return min(found, key=lambda f: f[0])[1:]


def test_covariance_determinant(spark):
    """Estimates of two groups against numpy, which takes every start to its end."""
    rnd = np.random.default_rng(2)
    data = {g: np.concatenate([rnd.normal(0, 1, (300, 3)) @ np.triu(rnd.normal(0, 1, (3, 3)) + 2 * np.eye(3)), rnd.normal(6, 1, (40, 3))]) for g in "xy"}
    df = spark.createDataFrame([(g, *map(float, r)) for g, x in data.items() for r in x], "group string, a double, b double, c double")
    for est in quality.robust_estimates(df, ["a", "b", "c"]).collect():
        m, c = least_determinant(data[est.group], quality.CORE)
        assert np.allclose([est.m_a, est.m_b, est.m_c], m, atol=1e-6)
        p = [[est[f"p_{max(i, j)}_{min(i, j)}"] for j in range(3)] for i in range(3)]
        assert np.allclose(np.linalg.inv(p), c + quality.SAFEGUARD * np.eye(3), atol=1e-5)


def test_outliers_of_a_source(spark):
    """Rows that are usual in one source are rejected in another of the same language; a source's own estimates need rows enough. Most distances are as chi-square's."""
    rnd = random.Random(8)
    words = {n: ["".join(rnd.choice("abcdefghijk") for _ in range(max(1, round(rnd.gauss(n, 1.5))))) for _ in range(400)] for n in (5, 9)}
    word = lambda n: rnd.choice(words[n])
    text = lambda n, size: ". ".join(" ".join(word(n) for _ in range(rnd.randrange(6, 13))).capitalize() for _ in range(size // 9)) + "."
    rows = [(i, text(5, rnd.randrange(90, 400)), "en", "short") for i in range(150)] + [(1000 + i, text(9, rnd.randrange(90, 400)), "en", "long") for i in range(150)]
    rows += [(2000 + i, text(9, 200), "en", "short") for i in range(8)] + [(3000, text(9, 200), "en", "rare"), (4000, text(5, 200), None, None), (5000, "| ".join(word(5) for _ in range(200)), "en", "short")]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)).collect()}
    assert not any(got[2000 + i].kept for i in range(8)) and not got[5000].kept and got[3000].kept
    assert (got[0].level, got[3000].level, got[4000].level) == (0, 1, 2)
    usual = sorted(got[i].distance for i in range(150))
    assert sum(got[i].kept for i in range(150)) >= 140 and 3 < usual[75] < 6


def test_toxicity(spark):
    rnd = random.Random(5)
    text = lambda bad: " ".join([*(f"w{rnd.randrange(300)}" for _ in range(40)), *(["nastyword"] if bad else [])])
    rows = [(i, text(i % 3 == 0), "en") for i in range(400)] + [(900, None, "en"), (901, "", "en"), (None, "x", None), (902, "y " * 40000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all((got[i].predicted == 1) == (i % 3 == 0) for i in range(400)) and all(0 <= r.score <= 1 for r in got.values())
    assert got[900].score == got[901].score
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.filter("doc_id % 3 = 0 and doc_id < 400").isEmpty() and left.filter("doc_id % 3 <> 0 and doc_id < 400").count() == 266
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_licences(spark):
    notice = "Released under the MIT License."
    rows = [("a/LICENSE", notice), ("a/b/c/x.py", "print"), ("a/b/COPYING", "All rights reserved."), ("z/y.py", None), (None, notice), ("top.py", ""), ("q/long.py", "word " * 30000 + "\n" + notice)]
    df = spark.createDataFrame([(i, p, t, "l") for i, (p, t) in enumerate(rows)], "doc_id long, p string, text string, license string")
    got = {r.doc_id: (r.license, r.found, r.from_dir) for r in license_scan.license_scan(df, F.col("p")).collect()}
    assert got == {0: ("MIT", "own", None), 1: ("proprietary", "inherited", "a/b"), 2: ("proprietary", "own", None), 3: (None, None, None), 4: ("MIT", "own", None), 5: (None, None, None), 6: ("MIT", "own", None)}
    assert license_scan.license_scan(df.limit(0), F.col("p")).collect() == []


def test_exact(spark, docs):
    rows = docs.collect()
    norm = lambda r: re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
    sizes = Counter(map(norm, rows))
    got = exact_dedup.exact_dedup(docs, hash_all=True).collect()
    assert Counter((r.doc_id, r.group_size, r.text_sha256) for r in got) == Counter((r.doc_id, sizes[norm(r)], hashlib.sha256(norm(r).encode()).hexdigest()) for r in rows)
    assert sum(r.kept for r in got) == len(sizes)


def test_mixing(spark, docs):
    got = mixing.mix(docs).collect()
    per = {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        per.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), rows in per.items():
        assert abs(sum(r.taken for r in rows) - target) <= max(r.size for r in rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(docs.limit(0)).collect() == []
    taken = mixing.take(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r.copies for r in got)


def test_texts_without_id(spark):
    """Texts of equal length with a null or repeated doc_id are mixed each for itself; only rows of the same text are one."""
    rows = [(i, f"t{k} a b", "s") for i in (None, 7) for k in range(40)] + [(None, "t0 a b", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    taken = mixing.take(df, weights=(1,))
    assert sorted(map(str, taken.collect())) == sorted(map(str, df.collect()))
    assert mixing.mix(df).columns == ["doc_id", "size", "source_size", "target", "taken", "source", "copies"]


def test_sharding(spark, docs):
    table = sharding.fill()
    counts = Counter(table)
    assert len(counts) == 64 and max(counts.values()) - min(counts.values()) <= 1
    placed = sharding.place(docs)
    assert placed.count() == docs.count() and placed.filter("shard is null").isEmpty()
    moved = sum(a != b for a, b in zip(table, sharding.fill(sharding.SHARDS[:-1]), strict=True))
    assert moved < 0.1 * len(table)


def test_shards_in_turn(spark):
    """The table against turns that are taken one by one with whole preference lists; placement of odd rows."""
    for shards, slots in ((("a", "b", "c"), 13), (("x",), 7), (sharding.SHARDS[:5], 101)):
        number = lambda what, s: int(hashlib.md5(f"{what}/{s}".encode()).hexdigest()[:15], 16)
        wish = {s: [(number("offset", s) + k * (number("skip", s) % (slots - 1) + 1)) % slots for k in range(slots)] for s in shards}
        table, turn = {}, 0
        while len(table) < slots:
            s = shards[turn % len(shards)]
            table[next(x for x in wish[s] if x not in table)] = turn % len(shards)
            turn += 1
        assert sharding.fill(shards, slots) == [table[x] for x in range(slots)]
    df = spark.createDataFrame([(1, 9, "z"), (1, 8, "y"), (None, 7, "x")], "doc_id long, slot long, shard string")
    got = sharding.place(df).collect()
    assert len(got) == 3 and len({r.shard for r in got if r.doc_id == 1}) == 1 and sharding.place(df.limit(0)).collect() == []


def test_shards_written(spark, tmp_path):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    sharding.write_shards(df, str(tmp_path / "s"), shards=("a", "b", "c"), slots=13)
    got = spark.read.parquet(str(tmp_path / "s"))
    assert got.count() == 500 and {r.shard for r in got.select("shard").distinct().collect()} == {0, 1, 2}


def test_exact_rows(spark, docs, monkeypatch):
    """Which row stays, ties, both ways of joining, digests only where they were needed, no rows."""
    rows = [(5, "a b"), (3, "a  b"), (9, "ab "), (2, "ab "), (None, "a   b"), (7, None), (8, " "), (4, "other"), (6, "ohter"), (6, "x" * 300 + "1"), (1, "x" * 300 + "2")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    group = lambda t: [(i, x) for i, x in rows if norm(x) == norm(t)]
    best = lambda t: min(group(t), key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
    for how in ({}, {"broadcast_bytes": 0}):
        got = exact_dedup.exact_dedup(df, hash_all=True, **how).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == Counter((i, best(t), len(group(t))) for i, t in rows)
        assert sum(r.kept for r in got) == len({norm(t) for _, t in rows}) and all(r.kept == (r.doc_id == r.keep_id) for r in got)
        some = {(r.doc_id, r.text_sha256 is None) for r in exact_dedup.exact_dedup(df, **how).collect()}
        assert some == {(5, False), (3, False), (9, False), (2, False), (None, False), (7, False), (8, False), (4, True), (6, True), (6, False), (1, False)}
    assert exact_dedup.exact_dedup(df.limit(0)).collect() == []
    same = spark.createDataFrame([(1, "same")] * 4, "doc_id long, text string")
    assert sorted(r.kept for r in exact_dedup.exact_dedup(same).collect()) == [False, False, False, True]


def test_texts_out_of_play_are_not_hashed(spark):
    """With more keys than are broadcast a bitmap keeps texts out: all rows of in-play keys are marked, others as good as never."""
    rows = spark.range(20000).selectExpr("id % 15000 as doc_id", "concat('text ', id % 15000) as text").selectExpr("*", "cast(length(text) as long) as n_bytes", "xxhash64(text) as prefix")
    keys = ["n_bytes", "prefix"]
    marked = exact_dedup._marked(rows, rows.groupBy(*keys).count().filter("count > 1"), keys)
    n = {(r.twice, r.marked): r["count"] for r in marked.selectExpr("doc_id < 5000 as twice", "marked").groupBy("twice", "marked").count().collect()}
    assert n[True, True] == 10000 and (True, False) not in n and n.get((False, True), 0) < 10


def test_many_lines_with_cues(spark):
    """Headers of a text of many cue lines are those found line by line, also across the stretches that lines are read in."""
    words = license_scan.VOCABULARY
    lines = [f"license {words[i % len(words)]} {'word ' * (i % 3)}" if i % 5 else "plain words" for i in range(300)] + ["copyright"]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "copyright"), (3, ""), (4, "\n\n"), (5, "no cue")], "key long, text string")
    got = Counter((r.key, r.at, r.n, tuple(r.tokens)) for r in license_scan.headers(df).collect())
    want = Counter()
    for key, text in ((1, lines), (2, ["copyright"])):
        for at, line in enumerate(text):
            for shorter, n in zip((0, *license_scan.LINES), license_scan.LINES):
                tokens = license_scan.tokens_of(" ".join(text[at : at + n]))
                known = len({*tokens} & {*license_scan.VOCABULARY})
                if {*license_scan.tokens_of(line)} & {*license_scan.CUES} and shorter < len(text) - at and len(tokens) <= license_scan.MOST_WORDS and known >= license_scan.KNOWN * len({*tokens}):
                    want[key, at, n, tuple(tokens)] += 1
    assert got == want and len({n for _, _, n, _ in want}) == len(license_scan.LINES) and len(want) > 1000


def test_shuffled_sides(spark, docs, monkeypatch):
    """What is broadcast on small tables gives the same rows when it is shuffled."""
    from tidemark.llm import common

    runs = [lambda: ngram_join.near_groups(docs), lambda: line_templates.line_report(docs), lambda: mixing.mix(docs), lambda: mixing.take(docs), lambda: quality.quality(docs).drop("distance")]
    before = [sorted(map(str, run().collect())) for run in runs]
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(line_templates, "NARROW", -1)
    for run, want in zip(runs, before, strict=True):
        assert sorted(map(str, run().collect())) == want


def test_targets(spark):
    """Targets against levels raised until all is shared out, with capped sources and a null one."""
    rnd = random.Random(4)
    for n in (1, 2, 7, 20):
        sizes = {(f"s{i:02d}" if i else None): rnd.randrange(1, 10 ** rnd.randrange(1, 6)) for i in range(n)}
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
        want = brute.capped_targets(sizes)
        assert all(abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) for r in got) and abs(sum(r.target for r in got) - sum(sizes.values())) < 1e-6 * sum(sizes.values())


def test_clashing_columns(spark):
    """Columns named as an operator might name its own come through."""
    rows = [(i, f"a b c {i}", "s", "en", i, -i, "m") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, key long, __key long, copies string")
    for f in (mixing.take, line_templates.drop_recurring_lines, ngram_join.drop_near_copies):
        got = f(df)
        assert got.columns == df.columns and {(r.key, r["__key"], r.copies) for r in got.collect()} <= {(i, -i, "m") for i in range(6)}


def test_lines_by_brute_force(spark):
    """Templates of several kinds among prose, repeated lines in a text, against the tree said again plainly."""
    rnd = random.Random(6)
    some = lambda n, k=30: " ".join(f"w{chr(97 + rnd.randrange(k) % 26)}{chr(97 + rnd.randrange(k) // 26)}" for _ in range(n))
    name = lambda: "".join(rnd.choice("abcde") for _ in range(4))
    passage = [some(30) for _ in range(4)]
    kinds = [lambda: f"the user {name()} came in through door {name()} of hall", lambda: f"{name()} has left the old building at last", lambda: f"page {rnd.randrange(50)} of 50", lambda: " ".join(name() if i in (7, 15) else w for i, w in enumerate(rnd.choice(passage).split())), lambda: some(rnd.randrange(3, 25), 400), lambda: some(3, 3)]
    texts = ["\n".join(rnd.choice(kinds)() for _ in range(rnd.randrange(1, 9))) for _ in range(120)]
    texts = list(dict.fromkeys([*texts, "", "\n \n", texts[0] + "\n" + texts[0]]))
    want = {t: set(x) for t, x in brute.recurring_lines(texts).items() if x}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = line_templates.drop_recurring_lines(df, keep_first=False).collect()
    left = {t: "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want.get(t, ())) for t, text in enumerate(texts)}
    assert {r.doc_id: r.text for r in got} == left and sum(map(len, want.values())) > 50


def test_real_headers(spark):
    """Wrapped notices, comment marks, titles and whole files; the nearest of several licence files above."""
    mit = next(t for n, t in license_scan.NOTICES if n == "MIT" and len(t) > 500)
    wrap = lambda text, n, mark: "\n".join(mark + " ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    by = lambda name: max((t for n, t in license_scan.NOTICES if n == name), key=len)
    prose = "\n".join(["some words of a file that says nothing of its terms"] * 5)
    rows = [
        ("a/m.py", wrap(mit.replace("Copyright (c)", "Copyright (c) 2021 Jo Doe"), 9, "# ") + "\nimport os\n" + prose, "MIT"),
        ("a/g.c", wrap(by("GPL-3.0"), 12, " * ") + "\n" + prose, "GPL-3.0"),
        ("a/b.c", wrap(by("BSD-3-Clause"), 10, "// "), "BSD-3-Clause"),
        ("a/p.c", wrap(by("Apache-2.0"), 11, ""), "Apache-2.0"),
        ("a/i.js", wrap(by("ISC"), 13, "; "), "ISC"),
        ("a/u.txt", wrap(by("Unlicense"), 10, ""), "Unlicense"),
        ("k/LICENSE", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + wrap(mit.split("Copyright (c) ")[1], 12, ""), "MIT"),
        ("k/LICENSE-2", wrap(by("Apache-2.0"), 11, ""), "Apache-2.0"),
        ("k/x/COPYING", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\nCopyright (C) 1989, 1991 Free Software Foundation, Inc.,\n51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed.", "GPL-2.0"),
        ("k/x/y/z.py", prose, "GPL-2.0"),
        ("k/w/z.py", prose, "MIT"),
        ("q/none.py", prose + "\nthe license of the rights that words have", None),
    ]
    rows.append(rows[0])
    got = license_scan.license_scan(spark.createDataFrame([(i, p, t) for i, (p, t, _) in enumerate(rows)], "doc_id long, p string, text string"), F.col("p")).collect()
    assert {r.doc_id: r.license for r in got} == {i: want for i, (_, _, want) in enumerate(rows)}


def test_toxic_features_and_ratios(spark):
    """Ratios against counts of n-grams as strings; repeated rows count each."""
    texts = [("Bad bad words", 1), ("good words", 0), ("good words", 0), ("", 0), ("ä\tö", 1)]
    grams = lambda t: {f" {t.lower()} "[i : i + n] for n in toxicity.SIZES for i in range(len(t) + 3 - n) if not re.search(r"[\x20\x09-\x0D]", f" {t.lower()} "[i + 1 : i + n - 1])}
    for t, _ in texts:
        assert len(toxicity.features(t)) == len({re.sub(r"[\x20\x09-\x0D]", " ", g) for g in grams(t)})
    got = toxicity.log_ratios(spark.createDataFrame([(t, y) for t, y in texts], "text string, toxic int"))
    p, q = np.ones(toxicity.FEATURES), np.ones(toxicity.FEATURES)
    for t, y in texts:
        (p if y else q)[toxicity.features(t)] += 1
    assert np.allclose(got, np.log((p / p.sum()) / (q / q.sum())), atol=1e-5)
