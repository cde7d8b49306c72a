"""Quality rules: text statistics, fixed base rules, then robust outliers by minimum covariance determinant in each language and source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, forget, small_side, text_or_empty, written

SYMBOLS = "#*$%&|<>"
#: The transformed statistics, and the power of the number of words by which a deviation is scaled: means over a text's words scatter with
#: the root of their number, so that without it every short text would be an outlier, or no long one.
STATISTICS = {"word_length": 0.5, "signs": 0.5, "variety": 0.25, "upper": 0.5, "line_length": 0.0}
#: Rows that a language and source needs for estimates of its own, ten for each statistic; with fewer, the language's are taken, then those of all rows.
LEAST_ROWS = 10 * len(STATISTICS)
#: The share of rows that the estimates rest on; steps taken from each start, and further ones from the best at most.
CORE, FIRST_STEPS, STEPS = 0.75, 2, 12
#: A row goes if its squared distance exceeds this quantile of chi-square.
QUANTILE = 0.999
#: Added to variances of statistics that have been scaled to a deviation of 1, so that the matrix has an inverse.
SAFEGUARD = 1e-6
#: Repeated windows up to which they are looked up one by one.
FEW_REPEATS = 32


def chi_square_cdf(x: float, k: int) -> float:
    """By the series of the incomplete gamma function."""
    term = total = 1.0
    for n in range(1, 400):
        term *= x / (k + 2 * n)
        total += term
    return (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1) * total


def chi_square_quantile(q: float, k: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, k) < q else (low, mid)
    return high


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_signs, n_distinct of each row, by whole text.

    Windows of three words are compared by 64-bit hash, inside their row: neither rows nor windows leave their task. Symbols are counted among the
    signs (all but letters, marks, numbers and spaces), which are few.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", text_or_empty().alias("text"))
    rows = rows.withColumns({
        "words": F.array_remove(F.split("text", f"[{SPACE}]+"), ""),
        "signs": F.regexp_replace("text", rf"[\p{{L}}\p{{M}}\p{{N}}{SPACE}]+", ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")),
    })
    n = F.size("words")
    word = lambda i: F.get(F.col("words"), i)
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("signs") - F.char_length(F.translate("signs", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.char_length("signs").cast("long").alias("n_signs"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))).alias("windows"),
    )
    rows = rows.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array("windows")))
    twice = F.array_distinct(F.filter("sorted", lambda x, k: x == F.get(F.col("sorted"), k + 1)))
    rows = rows.withColumn("twice", F.when(F.col("sorted").isNotNull(), twice))
    # The places of repeated windows: looked up among those found twice, or, where these are many, read off a sort of (hash, place).
    every = F.sequence(F.lit(0), F.size("windows") - 1)
    few = F.filter(every, lambda i: F.array_contains("twice", F.get(F.col("windows"), i)))
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(F.size("twice") > FEW_REPEATS, placed))
    same = lambda x, k: F.coalesce(F.get(F.col("placed"), k)["h"] == x["h"], F.lit(False))
    many = F.sort_array(F.transform(F.filter("placed", lambda x, k: ((k > 0) & same(x, F.greatest(k - 1, F.lit(0)))) | same(x, k + 1)), lambda x: x["i"]))
    rows = rows.withColumn("places", F.when(F.size("twice") > FEW_REPEATS, many).when(F.col("twice").isNotNull(), few))
    # Each place stands for its word and the two after it, up to the next place.
    covered = F.zip_with("places", F.slice("places", 2, F.greatest(F.size("places"), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    rows = rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
    return rows.drop("windows", "sorted", "twice", "placed", "places")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed() -> dict[str, Column]:
    """Shares by their square roots, lengths by logarithms, distinct words as a power of all words; the number of words itself is none, so that long texts are no outliers."""
    share = lambda x, of: F.sqrt(F.col(x) / F.greatest(F.col(of), F.lit(1)))
    log = lambda x, least: F.log(F.greatest(F.col(x), F.lit(least)).cast("double"))
    return {
        "word_length": log("word_chars", 1) - log("n_words", 1),
        "signs": share("n_signs", "word_chars"),
        "variety": log("n_distinct", 2) / log("n_words", 3),
        "upper": share("n_upper", "word_chars"),
        "line_length": log("word_chars", 1) - log("n_lines", 1),
    }


def _inverse(df: DataFrame, names: list[str]) -> DataFrame:
    """df (m_*, c_*_*) with p_*_*, the inverse of the covariances, and log_det, by Cholesky factors."""
    cov = lambda i, j: F.coalesce(F.col(f"c_{names[max(i, j)]}_{names[min(i, j)]}"), F.lit(0.0)) + (SAFEGUARD if i == j else 0.0)
    d, keep = len(names), [c for c in df.columns if not c.startswith("c_")]
    less = lambda i, j: sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
    for j in range(d):  # a column of the factor at a time, then a row of its inverse, so that the plan stays flat
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(cov(j, j) - less(j, j), F.lit(SAFEGUARD * 1e-3))))
        df = df.withColumns({f"l_{i}_{j}": (cov(i, j) - less(i, j)) / F.col(f"l_{j}_{j}") for i in range(j + 1, d)}) if j + 1 < d else df
    for i in range(d):
        row = {j: F.lit(1.0 if i == j else 0.0) - sum((F.col(f"l_{i}_{k}") * F.col(f"v_{k}_{j}") for k in range(j, i)), F.lit(0.0)) for j in range(i + 1)}
        df = df.withColumns({f"v_{i}_{j}": x / F.col(f"l_{i}_{i}") for j, x in row.items()})
    inverse = {f"p_{i}_{j}": sum((F.col(f"v_{k}_{i}") * F.col(f"v_{k}_{j}") for k in range(i, d)), F.lit(0.0)) for i in range(d) for j in range(i + 1)}
    return df.select(*keep, *[e.alias(x) for x, e in inverse.items()], sum((2 * F.log(F.col(f"l_{i}_{i}")) for i in range(d)), F.lit(0.0)).alias("log_det"))


def _distance(names: list[str]) -> Column:
    off = [F.col(x) - F.col(f"m_{x}") for x in names]
    return sum((off[i] * off[j] * F.col(f"p_{i}_{j}") * (1 if i == j else 2) for i in range(len(names)) for j in range(i + 1)), F.lit(0.0))


def _moments(names: list[str], of: dict[str, Column] | None = None) -> list[Column]:
    """The covariances of the columns (c_*_*), or of expressions of them."""
    x = of or {n: F.col(n) for n in names}
    return [F.covar_pop(x[a], x[b]).alias(f"c_{a}_{b}") for i, a in enumerate(names) for b in names[: i + 1]]


def _starts(rows: DataFrame, names: list[str]) -> DataFrame:
    """(group, start, m_*, p_*_*, log_det): the unit matrix, the covariances of directions, and those of hyperbolic tangents, around 0."""
    length = F.sqrt(F.greatest(sum((F.col(x) * F.col(x) for x in names), F.lit(0.0)), F.lit(1e-12)))
    unit = F.struct(*[F.lit(1.0 if a == b else 0.0).alias(f"c_{a}_{b}") for i, a in enumerate(names) for b in names[: i + 1]])
    made = rows.groupBy("group").agg(F.struct(*_moments(names, {x: F.col(x) / length for x in names})).alias("s1"), F.struct(*_moments(names, {x: F.tanh(x) for x in names})).alias("s2"))
    made = made.select("group", F.posexplode(F.array(unit, "s1", "s2")).alias("start", "s"))
    return _inverse(made.select("group", "start", *[F.lit(0.0).alias(f"m_{x}") for x in names], "s.*"), names)


def _step(rows: DataFrame, now: DataFrame, names: list[str], core: float) -> DataFrame:
    """Means and covariances of the `core` share of each group's rows that lie nearest to each of its estimates in now."""
    far = rows.join(small_side(now), "group").select("group", "start", *names, _distance(names).alias("d2"))
    limit = far.groupBy("group", "start").agg(F.percentile_approx("d2", core, 10_000).alias("limit"))
    half = far.join(small_side(now, limit), ["group", "start"]).filter("d2 <= limit")
    return _inverse(half.groupBy("group", "start").agg(*[F.avg(x).alias(f"m_{x}") for x in names], *_moments(names)), names)


def robust_estimates(rows: DataFrame, names: list[str], core: float = CORE, steps: int = STEPS) -> DataFrame:
    """(group, start, m_*, p_*_*, log_det), stored: centre and inverse scatter of the `core` share of each group's rows (group, *names) whose
    covariances have the least determinant.

    From three starts, FIRST_STEPS steps each; then the start with the least determinant goes on until no group's determinant falls any more.
    A step takes means and covariances of the rows nearest to the last estimate, which never raises the determinant. Quantiles
    and moments are aggregates that combine before the shuffle, so a group of any size is no single task's. The statistics should be centred
    and scaled robustly.
    """
    now = written(_starts(rows, names), "mcd-starts")
    for _ in range(FIRST_STEPS):
        last, now = now, written(_step(rows, now, names, core), "mcd-step")
        forget(last)
    best = now.groupBy("group").agg(F.min_by("start", F.struct("log_det", "start")).alias("start"))
    last, now = now, written(now.join(best, ["group", "start"]), "mcd-best")
    forget(last)
    for _ in range(steps):
        before = small_side(now, now.select("group", F.col("log_det").alias("before")))
        last, now = now, written(_step(rows, now, names, core).join(before, "group"), "mcd-step", fell=F.max(F.col("before") - F.col("log_det")))
        forget(last)
        if (now.stored.found["fell"] or 0.0) < 1e-9:
            break
    return now


def quality(docs: DataFrame, quantile: float = QUANTILE, least_rows: int = LEAST_ROWS) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance, level.

    Texts of under 50 words, or with over half of their words in windows of three words found twice, fail the base rules. Estimates
    rest on the others; one of those is rejected if its squared Mahalanobis distance exceeds the chi-square quantile. Each statistic is taken as
    its deviation from the group's median, scaled by a power of the number of words and by the median deviation. A statistic that is the same in
    half of a group's rows or more has none, and takes no part there; the quantile is of as many degrees as take part. Distances are scaled so
    that their median in a group is chi-square's. level says whose estimates were used: 0 its language and source (a null one counts as a value of its
    own), 1 its language, 2 all rows. distance and level are null where the base rules failed. Null texts have no words. Repeated rows are
    judged alike. No rows in, no rows out.
    """
    names = list(STATISTICS)
    measured = statistics(docs).withColumn("base_failed", base_failed()).withColumns({f"x_{k}": v for k, v in transformed().items()})
    kinds = [F.concat(F.lit(f"{level} "), F.to_json(F.struct(*cols))) if cols else F.lit(f"{level}") for level, cols in enumerate((["lang", "source"], ["lang"], []))]
    measured = written(measured.withColumn("own", kinds[0]).drop("n_lines", "n_upper", "n_signs", "n_distinct"), "quality-rows")
    good = measured.filter("not base_failed").withColumn("kinds", F.array(*kinds))
    sizes = good.groupBy("kinds").agg(F.count("*").alias("n"))
    by_lang = sizes.groupBy(F.col("kinds")[1].alias("kind")).agg(F.sum("n").alias("n_lang"))
    chosen = sizes.join(by_lang, F.col("kinds")[1] == F.col("kind")).select("kinds", F.when(F.col("n") >= least_rows, 0).when(F.col("n_lang") >= least_rows, 1).otherwise(2).alias("level"))
    chosen = written(chosen.select(F.col("kinds")[0].alias("own"), F.col("kinds")[F.col("level")].alias("group"), "level"), "quality-groups")
    # Rows count in each group that is asked for: a language's estimates rest on all of its sources.
    wanted = written(chosen.select("group").distinct(), "quality-wanted")
    fit = written(good.select(F.explode("kinds").alias("group"), "n_words", *[f"x_{x}" for x in names]).join(small_side(wanted), "group"), "quality-fit")
    middle = written(fit.groupBy("group").agg(*[F.percentile_approx(f"x_{x}", 0.5, 10_000).alias(f"med_{x}") for x in names]), "quality-middle")
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    off = {x: (F.col(f"x_{x}") - F.col(f"med_{x}")) * F.pow(words, F.lit(power)) for x, power in STATISTICS.items()}
    spread = fit.join(small_side(middle), "group").groupBy("group").agg(*[F.percentile_approx(F.abs(off[x]), 0.5, 10_000).alias(f"mad_{x}") for x in names])
    scale = written(middle.join(small_side(middle, spread), "group"), "quality-scale")
    scaled = {x: F.when(F.col(f"mad_{x}") > 0, off[x] / (1.4826 * F.col(f"mad_{x}"))).otherwise(0.0) for x in names}
    rows = written(fit.join(small_side(scale), "group").select("group", *[e.alias(x) for x, e in scaled.items()]), "quality-scaled")
    forget(wanted, fit, middle)
    estimates = robust_estimates(rows, names)
    active = sum((F.when(F.col(f"mad_{x}") > 0, 1).otherwise(0) for x in names), F.lit(0)).alias("active")
    centre = rows.join(small_side(estimates), "group").groupBy("group").agg(F.percentile_approx(_distance(names), 0.5, 10_000).alias("middle"))
    model = written(estimates.drop("log_det", "start", "before").join(small_side(estimates, centre), "group").join(small_side(scale, scale.withColumn("active", active)), "group"), "quality-model")
    forget(rows, estimates, scale)
    at = lambda q: F.element_at(F.array(*[F.lit(chi_square_quantile(q, k)) for k in range(1, len(names) + 1)]), F.greatest(F.col("active"), F.lit(1)))
    judged = measured.join(small_side(chosen), "own", "left").join(small_side(model), "group", "left").withColumns(scaled)
    distance = F.when(~F.col("base_failed"), F.when(F.col("middle") > 0, _distance(names) / F.col("middle") * at(0.5)).otherwise(0.0))
    judged = judged.withColumn("distance", distance).withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= at(quantile)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.coalesce("kept", F.lit(False)).alias("kept"), F.round("distance", 6).alias("distance"), F.when(~F.col("base_failed"), F.col("level")).alias("level"))
