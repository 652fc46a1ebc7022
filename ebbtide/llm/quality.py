"""Quality rules by robust multivariate outliers.

Each document gets statistics of its words, signs, lines and repetitions, taken to a scale on which documents of a
kind lie close. Per language and source, or for small ones per language or over all, a minimum-covariance-determinant estimate is found by concentration
steps: from the three quarters of the rows that lie nearest to the present centre, mean and covariance are taken
anew. Rows whose Mahalanobis distance from the result is beyond a chi-square bound go. Everything is Spark SQL on
one small row per document; a step is one grouped aggregate, so no group is ever held by a task.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.session import materialise

from .common import SPACE, WORD, text_of

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"
#: Statistics that are compared, each with the least spread that counts as one: below, groups are not told apart.
VECTOR = {"symbols": 0.3, "word_length": 0.15, "repeats": 0.8, "duplicate_lines": 1.0, "capitals": 0.4, "marks": 0.4}
#: Share of a group that an estimate rests on.
CORE = 0.75
STEPS = 3
#: Groups with fewer rows are judged by the estimate of a larger one around them.
SMALLEST = 200
#: Rows that the least spreads count for: they hold a small group's spread wide, and add little to that of a large one.
PRIOR = 40
#: Chance of a normal row beyond the bound.
BEYOND = 1e-7


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts and the compared statistics of every row; null texts are empty.

    A window of three words that occurs again in the text is found by sorting: hashes shortened to make room for
    their position bring equal windows together in one fast sort of numbers, and the few that meet are compared
    by their full hashes. Time grows with n log n of a text's own words.
    """
    text = F.col("text")
    rows = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        text_of().alias("text"))
    rows = rows.select(
        "doc_id", "lang", "source", "text",
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = rows.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"), _count(text, upper).alias("n_upper"), _count(text, "!?.,;:'\"()-").alias("n_marks"),
        F.when(F.size("words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        )).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    # positions take the low bits, as many as the longest needs
    room = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("windows") + F.lit(1.0)))).cast("long")
    kept = [c for c in rows.columns if c != "windows"]
    rows = rows.select(*kept, "windows", (room - 1).alias("low"))
    rows = rows.select(*kept, "windows", "low", F.sort_array(F.transform(
        "windows", lambda h, i: h.bitwiseAND(F.bitwise_not("low")).bitwiseOR(i.cast("long")))).alias("sorted"))

    def as_neighbour(x, j):
        high = x.bitwiseAND(F.bitwise_not("low"))
        near = [F.get("sorted", k).bitwiseAND(F.bitwise_not("low")) == high for k in (j - 1, j + 1)]
        return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

    suspects = F.transform(F.filter("sorted", as_neighbour), lambda x: x.bitwiseAND(F.col("low")).cast("int"))
    rows = rows.select(*kept, "windows", suspects.alias("suspects"))
    rows = rows.select(*kept, F.array_sort(F.transform(
        "suspects", lambda i: F.struct(F.get("windows", i).alias("hash"), i.alias("at")))).alias("pairs"))

    def equal_neighbour(x, j):
        near = [F.get("pairs", k)["hash"] == x["hash"] for k in (j - 1, j + 1)]
        return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

    rows = rows.select(*kept, F.sort_array(F.transform(
        F.filter("pairs", equal_neighbour), lambda p: p["at"])).alias("starts"))
    # a window adds the words that the one before does not cover
    covered = F.aggregate(
        "starts", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, at: F.struct(at.alias("last"), (s["n"] + F.least(F.lit(3), at - s["last"])).cast("long").alias("n")),
        lambda s: s["n"])
    rows = rows.select(*kept, covered.alias("n_repeat_words"))
    per_char = 100.0 / (F.col("word_chars") + 1)
    return rows.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.log1p(F.col("n_symbols") * per_char).alias("symbols"),
        F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)).alias("word_length"),
        F.log1p(100.0 * F.col("n_repeat_words") / (F.col("n_words") + 1)).alias("repeats"),
        F.log1p(100.0 * F.col("n_dup_lines") / (F.col("n_lines") + 1)).alias("duplicate_lines"),
        F.log1p(F.col("n_upper") * per_char).alias("capitals"),
        F.log1p(F.col("n_marks") * per_char).alias("marks"),
    )


def chi_square(degrees: int, beyond: float) -> float:
    """The value that a chi-square variable exceeds with the chance given (Wilson and Hilferty)."""
    z = NormalDist().inv_cdf(1 - beyond)
    return degrees * (1 - 2 / (9 * degrees) + z * math.sqrt(2 / (9 * degrees))) ** 3


def grouped(stats: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """``stats`` with ``part``, whose estimate judges a row, and ``parts``, whose estimates the row enters.

    A row is judged by its language and source, by all of its language if that has fewer than ``smallest`` rows,
    and by all rows if the language has fewer too. Estimates that judge no row are left out.
    """
    fine = F.concat_ws("\x1f", F.lit("s"), F.coalesce("lang", F.lit("\x1e")), F.coalesce("source", F.lit("\x1e")))
    coarse = F.concat_ws("\x1f", F.lit("l"), F.coalesce("lang", F.lit("\x1e")))
    rows = stats.withColumn("fine", fine).withColumn("coarse", coarse)
    sizes = materialise(rows.groupBy("fine", "coarse").agg(F.count("*").alias("n")), "sizes")
    languages = sizes.groupBy("coarse").agg(F.sum("n").alias("pooled"), (F.min("n") < smallest).alias("asked"))
    languages = materialise(languages, "languages")
    rare = languages.agg(F.coalesce(F.max(F.col("asked") & (F.col("pooled") < smallest)), F.lit(False)).alias("rare"))
    enough, pooled = F.col("n") >= smallest, F.col("pooled") >= smallest
    sizes = sizes.join(languages, "coarse").crossJoin(rare).select(
        "fine", F.when(enough, F.col("fine")).when(pooled, F.col("coarse")).otherwise(F.lit("all")).alias("part"),
        F.array_compact(F.array(
            F.when(enough, F.col("fine")), F.when(F.col("asked") & pooled, F.col("coarse")),
            F.when(F.col("rare"), F.lit("all")))).alias("parts"))
    return rows.join(materialise(sizes, "parts"), "fine").drop("fine", "coarse")


def _names(prefix: str) -> list[str]:
    size = len(VECTOR)
    return [f"{prefix}{i}_{j}" for i in range(size) for j in range(i + 1)]


def start(rows: DataFrame) -> DataFrame:
    """Per part the medians, and a diagonal matrix of the squared median deviations."""
    medians = rows.groupBy("part").agg(
        F.count("*").alias("n"), *[F.percentile_approx(v, 0.5, 10_000).alias(f"m{i}") for i, v in enumerate(VECTOR)])
    away = rows.join(materialise(medians, "medians"), "part")
    spread = away.groupBy("part").agg(
        F.first("n").alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(VECTOR))],
        *[F.percentile_approx(F.abs(F.col(v) - F.col(f"m{i}")), 0.5, 10_000).alias(f"d{i}") for i, v in enumerate(VECTOR)])
    cells = []
    for i, least in enumerate(VECTOR.values()):
        for j in range(i + 1):
            cell = F.greatest(F.lit(least), 1.4826 * F.col(f"d{i}")) ** 2 if i == j else F.lit(0.0)
            cells.append(cell.alias(f"c{i}_{j}"))
    return spread.select("part", "n", *[f"m{i}" for i in range(len(VECTOR))], *cells)


def factored(estimate: DataFrame) -> DataFrame:
    """Adds the Cholesky factor l of each matrix c, column after column; the least spreads keep it regular."""
    size = len(VECTOR)
    for j in range(size):
        head = F.col(f"c{j}_{j}") - sum((F.col(f"l{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        estimate = estimate.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(F.lit(1e-9), head)))
        estimate = estimate.withColumns({
            f"l{i}_{j}": (F.col(f"c{i}_{j}") - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0)))
            / F.col(f"l{j}_{j}") for i in range(j + 1, size)})
    return estimate.select("part", "n", *[f"m{i}" for i in range(size)], *_names("l"))


def distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance from the estimate of their part."""
    size = len(VECTOR)
    joined = rows.join(materialise(factored(estimate), "estimate"), "part")
    for i, v in enumerate(VECTOR):
        done = sum((F.col(f"l{i}_{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        joined = joined.withColumn(f"z{i}", (F.col(v) - F.col(f"m{i}") - done) / F.col(f"l{i}_{i}"))
    distance = sum((F.col(f"z{i}") ** 2 for i in range(size)), F.lit(0.0))
    return joined.select(*rows.columns, "n", distance.alias("distance"))


def concentrated(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Mean and covariance of the rows of each part that lie nearest to ``estimate``, scaled to the whole."""
    size, names = len(VECTOR), list(VECTOR)
    measured = distances(rows, estimate).drop("n")
    bounds = measured.groupBy("part").agg(F.percentile_approx("distance", CORE, 10_000).alias("bound"))
    core = measured.join(materialise(bounds, "bounds"), "part").filter("distance <= bound")
    sums = core.groupBy("part").agg(
        F.count("*").alias("k"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"v{i}_{j}") for i in range(size) for j in range(i + 1)])
    # the core of a normal cloud is narrower than the cloud
    inside = chi_square(size, 1 - CORE)
    wider = CORE / _chi_square_below(size + 2, inside)
    cells = []
    for i, least in enumerate(VECTOR.values()):
        for j in range(i + 1):
            cell = F.col(f"v{i}_{j}") * wider
            cells.append((cell + least**2 * (1 + PRIOR / F.col("k")) if i == j else cell).alias(f"c{i}_{j}"))
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    return sums.select("part", *[f"m{i}" for i in range(size)], *cells).join(counts, "part")


def _chi_square_below(degrees: int, value: float) -> float:
    return NormalDist().cdf(((value / degrees) ** (1 / 3) - 1 + 2 / (9 * degrees)) / math.sqrt(2 / (9 * degrees)))


def judge(docs: DataFrame, steps: int = STEPS, beyond: float = BEYOND, smallest: int = SMALLEST) -> DataFrame:
    """The base counts of every row with base_failed, distance and kept.

    base_failed: under 50 words, or over half of the words in repeated windows. Such rows, empty texts among them,
    are not kept and do not enter the estimates. Every other row is judged, however few there are: the fewer, the
    wider the least spreads. Null languages and sources are groups of their own; see ``grouped`` for small ones. Repeated rows count as often as they are there. No rows
    give no rows.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = materialise(statistics(docs).withColumn("base_failed", failed), "statistics")
    rows = materialise(grouped(stats.filter(~F.col("base_failed")), smallest), "vectors")
    members = rows.withColumn("part", F.explode("parts")).drop("parts")
    estimate = start(members)
    for _ in range(steps):
        estimate = concentrated(members, materialise(estimate, "step"))
    near = F.col("distance") <= chi_square(len(VECTOR), beyond)
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    passed = distances(rows.drop("parts"), estimate).select(*base, "distance", near.alias("kept"))
    return passed.unionByName(stats.filter("base_failed").select(
        *base, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept")))
