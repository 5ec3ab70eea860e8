"""Quality rules by robust multivariate outliers, in DataFrame operations only.

Each document becomes a vector of transformed statistics. For every language and source a minimum
covariance determinant estimate describes the bulk of its documents: concentration steps keep the
three quarters of rows nearest to the current centre and estimate centre and covariance from
them anew. A group's estimate leans on its language's, and that one on the estimate of all, the more
the fewer documents it has, without a threshold. Documents beyond a Mahalanobis distance are rejected.

Everything that is summed is an integer: statistics are rounded to 1/256, distances are counted in
classes. Estimates then do not depend on the order of rows or on how they are split, and a step is
one aggregation to a small table whatever the number of rows in a group.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settled, spare, without

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
STATS = ["s_word", "s_symbol", "s_repeat", "s_line"]
#: Least standard deviation of each statistic: below it, differences are no sign of quality.
#: With them the greatest value of each statistic alone is far beyond the limit, that of a text of repeated lines at 61 of 33.
LEAST_SPREAD = [0.08, 0.4, 0.42, 0.5]
UNIT = 256
CLASSES = 8
CORE = 0.75
STEPS = 4
#: Rows that the wider estimate counts for beside those of a group: ten for each statistic.
WIDER_ROWS = 40
TAIL = 1e-6
BROADCAST_GROUPS = 20_000


def chi2_cdf(x: float, dims: int) -> float:
    """For an even number of dimensions, where the sum is finite."""
    terms = [1.0]
    for k in range(1, dims // 2):
        terms.append(terms[-1] * x / 2 / k)
    return 1 - math.exp(-x / 2) * sum(terms)


def chi2_quantile(share: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, dims) < share else (low, middle)
    return high


def core_factor(core: float, dims: int) -> float:
    """What a covariance of the nearest share ``core`` is multiplied with, to be that of all rows."""
    return core / chi2_cdf(chi2_quantile(core, dims), dims + 2)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words and base_failed.

    Words are runs without ASCII white space, of the whole text; a null text has none. Windows of
    three words are compared by a 64-bit hash.
    """
    body = F.coalesce(docs[text], F.lit(""))
    worded = F.filter(F.split(body, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    df = docs.withColumns({
        "_words": F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), "_lines": worded,
        "word_chars": F.char_length(F.translate(body, SPACES, "")).cast("bigint"),
        "n_symbols": (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("bigint")})
    n = F.size("_words")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumns({
        "n_words": n.cast("bigint"), "n_lines": F.size("_lines").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_windows": windows}).drop("_words", "_lines")
    # Sorted with their places, equal windows stand side by side; most texts have none.
    placed = F.when(F.size("_windows") > F.size(F.array_distinct("_windows")), F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_placed", placed).drop("_windows")
    repeated = F.filter("_placed", lambda p, i: F.coalesce(p["h"] == F.get("_placed", i - 1)["h"], F.lit(False))
                        | F.coalesce(p["h"] == F.get("_placed", i + 1)["h"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda p: F.array(p["i"], p["i"] + 1, p["i"] + 2))))
    df = df.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("bigint")).drop("_placed")
    return df.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def _fixed(value: Column) -> Column:
    """A statistic in units of 1/256."""
    return F.floor(value * UNIT + 0.5).cast("bigint")


def with_vector(df: DataFrame) -> DataFrame:
    """Logarithms of mean word length and of the shares of symbols, repeated words and repeated lines."""
    words = F.greatest(F.lit(1), "n_words").cast("double")
    lines = F.greatest(F.lit(1), "n_lines").cast("double")
    return df.withColumns({
        "s_word": _fixed(F.log(F.greatest(F.lit(1), "word_chars") / words)),
        "s_symbol": _fixed(F.log(0.02 + F.col("n_symbols") / words)),
        "s_repeat": _fixed(F.log(0.02 + F.col("n_repeat_words") / words)),
        "s_line": _fixed(F.log(0.02 + F.col("n_dup_lines") / lines))})


def _matched(rows: DataFrame, estimates: DataFrame, key: str) -> DataFrame:
    """Rows with their group's estimates; these are sent to all tasks only if counted to be few."""
    if estimates.count() <= BROADCAST_GROUPS:
        estimates = F.broadcast(estimates)
    return rows.join(estimates, key)


def start_estimates(rows: DataFrame, key: str) -> DataFrame:
    """Median and quartile spread of each statistic, without covariances."""
    unfolded = rows.select(key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("dim"), F.col(s).alias("v")) for i, s in enumerate(STATS)])).alias("c")).select(key, "c.*")
    counts = unfolded.groupBy(key, "dim", "v").agg(F.count("*").alias("n"))
    order = Window.partitionBy(key, "dim").orderBy("v")
    whole = Window.partitionBy(key, "dim")
    sums = counts.select(key, "dim", "v", F.sum("n").over(order).alias("upto"), F.sum("n").over(whole).alias("all"))
    cut = lambda quarters: F.min(F.when(F.col("upto") * 4 >= F.col("all") * quarters, F.col("v")))
    spread = sums.groupBy(key, "dim").agg(cut(1).alias("low"), cut(2).alias("middle"), cut(3).alias("high"))
    columns = []
    for i, least in enumerate(LEAST_SPREAD):
        of = lambda c, i=i: F.max(F.when(F.col("dim") == i, F.col(c)))
        columns += [(of("middle") / UNIT).alias(f"m{i}"),
                    F.greatest((of("high") - of("low")) / UNIT / 1.349, F.lit(least)).alias(f"l{i}{i}")]
    spread = spread.groupBy(key).agg(*columns)
    return spread.withColumns({f"l{i}{j}": F.lit(0.0) for i in range(len(STATS)) for j in range(i)})


def with_distance(df: DataFrame, name: str = "d2") -> DataFrame:
    """Squared Mahalanobis distance, by forward substitution with the covariance's triangular root."""
    dims = range(len(STATS))
    for i in dims:
        left = F.col(STATS[i]) / UNIT - F.col(f"m{i}")
        solved = reduce(lambda e, j, i=i: e - F.col(f"l{i}{j}") * F.col(f"_y{j}"), range(i), left)
        df = df.withColumn(f"_y{i}", solved / F.col(f"l{i}{i}"))
    total = reduce(lambda a, b: a + b, [F.col(f"_y{i}") * F.col(f"_y{i}") for i in dims])
    return df.withColumn(name, total).drop(*[f"_y{i}" for i in dims])


def concentrate(rows: DataFrame, estimates: DataFrame, key: str, core: float = CORE) -> DataFrame:
    """One step: sums per distance class, then estimates from the classes that hold the core."""
    dims = range(len(STATS))
    pairs = [(i, j) for i in dims for j in range(i + 1)]
    far = with_distance(_matched(rows, estimates, key))
    far = far.withColumn("far", F.floor(CLASSES * F.log2(1 + F.col("d2"))).cast("int"))
    sums = far.groupBy(key, "far").agg(
        F.count("*").alias("n"), *[F.sum(STATS[i]).alias(f"a{i}") for i in dims],
        *[F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"a{i}{j}") for i, j in pairs])
    nearer = Window.partitionBy(key).orderBy("far")
    kept = sums.withColumns({
        "before": F.sum("n").over(nearer) - F.col("n"), "all": F.sum("n").over(Window.partitionBy(key))}).where(
        F.col("before") < F.ceil(F.col("all") * core))
    total = kept.groupBy(key).agg(F.max("all").alias("rows"), *[
        F.sum(c).alias(c) for c in ["n", *[f"a{i}" for i in dims], *[f"a{i}{j}" for i, j in pairs]]])
    n = F.col("n").cast("double")
    total = total.withColumns({f"m{i}": F.col(f"a{i}") / n / UNIT for i in dims})
    factor = core_factor(core, len(STATS))
    total = total.withColumns({
        f"c{i}{j}": (F.col(f"a{i}{j}") / n / UNIT / UNIT - F.col(f"m{i}") * F.col(f"m{j}")) * factor for i, j in pairs})
    return settled(with_root(total).select(
        key, "rows", *[f"m{i}" for i in dims], *[f"{k}{i}{j}" for k in "cl" for i, j in pairs]))


def with_root(estimates: DataFrame) -> DataFrame:
    """The triangular root ``l`` of the covariance ``c``, to whose variances the least ones are added."""
    dims = range(len(STATS))
    for i in dims:
        for j in range(i + 1):
            whole = F.col(f"c{i}{j}") + LEAST_SPREAD[i] ** 2 if i == j else F.col(f"c{i}{j}")
            left = reduce(lambda e, k, i=i, j=j: e - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), whole)
            estimates = estimates.withColumn(f"l{i}{j}", F.sqrt(left) if i == j else left / F.col(f"l{j}{j}"))
    return estimates


def leaning(own: DataFrame, wider: DataFrame, key: str, on: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Estimates of groups with their wider group's mixed in, as if that were ``WIDER_ROWS`` of their rows."""
    names = [*[f"m{i}" for i in range(len(STATS))], *[f"c{i}{j}" for i in range(len(STATS)) for j in range(i + 1)]]
    wide = wider.select(F.col(key).alias("_wider"), *[F.col(c).alias(f"w_{c}") for c in names])
    share = F.col("rows") / (F.col("rows") + WIDER_ROWS)
    mixed = own.join(wide, F.col(on) == F.col("_wider"))
    return mixed.select(key, "rows", *also, *[(share * F.col(c) + (1 - share) * F.col(f"w_{c}")).alias(c) for c in names])


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             source: str = "source", carry: tuple[str, ...] = (), tail: float = TAIL, steps: int = STEPS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, distance and the carried columns.

    ``kept`` is false where the base rule fails or the squared distance is beyond the chi-squared
    quantile at ``tail``. Every language and source has an estimate of its own, whatever its size:
    of n documents it counts n to ``WIDER_ROWS`` against its language's estimate, which leans in the same
    way on the estimate of all. Null languages and sources are groups of their own. Null ids and
    repeated rows stay; an empty table gives no rows.
    """
    stats = with_vector(with_statistics(docs.select(
        docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"), docs[lang].alias("lang"),
        docs[source].alias("source"), *carry))).drop("text", "n_lines")
    group = F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"})
    wide = F.to_json(F.struct("lang"), {"ignoreNullFields": "false"})
    stats = settled(stats.withColumns({"_group": group, "_wide": wide}).drop("lang", "source"))

    levels = settled(stats.select("_group", "_wide").distinct())
    rows = stats.select(F.explode(F.array("_group", "_wide", F.lit(""))).alias("_by"), *STATS)
    estimates = settled(start_estimates(rows, "_by"))
    for _ in range(steps):
        estimates = concentrate(rows, estimates, "_by")
    of_all = estimates.where("_by = ''")
    # Empty for every language, yet no constant: the one row of all is met by a key, not by a cross join.
    nothing = F.substring("_wide", 1, 0)
    of_langs = estimates.join(levels.select("_wide").distinct(), F.col("_by") == F.col("_wide")).withColumn("_all", nothing)
    of_groups = estimates.join(levels, F.col("_by") == F.col("_group"))
    langs = leaning(of_langs, of_all, "_by", "_all")
    by_group = settled(with_root(leaning(of_groups, langs, "_by", "_wide", ("_group",))).drop("_by", "rows"))
    judged = with_distance(_matched(stats, by_group, "_group"), "distance")
    limit = chi2_quantile(1 - tail, len(STATS))
    kept = ~F.col("base_failed") & (F.col("distance") <= limit)
    return judged.withColumn("kept", kept).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance", *carry)


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` keeps, told apart by id and text."""
    key = spare(docs, "text_key")
    marked = docs.withColumn(key, F.xxhash64(docs[text]))
    return without(docs, marked, verdicts(marked, doc_id, text, carry=(key,), **options).where("not kept"), doc_id, key)
