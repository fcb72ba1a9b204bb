"""Quality rules: text statistics and robust multivariate outliers per language and source.

Only DataFrame functions. Each language and source gets a minimum-covariance-determinant
estimate of centre and spread; a document far from the centre is an outlier.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import SPACES, saved, text_of
from pulsemart.operators.sizes import broadcast_if_small

SYMBOLS = "#*$%&|<>"
WINDOW = 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Spread below which a statistic is taken as constant, in the order of `vector`.
FLOORS = (0.08, 0.30, 0.10, 0.10, 0.08)
DIMS = len(FLOORS)


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def bound(value: Column, then) -> Column:
    """`then(value)` with the value computed once; inside a lambda it would be once per element."""
    return F.get(F.transform(F.array(value), then), 0)


def repeated_words(words: Column) -> Column:
    """Words in 5-word windows that occur twice or more, each place once."""

    def hashes(words: Column) -> Column:
        starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW))
        return F.transform(
            starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))
        )

    def places(ordered: Column) -> Column:
        """Where windows with a twin start. Sorted by content and place, twins are neighbours."""

        def has_twin(x: Column, at: Column) -> Column:
            before = F.get(ordered, at - 1)["h"] == x["h"]
            after = F.get(ordered, at + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.transform(F.filter(ordered, has_twin), lambda x: x["i"])

    def covered(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("end")),
            lambda acc, i: F.struct(
                (acc["n"] + (i + WINDOW - F.greatest(acc["end"], i))).alias("n"),
                (i + WINDOW).alias("end"),
            ),
            lambda acc: acc["n"],
        )

    def count(found: Column) -> Column:
        keyed = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        many = bound(F.sort_array(keyed), lambda o: covered(F.sort_array(places(o))))
        # Most texts repeat no window at all; that shows without sorting.
        return F.when(F.size(found) > F.size(F.array_distinct(found)), many).otherwise(F.lit(0))

    return bound(words, lambda w: bound(hashes(w), count))


def statistics(text: Column) -> dict[str, Column]:
    """Counts over the whole text, all LONG: those of STATS, lines and ASCII capitals."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, SPACES) != "")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(without(text, SPACES)),
        "n_symbols": F.length(text) - F.length(without(text, SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(repeated_words(words), F.lit(0)),
        "n_lines": F.size(lines),
        "n_capitals": F.length(text) - F.length(without(text, string.ascii_uppercase)),
    }
    return {name: count.cast("long") for name, count in counts.items()}


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def vector() -> list[Column]:
    """Statistics on scales where ordinary texts spread evenly.

    Each ratio starts from a fixed number of ordinary words, so that a short text is not far
    out by chance: word length, symbols per word, repeated lines, repeated words, capitals.
    """
    n = F.col("n_words").cast("double")
    return [
        F.log((F.col("word_chars") + 100.0) / (n + 20.0)),
        F.log1p(100.0 * F.col("n_symbols") / (n + 20.0)),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 20.0)),
        F.sqrt(F.col("n_repeat_words") / (n + 20.0)),
        F.sqrt(F.col("n_capitals") / (F.col("word_chars") + 100.0)),
    ]


def chi_square(x: float, k: int) -> float:
    """Distribution function of chi square with k degrees of freedom."""
    term = total = 1.0 / (k / 2)
    i = 1
    while term > 1e-15 * total:
        term *= (x / 2) / (k / 2 + i)
        total += term
        i += 1
    return total * math.exp(-x / 2 + (k / 2) * math.log(x / 2) - math.lgamma(k / 2))


def consistency(share: float, k: int = DIMS) -> float:
    """Factor that makes the spread of the central share of normal data that of all of it."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, k) < share else (low, mid)
    return share / chi_square(low, k + 2)


def squared_distance(row: str = "", group: str = "") -> Column:
    """Mahalanobis distance, squared, from columns x*, m* and the triangular factor l*."""
    z: list[Column] = []
    for i in range(DIMS):
        rest = F.col(f"{row}x{i}") - F.col(f"{group}m{i}")
        for j in range(i):
            rest = rest - F.col(f"{group}l{i}{j}") * z[j]
        z.append(rest / F.col(f"{group}l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def factor(moments: DataFrame) -> DataFrame:
    """Triangular factor of covariances c*, as columns l*, with the centre m*."""
    out = moments
    for i in range(DIMS):
        for j in range(i + 1):
            left = F.col(f"c{i}{j}")
            for k in range(j):
                left = left - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(left, F.lit(1e-9))) if i == j else left / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    names = [f"l{i}{j}" for i in range(DIMS) for j in range(i + 1)]
    return out.select("g", *(f"m{i}" for i in range(DIMS)), *names)


def group_names(rows: DataFrame, min_group: int) -> DataFrame:
    """(lang, source) -> g: the pair itself, the language, or everything, if it has few rows."""
    pairs = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    langs = pairs.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    mark = F.lit("\x1f")
    return pairs.join(langs, "lang").select(
        "lang",
        "source",
        F.when(F.col("n") >= min_group, F.concat(F.lit("s"), mark, "lang", mark, "source"))
        .when(F.col("n_lang") >= min_group, F.concat(F.lit("l"), mark, "lang"))
        .otherwise(F.lit("a"))
        .alias("g"),
    )


def estimate(rows: DataFrame, share: float = 0.75, steps: int = 4) -> DataFrame:
    """Centre and triangular factor by g from columns g, x0..: the estimate of each group.

    Starts from medians and quartiles. Each step keeps the `share` of rows nearest to the
    centre and takes their mean and covariance, which cannot raise the determinant. Floors on
    the spread keep constant statistics from ruling.
    """
    first = rows.groupBy("g").agg(
        *(
            F.percentile_approx(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}")
            for i in range(DIMS)
        )
    )
    zero = [F.lit(0.0).alias(f"l{i}{j}") for i in range(DIMS) for j in range(i)]
    params = saved(
        first.select(
            "g",
            *(F.col(f"q{i}")[1].alias(f"m{i}") for i in range(DIMS)),
            *(
                F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i])).alias(
                    f"l{i}{i}"
                )
                for i in range(DIMS)
            ),
            *zero,
        ),
        "mcd",
    )
    grow = consistency(share)
    for _ in range(steps):
        placed = rows.join(params, "g").withColumn("d", squared_distance())
        near = placed.groupBy("g").agg(F.percentile_approx("d", share, 2000).alias("most"))
        core = placed.join(near, "g").where(F.col("d") <= F.col("most"))
        moments = core.groupBy("g").agg(
            *(F.avg(f"x{i}").alias(f"m{i}") for i in range(DIMS)),
            *(
                F.covar_pop(f"x{i}", f"x{j}").alias(f"v{i}{j}")
                for i in range(DIMS)
                for j in range(i + 1)
            ),
        )
        spread = moments.select(
            "g",
            *(f"m{i}" for i in range(DIMS)),
            *(
                (F.col(f"v{i}{j}") * grow + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}")
                for i in range(DIMS)
                for j in range(i + 1)
            ),
        )
        params = saved(factor(spread), "mcd")
    return params


def with_statistics(docs: DataFrame) -> DataFrame:
    """The rows with their statistics; a column of the same name is replaced."""
    return docs.withColumns(statistics(text_of("text")))


class OutlierRule:
    """Estimates of one corpus, to be applied to its rows.

    Rows that fail the base rule take no part in the estimate. Null language or source counts as
    the empty one. Groups under `min_group` rows share the estimate of their language, or of all.
    Empty tables give no estimate and keep nothing.
    """

    def __init__(self, stats: DataFrame, *, cutoff: float = 6.0, min_group: int = 100) -> None:
        self.cutoff = cutoff
        good = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).select(
            F.coalesce("lang", F.lit("")).alias("lang"),
            F.coalesce("source", F.lit("")).alias("source"),
            *(c.alias(f"x{i}") for i, c in enumerate(vector())),
        )
        self.groups = saved(group_names(good, min_group), "mcd-groups")
        self.params = estimate(good.join(self.groups, ["lang", "source"]).drop("lang", "source"))

    def judge(self, stats: DataFrame) -> DataFrame:
        """The rows with base_failed, distance (null if base_failed) and kept."""
        failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
        keyed = self.groups.join(self.params, "g").select(
            F.col("lang").alias("__lang"),
            F.col("source").alias("__source"),
            *(c for c in self.params.columns if c != "g"),
        )
        names = [c for c in stats.columns if c not in ("base_failed", "distance", "kept")]
        rows = stats.select(
            *names,
            F.coalesce("lang", F.lit("")).alias("__l"),
            F.coalesce("source", F.lit("")).alias("__s"),
            failed.alias("base_failed"),
            F.struct(*(c.alias(f"x{i}") for i, c in enumerate(vector()))).alias("__x"),
        )
        # One row per group, saved and of a checked size: it goes to the rows, not they to it.
        packed = saved(
            keyed.select("__lang", "__source", F.struct(*keyed.columns).alias("__p")), "mcd-groups"
        )
        joined = rows.join(
            broadcast_if_small(packed),
            (F.col("__l") == F.col("__lang")) & (F.col("__s") == F.col("__source")),
            "left",
        )
        far = F.sqrt(squared_distance("__x.", "__p."))
        distance = F.when(~F.col("base_failed"), far)
        return joined.select(
            *names,
            "base_failed",
            distance.alias("distance"),
            F.coalesce(distance <= self.cutoff, F.lit(False)).alias("kept"),
        )


def judge(docs: DataFrame, **options) -> DataFrame:
    """doc_id, the counts, base_failed, distance and kept, one row per row of documents."""
    stats = saved(
        docs.select("doc_id", "lang", "source", text_of("text").alias("text"))
        .withColumns(statistics(F.col("text")))
        .drop("text"),
        "statistics",
    )
    return OutlierRule(stats, **options).judge(stats)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of documents that pass, with the same columns."""
    counts = [c.alias(n) for n, c in statistics(text_of("text")).items()]
    rows = saved(
        docs.select("lang", "source", F.struct(*docs.columns).alias("__row"), *counts), "statistics"
    )
    judged = OutlierRule(rows.drop("__row"), **options).judge(rows)
    return judged.where("kept").select("__row.*")
