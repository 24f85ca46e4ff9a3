"""Quality rules: robust multivariate outliers, in DataFrame functions only.

Each text gets a vector of transformed statistics: word length, rates of symbols, repeated lines,
repeated words, commas and sentence ends, and the share of vowels. Per language and source, the
minimum covariance determinant looks for the half of the texts whose covariance has the least
determinant. From three deterministic starts (distances from the medians, and the covariances of
hyperbolic tangents and of directions around them) it repeats the concentration step (mean and
covariance of the nearest half, Mahalanobis distances by them, the nearest half again) until the
determinant falls by less than one part in a hundred; the least one is taken. Mean and covariance
of all texts inside its chi-square bound then give every text its distance; those beyond ``BOUND`` are
rejected. Small groups can't bear a covariance: groups of fewer than ``LEAST`` texts share one
estimate per language, and languages with too few one in all.

Statistics are scaled first, per group, by their median and median absolute deviation. Where half
of a group or more share one value (no symbols, no repeats) there is no such scale, and no
covariance: the statistic is left out of the determinant. Symbols, repeated lines and repeated words
then add the square of their difference in units of ``FLAT``; the others add nothing.

Everything is grouping and joining: sums of products are aggregated before the shuffle, so a hot
source moves one row a task, and the nearest half is cut at an approximate quantile.

Defined results: null and empty texts have no words, fail the base rules and take no part in the
estimates; null languages and sources are groups of their own; texts of any length are taken
whole; repeated rows each count; an empty table gives an empty one. Only ``doc_id``, ``text``,
``lang`` and ``source`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import keep

#: White space and symbols of the rules; windows of words for repeats.
SPACE, SYMBOLS, RUN = r"[\x20\x09-\x0D]+", "#*$%&|<>", 3
#: What further statistics count.
COMMAS, ENDS, VOWELS = ",;:", ".!?", "aeiouyAEIOUY"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Groups under this share their language's estimate; the least fall of the determinant's logarithm
#: that asks for one more step; and the quantile of chi-square with seven degrees of freedom beyond
#: which a text is rejected (one in a thousand).
LEAST, FALL, BOUND = 60, 0.01, 24.322
#: The medians of chi-square with one to seven degrees of freedom: the half's covariance is too small,
#: so distances whose median lies above are scaled down to it.
MEDIANS = (0.4549, 1.3863, 2.3660, 3.3567, 4.3515, 5.3481, 6.3458)
#: Its quantiles inside which texts enter the last mean and covariance (975 in a thousand).
INSIDE = (5.024, 7.378, 9.348, 11.143, 12.833, 14.449, 16.013)
#: The median absolute deviation of the normal distribution, and the least one that counts as a scale.
NORMAL, LEAST_SPREAD = 0.67449, 1e-9
#: The unit of a statistic without a scale: one whose rate is 0 in most texts rejects alone from 0.14
#: a word on. Only the statistics at ``STRICT`` count so.
FLAT, STRICT = 0.173, (0, 1, 2, 3)
#: Added to the variances of scaled statistics, against rounding.
FLOOR = 1e-6
#: Stands for a null language or source in group keys.
NO_VALUE = "\x00"
DIMENSIONS = 7


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """How many of the words lie in a run of ``RUN`` words that the array holds twice or more.

    The runs' hashes are sorted with their places, so equal runs are neighbours; the places of
    those, sorted again, cover ``RUN`` words each, less what the next one covers.
    """
    def covered(hashes: Column) -> Column:
        again = F.filter(hashes, lambda x, i: (
            (x["h"] == F.get(hashes, i - 1)["h"]) | (x["h"] == F.get(hashes, i + 1)["h"])))
        return let(F.array_sort(F.transform(again, lambda x: x["i"])), lambda places: F.aggregate(
            F.transform(places, lambda p, k: F.least(
                F.lit(RUN), F.coalesce(F.get(places, k + 1) - p, F.lit(RUN)))),
            F.lit(0), lambda a, b: a + b))

    def runs(ws: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ws) - RUN),
            lambda i: F.struct(F.xxhash64(*[F.get(ws, i + k) for k in range(RUN)]).alias("h"), i.alias("i")))

    return F.when(F.size(words) < RUN, F.lit(0)).otherwise(
        let(words, lambda ws: let(F.array_sort(runs(ws)), covered)))


def statistics(documents: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts of the base rules, over whole texts."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def number_of(signs: str) -> Column:
        return (F.char_length("text") - F.char_length(F.translate("text", signs, ""))).cast("bigint")

    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), text.alias("text"),
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.regexp_replace(line, SPACE, "") != "").alias("lines"),
    )
    return rows.select(
        "doc_id", "lang", "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        number_of(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
        number_of(COMMAS).alias("n_commas"), number_of(ENDS).alias("n_ends"), number_of(VOWELS).alias("n_vowels"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics: word length, and rates on scales that are near normal."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log(F.greatest(F.col("word_chars") / words, F.lit(0.1))),
        F.log1p(10 * F.col("n_symbols") / words),
        F.log1p(10 * F.col("n_dup_lines") / words),
        F.log1p(10 * F.col("n_repeat_words") / words),
        F.log1p(10 * F.col("n_commas") / words),
        F.log1p(10 * F.col("n_ends") / words),
        F.col("n_vowels") / F.greatest(F.col("word_chars"), F.lit(1)),
    ]


PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]


def estimate(rows: DataFrame, *by: str) -> DataFrame:
    """Mean of ``x``, the inverse of the Cholesky factor of its covariance (``inverse``, by rows) and the
    logarithm of the determinant (``det``), per group; statistics without a scale have variance 1,
    no covariance, and no part in the determinant."""
    dims = range(DIMENSIONS)
    sums = rows.groupBy(*by).agg(
        F.first("varies").alias("varies"),
        *[F.expr(f"avg(x[{i}]) AS m{i}") for i in dims],
        *[F.expr(f"covar_pop(x[{i}], x[{j}]) AS c{i}{j}") for i, j in PAIRS])
    for j in dims:  # a column of the factor l after the other
        below = {}
        for i in range(j, DIMENSIONS):
            known = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            value, other = (f"c{i}{j} + {FLOOR}", "1D") if i == j else (f"c{i}{j}", "0D")
            below[i] = f"(CASE WHEN varies[{i}] AND varies[{j}] THEN {value} ELSE {other} END){known}"
        sums = sums.selectExpr("*", f"sqrt(greatest({below.pop(j)}, {FLOOR}D)) AS l{j}{j}")
        if below:
            sums = sums.selectExpr("*", *[f"({rest}) / l{j}{j} AS l{i}{j}" for i, rest in below.items()])
    for i in dims:  # a row of its inverse w after the other
        sums = sums.selectExpr("*", f"1 / l{i}{i} AS w{i}{i}", *[
            f"-({' + '.join(f'l{i}{k} * w{k}{j}' for k in range(j, i))}) / l{i}{i} AS w{i}{j}" for j in range(i)])
    return sums.selectExpr(
        *by, f"array({', '.join(f'm{i}' for i in dims)}) AS mean",
        f"array({', '.join(f'w{i}{j}' for i, j in PAIRS)}) AS inverse",
        f"2 * ({' + '.join(f'ln(l{i}{i})' for i in dims)}) AS det")


def distance() -> Column:
    """Squared Mahalanobis distance of ``x`` by ``mean`` and ``inverse``."""
    rows = [" + ".join(f"inverse[{PAIRS.index((i, k))}] * (x[{k}] - mean[{k}])" for k in range(i + 1))
            for i in range(DIMENSIONS)]
    return F.expr(" + ".join(f"pow({row}, 2)" for row in rows))


def starts(points: DataFrame) -> DataFrame:
    """The estimates that concentration begins with, per ``grp`` and ``start``, around the medians."""
    size = F.sqrt(sum((F.col("x")[i] * F.col("x")[i] for i in range(DIMENSIONS)), F.lit(FLOOR)))
    bent = points.select("grp", "varies", F.explode(F.array(
        F.struct(F.lit(1).alias("start"), F.transform("x", F.tanh).alias("x")),
        F.struct(F.lit(2).alias("start"), F.transform("x", lambda v: v / size).alias("x")))).alias("s")).select(
        "grp", "varies", "s.start", "s.x")
    middle = F.array(*[F.lit(0.0)] * DIMENSIONS)
    around = estimate(bent, "grp", "start").withColumn("mean", middle)
    plain = around.where(F.col("start") == 1).withColumns({
        "start": F.lit(0), "inverse": F.array(*[F.lit(float(i == j)) for i, j in PAIRS])})
    return around.unionByName(plain).withColumn("det", F.lit(float("inf")))


def least_determinant(points: DataFrame) -> DataFrame:
    """Per ``grp`` the ``mean``, ``inverse`` and ``det`` of the half of its points (``grp, varies, x``)
    with the least determinant that concentration finds."""
    before, met = keep(starts(points), "starts"), []
    active = before
    while True:  # ends: every further step needs a fall of FALL, and FLOOR bounds the determinant
        near = points.join(active.drop("det"), "grp").select("grp", "start", "varies", "x", distance().alias("d"))
        cuts = keep(near.groupBy("grp", "start").agg(F.percentile_approx("d", 0.5, 1000).alias("cut")), "cuts")
        half = near.join(cuts, ["grp", "start"]).where(F.col("d") <= F.col("cut"))
        moved = keep(estimate(half, "grp", "start"), "halves")
        met.append(moved)
        active = moved.join(before.select("grp", "start", F.col("det").alias("was")), ["grp", "start"]).where(
            F.col("det") < F.col("was") - FALL).drop("was")
        before = moved
        if active.isEmpty():
            break
    together = met[0]
    for moved in met[1:]:
        together = together.unionByName(moved)
    best = together.groupBy("grp").agg(F.min_by(F.struct("mean", "inverse", "det"), F.struct("det", "start")).alias("b"))
    return keep(best.select("grp", "b.*"), "least")


def calibrated(points: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with the ``scale`` that brings the median distance of a group's points down to that of
    chi-square."""
    near = points.join(found, "grp").select("grp", "varies", distance().alias("d"))
    middles = near.groupBy("grp").agg(
        F.percentile_approx("d", 0.5, 1000).alias("middle"), degrees(F.first("varies")).alias("degrees"))
    median = F.get(F.array(*[F.lit(m) for m in MEDIANS]), F.greatest(F.col("degrees") - 1, F.lit(0)))
    scales = middles.select("grp", "degrees", (median / F.greatest(F.col("middle"), median)).alias("scale"))
    return keep(found.join(scales, "grp"), "calibrated")


def degrees(varies: Column) -> Column:
    return F.size(F.filter(varies, lambda v: v))


def reweighted(points: DataFrame, found: DataFrame) -> DataFrame:
    """Mean and covariance of all points inside the chi-square bound of the least determinant's."""
    inside = F.get(F.array(*[F.lit(m) for m in INSIDE]), F.greatest(F.col("degrees") - 1, F.lit(0)))
    near = points.join(found, "grp").where(distance() * F.col("scale") <= inside)
    return keep(estimate(near.select("grp", "varies", "x"), "grp"), "reweighted")


def scaled(rows: DataFrame) -> DataFrame:
    """``x`` in units of its group's spreads, 0 for statistics without one; those make ``flat``."""
    off = [F.col("x")[i] - F.col("middles")[i] for i in range(DIMENSIONS)]
    varies = [F.col("varies")[i] for i in range(DIMENSIONS)]
    flat = sum((F.when(varies[i], 0.0).otherwise(F.pow(off[i] / FLAT, F.lit(2))) for i in STRICT), F.lit(0.0))
    return rows.withColumns({
        "flat": flat,
        "x": F.when(F.col("x").isNotNull(), F.array(*[
            F.when(varies[i], off[i] / F.col("spreads")[i]).otherwise(0.0) for i in range(DIMENSIONS)]))})


def groups(good: DataFrame) -> DataFrame:
    """For each ``lang_key`` and ``source_key`` the group whose estimate it takes."""
    sizes = good.groupBy("lang_key", "source_key").agg(F.count("*").alias("n"))
    totals = sizes.groupBy("lang_key").agg(F.sum("n").alias("total"))
    return sizes.join(totals, "lang_key").select(
        "lang_key", "source_key",
        F.when(F.col("n") >= LEAST, F.to_json(F.struct("lang_key", "source_key")))
        .when(F.col("total") >= LEAST, F.to_json(F.struct("lang_key")))
        .otherwise(F.lit("all")).alias("grp"))


def outliers(counted: DataFrame) -> DataFrame:
    """The counted rows with ``base_failed``, the squared ``distance`` (null for those that
    failed) and ``kept``."""
    counted = keep(counted, "statistics")  # costly, and read for the groups and for the rows
    keyed = counted.withColumn("base_failed", base_failed()).withColumns({
        f"{c}_key": F.coalesce(F.col(c), F.lit(NO_VALUE)) for c in ("lang", "source")})
    good = keyed.where(~F.col("base_failed"))
    rows = keep(
        keyed.join(keep(groups(good), "groups"), ["lang_key", "source_key"], "left")
        .withColumn("x", F.when(~F.col("base_failed"), F.array(*vector()))), "vectors")
    vectors = rows.where(~F.col("base_failed")).select("grp", "x")

    middles = vectors.groupBy("grp").agg(F.array(*[
        F.percentile_approx(F.col("x")[i], 0.5, 1000) for i in range(DIMENSIONS)]).alias("middles"))
    spreads = keep(vectors.join(middles, "grp").groupBy("grp").agg(
        F.first("middles").alias("middles"),
        F.array(*[
            F.percentile_approx(F.abs(F.col("x")[i] - F.col("middles")[i]), 0.5, 1000) / NORMAL
            for i in range(DIMENSIONS)]).alias("spreads"))
        .withColumn("varies", F.transform("spreads", lambda s: s > LEAST_SPREAD)), "spreads")
    rows = scaled(rows.join(spreads, "grp", "left"))
    points = keep(rows.where(~F.col("base_failed")).select("grp", "varies", "x"), "points")
    least = calibrated(points, least_determinant(points))
    found = calibrated(points, reweighted(points, least)).drop("degrees")
    return (
        rows.join(found, "grp", "left")
        .withColumn("distance", F.when(~F.col("base_failed"), distance() * F.col("scale") + F.col("flat")))
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= BOUND))
        .select(*counted.columns, "base_failed", "distance", "kept")
    )
