"""The covariance of the quality rules against a search in numpy, and outliers of two statistics at once."""

import numpy as np
from pyspark.sql import functions as F

from cairn.llm import quality

VARIES = [True, False, False, False, True, True, True]


def cloud(rng, size, far):
    """Correlated points in the varying dimensions, the last ``far`` of them off the others' plane."""
    mix = rng.normal(size=(4, 4))
    points = rng.normal(size=(size, 4)) @ mix
    points[size - far:] = rng.normal(size=(far, 4)) * 0.3 + 6 * mix.sum(axis=0)
    full = np.zeros((size, 7))
    full[:, [0, 4, 5, 6]] = points
    return full


def log_determinant(points):
    return np.linalg.slogdet(np.cov(points.T, bias=True) + quality.FLOOR * np.eye(points.shape[1]))[1]


def searched(points, half, rng, tries=300):
    """The least determinant of ``half`` points by concentration from random small subsets."""
    best = np.inf
    for _ in range(tries):
        take = rng.choice(len(points), 6, replace=False)
        for _ in range(30):
            mean = points[take].mean(axis=0)
            off = points - mean
            inverse = np.linalg.inv(np.cov(points[take].T, bias=True) + quality.FLOOR * np.eye(points.shape[1]))
            take = np.argsort((off @ inverse * off).sum(axis=1), kind="stable")[:half]
        best = min(best, log_determinant(points[take]))
    return best


def test_least_determinant_is_that_of_a_search(spark):
    rng = np.random.default_rng(8)
    groups = {f"g{i}": cloud(rng, 80, 8 * i) for i in range(4)}
    points = spark.createDataFrame(
        [(g, VARIES, [float(v) for v in p]) for g, rows in groups.items() for p in rows],
        "grp string, varies array<boolean>, x array<double>")
    found = {r.grp: r for r in quality.least_determinant(points).collect()}
    assert set(found) == set(groups)
    for name, rows in groups.items():
        some = rows[:, [0, 4, 5, 6]]
        assert found[name].det <= searched(some, 40, rng) + 0.1, name


def test_distances_are_those_of_the_inverse(spark):
    rng = np.random.default_rng(9)
    rows = cloud(rng, 50, 0)
    points = spark.createDataFrame(
        [("g", VARIES, [float(v) for v in p]) for p in rows], "grp string, varies array<boolean>, x array<double>")
    estimated = quality.estimate(points, "grp")
    got = sorted(r.d for r in points.join(estimated, "grp").select(quality.distance().alias("d")).collect())
    some = rows[:, [0, 4, 5, 6]]
    off = some - some.mean(axis=0)
    want = (off @ np.linalg.inv(np.cov(some.T, bias=True) + quality.FLOOR * np.eye(4)) * off).sum(axis=1)
    assert np.allclose(got, sorted(want))
    assert np.isclose(estimated.first().det, log_determinant(some))


def counted(i, commas, ends):
    return (i, "en", "s", 200, 1000 + i % 37, 0, 0, 0, commas, ends, 400 + (i * 7) % 41)


FIELDS = (
    "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, n_commas bigint, n_ends bigint, n_vowels bigint")


def test_outliers_of_two_statistics_at_once(spark):
    """Commas and ends rise together; many of the one with few of the other is an outlier, though
    neither number is rare."""
    rng = np.random.default_rng(10)
    level = rng.integers(20, 60, 400)
    rows = [counted(i, int(n), int(n // 2 + rng.integers(0, 3))) for i, n in enumerate(level)]
    rows += [counted(400 + i, 24, 27 + i) for i in range(4)] + [counted(404 + i, 56, 12 + i) for i in range(4)]
    got = {r.doc_id: r for r in quality.outliers(spark.createDataFrame(rows, FIELDS)).collect()}
    assert sum(got[i].kept for i in range(400)) >= 392
    assert not any(got[i].kept for i in range(400, 408))
    ends = [r[9] for r in rows[:400]]
    assert min(ends) <= 12 and max(ends) >= 30


def test_equal_rows_and_small_groups(spark):
    """No statistic varies: nothing is far from the rest but what has a strict statistic of its own."""
    rows = [counted(0, 30, 15)] * 70 + [(9, "en", "s", 200, 1000, 150, 0, 0, 30, 15, 400)]
    got = quality.outliers(spark.createDataFrame(rows, FIELDS)).collect()
    assert len(got) == 71 and all(r.kept for r in got if r.doc_id == 0)
    assert [r.kept for r in got if r.doc_id == 9] == [False]
    assert quality.least_determinant(
        spark.createDataFrame([], "grp string, varies array<boolean>, x array<double>")).where(F.lit(True)).count() == 0
