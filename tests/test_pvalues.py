import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.functions.pvalues import (
    betainc_regularized, normal_p_value, normal_two_sided_upper, student_t_two_sided, t_test_p_value,
)


def test_known_welch_p_value():
    # t = 2 with 10 degrees of freedom (FIXTURES.md, hand-made cases)
    assert student_t_two_sided([2.0], [10.0])[0] == pytest.approx(0.0733880348, abs=1e-9)


def test_t_p_value_limits():
    p = student_t_two_sided([0.0, 1e9, -2.0, 1.959963984540054], [7.0, 5.0, 10.0, 1e9])
    assert p[0] == pytest.approx(1.0)
    assert p[1] == pytest.approx(0.0, abs=1e-12)
    assert p[2] == pytest.approx(0.0733880348, abs=1e-9)
    assert p[3] == pytest.approx(0.05, abs=1e-6)


def test_incomplete_beta_symmetry_and_values():
    # I_x(a, a) at x = 1/2 is 1/2; I_x(1, 1) = x; I_x(a, 1) = x^a
    assert betainc_regularized(3.5, 3.5, 0.5)[()] == pytest.approx(0.5, abs=1e-12)
    assert betainc_regularized(1.0, 1.0, 0.3)[()] == pytest.approx(0.3, abs=1e-12)
    assert betainc_regularized(2.5, 1.0, 0.4)[()] == pytest.approx(0.4 ** 2.5, abs=1e-12)


def test_normal_p_value():
    p = normal_two_sided_upper([1.959963984540054, 0.0, -0.5, float("nan")])
    assert p[0] == pytest.approx(0.05, abs=1e-9)
    assert p[1] == pytest.approx(1.0)
    assert p[2] == 1.0
    assert math.isnan(p[3])


def test_udfs_on_spark_keep_nulls(spark):
    df = spark.createDataFrame([(2.0, 10.0, 1.959963984540054), (None, None, None)], "t double, df double, z double")
    rows = df.select(t_test_p_value(F.col("t"), F.col("df")).alias("p"),
                     normal_p_value(F.col("z")).alias("q")).collect()
    assert rows[0].p == pytest.approx(0.0733880348, abs=1e-9)
    assert rows[0].q == pytest.approx(0.05, abs=1e-9)
    assert rows[1].p is None and rows[1].q is None


def test_matches_monte_carlo_t():
    rng = np.random.default_rng(1)
    df = 6.3
    sample = rng.standard_t(df, size=400_000)
    for t in (0.5, 1.7, 2.9):
        assert student_t_two_sided([t], [df])[0] == pytest.approx(np.mean(np.abs(sample) >= t), abs=3e-3)


def _brute_u_dist(m, n):
    import itertools
    from collections import Counter
    c = Counter()
    for pos in itertools.combinations(range(m + n), m):
        # U of the first sample = pairs (x in first, y in second) with x > y, ranks = positions
        others = [i for i in range(m + n) if i not in pos]
        c[sum(1 for x in pos for y in others if x > y)] += 1
    return c


def test_exact_u_counts_match_enumeration():
    from feedlens.functions.pvalues import _u_counts
    for m, n in ((1, 1), (2, 3), (4, 3), (3, 5)):
        brute = _brute_u_dist(m, n)
        assert _u_counts(m, n) == [brute.get(u, 0) for u in range(m * n + 1)]


def test_mann_whitney_exact_small_groups(spark):
    from feedlens.functions.pvalues import mann_whitney_exact_p
    from feedlens.operators import experiments as ex
    a, b = [1.0, 2.5, 3.0, 7.0], [4.0, 5.0, 6.0]
    df = spark.createDataFrame([(1, x) for x in a] + [(2, x) for x in b], "g int, x double")
    r = ex.with_normal_p_value(ex.mann_whitney(df, "x", "g", 1, 2)).first()
    assert r.method == "exact" and r.u_a == 3.0
    dist = _brute_u_dist(3, 4)
    tail = sum(v for u, v in dist.items() if u >= max(r.u_a, r.u_b)) / sum(dist.values())
    assert r.p_value == pytest.approx(min(1.0, 2 * tail))
    assert mann_whitney_exact_p(6.0, 6.0, 3, 4) == 1.0
    ties = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 2.0), (2, 3.0)], "g int, x double")
    assert ex.with_normal_p_value(ex.mann_whitney(ties, "x", "g", 1, 2)).first().method == "asymptotic"


def test_t_p_value_at_large_df():
    """Student's law meets the normal law as df grows; the tails agree to the order of 1/df."""
    at, over = student_t_two_sided([0.5, 1.96, 4.0], [2e5] * 3), student_t_two_sided([0.5, 1.96, 4.0], [2e5 + 1] * 3)
    assert over == pytest.approx(at, rel=1e-8)  # where the formula changes
    for df in (1e5, 1e6, 1e9, 1e10, 1e13, 1e15):
        for t in (0.3, 1.0, 1.959963984540054, 4.0):
            want = math.erfc(t / math.sqrt(2))
            assert student_t_two_sided([t], [df])[0] == pytest.approx(want, rel=1e-9 + 100 / df)


def test_exact_law_has_a_clear_bound():
    from feedlens.functions.pvalues import mann_whitney_exact_p
    with pytest.raises(ValueError, match="asymptotic"):
        mann_whitney_exact_p(5.0, 3.0, 8, 10**9)
