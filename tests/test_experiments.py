import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedlens.functions import permutation
from feedlens.functions.columns import draw32, hash_halves, salt_offset, uniform_bucket
from feedlens.operators import experiments as ex
from feedlens.operators.ordering import running_total
from feedlens.plans import params as P


def _users(spark, rows):
    return spark.createDataFrame(rows, "exp_group int, user_id bigint, likes bigint, views bigint") \
        .withColumn("ctr", F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")))


def test_mann_whitney_with_ties(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 2.0), (1, 3.0), (2, 2.0), (2, 3.0), (2, 4.0)],
                               "g int, x double")
    r = ex.mann_whitney(df, "x", "g", 1, 2).first()
    assert (r.n_a, r.n_b) == (4, 3)
    assert r.u_a == pytest.approx(2.5) and r.u_b == pytest.approx(9.5)
    assert r.tie_sum == pytest.approx(30.0)


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_mann_whitney_equals_pair_counting(spark, ranges):
    rng = np.random.default_rng(7)
    a = rng.integers(0, 12, 60).astype(float)
    b = rng.integers(2, 15, 45).astype(float)
    rows = [(1, float(v)) for v in a] + [(2, float(v)) for v in b] + [(1, None), (3, 5.0)]
    df = spark.createDataFrame(rows, "g int, x double")
    r = ex.mann_whitney(df, "x", "g", 1, 2, ranges=ranges).first()
    u1 = sum((x > y) + 0.5 * (x == y) for x, y in itertools.product(a, b))
    assert r.u_a == pytest.approx(u1)
    assert r.u_a + r.u_b == pytest.approx(len(a) * len(b))
    _, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    assert r.tie_sum == pytest.approx(float((counts ** 3 - counts).sum()))


def test_running_total_with_ties(spark):
    vals = [3.0, 1.0, 2.0, 2.0, 5.0, 1.0, 9.0, 7.0, 7.0, 4.0]
    df = spark.createDataFrame([(v, 1) for v in vals], "v double, c long")
    got = {r.v: r.cum for r in running_total(df, "v", "c", "cum", ranges=4).collect()}
    s = pd.Series(vals)
    for v in set(vals):
        assert got[v] == int((s <= v).sum())


def test_welch_matches_formula(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0.2, 1.0, 40), rng.normal(0.5, 2.0, 25)
    df = spark.createDataFrame([(1, float(x)) for x in a] + [(2, float(x)) for x in b], "g int, x double")
    r = ex.welch_stats(df, "x", "g", 1, 2).first()
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    assert r.t == pytest.approx((a.mean() - b.mean()) / np.sqrt(va + vb), rel=1e-10)
    assert r.df == pytest.approx((va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1)), rel=1e-10)


def test_zero_view_user(spark):
    users = _users(spark, [(1, 1, 1, 0), (1, 2, 1, 4), (1, 3, 2, 4), (2, 4, 1, 2), (2, 5, 0, 3), (2, 6, 3, 3)])
    assert users.where("user_id = 1").first().ctr is None
    w = ex.welch_pairs(users, "ctr", [(1, 2)]).first()
    assert (w.n_a, w.n_b) == (2, 3)          # left out of the t-test
    g = {r.exp_group: r for r in ex.global_ctr(users).collect()}
    assert g[1].global_ctr == pytest.approx(4 / 8)   # kept in the global CTR
    s = {r.user_id: r.smoothed_ctr for r in ex.smoothed_ctr(users, (1, 2)).collect()}
    assert s[1] == pytest.approx((1 + 5 * 0.5) / (0 + 5))


def test_linearized_control_mean_is_zero(spark):
    users = _users(spark, [(0, 1, 1, 5), (0, 2, 3, 7), (3, 3, 2, 4), (3, 4, 0, 6)])
    lin = ex.linearized_likes(users, [(0, 3)])
    m = {r.exp_group: r.mean_linearized_likes for r in ex.linearized_means(lin).collect()}
    assert m[0] == pytest.approx(0.0, abs=1e-12)
    c = 4 / 12
    assert m[3] == pytest.approx(((2 - c * 4) + (0 - c * 6)) / 2)


def _py_mix(x):
    for _ in range(2):
        x = ((x ^ (x >> 16)) * 0x45D9F3B) & 0xFFFFFFFF
    return x ^ (x >> 16)


def _py_halves(salt, user):
    import hashlib
    h = hashlib.md5(f"{salt}:{user}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16)


def _py_draw(hi, lo, rep):
    return _py_mix((_py_mix((lo + rep * 0x9E3779B1) & 0xFFFFFFFF) + hi) & 0xFFFFFFFF)


def test_draws_match_python(spark):
    df = spark.createDataFrame([(u, r) for u in (0, 5, 123456789012) for r in (0, 1, 9999)], "u bigint, r int")
    got = df.select("u", "r", draw32(*hash_halves("aa", "u"), "r").alias("h")).collect()
    for row in got:
        assert row.h == _py_draw(*_py_halves("aa", row.u), row.r)


def test_draw_keys_use_all_64_bits(spark):
    """Users that share either half of the key do not share their draws."""
    rows = [(hi, lo, r) for hi, lo in ((1, 2), (1, 3), (4, 2)) for r in range(50)]
    got = (spark.createDataFrame(rows, "hi bigint, lo bigint, r int").withColumn("h", draw32("hi", "lo", "r"))
           .groupBy("hi", "lo").agg(F.sort_array(F.collect_list("h")).alias("d")).collect())
    assert len({tuple(r.d) for r in got}) == 3


def test_buckets_are_even_and_ignore_the_salt_of_others(spark):
    df = spark.range(40000).select(uniform_bucket("bucket", "id", 20).alias("a"), uniform_bucket("other", "id", 20).alias("b"))
    counts = [r["count"] for r in df.groupBy("a").count().collect()]
    assert len(counts) == 20 and max(counts) < 1.1 * 2000 and min(counts) > 0.9 * 2000
    assert df.where("a = b").count() == pytest.approx(2000, rel=0.1)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 37, 64, 1000, 4097])
def test_permutation_is_a_permutation(n):
    for stream in (0, 1, 77):
        keys = permutation.round_keys(salt_offset("aa"), stream, 2)
        assert sorted(permutation.permuted(np.arange(n), n, keys).tolist()) == list(range(n))


def test_permutation_visits_every_place_evenly():
    n, streams = 12, 6000
    keys = [np.repeat(k, n) for k in permutation.round_keys(salt_offset("x"), np.arange(streams), 0)]
    images = permutation.permuted(np.tile(np.arange(n), streams), n, keys).reshape(streams, n)
    for place in range(n):
        counts = np.bincount(images[:, place], minlength=n)
        # 5 sigma of a binomial count with mean 500
        assert abs(counts - streams / n).max() < 5 * np.sqrt(streams / n)


def test_aa_samples_are_samples(spark):
    rows = [(2 + (u % 2), 10 * u, u % 5, 5 + u % 3) for u in range(41)]
    users = _users(spark, rows)
    got = ex.aa_samples(users, (2, 3), reps=30, sample=6).toPandas()
    assert (got.groupby(["sim", "exp_group"]).user_id.nunique() == 6).all() and len(got) == 30 * 2 * 6
    own = {(r[0], r[1]) for r in rows}
    assert set(zip(got.exp_group, got.user_id)) <= own
    ids = {g: sorted(u for h, u in own if h == g) for g in (2, 3)}
    for (sim, g), part in got.groupby(["sim", "exp_group"]):
        keys = permutation.round_keys(salt_offset("aa"), int(sim), int(g))
        want = permutation.permuted(np.arange(6), len(ids[g]), keys)
        assert sorted(part.user_id) == sorted(ids[g][i] for i in want)
    whole = ex.aa_samples(users, (2, 3), reps=2, share=1.0).toPandas()
    assert set(zip(whole.exp_group, whole.user_id)) == own and len(whole) == 2 * 41


def test_aa_draws_do_not_grow_with_the_group(spark):
    """The rows drawn are reps x groups x sample for any number of users."""
    for n in (200, 2000):
        users = _users(spark, [(2 + (u % 2), u, 1, 5) for u in range(n)])
        assert ex.aa_samples(users, (2, 3), reps=20, sample=5).count() == 20 * 2 * 5


def test_aa_group_too_small(spark):
    users = _users(spark, [(2, 1, 1, 2), (3, 2, 1, 2), (3, 3, 0, 1)])
    with pytest.raises(Exception, match="larger than a group"):
        ex.aa_samples(users, (2, 3), reps=3, sample=2).collect()


def test_aa_p_values_uniform_under_null(spark):
    # Two groups drawn from one law: the share of p <= 0.05 should be near 0.05.
    rows = [(2 + (u % 2), u, int(_py_halves("law", u)[0] % 7), 10) for u in range(2000)]
    users = _users(spark, rows)
    stats = ex.aa_stats(ex.aa_samples(users, (2, 3), reps=2000, sample=50), (2, 3))
    s = ex.aa_summary(ex.with_t_p_value(stats)).first()
    assert s.n_sims == 2000
    assert 0.03 <= s.fp_share <= 0.07


def test_repeated_pair_changes_nothing(spark, actions001):
    users = ex.user_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.ALL_GROUPS)
    once = ex.welch_pairs(users, "ctr", [(0, 3), (1, 2)]).collect()
    twice = ex.welch_pairs(users, "ctr", [(0, 3), (1, 2), (1, 2)]).collect()
    assert sorted(map(tuple, once)) == sorted(map(tuple, twice))


def test_ab_tests_scan_events_once(spark, actions001):
    """All tests read the materialized per-user table: the plan holds no scan of events."""
    out = ex.ab_tests(ex.user_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.ALL_GROUPS), P.LINEARIZED_PAIRS,
                      P.AB_GROUPS, reps=20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "Scan ExistingRDD" in plan


def test_bucket_ctr_of_users_equals_bucket_ctr_of_events(spark, actions001):
    users = ex.user_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS)
    a = ex.bucket_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS, 20)
    b = ex.bucket_ctr_of_users(users, P.AB_GROUPS, 20)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_mann_whitney_methods(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (1, 5.0), (2, 2.0), (2, 4.0), (2, 6.0)], "g int, x double")
    stats = ex.mann_whitney(df, "x", "g", 1, 2)
    auto, exact, normal = (ex.with_normal_p_value(stats, method=m).first() for m in ("auto", "exact", "asymptotic"))
    assert auto.method == exact.method == "exact" and auto.p_value == exact.p_value == pytest.approx(0.7)
    assert normal.method == "asymptotic" and normal.p_value != auto.p_value
    tied = ex.mann_whitney(spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 2.0)], "g int, x double"), "x", "g", 1, 2)
    assert ex.with_normal_p_value(tied).first().method == "asymptotic"
    with pytest.raises(Exception, match="ties"):
        ex.with_normal_p_value(tied, method="exact").collect()


def test_histogram_by_pair_has_edges_of_its_own(spark):
    rows = [(0, 3, 0, float(v)) for v in range(11)] + [(1, 2, 1, 100.0 + 2 * v) for v in range(6)]
    df = spark.createDataFrame(rows, "group_a int, group_b int, exp_group int, x double")
    got = {(r.group_a, r.bin): (r.bin_lo, r.bin_hi, r.n)
           for r in ex.histogram(df, "x", "exp_group", bins=5, by=("group_a", "group_b")).collect()}
    assert got[(0, 0)] == (0.0, 2.0, 2) and got[(0, 4)] == (8.0, 10.0, 3)
    assert got[(1, 0)] == (100.0, 102.0, 1) and got[(1, 4)] == (108.0, 110.0, 2)
    assert ex.histogram(df.where("x < 0"), "x", bins=5).count() == 0


def test_bootstrap_mean_near_global_ctr(spark, actions001):
    users = ex.user_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS)
    boot = ex.poisson_bootstrap(users, P.AB_GROUPS, reps=400)
    mean = {r.exp_group: r.m for r in boot.groupBy("exp_group").agg(F.avg("ctr").alias("m")).collect()}
    glob = {r.exp_group: r.global_ctr for r in ex.global_ctr(users).collect()}
    for g in P.AB_GROUPS:
        assert mean[g] == pytest.approx(glob[g], rel=0.03)


def test_results_do_not_depend_on_partitions(spark, actions001):
    from feedlens.plans.catalog import queries
    qs = queries()
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append({k: sorted(map(tuple, qs[k](spark, "/root/testdata/sf0.01").collect()))
                             for k in ("mann_whitney", "aa_stats", "poisson_bootstrap", "weekly_audience")})
        assert results[0] == results[1] == results[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def test_aa_draws_are_bounded_by_ranges(spark, monkeypatch):
    """A sample of half a group is drawn range by range; the rows do not depend on the ranges."""
    users = spark.createDataFrame([(g, u, u / 7) for g in (2, 3) for u in range(40 + g)],
                                  "exp_group int, user_id bigint, ctr double")
    plain = sorted(map(tuple, ex.aa_samples(users, reps=6, share=0.5).collect()))
    permuted = ex.permutation.permuted

    def bounded(numbers, *args):
        assert len(numbers) <= 8
        return permuted(numbers, *args)

    monkeypatch.setattr(ex.permutation, "permuted", bounded)
    monkeypatch.setattr(ex, "DRAWS", 8, raising=False)
    assert sorted(map(tuple, ex.aa_samples(users, reps=6, share=0.5).collect())) == plain
    assert len(plain) == len(set(plain)) == 6 * (21 + 21)
