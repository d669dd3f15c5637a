import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def test_weekly_audience_approx_close_to_exact(spark):
    qs = E.queries()
    exact = {(r.this_week, r.status): r.num_users for r in qs["weekly_audience"](spark, SF).collect()}
    approx = {(r.this_week, r.status): r.num_users for r in qs["weekly_audience_approx"](spark, SF).collect()}
    assert set(exact) == set(approx)
    for k, v in exact.items():
        assert approx[k] == pytest.approx(v, rel=0.05)


def test_ab_results_decisions(spark):
    rows = E.queries()["ab_results"](spark, SF).collect()
    names = {r.test for r in rows}
    assert names == {"welch_ctr", "mann_whitney_ctr", "welch_smoothed_ctr", "welch_bootstrap_ctr",
                     "welch_bucket_ctr", "mann_whitney_bucket_ctr", "welch_linearized_likes"}
    by_test = {(r.test, r.group_a, r.group_b): r for r in rows}
    assert len(by_test) == len(rows) == 9
    # each row is its own single-test key
    for test, key, value in (("welch_ctr", "welch_ctr_pairs", "t"), ("mann_whitney_ctr", "mann_whitney", "u_a"),
                             ("welch_smoothed_ctr", "welch_smoothed", "t"), ("welch_bootstrap_ctr", "welch_bootstrap", "t"),
                             ("welch_bucket_ctr", "welch_bucket", "t"),
                             ("mann_whitney_bucket_ctr", "mann_whitney_bucket", "u_a"),
                             ("welch_linearized_likes", "welch_linearized", "t")):
        for single in E.queries()[key](spark, SF).collect():
            row = by_test[(test, single.group_a, single.group_b)]
            assert row.statistic == pytest.approx(single[value], abs=1e-6)
    single = E.queries()["welch_ctr"](spark, SF).first()
    assert by_test[("welch_ctr", 1, 2)].statistic == pytest.approx(single.t, abs=1e-6)
    assert by_test[("welch_ctr", 1, 2)].df == pytest.approx(single.df, abs=1e-6)
    for r in rows:
        assert 0.0 <= r.p_value <= 1.0
        assert r.decision == ("rejected" if r.p_value < 0.05 else "not rejected")


def test_aa_outputs(spark):
    qs = E.queries()
    s = qs["aa_summary"](spark, SF).first()
    assert s.n_sims == 10000
    assert 0.0 <= s.fp_share <= 1.0
    hist = qs["aa_pvalue_histogram"](spark, SF).collect()
    assert sum(r.n for r in hist) == 10000
    assert sorted(r.bin for r in hist) == list(range(10))
