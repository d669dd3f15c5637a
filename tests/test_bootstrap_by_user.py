"""welch_bootstrap draws a weight for each user and repetition."""

import hashlib
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from feedlens.functions import resampling
from feedlens.operators import experiments as ex
from feedlens.plans import params as P

SF = "/root/testdata/sf0.01"


def _weights(user_id, reps):
    key = hashlib.md5(f"poisson:{user_id}".encode()).hexdigest()
    hi, lo = (np.full(reps, int(key[at:at + 8], 16)) for at in (0, 8))
    return np.searchsorted(resampling.poisson_bounds(1), resampling.draws(hi, lo, np.arange(reps)), side="right")


def _welch(a, b):
    a, b = (x[~np.isnan(x)] for x in (a, b))
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    return (a.mean() - b.mean()) / np.sqrt(va + vb), (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1))


def test_each_user_has_weights_of_their_own(spark, tmp_dir):
    """Users with equal likes and views, a user without views, a repeated event and events without user."""
    # (user, likes, views): few distinct pairs, many users each
    users = [(u, u // 4 % 3, 2 + u // 4 % 2) for u in range(160) if u % 4 in (1, 2)] + [(2001, 2, 0)]
    events = [(u, t) for u, likes, views in users for t in ["click"] * likes + ["view"] * views] + [(None, "view")] * 3
    duckdb.sql(f"""COPY (SELECT CAST(i AS BIGINT) AS event_id, TIMESTAMP '2024-01-09 10:00:00' AS ts, CAST(u AS BIGINT) AS user_id,
        t AS event_type, 1.0::DOUBLE AS value, '{{"k": 7}}' AS props FROM (VALUES {', '.join(
            f"({i}, {'NULL' if u is None else u}, '{t}')" for i, (u, t) in enumerate(events))}) v(i, u, t))
        TO '{tmp_dir}/events.parquet' (FORMAT parquet)""")
    sums = {g: np.zeros((2, P.BOOTSTRAP_REPS)) for g in P.AB_GROUPS}
    for u, likes, views in users:
        sums[u % 4] += np.outer([likes, views], _weights(u, P.BOOTSTRAP_REPS))
    t, df = _welch(*(sums[g][0] / sums[g][1] for g in P.AB_GROUPS))

    got = E.queries()["welch_bootstrap"](spark, tmp_dir).collect()
    assert [(r.group_a, r.group_b, r.n_a, r.n_b) for r in got] == [(1, 2, 3000, 3000)]
    assert got[0].t == pytest.approx(t, abs=2e-6) and got[0].df == pytest.approx(df, abs=2e-6)

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{os.path.join(tmp_dir, 'events.parquet')}')")
    want = con.execute(E.oracle_sql()["welch_bootstrap"]).fetchall()
    assert len(want) == 1 and tuple(got[0]) == pytest.approx(want[0], abs=2e-6)


def test_by_user_repetitions_of_zeros_stay_and_tasks_do_not_matter(spark):
    users = spark.createDataFrame([(1, 5, 2, 3), (2, 6, 1, 4), (2, 7, 0, 4), (2, 7, 0, 4), (3, 8, 1, 1)],
                                  "exp_group int, user_id bigint, likes bigint, views bigint")
    rows = sorted(map(tuple, ex.poisson_bootstrap_by_user(users, (1, 2), reps=50, tasks=1).collect()))
    w = {u: _weights(u, 50).tolist() for u in (5, 6, 7)}
    assert 0 in w[5]
    one = [(1, b, 2 * w[5][b], 3 * w[5][b], 2 / 3 if w[5][b] else None) for b in range(50)]
    two = [(2, b, w[6][b], 4 * w[6][b] + 8 * w[7][b]) for b in range(50)]
    assert [r[:4] for r in rows] == [r[:4] for r in one] + two
    assert [r[4] for r in rows[:50]] == [r[4] if r[4] is None else pytest.approx(r[4]) for r in one]
    assert sorted(map(tuple, ex.poisson_bootstrap_by_user(users, (1, 2), reps=50, tasks=5).collect())) == rows


def test_ab_results_rows_against_what_their_sql_draws(spark, actions001):
    """ab_results keeps its SQL: its bootstrap row has a draw per cell, its other rows are their single-test keys."""
    by_test = {(r.test, r.group_a, r.group_b): r for r in E.queries()["ab_results"](spark, SF).collect()}
    boot = ex.poisson_bootstrap(ex.user_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS), P.AB_GROUPS, P.BOOTSTRAP_REPS)
    single = ex.welch_pairs(boot, "ctr", [P.AB_GROUPS]).first()
    assert by_test[("welch_bootstrap_ctr", 1, 2)].statistic == pytest.approx(single.t, abs=1e-6)
    for test, key, value in (("welch_bucket_ctr", "welch_bucket", "t"), ("mann_whitney_bucket_ctr", "mann_whitney_bucket", "u_a"),
                             ("welch_linearized_likes", "welch_linearized", "t")):
        for single in E.queries()[key](spark, SF).collect():
            assert by_test[(test, single.group_a, single.group_b)].statistic == pytest.approx(single[value], abs=1e-6)
