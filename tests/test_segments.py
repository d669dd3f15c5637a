"""Attribute combinations behind a drop, against a plain loop over all of them."""

import datetime as dt
import math
from itertools import combinations

import pytest

from feedlens.operators import segments
from feedlens.sources.actions import FEED_SCHEMA, MESSAGE_SCHEMA, Actions

DIMS = ("os", "gender", "age", "source")
BASE, DROP = dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 8, 12)


def _actions(spark, users):
    """users: (user_id, [(os, age, gender, source), ...], came)"""
    rows = [(u, 1, "view", BASE, 0, o, a, g, s) for u, sets, _ in users for o, a, g, s in sets]
    rows += [(u, 1, "view", DROP, 0, o, a, g, s) for u, sets, came in users if came for o, a, g, s in sets[:1]]
    return Actions(spark.createDataFrame(rows, FEED_SCHEMA), spark.createDataFrame([], MESSAGE_SCHEMA))


def _plain(users, min_share):
    having, gone = {}, {u for u, _, came in users if not came}
    for u, sets, _ in users:
        for o, a, g, s in sets:
            known = [(d, None if v is None else str(v)) for d, v in (("os", o), ("gender", g), ("age", a), ("source", s))]
            for size in range(0, 5):
                for c in combinations(known, size):
                    if all(v is not None for _, v in c):
                        having.setdefault(frozenset(c), set()).add(u)
    least = math.ceil(len(users) * min_share)
    share = {c: len(us & gone) / len(us) for c, us in having.items() if len(us) >= least}
    return {c: (len(having[c]), len(having[c] & gone), max(share[c - {x}] for x in c)) for c in share if c}


def _found(df):
    return {frozenset((d, r[d]) for d in DIMS if r[d] is not None): r for r in df.collect()}


@pytest.mark.parametrize("min_share", [0.0, 0.03, 0.2])
def test_every_supported_combination(spark, min_share):
    import random
    rnd = random.Random(1)

    def attributes():
        return (rnd.choice(["iOS", "Android", None]), rnd.choice([20, 30, 40]), rnd.choice([0, 1]), rnd.choice(["ads", "organic"]))

    users = [(u, [attributes() for _ in range(rnd.choice([1, 1, 1, 2, 3]))], rnd.random() < 0.7) for u in range(150)]
    got = _found(segments.audience_drop_segments(_actions(spark, users), BASE.date(), BASE.date(), DROP.date(), min_share=min_share))
    want = _plain(users, min_share)
    assert set(got) == set(want)
    for c, (n, gone, best) in want.items():
        r = got[c]
        assert (r.n_dimensions, r.users_base, r.users_missing) == (len(c), n, gone)
        assert r.best_parent_share == pytest.approx(best) and r.share_missing == pytest.approx(gone / n)
        assert r.lift == (pytest.approx(gone / n / best) if best else None)


def test_planted_pair_comes_first(spark):
    """Only Android users from ads stay away more often; neither attribute alone, nor a finer combination, explains more."""
    import random
    rnd = random.Random(2)
    users = []
    for u in range(3000):
        o, a, g, s = rnd.choice(["iOS", "Android"]), rnd.choice([20, 30, 40]), rnd.choice([0, 1]), rnd.choice(["ads", "organic"])
        users.append((u, [(o, a, g, s)], rnd.random() > (0.8 if (o, s) == ("Android", "ads") else 0.1)))
    out = segments.audience_drop_segments(_actions(spark, users), BASE.date(), BASE.date(), DROP.date())
    first = out.orderBy("z", ascending=False).first()
    assert (first.os, first.source, first.gender, first.age, first.n_dimensions) == ("Android", "ads", None, None, 2)
    assert out.orderBy("lift", ascending=False).where("users_base > 300").first().os == "Android"


def test_values_below_the_bound_are_not_expanded(spark):
    users = [(u, [("iOS", 1000 + u, 0, "ads")], True) for u in range(60)]
    out = segments.audience_drop_segments(_actions(spark, users), BASE.date(), BASE.date(), DROP.date(), min_share=0.5).collect()
    assert len(out) == 7 and all(r.age is None for r in out)
    assert [r.z for r in out] == [None] * 7       # nobody is missing


def test_no_users(spark):
    assert segments.audience_drop_segments(_actions(spark, []), BASE.date(), BASE.date(), DROP.date()).count() == 0
