"""A/A and A/B experiment evaluation on the per-user CTR table.

Every statistic is an aggregate: per-group moments (count, mean, sample
variance) come out of one partial + final hash aggregate, so the shuffle holds
a handful of rows per task no matter how many users there are. Resampling works
on counts: users with the same likes and views are one row of the bootstrap, whose
weight is one Poisson draw of their number; an A/A simulation deals its sample over
the distinct values of the metric. Both cost repetitions x distinct values, whatever
the number of users. ``aa_samples`` has the sampled users themselves and
``poisson_bootstrap_by_user`` a weight for each user, which costs repetitions x users.
Only p-values, weights and sampled row numbers use Python (``functions.pvalues``,
``functions.resampling``, ``functions.permutation``), never events.

Group and pair lists are parameters, so the small tables built from them
(pairs, group totals) have a proven size and are broadcast explicitly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions import permutation, resampling
from feedlens.functions.columns import draw32, hash_halves, poisson1_weight, ratio, salt_offset, uniform_bucket, xxh64_bucket
from feedlens.functions.pvalues import decision, mann_whitney_method, mann_whitney_p_value, t_test_p_value
from feedlens.operators.ordering import RANGES, materialize, row_index, running_total
from feedlens.operators.timeframe import where_days

# Defaults of the reference study (fixed values).
ALPHA = 0.05
SMOOTHING_WEIGHT = 5
BOOTSTRAP_REPS = 3000
BUCKETS = 200
AA_REPS = 10000
AA_SAMPLE = 500

Pair = tuple[int, int]


# --------------------------------------------------------------------------
# per-user table
# --------------------------------------------------------------------------

def user_ctr(feed: DataFrame, start: dt.date | str, end: dt.date | str,
             groups: Sequence[int] | None = None) -> DataFrame:
    """Likes, views and CTR per (exp_group, user_id) over the inclusive days
    [start, end]. CTR is NULL for a user without views."""
    f = where_days(feed, start, end)
    if groups is not None:
        f = f.where(F.col("exp_group").isin(*groups))
    return (f.groupBy("exp_group", "user_id")
            .agg(F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_if(F.col("action") == "view").alias("views"))
            .withColumn("ctr", ratio("likes", "views")))


def group_sizes(users: DataFrame) -> DataFrame:
    """Non-NULL count of every column per experiment group."""
    cols = [c for c in users.columns if c != "exp_group"]
    return users.groupBy("exp_group").agg(*[F.count(c).alias(c) for c in cols])


def global_ctr(users: DataFrame) -> DataFrame:
    """Total likes / total views per group (users without views count too)."""
    return (users.groupBy("exp_group")
            .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
            .withColumn("global_ctr", ratio("likes", "views")))


# --------------------------------------------------------------------------
# Welch t-test
# --------------------------------------------------------------------------

def _welch(n_a: Column, n_b: Column, m_a: Column, m_b: Column, v_a: Column, v_b: Column):
    se_a = F.try_divide(v_a, n_a)
    se_b = F.try_divide(v_b, n_b)
    se2 = se_a + se_b
    t = F.try_divide(m_a - m_b, F.sqrt(se2))
    df = F.try_divide(se2 * se2, F.try_divide(se_a * se_a, n_a - 1) + F.try_divide(se_b * se_b, n_b - 1))
    return t, df


def welch_stats(df: DataFrame, value: str, side_col: str, a, b,
                keys: Sequence[str] = ()) -> DataFrame:
    """Welch statistics comparing rows with ``side_col == a`` against
    ``side_col == b``, per key (or overall). NULL values are skipped.

    Columns: keys..., n_a, n_b, mean_a, mean_b, var_a, var_b, t, df.
    """
    side, x = F.col(side_col), F.col(value)
    xa, xb = F.when(side == a, x), F.when(side == b, x)
    g = df.groupBy(*keys) if keys else df.groupBy()
    out = g.agg(F.count(xa).alias("n_a"), F.count(xb).alias("n_b"),
                F.avg(xa).alias("mean_a"), F.avg(xb).alias("mean_b"),
                F.var_samp(xa).alias("var_a"), F.var_samp(xb).alias("var_b"))
    t, dof = _welch(F.col("n_a"), F.col("n_b"), F.col("mean_a"), F.col("mean_b"),
                    F.col("var_a"), F.col("var_b"))
    return out.select("*", t.alias("t"), dof.alias("df"))


def with_t_p_value(stats: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add the two-sided Welch p-value and the decision at alpha."""
    p = t_test_p_value(F.col("t"), F.col("df"))
    return stats.withColumn("p_value", p).withColumn("decision", decision(F.col("p_value"), alpha))


def pair_sides(spark, pairs: Sequence[Pair], group_col: str = "exp_group") -> DataFrame:
    """One row per (pair, side): group_a, group_b, <group_col>, side ('a'/'b').
    A pair listed twice counts once. Its size is 2 x len(pairs)."""
    distinct = dict.fromkeys((int(a), int(b)) for a, b in pairs)
    rows = [(a, b, g, s) for a, b in distinct for g, s in ((a, "a"), (b, "b"))]
    return spark.createDataFrame(rows, f"group_a int, group_b int, {group_col} int, side string")


def attach_pairs(users: DataFrame, pairs: Sequence[Pair], group_col: str = "exp_group") -> DataFrame:
    """Repeat each user row once per pair holding its group (broadcast join
    with the pair table, whose size is bounded by the parameter)."""
    p = pair_sides(users.sparkSession, pairs, group_col)
    return users.join(F.broadcast(p), group_col)


def welch_pairs(users: DataFrame, value: str, pairs: Sequence[Pair],
                group_col: str = "exp_group") -> DataFrame:
    """Welch statistics of ``value`` for each (group_a, group_b) pair."""
    x = attach_pairs(users, pairs, group_col)
    return welch_stats(x, value, "side", "a", "b", keys=("group_a", "group_b"))


# --------------------------------------------------------------------------
# Mann-Whitney U
# --------------------------------------------------------------------------

def mann_whitney(df: DataFrame, value: str, group_col: str, a: int, b: int,
                 ranges: int = RANGES) -> DataFrame:
    """Two-sided Mann-Whitney U of ``value`` between groups a and b.

    Ranks with ties are averaged. Values are first reduced to distinct values
    with their counts; a distributed running total over the values gives each
    block of ties its first rank. Twice the rank sum is kept as an integer so
    U is exact. Columns: group_a, group_b, n_a, n_b, u_a, u_b, tie_sum, z
    (z: normal approximation with tie and continuity correction; see
    ``with_normal_p_value`` for the p-value).
    """
    g, x = F.col(group_col), F.col(value)
    counts = (df.where(x.isNotNull() & g.isin(a, b))
              .groupBy(x.alias("_v"))
              .agg(F.count(F.lit(1)).alias("_t"), F.count_if(g == a).alias("_ca")))
    cum = running_total(counts, "_v", "_t", "_cum", ranges=ranges)
    t, ca, c = F.col("_t"), F.col("_ca"), F.col("_cum")
    agg = cum.agg(
        F.coalesce(F.sum(ca), F.lit(0)).alias("n_a"),
        F.coalesce(F.sum(t - ca), F.lit(0)).alias("n_b"),
        F.sum(ca * (F.lit(2) * (c - t) + t + 1)).alias("_r2"),
        F.coalesce(F.sum(t.cast("double") * t * t - t), F.lit(0.0)).alias("tie_sum"))
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    u_a = F.col("_r2") / 2.0 - n_a * (n_a + 1) / 2.0
    n = n_a + n_b
    sigma = F.sqrt(n_a * n_b / 12.0 * ((n + 1) - F.try_divide(F.col("tie_sum"), n * (n - 1))))
    us = agg.select("n_a", "n_b", "tie_sum", u_a.alias("u_a"), (n_a * n_b - u_a).alias("u_b"), sigma.alias("_s"))
    z = F.try_divide(F.greatest("u_a", "u_b") - F.col("n_a").cast("double") * F.col("n_b") / 2.0 - 0.5,
                     F.col("_s"))
    return us.select(F.lit(a).cast("int").alias("group_a"), F.lit(b).cast("int").alias("group_b"),
                     "n_a", "n_b", "u_a", "u_b", "tie_sum", z.alias("z"))


def with_normal_p_value(stats: DataFrame, alpha: float = ALPHA, method: str = "auto") -> DataFrame:
    """Add the Mann-Whitney p-value under the law that ``method`` names: 'exact',
    'asymptotic' (normal, with tie and continuity correction) or 'auto', the
    study's rule (exact when a group has at most 8 values and there are no ties).
    The law used is in column ``method``."""
    c = F.col
    law = mann_whitney_method(c("n_a"), c("n_b"), c("tie_sum"), method)
    p = mann_whitney_p_value(c("u_a"), c("u_b"), c("n_a"), c("n_b"), c("method"), c("z"))
    return (stats.withColumn("method", law).withColumn("p_value", p)
            .withColumn("decision", decision(F.col("p_value"), alpha)))


# --------------------------------------------------------------------------
# CTR transformations
# --------------------------------------------------------------------------

def smoothed_ctr(users: DataFrame, groups: Sequence[int], weight: float = SMOOTHING_WEIGHT) -> DataFrame:
    """(likes + w * G) / (views + w) per user, G the global CTR of the user's
    own group. The group table has one row per listed group: broadcast."""
    u = users.where(F.col("exp_group").isin(*groups))
    g = global_ctr(u).select("exp_group", "global_ctr")
    return (u.join(F.broadcast(g), "exp_group")
            .withColumn("smoothed_ctr",
                        F.try_divide(F.col("likes") + F.lit(float(weight)) * F.col("global_ctr"),
                                     F.col("views") + F.lit(float(weight))))
            .select("exp_group", "user_id", "likes", "views", "global_ctr", "smoothed_ctr"))


def linearized_likes(users: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """likes - C * views per user, C the global CTR of the pair's control
    group (the first of the pair), the same C for both groups of a pair."""
    control_groups = sorted({a for a, _ in pairs})
    ctrl = (global_ctr(users.where(F.col("exp_group").isin(*control_groups)))
            .select(F.col("exp_group").alias("group_a"), F.col("global_ctr").alias("ctr_control")))
    x = attach_pairs(users, pairs).join(F.broadcast(ctrl), "group_a")
    return x.select("group_a", "group_b", "exp_group", "side", "user_id", "likes", "views",
                    "ctr_control",
                    (F.col("likes") - F.col("ctr_control") * F.col("views")).alias("linearized_likes"))


def linearized_means(lin: DataFrame) -> DataFrame:
    return (lin.groupBy("group_a", "group_b", "exp_group")
            .agg(F.avg("linearized_likes").alias("mean_linearized_likes")))


# --------------------------------------------------------------------------
# buckets
# --------------------------------------------------------------------------

def _bucket(hashing: str, salt: str, buckets: int) -> Column:
    if hashing == "mix":
        return uniform_bucket(salt, "user_id", buckets)
    if hashing in ("xxh64", "xxh64_32"):
        return xxh64_bucket("user_id", buckets, 8 if hashing == "xxh64" else 4)
    raise ValueError(f"unknown hashing {hashing!r}: 'mix', 'xxh64' or 'xxh64_32'")


def bucket_ctr(feed: DataFrame, start, end, groups: Sequence[int], buckets: int = BUCKETS,
               salt: str = "bucket", hashing: str = "mix") -> DataFrame:
    """Sum of likes / sum of views per (exp_group, bucket), users hashed into
    ``buckets`` buckets. One aggregate straight from the events (the per-user
    level of the source query adds nothing to sums); the shuffle carries at
    most groups x buckets rows per task. ``hashing`` is 'mix' (salted, so that
    experiments have buckets of their own), or 'xxh64' for the buckets that the
    study's database gives 64-bit user ids ('xxh64_32': 32-bit ones)."""
    f = where_days(feed, start, end).where(F.col("exp_group").isin(*groups))
    return (f.groupBy("exp_group", _bucket(hashing, salt, buckets).alias("bucket"))
            .agg(F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_if(F.col("action") == "view").alias("views"))
            .withColumn("bucket_ctr", ratio("likes", "views")))


def bucket_ctr_of_users(users: DataFrame, groups: Sequence[int], buckets: int = BUCKETS,
                        salt: str = "bucket", hashing: str = "mix") -> DataFrame:
    """``bucket_ctr`` from the per-user table, where one exists already."""
    return (users.where(F.col("exp_group").isin(*groups))
            .groupBy("exp_group", _bucket(hashing, salt, buckets).alias("bucket"))
            .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
            .withColumn("bucket_ctr", ratio("likes", "views")))


# --------------------------------------------------------------------------
# Poisson bootstrap
# --------------------------------------------------------------------------

def explode_tasks(spark, per_core: int = 2) -> int:
    """Tasks for a repetition explode: at least the session's shuffle partitions,
    since under dynamic allocation the cores known now may be the start-up ones."""
    return max(per_core * spark.sparkContext.defaultParallelism,
               int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Repetitions that one row of the draw carries, and numbers that a task draws at a time.
BOOTSTRAP_RUN, WEIGHTS = 500, 1_000_000


def bootstrap_cells(users: DataFrame, groups: Sequence[int]) -> DataFrame:
    """Users per (exp_group, likes, views): all that a bootstrap of the global CTR needs of them."""
    return (users.where(F.col("exp_group").isin(*groups)).groupBy("exp_group", "likes", "views")
            .agg(F.count(F.lit(1)).alias("n")))


def poisson_bootstrap(users: DataFrame, groups: Sequence[int], reps: int = BOOTSTRAP_REPS,
                      salt: str = "poisson", tasks: int | None = None) -> DataFrame:
    """Global CTR of each group under ``reps`` Poisson(1) reweightings of its users.

    The weights of n users with the same likes and views add up to a Poisson(n)
    number, so those users are one cell and get one draw per repetition, keyed by
    an md5 hash of salt, group, likes and views (``functions.resampling``). The
    rows drawn are repetitions x distinct (likes, views), whatever the number of
    users. A task adds its cells up before the shuffle, which carries one row per
    task, group and repetition. Columns: exp_group, b, likes_w, views_w, ctr.
    """
    spark = users.sparkSession
    hi, lo = hash_halves(salt, "exp_group", "likes", "views")
    cells = (bootstrap_cells(users, groups).select("exp_group", "likes", "views", "n", hi.alias("hi"), lo.alias("lo"))
             .withColumn("first", F.explode(F.sequence(F.lit(0), F.lit(reps - 1), F.lit(BOOTSTRAP_RUN))))
             .repartition(tasks or explode_tasks(spark), "exp_group", "likes", "views", "first"))
    run, most, poisson = BOOTSTRAP_RUN, WEIGHTS, resampling.poisson

    def weigh(frames):
        sums = {}
        for frame in frames:
            for (g, first, n), part in frame.groupby(["exp_group", "first", "n"]):
                reps_here = np.arange(first, min(first + run, reps), dtype=np.int64)
                held = sums.setdefault((g, first), np.zeros((2, len(reps_here)), np.int64))
                for at in range(0, len(part), max(1, most // run)):
                    few = part.iloc[at:at + max(1, most // run)]
                    shape = (len(few), len(reps_here))
                    keys = (np.repeat(few[c].to_numpy(np.int64), shape[1]) for c in ("hi", "lo"))
                    w = poisson(int(n), *keys, np.tile(reps_here, shape[0])).reshape(shape)
                    held += np.stack([few[c].to_numpy(np.int64) @ w for c in ("likes", "views")])
        for (g, first), (likes, views) in sums.items():
            yield pd.DataFrame({"exp_group": np.int32(g), "b": np.arange(first, first + len(likes), dtype=np.int32),
                                "likes_w": likes, "views_w": views})

    return (cells.mapInPandas(weigh, "exp_group int, b int, likes_w bigint, views_w bigint").groupBy("exp_group", "b")
            .agg(F.sum("likes_w").alias("likes_w"), F.sum("views_w").alias("views_w"))
            .withColumn("ctr", ratio("likes_w", "views_w")))


def poisson_bootstrap_by_user(users: DataFrame, groups: Sequence[int], reps: int = BOOTSTRAP_REPS,
                              salt: str = "poisson", tasks: int | None = None) -> DataFrame:
    """Global CTR of each group under ``reps`` Poisson(1) reweightings, each user with a weight of their own.

    Weight of (rep b, user) = Poisson(1) inverse CDF of draw b of the user's key
    (an md5 hash of salt and user, computed once per user). The exploded rows live
    only inside one stage: the partial aggregate by (group, b) runs before the
    shuffle. The per-user table is spread over ``tasks`` partitions first: after an
    aggregate AQE coalesces a small table into few, and exploding by thousands there
    would leave a few huge tasks. Columns: exp_group, b, likes_w, views_w, ctr.
    """
    hi, lo = hash_halves(salt, "user_id")
    u = (users.where(F.col("exp_group").isin(*groups))
         .select("exp_group", "user_id", "likes", "views", hi.alias("_hi"), lo.alias("_lo"))
         .repartition(tasks or explode_tasks(users.sparkSession), "user_id"))
    # The draw is its own column: the weight's CASE tests it up to 12 times.
    # Weight-0 rows are not filtered out: they add nothing to the sums, a repetition
    # of nothing but zeros stays a row, and a filter on w would be pushed below the
    # projections with the CASE (and the draw in each branch) inlined into it.
    x = (u.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
         .withColumn("_h", draw32("_hi", "_lo", "b"))
         .withColumn("w", poisson1_weight("_h")))
    return (x.groupBy("exp_group", "b")
            .agg(F.sum(F.col("w") * F.col("likes")).alias("likes_w"),
                 F.sum(F.col("w") * F.col("views")).alias("views_w"))
            .withColumn("ctr", ratio("likes_w", "views_w")))


def bootstrap_diff(boot: DataFrame, a: int, b: int) -> DataFrame:
    """Per repetition: ctr of group b minus ctr of group a."""
    g = F.col("exp_group")
    return (boot.groupBy("b")
            .agg(F.max(F.when(g == a, F.col("ctr"))).alias("ctr_a"),
                 F.max(F.when(g == b, F.col("ctr"))).alias("ctr_b"))
            .withColumn("diff", F.col("ctr_b") - F.col("ctr_a")))


# --------------------------------------------------------------------------
# A/A simulation
# --------------------------------------------------------------------------

#: Numbers that a task draws at a time.
DRAWS = 500_000


def aa_samples(users: DataFrame, groups: Pair = (2, 3), reps: int = AA_REPS, sample: int = AA_SAMPLE,
               share: float | None = None, salt: str = "aa", value: str = "ctr",
               tasks: int | None = None) -> DataFrame:
    """``reps`` samples of ``sample`` users per group without replacement, or of
    the ``share`` of each group's users if that is given.

    The users of a group are numbered by user id; sample s of group g takes
    the users whose numbers are the images of 0 .. sample-1 under a
    permutation of the group's numbers keyed by (salt, s, g)
    (``functions.permutation``). Only reps x groups x sample numbers are drawn
    and joined to the numbered users, whatever the size of the groups. The
    per-user table is materialized once. A group smaller than ``sample`` fails
    the job: drawing without replacement cannot be done.
    Columns: sim, exp_group, user_id, <value>.
    """
    spark = users.sparkSession
    groups = [int(g) for g in groups]
    u = materialize(users.where(F.col("exp_group").isin(*groups)).select("exp_group", "user_id", value))
    # one row per listed group, also of a group without users
    counts = u.groupBy("exp_group").agg(F.count(F.lit(1)).alias("_n"))
    sizes = (spark.createDataFrame([(g,) for g in groups], "exp_group int").join(F.broadcast(counts), "exp_group", "left")
             .select("exp_group", F.coalesce("_n", F.lit(0)).alias("_n")))
    n = F.col("_n")
    if share is None:
        too_large = F.raise_error(F.lit(f"A/A sample of {sample} is larger than a group"))
        k = F.when(n < sample, too_large.cast("bigint")).otherwise(F.lit(sample).cast("bigint"))
    else:
        k = F.floor(n * F.lit(share))
    draws = (spark.range(0, reps, 1, tasks or explode_tasks(spark))
             .select(F.col("id").alias("sim"), F.explode(F.array(*[F.lit(g) for g in groups])).alias("exp_group"))
             .join(F.broadcast(sizes.withColumn("_k", k)), "exp_group")
             # a sample of any size is drawn by ranges of at most DRAWS numbers
             .withColumn("_from", F.explode(F.when(F.col("_k") > 0, F.sequence(
                 F.lit(0).cast("bigint"), F.col("_k") - 1, F.lit(DRAWS).cast("bigint"))))))
    most = DRAWS
    offset, keys_of, images = salt_offset(salt), permutation.round_keys, permutation.permuted

    def numbers(frames):
        for frame in frames:
            for (g, size, whole, begin), part in frame.groupby(["exp_group", "_n", "_k", "_from"]):
                take = int(min(most, whole - begin))
                step = max(1, most // take)
                for at in range(0, len(part), step):
                    sims = part["sim"].to_numpy(np.int64)[at:at + step]
                    keys = [np.repeat(k, take) for k in keys_of(offset, sims, int(g))]
                    yield pd.DataFrame({"sim": np.repeat(sims, take).astype(np.int32), "exp_group": np.int32(g),
                                        "_i": images(np.tile(np.arange(begin, begin + take), len(sims)), int(size), keys)})

    drawn = draws.mapInPandas(numbers, "sim int, exp_group int, _i bigint")
    return (drawn.join(row_index(u, "exp_group", "user_id", "_i"), ["exp_group", "_i"])
            .select("sim", "exp_group", "user_id", value))


#: Distinct values that a task deals a sample over at a time, and simulations it does that for.
CELLS, SIMS = 4096, 250
#: A table of at most so many ranges of ``CELLS`` values (64 MB) is broadcast; a larger one is joined by a shuffle.
BROADCAST_RANGES = 1000


def aa_draw_stats(users: DataFrame, groups: Pair = (2, 3), reps: int = AA_REPS, sample: int = AA_SAMPLE,
                  share: float | None = None, salt: str = "aa", value: str = "ctr", cells: int = CELLS) -> DataFrame:
    """Welch statistics of ``reps`` samples without replacement, as ``aa_stats`` has them, without the sampled users.

    A sample matters by how many users of each value it holds: a multivariate
    hypergeometric draw over the group's distinct values (NULL is one of them). A
    binary tree over the values, in order, splits the sample at each node
    (``resampling.split_sample``), keyed by (salt, simulation, group, node). Up to
    ``cells`` values are one range: the sample is dealt over the ranges first and
    then, in other tasks, over the values of each. The rows shuffled are reps x
    groups x ranges, whatever the number of users. ``sample`` and ``share`` are those
    of ``aa_samples``; a group smaller than ``sample`` fails the job.
    Columns: sim, n_a, n_b, mean_a, mean_b, var_a, var_b, t, df.
    """
    spark = users.sparkSession
    groups = [int(g) for g in groups]
    counted = (users.where(F.col("exp_group").isin(*groups)).groupBy("exp_group", F.col(value).cast("double").alias("_v"))
               .agg(F.count(F.lit(1)).alias("_n")).withColumn("_place", F.coalesce("_v", F.lit(float("inf")))))
    numbered = row_index(materialize(counted), "exp_group", "_place", "_i")
    # a range holds at most ``cells`` rows
    ranges = materialize(numbered.groupBy("exp_group", F.floor(F.col("_i") / cells).alias("_r")).agg(
        F.sort_array(F.collect_list(F.struct("_i", "_v", "_n"))).alias("_c"), F.sum("_n").alias("_total"),
        F.sum(F.col("_v") * F.col("_n")).alias("_s"), F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))).alias("_m"))
        .select("exp_group", "_r", F.col("_c._v").alias("_values"), F.col("_c._n").alias("_counts"), "_total", "_s", "_m"))
    # one row per listed group, also of a group without users; its arrays have a number per range
    whole = (spark.createDataFrame([(g,) for g in groups], "exp_group int").join(F.broadcast(
        ranges.groupBy("exp_group").agg(F.sort_array(F.collect_list(F.struct("_r", "_total"))).alias("_c"),
                                        F.sum("_total").alias("_n"), F.try_divide(F.sum("_s"), F.sum("_m")).alias("_mid"))
        .select("exp_group", "_n", "_mid", F.col("_c._total").alias("_totals"))), "exp_group", "left")
        .withColumn("_n", F.coalesce("_n", F.lit(0))))
    n = F.col("_n")
    if share is None:
        too_large = F.raise_error(F.lit(f"A/A sample of {sample} is larger than a group"))
        k = F.when(n < sample, too_large.cast("bigint")).otherwise(F.lit(sample).cast("bigint"))
    else:
        k = F.floor(n * F.lit(share))
    blocks = (spark.range(0, -(-reps // SIMS), 1, explode_tasks(spark))
              .select(F.col("id").alias("_block"), F.explode(F.array(*[F.lit(g) for g in groups])).alias("exp_group"))
              .join(F.broadcast(whole.withColumn("_k", k)), "exp_group")
              .select("_block", "exp_group", "_k", "_totals", F.coalesce("_mid", F.lit(0.0)).alias("_mid")))
    sims, low, offset, split = SIMS, (cells - 1).bit_length(), salt_offset(salt), resampling.split_sample

    def streams(block):
        return np.arange(block * sims, min((block + 1) * sims, reps), dtype=np.int64)

    def over_ranges(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                if row[3] is None or row[2] == 0:
                    continue
                block, group, taken, totals, mid = row
                stream = streams(block)
                held = split(np.asarray(totals, np.int64), np.full(len(stream), taken), offset, stream, group, low)
                yield pd.DataFrame({"_block": block, "exp_group": np.int32(group), "_mid": mid, "_r": np.arange(len(totals)),
                                    "_ks": list(held.T)})

    def over_values(frames):
        for frame in frames:
            for block, group, mid, r, ks, values, counts in frame.itertuples(index=False):
                stream = streams(block)
                held = split(np.asarray(counts, np.int64), np.asarray(ks, np.int64), offset, stream, group, 0, r * (1 << low), low)
                v = np.array([np.nan if x is None else x for x in values], float)
                known = ~np.isnan(v)
                held, v = held[:, known], v[known]
                seen = held > 0
                yield pd.DataFrame({"sim": stream.astype(np.int32), "exp_group": np.int32(group), "mid": mid,
                                    "n": held.sum(axis=1), "s": held @ v, "q": held @ (v - mid) ** 2,
                                    "lo": np.where(seen, v, np.inf).min(axis=1, initial=np.inf),
                                    "hi": np.where(seen, v, -np.inf).max(axis=1, initial=-np.inf)})

    dealt = blocks.mapInPandas(over_ranges, "_block bigint, exp_group int, _mid double, _r bigint, _ks array<bigint>")
    table = ranges.select("exp_group", "_r", "_values", "_counts")
    if table.count() <= BROADCAST_RANGES:
        table = F.broadcast(table)
    sums = (dealt.join(table, ["exp_group", "_r"])
            .select("_block", "exp_group", "_mid", "_r", "_ks", "_values", "_counts")
            .mapInPandas(over_values, "sim int, exp_group int, mid double, n bigint, s double, q double, lo double, hi double"))

    def of(side: int, name: str, add=F.sum) -> Column:
        return add(F.when(F.col("exp_group") == side, F.col(name)))

    out = sums.groupBy("sim").agg(*[of(g, c, add).alias(f"_{c}_{side}") for side, g in zip("ab", groups) for c, add in (
        ("n", F.sum), ("s", F.sum), ("q", F.sum), ("lo", F.min), ("hi", F.max), ("mid", F.max))])
    moments = ["sim"]
    for side in "ab":
        m, total, q, lo, hi, mid = (F.col(f"_{c}_{side}") for c in ("n", "s", "q", "lo", "hi", "mid"))
        mean = F.try_divide(total, m)
        spread = F.when(lo == hi, F.lit(0.0)).otherwise(q - m * (mean - mid) * (mean - mid))
        moments += [F.coalesce(m, F.lit(0).cast("bigint")).alias(f"n_{side}"), mean.alias(f"mean_{side}"),
                    F.when(m > 1, F.greatest(spread, F.lit(0.0)) / (m - 1)).alias(f"var_{side}")]
    names = ("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b")
    t, dof = _welch(*(F.col(c) for c in names))
    return out.select(*moments).select("sim", *names, t.alias("t"), dof.alias("df"))


def aa_stats(samples: DataFrame, groups: Pair = (2, 3), value: str = "ctr") -> DataFrame:
    """Welch statistics per simulation (first group against the second)."""
    a, b = groups
    return welch_stats(samples, value, "exp_group", a, b, keys=("sim",))


def aa_summary(pvalues: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Number of simulations and share with p <= alpha (inclusive)."""
    p = F.col("p_value")
    return pvalues.agg(F.count(p).alias("n_sims"),
                       F.count_if(p <= alpha).alias("n_significant"),
                       F.avg((p <= alpha).cast("double")).alias("fp_share"))


# --------------------------------------------------------------------------
# histograms
# --------------------------------------------------------------------------

def _order_statistics(df: DataFrame, value: str, ranges: int = RANGES) -> DataFrame:
    """One row with the number of values, their ends and quartiles (linear between the two nearest ranks).

    Values are counted first; a distributed running total gives each distinct one its
    ranks, and the at most four that the quartiles lie between are picked from it.
    """
    counts = (df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_t")))
    ranked = running_total(counts, "_v", "_t", "_cum", ranges=ranges)
    ends = ranked.agg(F.coalesce(F.sum("_t"), F.lit(0)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    x = ranked.withColumn("_e", ends.select(F.struct("n", "lo", "hi")).scalar())
    first, n = F.col("_cum") - F.col("_t"), F.col("_e.n")

    def quartile(quarters: int) -> Column:
        at = F.lit(quarters) * (n - 1)
        rank, part = F.floor(at / 4), (at % 4) / 4.0
        below = F.when((first <= rank) & (rank < F.col("_cum")), F.col("_v"))
        above = F.when((first <= rank + 1) & (rank + 1 < F.col("_cum")), F.col("_v"))
        return F.min(below) + F.coalesce(F.min(above) - F.min(below), F.lit(0.0)) * F.min(part)

    return x.agg(F.coalesce(F.min("_e.n"), F.lit(0)).alias("n"), F.min("_e.lo").alias("lo"), F.min("_e.hi").alias("hi"),
                 quartile(1).alias("q1"), quartile(3).alias("q3"))


def auto_bins(df: DataFrame, value: str) -> DataFrame:
    """One row: n, lo, hi, q1, q3 and ``bins``, the number of equal bins that the values ask for.

    The narrower of the Sturges width (range / (log2 n + 1)) and the Freedman-Diaconis
    width (twice the quartiles' distance over the cube root of n; if that is 0, Sturges
    alone) decides; values without a range, or none, get one bin.
    """
    c = F.col
    spread = c("hi") - c("lo")
    sturges = F.try_divide(spread, F.log2(c("n")) + 1)
    diaconis = F.try_divide(F.lit(2.0) * (c("q3") - c("q1")), F.pow(c("n"), F.lit(1.0 / 3.0)))
    width = F.when(diaconis > 0, F.least(diaconis, sturges)).otherwise(sturges)
    return _order_statistics(df, value).withColumn(
        "bins", F.when(width > 0, F.greatest(F.ceil(spread / width), F.lit(1))).otherwise(F.lit(1)).cast("bigint"))


def histogram(df: DataFrame, value: str, group_col: str | None = None,
              groups: Sequence[int] | None = None, bins: int | str = 10, by: Sequence[str] = ()) -> DataFrame:
    """Counts of ``value`` in ``bins`` equal bins over [min, max] taken over
    all listed groups together (common edges), separately for each value of
    ``by``; the last bin is closed. ``bins='auto'`` lets the values choose their
    number (``auto_bins``; not together with ``by``).

    The range is a scalar subquery (or one row per ``by``), planned with the
    rest: the shuffle that builds the input is shared by both.
    Columns: [by..., group_col,] bin, bin_lo, bin_hi, n.
    """
    if bins == "auto" and by:
        raise ValueError("bins='auto' takes all values together: pass a number of bins with `by`")
    x = df.where(F.col(value).isNotNull())
    if group_col and groups is not None:
        x = x.where(F.col(group_col).isin(*groups))
    keys = [*by, *([group_col] if group_col else [])]
    x = x.select(*keys, F.col(value).cast("double").alias("_v"))
    number = F.lit(1).cast("bigint") if bins == "auto" else F.lit(bins).cast("bigint")
    ends = F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.min(number).alias("bins"))
    if bins == "auto":
        x = x.withColumn("_r", auto_bins(x, "_v").select(F.struct("lo", "hi", "bins")).scalar())
    elif by:
        # one row per value of ``by``, a parameter of the caller
        x = x.join(F.broadcast(x.groupBy(*by).agg(ends.alias("_r"))), list(by))
    else:
        x = x.withColumn("_r", x.agg(ends).scalar())
    lo, width, number = F.col("_r.lo"), F.col("_r.hi") - F.col("_r.lo"), F.col("_r.bins")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(F.col("_v") - lo, width) * number), number - 1)).cast("int")
    out = x.withColumn("bin", b).groupBy(*keys, "bin", "_r").agg(F.count(F.lit(1)).alias("n"))
    step = width / number.cast("double")
    return out.select(*keys, "bin", (lo + step * F.col("bin")).alias("bin_lo"),
                      (lo + step * (F.col("bin") + 1)).alias("bin_hi"), "n")


def ab_tests(users: DataFrame, ctr_pairs: Sequence[Pair], pair: Pair, reps: int = BOOTSTRAP_REPS,
             buckets: int = BUCKETS, smoothing: float = SMOOTHING_WEIGHT, alpha: float = ALPHA,
             method: str = "auto", linearized_pairs: Sequence[Pair] | None = None) -> DataFrame:
    """Every A/B test of the study in one table, from one per-user table: Welch
    on CTR for ``ctr_pairs`` and on linearized likes; for ``pair`` also
    Mann-Whitney on CTR, Welch on smoothed CTR and on Poisson-bootstrap global
    CTRs, and both tests on bucket CTRs. The per-user table is materialized
    once, so the events are scanned once however many tests read it.
    Columns: test, group_a, group_b, statistic, df, p_value, decision."""
    users = materialize(users)
    two = users.where(F.col("exp_group").isin(*pair))
    bucketed = bucket_ctr_of_users(two, pair, buckets)

    def t_rows(name: str, stats: DataFrame) -> DataFrame:
        return with_t_p_value(stats, alpha).select(
            F.lit(name).alias("test"), "group_a", "group_b", F.col("t").alias("statistic"),
            "df", "p_value", "decision")

    def u_rows(name: str, stats: DataFrame) -> DataFrame:
        return with_normal_p_value(stats, alpha, method).select(
            F.lit(name).alias("test"), "group_a", "group_b", F.col("u_a").alias("statistic"),
            F.lit(None).cast("double").alias("df"), "p_value", "decision")

    lin = linearized_likes(users, ctr_pairs if linearized_pairs is None else linearized_pairs)
    parts = [
        t_rows("welch_ctr", welch_pairs(users, "ctr", ctr_pairs)),
        u_rows("mann_whitney_ctr", mann_whitney(two, "ctr", "exp_group", *pair)),
        t_rows("welch_smoothed_ctr", welch_pairs(smoothed_ctr(two, pair, smoothing), "smoothed_ctr", [pair])),
        t_rows("welch_bootstrap_ctr", welch_pairs(poisson_bootstrap(two, pair, reps), "ctr", [pair])),
        t_rows("welch_bucket_ctr", welch_pairs(bucketed, "bucket_ctr", [pair])),
        u_rows("mann_whitney_bucket_ctr", mann_whitney(bucketed, "bucket_ctr", "exp_group", *pair)),
        t_rows("welch_linearized_likes", welch_stats(lin, "linearized_likes", "side", "a", "b",
                                                     keys=("group_a", "group_b"))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
