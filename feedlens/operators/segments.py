"""What unites the users who stayed away on a bad day: every combination of attributes with enough users.

The cube over all attribute combinations is cut down before it is built (an
iceberg cube). A combination cannot have more users than any of its values, so a
value below the support bound is blanked out in the users' rows first and none
of its combinations is ever made. Users with the same attributes are then one
row with a count, and only these rows are expanded into combinations: the cost is
that of the distinct attribute sets, not of the users.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import ratio
from feedlens.operators.cohorts import DROP_DIMENSIONS
from feedlens.operators.ordering import materialize
from feedlens.operators.timeframe import where_days
from feedlens.sources.actions import Actions

#: Least share of the base period's users that a combination must have.
MIN_SHARE = 0.05


def _marked_users(actions: Actions, base_start, base_end, drop_day, dimensions: Sequence[str]) -> DataFrame:
    """(user_id, sets, missing): the attribute sets that each user of the base period had, and whether the user stayed away."""
    cols = [F.col(d).cast("string").alias(d) for d in dimensions]

    def seen(df: DataFrame, start, end) -> DataFrame:
        return where_days(df, start, end)

    base = (seen(actions.feed, base_start, base_end).select("user_id", *cols)
            .unionByName(seen(actions.message, base_start, base_end).select("user_id", *cols)))
    present = (seen(actions.feed, drop_day, drop_day).select("user_id")
               .unionByName(seen(actions.message, drop_day, drop_day).select("user_id"))
               .distinct().withColumn("_present", F.lit(True)))
    users = base.groupBy("user_id").agg(F.collect_set(F.struct(*dimensions)).alias("sets"))
    return users.join(present, "user_id", "left").select(
        "user_id", F.sort_array("sets").alias("sets"), F.col("_present").isNull().alias("missing"))


def _subsets(row: Column, dimensions: Sequence[str]) -> Column:
    """All combinations of a set's known values, as structs in which the other attributes are null."""
    made = []
    for size in range(1, len(dimensions) + 1):
        for kept in combinations(dimensions, size):
            known = F.lit(True)
            for d in kept:
                known = known & row[d].isNotNull()
            made.append(F.when(known, F.struct(*[(row[d] if d in kept else F.lit(None).cast("string")).alias(d)
                                                 for d in dimensions])))
    return F.array_compact(F.array(*made))


def audience_drop_segments(actions: Actions, base_start, base_end, drop_day,
                           dimensions: Sequence[str] = DROP_DIMENSIONS, min_share: float = MIN_SHARE) -> DataFrame:
    """Users active in [base_start, base_end] and absent on ``drop_day``, for every combination of one or more
    attribute values that at least ``min_share`` of the base users had.

    A combination's parents lack one of its attributes (a single value's parent is
    everyone); the best one is the parent with the largest share of missing users.
    ``lift`` is the combination's share over that share, and ``z`` how many
    standard deviations its missing users exceed what that share lets expect; the
    combination that explains a drop has the largest z, as neither its parents nor
    its refinements add to it. A user counts once per combination, however
    many attribute sets the user had. Attributes that are unknown (null) make no
    combination. Columns: <dimensions>, n_dimensions, users_base, users_missing,
    share_missing, best_parent_share, lift, z (the attributes left out are null).
    """
    dims = list(dimensions)
    # one row per distinct collection of attribute sets
    cells = materialize(_marked_users(actions, base_start, base_end, drop_day, dims).groupBy("sets").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("missing").alias("gone")))
    # at most 1 / min_share values of an attribute reach the bound (more only if users have several)
    least = cells.agg(F.ceil(F.sum("n") * F.lit(min_share)).alias("least"))
    values = cells.select("n", F.explode(F.array_distinct(F.flatten(F.transform("sets", lambda s: F.array(
        *[F.struct(F.lit(d).alias("dimension"), s[d].alias("value")) for d in dims]))))).alias("v"))
    frequent = (values.where("v.value is not null").groupBy("v").agg(F.sum("n").alias("n"))
                .where(F.col("n") >= least.scalar()))
    kept = frequent.agg(*[F.collect_list(F.when(F.col("v.dimension") == d, F.col("v.value"))).alias(d) for d in dims])
    allowed = kept.select(F.struct(*dims).alias("_kept")).scalar()
    pruned = (cells.withColumn("_kept", allowed).withColumn("sets", F.array_distinct(F.transform("sets", lambda s: F.struct(
        *[F.when(F.array_contains(F.col("_kept")[d], s[d]), s[d]).alias(d) for d in dims]))))
        .groupBy("sets").agg(F.sum("n").alias("n"), F.sum("gone").alias("gone")))
    expanded = pruned.select("n", "gone", F.explode(F.array_distinct(F.flatten(
        F.transform("sets", lambda s: _subsets(s, dims))))).alias("c"))
    counted = materialize(expanded.groupBy("c").agg(F.sum("n").alias("users_base"), F.sum("gone").alias("users_missing"))
                          .where(F.col("users_base") >= least.scalar())
                          .withColumn("share_missing", ratio("users_missing", "users_base")))
    everyone = cells.agg(ratio(F.sum("gone"), F.sum("n")).alias("share")).scalar()
    parents = counted.select("c", F.explode(F.array_compact(F.array(*[
        F.when(F.col("c")[out].isNotNull(), F.struct(*[(F.lit(None).cast("string") if d == out else F.col("c")[d]).alias(d)
                                                       for d in dims])) for out in dims]))).alias("p"))
    shares = counted.select(F.col("c").alias("p"), F.col("share_missing").alias("_share"))
    best = parents.join(shares, "p", "left").groupBy("c").agg(F.max("_share").alias("_best"))
    size = sum((F.col("c")[d].isNotNull().cast("int") for d in dims), F.lit(0))
    out = counted.join(best, "c").select(
        "c.*", size.alias("n_dimensions"), "users_base", "users_missing", "share_missing",
        F.when(size == 1, everyone).otherwise(F.col("_best")).alias("best_parent_share"))
    p, n = F.col("best_parent_share"), F.col("users_base")
    return out.select("*", F.try_divide(F.col("share_missing"), p).alias("lift"),
                      F.try_divide(F.col("users_missing") - n * p, F.sqrt(n * p * (F.lit(1.0) - p))).alias("z"))
