"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the fixture's ``events`` table in full (through the two
action views) and runs one job of the library with the parameters in
``params``. Double columns are rounded to 6 decimals through a decimal
(``rounded``), so results compare exactly against an independent SQL engine
whose floating-point sums run in another order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators import alerts, bitmaps, cohorts, experiments as ex, metrics, segments, sketches, slices
from feedlens.operators.ordering import materialize
from feedlens.plans import params as P
from feedlens.sources.actions import Actions, load_fixture

Query = Callable[[SparkSession, str], DataFrame]


def significant(c: str, digits: int = P.SIGNIFICANT):
    """A double to its leading digits, which keeps small p-values."""
    return F.format_string(f"%.{digits - 1}e", F.col(c)).cast("double").alias(c)


def rounded(df: DataFrame, digits: int = P.DIGITS, leading: tuple[str, ...] = ()) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in leading:
            cols.append(significant(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # Decimal rounding: the double goes to a 9-place decimal (absorbing
            # the few ulps by which sums in another order differ), which is then
            # rounded half-up exactly. A binary round() would split exact
            # decimal halves (1.0135925) differently in different engines.
            dec = F.col(f.name).try_cast(f"decimal(38,{P.PRE_DIGITS})")
            cols.append(F.round(dec, digits).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _users(a: Actions, groups=P.ALL_GROUPS) -> DataFrame:
    return ex.user_ctr(a.feed, P.EXP_START, P.EXP_END, groups)


# --- sources ---------------------------------------------------------------

def q_feed_actions(a: Actions) -> DataFrame:
    return a.feed


def q_message_actions(a: Actions) -> DataFrame:
    return a.message


# --- feed report -----------------------------------------------------------

def q_report_day(a: Actions) -> DataFrame:
    return metrics.report_day(a.feed, P.AS_OF)


def q_report_week(a: Actions) -> DataFrame:
    return metrics.report_week(a.feed, P.AS_OF)


def q_report_week_series(a: Actions) -> DataFrame:
    return metrics.long_series(metrics.report_week(a.feed, P.AS_OF), metrics.FEED_DAILY_METRICS)


# --- application report ----------------------------------------------------

def q_daily_actions(a: Actions) -> DataFrame:
    return metrics.daily_actions(a)


def q_daily_actions_compat(a: Actions) -> DataFrame:
    return metrics.daily_actions_compat(a)


def q_new_users(a: Actions) -> DataFrame:
    return metrics.new_users(a)


def q_new_posts(a: Actions) -> DataFrame:
    return metrics.new_posts(a.feed)


def q_dau(a: Actions) -> DataFrame:
    return metrics.dau(a)


def q_dau_all_compat(a: Actions) -> DataFrame:
    return metrics.dau(a, compat=True)


def q_product_daily(a: Actions) -> DataFrame:
    return metrics.product_daily(a)


def q_product_report_day(a: Actions) -> DataFrame:
    return metrics.product_report_day(a, P.AS_OF)


def q_product_series(a: Actions) -> DataFrame:
    return metrics.long_series(metrics.product_daily(a), metrics.PRODUCT_METRICS)


def q_top_posts(a: Actions) -> DataFrame:
    return metrics.top_posts(a.feed, 10)


def q_weekly_audience(a: Actions) -> DataFrame:
    return cohorts.weekly_audience(a, P.AS_OF)


def q_weekly_audience_compat(a: Actions) -> DataFrame:
    return cohorts.weekly_audience(a, P.AS_OF, feed_only=True)


def q_weekly_audience_totals(a: Actions) -> DataFrame:
    return cohorts.weekly_audience_totals(cohorts.weekly_audience(a, P.AS_OF))


def q_weekly_audience_series(a: Actions) -> DataFrame:
    return cohorts.weekly_audience_series(cohorts.weekly_audience(a, P.AS_OF))


def q_weekly_audience_approx(a: Actions) -> DataFrame:
    return cohorts.weekly_audience(a, P.AS_OF, approx=True)


def q_weekly_users_sketched(a: Actions) -> DataFrame:
    return sketches.weekly_users_check(a)


def q_weekly_audience_sketched(a: Actions) -> DataFrame:
    return sketches.audience_check(a, P.AS_OF)


# --- daily slices ----------------------------------------------------------

def q_etl_feed(a: Actions) -> DataFrame:
    return slices.etl_feed(a.feed)


def q_etl_messages(a: Actions) -> DataFrame:
    return slices.etl_messages(a.message)


def q_etl_total(a: Actions) -> DataFrame:
    return slices.etl_total(slices.etl_feed(a.feed), slices.etl_messages(a.message))


def q_etl_slices(a: Actions) -> DataFrame:
    return slices.daily_slices(a.feed, a.message)


# --- experiments -----------------------------------------------------------

def q_user_ctr(a: Actions) -> DataFrame:
    return _users(a)


def q_group_sizes(a: Actions) -> DataFrame:
    return ex.group_sizes(_users(a, P.AA_GROUPS))


def q_global_ctr(a: Actions) -> DataFrame:
    return ex.global_ctr(_users(a, P.AB_GROUPS))


def q_welch_ctr(a: Actions) -> DataFrame:
    return ex.welch_pairs(_users(a, P.AB_GROUPS), "ctr", [P.AB_GROUPS])


def q_welch_ctr_pairs(a: Actions) -> DataFrame:
    return ex.welch_pairs(_users(a), "ctr", P.LINEARIZED_PAIRS)


def q_mann_whitney(a: Actions) -> DataFrame:
    return ex.mann_whitney(_users(a, P.AB_GROUPS), "ctr", "exp_group", *P.AB_GROUPS)


def q_smoothed_ctr(a: Actions) -> DataFrame:
    return ex.smoothed_ctr(_users(a, P.AB_GROUPS), P.AB_GROUPS)


def q_welch_smoothed(a: Actions) -> DataFrame:
    return ex.welch_pairs(ex.smoothed_ctr(_users(a, P.AB_GROUPS), P.AB_GROUPS),
                          "smoothed_ctr", [P.AB_GROUPS])


def _boot(a: Actions) -> DataFrame:
    return ex.poisson_bootstrap(_users(a, P.AB_GROUPS), P.AB_GROUPS, P.BOOTSTRAP_REPS)


def q_poisson_bootstrap(a: Actions) -> DataFrame:
    return _boot(a)


def q_bootstrap_diff(a: Actions) -> DataFrame:
    return ex.bootstrap_diff(_boot(a), *P.AB_GROUPS)


def q_welch_bootstrap(a: Actions) -> DataFrame:
    boot = ex.poisson_bootstrap_by_user(_users(a, P.AB_GROUPS), P.AB_GROUPS, P.BOOTSTRAP_REPS)
    return ex.welch_pairs(boot, "ctr", [P.AB_GROUPS])


def _buckets(a: Actions) -> DataFrame:
    return ex.bucket_ctr(a.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS, P.BUCKETS)


def q_bucket_ctr(a: Actions) -> DataFrame:
    return _buckets(a)


def _xxh64_buckets(a: Actions) -> DataFrame:
    return ex.bucket_ctr(a.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS, P.BUCKETS, hashing="xxh64")


def q_bucket_ctr_xxh64(a: Actions) -> DataFrame:
    return _xxh64_buckets(a)


def q_welch_bucket_xxh64(a: Actions) -> DataFrame:
    return ex.welch_pairs(_xxh64_buckets(a), "bucket_ctr", [P.AB_GROUPS])


def q_welch_bucket(a: Actions) -> DataFrame:
    return ex.welch_pairs(_buckets(a), "bucket_ctr", [P.AB_GROUPS])


def q_mann_whitney_bucket(a: Actions) -> DataFrame:
    return ex.mann_whitney(_buckets(a), "bucket_ctr", "exp_group", *P.AB_GROUPS)


def _linearized(a: Actions) -> DataFrame:
    return ex.linearized_likes(_users(a), P.LINEARIZED_PAIRS)


def q_linearized_likes(a: Actions) -> DataFrame:
    return _linearized(a).drop("side")


def q_linearized_means(a: Actions) -> DataFrame:
    return ex.linearized_means(_linearized(a))


def q_welch_linearized(a: Actions) -> DataFrame:
    return ex.welch_stats(_linearized(a), "linearized_likes", "side", "a", "b",
                          keys=("group_a", "group_b"))


def q_ctr_histogram(a: Actions) -> DataFrame:
    return ex.histogram(_users(a, P.AB_GROUPS), "ctr", "exp_group", P.AB_GROUPS, P.HIST_BINS)


def q_ctr_histogram_auto(a: Actions) -> DataFrame:
    return ex.histogram(_users(a, P.AB_GROUPS), "ctr", "exp_group", P.AB_GROUPS, "auto")


def q_ctr_auto_bins(a: Actions) -> DataFrame:
    return ex.auto_bins(_users(a, P.AB_GROUPS), "ctr")


def q_bootstrap_diff_histogram(a: Actions) -> DataFrame:
    return ex.histogram(ex.bootstrap_diff(_boot(a), *P.AB_GROUPS), "diff", bins=P.HIST_BINS)


def q_bucket_ctr_histogram(a: Actions) -> DataFrame:
    return ex.histogram(_buckets(a), "bucket_ctr", "exp_group", P.AB_GROUPS, P.HIST_BINS)


def q_linearized_histogram(a: Actions) -> DataFrame:
    return ex.histogram(_linearized(a), "linearized_likes", "exp_group", bins=P.HIST_BINS, by=("group_a", "group_b"))


def q_aa_ctr_histogram(a: Actions) -> DataFrame:
    return ex.histogram(_users(a, P.AA_GROUPS), "ctr", "exp_group", P.AA_GROUPS, P.HIST_BINS)


def _aa_samples(a: Actions) -> DataFrame:
    return ex.aa_samples(_users(a, P.AA_GROUPS), P.AA_GROUPS, P.AA_REPS, share=P.AA_SHARE)


def q_aa_samples(a: Actions) -> DataFrame:
    return _aa_samples(a)


def _aa_stats(a: Actions) -> DataFrame:
    return ex.aa_draw_stats(_users(a, P.AA_GROUPS), P.AA_GROUPS, P.AA_REPS, share=P.AA_SHARE)


def q_aa_stats(a: Actions) -> DataFrame:
    return _aa_stats(a)


def q_aa_test(a: Actions) -> DataFrame:
    return ex.with_t_p_value(_aa_stats(a)).select("sim", "t", "df", "p_value")


def q_aa_summary(a: Actions) -> DataFrame:
    return ex.aa_summary(q_aa_test(a))


def q_aa_pvalue_histogram(a: Actions) -> DataFrame:
    # one row per simulation, read by the range and the counts
    return ex.histogram(materialize(q_aa_test(a)), "p_value", bins=10)


def q_ab_results(a: Actions) -> DataFrame:
    """All A/B tests of the study in one table with p-values and decisions."""
    return ex.ab_tests(_users(a), P.LINEARIZED_PAIRS, P.AB_GROUPS, P.BOOTSTRAP_REPS, P.BUCKETS,
                       method=P.MANN_WHITNEY)


# --- alerts ----------------------------------------------------------------

def q_alert_series(a: Actions) -> DataFrame:
    return alerts.alert_series(a, P.NOW).orderBy("ts")


def q_alert_bands(a: Actions) -> DataFrame:
    return alerts.alert_bands(alerts.alert_series(a, P.NOW))


def q_alert_check(a: Actions) -> DataFrame:
    return alerts.alert_check(alerts.alert_bands(alerts.alert_series(a, P.NOW)))


# --- cohorts ---------------------------------------------------------------

def q_retention_by_source(a: Actions) -> DataFrame:
    return cohorts.retention_by_source(a.feed)


def q_campaign_retention(a: Actions) -> DataFrame:
    return cohorts.campaign_retention(a.feed, P.CAMPAIGN_START, P.CAMPAIGN_END)


def q_weekly_audience_bitmaps(a: Actions) -> DataFrame:
    return bitmaps.weekly_audience(bitmaps.user_bitmaps(a), P.AS_OF)


def q_retention_by_source_bitmaps(a: Actions) -> DataFrame:
    return bitmaps.retention_by_source(bitmaps.user_bitmaps(a))


def q_campaign_retention_bitmaps(a: Actions) -> DataFrame:
    return bitmaps.campaign_retention(bitmaps.user_bitmaps(a), P.CAMPAIGN_START, P.CAMPAIGN_END)


def q_audience_drop(a: Actions) -> DataFrame:
    return cohorts.audience_drop(a, P.DROP_BASE_START, P.DROP_BASE_END, P.DROP_DAY)


def q_audience_drop_segments(a: Actions) -> DataFrame:
    return segments.audience_drop_segments(a, P.DROP_BASE_START, P.DROP_BASE_END, P.DROP_DAY, min_share=P.DROP_SHARE)


# Columns kept to their leading digits instead of a fixed number of places.
_LEADING = {"q_ab_results": ("p_value",), "q_aa_test": ("p_value",)}

_JOBS: dict[str, Callable[[Actions], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}


_FIXTURES: dict[tuple[int, str], tuple[SparkSession, Actions]] = {}


def _fixture(spark: SparkSession, sf_dir: str) -> Actions:
    """The fixture's two table handles, built once per session and folder
    (plans only: no data is cached)."""
    key = (id(spark), sf_dir)
    hit = _FIXTURES.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, load_fixture(spark, sf_dir))
        _FIXTURES[key] = hit
    return hit[1]


def _bind(job: Callable[[Actions], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(job(_fixture(spark, sf_dir)), leading=_LEADING.get(job.__name__, ()))
    run.__name__ = job.__name__
    run.__doc__ = job.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _bind(job) for name, job in _JOBS.items()}
