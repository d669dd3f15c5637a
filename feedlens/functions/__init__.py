from feedlens.functions.columns import (  # noqa: F401
    add_weeks, day_of, fixed2, fifteen_minute_start, hash_halves, hh_mm, monday,
    percent2, ratio, uniform_bucket,
)
