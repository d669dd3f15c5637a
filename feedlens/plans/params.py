"""Parameters of the registered queries.

The daily jobs run with a fixed clock so that results are repeatable: the
fixture's data covers 2024-01-01 .. 2024-01-30, so the job date is
2024-01-31 ("yesterday" is the last day of data). Repetition and bucket
counts are the study's own (10,000 A/A repetitions, 3,000 bootstrap
repetitions, 200 buckets). The A/A sample is a share of each group, since the
study's 500 users are more than a fixture group holds; the library's default
is the study's 500.
"""

import datetime as dt

AS_OF = dt.date(2024, 1, 31)
NOW = dt.datetime(2024, 1, 30, 12, 0, 0)
EXP_START = dt.date(2024, 1, 8)
EXP_END = dt.date(2024, 1, 14)

ALL_GROUPS = (0, 1, 2, 3)
AA_GROUPS = (2, 3)
AB_GROUPS = (1, 2)
LINEARIZED_PAIRS = ((0, 3), (1, 2))

AA_REPS = 10000
AA_SHARE = 0.5
BUCKETS = 200
BOOTSTRAP_REPS = 3000
MANN_WHITNEY = "asymptotic"
HIST_BINS = 20

CAMPAIGN_START = dt.date(2024, 1, 10)
CAMPAIGN_END = dt.date(2024, 1, 12)
DROP_BASE_START = dt.date(2024, 1, 22)
DROP_BASE_END = dt.date(2024, 1, 28)
DROP_DAY = dt.date(2024, 1, 29)
DROP_SHARE = 0.05       # least share of the base users behind a combination

DIGITS = 6
SIGNIFICANT = 4         # digits of the p-values of aa_test and ab_results
PRE_DIGITS = 9
