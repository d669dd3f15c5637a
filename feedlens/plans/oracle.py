"""Reference SQL for the registered queries, in DuckDB's dialect.

Each statement rebuilds the two action tables from ``events`` and computes
the same result as the Spark job the plain way (joins that really fan out,
global windows, cross products with a repetition range), which is what makes
it an independent check. Doubles are rounded to 6 decimals like the Spark side.
"""

from __future__ import annotations

import datetime as dt
import zlib
from decimal import Decimal, localcontext

from feedlens.functions.columns import GOLDEN32, M32, MIX32, XXH_PRIMES
from feedlens.functions.permutation import ROUNDS
from feedlens.functions.resampling import SMALL_MEAN
from feedlens.plans import params as P


def _d(d) -> str:
    return f"DATE '{d.isoformat()}'"


def _ts(t) -> str:
    if not isinstance(t, dt.datetime):
        t = dt.datetime(t.year, t.month, t.day)
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


def _r(expr: str) -> str:
    return f"CAST(round(TRY_CAST({expr} AS DECIMAL(38,{P.PRE_DIGITS})), {P.DIGITS}) AS DOUBLE)"


def _ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)"


def _hash_halves(salt: str, *keys: str) -> tuple[str, str]:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    text = f"md5(concat_ws(':', '{salt}', {parts}))"
    return tuple(f"CAST('0x' || substr({text}, {at}, 8) AS BIGINT)" for at in (1, 9))


def _mix32(x: str) -> str:
    def step(v: str) -> str:
        return f"((xor({v}, ({v}) >> 16) * {MIX32}) & {M32})"
    y = step(step(x))
    return f"xor({y}, {y} >> 16)"


def _mixed(inner: str) -> tuple[str, str]:
    """The mix in two layers, (inner column, outer expression over ``z``): the
    text of a nested mix doubles with every step."""
    return _mix32(inner), _mix32(f"((z + hi) & {M32})")


def _salt(salt: str) -> int:
    return (zlib.crc32(salt.encode()) * GOLDEN32) & M32


def _fixed2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), 2) AS VARCHAR)"


def _percent2(x: str) -> str:
    return f"({_fixed2(f'({x}) * 100.0')} || '%')"


_ATTRS = """
    CASE WHEN user_id % 2 = 0 THEN 'iOS' ELSE 'Android' END AS os,
    CAST(15 + user_id % 50 AS INTEGER) AS age,
    CAST((user_id // 3) % 2 AS INTEGER) AS gender,
    CASE WHEN user_id % 5 < 2 THEN 'ads' ELSE 'organic' END AS source"""

BASE = f"""
feed_actions AS (
  SELECT user_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS post_id,
    CASE WHEN event_type = 'view' THEN 'view' ELSE 'like' END AS action,
    ts AS "time",
    CAST(user_id % 4 AS INTEGER) AS exp_group,{_ATTRS}
  FROM events WHERE event_type IN ('view', 'click')
),
message_actions AS (
  SELECT user_id,
    (user_id * 7 + CAST(json_extract_string(props, '$.k') AS BIGINT)) % 15 AS reciever_id,
    ts AS "time",{_ATTRS}
  FROM events WHERE event_type = 'purchase'
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((BASE,) + ctes) + "\n"


def _recursive(statement: str) -> str:
    return statement.replace("WITH ", "WITH RECURSIVE ", 1)


def _exp_week(col: str = '"time"') -> str:
    return f"{col} >= {_ts(P.EXP_START)} AND {col} < {_ts(P.EXP_END)} + INTERVAL 1 DAY"


def _user_ctr_cte(name: str, groups) -> str:
    g = ", ".join(str(x) for x in groups)
    return f"""{name} AS (
  SELECT exp_group, user_id,
    CAST(count_if(action = 'like') AS BIGINT) AS likes,
    CAST(count_if(action = 'view') AS BIGINT) AS views,
    {_ratio("count_if(action = 'like')", "count_if(action = 'view')")} AS ctr
  FROM feed_actions WHERE {_exp_week()} AND exp_group IN ({g})
  GROUP BY exp_group, user_id)"""


def _plain(expr: str) -> str:
    return f"({expr})"


def _welch_select(src: str, value: str, side: str, a: str, b: str, keys: str = "", r=_r) -> str:
    """Welch columns from conditional aggregates of ``src``, rounded by ``r``."""
    k = f"{keys}, " if keys else ""
    grp = f"GROUP BY {keys}" if keys else ""
    se = "nullif(var_a / n_a + var_b / n_b, 0)"
    parts = "nullif(power(var_a / n_a, 2) / nullif(n_a - 1, 0) + power(var_b / n_b, 2) / nullif(n_b - 1, 0), 0)"
    return f"""SELECT {k}n_a, n_b, {r('mean_a')} AS mean_a, {r('mean_b')} AS mean_b,
  {r('var_a')} AS var_a, {r('var_b')} AS var_b,
  {r(f'(mean_a - mean_b) / sqrt({se})')} AS t,
  {r(f'power({se}, 2) / {parts}')} AS df
FROM (
  SELECT {k}
    count(CASE WHEN {side} = {a} THEN {value} END) AS n_a,
    count(CASE WHEN {side} = {b} THEN {value} END) AS n_b,
    avg(CASE WHEN {side} = {a} THEN {value} END) AS mean_a,
    avg(CASE WHEN {side} = {b} THEN {value} END) AS mean_b,
    var_samp(CASE WHEN {side} = {a} THEN {value} END) AS var_a,
    var_samp(CASE WHEN {side} = {b} THEN {value} END) AS var_b
  FROM {src} {grp})"""


def _pairs_cte(name: str, pairs) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {a} AS group_a, {b} AS group_b, {g} AS exp_group, '{s}' AS side"
        for a, b in pairs for g, s in ((a, "a"), (b, "b")))
    return f"{name} AS ({rows})"


def _welch_pairs(src_cte: str, value: str, pairs, r=_r) -> str:
    return (_with(src_cte, _pairs_cte("pairs", pairs),
                  "paired AS (SELECT p.group_a, p.group_b, p.side, s.* FROM src s JOIN pairs p USING (exp_group))")
            + _welch_select("paired", value, "side", "'a'", "'b'", "group_a, group_b", r))


def _mann_whitney(src_cte: str, value: str, a: int, b: int, r=_r) -> str:
    return _with(src_cte, f"""counts AS (
  SELECT {value} AS v, count(*) AS t, count_if(exp_group = {a}) AS ca
  FROM src WHERE {value} IS NOT NULL AND exp_group IN ({a}, {b}) GROUP BY {value})""",
                 """ranked AS (
  SELECT *, sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM counts)""",
                 """agg AS (
  SELECT CAST(sum(ca) AS BIGINT) AS n_a, CAST(sum(t - ca) AS BIGINT) AS n_b,
    sum(ca * (cum - t + (t + 1) / 2.0)) AS r_a,
    sum(CAST(t AS DOUBLE) * t * t - t) AS tie_sum FROM ranked)""",
                 """u AS (SELECT *, r_a - n_a * (n_a + 1) / 2.0 AS u_a, n_a * n_b - (r_a - n_a * (n_a + 1) / 2.0) AS u_b FROM agg)""") + f"""
SELECT {a} AS group_a, {b} AS group_b, n_a, n_b, {r('u_a')} AS u_a, {r('u_b')} AS u_b,
  {r('tie_sum')} AS tie_sum,
  {r(f"(greatest(u_a, u_b) - n_a * n_b / 2.0 - 0.5) / sqrt(n_a * n_b / 12.0 * ((n_a + n_b + 1) - tie_sum / ((n_a + n_b) * (n_a + n_b - 1.0))))")} AS z
FROM u"""


def _src(body: str) -> str:
    return f"src AS ({body})"


def _users_src(groups) -> str:
    return _user_ctr_cte("src", groups)


def _poisson_case(h: str, mean: int) -> str:
    """Weight of a 32-bit draw by the Poisson(mean) law, from the law itself."""
    with localcontext() as ctx:
        ctx.prec = 50
        term, cdf, bounds, k = Decimal(-mean).exp(), Decimal(0), [], 0
        while 1 - (cdf + term) >= Decimal(2) ** -32:
            cdf += term
            bounds.append(int(cdf * 2**32))
            k += 1
            term = term * mean / k
    whens = " ".join(f"WHEN {h} < {bound} THEN {k}" for k, bound in enumerate(bounds))
    return f"CASE {whens} ELSE {len(bounds)} END"


def poisson_sql(cells: str, reps: int) -> str:
    """CTEs up to ``weighted``: the rows of ``cells`` (with n, hi, lo) and each repetition b, w drawn by the
    Poisson(n) law: by the distribution function for small n, else by transformed rejection, attempt after attempt."""
    inner = _mix32(f"((c.lo + CAST(r.b AS BIGINT) * {GOLDEN32}) & {M32})")
    first = _mix32(f"((z + hi) & {M32})")
    small = " ".join(f"WHEN {n} THEN {_poisson_case('h', n)}" for n in range(1, SMALL_MEAN + 1))

    def uniform(number: str) -> str:
        return f"(({_mix32(f'((z + hi + ({number}) * {GOLDEN32}) & {M32})')}) + 0.5) / 4294967296.0"

    b = "(0.931 + 2.53 * sqrt(n))"
    a = f"(-0.059 + 0.02483 * {b})"
    place = f"floor((2 * {a} / us + {b}) * u + n + 0.43)"
    fits = (f"ln(v) + ln(1.1239 + 1.1328 / ({b} - 3.4)) - ln({a} / (us * us) + {b}) "
            f"<= k * ln(n) - n - lgamma(greatest(k, 0) + 1)")
    # attempt and number of the draw: 2 t for the place, 2 t + 1 for the height
    attempt = f"""SELECT * EXCLUDE (k, us, u, v), CASE WHEN (us >= 0.07 AND v <= 0.9277 - 3.6224 / ({b} - 2))
      OR (k >= 0 AND NOT (us < 0.013 AND v > us) AND {fits}) THEN CAST(k AS BIGINT) END AS w FROM (
    SELECT *, {place} AS k FROM (SELECT *, 0.5 - abs(u) AS us FROM (
      SELECT *, {uniform('2 * t')} - 0.5 AS u, {uniform('2 * t + 1')} AS v FROM ({{}}))))"""
    return f"""boot_low AS (SELECT c.*, r.b, {inner} AS z FROM {cells} c CROSS JOIN range({reps}) r(b)),
boot_small AS (SELECT *, CASE n {small} END AS w FROM (SELECT *, {first} AS h FROM boot_low WHERE n <= {SMALL_MEAN})),
boot_large AS (
  {attempt.format(f"SELECT *, 0 AS t FROM boot_low WHERE n > {SMALL_MEAN}")}
  UNION ALL
  {attempt.format("SELECT * EXCLUDE (w, t), t + 1 AS t FROM boot_large WHERE w IS NULL")}),
weighted AS (SELECT * EXCLUDE (z, h) FROM boot_small
  UNION ALL SELECT * EXCLUDE (z, t) FROM boot_large WHERE w IS NOT NULL)"""


def _boot_cte(name: str) -> str:
    """Poisson bootstrap of the users with the same likes and views together."""
    hi, lo = _hash_halves("poisson", "exp_group", "likes", "views")
    return f"""boot_cells AS (
  SELECT *, {hi} AS hi, {lo} AS lo FROM (
    SELECT exp_group, likes, views, CAST(count(*) AS BIGINT) AS n FROM ab_users GROUP BY ALL)),
{poisson_sql('boot_cells', P.BOOTSTRAP_REPS)},
{name} AS (
  SELECT exp_group, b, CAST(sum(w * likes) AS BIGINT) AS likes_w, CAST(sum(w * views) AS BIGINT) AS views_w,
    {_ratio('sum(w * likes)', 'sum(w * views)')} AS ctr
  FROM weighted GROUP BY exp_group, b)"""


def _boot_by_user_cte(name: str) -> str:
    """Poisson bootstrap with a weight for each user and repetition."""
    hi, lo = _hash_halves("poisson", "user_id")
    inner, outer = _mixed(f"((u.lo + CAST(r.b AS BIGINT) * {GOLDEN32}) & {M32})")
    return f"""boot_users AS (SELECT *, {hi} AS hi, {lo} AS lo FROM ab_users),
boot_low AS (SELECT u.exp_group, r.b, u.likes, u.views, u.hi, {inner} AS z
             FROM boot_users u CROSS JOIN range({P.BOOTSTRAP_REPS}) r(b)),
boot_draws AS (SELECT exp_group, b, likes, views, {outer} AS h FROM boot_low),
{name} AS (
  SELECT exp_group, b, CAST(sum(w * likes) AS BIGINT) AS likes_w, CAST(sum(w * views) AS BIGINT) AS views_w,
    {_ratio('sum(w * likes)', 'sum(w * views)')} AS ctr
  FROM (SELECT exp_group, b, likes, views, {_poisson_case('h', 1)} AS w FROM boot_draws)
  GROUP BY exp_group, b)"""


def _bucket_cte(name: str) -> str:
    g = ", ".join(str(x) for x in P.AB_GROUPS)
    inner, outer = _mixed(f"(((user_id & {M32}) + {_salt('bucket')}) & {M32})")
    return f"""bucket_low AS (
  SELECT exp_group, action, (user_id >> 32) & {M32} AS hi, {inner} AS z
  FROM feed_actions WHERE {_exp_week()} AND exp_group IN ({g})),
{name} AS (
  SELECT exp_group, CAST({outer} % {P.BUCKETS} AS INTEGER) AS bucket,
    CAST(count_if(action = 'like') AS BIGINT) AS likes, CAST(count_if(action = 'view') AS BIGINT) AS views,
    {_ratio("count_if(action = 'like')", "count_if(action = 'view')")} AS bucket_ctr
  FROM bucket_low GROUP BY 1, 2)"""


def xxh64_sql(keys: str) -> str:
    """CTEs up to ``hashed`` (key, xxh64): the hash of each key's 8 little-endian bytes with
    seed 0, unsigned, step by step as its specification has it; products are taken in 128 bits."""
    p1, p2, p3, p4, p5 = XXH_PRIMES

    def times(x: str, p: int, plus: int = 0) -> str:
        return f"CAST((CAST({x} AS UHUGEINT) * {p}::UHUGEINT + {plus}::UHUGEINT) % 18446744073709551616::UHUGEINT AS UBIGINT)"

    def rotate(x: str, by: int) -> str:
        return f"({times(x, 1 << by)} | ({x} >> {64 - by}))"

    steps = [("a0", "CAST(CAST(key AS HUGEINT) + CASE WHEN key < 0 THEN 18446744073709551616::HUGEINT ELSE 0 END AS UBIGINT)"),
             ("a1", times("a0", p2)), ("a2", rotate("a1", 31)), ("a3", times("a2", p1)),
             ("a4", f"xor(a3, {(p5 + 8) % 2**64}::UBIGINT)"), ("a5", rotate("a4", 27)), ("a6", times("a5", p1, p4)),
             ("a7", "xor(a6, a6 >> 33)"), ("a8", times("a7", p2)), ("a9", "xor(a8, a8 >> 29)"), ("a10", times("a9", p3)),
             ("xxh64", "xor(a10, a10 >> 32)")]
    body = keys
    for name, step in steps:
        body = f"SELECT *, {step} AS {name} FROM ({body})"
    return f"hashed AS (SELECT key, xxh64 FROM ({body}))"


def _xxh64_bucket_cte(name: str) -> str:
    g = ", ".join(str(x) for x in P.AB_GROUPS)
    return f"""{xxh64_sql('SELECT DISTINCT user_id AS key FROM feed_actions')},
{name} AS (
  SELECT exp_group, CAST(xxh64 % {P.BUCKETS} AS INTEGER) AS bucket,
    CAST(count_if(action = 'like') AS BIGINT) AS likes, CAST(count_if(action = 'view') AS BIGINT) AS views,
    {_ratio("count_if(action = 'like')", "count_if(action = 'view')")} AS bucket_ctr
  FROM feed_actions JOIN hashed ON key = user_id WHERE {_exp_week()} AND exp_group IN ({g}) GROUP BY 1, 2)"""


def _linearized_cte(name: str) -> str:
    ctrl = ", ".join(str(a) for a, _ in P.LINEARIZED_PAIRS)
    return f"""{_user_ctr_cte('lin_users', P.ALL_GROUPS)},
{_pairs_cte('pairs', P.LINEARIZED_PAIRS)},
ctrl AS (SELECT exp_group AS group_a, sum(likes) / sum(views) AS ctr_control
         FROM lin_users WHERE exp_group IN ({ctrl}) GROUP BY exp_group),
{name} AS (
  SELECT p.group_a, p.group_b, u.exp_group, p.side, u.user_id, u.likes, u.views, c.ctr_control,
    u.likes - c.ctr_control * u.views AS linearized_likes
  FROM lin_users u JOIN pairs p USING (exp_group) JOIN ctrl c ON c.group_a = p.group_a)"""


def _aa_samples_cte(name: str) -> str:
    """Samples by a keyed permutation of each group's user numbers: a Feistel
    network on 2 x half bits, repeated until the number is in range."""
    def network(x: str, source: str) -> str:
        body = f"SELECT sim, exp_group, n, half, j, base, ({x}) >> half AS l, ({x}) & ((1 << half) - 1) AS r FROM {source}"
        for k in range(ROUNDS):
            body = (f"SELECT sim, exp_group, n, half, j, base, r AS l, {_mix32('m')} & ((1 << half) - 1) AS f, l AS l0 FROM "
                    f"(SELECT *, (r + {_mix32('q')}) & {M32} AS m FROM "
                    f"(SELECT *, (base + exp_group * {GOLDEN32} + {k}) & {M32} AS q FROM ({body})))")
            body = f"SELECT sim, exp_group, n, half, j, base, l, xor(l0, f) AS r FROM ({body})"
        return f"SELECT sim, exp_group, n, half, j, base, (l << half) | r AS x FROM ({body})"

    base = _mix32(f"(({_salt('aa')} + r.sim * {GOLDEN32}) & {M32})")
    return f"""{_user_ctr_cte('aa_users0', P.AA_GROUPS)},
aa_users AS (SELECT *, row_number() OVER (PARTITION BY exp_group ORDER BY user_id) - 1 AS i FROM aa_users0),
aa_sizes AS (
  SELECT exp_group, count(*) AS n, greatest(1, (length(bin(count(*) - 1)) + 1) // 2) AS half,
    CAST(floor(count(*) * {P.AA_SHARE}) AS BIGINT) AS k FROM aa_users GROUP BY exp_group),
aa_start AS (
  SELECT r.sim, s.exp_group, s.n, s.half, j.j, {base} AS base, j.j AS x
  FROM aa_sizes s CROSS JOIN range({P.AA_REPS}) r(sim) JOIN range((SELECT max(n) FROM aa_sizes)) j(j) ON j.j < s.k),
aa_walk AS (
  {network('x', 'aa_start')}
  UNION ALL
  {network('x', '(SELECT * FROM aa_walk WHERE x >= n)')}),
{name} AS (
  SELECT CAST(w.sim AS INTEGER) AS sim, w.exp_group, u.user_id, u.ctr
  FROM aa_walk w JOIN aa_users u ON u.exp_group = w.exp_group AND u.i = w.x WHERE w.x < w.n)"""


#: Levels of the tree over distinct values; those above a table's own size split nothing.
TREE_LEVELS = 14


def split_sql(cells: str, starts: str, salt: str, levels: int = TREE_LEVELS) -> str:
    """CTEs up to ``dealt`` (sim, exp_group, i, k): how many of each sample come from each cell.

    ``cells`` are (exp_group, i, n), ``starts`` (sim, exp_group, k). On each level of a binary
    tree over the cells the sample of a node is split by a hypergeometric draw: the values are
    listed outwards from the mode, and the first whose running probability exceeds the draw counts."""
    base = _mix32(f"(({_salt(salt)} + sim * {GOLDEN32}) & {M32})")
    parts = [f"""sums AS (SELECT exp_group, i, sum(n) OVER (PARTITION BY exp_group ORDER BY i) AS upto FROM {cells}),
node_{levels} AS (SELECT sim, exp_group, CAST(0 AS BIGINT) AS j, k, {base} AS base FROM {starts})"""]

    def choose(n: str, k: str) -> str:
        return f"lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - {k} + 1)"

    probability = (f"exp({choose('part', 'x')} + {choose('(total - part)', '(k - x)')} - ({choose('total', 'k')}))")
    for up in range(levels, 0, -1):
        def upto(at: str) -> str:
            return (f"coalesce((SELECT max(s.upto) FROM sums s WHERE s.exp_group = d.exp_group AND s.i < ({at})), 0)")
        size, half = 1 << up, 1 << (up - 1)
        draw = _mix32("((z + j) & %d)" % M32)
        parts.append(f"""size_{up} AS (
  SELECT exp_group, j, {upto(f'j * {size} + {half}')} - {upto(f'j * {size}')} AS part,
    {upto(f'(j + 1) * {size}')} - {upto(f'j * {size}')} AS total FROM (SELECT DISTINCT exp_group, j FROM node_{up}) d),
split_{up} AS (
  SELECT *, greatest(0, k - (total - part)) AS low, least(part, k) AS high,
    floor((k + 1.0) * (part + 1.0) / (total + 2.0)) AS mode, ({draw} + 0.5) / 4294967296.0 AS u FROM (
    SELECT n.*, s.part, s.total, {_mix32(f'((base + exp_group * {GOLDEN32} + {up}) & {M32})')} AS z
    FROM node_{up} n JOIN size_{up} s USING (exp_group, j))),
took_{up} AS (
  SELECT sim, exp_group, j, CAST(arg_min(x, nth) FILTER (running > u) AS BIGINT) AS x FROM (
    SELECT sim, exp_group, j, x, nth, u, sum(probability) OVER (PARTITION BY sim, exp_group, j ORDER BY nth) AS running FROM (
      SELECT *, CASE WHEN x > mode THEN 2 * (x - mode) - 1 ELSE 2 * (mode - x) END AS nth, {probability} AS probability
      FROM (SELECT *, unnest(range(CAST(low AS BIGINT), CAST(high AS BIGINT) + 1)) AS x FROM split_{up} WHERE low < high)))
  GROUP BY ALL),
left_{up} AS (
  SELECT s.sim, s.exp_group, s.j, s.k, s.base, CAST(CASE WHEN low = high THEN low ELSE coalesce(t.x, s.mode) END AS BIGINT) AS x
  FROM split_{up} s LEFT JOIN took_{up} t USING (sim, exp_group, j)),
node_{up - 1} AS (
  SELECT sim, exp_group, 2 * j AS j, x AS k, base FROM left_{up} WHERE x > 0
  UNION ALL SELECT sim, exp_group, 2 * j + 1, k - x, base FROM left_{up} WHERE k > x)""")
    parts.append("dealt AS (SELECT sim, exp_group, j AS i, k FROM node_0)")
    return ",\n".join(parts)


def _aa_drawn_cte(name: str) -> str:
    """One row per sampled user of the A/A simulations, known by its CTR only."""
    return f"""{_user_ctr_cte('aa_users', P.AA_GROUPS)},
aa_cells AS (
  SELECT exp_group, ctr, n, row_number() OVER (PARTITION BY exp_group ORDER BY ctr NULLS LAST) - 1 AS i
  FROM (SELECT exp_group, ctr, CAST(count(*) AS BIGINT) AS n FROM aa_users GROUP BY ALL)),
aa_starts AS (
  SELECT r.sim, exp_group, k FROM range({P.AA_REPS}) r(sim) CROSS JOIN (
    SELECT exp_group, CAST(floor(sum(n) * {P.AA_SHARE}) AS BIGINT) AS k FROM aa_cells GROUP BY exp_group) WHERE k > 0),
{split_sql('aa_cells', 'aa_starts', 'aa')},
{name} AS (
  SELECT CAST(sim AS INTEGER) AS sim, exp_group, ctr FROM (
    SELECT d.sim, d.exp_group, c.ctr, unnest(range(d.k)) FROM dealt d JOIN aa_cells c USING (exp_group, i)))"""


# --- p-values: the laws' tails by Simpson's rule ------------------------------

def _t_p(rows: str, points: int) -> str:
    """``rows`` (with columns t, df) and p, the two-sided p-value of Student's t:
    the share of the integral of cos(a)^(df - 1) beyond a = atan(|t| / sqrt(df)),
    taken over v with a = pi/2 - v^4, which is smooth at both ends."""
    g = "pow(sin(pow(v, 4)), df - 1) * 4 * pow(v, 3)"
    weight = f"CASE WHEN i IN (0, {points}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"""WITH numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS row_no FROM ({rows}))
SELECT numbered.* EXCLUDE (row_no), tail / whole AS p FROM numbered LEFT JOIN (
  SELECT row_no, any_value(edge) * sum(CASE WHEN part = 1 THEN {weight} * {g} END) AS tail,
    any_value(full_edge) * sum(CASE WHEN part = 0 THEN {weight} * {g} END) AS whole
  FROM (SELECT row_no, df, edge, full_edge, i, part,
          CASE WHEN part = 1 THEN edge ELSE full_edge END * i / {points} AS v
        FROM (SELECT row_no, df, pow(atan2(sqrt(df), abs(t)), 0.25) AS edge, pow(pi() / 2, 0.25) AS full_edge
              FROM numbered WHERE t IS NOT NULL AND df IS NOT NULL)
        CROSS JOIN range({points} + 1) g(i) CROSS JOIN range(2) p(part))
  GROUP BY row_no) integrals USING (row_no)"""


def _z_p(rows: str, points: int = 20000) -> str:
    """``rows`` (with a column z) and p = 2 P(Z >= z), at most 1."""
    weight = f"CASE WHEN i IN (0, {points}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"""SELECT * EXCLUDE (s), least(1.0, 2 * s / sqrt(2 * pi())) AS p FROM (
  SELECT r.*, (SELECT sum({weight} * exp(-pow(r.z + 14.0 * i / {points}, 2) / 2)) * 14.0 / {points} / 3
               FROM range({points} + 1) g(i)) AS s FROM ({rows}) r)"""


def _decision(p: str) -> str:
    return f"CASE WHEN {p} < 0.05 THEN 'rejected' WHEN {p} IS NOT NULL THEN 'not rejected' END"


def _leading(p: str) -> str:
    return f"CAST(printf('%.{P.SIGNIFICANT - 1}e', {p}) AS DOUBLE)"


def _feed_daily(where: str) -> str:
    return f"""SELECT CAST("time" AS DATE) AS day, CAST(count(DISTINCT user_id) AS BIGINT) AS dau,
    CAST(count(CASE WHEN action = 'view' THEN user_id END) AS BIGINT) AS views,
    CAST(count(CASE WHEN action = 'like' THEN user_id END) AS BIGINT) AS likes,
    {_ratio("count(CASE WHEN action = 'like' THEN user_id END)", "count(CASE WHEN action = 'view' THEN user_id END)")} AS ctr
  FROM feed_actions WHERE {where} GROUP BY 1"""


def _day_eq(day) -> str:
    return f'CAST("time" AS DATE) = {_d(day)}'


YESTERDAY = P.AS_OF.fromordinal(P.AS_OF.toordinal() - 1)
WEEK_START = P.AS_OF.fromordinal(P.AS_OF.toordinal() - 7)

# Actions of a day over both services.
DAILY_ACTIONS_CTE = """daily_actions AS (
  SELECT day, sum(is_like) AS likes, sum(is_view) AS views, sum(is_message) AS messages_sent FROM (
    SELECT CAST("time" AS DATE) AS day, CAST(action = 'like' AS BIGINT) AS is_like,
      CAST(action = 'view' AS BIGINT) AS is_view, 0 AS is_message FROM feed_actions
    UNION ALL
    SELECT CAST("time" AS DATE), 0, 0, CAST(reciever_id IS NOT NULL AS BIGINT) FROM message_actions)
  GROUP BY day)"""

# A user is new on a day with an action of theirs that has none on an earlier day.
NEW_USERS_CTE = """user_days AS (
  SELECT user_id, CAST("time" AS DATE) AS day FROM feed_actions
  UNION SELECT user_id, CAST("time" AS DATE) FROM message_actions),
new_users AS (
  SELECT d.day, count(d.user_id) AS new_users FROM user_days d
  WHERE NOT EXISTS (SELECT 1 FROM user_days earlier WHERE earlier.user_id = d.user_id AND earlier.day < d.day)
  GROUP BY d.day)"""

# A post is new on the first of the days it has actions on.
NEW_POSTS_CTE = """post_days AS (
  SELECT post_id, CAST("time" AS DATE) AS day, dense_rank() OVER (PARTITION BY post_id ORDER BY CAST("time" AS DATE)) AS nth
  FROM feed_actions),
new_posts AS (SELECT day, count(DISTINCT post_id) AS new_posts FROM post_days WHERE nth = 1 GROUP BY day)"""


def _dau_cte(name: str, compat: bool) -> str:
    """Users of one service only, and of the app (``compat``: those of the feed),
    on days that have both kinds of one-service users."""
    app = "count(*) FILTER (in_feed)" if compat else "count(*)"
    return f"""presence AS (
  SELECT day, user_id, bool_or(service = 'feed') AS in_feed, bool_or(service = 'messenger') AS in_messenger
  FROM (SELECT CAST("time" AS DATE) AS day, user_id, 'feed' AS service FROM feed_actions
        UNION ALL SELECT CAST("time" AS DATE), user_id, 'messenger' FROM message_actions)
  GROUP BY day, user_id),
{name} AS (
  SELECT day, count(*) FILTER (in_messenger AND NOT in_feed) AS dau_message,
    count(*) FILTER (in_feed AND NOT in_messenger) AS dau_feed, {app} AS dau_all_services
  FROM presence GROUP BY day
  HAVING bool_or(in_messenger AND NOT in_feed) AND bool_or(in_feed AND NOT in_messenger))"""


PRODUCT_DAILY_CTE = """product_daily AS (
  SELECT day, CAST(likes AS BIGINT) AS likes, CAST(views AS BIGINT) AS views,
    CAST(messages_sent AS BIGINT) AS messages_sent, CAST(new_users AS BIGINT) AS new_users,
    CAST(new_posts AS BIGINT) AS new_posts, CAST(dau_message AS BIGINT) AS dau_message,
    CAST(dau_feed AS BIGINT) AS dau_feed, CAST(dau_all_services AS BIGINT) AS dau_all_services
  FROM daily_actions FULL JOIN new_users USING (day) FULL JOIN new_posts USING (day) FULL JOIN dau USING (day))"""

PRODUCT_CTES = (DAILY_ACTIONS_CTE, NEW_USERS_CTE, NEW_POSTS_CTE, _dau_cte("dau", False), PRODUCT_DAILY_CTE)


def _weekly_cte(name: str, feed_only: bool) -> str:
    src = 'SELECT user_id, "time" FROM feed_actions'
    if not feed_only:
        src += ' UNION ALL SELECT user_id, "time" FROM message_actions'
    next_week = P.AS_OF.fromordinal(P.AS_OF.toordinal() - P.AS_OF.weekday() + 7)
    return f"""uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', CAST("time" AS DATE)) AS DATE) AS week FROM ({src})),
{name} AS (
  SELECT this_week, previous_week, CAST(-count(*) AS BIGINT) AS num_users, 'gone' AS status FROM (
    SELECT a.week + 7 AS this_week, a.week AS previous_week FROM uw a
    LEFT JOIN uw n ON n.user_id = a.user_id AND n.week = a.week + 7 WHERE n.user_id IS NULL)
  GROUP BY 1, 2 HAVING this_week <> {_d(next_week)}
  UNION ALL
  SELECT this_week, previous_week, CAST(count(*) AS BIGINT) AS num_users, status FROM (
    SELECT a.week AS this_week, a.week - 7 AS previous_week,
      CASE WHEN p.user_id IS NULL THEN 'new' ELSE 'retained' END AS status FROM uw a
    LEFT JOIN uw p ON p.user_id = a.user_id AND p.week = a.week - 7)
  GROUP BY 1, 2, 4)"""


ETL_FEED_CTE = """etl_feed AS (
  SELECT CAST("time" AS DATE) AS event_date, user_id, os, age, gender,
    CAST(count_if(action = 'view') AS BIGINT) AS views, CAST(count_if(action = 'like') AS BIGINT) AS likes
  FROM feed_actions GROUP BY 1, 2, 3, 4, 5)"""

# What a user sent and got on a day; users who sent nothing that day are left out.
ETL_MESSAGES_CTE = """outbox AS (
  SELECT CAST("time" AS DATE) AS event_date, user_id, os, age, gender,
    CAST(count(*) AS BIGINT) AS messages_sent, CAST(count(DISTINCT reciever_id) AS BIGINT) AS users_sent
  FROM message_actions GROUP BY ALL),
inbox AS (
  SELECT CAST("time" AS DATE) AS event_date, reciever_id AS user_id,
    CAST(count(*) AS BIGINT) AS messages_received, CAST(count(DISTINCT user_id) AS BIGINT) AS users_received
  FROM message_actions GROUP BY ALL),
etl_messages AS (
  SELECT event_date, user_id, os, age, gender, messages_received, messages_sent, users_received, users_sent
  FROM outbox JOIN inbox USING (event_date, user_id))"""

# Both services of a user and day side by side; unknown attributes match each other.
ETL_TOTAL_CTE = """etl_total AS (
  SELECT coalesce(f.event_date, m.event_date) AS event_date, coalesce(f.user_id, m.user_id) AS user_id,
    coalesce(f.os, m.os) AS os, coalesce(f.age, m.age) AS age, coalesce(f.gender, m.gender) AS gender,
    f.views, f.likes, m.messages_received, m.messages_sent, m.users_received, m.users_sent
  FROM etl_feed f FULL JOIN etl_messages m
  ON f.event_date IS NOT DISTINCT FROM m.event_date AND f.user_id IS NOT DISTINCT FROM m.user_id
    AND f.os IS NOT DISTINCT FROM m.os AND f.age IS NOT DISTINCT FROM m.age AND f.gender IS NOT DISTINCT FROM m.gender)"""


def _slice(dim: str) -> str:
    metrics = ", ".join(f"CAST(coalesce(sum({m}), 0) AS BIGINT) AS {m}" for m in
                        ("views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"))
    return (f"SELECT event_date, '{dim}' AS dimension, CAST({dim} AS VARCHAR) AS dimension_value, {metrics} "
            f"FROM etl_total WHERE {dim} IS NOT NULL GROUP BY event_date, {dim}")


def _alert_series_cte(name: str) -> str:
    start = P.NOW.replace(hour=0, minute=0, second=0, microsecond=0)
    start = start.fromordinal(start.toordinal() - 1)
    end = P.NOW.replace(minute=P.NOW.minute - P.NOW.minute % 15, second=0, microsecond=0)
    win = f'"time" >= {_ts(start)} AND "time" < {_ts(end)}'
    return f"""{name} AS (
  SELECT f.ts, CAST(f.ts AS DATE) AS date, strftime(f.ts, '%H:%M') AS hm, f.users_feed, f.views, f.likes,
    round({_ratio('f.likes', 'f.views')}, 3) AS ctr,
    coalesce(m.users_messenger, 0) AS users_messenger, coalesce(m.number_messages, 0) AS number_messages
  FROM (SELECT time_bucket(INTERVAL 15 MINUTE, "time") AS ts, CAST(count(DISTINCT user_id) AS BIGINT) AS users_feed,
          CAST(count_if(action = 'view') AS BIGINT) AS views, CAST(count_if(action = 'like') AS BIGINT) AS likes
        FROM feed_actions WHERE {win} GROUP BY 1) f
  LEFT JOIN (SELECT time_bucket(INTERVAL 15 MINUTE, "time") AS ts, CAST(count(DISTINCT user_id) AS BIGINT) AS users_messenger,
          CAST(count(reciever_id) AS BIGINT) AS number_messages
        FROM message_actions GROUP BY 1) m ON f.ts = m.ts)"""


ALERT_METRICS = ["users_feed", "views", "likes", "ctr", "users_messenger", "number_messages"]
# Display names (fixed values, as in the alert module).
ALERT_LABELS = {"users_feed": "Feed audience", "views": "Views", "likes": "Likes", "ctr": "CTR",
                "users_messenger": "Messenger audience", "number_messages": "Messages sent"}


def _alert_bands_cte(name: str) -> str:
    long = " UNION ALL ".join(
        f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM series" for m in ALERT_METRICS)
    w = "PARTITION BY metric ORDER BY ts"
    before = f"({w} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)"
    return f"""{_alert_series_cte('series')},
long AS ({long}),
b0 AS (
  SELECT metric, ts, value, lag(value) OVER ({w}) AS prev_value,
    CASE WHEN count(value) OVER {before} = 4 THEN avg(value) OVER {before} END AS mean,
    CASE WHEN count(value) OVER {before} = 4 THEN stddev_samp(value) OVER {before} END AS std
  FROM long),
{name} AS (
  SELECT metric, ts, value, prev_value, mean, std,
    avg(mean + 3 * std) OVER ({w} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS up,
    avg(mean - 3 * std) OVER ({w} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS low
  FROM b0)"""


def _retention_select(seg_expr: str, seg_name: str) -> str:
    return f"""ud AS (SELECT user_id, CAST("time" AS DATE) AS day, min(source) AS source FROM feed_actions GROUP BY 1, 2),
u AS (SELECT user_id, min(day) AS cohort_date, min(source) AS source FROM ud GROUP BY 1),
act AS (
  SELECT {seg_expr} AS {seg_name}, u.cohort_date, CAST(datediff('day', u.cohort_date, ud.day) AS INTEGER) AS day_n,
    CAST(count(*) AS BIGINT) AS active_users
  FROM ud JOIN u USING (user_id) GROUP BY 1, 2, 3)"""


def _retention_final(seg_name: str) -> str:
    return f"""SELECT a.{seg_name}, a.cohort_date, a.day_n, a.active_users, c.active_users AS cohort_users,
  {_r(_ratio('a.active_users', 'c.active_users'))} AS retention
FROM act a LEFT JOIN act c ON c.{seg_name} = a.{seg_name} AND c.cohort_date = a.cohort_date AND c.day_n = 0"""


def _rounded_cols(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(f"{_r(c)} AS {c}" if c in doubles else c for c in cols)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["feed_actions"] = _with() + "SELECT * FROM feed_actions"
    q["message_actions"] = _with() + "SELECT * FROM message_actions"

    # feed report
    day = _feed_daily(_day_eq(YESTERDAY))
    q["report_day"] = _with(f"d AS ({day})") + f"""
SELECT day, dau, views, likes, {_r('ctr')} AS ctr,
  'Feed report for ' || strftime(day, '%d.%m.%Y') || ':
DAU: ' || CAST(dau AS VARCHAR) || '
Views: ' || CAST(views AS VARCHAR) || '
Likes: ' || CAST(likes AS VARCHAR) || '
CTR: ' || coalesce({_percent2('ctr')}, 'n/a') AS message
FROM d"""
    week = _feed_daily(f'CAST("time" AS DATE) BETWEEN {_d(WEEK_START)} AND {_d(YESTERDAY)}')
    q["report_week"] = _with(f"d AS ({week})") + f"SELECT day, dau, views, likes, {_r('ctr')} AS ctr FROM d"
    q["report_week_series"] = _with(f"d AS ({week})") + " UNION ALL ".join(
        f"SELECT day, strftime(day, '%d/%m/%Y') AS label, '{m}' AS metric, {_r(f'CAST({m} AS DOUBLE)')} AS value FROM d"
        for m in ("dau", "views", "likes", "ctr"))

    # application report
    q["daily_actions"] = _with(DAILY_ACTIONS_CTE) + """
SELECT day, CAST(likes AS BIGINT) AS likes, CAST(views AS BIGINT) AS views,
  CAST(messages_sent AS BIGINT) AS messages_sent FROM daily_actions"""
    # One row per feed day and message day of a user (feed users without
    # messages: one row per feed day), summed by the feed day.
    q["daily_actions_compat"] = _with("""feed_days AS (
  SELECT user_id, CAST("time" AS DATE) AS day, count_if(action = 'like') AS likes, count_if(action = 'view') AS views
  FROM feed_actions GROUP BY ALL)""", """message_days AS (
  SELECT user_id, CAST("time" AS DATE) AS message_day, count(reciever_id) AS messages FROM message_actions GROUP BY ALL)""",
        """pairs AS (
  SELECT day, likes, views, messages FROM feed_days JOIN message_days USING (user_id)
  UNION ALL
  SELECT day, likes, views, 0 FROM feed_days ANTI JOIN message_days USING (user_id))""") + """
SELECT day, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
  CAST(sum(messages) AS BIGINT) AS messages_sent FROM pairs GROUP BY day"""
    q["new_users"] = _with(NEW_USERS_CTE) + "SELECT day, CAST(new_users AS BIGINT) AS new_users FROM new_users"
    q["new_posts"] = _with(NEW_POSTS_CTE) + "SELECT day, CAST(new_posts AS BIGINT) AS new_posts FROM new_posts"
    dau_cols = """SELECT day, CAST(dau_message AS BIGINT) AS dau_message, CAST(dau_feed AS BIGINT) AS dau_feed,
  CAST(dau_all_services AS BIGINT) AS dau_all_services FROM dau"""
    q["dau"] = _with(_dau_cte("dau", False)) + dau_cols
    q["dau_all_compat"] = _with(_dau_cte("dau", True)) + dau_cols
    q["product_daily"] = _with(*PRODUCT_CTES) + "SELECT * FROM product_daily"
    q["product_report_day"] = _with(*PRODUCT_CTES) + f"""
SELECT *, 'App report for ' || strftime(day, '%d.%m.%Y') || ':
New users: ' || coalesce(CAST(new_users AS VARCHAR), 'n/a') || '
DAU: ' || coalesce(CAST(dau_all_services AS VARCHAR), 'n/a') || '
New posts: ' || coalesce(CAST(new_posts AS VARCHAR), 'n/a') || '
Views: ' || coalesce(CAST(views AS VARCHAR), 'n/a') || '
Likes: ' || coalesce(CAST(likes AS VARCHAR), 'n/a') AS message
FROM product_daily WHERE day = {_d(YESTERDAY)}"""
    q["product_series"] = _with(*PRODUCT_CTES) + " UNION ALL ".join(
        f"SELECT day, strftime(day, '%d/%m/%Y') AS label, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM product_daily"
        for m in ("likes", "views", "messages_sent", "new_users", "new_posts",
                  "dau_message", "dau_feed", "dau_all_services"))
    q["top_posts"] = _with() + f"""
SELECT post_id, CAST(count_if(action = 'view') AS BIGINT) AS views, CAST(count_if(action = 'like') AS BIGINT) AS likes,
  {_r(_ratio("count_if(action = 'like')", "count_if(action = 'view')"))} AS ctr,
  CAST(count(DISTINCT user_id) AS BIGINT) AS uniq_users
FROM feed_actions GROUP BY post_id ORDER BY views DESC, post_id LIMIT 10"""

    q["weekly_audience"] = _with(_weekly_cte("weekly", False)) + "SELECT * FROM weekly"
    q["weekly_audience_compat"] = _with(_weekly_cte("weekly", True)) + "SELECT * FROM weekly"
    q["weekly_audience_totals"] = _with(_weekly_cte("weekly", False)) + """
SELECT this_week, strftime(this_week, '%d/%m/%Y') AS label, CAST(sum(num_users) AS BIGINT) AS num_users
FROM weekly GROUP BY this_week"""
    q["weekly_audience_series"] = _with(_weekly_cte("weekly", False)) + """
SELECT this_week, strftime(this_week, '%d/%m/%Y') AS label, status, num_users FROM weekly"""

    # sketches: the exact numbers, which every estimate has to meet within its bound
    q["weekly_users_sketched"] = _with("""seen AS (
  SELECT user_id, "time" FROM feed_actions UNION ALL SELECT user_id, "time" FROM message_actions)""") + """
SELECT CAST(date_trunc('week', CAST("time" AS DATE)) AS DATE) AS week, count(DISTINCT user_id) AS users, true AS within_bound
FROM seen GROUP BY 1"""
    q["weekly_audience_sketched"] = _with(_weekly_cte("weekly", False)) + """
SELECT this_week, previous_week, status, abs(num_users) AS users, true AS within_bound FROM weekly"""

    # slices
    q["etl_feed"] = _with(ETL_FEED_CTE) + "SELECT * FROM etl_feed"
    q["etl_messages"] = _with(ETL_MESSAGES_CTE) + "SELECT * FROM etl_messages"
    q["etl_total"] = _with(ETL_FEED_CTE, ETL_MESSAGES_CTE, ETL_TOTAL_CTE) + "SELECT * FROM etl_total"
    q["etl_slices"] = (_with(ETL_FEED_CTE, ETL_MESSAGES_CTE, ETL_TOTAL_CTE)
                       + " UNION ALL ".join(_slice(d) for d in ("os", "age", "gender")))

    # experiments
    uc = ["exp_group", "user_id", "likes", "views", "ctr"]
    q["user_ctr"] = _with(_users_src(P.ALL_GROUPS)) + f"SELECT {_rounded_cols(uc, {'ctr'})} FROM src"
    q["group_sizes"] = _with(_users_src(P.AA_GROUPS)) + """
SELECT exp_group, count(user_id) AS user_id, count(likes) AS likes, count(views) AS views, count(ctr) AS ctr
FROM src GROUP BY exp_group"""
    q["global_ctr"] = _with(_users_src(P.AB_GROUPS)) + f"""
SELECT exp_group, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
  {_r(_ratio('sum(likes)', 'sum(views)'))} AS global_ctr FROM src GROUP BY exp_group"""
    q["welch_ctr"] = _welch_pairs(_users_src(P.AB_GROUPS), "ctr", [P.AB_GROUPS])
    q["welch_ctr_pairs"] = _welch_pairs(_users_src(P.ALL_GROUPS), "ctr", P.LINEARIZED_PAIRS)
    q["mann_whitney"] = _mann_whitney(_users_src(P.AB_GROUPS), "ctr", *P.AB_GROUPS)

    smoothed = f"""{_user_ctr_cte('ab_users', P.AB_GROUPS)},
g AS (SELECT exp_group, sum(likes) / sum(views) AS global_ctr FROM ab_users GROUP BY exp_group),
src AS (SELECT u.exp_group, u.user_id, u.likes, u.views, g.global_ctr,
          (u.likes + 5.0 * g.global_ctr) / (u.views + 5.0) AS smoothed_ctr
        FROM ab_users u JOIN g USING (exp_group))"""
    sc = ["exp_group", "user_id", "likes", "views", "global_ctr", "smoothed_ctr"]
    q["smoothed_ctr"] = _with(smoothed) + f"SELECT {_rounded_cols(sc, {'global_ctr', 'smoothed_ctr'})} FROM src"
    q["welch_smoothed"] = _welch_pairs(smoothed, "smoothed_ctr", [P.AB_GROUPS])

    boot = f"{_user_ctr_cte('ab_users', P.AB_GROUPS)},\n{_boot_cte('src')}"
    q["poisson_bootstrap"] = _recursive(_with(boot)) + f"SELECT exp_group, CAST(b AS INTEGER) AS b, likes_w, views_w, {_r('ctr')} AS ctr FROM src"
    a, b = P.AB_GROUPS
    q["bootstrap_diff"] = _recursive(_with(boot)) + f"""
SELECT CAST(b AS INTEGER) AS b, {_r('ctr_a')} AS ctr_a, {_r('ctr_b')} AS ctr_b, {_r('ctr_b - ctr_a')} AS diff FROM (
  SELECT b, max(CASE WHEN exp_group = {a} THEN ctr END) AS ctr_a, max(CASE WHEN exp_group = {b} THEN ctr END) AS ctr_b
  FROM src GROUP BY b)"""
    by_user = f"{_user_ctr_cte('ab_users', P.AB_GROUPS)},\n{_boot_by_user_cte('src')}"
    q["welch_bootstrap"] = _welch_pairs(by_user, "ctr", [P.AB_GROUPS])

    q["bucket_ctr"] = _with(_bucket_cte("src")) + f"SELECT exp_group, bucket, likes, views, {_r('bucket_ctr')} AS bucket_ctr FROM src"
    q["welch_bucket"] = _welch_pairs(_bucket_cte("src"), "bucket_ctr", [P.AB_GROUPS])
    q["mann_whitney_bucket"] = _mann_whitney(_bucket_cte("src"), "bucket_ctr", *P.AB_GROUPS)

    q["bucket_ctr_xxh64"] = _with(_xxh64_bucket_cte("src")) + f"SELECT exp_group, bucket, likes, views, {_r('bucket_ctr')} AS bucket_ctr FROM src"
    q["welch_bucket_xxh64"] = _welch_pairs(_xxh64_bucket_cte("src"), "bucket_ctr", [P.AB_GROUPS])

    lc = ["group_a", "group_b", "exp_group", "user_id", "likes", "views", "ctr_control", "linearized_likes"]
    q["linearized_likes"] = _with(_linearized_cte("lin")) + f"SELECT {_rounded_cols(lc, {'ctr_control', 'linearized_likes'})} FROM lin"
    q["linearized_means"] = _with(_linearized_cte("lin")) + f"""
SELECT group_a, group_b, exp_group, {_r('avg(linearized_likes)')} AS mean_linearized_likes FROM lin GROUP BY 1, 2, 3"""
    q["welch_linearized"] = _with(_linearized_cte("lin")) + _welch_select(
        "lin", "linearized_likes", "side", "'a'", "'b'", "group_a, group_b")

    bins = P.HIST_BINS
    def hist_sql(src_ctes, src: str, value: str, group: str | None, bins: int = bins) -> str:
        g = f"{group}, " if group else ""
        return _with(*src_ctes, f"x AS (SELECT * FROM {src} WHERE {value} IS NOT NULL)",
                     f"rng AS (SELECT min({value}) AS lo, max({value}) AS hi FROM x)") + f"""
SELECT {g}bin, {_r(f'lo + (hi - lo) / {bins} * bin')} AS bin_lo, {_r(f'lo + (hi - lo) / {bins} * (bin + 1)')} AS bin_hi,
  CAST(count(*) AS BIGINT) AS n FROM (
  SELECT {'x.' + group + ', ' if group else ''}rng.lo, rng.hi,
    CAST(CASE WHEN rng.hi = rng.lo THEN 0 ELSE least(floor((x.{value} - rng.lo) / (rng.hi - rng.lo) * {bins}), {bins - 1}) END AS INTEGER) AS bin
  FROM x CROSS JOIN rng)
GROUP BY {g}bin, lo, hi"""

    q["ctr_histogram"] = hist_sql((_users_src(P.AB_GROUPS),), "src", "ctr", "exp_group")
    q["aa_ctr_histogram"] = hist_sql((_users_src(P.AA_GROUPS),), "src", "ctr", "exp_group")
    auto = f"""qs AS (
  SELECT CAST(count(*) AS BIGINT) AS n, min(ctr) AS lo, max(ctr) AS hi, quantile_cont(ctr, 0.25) AS q1, quantile_cont(ctr, 0.75) AS q3
  FROM src WHERE ctr IS NOT NULL),
widths AS (SELECT *, (hi - lo) / (log2(n) + 1) AS sturges, 2 * (q3 - q1) / pow(n, 1.0 / 3) AS fd FROM qs),
auto AS (SELECT n, lo, hi, q1, q3, CASE WHEN hi > lo
  THEN CAST(ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END) AS BIGINT) ELSE 1 END AS bins FROM widths)"""
    q["ctr_auto_bins"] = _with(_users_src(P.AB_GROUPS), auto) + f"SELECT {_rounded_cols(['n', 'lo', 'hi', 'q1', 'q3', 'bins'], {'lo', 'hi', 'q1', 'q3'})} FROM auto"
    q["ctr_histogram_auto"] = _with(_users_src(P.AB_GROUPS), auto) + f"""
SELECT exp_group, bin, {_r('lo + (hi - lo) / bins * bin')} AS bin_lo, {_r('lo + (hi - lo) / bins * (bin + 1)')} AS bin_hi,
  CAST(count(*) AS BIGINT) AS n FROM (
  SELECT src.exp_group, lo, hi, bins,
    CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((ctr - lo) / (hi - lo) * bins), bins - 1) END AS INTEGER) AS bin
  FROM src CROSS JOIN auto WHERE ctr IS NOT NULL)
GROUP BY exp_group, bin, lo, hi, bins"""
    diff_cte = f"""diff AS (
  SELECT b, max(CASE WHEN exp_group = {a} THEN ctr END) AS ctr_a, max(CASE WHEN exp_group = {b} THEN ctr END) AS ctr_b,
    max(CASE WHEN exp_group = {b} THEN ctr END) - max(CASE WHEN exp_group = {a} THEN ctr END) AS diff
  FROM src GROUP BY b)"""
    q["bootstrap_diff_histogram"] = _recursive(hist_sql((boot, diff_cte), "diff", "diff", None))
    q["bucket_ctr_histogram"] = hist_sql((_bucket_cte("src"),), "src", "bucket_ctr", "exp_group")
    # one histogram per pair, with edges of its own
    q["linearized_histogram"] = " UNION ALL ".join(
        f"SELECT {pa} AS group_a, {pb} AS group_b, * FROM (" + hist_sql(
            (_linearized_cte("lin"), f"lin1 AS (SELECT * FROM lin WHERE group_a = {pa} AND group_b = {pb})"),
            "lin1", "linearized_likes", "exp_group") + ")"
        for pa, pb in P.LINEARIZED_PAIRS)

    q["aa_samples"] = _recursive(_with(_aa_samples_cte("s"))) + f"SELECT sim, exp_group, user_id, {_r('ctr')} AS ctr FROM s"
    a2, b2 = P.AA_GROUPS
    drawn = _aa_drawn_cte("s")
    q["aa_stats"] = _with(drawn) + _welch_select("s", "ctr", "exp_group", str(a2), str(b2), "sim")
    stats = _welch_select("s", "ctr", "exp_group", str(a2), str(b2), "sim", _plain)
    tests = f"tests AS ({_t_p(f'SELECT sim, t, df FROM ({stats})', 6000)})"
    q["aa_test"] = _with(drawn, tests) + f"SELECT sim, {_r('t')} AS t, {_r('df')} AS df, {_leading('p')} AS p_value FROM tests"
    q["aa_summary"] = _with(drawn, tests) + f"""SELECT CAST(count(p) AS BIGINT) AS n_sims,
  CAST(count(*) FILTER (p <= 0.05) AS BIGINT) AS n_significant, {_r('avg(CAST(p <= 0.05 AS DOUBLE))')} AS fp_share FROM tests"""
    q["aa_pvalue_histogram"] = hist_sql((drawn, tests), "tests", "p", None, 10)

    # every A/B test, from statistics that are not rounded
    def t_test(name: str, statement: str) -> str:
        rows = _t_p(f"SELECT group_a, group_b, t, df FROM ({statement})", 20000)
        return (f"SELECT '{name}' AS test, group_a, group_b, {_r('t')} AS statistic, {_r('df')} AS df, "
                f"{_leading('p')} AS p_value, {_decision('p')} AS decision FROM ({rows})")

    def u_test(name: str, statement: str) -> str:
        return (f"SELECT '{name}' AS test, group_a, group_b, {_r('u_a')} AS statistic, CAST(NULL AS DOUBLE) AS df, "
                f"{_leading('p')} AS p_value, {_decision('p')} AS decision FROM ({_z_p(statement)})")

    lin_stats = _with(_linearized_cte("lin")) + _welch_select(
        "lin", "linearized_likes", "side", "'a'", "'b'", "group_a, group_b", _plain)
    ab = [P.AB_GROUPS]
    q["ab_results"] = " UNION ALL ".join([
        t_test("welch_ctr", _welch_pairs(_users_src(P.ALL_GROUPS), "ctr", P.LINEARIZED_PAIRS, _plain)),
        u_test("mann_whitney_ctr", _mann_whitney(_users_src(P.AB_GROUPS), "ctr", *P.AB_GROUPS, _plain)),
        t_test("welch_smoothed_ctr", _welch_pairs(smoothed, "smoothed_ctr", ab, _plain)),
        t_test("welch_bootstrap_ctr", _recursive(_welch_pairs(boot, "ctr", ab, _plain))),
        t_test("welch_bucket_ctr", _welch_pairs(_bucket_cte("src"), "bucket_ctr", ab, _plain)),
        u_test("mann_whitney_bucket_ctr", _mann_whitney(_bucket_cte("src"), "bucket_ctr", *P.AB_GROUPS, _plain)),
        t_test("welch_linearized_likes", lin_stats)])

    # alerts
    q["alert_series"] = _with(_alert_series_cte("series")) + f"""
SELECT ts, date, hm, users_feed, views, likes, {_r('ctr')} AS ctr, users_messenger, number_messages FROM series"""
    bc = ["metric", "ts", "strftime(ts, '%d/%m %H:%M') AS label", "value", "prev_value", "mean", "std", "up", "low"]
    q["alert_bands"] = _with(_alert_bands_cte("bands")) + f"""
SELECT {_rounded_cols(bc, {'value', 'prev_value', 'mean', 'std', 'up', 'low'})} FROM bands"""
    label = "CASE metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ALERT_LABELS.items()) + " ELSE metric END"
    q["alert_check"] = _with(_alert_bands_cte("bands")) + f"""
SELECT metric, ts, {_r('value')} AS value, {_r('low')} AS low, {_r('up')} AS up, is_alert, {_r('deviation')} AS deviation,
  CASE WHEN is_alert THEN 'Alert! Metric ' || ({label}) || ':
- current value ' || coalesce({_fixed2('value')}, 'n/a') || ';
- deviation from the previous value ' || coalesce({_percent2('deviation')}, 'n/a') END AS message
FROM (
  SELECT *, coalesce(value < low OR value > up, false) AS is_alert,
    abs(1.0 - value / nullif(prev_value, 0)) AS deviation
  FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY ts DESC) AS rk FROM bands) WHERE rk = 1)"""

    # cohorts
    q["retention_by_source"] = _with(_retention_select("u.source", "source")) + _retention_final("source")
    camp = (f"CASE WHEN u.cohort_date BETWEEN {_d(P.CAMPAIGN_START)} AND {_d(P.CAMPAIGN_END)} "
            f"THEN 'campaign' ELSE 'other' END")
    q["campaign_retention"] = _with(_retention_select(camp, "segment")) + _retention_final("segment")
    # the same numbers from the bitmaps of active days
    for key in ("weekly_audience", "retention_by_source", "campaign_retention"):
        q[f"{key}_bitmaps"] = q[key]
    base = (f'CAST("time" AS DATE) BETWEEN {_d(P.DROP_BASE_START)} AND {_d(P.DROP_BASE_END)}')
    drop = f'CAST("time" AS DATE) = {_d(P.DROP_DAY)}'
    dims = ("os", "gender", "age", "source")
    cols = "user_id, os, gender, age, source"
    q["audience_drop"] = _with(
        f"""base AS (SELECT {cols} FROM feed_actions WHERE {base}
              UNION ALL SELECT {cols} FROM message_actions WHERE {base})""",
        f"""present AS (SELECT user_id FROM feed_actions WHERE {drop}
              UNION ALL SELECT user_id FROM message_actions WHERE {drop})""",
        """marked AS (SELECT *, user_id IN (SELECT user_id FROM present) AS came FROM base)""") + " UNION ALL ".join(
        f"""SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS dimension_value,
  CAST(count(DISTINCT user_id) AS BIGINT) AS users_base,
  CAST(count(DISTINCT user_id) FILTER (NOT came) AS BIGINT) AS users_missing,
  {_r(_ratio('count(DISTINCT user_id) FILTER (NOT came)', 'count(DISTINCT user_id)'))} AS share_missing
FROM marked WHERE {d} IS NOT NULL GROUP BY {d}""" for d in dims)
    cube = ", ".join(dims)
    sizes = " + ".join(f"(1 - grouping({d}))" for d in dims)
    known = " AND ".join(f"(grouping({d}) = 1 OR {d} IS NOT NULL)" for d in dims)
    parent = " AND ".join(f"(p.{d} IS NOT DISTINCT FROM c.{d} OR p.{d} IS NULL)" for d in dims)
    q["audience_drop_segments"] = _with(
        f"""base AS (SELECT {cols} FROM feed_actions WHERE {base}
              UNION ALL SELECT {cols} FROM message_actions WHERE {base})""",
        f"""present AS (SELECT user_id FROM feed_actions WHERE {drop}
              UNION ALL SELECT user_id FROM message_actions WHERE {drop})""",
        f"""marked AS (SELECT user_id, {', '.join(f'CAST({d} AS VARCHAR) AS {d}' for d in dims)},
                user_id IN (SELECT user_id FROM present) AS came FROM base)""",
        f"""cube AS (
  SELECT {cube}, CAST({sizes} AS INTEGER) AS n_dimensions, count(DISTINCT user_id) AS users_base,
    count(DISTINCT user_id) FILTER (NOT came) AS users_missing
  FROM marked GROUP BY CUBE ({cube}) HAVING {known}
    AND count(DISTINCT user_id) >= ceil((SELECT count(DISTINCT user_id) FROM marked) * {P.DROP_SHARE})),
shares AS (SELECT *, {_ratio('users_missing', 'users_base')} AS share_missing FROM cube),
judged AS (
  SELECT c.*, (SELECT max(p.share_missing) FROM shares p WHERE p.n_dimensions = c.n_dimensions - 1 AND {parent}) AS best
  FROM shares c WHERE n_dimensions > 0)""") + f"""
SELECT {cube}, n_dimensions, users_base, users_missing, {_r('share_missing')} AS share_missing,
  {_r('best')} AS best_parent_share, {_r('share_missing / nullif(best, 0)')} AS lift,
  {_r('(users_missing - users_base * best) / nullif(sqrt(users_base * best * (1.0 - best)), 0)')} AS z
FROM judged"""
    return q
