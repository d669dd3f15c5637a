"""Buckets equal to a column store's, and bin counts that the values choose."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.functions.columns import unsigned_mod, xxh64, xxh64_bucket
from feedlens.operators import experiments as ex
from feedlens.plans import oracle

M64 = 2**64 - 1
# The five primes of XXH64.
P1, P2, P3, P4, P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def _rotl(x, r):
    return ((x << r) | (x >> (64 - r))) & M64


def plain_xxh64(data: bytes, seed: int = 0) -> int:
    """XXH64 of inputs shorter than 32 bytes, from its specification."""
    h, i = (seed + P5 + len(data)) & M64, 0
    while i + 8 <= len(data):
        k = int.from_bytes(data[i:i + 8], "little")
        h ^= _rotl(k * P2 & M64, 31) * P1 & M64
        h = (_rotl(h, 27) * P1 + P4) & M64
        i += 8
    if i + 4 <= len(data):
        h ^= int.from_bytes(data[i:i + 4], "little") * P1 & M64
        h = (_rotl(h, 23) * P2 + P3) & M64
        i += 4
    for byte in data[i:]:
        h ^= byte * P5 & M64
        h = _rotl(h, 11) * P1 & M64
    h = (h ^ h >> 33) * P2 & M64
    h = (h ^ h >> 29) * P3 & M64
    return h ^ h >> 32


def test_plain_form_has_the_published_vectors():
    # fixed values of the published hash: the empty input, and "a"
    assert plain_xxh64(b"") == 0xEF46DB3751D8E999
    assert plain_xxh64(b"a") == 0xD24EC4F1A98C6E5B


KEYS = [0, 1, 2, 199, 4294967295, 2**62, -1, -(2**63), 123456789, 987654321987]


def test_hash_of_integers(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(k,) for k in KEYS], "k bigint")
    for r in df.select("k", xxh64("k").alias("h"), xxh64_bucket("k", 200).alias("b")).collect():
        want = plain_xxh64((r.k & M64).to_bytes(8, "little"))
        assert r.h & M64 == want and r.b == want % 200
    small = df.where("k between 0 and 2000000000")
    for r in small.select("k", xxh64("k", 4).alias("h"), xxh64_bucket("k", 7, 4).alias("b")).collect():
        want = plain_xxh64(r.k.to_bytes(4, "little"))
        assert r.h & M64 == want and r.b == want % 7
    with pytest.raises(ValueError):
        xxh64("k", 3)


def test_sql_form_is_the_same_hash():
    values = ", ".join(f"(CAST('{k}' AS BIGINT))" for k in KEYS)
    rows = duckdb.sql(f"WITH keys(key) AS (VALUES {values}), {oracle.xxh64_sql('SELECT * FROM keys')} SELECT * FROM hashed").fetchall()
    assert dict(rows) == {k: plain_xxh64((k & M64).to_bytes(8, "little")) for k in KEYS}


def test_unsigned_mod(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k bigint")
    for m in (1, 2, 200, 999):
        assert all(r.b == (r.k & M64) % m for r in df.select("k", unsigned_mod("k", m).alias("b")).collect())


def test_bucket_of_users_equals_bucket_of_events(spark, actions001):
    from feedlens.plans import params as P
    users = ex.user_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS)
    for hashing in ("xxh64", "xxh64_32"):
        a = ex.bucket_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS, 20, hashing=hashing)
        b = ex.bucket_ctr_of_users(users, P.AB_GROUPS, 20, hashing=hashing)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    with pytest.raises(ValueError):
        ex.bucket_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS, hashing="md5")


@pytest.mark.parametrize("case", ["normal", "skewed", "ties", "few", "constant", "one"])
def test_bins_are_those_of_numpy(spark, case):
    rng = np.random.default_rng(11)
    x = {"normal": rng.normal(0, 1, 700), "skewed": rng.exponential(1, 333), "ties": np.repeat([0.0, 1.0], [900, 30]),
         "few": np.array([0.5, 2.0, 2.5]), "constant": np.full(9, 4.25), "one": np.array([3.0])}[case]
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(x)] + [(None, 0)], "x double, g int")
    # the larger count of the two rules; without a distance between the quartiles Sturges alone
    rules = ["sturges"] + ["fd"] * bool(np.subtract(*np.percentile(x, [75, 25])) > 0)
    edges = max((np.histogram_bin_edges(x, bins=r) for r in rules), key=len)
    row = ex.auto_bins(df, "x").first()
    assert (row.n, row.lo, row.hi) == (len(x), x.min(), x.max())
    assert (row.q1, row.q3) == pytest.approx(tuple(np.percentile(x, [25, 75])))
    assert row.bins == len(edges) - 1
    got = ex.histogram(df, "x", "g", bins="auto").collect()
    assert sum(r.n for r in got) == len(x)
    if case not in ("constant", "one"):
        counts, _ = np.histogram(x, bins=edges)
        summed = np.zeros(len(counts), int)
        for r in got:
            summed[r.bin] += r.n
        assert (summed == counts).all()


def test_bins_without_values(spark):
    df = spark.createDataFrame([(None, 1)], "x double, g int")
    assert tuple(ex.auto_bins(df, "x").first()) == (0, None, None, None, None, 1)
    assert ex.histogram(df, "x", "g", bins="auto").count() == 0
    with pytest.raises(ValueError):
        ex.histogram(df, "x", bins="auto", by=("g",))


def test_quartiles_do_not_need_one_task(spark):
    plan = ex.auto_bins(spark.range(1000).select(F.col("id").cast("double").alias("x")), "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower()
