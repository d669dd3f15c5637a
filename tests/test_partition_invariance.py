import math

import pytest

from feedlens.plans import catalog, oracle

SF = "/root/testdata/sf0.01"


def _norm(rows):
    def one(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6) + 0.0
        return v
    return sorted((tuple(one(x) for x in r) for r in rows), key=lambda r: tuple(map(str, r)))


@pytest.fixture(scope="module")
def results_by_partitions(spark):
    keys = sorted(oracle.oracle_sql())
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    out = {}
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            qs = catalog.queries()
            out[n] = {k: _norm(qs[k](spark, SF).collect()) for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    return out


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_same_result_for_1_and_13_partitions(results_by_partitions, key):
    assert results_by_partitions["1"][key] == results_by_partitions["13"][key]


ROWS_ONLY = sorted(set(catalog.queries()) - set(oracle.oracle_sql()))


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_keys_are_partition_invariant(spark, key):
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(_norm(catalog.queries()[key](spark, SF).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert out[0] == out[1]
