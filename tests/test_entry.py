import math

import duckdb
import pytest

import __spark_entry__ as E
from feedlens.plans import catalog, oracle

SF = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["day", "dau", "views", "likes", "ctr"]


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows):
    def one(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6) + 0.0
        return v
    return sorted((tuple(one(x) for x in r) for r in rows), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_matches_duckdb(spark, duck, key):
    df = E.queries()[key](spark, SF)
    res = duck.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    got = [tuple(r[c] for c in order) for r in df.collect()]
    exp = [tuple(r[cols.index(c)] for c in order) for r in res.fetchall()]
    assert _norm(got) == _norm(exp)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_column_types_match_duckdb(spark, duck, key):
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in E.queries()[key](spark, SF).schema.fields}
    rel = duck.sql(E.oracle_sql()[key])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types


def test_only_the_approximate_count_has_no_statement():
    assert set(catalog.queries()) - set(oracle.oracle_sql()) == {"weekly_audience_approx"}
