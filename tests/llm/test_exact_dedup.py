import random
import time

import duckdb
import pyarrow as pa

from cases import LONG, SF001, documents, edge_table, empty_table
from feedlens.llm import exact_dedup, queries


def _keep(old, new):
    return min(old, new)


def test_trie_holds_what_a_dict_holds():
    rng = random.Random(4)
    keys = [bytes(rng.choices(b"ab", k=rng.randint(0, 12))) for _ in range(3000)]
    trie, want = exact_dedup.RadixTrie(), {}
    for n, k in enumerate(keys):
        assert trie.insert(k, n, _keep) == want.setdefault(k, n)
    assert dict(trie.items(_keep)) == want


def test_trie_spills_by_subtree_and_loses_nothing():
    rng = random.Random(5)
    keys = [b"common start " + bytes(rng.choices(b"abcdef", k=rng.randint(0, 9))) for _ in range(4000)] + [b"", b"c", b"zz"]
    trie, want = exact_dedup.RadixTrie(20_000), {}
    for n, k in enumerate(keys):
        trie.insert(k, (n, 1), lambda a, b: (min(a[0], b[0]), a[1] + b[1]))
        first, count = want.get(k, (n, 0))
        want[k] = (first, count + 1)
    assert trie.spilled and trie.bytes <= 20_000 + 300
    found = list(trie.items(lambda a, b: (min(a[0], b[0]), a[1] + b[1])))
    assert len(found) == len(want) and dict(found) == want


def _brute(rows):
    groups = {}
    for n, (doc_id, text) in enumerate(rows):
        body = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(body, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return groups


def test_defined_cases(spark):
    rows = [(r.doc_id, r.text) for r in edge_table(spark).collect()]
    groups = _brute(rows)
    got = exact_dedup.exact_dedup(edge_table(spark)).collect()
    assert len(got) == len(rows)
    assert sum(r.kept for r in got) == len(groups)
    by_sha = {}
    for r in got:
        by_sha.setdefault(r.text_sha256, []).append(r)
    assert sorted((len(v), {r.group_size for r in v} == {len(v)}, {r.keep_id for r in v} == {v[0].keep_id})
                  for v in by_sha.values()) == sorted((len(v), True, True) for v in groups.values())
    want = {doc_id: min(members)[3] for members in groups.values() for *_, doc_id in members if doc_id is not None}
    assert all(r.keep_id == want[r.doc_id] for r in got if r.doc_id is not None)
    assert sum(r.kept for r in got if r.doc_id == 9) == 0  # the longer text 5 stays
    assert exact_dedup.exact_dedup(empty_table(spark)).count() == 0


def test_small_tries_give_the_same(spark):
    rows = [(i, f"text {i % 50} " + "z" * (i % 7)) for i in range(400)] + [(900, LONG), (901, LONG)]
    whole = exact_dedup.exact_dedup(documents(spark, rows)).drop("text_hash")
    small = exact_dedup.exact_dedup(documents(spark, rows).repartition(5), trie_bytes=2000).drop("text_hash")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, small.collect()))


def test_kept_rows(spark):
    table = edge_table(spark)
    kept = exact_dedup.keep_distinct(table)
    assert kept.columns == table.columns
    texts = [r.text for r in kept.collect()]
    assert len(texts) == len(_brute([(r.doc_id, r.text) for r in table.collect()]))
    assert "The cat  sat on\nthe mat." in texts and "The cat sat on the mat." not in texts
    # a row that repeats the row that stays goes as well, whatever its white space
    twice = documents(spark, [(1, "a b"), (1, "ab"), (1, "a b"), (2, "ab")])
    assert [tuple(r) for r in exact_dedup.keep_distinct(twice).collect()] == [(1, "a b")]
    # equal ids with different texts are different documents
    shared = documents(spark, [(1, "ab"), (5, "a b c"), (5, "ab")])
    assert sorted(tuple(r) for r in exact_dedup.keep_distinct(shared).collect()) == [(1, "ab"), (5, "a b c")]


def test_query_matches_duckdb(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    rel = con.sql(queries.ORACLE_SQL["op2_exact_dedup"])
    got = queries.QUERIES["op2_exact_dedup"](spark, SF001).select(*rel.columns)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())


def test_hot_texts_are_merged_in_two_steps(spark):
    """Texts that every task sends on, with other rows between them: the same rows, and no owner meets all copies."""
    rows = [(i, "hot text" if i % 3 == 0 else "warm " + "w" * (i % 2) if i % 3 == 1 else f"own {i}") for i in range(3000)]
    whole = exact_dedup.exact_dedup(documents(spark, rows).repartition(60), hot_copies=1_000_000).drop("text_hash")
    split = exact_dedup.exact_dedup(documents(spark, rows).repartition(60), hot_copies=9).drop("text_hash")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))
    assert {r.group_size for r in split.where("text_sha256 = sha2('hottext', 256)").collect()} == {1000}


def test_many_group_numbers_of_one_text_in_time():
    began = time.perf_counter()
    rows = [(n, n, n, 4, 1, b"same") for n in range(200_000)]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 5 + (pa.binary(),))]
    batch = pa.RecordBatch.from_arrays(columns, names=["group_no", "row_no", "doc_id", "n_chars", "n_rows", "body"])
    got = pa.Table.from_batches(list(exact_dedup._own(1 << 20)(iter([batch]))))
    assert got.num_rows == 200_000 and set(got["group_size"].to_pylist()) == {200_000} and set(got["keep_id"].to_pylist()) == {0}
    assert time.perf_counter() - began < 15
