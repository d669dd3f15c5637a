"""Chat formatting: reversible for any text, native plan, attachments in order, rows equal to SQL."""

import hashlib
import random

import duckdb
import pytest
from cases import SF001
from pyspark.sql import functions as F

from feedlens.llm import chat, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    """{conv_id: (n_turns, turns digest, loss_chars, loss digest)} from the rows themselves."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        learned = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                  hashlib.sha256(learned.encode()).hexdigest())
    return out


def digests(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_query_matches_rows_and_sql(spark):
    got = queries.op13_chat_format(spark, SF001)
    table = spark.read.parquet(f"{SF001}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", chat.CONTROL_TEXT), (-7, 1, "assistant", chat.CONTROL_TEXT)]
    assert digests(got) == expected(rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    sql = {r[0]: r[1:] for r in con.sql(queries.ORACLE_SQL["op13_chat_format"]).fetchall()}
    assert sql == {r.conv_id: tuple(r)[1:] for r in got.collect()}


def test_plan_is_native(spark):
    plan = queries.op13_chat_format(spark, SF001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Scan ExistingRDD" not in plan


def test_any_text_comes_back(spark):
    rnd = random.Random(3)
    bits = [*chat.Template().controls, "\\", "\\\\", "[", "]", "<", ">", "/", "s>", "[INST", "INST]", "<<", "\n", "é", "😀",
            "$1", " ", "", "<\\s>", "[\\INST]", "$"]
    rows = []
    for c in range(60):
        for t in range(rnd.randrange(1, 7)):
            role = rnd.choice(["user", "assistant", "system", "tool", "", "[/ROLE]", "a\\b\n", None])
            rows.append((c, t, role, "".join(rnd.choices(bits, k=rnd.randrange(9)))))
    rows += [(99, 0, "user", None), (99, 1, "assistant", "x" * 400_000 + "</s>" * 1000), (None, None, None, None),
             (None, 3, "assistant", "of no conversation"), (98, 0, "assistant", "   ")]
    table = spark.createDataFrame(rows, SCHEMA)
    formatted = chat.format_conversations(table)
    assert digests(chat.chat_digests(formatted)) == expected(rows)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(formatted).collect()}
    ordered = sorted(((c, t, r, x) for c, t, r, x in rows if c is not None), key=lambda r: r[:2])
    assert back[5] == [(r or "", x) for c, t, r, x in ordered if c == 5]


def test_ties_repeats_clashing_columns_and_empty_table(spark):
    rows = [(1, 0, "user", "b", 1, "x"), (1, 0, "user", "a", 2, "y"), (1, 0, "user", "a", 2, "y"), (1, None, "system", "s", 3, "z"),
            (1, 1, "assistant", "c", 4, "w")]
    table = spark.createDataFrame(rows, SCHEMA + ", formatted bigint, markup string").withColumns(
        {"spans": F.lit(1), "no": F.lit("q"), "at": F.lit("p"), "n_tokens": F.lit("n")})
    out = chat.format_conversations(table).first()
    assert out.formatted == "<<SYS>>s<</SYS>>[INST]a[/INST][INST]a[/INST][INST]b[/INST]<s>c</s>"
    assert [out.formatted[s.loss_start:s.loss_start + s.loss_length] for s in out.spans if s.loss_start is not None] == ["c"]
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_parts_become_ordered_placeholders(spark):
    parts = ("array(named_struct('type','text','text','see <image> and','ref',null,'width',null,'height',null,'seconds',null,'pages',null),"
             "named_struct('type','image','text',null,'ref','a.png','width',57L,'height',28L,'seconds',null,'pages',null),"
             "named_struct('type','audio','text',null,'ref','b.wav','width',null,'height',null,'seconds',2.5D,'pages',null),"
             "named_struct('type','document','text',null,'ref','c.pdf','width',null,'height',null,'seconds',null,'pages',3L),"
             "named_struct('type','image','text',null,'ref',null,'width',null,'height',null,'seconds',null,'pages',null),"
             "named_struct('type',null,'text','end.','ref',null,'width',null,'height',null,'seconds',null,'pages',null))")
    cast = f"cast({parts} as array<{chat.PART}>)"
    table = spark.sql(f"SELECT 1L AS conv_id, 4L AS turn, 'user' AS role, {cast} AS parts UNION ALL "
                      "SELECT 1L, 5L, 'assistant', null UNION ALL SELECT 1L, 1L, 'system', "
                      f"slice({cast}, 3, 1)")
    out = chat.format_conversations(table, parts=F.col("parts")).first()
    assert out.formatted == ("<<SYS>><audio><</SYS>>[INST]see <\\image> and<image><audio><document><image>end.[/INST]<s></s>")
    assert [tuple(a) for a in out.attachments] == [
        (0, 0, "audio", "b.wav", 63), (1, 1, "image", "a.png", 3), (1, 2, "audio", "b.wav", 63),
        (1, 3, "document", "c.pdf", 1728), (1, 4, "image", None, 1)]
    assert out.n_tokens == 63 + 5 + 3 + 63 + 1728 + 1 + 2
    assert [tuple(s)[2:] for s in out.spans] == [(None, None), (None, None), (len(out.formatted) - 4, 0)]


@pytest.mark.parametrize("bad", [{"role_open": ""}, {"role_open": "a\\b"}, {"role_open": "<s>x", "role_close": "x<"},
                                 {"turns": {"user": ("aba", "ba")}}])
def test_ambiguous_templates_are_refused(bad):
    with pytest.raises(ValueError):
        chat.Template(**bad)
