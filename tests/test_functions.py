import datetime as dt

import pytest
from pyspark.sql import functions as F

from lectern import schemas as S
from lectern.functions import nested, scalars, text
from lectern.functions.structured import parse_structured
from lectern.functions.timestamps import parse_iso_timestamp

UTC_NOON = dt.datetime(2024, 7, 1, 12, 34, 56)


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_timestamps(spark, zone):
    accepted = {
        "2024-07-01 12:34:56.789+00": "2024-07-01 12:34:56.789000",
        "2024-07-01T12:34:56Z": "2024-07-01 12:34:56.000000",
        "2024-07-01T12:34:56+00:00": "2024-07-01 12:34:56.000000",
        "2024-07-01 12:34:56.123456+00": "2024-07-01 12:34:56.123456",
        "2024-07-01T12:34:56+0000": "2024-07-01 12:34:56.000000",
        "2024-07-01T12:34:56+02:30": "2024-07-01 10:04:56.000000",
        "2024-07-01T12:34:56": "2024-07-01 12:34:56.000000",
        "2024-07-01T12:34": "2024-07-01 12:34:00.000000",
        "2024-07-01 12:34+01": "2024-07-01 11:34:00.000000",
        "2024-07-01": "2024-07-01 00:00:00.000000",
        "20240701T120000": "2024-07-01 12:00:00.000000",
        "20240701T1234+0130": "2024-07-01 11:04:00.000000",
        "2024-W27-1": "2024-07-01 00:00:00.000000",
        "2020W537T23": "2021-01-03 23:00:00.000000",
        "2024-07-01T12": "2024-07-01 12:00:00.000000",
        "2024-07-01_12:34:56,5": "2024-07-01 12:34:56.500000",
        "2024-07-01T12:34:56.123456789Z": "2024-07-01 12:34:56.123456",
        "2024-07-01T12:34:56+01:02:03": "2024-07-01 11:32:53.000000",
    }
    refused = [
        "2024", "2024-07", "12:30", "garbage", "", None, "2023-W53-1", "2024-W27-8", "2024-W00-1",
        "2024-13-01", "2024-02-30", "2024-07-01T25:00:00", " 2024-07-01",
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = F.unix_micros(parse_iso_timestamp("x"))
        got = values(spark, [(x,) for x in [*accepted, *refused]], "x string", micros)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    wanted = [
        round(dt.datetime.fromisoformat(v + "+00:00").timestamp() * 1_000_000)
        for v in accepted.values()
    ]
    assert got == wanted + [None] * len(refused)


def test_length_counts_characters(spark):
    assert values(spark, [("é😀x",)], "x string", F.length("x")) == [3]
    assert values(spark, [("é😀x",), (None,)], "x string", scalars.longer_than("x", 2)) == [True, None]


def test_only_numeric_nulls_are_filled(spark):
    schema = "i int, s string, d double, t timestamp"
    df = scalars.fill_numeric_nulls(spark.createDataFrame([(None,) * 4], schema))
    assert tuple(df.first()) == (0, None, 0.0, None)


def test_defaults(spark):
    rows = [("x",), ("",), (None,)]
    assert values(spark, rows, "v string", scalars.default_when_empty("v", "d")) == ["x", "d", "d"]
    df = spark.createDataFrame(rows, "v string")
    here = [r[0] for r in df.select(scalars.default_when_absent(df, "v", "d")).collect()]
    gone = [r[0] for r in df.select(scalars.default_when_absent(df, "w", "d")).collect()]
    assert here == ["x", "", None] and gone == ["d", "d", "d"]


def test_ids(spark):
    layout = r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    df = spark.createDataFrame([("k",)], "k string").select(
        scalars.prefixed_id("k", "exam").alias("a"), scalars.prefixed_id("k").alias("b"),
        scalars.random_id("exam").alias("c"), scalars.random_id().alias("d"),
    )
    for column, prefix in [("a", "exam-"), ("b", ""), ("c", "exam-"), ("d", "")]:
        assert df.where(F.col(column).rlike(f"^{prefix}{layout}$")).count() == 1
    assert df.first().a == df.first().a


def test_paths(spark):
    rows = [("a/b/c",), ("a/b/c//",), ("c",), ("/",)]
    assert values(spark, rows, "p string", scalars.path_basename("p")) == ["c", "c", "c", ""]
    joined = scalars.path_join("out/", F.col("p"), "topics.json")
    assert values(spark, [("repo",)], "p string", joined) == ["out/repo/topics.json"]


def test_outcome_and_status(spark):
    df = spark.createDataFrame([(0, "a", None), (101, None, "b"), (None, None, None)],
                               "exit_code int, stdout string, stderr string")
    got = [tuple(r) for r in df.select(*scalars.run_outcome("exit_code", "stdout", "stderr")).collect()]
    assert got == [(True, "a"), (False, "b"), (None, "")]
    assert values(spark, [("boom",), (None,)], "e string", scalars.generation_status("e")) == [
        "failed: boom", "generated"]


def test_vectorised_function_skips_nulls(spark):
    upper = scalars.vectorised(lambda v: v.upper(), "string")
    assert values(spark, [("a",), (None,), ("b",)], "x string", upper("x")) == ["A", None, "B"]


def test_prompt(spark):
    df = spark.createDataFrame([("t", 1), (None, 2)], "title string, n int")
    prompt = text.render_prompt("Title: {title}\n{{n}} = {n}", title="title", n="n")
    assert df.where("n = 1").select(prompt).first()[0] == "Title: t\n{n} = 1"
    with pytest.raises(Exception, match="prompt field title is null"):
        df.select(prompt).collect()
    with pytest.raises(ValueError, match="not given"):
        text.render_prompt("{a}")
    with pytest.raises(ValueError, match="without a place"):
        text.render_prompt("a", b="n")
    with pytest.raises(ValueError, match="plain named"):
        text.render_prompt("{a!r}", a="n")


def test_problem_markdown(spark):
    page = text.problem_markdown("a", "b", "c", "d")
    got = values(spark, [("N", "S\nS2", "c()", "t()")], "a string, b string, c string, d string", page)
    assert got == ["## N\n### Problem Statement\nS\nS2\n### Canonical Solution\n```python\nc()\n```\n"
                   "### Test Code\n```python\nt()\n```\n"]


def test_training_layouts(spark):
    rows, schema = [("Q", "R", "A")], "question string, reasoning string, answer string"
    assert values(spark, rows, schema, text.thinking_completion("reasoning", "answer")) == [
        "<think>\nR\n</think>\n\nA"]
    assert values(spark, rows, schema, text.thinking_message("reasoning", "answer")) == [
        "<think>R</think>A"]
    chat = values(spark, rows, schema, text.chat_messages("question", "reasoning", "answer", "sys"))[0]
    assert [(m.role, m.content) for m in chat] == [
        ("system", "sys"), ("user", "Q"), ("assistant", "<think>R</think>A")]


def test_items(spark):
    schema = "items array<struct<kind string, content string>>"
    rows = [([("reasoning", "r1"), ("message", "m1"), ("reasoning", "r2"), ("message", "m2")],),
            ([("message", "m")],), ([],), (None,)]
    assert values(spark, rows, schema, nested.first_content("items", "reasoning")) == ["r1", "", "", ""]
    assert values(spark, rows, schema, nested.last_content("items", "message")) == ["m2", "m", None, None]


def test_structured_parse(spark):
    cases = {
        '{"is_useful": true, "reason": "r"}': True,
        '{"is_useful": true, "reason": "r", "more": {"a": 1}}': True,
        '{"is_useful": "true", "reason": "r"}': False,
        '{"is_useful": true, "reason": 5}': False,
        '{"is_useful": true, "reason": null}': False,
        '{"is_useful": true}': False,
        '{"is_useful": tr': False,
        "[true]": False,
        "not json": False,
        "": False,
        None: False,
    }
    df = spark.createDataFrame([(c,) for c in cases], "response string")
    got = parse_structured(df, "response", S.USEFULNESS).collect()
    assert [r.valid for r in got] == list(cases.values())
    assert [r.parsed is not None for r in got] == list(cases.values())
    assert got[0].parsed.is_useful is True and got[0].parsed.reason == "r"


def test_structured_parse_of_lists(spark):
    cases = {
        '{"tasks": [{"question": "q", "answer": "a"}, {"question": "q2", "answer": "a2", "x": 1}]}': 2,
        '{"tasks": []}': 0,
        '{"tasks": [{"question": "q"}]}': None,
        '{"tasks": [{"question": "q", "answer": 1}]}': None,
        '{"tasks": [null]}': None,
        '{"tasks": "q"}': None,
        '{"tasks": null}': None,
        "{}": None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "response string")
    got = parse_structured(df, "response", S.QA_LIST).collect()
    assert [len(r.parsed.tasks) if r.valid else None for r in got] == list(cases.values())


def test_optional_field_may_be_null(spark):
    df = spark.createDataFrame([('{"reasoning": null}',), ("{}",), ('{"reasoning": "x"}',),
                                ('{"reasoning": 1}',)], "response string")
    got = parse_structured(df, "response", S.REASONING).collect()
    assert [(r.valid, r.parsed and r.parsed.reasoning) for r in got] == [
        (True, None), (True, None), (True, "x"), (False, None)]


def test_nested_records(spark):
    good = ('{"qra": {"question": "q", "answer": "a", "reasoning": "r"}, "agent_reasoning": "",'
            ' "agent_answer": "x", "is_correct": false}')
    bad = good.replace('"r"', "7")
    df = spark.createDataFrame([(good,), (bad,)], "response string")
    got = parse_structured(df, "response", S.SOLVE_RESULT).collect()
    assert [r.valid for r in got] == [True, False]
    assert got[0].parsed.qra.reasoning == "r"
