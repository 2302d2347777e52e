"""Tool calls against SQL and small cases."""

import collections
import json
import random

import duckdb
import pytest

from millrace.llm import chat, entry

from .conftest import SF

SCHEMAS = {"find": {"q": ("string", True), "n": ("integer", True), "f": ("number", False), "o'k": ("object", False), "l": ("array", False), "b": ("boolean", False)}}


def test_rows_of_the_table_are_those_of_the_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    want = con.sql(entry.SQL["op7_tool_call_linking"])
    got = entry.op7_tool_call_linking(spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(want.columns).collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter(want.fetchall())
    assert {"answered", "unanswered", "orphan"} & {r.status for r in rows} and max(r.level or 0 for r in rows) > 0
    for r in rows:
        assert json.loads(r.message)["id"] == r.call_id
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    "arguments, errors",
    [
        ('{"q":"x","n":1}', ""),
        ('{"n":1.5,"q":"x","f":2.5,"o\'k":{"b":1,"a":[]},"l":[1],"b":false}', "type of n"),
        ('{"n":1,"q":"x","f":3,"o\'k":{},"l":[],"b":true}', ""),
        ('{"n":null,"q":5}', "type of n; type of q"),
        ('{"zz":1,"b":"no","aa":2}', "type of b; missing n; missing q; unknown aa; unknown zz"),
        ("[1]", "arguments are no object"),
        ("{", "arguments are no object"),
        ("", "arguments are no object"),
        (None, "arguments are no object"),
    ],
)
def test_arguments_are_checked(spark, arguments, errors):
    calls = spark.createDataFrame([("c", "find", arguments, None)], "call_id string, name string, arguments string, depends_on string")
    results = spark.createDataFrame([], "call_id string, content string")
    assert chat.link(calls, results, SCHEMAS).first().errors == errors


def test_links_of_odd_rows(spark):
    text = 'a "b"\n\\ é'
    calls = [("1", "find", '{ "q":"é\\n", "n" : 2 }', None, 9), ("2", "find", '{"q":"b","n":2}', "1", 9), ("2", "find", '{"q":"a","n":2}', "1", 9), ("3", "other", "{}", "nowhere", 9)]
    calls += [("x", None, "{}", "y", 9), ("y", "find", "no json", "x", 9), ("z", "find", "{}", "y", 9), (None, "find", "{}", None, 9), (None, "find", "{}", None, 9)]
    results = [("1", text, 9), ("2", "r2", 9), ("2", "r1", 9), ("lost", None, 9), (None, "stray", 9)]
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    calls = frame(calls, "call_id string, name string, arguments string, depends_on string, level int")
    results = frame(results, "call_id string, content string, message int")
    got = collections.defaultdict(list)
    for r in chat.link(calls, results, SCHEMAS).collect():
        got[r.call_id].append(r)
    assert got["1"][0].message == '{"arguments":{"n":2,"q":"é\\n"},"id":"1","level":0,"name":"find","result":' + json.dumps(text, ensure_ascii=False) + "}"
    two = got["2"][0]
    assert (two.level, two.n_calls, two.n_results, two.status) == (1, 2, 2, "answered") and '"q":"a"' in two.message and '"r1"' in two.message
    assert (got["3"][0].level, got["3"][0].status, got["3"][0].errors) == (0, "unanswered", "unknown tool")
    assert [got[k][0].level for k in "xyz"] == [None, None, None]
    assert got["y"][0].message == '{"arguments_text":"no json","id":"y","name":"find"}'
    assert (got["lost"][0].status, got["lost"][0].n_calls) == ("orphan", 0)
    assert sorted((r.status, r.n_calls, r.n_results) for r in got[None]) == [("no id", 0, 1), ("no id", 1, 0), ("no id", 1, 0)]
    assert chat.link(calls.limit(0), results.limit(0), SCHEMAS).collect() == []


def test_levels_of_long_chains(spark):
    rng = random.Random(6)
    above = {i: rng.choice([None, i - 1, rng.randint(0, i - 1)]) if i else None for i in range(300)} | {i: i - 1 for i in range(300, 420)}
    want = {}
    for i, a in above.items():
        want[i] = 0 if a is None else want[a] + 1
    calls = spark.createDataFrame([(str(i), None if a is None else str(a)) for i, a in above.items()], "call_id string, depends_on string")
    assert {int(r.call_id): r.level for r in chat.levels(calls).collect()} == want
