"""Linked calls against a plain walk over small hand-made graphs."""

import json
import random

from pyspark.sql import functions as F

from croploom.llm import toolcalls as T

SCHEMAS = {"sum": {"a": ("number", True), "b": ("integer", False), "tags": ("array", False)}, "noop": {}}
CALLS = "conv_id long, call_id string, parent_id string, tool string, arguments string, turn long"
RESULTS = "conv_id long, call_id string, content string, turn long"


def link(spark, calls, results):
    c = spark.createDataFrame(calls, CALLS).withColumn("depth", F.lit(9)).withColumn("content", F.lit("clash"))
    rows = T.link(c, spark.createDataFrame(results, RESULTS).withColumn("tool", F.lit(1)), SCHEMAS).collect()
    calls_only = [r for r in rows if not {"no_call", "repeated_result"} & set(r.problems)]
    return {(r.conv_id, r.call_id): r for r in calls_only}, len(calls_only)


def test_arguments(spark):
    cases = {
        '{"a": 1}': [],
        '{"b": 2, "a": 1.5, "tags": []}': [],
        '{"a": "1"}': ["type:a"],
        '{"a": true, "b": 1.5, "tags": {}}': ["type:a", "type:b", "type:tags"],
        '{"b": null}': ["missing:a"],
        '{"a": 1, "z": 2, "y": 1}': ["unknown:y", "unknown:z"],
        "[1]": ["not_an_object"],
        '{"a": 1': ["not_an_object"],
        "": ["not_an_object"],
        None: ["not_an_object"],
    }
    df = spark.createDataFrame([("sum", k) for k in cases] + [("noop", "{}"), ("noop", '{"x":1}'), ("other", "{}"), (None, "{}")], "tool string, arguments string")
    got = {(r.tool, r.arguments): r.p for r in df.withColumn("p", T.problems(SCHEMAS)).collect()}
    assert {k: got["sum", k] for k in cases} == cases
    assert got["noop", "{}"] == [] and got["noop", '{"x":1}'] == ["unknown:x"] and got["other", "{}"] == got[None, "{}"] == ["unknown_tool"]


def test_links_order_and_json(spark):
    calls = [
        (1, "b", "a", "sum", '{ "b":2, "a" : 1 }', 3), (1, "a", "late", "noop", "{}", 1), (1, "late", None, "noop", "{}", 9),
        (1, "x", "y", "noop", "{}", 2), (1, "y", "x", "noop", "{}", 2), (1, "z", "y", "noop", "{}", 0), (1, "lost", "nowhere", "noop", "{}", 0),
        (2, "a", None, "noop", '{"é":"\\n"}', 0), (2, "a", None, "noop", '{"é":"\\n"}', 0), (2, "d", None, "noop", "{}", 1), (2, "d", None, "sum", "{}", 2),
        (2, None, None, "noop", "{}", 4), (None, "a", None, "noop", "{}", 4),
    ]
    results = [(1, "b", 'say "é"\n', 5), (1, "b", "second", 6), (1, "nobody", "?", 1), (2, None, "?", 1), (2, "a", None, 1), (None, "a", "?", 1)]
    got, n = link(spark, calls, results)
    assert n == len(got) == 11
    assert [k for k, r in sorted(got.items(), key=lambda x: x[1].position if x[0][0] == 1 else 99) if k[0] == 1][:4] == [(1, "lost"), (1, "late"), (1, "a"), (1, "b")]
    assert {k[1]: r.depth for k, r in got.items() if k[0] == 1} == {"late": 0, "a": 1, "b": 2, "x": None, "y": None, "z": None, "lost": 0}
    assert sorted(r.position for k, r in got.items() if k[0] == 1) == list(range(1, 8))
    rows = T.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    more = {(r.conv_id, r.call_id, r.position): (r.problems, json.loads(r.line)["result"]) for r in rows if r.tool is None}
    assert more == {(1, "nobody", 8): (["no_call"], "?"), (1, "b", 9): (["repeated_result"], "second"), (2, None, 4): (["no_call", "no_id"], "?"), (None, "a", 2): (["no_call", "no_id"], "?")}
    assert got[1, "b"].n_results == 2 and "cycle" in got[1, "z"].problems and "no_parent" in got[1, "lost"].problems
    assert "conflict" in got[2, "d"].problems and "conflict" not in got[2, "a"].problems and "no_id" in got[2, None].problems
    assert got[1, "b"].line == json.dumps(
        {"arguments": {"a": 1, "b": 2}, "id": "b", "parent": "a", "position": 4, "result": 'say "é"\n', "tool": "sum"}, ensure_ascii=False, separators=(",", ":")
    )
    assert json.loads(got[2, "a"].line) == {"arguments": {"é": "\n"}, "id": "a", "parent": None, "position": 1, "result": None, "tool": "noop"}


def test_long_chains_and_empty_tables(spark):
    rnd = random.Random(2)
    order = list(range(300))
    rnd.shuffle(order)
    calls = [(7, f"c{i}", f"c{i - 1}" if i else None, "noop", "{}", order[i]) for i in range(300)]
    got, _ = link(spark, calls, [])
    assert all(got[7, f"c{i}"].depth == i and got[7, f"c{i}"].position == i + 1 for i in range(300))
    assert link(spark, [], [])[1] == 0


def test_no_row_is_lost(spark):
    calls = [(1, None, None, "noop", "{}", 1), (1, None, None, "noop", '{"x":1}', 2), (None, "a", None, "noop", "{}", 1), (None, "a", None, "sum", "{}", 1), (1, None, None, "noop", "{}", 1)]
    results = [(9, "q", "r", 1), (9, "q", "r", 1), (1, None, None, None)]
    rows = T.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    assert sorted(str((r.conv_id, r.call_id, r.tool, r.position)) for r in rows) == sorted(
        str(x) for x in [(1, None, "noop", 1), (1, None, "noop", 2), (1, None, None, 3), (None, "a", "noop", 1), (None, "a", "sum", 2), (9, "q", None, 1)]
    )


def test_canonical_numbers_and_keys(spark):
    from decimal import Decimal

    cases = {
        "1.0": "1", "1": "1", "10e-1": "1", "1e2": "100", "1E+2": "100", "-0": "0", "-0.0e5": "0", "0.10": "0.1", "-12.340": "-12.34", "1e-6": "0.000001",
        "1.5e-7": "1.5e-7", "1e21": "1e+21", "123456789012345678901": "123456789012345678901", "1e400": "1e+400", "-25e-400": "-2.5e-399",
        "123456789012345678901234567890123456789012345": "1.23456789012345678901234567890123456789012345e+44", "0.1000000000000000055511151231257827": "0.1000000000000000055511151231257827",
        '{"b": 1.0, "a": [1e2, "1.0", {"y": -0, "x": "a-1"}]}': '{"a":[100,"1.0",{"x":"a-1","y":0}],"b":1}',
        '"1.0"': '"1.0"', '"q\\" 1.0"': '"q\\" 1.0"', '{"k":1,"k":2}': None, "01": None, "{": None, "": None, "1 2": None, "true": "true", "null": "null", '"\ue0001\ue000"': '"\ue0001\ue000"', '"\\ue0001\\ue000"': '"\ue0001\ue000"',
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "j string")
    got = {r.j: r.c for r in df.withColumn("c", T.canonical("j")).collect()}
    assert got.pop(None) is None and got == cases
    for k, v in cases.items():
        if v and v[0] in "-0123456789":
            assert Decimal(k) == Decimal(v)
