"""Tool calls: odd messages, schemas, cycles."""

import json

import pytest

from roadpulse.llm import chat_tools

SEARCH = {"query": "q", "turn": 1}


def _call(call_id, name="search", arguments=None, after=()):
    return {"id": call_id, "name": name, "arguments": SEARCH if arguments is None else arguments, "after": list(after)}


@pytest.fixture
def run(spark):
    def link(rows):
        full = [(*r, "x", 1, "y") for r in rows]
        schema = "conv_id long, turn long, role string, text string, name string, level int, json string"
        return chat_tools.linked(spark.createDataFrame(full, schema)).collect()

    return link


def _assistant(conv, turn, *calls):
    return (conv, turn, "assistant", json.dumps({"tool_calls": list(calls)}))


def _tool(conv, turn, call_id, content):
    return (conv, turn, "tool", json.dumps({"tool_call_id": call_id, "content": content}))


def test_links_orders_and_serialises(run):
    out = run([
        _assistant(1, 1, _call("b", after=["a"]), _call("a")), _tool(1, 2, "a", "é\n\"x\""), _tool(1, 3, "a", "later"),
        _assistant(1, 4, _call("c", after=["b", "zz"])), _tool(1, 5, "nobody", "lost"), _tool(2, 1, "a", "other"),
        _assistant(1, 6, _call("d"), _call("d")),
    ])
    rows = {(r.conv_id, r.call_id, r.place): r for r in out}
    one = sorted((r for r in out if r.conv_id == 1), key=lambda r: r.place)
    assert [r.call_id for r in one] == ["a", "d", "d", "b", "c", "nobody"]
    assert [r.level for r in one] == [0, 0, 0, 1, 2, None]
    assert [r.status for r in one] == ["linked", "duplicate", "duplicate", "unanswered", "unanswered", "orphan"]
    assert one[0].n_results == 2 and one[4].errors == ["unknown_call:zz"]
    assert one[0].json == '{"arguments":{"query":"q","turn":1},"id":"a","name":"search","result":"é\\n\\"x\\""}'
    assert rows[(2, "a", 0)].status == "orphan"


def test_cycles_have_no_level(run):
    out = run([_assistant(1, 1, _call("a", after=["b"]), _call("b", after=["a"]), _call("c", after=["a"]), _call("d"))])
    assert {r.call_id: r.level for r in out} == {"a": None, "b": None, "c": None, "d": 0}
    assert [r.call_id for r in sorted(out, key=lambda r: r.place)][0] == "d"


@pytest.mark.parametrize("name, arguments, errors", [
    ("search", SEARCH, []),
    ("search", {"query": 5, "turn": 1.5}, ["not_integer:turn", "not_string:query"]),
    ("search", {"turn": 1, "colour": None}, ["required:query", "unknown_field:colour"]),
    ("search", "{broken", ["invalid_json"]),
    ("search", [1], ["no_object"]),
    ("sing", {}, ["unknown_tool"]),
    (None, None, ["missing", "unknown_tool"]),
])
def test_arguments_are_held_against_the_schema(run, name, arguments, errors):
    call = {"id": "a", "name": name, "arguments": arguments}
    assert [r.errors for r in run([_assistant(1, 1, call)])] == [errors]


def test_odd_messages(run):
    assert run([]) == []
    out = run([
        (1, 1, "assistant", None), (1, 2, "assistant", ""), (1, 3, "assistant", "no json"), (1, 4, "tool", "{}"),
        (None, None, "assistant", json.dumps({"tool_calls": [_call("a")]})), (1, 5, None, "x"), (1, 6, "user", "x"),
        _assistant(1, None, _call(None)), (1, 8, "assistant", '{"tool_calls": [null]}'),
    ])
    assert sorted((str(r.conv_id), str(r.call_id), r.status) for r in out) == [
        ("1", "None", "no_id"), ("None", "a", "no_id"),
    ]


def test_keys_are_sorted_at_every_depth(run):
    nested = {"turn": 1, "query": "q", "limit": {"z": 1, "a": [{"y": 1, "b": 2}]}}
    out = run([_assistant(1, 1, _call("a", arguments=nested))])
    assert '"arguments":{"limit":{"a":[{"b":2,"y":1}],"z":1},"query":"q","turn":1}' in out[0].json
