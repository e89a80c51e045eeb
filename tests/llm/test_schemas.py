"""JSON schemas of tool arguments."""

from __future__ import annotations

import json

import pytest

from larder.llm import chat
from larder.llm.schemas import distinct, fits, judged, same

POINT = {"type": "object", "properties": {"x": {"type": "number"}}, "required": ["x"], "additionalProperties": {"type": "string"}}


@pytest.mark.parametrize(
    "schema, yes, no",
    [
        ({"type": "integer"}, [1, 1.0, -0.0], [1.5, True, "1", None]),
        ({"type": ["number", "null"]}, [1, 2.5, None], [False, "x", []]),
        ({"type": "odd"}, [], [1, None, {}]),
        ({"enum": [1, "a", [True]]}, [1, 1.0, "a", [True]], [True, [1], "b"]),
        ({"const": {"a": 1}}, [{"a": 1.0}], [{"a": True}, {}, {"a": 1, "b": 2}]),
        ({"minimum": 2, "exclusiveMaximum": 5}, [2, 4.9, "text"], [1.9, 5]),
        ({"minimum": 2, "exclusiveMinimum": True}, [2.1], [2]),
        ({"multipleOf": 0.1}, [0.3, 7, -2.2], [0.25]),
        ({"minLength": 2, "maxLength": 3}, ["ab", "éàü", 1], ["a", "abcd"]),
        ({"pattern": "^a+$"}, ["aa", 5], ["ab", ""]),
        ({"items": {"type": "string"}, "minItems": 1}, [["a"], {}], [[], ["a", 1]]),
        ({"prefixItems": [{"const": 1}], "items": False}, [[1], []], [[2], [1, 2]]),
        ({"items": [{"const": 1}], "additionalItems": {"type": "null"}}, [[1, None]], [[1, 2]]),
        ({"uniqueItems": True}, [[1, True, "1", [1], [True]], []], [[1, 1.0], [{"a": [1]}, {"a": [1]}]]),
        ({"contains": {"const": 3}, "maxContains": 1}, [[3, 4]], [[], [4], [3, 3]]),
        (POINT, [{"x": 1}, {"x": 1, "y": "s"}], [{}, {"x": "1"}, {"x": 1, "y": 2}]),
        ({"patternProperties": {"^n_": {"type": "integer"}}, "additionalProperties": False}, [{"n_a": 1}], [{"n_a": "1"}, {"a": 1}]),
        ({"propertyNames": {"maxLength": 1}, "maxProperties": 1}, [{"a": 0}], [{"ab": 0}, {"a": 0, "b": 0}]),
        ({"dependentRequired": {"a": ["b"]}}, [{"b": 1}, {"a": 1, "b": 1}], [{"a": 1}]),
        ({"anyOf": [{"type": "string"}, {"minimum": 3}], "type": ["string", "number"]}, ["a", 3], [2, None]),
        ({"oneOf": [{"multipleOf": 2}, {"multipleOf": 3}]}, [2, 9], [6, 5]),
        ({"allOf": [{"minimum": 1}, {"maximum": 2}], "not": {"const": 2}}, [1, 1.5], [2, 0, 3]),
        ({"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"type": "null"}}, ["ab", None], ["a", 1]),
        ({"properties": {"a": False}}, [{}, {"b": 1}], [{"a": 1}]),
        ({"format": "email", "title": "t"}, ["nothing of the kind", 1], []),
    ],
)
def test_schemas_say_yes_and_no(schema, yes, no):
    assert [fits(value, schema) for value in yes] == [True] * len(yes)
    assert [fits(value, schema) for value in no] == [False] * len(no)


def test_unknown_keywords_decide_only_where_the_rest_does_not():
    odd = {"$ref": "#/other", "type": "integer"}
    assert fits(1, odd) is None and fits("1", odd) is False
    assert fits(1, {"anyOf": [odd, {"const": 1}]}) is True and fits(2, {"anyOf": [odd, {"const": 1}]}) is None
    assert fits(1, {"not": odd}) is None and fits("1", {"not": odd}) is True
    assert fits("a", {"pattern": r"\p{L}"}) is None
    assert fits({"a": 1}, {"properties": {"a": odd}}) is None and fits({}, {"properties": {"a": odd}}) is True


def test_what_is_no_schema_fits_nothing():
    deep = {"type": "array"}
    for _ in range(5_000):
        deep = {"items": deep}
    value: list = []
    for _ in range(5_000):
        value = [value]
    for schema in (3, "x", None, [], {"minimum": "3"}, {"properties": 7}, {"multipleOf": 0}, {"allOf": 1}):
        assert judged(1, schema) is False or judged({"a": 1}, schema) is False
    assert judged(value, deep) is False


def test_equal_as_json():
    assert same(1, 1.0) and not same(True, 1) and not same([0], [False]) and same({"a": None}, {"a": None})
    assert distinct([0, False, None, "", [], {}]) and not distinct([[1], [1.0]])


def test_calls_that_cannot_be_checked(spark):
    schemas = {
        "f": {"properties": {"x": {"type": "integer", "maximum": 9}}},
        "g": {"properties": {"x": {"$ref": "#/y"}}},
    }
    tools = [{"name": name, "parameters": schema} for name, schema in schemas.items()]
    bodies = [("f", {"x": 9.0}), ("f", {"x": 10}), ("g", {"x": 1}), ("g", {})]
    calls = "".join(f'<tool_call>{json.dumps({"id": i, "name": name, "arguments": body})}</tool_call>' for i, (name, body) in enumerate(bodies))
    rows = [(1, 0, "system", f"<tools>{json.dumps(tools)}</tools>"), (1, 1, "assistant", calls)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for found in (chat.format_chats(turns), chat.format_chats(turns.where("turn = 1"), schemas)):
        row = found.where("turn = 1").first()
        assert [call["valid"] for call in json.loads(row["message"])["tool_calls"]] == [True, False, None, True]
        assert (row["n_calls"], row["n_invalid"]) == (4, 1)
