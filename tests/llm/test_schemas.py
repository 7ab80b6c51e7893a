"""op2: every deciding word of a schema is applied or makes it one that can't be."""

from __future__ import annotations

import json

import pytest

from wickwork.llm import chat_format as chat


def verdict(schema: object, value: object) -> str:
    return chat.checked(json.dumps(value), json.dumps(schema))[1] or "ok"


@pytest.mark.parametrize(
    ("schema", "good", "bad"),
    [
        ({"const": {"a": 1}}, {"a": 1.0}, {"a": 2}), ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, 4, 2), ({"allOf": [{"minimum": 1}, {"maximum": 2}]}, 1.5, 3), ({"oneOf": [{"minimum": 1}, {"minimum": 3}]}, 2, 4), ({"not": {"type": "null"}}, 0, None),
        ({"minItems": 1, "maxItems": 2}, [1], [1, 2, 3]), ({"uniqueItems": True}, [1, "1", True], [1, 1.0]), ({"exclusiveMinimum": 3}, 3.5, 3), ({"exclusiveMaximum": 3}, 2, 3), ({"multipleOf": 0.1}, 0.3, 0.35), ({"multipleOf": 7}, 10**30 * 7, 8),
        ({"minProperties": 1, "maxProperties": 1}, {"a": 1}, {}), ({"properties": {"x": {"items": {"not": {"const": 2}}}}}, {"x": [1, 3]}, {"x": [2]}), ({"enum": [10**16]}, 1e16, 10**16 + 1), ({"minLength": 2}, "ab", "a"),
        ({"title": "t", "description": "d", "default": 1, "format": "email", "examples": [], "my-own": {}, "type": "integer"}, 2.0, 2.5),
    ],
)
def test_words_are_applied(schema, good, bad):
    assert verdict(schema, good) == "ok" and verdict(schema, bad) == "invalid"


@pytest.mark.parametrize("word", sorted(chat.LACKING))
def test_words_that_are_not_applied_are_never_ok(word):
    for schema in ({word: {}}, {"properties": {"a": {word: "x"}}}, {"items": {word: 1}}, {"anyOf": [True, {word: True}]}, {"not": {word: []}}, {"additionalProperties": {word: {}}}):
        assert verdict(schema, {"a": 1}) == "bad_schema"


@pytest.mark.parametrize("schema", [{"anyOf": []}, {"oneOf": {}}, {"allOf": [1]}, {"not": 1}, {"minItems": -1}, {"maxItems": "2"}, {"multipleOf": 0}, {"uniqueItems": 1}, {"exclusiveMinimum": True}, [], 1, None])
def test_broken_schemas(schema):
    assert verdict(schema, {}) == "bad_schema"


def test_a_property_may_have_any_name():
    assert verdict({"properties": {"pattern": {"type": "string"}}, "required": ["pattern"]}, {"pattern": "x"}) == "ok"


def test_numbers_are_equal_as_json():
    for a, b in (("1e16", "10000000000000000"), ("1e300", "1" + "0" * 300), ("100e-2", "1"), ("9007199254740993.0", "9007199254740993"), ("-0.0", "0")):
        assert chat.canonical(chat.parsed(a)) == chat.canonical(chat.parsed(b)) == b
    assert chat.canonical(chat.parsed("0.1")) == "0.1" and chat.canonical(chat.parsed("9007199254740993.5")) != "9007199254740993"
    for refused in ("1e999", "NaN", "-Infinity"):
        with pytest.raises(ValueError):
            chat.canonical(chat.parsed(refused))
