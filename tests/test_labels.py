"""Hand-traced cases of strict JSON, extraction, repair, validation and the candidate cascade."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tessella.functions import labels, text

GOOD = '{"reasoning": "r", "identifiers": ["a"]}'
BARE = '{reasoning: "r", identifiers: ["a"],}'


def _strict(t):
    def reject(name):
        raise ValueError(name)

    try:
        json.loads(t, parse_constant=reject)
        return True
    except ValueError:
        return False


STRICT_CASES = [
    '{"a":1}', ' {"a":1}\n', '{"a":1} xx', "1", "1,2", "", "[1", "1],[2", '"abc', '{"a":1', '{"a":null}', "{'a':1}",
    '{"a":NaN}', '{"a":1,}', '{"a":1,"a":2}', "[1,2]", "1]", '"x"', "nul", "null", "true", '{"a":"x\ny"}', "01", "1.",
    "7301995218734066113", "[7301995218734066113]", "1] 7301995218734066113", "1,7301995218734066113", "-", "1e5",
    '{"a":7301995218734066113} x', '1},{"v":2', "//c\n1", '"\\u00e9"', "﻿1", "1 7301995218734066113",
]


def test_strict_json_agrees_with_a_strict_parser(column):
    got = column(labels.is_strict_json, STRICT_CASES)
    assert dict(zip(STRICT_CASES, got)) == {t: _strict(t) for t in STRICT_CASES}


def test_strict_json_of_null(column):
    assert column(labels.is_strict_json, [None]) == [False]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='{}[]",:1a \n', max_size=12), min_size=200, max_size=200))
def test_strict_json_on_random_texts(column, texts):
    assert column(labels.is_strict_json, texts) == [_strict(t) for t in texts]


def test_strip_removes_all_unicode_whitespace(column):
    odd = ["\x1c a b\xa0\n", "　x ", "", " \t ", "a", "​x"]
    assert column(text.strip, odd) == [t.strip() for t in odd]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("```swift\nlet a = 1\n```", "let a = 1"),
        ("  ```swift let a = 1", "let a = 1"),
        ("let a = 1```", "let a = 1"),
        ("```\nlet a = 1\n```", "```\nlet a = 1"),
        ("x ```swift\n```", "x ```swift"),
        ("```swift```", None),
        ("```swift", None),
        ("", None),
    ],
)
def test_fence_strip(column, raw, want):
    assert column(text.strip_fence, [raw]) == [want]


@pytest.mark.parametrize(
    "raw, want",
    [
        (f"```json\n{GOOD}\n```", GOOD),
        (f"intro\n```\n{GOOD}\n```\nend", GOOD),
        (f"```json\n{BARE}\n```", BARE),  # validates only repaired, returned as it stands
        ('```json\n{"reasoning": "x"}\n```', None),
        (f"```json\n[1]\n```\n```json\n{GOOD}\n```", GOOD),  # the first fence holding an object
        (f'```json\n{{"a": 1}}\n```\n```json\n{GOOD}\n```', None),  # and only that one
        (f"```JSON\n{GOOD}\n```", f"JSON\n{GOOD}"),  # its repaired form is a label
        ("no fence", None),
        (None, None),
    ],
)
def test_fenced_json(column, raw, want):
    assert column(labels.extract_fenced_json, [raw]) == [want]


@pytest.mark.parametrize(
    "raw, want",
    [
        (f"note\n{GOOD}\nmore", GOOD),
        ('note\n  {\n"reasoning": "r",\n"identifiers": []\n}\ntail', '{\n"reasoning": "r",\n"identifiers": []\n}'),
        (BARE, '{"reasoning": "r", "identifiers": ["a"]}'),
        ('{"a": 1}\n' + GOOD, None),  # the first balanced object decides, no rescan
        (f"Answer: {GOOD}", None),  # no line starts with a brace
        ('{"reasoning": "}", "identifiers": []}', '{"reasoning": "}", "identifiers": []}'),  # balance -1, whole text
        ('{"reasoning": "{", "identifiers": []}', '{"reasoning": "{", "identifiers": []}'),  # never balances
        ('{"reasoning": "{",\n"identifiers": []}\n}', None),  # a brace inside a string counts
        (GOOD + " tail", GOOD),  # balanced by line; the tail goes with repair
        ("", None),
    ],
)
def test_balanced_json(column, raw, want):
    assert column(labels.extract_balanced_json, [raw]) == [want]


@pytest.mark.parametrize(
    "raw, want",
    [
        (f"  {GOOD}\n", GOOD),
        (BARE, GOOD),
        (f"text {GOOD} text", GOOD),
        ('{"reasoning": "r"}', None),
        ('{"reasoning": null, "identifiers": null}', '{"reasoning": null, "identifiers": null}'),
        ('[{"reasoning": 1, "identifiers": 2}]', None),
        ('"reasoning identifiers"', None),
        ("", None),
    ],
)
def test_validate_label(column, raw, want):
    assert column(labels.validate_label, [raw]) == [want]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("a {b: 1,} c", '{"b": 1}'),
        ('{"s": "x, y: z"}', '{"s": "x, "y": z"}'),  # fires inside strings too
        ("[1, 2, ]", "[1, 2 ]"),
        ("} {", "} {"),
        ("  plain ", "plain"),
        ("{\n é_1 : 2 ,\n}", '{\n "é_1" : 2 \n}'),
    ],
)
def test_repair(column, raw, want):
    assert column(labels.repair_json, [raw]) == [want]


@pytest.mark.parametrize("raw, want", [("x{a}y}z", "{a}y}"), ("}{", None), ("{", None), ("{}", "{}"), ("", None)])
def test_brace_slice(column, raw, want):
    assert column(text.brace_slice, [raw]) == [want]


@pytest.mark.parametrize(
    "raw, want",
    [
        (f"```json\n{GOOD}\n```", (GOOD, "fenced")),
        (f"note\n{GOOD}", (GOOD, "balanced")),
        (BARE, (GOOD, "repaired")),
        (f"Answer: {GOOD}", (GOOD, "slice")),
        (f"```json\n{BARE}\n```", None),  # repair never helps a fenced response
        ("nothing", None),
        (None, None),
    ],
)
def test_resolve_label(column, raw, want):
    got = column(labels.resolve_label, [raw])[0]
    assert (tuple(got) if got else None) == want


def test_last_duplicate_key_wins(spark):
    v = labels.strict_variant(F.lit('{"reasoning":"a","identifiers":[],"identifiers":["x",1,null]}'))
    row = spark.range(1).select(labels.string_items(labels.label_items(v)).alias("items")).first()
    assert row["items"] == ["x", None, None]


def test_pretty_json(column):
    texts = ['{"b":1,"a":["é",{}]}', "not json", None, "[]", '{"e":1E5}']
    want = [t if t in (None, "not json") else json.dumps(json.loads(t), indent=2, ensure_ascii=False) for t in texts]
    assert column(labels.pretty_json, texts) == want


def test_names(column):
    assert column(lambda t: text.split_ext(text.base_name(t))["ext"], ["a/b.c.json", ".rc", "x", "a.d/y", "z."]) == [
        ".json", "", "", "", ".",
    ]
    assert column(lambda t: text.artifact_name("t", F.lit("src/App.View.swift"), "labels.json"), ["org/my-app"]) == [
        "org_my_app_App.View_labels.json"
    ]
    assert column(lambda t: text.mime_type(t), ["A.SWIFT", "b.json", "c.txt", "d"]) == [
        "text/x-swift", "application/json", "text/plain", "text/plain",
    ]


def test_fill_does_not_rescan_slots(spark):
    row = spark.range(1).select(text.fill("{a}-{b} {{x}}", {"a": F.lit("{b}"), "b": F.lit("B")}).alias("r")).first()
    assert row.r == "{b}-B {x}"
