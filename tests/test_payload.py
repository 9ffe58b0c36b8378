"""JSON previews: the native path and the recursion agree, and follow the rules."""

import json

import pytest
from pyspark.sql import functions as F

from callscope import schemas as S
from callscope.functions import payload, telemetry

RUN = "QUJD" * 130


def preview(spark, values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = payload.with_preview(df, "out", "v", **options).orderBy("i").collect()
    return [r.out for r in rows]


def test_native_and_recursive_paths_agree(spark):
    values = [
        '{"b":1,"a":{"z":[1,2,{"y":null,"x":true}],"k":"<&>"}}', "[]", "{}", '[{"q":"text"}, 3]',
        '{"telemetry":{"user_intent":"x"},"b":[1],"a":"s"}', '{ "k" : 69 }', '{"a":1,"a":2}',
    ]
    strip = __import__("pyspark.sql.functions", fromlist=["lit"]).lit(True)
    got = preview(spark, values, strip=strip)
    slow = [
        payload.stringify(payload.clean_value(payload.select_payload(v, None, True, None, False)))
        for v in values
    ]
    assert got == slow
    assert got[0] == '{"a":{"k":"\\u003c\\u0026\\u003e","z":[1,2,{"x":true,"y":null}]},"b":1}'
    assert got[4] == '{"a":"s","b":[1]}'


def test_native_path_leaves_nothing_to_the_rules(spark):
    keys = ["pass-word", "_P_W_D", "TO-KEN", "client--secret", "data_base_url"]
    values = [json.dumps({k: "v", "note": "plain"}) for k in keys]
    want = [json.dumps({k: S.SENSITIVE_FIELD, "note": "plain"}, separators=(",", ":"), sort_keys=True) for k in keys]
    assert [json.loads(p) for p in preview(spark, values)] == [json.loads(w) for w in want]
    numbers = ["1.0", "10e2", "-0", "1234567890123456789", "[1.50]", "2.0e-3"]
    values = [f'{{"d":"2024-01-05 x1e5","n":{n}}}' for n in numbers]
    assert preview(spark, values) == values
    assert not any(leaves(spark, values + ['{"d":"2024-01-05 x1e5","n":12}']))


def leaves(spark, values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in payload.with_recursion_flag(df, "out", "v", **options).orderBy("i").collect()]


ROUGH = [
    {"s": "line\nend\ttab \" \\ / é 中 😀 \u2028 <b>&"}, {"n": [1.50, -0.0, 1e-7, 12345678901234567890], "m": {"x": 2.0, "y": True, "z": None}},
    {"password": "a\nb", "Api-Key": 12, "_to_ken_": True, "pwd": None, "database_URL": 1.5, "passwords": "kept", "note": "password"},
    {"content": [{"type": "image", "data": "QQ==", "mimeType": "a/b"}, {"type": "text", "data": "kept"}, {"type": "audio", "data": ""}, {"data": "x", "name": 1}, {"type": "image", "data": 1.5}]},
    {"blob": "x", "in": {"blob": ""}, "l": [{"blob": 1.5}, {"blob": "é\n"}], "t": '"blob":"kept"', "k,\"blob": "kept"},
    {"a": RUN, "b": "see " + RUN + "\nend", "c": ["data:image/png;base64," + "QUFB" * 20, RUN.replace("C", "/")], RUN: RUN},
    {"u": "postgres://a:b@h", "v": "x", "w": "://q", "x": "y@z"}, {"lines": "token=abc\nnext", "quote": 'pwd="q"', "multi": "-----BEGIN PRIVATE KEY-----\nabc\n-----END PRIVATE KEY-----\n!"},
    {"key token=x": 1, "é": {"ü": ["secret=é&x"]}}, [], {}, [[], {}, [1.0]], {"": ""}, {"deep": {"data": "v", "inner": [1], "note": "no type here"}},
    {"e": "bearer abcdefghijklmnopqrstuvwxyz", "f": ["AKIA" + "ABCDEFGHIJKLMNOP", 3.25]}, {"x": "," , "y": ':"', "z": "{[\\"},
]
#: Texts the recursion has to see: what follows a value, wrong numbers, repeated keys and the like.
STRANGE = [
    '{"a":1} x', "[1] [2]", "[01]", "[1.]", '{"a":1,"a":2}', '{"a":"\\ud800"}', '{"a":"\\u0001"}', '{"a":"\ue010"}', '{"password":{"x":[1]}}', '{"secret":["a"]}',
    '{"data":"x","more":{"q":1},"type":"image"}', "text", '{"a":"\\ue010"}', '{"to\\u212aen":"x"}', '{"a":NaN}', '{"\uff01":1,"😀":2}', "[1]], [[2]", '{"a":1}}', "",
]
#: The same, as far as the native path can tell.
PLAIN = ['"text"', "5", "1.50", ' "q" ', "[1 , 2.0 ]", '{ "b" : 1e5 , "a" : "\\u00e9\\/" }', '{"a":"\\ud83d\\ude00"}', "true"]


@pytest.mark.parametrize("secrets", [True, False])
def test_text_rewriting_gives_what_the_recursion_gives(spark, secrets):
    values = [json.dumps(v) for v in ROUGH] + [json.dumps(v, ensure_ascii=False, indent=1) for v in ROUGH] + STRANGE + PLAIN
    want = [payload.stringify(payload.clean_value(payload.decode(v), secrets)) for v in values]
    assert preview(spark, values, secrets=secrets) == want
    flags = leaves(spark, values, secrets=secrets)
    assert not any(flags[:2 * len(ROUGH)]) and not any(flags[-len(PLAIN):])


def test_member_of_a_rough_payload(spark):
    values = [json.dumps({"name": "t", "arguments": v}) for v in (*ROUGH, None, 5, "text")] + ["[1]", '{"name":"no arguments"}', '{"arguments":{"a":1}} x']
    for objects in (True, False):
        want = [payload.stringify(payload.clean_value(payload.select_payload(v, "arguments", True, "mark", objects))) for v in values]
        assert preview(spark, values, pick="arguments", strip=F.lit(True), drop_marker="mark", objects_only=objects) == want
    owned = [json.dumps({"arguments": {"telemetry": {"n": 1.50, "a": "é\n"}, "b": [2.50], "a": "token=q"}})]
    assert preview(spark, owned, pick="arguments", strip=F.lit(True)) == ['{"a":"token=[redacted:sensitive-kv]","b":[2.5]}'.replace("2.5", "2.5")]
    assert preview(spark, owned, pick="arguments") == ['{"a":"token=[redacted:sensitive-kv]","b":[2.5],"telemetry":{"a":"é\\n","n":1.5}}']


def test_long_strings_with_many_escapes(spark):
    value = {"a": "line\n" * 100_000 + "token=abc", "b": [1.5] * 1000}
    want = payload.stringify(payload.clean_value(payload.decode(json.dumps(value))))
    assert preview(spark, [json.dumps(value)]) == [want] and leaves(spark, [json.dumps(value)]) == [False]


def test_exact_numbers_and_odd_values(spark):
    values = [
        '{"n":1.50,"e":1E5,"big":123456789012345678901234567890,"z":-0}', "null", None, "not json",
        '"text"', '{"s":"line\\u2028 \\ud800 \\" é"}', "5", "NaN",
    ]
    assert preview(spark, values) == [
        '{"big":123456789012345678901234567890,"e":1E5,"n":1.50,"z":-0}', "undefined", "undefined",
        '"not json"', '"text"', '{"s":"line\\u2028 \ufffd \\" é"}', "5", '"NaN"',
    ]


def test_binary_fields_and_sensitive_keys(spark):
    value = {
        "content": [{"type": "image", "data": "QQ=="}, {"type": "text", "data": "kept"}, {"blob": "x"}, {"blob": ""}],
        "Api-Key": "v", "nested": {"DATABASE_URL": "mysql://a:b@c", "token_count": 3, "password": None},
        "list": ["AKIA" + "ABCDEFGHIJKLMNOP", "plain"], "whole": RUN, "part": "see " + RUN + " end",
        "password": RUN, "token": 12,
    }
    got = json.loads(preview(spark, [json.dumps(value)])[0])
    assert [c.get("data", c.get("blob")) for c in got["content"]] == [S.BINARY_REMOVED, "kept", S.BINARY_REMOVED, ""]
    assert got["Api-Key"] == got["password"] == got["token"] == S.SENSITIVE_FIELD
    assert got["nested"] == {"DATABASE_URL": S.SENSITIVE_FIELD, "token_count": 3, "password": None}
    assert got["list"] == ["[redacted:aws-access-key-id]", "plain"]
    assert (got["whole"], got["part"]) == (S.BASE64_REMOVED, f"see {S.BASE64_REMOVED} end")
    kept = json.loads(preview(spark, [json.dumps(value)], secrets=False)[0])
    assert kept["Api-Key"] == "v" and kept["whole"] == S.BASE64_REMOVED


def test_long_values_are_cleaned_whole():
    value = {"b": "x " * 2_000_000, "a": ["w " * 20_000, 7, "last"], "k" * 70_000: "é" * 40_000}
    assert payload.clean_value(value) == value


def test_deep_nesting_is_no_failure(spark):
    deep = "[" * 5000 + "]" * 5000
    assert preview(spark, [deep])[0] in (S.UNSERIALISABLE, json.dumps(deep))


def test_telemetry_shapes(column):
    args = [
        {"telemetry": {"user_intent": "new", "intent": "old"}},
        {"telemetry": {"user_intent": " ", "intent": "old"}},
        {"telemetry": {"user_intent": "", "intent": "old"}},
        {"telemetry": {"user_intent": 1, "intent": "old", "user_turn": 2}},
        {"telemetry": {"user_frustration": "no", "frustration_level": "medium"}},
        {"telemetry": json.dumps({"agent_thinking": "in text"})},
        {"telemetry": json.dumps([1])}, {"telemetry": 5}, {"telemetry": None}, {"q": 1},
    ]
    got = column(telemetry.extract("v"), [json.dumps(a) for a in args])
    assert [tuple(t) for t in got] == [
        ("new", None, None), (" ", None, None), (None, None, None), ("old", None, None),
        (None, None, "medium"), (None, "in text", None), *[(None, None, None)] * 4,
    ]


@pytest.mark.parametrize("enabled,want", [(True, ["why", None, "high"]), (False, [None, None, None])])
def test_field_map(column, enabled, want):
    fields = {"user_intent": "purpose", "agent_thinking": "n", "user_frustration": "mood"}
    value = json.dumps({"purpose": "why", "n": 5, "mood": "high"})
    got = column(telemetry.capture("v", owned="true", fields=fields, enabled=enabled), [value])
    assert list(got[0]) == want


def test_normalize(spark):
    names = [*telemetry.FIELDS, *telemetry.LEGACY.values()]
    df = spark.createDataFrame(
        [(("", "b", "angry", "x", "y", "low"),)],
        "t struct<" + ", ".join(f"{n}: string" for n in names) + ">",
    )
    assert list(df.select(telemetry.normalize("t").alias("o")).first().o) == ["x", "b", "low"]
