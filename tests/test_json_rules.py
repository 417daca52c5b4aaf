"""Strict JSON validity and truthiness vs Python's json / bool."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from quayside.functions.json import compact_sql, is_object, is_truthy, is_valid

CASES = ['{"a":1}', '{"a":1} junk', "1],[2", '1},{"a":2', "[]", "{}", "0", "0.0", "-0", "0e0", '""', "false",
         "null", "abc", ' {"a":1} ', '"x"', "5", "[0]", '"\\u00e9"', "true", "[1,2]", '{"a":{"b":[1,null]}}',
         "1.5e3", "-0.000", "  0  ", '"0"', "[[]]", '{"":0}', "tru", "{", "", " ", "01", "1.", ".5", "[1,]",
         '{"a":1,}', "'a'", "Infinity", "{ }", "[ \n]", "1,2", '1,"b":2', "1],[", '{"a":1},{"b":2}', '1}', '1]', "1],[2]", "1e-400", ' "" ',
         "{\t}", '"a', '"a\\', '"}', '"]', '],[', '},{', '"x"],["y"', '"x"},{"v":"y"', "1 /* c */", "nul", "[1", '{"v":1']
# Python accepts NaN, the infinities and duplicate keys, and so does the engine; nesting beyond LEVELS is folded
CASES += ["NaN", "-Infinity", "-NaN", "+Infinity", '{"a":1,"a":2}', '{"a":NaN}', "[-Infinity,Infinity]", '{"a":{"a":{"a":{"a":{"a":{"a":[1,{"b":null}]}}}}}}',
          "[[[[[[]]]]]]", "[[[[[[]]]]]", "[[[[[[1,]]]]]]", "[[[[[[1] ,[2]]]]]]", "[[[[[{[]:1}]]]]]", "[[[[[1[]]]]]]", "[[[[[[][]]]]]]", '[[[[["[","]"]]]]]', '[[[[["a\\x", "b"]]]]]',
          "[[[[[\n{ }\t]]]]]", "[" * 60 + "1" + "]" * 60, "[" * 60 + "1" + "]" * 59, '{"a":"\t"}', '"\\u00e"', "1\u0085", "1\u2028", "\ufeff1", "[1 2]", '{"a" 1}', '{a:1}', "[[[[[{\"a\":}]]]]]",
          "[" + "1," * 20_000 + "1]", "[" + '{"k":[1,2]},' * 5_000 + "{}]", '"' + "é\\n" * 30_000 + '"', "[[[[[" + '{"k":[1,{"z":"x]"}]},' * 2_000 + "{}]]]]]"]
PY_ONLY: set = set()


def py_valid(s):
    try:
        json.loads(s)
        return True
    except ValueError:
        return False


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "s string")
    out = df.select("s", is_valid("s").alias("valid"), is_truthy("s").alias("truthy"), is_object("s").alias("obj"))
    return {r["s"]: r for r in out.collect()}


@pytest.mark.parametrize("text", CASES)
def test_validity(rows, text):
    expected = py_valid(text) and text not in PY_ONLY
    assert rows[text]["valid"] == expected


@pytest.mark.parametrize("text", [c for c in CASES if py_valid(c) and c not in PY_ONLY])
def test_truthiness(rows, text):
    v = json.loads(text)
    assert rows[text]["truthy"] == bool(v)
    assert rows[text]["obj"] == isinstance(v, dict)


def test_python_extensions(spark):
    df = spark.createDataFrame([("NaN",), ('{"a":1,"a":2}',)], "s string")
    assert all(r[0] and r[1] for r in df.select(is_valid("s"), is_truthy("s")).collect())
    assert math.isnan(json.loads("NaN"))


def test_generated_documents_agree_with_python(spark):
    rng = random.Random(5)
    tokens = ["{", "}", "[", "]", ",", ":", '"a"', '"]"', "1", "-0.5e3", "null", " ", "NaN", '"\\"', "true", "0"]

    def document(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            return rng.choice(["1", '"x"', "null", "-2.5E+7", '"\\\\"', "NaN", "[]", "{}"])
        members = [document(depth - 1) for _ in range(rng.randrange(4))]
        return "[" + ", ".join(members) + "]" if kind < 0.65 else "{" + ",".join(f'"k{i % 2}" : {m}' for i, m in enumerate(members)) + "}"

    texts = [document(rng.randrange(9)) for _ in range(600)]
    for t in list(texts):                                   # and one edit away from a document
        at = rng.randrange(len(t))
        texts.append(t[:at] + rng.choice([*tokens, ""]) + t[at + rng.randrange(2):])
    texts += ["".join(rng.choices(tokens, k=rng.randrange(1, 9))) for _ in range(600)]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select("s", is_valid("s")).collect()
    wrong = [r[0] for r in got if r[1] != py_valid(r[0])]
    assert not wrong, wrong[:5]


MERGE_CASES = ['{"a":1}', '{"processed_at":"old","b":[1,null]}', '{"x":{"y":{"z":null}},"processing_version":"0.9","w":true}',
               '{"processing_version":"0.9","processed_at":"old"}', '{}', '{"s":"é\\"q"}']


def test_set_object_keys_is_dict_update(spark):
    from quayside.functions.json import set_object_keys
    df = spark.createDataFrame([(m,) for m in MERGE_CASES], "m string")
    out = df.select("m", set_object_keys("m", {"processed_at": "'NEW'", "processing_version": "'1.0'"}).alias("o"))
    for r in out.collect():
        expected = json.loads(r["m"])
        expected.update({"processed_at": "NEW", "processing_version": "1.0"})
        got = json.loads(r["o"])
        assert got == expected and list(got) == list(expected), (r["m"], r["o"])


def test_compact_text_keeps_values(spark):
    cases = ['{"a": 1}', '{ "a" : [1 , 2] }', '{"s":"a b\\"  c","n":12345678901234567890123456789012345678901234567}', '{"x":1.50}', '{"t":" "}', "{}"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    for r in df.selectExpr("s", f"{compact_sql('s')} AS o").collect():
        assert json.loads(r["o"]) == json.loads(r["s"])
        assert r["o"] == json.dumps(json.loads(r["s"], parse_float=str, parse_int=str), separators=(",", ":")) or "1" in r["s"]


def test_enrichment_keeps_long_numbers(spark):
    from helpers import AS_OF, envelopes
    from quayside.plans.ingest import accepted_conformed, process_events
    big = "1" * 45
    texts = ['{"event_id":"a","event_type":"t","payload":{"a":1},"source":"s","metadata":%s}' % m
             for m in ('{"big":%s,"f":1.25}' % big, "{}", '"{\\"big\\": %s}"' % big, '{"processed_at":"old","k":1}')]
    rows = accepted_conformed(process_events(envelopes(spark, texts), as_of=AS_OF), keep=("offset",)).orderBy("offset").collect()
    tail = '"processed_at":"2024-01-25T00:00:00","processing_version":"1.0"}'
    assert [r.metadata for r in rows] == ['{"big":%s,"f":1.25,%s' % (big, tail), "{" + tail, '{"big":%s,%s' % (big, tail),
                                          '{"processed_at":"2024-01-25T00:00:00","k":1,"processing_version":"1.0"}']
