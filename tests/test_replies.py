"""Reply parsing (R1-R4): replies whose answer is known from how they are built."""

import random

import pytest
from pyspark.sql import functions as F

from glossa.operators.replies import envelope_text, parse_replies

def _parse(spark, items):
    df = spark.createDataFrame([(i, r, n) for i, (r, n) in enumerate(items)],
                               "i int, reply string, n int")
    out = parse_replies(df, "reply", "n").orderBy("i").select("status", "items").collect()
    return [(r.status, list(r.items) if r.items is not None else None) for r in out]


# how a provider may dress a JSON array without changing what it says
BEFORE = ["", "\n \n", "Below, in order:\n", "1 of 1 - "]
AFTER = ["", " ", "\n(Names such as [guard] stay.)", "\nEnd {of} list"]
FENCES = [("", ""), ("```json\n", "\n```"), ("```", "```")]
# JSON scalar -> its text in the result
SCALARS = [("true", "True"), ("false", "False"), ("null", "None"), ("7", "7"), ("-0.25", "-0.25"),
           ("3.0", "3.0"), ("2e2", "200.0"), ('"[lake] {x}"', "[lake] {x}"), ('"a\\"b"', 'a"b'),
           ('"\\u0161"', "š"), ('"]"', "]"), ('""', "")]


def _built_case(rnd):
    """(reply, expected number, status, items): the answer is known from how it is built."""
    picked = [rnd.choice(SCALARS) for _ in range(rnd.randint(1, 5))]
    body, items, n = "[" + ", ".join(j for j, _ in picked) + "]", [t for _, t in picked], len(picked)
    kind = rnd.choice(["ok", "ok", "ok", "wrong_count", "nested_item", "not_array", "invalid_json"])
    if kind == "wrong_count":
        n += rnd.choice([1, 2])
    elif kind == "nested_item":
        body, n = body[:-1] + rnd.choice([', {"k": 1}]', ", [2]]"]), n + 1
    elif kind == "not_array":
        return rnd.choice(['{"k": "v"}', '"words"', "12", "null"]), n, kind, None
    elif kind == "invalid_json":
        return rnd.choice(["", "  ", "no list here", "{", body[:-1]]), n, kind, None
    if rnd.random() < 0.5:
        left, right = rnd.choice(FENCES)
        return left + body + right, n, kind, items if kind == "ok" else None
    return rnd.choice(BEFORE) + body + rnd.choice(AFTER), n, kind, items if kind == "ok" else None


def test_built_replies(spark):
    rnd = random.Random(5)
    cases = [_built_case(rnd) for _ in range(1500)]
    got = _parse(spark, [(r, n) for r, n, _, _ in cases])
    diffs = [(c, g) for c, g in zip(cases, got) if g != (c[2], c[3])]
    assert not diffs, diffs[:5]


@pytest.mark.parametrize("provider,raw,status,text", [
    ("anthropic", '{"content":[{"type":"text","text":"[\\"a\\"]"}],"stop_reason":"end_turn"}', None, '["a"]'),
    ("anthropic", '{"content":[{"type":"text","text":"[\\"a\\"]"}],"stop_reason":"max_tokens"}', "truncated", '["a"]'),
    ("openai", '{"choices":[{"message":{"content":"[1]"},"finish_reason":"stop"}]}', None, "[1]"),
    ("openai", '{"choices":[{"message":{"content":null},"finish_reason":"stop"}]}', "refused", None),
    ("openai", '{"choices":[{"message":{"content":"x"},"finish_reason":"length"}]}', "truncated", "x"),
])
def test_envelopes(spark, provider, raw, status, text):
    df = spark.createDataFrame([(raw,)], "raw string")
    t, s = envelope_text(provider, "raw")
    row = df.select(t.alias("t"), s.alias("s")).first()
    assert (row.s, row.t) == (status, text)
