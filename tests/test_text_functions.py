"""Python string semantics on the JVM side, compared with Python itself."""

import json
import random

from pyspark.sql import functions as F

from glossa.functions.text import is_blank, json_quote, py_float_repr, py_str_variant, py_strip


def _col(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_blank_and_strip_match_python_over_bmp(spark):
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    values = ["a" + "".join(chars[i:i + 64]) + "b" for i in range(0, len(chars), 64)]
    values += [c for c in chars if c.isspace()] + ["", "  x  ", "　y\x1c"]
    got_blank = _col(spark, values, is_blank)
    got_strip = _col(spark, values, py_strip)
    assert got_blank == [not v.strip() for v in values]
    assert got_strip == [v.strip() for v in values]


def test_json_quote_matches_python(spark):
    rnd = random.Random(7)
    pool = [chr(c) for c in range(0, 0x250)] + ["é", " ", "😀", '"', "\\", "/"]
    values = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    values += ["\x0b\x1f\x0e", "\\u000B", "\\\x0b"]
    assert _col(spark, values, json_quote) == [json.dumps(v, ensure_ascii=False) for v in values]


def test_float_repr_matches_python(spark):
    rnd = random.Random(11)
    floats = [0.0, -0.0, 1.0, 1e16, 1e15, 123456789012345678.0, 0.0001, 0.00001, 1.5e-7,
              12345678.0, 1e22, 1.7976931348623157e308, 5e-324, 2.5, -3.75e-5, 0.1, 1 / 3]
    floats += [rnd.uniform(-1e6, 1e6) for _ in range(300)]
    floats += [10 ** rnd.uniform(-30, 30) for _ in range(300)]
    floats += [float(f"{rnd.randint(1, 10**rnd.randint(1, 15))}e{rnd.randint(-40, 40)}")
               for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(floats)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(py_float_repr(F.col("x"))).collect()]
    assert got == [repr(x) for x in floats]


def test_str_of_json_scalars(spark):
    texts = ['"x"', "true", "false", "null", "12", "-7", "1.0", "1e3", "2.5", "12345678901234567890",
             "1.5e20", '{"a":1}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(py_str_variant(F.parse_json("t"))).collect()]
    expect = [str(json.loads(t)) for t in texts[:-1]] + ['{"a":1}']
    assert got == expect
