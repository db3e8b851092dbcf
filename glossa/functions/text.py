"""Column expressions that reproduce Python string semantics on the JVM side.

Everything here returns a ``Column`` built from Spark SQL built-ins, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------
# Python's ``str.isspace`` set equals Java's Unicode White_Space property plus the four
# information separators U+001C..U+001F.  ``(?U)`` turns on Unicode classes in Java regex.
PY_SPACE = r"(?U)[\s\x1c-\x1f]"
PY_NONSPACE = r"(?U)[^\s\x1c-\x1f]"
# ------------------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_blank(col) -> Column:
    """Python ``not s.strip()``: true for '' and for text made only of whitespace."""
    return ~_c(col).rlike(PY_NONSPACE)


def has_text(col) -> Column:
    """Python ``bool(s.strip())``."""
    return _c(col).rlike(PY_NONSPACE)


def py_strip(col) -> Column:
    """Python ``s.strip()`` (Unicode whitespace at both ends)."""
    return F.regexp_replace(_c(col), r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def py_rstrip(col) -> Column:
    """Python ``s.rstrip()``."""
    return F.regexp_replace(_c(col), r"(?U)[\s\x1c-\x1f]+\z", "")


def json_quote(col) -> Column:
    """``json.dumps(s, ensure_ascii=False)``: the JSON string literal of ``s``.

    ``to_json`` escapes exactly the characters Python escapes and keeps non-ASCII text
    as is; the only difference is the hex case of ``\\u00XX`` escapes of the control
    characters whose code has a letter digit (Python writes lower case).  Those are
    rare, so the fix is applied only when such a character is present.
    """
    c = _c(col)
    quoted = F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    fixed = quoted
    for upper in "ABCDEF":
        fixed = F.regexp_replace(
            fixed, r"((?<!\\)(?:\\\\)*\\u00[01])" + upper, "$1" + upper.lower())
    return F.when(c.rlike(r"[\x0b\x0e\x0f\x1a-\x1f]"), fixed).otherwise(quoted)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element ``transform``).

    Used where a formula refers to an intermediate many times: inlining would repeat
    it and blow the 64 KB limit of generated methods."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _named(**fields) -> Column:
    return F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), v)])


def py_float_repr(x) -> Column:
    """Python ``repr(float)`` of a DOUBLE column.

    Python prints the shortest decimal that reads back as the same double.  That is
    found natively: format the value with 1..17 significant digits (``%.Ne``) and keep
    the first text that casts back to the same double; then lay it out as Python does
    (positional for decimal exponents -4..15, else ``d.ddde+XX``).  Java's
    ``Double.toString`` is not used: before JDK 19 it sometimes prints extra digits.
    """
    v = _c(x).cast("double")
    candidates = F.array(*[F.format_string(f"%.{k}e", v) for k in range(17)])
    shortest = F.element_at(F.filter(candidates, lambda t: t.cast("double") == v), 1)

    def split(a):
        m = F.regexp_extract(a["u"], r"^([0-9])\.?([0-9]*)e([+-][0-9]+)$", 0)
        d = F.rtrim(F.concat(F.regexp_extract(m, r"^([0-9])", 1),
                             F.regexp_extract(m, r"^[0-9]\.?([0-9]*)e", 1)), F.lit("0"))
        d = F.ltrim(d, F.lit("0"))
        p = F.regexp_extract(m, r"e([+-][0-9]+)$", 1).try_cast("int") + 1
        return _let(_named(neg=a["neg"], u=a["u"], d=d, p=p), layout)

    def layout(c):
        d, p = c["d"], c["p"]
        n, e = F.length(d), p - 1
        positional = (F.when(p <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -p), d))
                      .when(p >= n, F.concat(d, F.repeat(F.lit("0"), p - n), F.lit(".0")))
                      .otherwise(F.concat(F.substr(d, F.lit(1), p), F.lit("."), F.substr(d, p + 1))))
        scientific = F.concat(
            F.substr(d, F.lit(1), F.lit(1)),
            F.when(n > 1, F.concat(F.lit("."), F.substr(d, F.lit(2)))).otherwise(F.lit("")),
            F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
            # at least two exponent digits (lpad would cut longer ones)
            F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(e).cast("string"))
        body = (F.when(c["u"] == "Infinity", F.lit("inf"))
                 .when(n == 0, F.lit("0.0"))
                 .when((e >= -4) & (e < 16), positional)
                 .otherwise(scientific))
        return F.when(c["u"] == "NaN", F.lit("nan")).otherwise(
            F.concat(F.when(c["neg"], F.lit("-")).otherwise(F.lit("")), body))

    return _let(_named(neg=shortest.startswith("-"), u=F.regexp_replace(shortest, "^-", "")),
                split)


def py_str_variant(v) -> Column:
    """Python ``str(x)`` of a JSON scalar held in a VARIANT.

    JSON null -> ``None``; booleans -> ``True``/``False``; integers as digits; numbers
    with a fraction or exponent (VARIANT keeps them as DECIMAL or DOUBLE) -> Python float
    repr.  Objects and arrays come back as compact JSON (Python would print a dict or
    list repr; documented difference).  SQL NULL (field missing) stays NULL.

    Strings and integers (nearly all keys and ids) take a short inline path; the rare
    kinds go through one bound lambda, which keeps generated code small.
    """
    v = _c(v)
    t = F.schema_of_variant(v)
    simple = t.isin("STRING", "BIGINT", "INT", "SMALLINT", "TINYINT")

    def rare(a):
        x, k = a["v"], a["t"]
        as_text = x.cast("string")
        dec_scale0 = F.regexp_extract(k, r"^DECIMAL\((\d+),0\)$", 1)
        return (F.when(k == "VOID", F.lit("None"))
                 .when(k == "BOOLEAN", F.initcap(as_text))
                 # an integer too long for BIGINT is DECIMAL(p,0) with p >= 19: digits
                 .when((dec_scale0 != "") & (dec_scale0.cast("int") >= 19), as_text)
                 .when(k.startswith("DECIMAL") | k.isin("DOUBLE", "FLOAT"),
                       py_float_repr(x.cast("double")))
                 .otherwise(F.to_json(x)))

    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(simple, v.cast("string"))
             .otherwise(_let(_named(v=v, t=t), rare)))
