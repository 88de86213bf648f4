"""Number expressions: Python-compatible number text and numeric coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1: Veltkamp splitting constant for IEEE doubles.
_SPLIT = 134217729.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_TWO_52 = "4503599627370496D"
_LONG_SAFE = "9.0E18D"


def py_fixed_sql(x: str, digits: int = 0) -> str:
    """SQL text that writes the SQL expression `x` as Python's `format(x, '.<digits>f')`.

    Python rounds the exact binary value, ties to even; Spark's `bround` and
    `format_string` round the shortest decimal form, which differs for values
    such as 0.35. Here x * 10**digits is formed exactly as p + e (Dekker's
    product with a Veltkamp split) and rounded to an integer: below 2**52, p's
    fraction decides and e only breaks an exact half; from 2**52 on, p is an
    integer and e is rounded on its own.

    Each intermediate is bound once through a lambda, so the expression stays
    small however often a value is reused; it parses in one call instead of
    hundreds of column-building calls. Non-finite values and magnitudes past
    the exact range are routed around the integer arithmetic (ANSI mode would
    reject the overflow): NULL, 'nan', 'inf', '-inf', and Java's formatting
    beyond 9e18 / 10**digits.
    """
    m = f"{float(10 ** digits)!r}D"
    scale = 10**digits
    a = "(CASE WHEN isnan(_pf_v) OR abs(_pf_v) * {m} >= {safe} THEN 0D ELSE abs(_pf_v) END)".format(m=m, safe=_LONG_SAFE)
    hi = f"({a} * {_SPLIT!r}D - ({a} * {_SPLIT!r}D - {a}))"
    split = f"named_struct('p', {a} * {m}, 'e', ({hi} * {m} - {a} * {m}) + ({a} - {hi}) * {m})"
    fl = "floor(_pf_s.p)"
    n = (
        f"CASE WHEN _pf_s.p < {_TWO_52} THEN {fl} + IF(_pf_s.p - {fl} > 0.5D OR (_pf_s.p - {fl} = 0.5D AND "
        f"(_pf_s.e > 0D OR (_pf_s.e = 0D AND pmod({fl}, 2) = 1))), 1, 0) "
        f"ELSE {fl} + floor(_pf_s.e) + IF(_pf_s.e - floor(_pf_s.e) > 0.5D OR (_pf_s.e - floor(_pf_s.e) = 0.5D AND "
        f"pmod({fl} + floor(_pf_s.e), 2) = 1), 1, 0) END"
    )
    if digits == 0:
        body = "CAST(_pf_n AS STRING)"
    else:
        body = (
            f"concat(CAST(floor(_pf_n / {scale}) AS STRING), '.', "
            f"lpad(CAST(pmod(_pf_n, {scale}) AS STRING), {digits}, '0'))"
        )
    final = (
        "CASE WHEN _pf_v IS NULL THEN CAST(NULL AS STRING) WHEN isnan(_pf_v) THEN 'nan' "
        "WHEN _pf_v = double('inf') THEN 'inf' WHEN _pf_v = double('-inf') THEN '-inf' "
        f"WHEN abs(_pf_v) * {m} >= {_LONG_SAFE} THEN format_string('%.{digits}f', _pf_v) "
        f"ELSE concat(IF(_pf_v < 0, '-', ''), {body}) END"
    )
    return (
        f"element_at(transform(array(CAST(({x}) AS DOUBLE)), _pf_v -> "
        f"element_at(transform(array({split}), _pf_s -> "
        f"element_at(transform(array({n}), _pf_n -> {final}), 1)), 1)), 1)"
    )


def py_text(x: str, digits: int = 0) -> Column:
    """The column of `py_fixed_sql` for a SQL expression (e.g. a column name)."""
    return F.expr(py_fixed_sql(x, digits))


def py_round_text(x: str) -> Column:
    """Text of Python's `str(round(x))` for a SQL expression: ties to even, and an integer, so a
    negative value that rounds to zero prints "0" (format(x, '.0f') gives "-0")."""
    t = py_text(x, 0)
    return F.when(t == "-0", F.lit("0")).otherwise(t)


def coerce_numeric(c: Column | str) -> Column:
    """Text to double; anything unparsable becomes NULL (pandas `to_numeric(errors="coerce")`).

    Java's parser also accepts a trailing type letter ('1.5d', '2f') and hex
    floats ('0x1p3') that pandas rejects, so those forms are refused before the
    cast; and an overflowing literal ('1e999') parses to infinity there but is a
    failure for pandas, so infinity counts only when the text spells it.
    """
    c = _col(c)
    s = c.cast("string")
    v = s.try_cast("double")
    spelled_inf = s.rlike(r"(?i)^\s*[+-]?inf(inity)?\s*$")
    overflow = ((v == float("inf")) | (v == float("-inf"))) & ~spelled_inf
    return F.when(~s.rlike(r"[0-9.]\s*[dDfF]\s*$|[xX]") & ~overflow, v)
