"""Text expressions: encoding repair and word capitalisation.

Everything here is built from Spark's own functions; there is no Python UDF.
`repair_columns` runs inside whole-stage codegen; expressions with lambdas
(`capitalize_sentences`) run outside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A string is Latin-1 encodable when every code point is at most U+00FF.
_LATIN1_ONLY = r"^[\x{00}-\x{FF}]*$"

# --- fixed values -----------------------------------------------------------
# Characters Python's str.split() treats as whitespace, as a Java regex class.
PY_WHITESPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
# Sentence separator of the capitaliser: a full stop followed by one space.
SENTENCE_SEP = ". "
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latin1_bytes(c: Column | str) -> Column:
    """Latin-1 bytes of `c`, or NULL when `c` has a code point above U+00FF.

    Spark's `encode` raises on unmappable input, so the guard sits inside the
    argument: the encoder only ever sees encodable strings or NULL.
    """
    c = _col(c)
    return F.encode(F.when(c.rlike(_LATIN1_ONLY), c), "ISO-8859-1")


def mis_encode(c: Column | str, layers: int = 1) -> Column:
    """Apply `layers` rounds of UTF-8 bytes read back as Latin-1 (mojibake)."""
    c = _col(c)
    for _ in range(layers):
        c = F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    return c


def _decode_replacing(b: Column) -> Column:
    # UTF-8 decode; invalid sequences become U+FFFD.
    return F.make_valid_utf8(b.cast("string"))


def _decode_or_null(b: Column) -> Column:
    # UTF-8 decode; NULL when the bytes are not valid UTF-8.
    return F.try_validate_utf8(b.cast("string"))


def repair_text(c: Column | str, mode: str = "strict") -> Column:
    """Undo text that was UTF-8 encoded and then read as Latin-1, once or twice.

    mode="compat" follows the dashboard's rules exactly:
      1. NULL stays NULL.
      2. d1 = Latin-1 bytes of the input decoded as UTF-8 with replacement;
         if the input is not Latin-1 encodable, keep the input.
      3. If d1 equals the input or contains '?', keep the input.
      4. d2 = the same step on d1; if d1 is not Latin-1 encodable, keep the input.
      5. Return d2 if it differs from d1 and has no '?', else d1.
    These rules damage singly mis-encoded text and skip any text with '?'.

    mode="strict" repairs one or two layers and leaves correct text alone: each
    of two passes replaces the text by its Latin-1 bytes decoded as UTF-8 only
    when those bytes are valid UTF-8.
    """
    c = _col(c)
    if mode == "strict":
        once = F.coalesce(_decode_or_null(latin1_bytes(c)), c)
        repaired = F.coalesce(_decode_or_null(latin1_bytes(once)), once)
    elif mode == "compat":
        d1 = _decode_replacing(latin1_bytes(c))
        repaired = _compat_choice(c, d1, _decode_replacing(latin1_bytes(d1)))
    else:
        raise ValueError(f"unknown repair mode: {mode!r}")
    return F.when(_is_ascii(c), c).otherwise(repaired)


def _is_ascii(c: Column) -> Column:
    # As many bytes as characters. ASCII text is its own repair in both modes, without regex and codec work.
    return F.octet_length(c) == F.length(c)


def _compat_choice(c: Column, d1: Column, d2: Column) -> Column:
    return (
        F.when(c.isNull() | d1.isNull() | (d1 == c) | d1.contains("?") | d2.isNull(), c)
        .when((d2 != d1) & ~d2.contains("?"), d2)
        .otherwise(d1)
    )


def repair_columns(df: DataFrame, names: Sequence[str], mode: str = "strict") -> DataFrame:
    """`df` with `repair_text` applied to some of its columns, one projection per decoding step.

    Each step is a column of its own, so it runs once per row and inside
    whole-stage codegen, which `repair_text` as one expression cannot give:
    its first step would be computed again in every branch that uses it.
    """
    if mode not in ("strict", "compat"):
        raise ValueError(f"unknown repair mode: {mode!r}")
    step = _decode_or_null if mode == "strict" else _decode_replacing
    one, two = ({n: f"_repair_{n}_{k}" for n in names} for k in (1, 2))

    def decoded(c: Column) -> Column:
        return step(latin1_bytes(F.when(~_is_ascii(c), c)))

    df = df.withColumns({one[n]: decoded(F.col(n)) for n in names})
    if mode == "strict":
        df = df.withColumns({one[n]: F.coalesce(one[n], n) for n in names})
    df = df.withColumns({two[n]: decoded(F.col(one[n])) for n in names})
    if mode == "strict":
        fixed = {n: F.coalesce(two[n], one[n]) for n in names}
    else:
        # An ASCII second text is its own next step.
        second = {n: F.when(_is_ascii(F.col(one[n])), F.col(one[n])).otherwise(F.col(two[n])) for n in names}
        fixed = {n: _compat_choice(F.col(n), F.col(one[n]), second[n]) for n in names}
    return df.withColumns(fixed).drop(*one.values(), *two.values())


def is_lower(w: Column) -> Column:
    """Python's str.islower(): no upper/title-case character and at least one lower-case one."""
    return (~w.rlike(r"[\p{IsUppercase}\p{IsTitlecase}]")) & w.rlike(r"\p{IsLowercase}")


def capitalize_words(s: Column) -> Column:
    """Split on whitespace, title-case each all-lower-case word, join with one space."""
    words = F.filter(F.split(s, PY_WHITESPACE), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.when(is_lower(w), F.initcap(w)).otherwise(w)), " ")


# An upper or title case letter inside a word, or one that is no Latin-1 letter: `initcap` may change such words.
_ODD_CASE = rf"(?<=[^{PY_WHITESPACE[1:-2]}])[\p{{IsUppercase}}\p{{IsTitlecase}}]|[\p{{IsUppercase}}\p{{IsTitlecase}}&&[^A-ZÀ-ÖØ-Þ]]"


def _capitalize_piece(s: Column) -> Column:
    # Where words begin with a capital at most, `initcap` of all of them is that of the lower-case ones.
    at_once = F.initcap(F.trim(F.regexp_replace(s, PY_WHITESPACE, " ")))
    return F.when(~s.rlike(_ODD_CASE), at_once).otherwise(capitalize_words(s))


def capitalize_sentences(c: Column | str) -> Column:
    """The summary capitaliser: split on '. ', capitalise each all-lower-case word
    of every piece, rejoin pieces with '. '. Despite the name it title-cases words."""
    pieces = F.split(_col(c), r"\Q" + SENTENCE_SEP + r"\E")
    return F.array_join(F.transform(pieces, _capitalize_piece), SENTENCE_SEP)
