"""Entity decoding and NFKC: the one text step Spark has no built-in for."""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskit import fixed

# Characters beyond ASCII that NFKC leaves alone wherever they stand (quick-check "yes",
# never reordered, never composed with the character before). A text of these and ASCII
# only, without an ampersand that may start an entity, needs no Python at all.
STABLE = (
    r"\x{C0}-\x{0131}\x{0134}-\x{013E}\x{0141}-\x{0148}\x{014A}-\x{017E}\x{0410}-\x{044F}"
    r"\x{2018}-\x{201F}\x{3041}-\x{3094}\x{30A1}-\x{30FA}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}"
)
# The outer range is tested first and settles ASCII at once.
_UNSTABLE = f"[\\x{{80}}-\\x{{10FFFF}}&&[^{STABLE}]]"
_TAG_RE = re.compile(fixed.TAG)


def _strings(values: pa.Array, convert) -> pa.Array:
    return pa.array([None if v is None else convert(v) for v in values.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _decode(values: pa.Array) -> pa.Array:
    return _strings(values, html.unescape)


@F.arrow_udf(T.StringType())
def _decode_fold(values: pa.Array) -> pa.Array:
    return _strings(values, lambda v: unicodedata.normalize("NFKC", html.unescape(v)))


@F.arrow_udf(T.StringType())
def _decode_strip_decode_fold(values: pa.Array) -> pa.Array:
    def convert(v: str) -> str:
        text = _TAG_RE.sub(" ", html.unescape(v))
        return unicodedata.normalize("NFKC", html.unescape(text))

    return _strings(values, convert)


@F.arrow_udf(T.StringType())
def _fold(values: pa.Array) -> pa.Array:
    return _strings(values, lambda v: unicodedata.normalize("NFKC", v))


def _only_where(needed: Column, text: Column, udf, otherwise: Column) -> Column:
    # Rows that need no work reach Python as NULL, so their text never leaves the JVM, and
    # the alternative is only computed for them.
    return F.coalesce(udf(F.when(needed, text)), otherwise)


def _may_change(text: Column) -> Column:
    return text.contains("&") | text.rlike(_UNSTABLE)


def decode_entities(text: Column) -> Column:
    """HTML entities to characters."""
    return _only_where(text.contains("&"), text, _decode, text)


def nfkc(text: Column) -> Column:
    """Unicode compatibility composition."""
    return _only_where(text.rlike(_UNSTABLE), text, _fold, text)


def strip_decode_fold(text: Column) -> Column:
    """Tags to spaces, entities decoded, then NFKC, in at most one Arrow hop."""
    bare = F.when(text.contains("<"), F.regexp_replace(text, fixed.TAG, " ")).otherwise(text)
    return _only_where(_may_change(text), bare, _decode_fold, bare)


def decode_strip_decode_fold(html_text: Column, bare: Column) -> Column:
    """Parser-style decoding of ``bare``, ``html_text`` without its markup, followed by
    :func:`strip_decode_fold`, in at most one Arrow hop."""
    # Without an opening bracket there is no markup, which a plain search tells sooner than the patterns.
    native = F.when(html_text.contains("<"), F.regexp_replace(bare, fixed.TAG, " ")).otherwise(html_text)
    return _only_where(_may_change(html_text), bare, _decode_strip_decode_fold, native)
