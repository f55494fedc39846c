"""Tokens of a text as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.functions.text import clean_text


def _prepared(text: Column, do_clean: bool) -> Column:
    return clean_text(text) if do_clean else text


def tokens(text: Column, do_clean: bool = True) -> Column:
    """Words and single punctuation marks, in order."""
    return F.regexp_extract_all(_prepared(text, do_clean), F.lit(fixed.WORD_OR_PUNCTUATION), F.lit(0))


def token_count(text: Column, do_clean: bool = True) -> Column:
    """Number of tokens, neither truncated nor with specials."""
    return F.regexp_count(_prepared(text, do_clean), F.lit(fixed.WORD_OR_PUNCTUATION))


def passages(text: Column, size: int = fixed.PASSAGE_TOKENS, overlap: int = fixed.PASSAGE_OVERLAP) -> Column:
    """Whitespace-separated words cut into overlapping windows: array<struct<passage_no, passage>>.

    The last window starts where words not yet covered remain, so every word is in one.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap

    def windows(words: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(words) - overlap) / F.lit(step)).cast("int") - 1)
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                i.alias("passage_no"),
                F.array_join(F.slice(words, i * step + 1, size), " ").alias("passage"),
            ),
        )

    # Binding the words as a lambda argument splits each text once, not once per window.
    return F.element_at(F.transform(F.array(F.split(text, " ")), windows), 1)
