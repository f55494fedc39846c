"""Text cleaning as Column functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskit import fixed
from corpuskit.functions import normalise

# One left-to-right pass, so a comment holding a script (or the reverse) is read the
# way a parser reads it: comment, script or style element, quoted tag, loose tag.
_MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
    r"|[/a-z!?](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|[/a-z!?][^>]*>)"
)
# A run of whitespace other than a lone space, which can stay as it is.
_RUN = f" {fixed.WHITESPACE}+|[{fixed.WHITESPACE}&&[^ ]]{fixed.WHITESPACE}*"


def strip_tags(text: Column) -> Column:
    """Every ``<...>`` becomes a space."""
    return F.regexp_replace(text, fixed.TAG, " ")


def collapse_whitespace(text: Column) -> Column:
    """Runs of Unicode whitespace become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, _RUN, " "))


def clean_text(text: Column) -> Column:
    """Tags, entities, NFKC, whitespace - in that order; NULL becomes ''."""
    return collapse_whitespace(normalise.strip_decode_fold(F.coalesce(text, F.lit(""))))


def markup_removed(html: Column) -> Column:
    """Tags, comments, and whole script and style elements become spaces."""
    return F.regexp_replace(html, _MARKUP, " ")


def visible_text(html: Column) -> Column:
    """Text a reader of the page sees, entities decoded."""
    return collapse_whitespace(normalise.decode_entities(markup_removed(F.coalesce(html, F.lit("")))))


def preprocess_text(text: Column, mode: str = "parsed") -> Column:
    """Clean a field that may hold a page.

    ``parsed``  drop markup the way a parser does, then clean (entities are decoded twice)
    ``regex``   clean only: script bodies stay, as when no parser is at hand
    """
    if mode == "regex":
        return clean_text(text)
    if mode != "parsed":
        raise ValueError(f"unknown mode {mode!r}")
    page = F.coalesce(text, F.lit(""))
    return collapse_whitespace(normalise.decode_strip_decode_fold(page, markup_removed(page)))


def apply_rules(text: Column, rules: Sequence[Callable[[Column], Column]]) -> Column:
    """Extra cleaning rules written as Column functions, in order."""
    for rule in rules:
        text = rule(text)
    return text


def apply_python_rules(text: Column, rules: Sequence[Callable[[str], str]]) -> Column:
    """Extra cleaning rules written in Python, in order, in one Arrow hop.

    A rule that fails on a text leaves that text as it was; later rules still run.
    """
    rules = tuple(rules)

    def run(value: str) -> str:
        for rule in rules:
            try:
                value = rule(value)
            except Exception:  # noqa: BLE001 - a user rule may raise anything
                continue
        return value

    @F.arrow_udf(T.StringType())
    def ruled(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else run(v) for v in values.to_pylist()], pa.string())

    return ruled(text)


def content_hash(*parts: Column) -> Column:
    """Hex SHA-256 of a text, or of several texts kept apart."""
    if len(parts) == 1:
        return F.sha2(parts[0], 256)
    return F.sha2(F.concat_ws("\x1f", *[F.sha2(p, 256) for p in parts]), 256)


def training_text(*parts: Column) -> Column:
    """Non-empty parts joined by a blank line; '' when all are empty."""
    return F.concat_ws(fixed.PART_SEPARATOR, *[F.nullif(p, F.lit("")) for p in parts])


def nested_record(fields: dict[str, tuple[Column, Column]]) -> Column:
    """``{name: (original, processed)}`` as a struct of structs."""
    return F.struct(
        *[
            F.struct(original.alias("original"), processed.alias("processed")).alias(name)
            for name, (original, processed) in fields.items()
        ]
    )


def source_preview(document: Column) -> Column:
    """First characters of a source followed by an ellipsis."""
    return F.concat(F.substring(document, 1, fixed.PREVIEW_CHARS), F.lit(fixed.PREVIEW_SUFFIX))


def prompt(context: Column, question: Column) -> Column:
    """Context and question laid out for a model."""
    return F.concat(
        F.lit(fixed.PROMPT_HEAD), context, F.lit(fixed.PROMPT_QUESTION), question, F.lit(fixed.PROMPT_TAIL)
    )


def answer_part(response: Column) -> Column:
    """What follows the last answer mark, or the whole response without one."""
    return strip_ends(F.element_at(F.split(response, fixed.ANSWER_MARK), -1))


def strip_ends(text: Column) -> Column:
    """Whitespace off both ends, inner whitespace kept."""
    return F.btrim(text, F.lit(fixed.WHITESPACE_CHARACTERS))


def is_blank(text: Column) -> Column:
    """True for NULL, empty or whitespace-only text."""
    return F.coalesce(strip_ends(text) == "", F.lit(True))


def dont_know(response: Column) -> Column:
    """The response admits it has no answer."""
    return response.rlike(f"(?iu){fixed.DONT_KNOW}")


def mask_personal_data(text: Column) -> Column:
    """E-mail addresses, phone numbers and long digit runs become placeholders."""
    text = F.regexp_replace(text, fixed.EMAIL, "<email>")
    text = F.regexp_replace(text, fixed.PHONE, "<phone>")
    return F.regexp_replace(text, fixed.NUMBER_RUN, "<number>")


def pseudonym(user_id: Column, salt: str) -> Column:
    """Salted SHA-256 of a user id."""
    return F.sha2(F.concat(F.lit(salt), user_id.cast("string")), 256)


def history_line(role: Column, text: Column) -> Column:
    """``User: ...`` or ``Assistant: ...``."""
    return F.concat(F.when(role == "user", "User").otherwise("Assistant"), F.lit(": "), text)
