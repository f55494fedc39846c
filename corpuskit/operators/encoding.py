"""Tokens to ids and back."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.functions.text import clean_text

MAX_VOCABULARY = 1_000_000
MAX_BYTES = 128 << 20
ENCODE_BYTES = 256 << 10
ENCODE_TEXTS = 256


def _map_flat(values: pa.Array, flat_map: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """Apply a function to the elements of a list array, keeping its shape."""
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), flat_map(values.flatten()))


class Vocabulary:
    """An ``(id, token)`` table shipped to every executor once.

    The table's size is a model parameter, not a property of the data; its rows and bytes
    are checked before it is collected, which is an action. Looking ids up where the tokens are avoids exploding,
    joining and regrouping every token of the corpus.
    """

    def __init__(self, table: DataFrame):
        held = table.agg(F.count("*").alias("n"), F.sum(F.octet_length("token") + 16).alias("size")).first()
        if held["n"] > MAX_VOCABULARY or (held["size"] or 0) > MAX_BYTES:
            raise ValueError(f"more than {MAX_VOCABULARY} tokens or {MAX_BYTES} bytes of them: {held}")
        rows = table.select("id", "token").toArrow().sort_by("id")
        ids = rows.column("id").combine_chunks().cast(pa.int32())
        tokens = rows.column("token").combine_chunks().cast(pa.string())
        self.size = rows.num_rows
        self._known = (ids, tokens)
        shared = table.sparkSession.sparkContext.broadcast((ids, tokens))

        @F.arrow_udf("array<int>")
        def to_ids(values: pa.Array) -> pa.Array:
            known, names = shared.value

            def look_up(flat: pa.Array) -> pa.Array:
                place = pc.index_in(flat.cast(pa.string()), value_set=names)
                return pc.fill_null(pc.take(known, place), fixed.UNK_ID)

            return _map_flat(values, look_up)

        @F.arrow_udf("array<string>")
        def to_tokens(values: pa.Array) -> pa.Array:
            known, names = shared.value
            return _map_flat(values, lambda flat: pc.take(names, pc.index_in(flat, value_set=known)))

        self._to_ids, self._to_tokens = to_ids, to_tokens

    def as_dict(self) -> dict[str, int]:
        known, names = self._known
        return dict(zip(names.to_pylist(), known.to_pylist()))

    def ids(self, tokens: Column) -> Column:
        """Token ids, the unknown id for tokens outside the vocabulary."""
        return self._to_ids(tokens)

    def encode(self, tokens: Column, max_length: int = fixed.ENCODE_MAX_LENGTH, specials: bool = True) -> Column:
        """Ids cut to ``max_length``, start and end included. Cut before the lookup."""
        if not specials:
            return self.ids(F.slice(tokens, 1, max_length))
        inner = self.ids(F.slice(tokens, 1, max_length - 2))
        return F.concat(F.array(F.lit(fixed.BOS_ID)), inner, F.array(F.lit(fixed.EOS_ID)))

    def decode(self, ids: Column) -> Column:
        """Tokens of the ids joined by spaces, special ids left out."""
        specials = len(fixed.SPECIAL_TOKENS)
        return F.array_join(self._to_tokens(F.filter(ids, lambda i: i >= specials)), " ")


def pad(df: DataFrame, ids: str, max_length: int) -> DataFrame:
    """Replaces ``ids`` by ``input_ids`` of equal length plus the ``attention_mask``."""
    used, rest = F.size(ids), F.lit(max_length) - F.size(ids)
    return df.select(
        *[c for c in df.columns if c != ids],
        F.concat(F.col(ids), F.array_repeat(F.lit(fixed.PAD_ID), rest)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), rest)).alias("attention_mask"),
    )


def encode_some(tokenizer, values: pa.Array) -> pa.Array:
    """Ids of the texts, NULL as ''; so many texts at a time that their encodings stay small.

    An encoding holds every token of its text with its places before it is cut, many times the text.
    """
    done, texts, size = [], [], 0
    for value in values:
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= ENCODE_BYTES or len(texts) >= ENCODE_TEXTS:
            done.append(pa.array([e.ids for e in tokenizer.encode_batch(texts)], pa.list_(pa.int32())))
            texts, size = [], 0
    done.append(pa.array([e.ids for e in tokenizer.encode_batch(texts)] if texts else [], pa.list_(pa.int32())))
    return pa.concat_arrays(done)


def pretrained_encoder(spark, tokenizer_json: str, max_length: int, do_clean: bool = True):
    """Column function encoding with a ready-made tokenizer definition (its JSON text).

    The definition is broadcast and built once per Python worker; texts arrive in
    Arrow batches.
    """
    try:
        import tokenizers  # noqa: F401
    except ImportError as error:
        raise ImportError("the tokenizers package is needed for pretrained encoding") from error
    shared = spark.sparkContext.broadcast(tokenizer_json)
    built: list = []

    @F.arrow_udf("array<int>")
    def run(values: pa.Array) -> pa.Array:
        if not built:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(shared.value)
            tokenizer.enable_truncation(max_length)
            built.append(tokenizer)
        return encode_some(built[0], values)

    return lambda text: run(clean_text(text) if do_clean else text)
