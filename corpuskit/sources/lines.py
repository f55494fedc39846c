"""Line-delimited JSON: lines, records, and what could not be read."""

from __future__ import annotations

import codecs

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions.text import strip_ends

RECORD_SCHEMA = "struct<body:string,parsed_content:string>"
_JSON_OPTIONS = {"allowSingleQuotes": "false"}
_WIDE = ("utf-16", "utf-32")


def _decoder(encoding: str):
    name = codecs.lookup(encoding).name

    @F.arrow_udf("string")
    def decode(values: pa.Array) -> pa.Array:
        def one(raw: bytes | None) -> str | None:
            try:
                return None if raw is None else raw.decode(name)
            except UnicodeDecodeError:
                return None

        return pa.array([one(v) for v in values.to_pylist()], pa.string())

    return decode


def _with_line_key(raw: DataFrame, *columns: Column) -> DataFrame:
    # Files have no row number. File, block within the file, and the row's place in
    # the scan order lines the way a reader going through the files would.
    return raw.select(
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("line_key"),
        *columns,
    )


def read_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """``(line_key, value)`` per line. Fails at once when the path does not exist.

    Lines that are not valid in the encoding come back with a NULL value. Any encoding
    that keeps the newline byte to itself can be split across tasks; UTF-16 and UTF-32
    do not, see :func:`read_wide_records`.
    """
    name = codecs.lookup(encoding).name
    if name.startswith(_WIDE):
        raise ValueError(f"{encoding}: use read_wide_records")
    raw = spark.read.text(path)
    if name == "utf-8":
        value = F.when(F.is_valid_utf8("value"), F.col("value"))
    else:
        # The text source passes bytes through untouched, so they can be decoded here.
        value = _decoder(name)(F.col("value").cast("binary"))
    return _with_line_key(raw, value.alias("value"))


def read_wide_records(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """UTF-16 and UTF-32 files, through the JSON source: same columns as :func:`parse_lines`."""
    schema = "body string, parsed_content string, _rejected string"
    raw = (
        spark.read.schema(schema)
        .options(encoding=encoding, lineSep="\n", columnNameOfCorruptRecord="_rejected", **_JSON_OPTIONS)
        .json(path)
    )
    # The source refuses plans that need the rejected text alone; the second test is never
    # true and keeps a field in them.
    ok = ~(F.col("_rejected").isNotNull() | F.coalesce(F.length("body") < 0, F.lit(False)))
    return _with_line_key(
        raw,
        F.col("_rejected").alias("value"),
        F.when(ok, F.struct("body", "parsed_content")).alias("record"),
        F.when(~ok, "malformed_json").alias("reject_reason"),
    )


def stripped_lines(lines: DataFrame) -> DataFrame:
    """Whitespace off the ends, blank lines dropped. Undecodable lines (NULL) stay.

    A byte-order mark at the start of a line is dropped as well.
    """
    stripped = strip_ends(F.ltrim(F.col("value"), F.lit("\ufeff")))
    return lines.withColumn("value", stripped).filter(F.col("value").isNull() | (F.col("value") != ""))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds ``record`` (NULL when the line is no JSON object) and ``reject_reason``.

    The line is parsed as the only element of an array: that makes the parser reject
    whatever follows the object, which it would otherwise pass over. With a repeated
    key the last value wins.
    """
    stripped = stripped_lines(lines)
    parsed = stripped.withColumn(
        "_list",
        F.from_json(F.concat(F.lit("["), "value", F.lit("]")), f"array<{RECORD_SCHEMA}>", _JSON_OPTIONS),
    )
    one_object = (F.size("_list") == 1) & F.startswith(F.col("value"), F.lit("{")) & F.endswith(
        F.col("value"), F.lit("}")
    )
    record = F.when(one_object, F.element_at("_list", 1))
    reason = (
        F.when(record.isNotNull(), None)
        .when(F.col("value").isNull(), "undecodable")
        .when(F.startswith(F.col("value"), F.lit("{")), "malformed_json")
        .when(F.try_parse_json("value").isNotNull(), "not_an_object")
        .otherwise("malformed_json")
    )
    return parsed.select(*stripped.columns, record.alias("record"), reason.alias("reject_reason"))


def _present(column: Column) -> Column:
    # Same rows as a filter on "is not null". A filter would be pushed below the parse and
    # repeat it; a generator is evaluated once.
    return F.explode(F.array_compact(F.array(column)))


def _others(parsed: DataFrame) -> list[str]:
    return [c for c in parsed.columns if c not in ("value", "record", "reject_reason")]


def records(parsed: DataFrame) -> DataFrame:
    """The two text fields of every readable line; a missing or null field is ''."""
    kept = _others(parsed)
    return parsed.select(*kept, _present(F.col("record")).alias("record")).select(
        *kept,
        F.coalesce("record.body", F.lit("")).alias("body"),
        F.coalesce("record.parsed_content", F.lit("")).alias("parsed_content"),
    )


def quarantine(parsed: DataFrame) -> DataFrame:
    """The lines that were skipped, each with the reason."""
    kept = _others(parsed)
    skipped = F.when(F.col("reject_reason").isNotNull(), F.struct("value", "reject_reason"))
    return parsed.select(*kept, _present(skipped).alias("s")).select(*kept, "s.value", "s.reject_reason")


def line_count(lines: DataFrame) -> DataFrame:
    """Non-blank lines, malformed ones included."""
    return stripped_lines(lines).agg(F.count("*").alias("line_count"))


def first_rows(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """At most ``n`` rows, the first ones in the given order; all of them for None."""
    if n is None:
        return df
    return (df.orderBy(*order) if order else df).limit(n)
