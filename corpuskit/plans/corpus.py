"""From raw lines to a tokenised, split dataset, and its quality report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.functions.text import apply_rules, content_hash, preprocess_text, training_text
from corpuskit.functions.tokens import tokens
from corpuskit.operators.dedup import first_occurrences
from corpuskit.operators.encoding import Vocabulary, pad
from corpuskit.operators.quality import quality_report
from corpuskit.operators.splits import exact_split
from corpuskit.operators.versions import fingerprint
from corpuskit.operators.vocabulary import learn_vocabulary
from corpuskit.session import durable, evaluated_once
from corpuskit.sources.lines import parse_lines, records
from corpuskit.sources.store import load_splits, save_report, save_splits


@dataclass(frozen=True)
class BuildConfig:
    """What a build does; the defaults are the usual build.

    ``dedup_key`` is ``body`` or ``body+parsed``; ``keep_empty`` lets rows with empty content
    be no duplicates of each other; ``rules`` are Column functions applied to both cleaned
    fields; without ``specials`` ids have no start and end.
    """

    html_mode: str = "parsed"
    clean_tokens: bool = True
    max_length: int = fixed.BUILD_MAX_LENGTH
    vocabulary_size: int = fixed.VOCABULARY_SIZE
    seed: int = fixed.SPLIT_SEED
    deduplicate: bool = True
    dedup_key: str = "body"
    keep_empty: bool = False
    rules: tuple[Callable[[Column], Column], ...] = ()
    ratios: Mapping[str, float] = field(default_factory=lambda: dict(fixed.SPLIT_RATIOS))
    specials: bool = True


@dataclass(frozen=True)
class Corpus:
    texts: DataFrame
    vocabulary_table: DataFrame
    vocabulary: Vocabulary
    encoded: DataFrame


def training_rows(lines: DataFrame, order: str, config: BuildConfig = BuildConfig()) -> DataFrame:
    """``(order, content_hash, text)``: parsed, cleaned, first of equal contents, not empty."""
    read = records(parse_lines(lines))

    def cleaned_field(name: str) -> Column:
        return apply_rules(preprocess_text(F.col(name), config.html_mode), config.rules).alias(name)

    cleaned = evaluated_once(read, [order], cleaned_field("body"), cleaned_field("parsed_content"))
    contents = {"body": F.col("body"), "body+parsed": F.concat_ws("\x1f", "body", "parsed_content")}
    content = contents[config.dedup_key]
    if config.deduplicate:
        empty = F.concat("body", "parsed_content") if config.dedup_key == "body+parsed" else content
        kept = first_occurrences(cleaned, F.when(empty == "", "").otherwise(content), order, keep_empty=config.keep_empty)
    else:
        kept = cleaned.withColumn("content_hash", content_hash(content))
    text = training_text(F.col("body"), F.col("parsed_content")).alias("text")
    return evaluated_once(kept, [order, "content_hash"], text).filter(F.col("text") != "")


def build(lines: DataFrame, order: str, config: BuildConfig = BuildConfig(), save_to: str | None = None) -> Corpus:
    """Everything up to padded ids per split; written to ``save_to`` when given.

    Texts and their tokens are written once. Splitting then reads only the key, learning the
    vocabulary only the tokens, and encoding only as many tokens as an encoded row can hold.
    Runs jobs while it is called.
    """
    rows = training_rows(lines, order, config).withColumn("tokens", tokens(F.col("text"), config.clean_tokens))
    cut = F.slice("tokens", 1, config.max_length).alias("first_tokens")
    # Equal contents are one row unless they are kept; then the order tells rows apart.
    unique = config.deduplicate and not config.keep_empty
    texts = exact_split(
        durable(rows.select("*", cut), "texts"), "content_hash" if unique else order, ratios=dict(config.ratios), seed=config.seed
    )
    table = durable(
        learn_vocabulary(texts.filter(F.col("split") == "train"), size=config.vocabulary_size), "vocabulary"
    )
    vocabulary = Vocabulary(table)
    ids = vocabulary.encode(F.col("first_tokens"), config.max_length, config.specials).alias("ids")
    encoded = pad(texts.select(order, "split", ids), "ids", config.max_length)
    if save_to is not None:
        save_splits(encoded, save_to)
        encoded = load_splits(lines.sparkSession, save_to)
    return Corpus(texts.drop("tokens", "first_tokens"), table, vocabulary, encoded)


def fingerprints(built: Corpus) -> DataFrame:
    """Fingerprint per split and of the vocabulary, which the ids mean nothing without."""
    ids = F.array_join(F.col("input_ids").cast("array<string>"), " ")
    words = built.vocabulary_table.withColumn("split", F.lit("vocabulary"))
    entry = F.concat_ws(" ", F.col("id").cast("string"), "token")
    return fingerprint(built.encoded, ids).unionByName(fingerprint(words, entry))


def validate(spark, dataset_path: str, vocab_size: int, report_path: str | None = None, mode: str = "padded") -> DataFrame:
    """Quality report of a written dataset, saved as JSON when a path is given."""
    report = quality_report(load_splits(spark, dataset_path), vocab_size, mode=mode)
    if report_path is not None:
        save_report(report, report_path)
    return report
