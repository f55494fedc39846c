"""Data-quality figures of a tokenised dataset, and checks on any table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.functions.text import is_blank


def _by_split(df: DataFrame) -> DataFrame:
    return df if "split" in df.columns else df.withColumn("split", F.lit("dataset"))


def _samples(encoded: DataFrame, mode: str) -> DataFrame:
    """``(split, ids)``: the whole padded array, or only the ids the mask marks as used."""
    if mode == "padded":
        ids = F.col("input_ids")
    elif mode == "masked":
        used = F.aggregate("attention_mask", F.lit(0), lambda acc, m: acc + m)
        ids = F.slice("input_ids", F.lit(1), used)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return _by_split(encoded).select("split", ids.alias("ids"))


def _length_columns(length: Column) -> list[Column]:
    # Lengths are bounded by max_length, so the exact median keeps few distinct values.
    return [
        F.count("*").alias("count"),
        F.avg(length).alias("mean"),
        F.median(length).alias("median"),
        F.coalesce(F.stddev_samp(length), F.lit(0.0)).alias("std"),
        F.min(length).alias("min"),
        F.max(length).alias("max"),
    ]


def _unknown_columns(ids: Column, unk_id: int | None) -> list[Column]:
    hits = F.size(F.filter(ids, lambda i: i == F.lit(unk_id))) if unk_id is not None else F.lit(0)
    unknown = F.coalesce(F.sum(hits), F.lit(0))
    total = F.coalesce(F.sum(F.size(ids)), F.lit(0))
    return [
        unknown.alias("unk_tokens"),
        total.alias("total_tokens"),
        F.coalesce(F.try_divide(unknown * 100.0, total), F.lit(0.0)).alias("pct_unk"),
    ]


def token_length_stats(encoded: DataFrame, mode: str = "padded") -> DataFrame:
    return _samples(encoded, mode).groupBy("split").agg(*_length_columns(F.size("ids")))


def unknown_stats(encoded: DataFrame, unk_id: int | None = fixed.UNK_ID, mode: str = "padded") -> DataFrame:
    return _samples(encoded, mode).groupBy("split").agg(*_unknown_columns(F.col("ids"), unk_id))


def vocabulary_coverage(
    encoded: DataFrame, vocab_size: int, mode: str = "padded", approximate: bool = False
) -> DataFrame:
    """Distinct ids over the vocabulary size. The shuffle holds at most one row per
    task, split and vocabulary id."""
    each = _samples(encoded, mode).select("split", F.explode(F.array_distinct("ids")).alias("id"))
    distinct = F.approx_count_distinct("id") if approximate else F.countDistinct("id")
    return (
        each.groupBy("split")
        .agg(distinct.alias("unique_tokens"))
        .withColumn("model_vocab_size", F.lit(vocab_size).cast("bigint"))
        .withColumn("coverage_pct", F.try_divide(F.col("unique_tokens") * 100.0, F.col("model_vocab_size")))
    )


def duplicate_stats(encoded: DataFrame, mode: str = "padded") -> DataFrame:
    """Rows in groups of identical ids, and the number of such groups. Groups are keyed
    by a digest, so only the digest and a partial count are shuffled."""
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    groups = _samples(encoded, mode).groupBy("split", digest.alias("d")).agg(F.count("*").alias("n"))
    repeated = F.col("n") > 1
    return groups.groupBy("split").agg(
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        F.count_if(repeated).alias("duplicate_variants"),
    )


def quality_report(
    encoded: DataFrame, vocab_size: int, unk_id: int | None = fixed.UNK_ID, mode: str = "padded"
) -> DataFrame:
    """One row per split (or one for ``dataset``) with all figures."""
    basic = (
        _samples(encoded, mode)
        .groupBy("split")
        .agg(*_length_columns(F.size("ids")), *_unknown_columns(F.col("ids"), unk_id))
    )
    return (
        basic.join(vocabulary_coverage(encoded, vocab_size, mode), "split", "left")
        .join(duplicate_stats(encoded, mode), "split", "left")
        .withColumn("duplicates", F.struct("duplicate_rows", "duplicate_variants"))
        .drop("duplicate_rows", "duplicate_variants")
    )


def corpus_stats(encoded: DataFrame, ids: str = "ids", unk_id: int | None = fixed.UNK_ID) -> DataFrame:
    """Average and largest number of ids and the share of unknown ones; zeros when empty."""
    length = F.size(ids)
    return encoded.agg(
        F.coalesce(F.avg(length), F.lit(0.0)).alias("avg_tokens"),
        F.coalesce(F.max(length), F.lit(0)).alias("max_tokens"),
        _unknown_columns(F.col(ids), unk_id)[2],
    )


@dataclass(frozen=True)
class Expectation:
    """What must hold for a column: a predicate per row, or uniqueness of its values."""

    column: str
    check: str
    holds: Column | None = None


def not_null(column: str) -> Expectation:
    return Expectation(column, "not_null", F.col(column).isNotNull())


def in_range(column: str, low, high) -> Expectation:
    return Expectation(column, "in_range", F.col(column).between(low, high))


def castable(column: str, sql_type: str) -> Expectation:
    as_text = F.col(column).cast("string")
    return Expectation(column, f"is_{sql_type}", as_text.isNull() | as_text.try_cast(sql_type).isNotNull())


def one_of(column: str, values: Sequence) -> Expectation:
    return Expectation(column, "one_of", F.col(column).isin(list(values)))


def unique(column: str) -> Expectation:
    return Expectation(column, "unique")


def check_expectations(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """``(column_name, check_name, failures)``.

    All row predicates share one scan. NULL fails ``not_null`` only. Uniqueness counts the
    rows beyond the first of each value, grouped by value with partial counts.
    """

    def row(e: Expectation, failures: Column) -> Column:
        return F.struct(
            F.lit(e.column).alias("column_name"), F.lit(e.check).alias("check_name"),
            failures.cast("bigint").alias("failures"),
        )

    results = []
    per_row = [e for e in expectations if e.holds is not None]
    if per_row:
        counts = df.agg(*[F.count_if(~F.coalesce(e.holds, F.lit(True))).alias(f"f{i}") for i, e in enumerate(per_row)])
        results.append(counts.select(F.inline(F.array(*[row(e, F.col(f"f{i}")) for i, e in enumerate(per_row)]))))
    for e in expectations:
        if e.holds is None:
            groups = df.filter(F.col(e.column).isNotNull()).groupBy(e.column).agg(F.count("*").alias("n"))
            extra = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
            results.append(extra.select(row(e, F.col("n")).alias("r")).select("r.*"))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def missing_references(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Rows of ``child`` whose key is set but absent from ``parent``."""
    return child.filter(F.col(on).isNotNull()).join(parent.select(on), on, "left_anti")


def stage_counts(lines: DataFrame, parsed: DataFrame, body: Column, text: Column, order: Column) -> DataFrame:
    """``(stage, rows)`` from raw lines to training rows, each drop with its reason.

    ``body`` is the processed body and ``text`` the training text of a parsed row, and
    ``order`` says which of equal bodies comes first. One pass over the lines and one over
    the parsed rows. Only a row with an empty body can have an empty text, and of those
    rows just the first is kept.
    """
    ok = F.col("record").isNotNull()
    counted = parsed.select(
        "reject_reason",
        F.when(ok, F.sha2(body, 256)).alias("content"),
        F.when(ok & (body == ""), text == "").alias("without_text"),
        F.when(ok & (body == ""), order).alias("empty_order"),
    ).agg(
        F.count("*").alias("not_blank"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
        F.countDistinct("content").alias("bodies"),
        F.coalesce(F.min_by("without_text", "empty_order"), F.lit(False)).cast("int").alias("empty"),
    )
    records = F.col("not_blank") - F.col("rejected")
    stages = {
        "rejected": F.col("rejected"),
        "records": records,
        "duplicate": records - F.col("bodies"),
        "empty": F.col("empty"),
        "training_rows": F.col("bodies") - F.col("empty"),
        "not_blank": F.col("not_blank"),
    }

    def rows(named: dict[str, Column]) -> Column:
        return F.inline(
            F.array(*[F.struct(F.lit(n).alias("stage"), v.cast("bigint").alias("rows")) for n, v in named.items()])
        )

    read = lines.agg(F.count("*").alias("n"), F.count_if(is_blank(F.col("value"))).alias("blank"))
    return read.select(rows({"lines": F.col("n"), "blank": F.col("blank")})).unionByName(
        counted.select(rows(stages))
    )
