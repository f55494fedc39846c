"""Reproducible train / validation / test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.session import durable

_PREFIX = 4  # hex digits: 65,536 buckets


def _check(ratios: dict[str, float]) -> None:
    if abs(sum(ratios.values()) - 1.0) > 1e-9 or min(ratios.values()) < 0:
        raise ValueError("ratios must be non-negative and sum to 1")


def shuffle_hash(key: str, seed: int) -> Column:
    """Hash that orders rows at random, the same way for the same seed."""
    return F.sha2(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")), 256)


def exact_split(
    df: DataFrame,
    key: str,
    *,
    ratios: dict[str, float] = fixed.SPLIT_RATIOS,
    seed: int = fixed.SPLIT_SEED,
) -> DataFrame:
    """Adds ``split`` with exact counts: test = ceil(n*t), validation = ceil(rest*v/(1-t)).

    Rows are ordered by a seeded hash of the unique ``key`` and cut twice, without
    sorting them. Counts per hash prefix (at most 65,536 rows) say which prefixes lie
    wholly on one side of a cut; only the at most two prefixes that a cut goes through
    are ranked, to find the hash at the cut. The last pass compares hashes, through a
    broadcast of the prefix table. The first two passes read the key column alone.
    """
    _check(ratios)
    hashed = df.withColumn("_h", shuffle_hash(key, seed)).withColumn("_prefix", F.substring("_h", 1, _PREFIX))
    counts = hashed.groupBy("_prefix").agg(F.count("*").alias("_n"))

    # One task, at most 65,536 rows.
    everything = Window.partitionBy(F.lit(0)).orderBy("_prefix")
    total = F.sum("_n").over(Window.partitionBy(F.lit(0)))
    portion = ratios["validation"] / (1 - ratios["test"]) if ratios["test"] < 1 else 0.0
    # Written down, as it is used twice and a second count would read all keys again.
    cuts = durable(
        counts.withColumn("_total", total)
        .withColumn("_before", F.sum("_n").over(everything) - F.col("_n"))
        .withColumn("_test_end", F.ceil(F.col("_total") * F.lit(ratios["test"])))
        .withColumn("_val_end", F.col("_test_end") + F.ceil((F.col("_total") - F.col("_test_end")) * F.lit(portion)))
        .select(
            "_prefix",
            "_n",
            (F.col("_test_end") - F.col("_before")).alias("_test_in"),
            (F.col("_val_end") - F.col("_before")).alias("_val_in"),
        ),
        "cuts",
    )

    def cut_inside(inside: str) -> Column:
        return (F.col(inside) > 0) & (F.col(inside) < F.col("_n"))

    crossed = cuts.filter(cut_inside("_test_in") | cut_inside("_val_in"))
    ranked = (
        hashed.select("_prefix", "_h")
        .join(F.broadcast(crossed), "_prefix")
        .withColumn("_rank", F.row_number().over(Window.partitionBy("_prefix").orderBy("_h")))
    )
    at_cut = ranked.groupBy("_prefix").agg(
        F.max(F.when(F.col("_rank") == F.col("_test_in"), F.col("_h"))).alias("_test_h"),
        F.max(F.when(F.col("_rank") == F.col("_val_in"), F.col("_h"))).alias("_val_h"),
    )

    def within(inside: str, last_hash: str) -> Column:
        return (F.col(inside) >= F.col("_n")) | (cut_inside(inside) & (F.col("_h") <= F.col(last_hash)))

    name = (
        F.when(within("_test_in", "_test_h"), "test")
        .when(within("_val_in", "_val_h"), "validation")
        .otherwise("train")
    )
    return (
        hashed.join(F.broadcast(cuts.join(at_cut, "_prefix", "left")), "_prefix")
        .withColumn("split", name)
        .select(*df.columns, "split")
    )


def unit_hash(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    return F.conv(F.substring(shuffle_hash(key, seed), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def threshold_split(
    df: DataFrame,
    key: str,
    *,
    ratios: dict[str, float] = fixed.SPLIT_RATIOS,
    seed: int = fixed.SPLIT_SEED,
) -> DataFrame:
    """Adds ``split`` from the key alone: no shuffle, stable as rows are added, counts approximate."""
    _check(ratios)
    u = unit_hash(key, seed)
    name = (
        F.when(u < ratios["test"], "test")
        .when(u < ratios["test"] + ratios["validation"], "validation")
        .otherwise("train")
    )
    return df.withColumn("split", name)


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = fixed.SPLIT_SEED) -> DataFrame:
    """A reproducible subset for trial runs."""
    return df.filter(unit_hash(key, seed) < fraction)


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"))


def split_leakage(df: DataFrame, content_hash: Column) -> DataFrame:
    """For each pair of splits, how many distinct contents are in both. One shuffle."""
    names = sorted(fixed.SPLIT_RATIOS)
    where = df.groupBy(content_hash.alias("_c")).agg(
        *[F.max(F.when(F.col("split") == s, 1).otherwise(0)).alias(s) for s in names]
    )
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    shared = where.agg(
        *[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).alias(f"{a}_{b}") for a, b in pairs]
    )
    return shared.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("split_a"), F.lit(b).alias("split_b"),
                        F.col(f"{a}_{b}").alias("shared_contents"),
                    )
                    for a, b in pairs
                ]
            )
        )
    )
