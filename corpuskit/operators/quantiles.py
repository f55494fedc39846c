"""Exact quantiles per group, also for groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.session import durable

_CELLS_PER_E = 64
_FINER = 4096
SMALL_CELL = 100_000
_INFINITE_CELL = 1 << 20


def _cell(value: Column) -> Column:
    """Coarse cell that never decreases as the value grows."""
    scaled = F.floor(F.signum(value) * F.log1p(F.abs(value)) * _CELLS_PER_E)
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(infinite, F.signum(value) * _INFINITE_CELL).otherwise(scaled).cast("bigint")


def _finer_cell() -> Column:
    """Cells of equal width between the least and the greatest value of a cell."""
    width = F.col("_high") - F.col("_low")
    # Halves, so that the width of a cell from the least to the greatest double stays finite.
    share = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
    return F.when(width == 0, 0).otherwise(F.floor(share * _FINER)).cast("bigint")


def group_quantiles(
    df: DataFrame, by: Sequence[str], value: str, quantiles: dict[str, float], small_cell: int = SMALL_CELL
) -> DataFrame:
    """Interpolated quantiles, one column each; NULL and NaN are ignored.

    Infinite values take part as least and greatest; between a finite and an infinite
    neighbour the quantile is infinite. Equal values are counted before the shuffle. Counts
    per coarse cell of the value tell in which cell each wanted rank lies. Cells that still
    hold more than ``small_cell`` distinct values are cut into 4,096 finer ones, again and
    again; then only the wanted cells are put in order. Runs jobs while it is called.
    """
    by = list(by)
    v = F.col(value).cast("double")
    counted = durable(
        df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*by, v.alias("_v")).agg(F.count("*").alias("_n")), "values"
    )
    ranks = counted.groupBy(*by).agg(F.sum("_n").alias("_total"))
    position = {name: F.lit(q) * (F.col("_total") - 1) for name, q in quantiles.items()}
    ends = {f"_{name}_{side}": f(p).cast("bigint") for name, p in position.items() for side, f in (("lo", F.floor), ("hi", F.ceil))}
    wanted = F.array_distinct(F.array(*ends.values()))
    # All of a group is one cell to begin with; the ranks are those within the cell.
    cells = ranks.select(*by, F.lit(0).cast("bigint").alias("_at"), F.lit(0).cast("bigint").alias("_start"), wanted.alias("_ranks"))
    values = counted.withColumns({"_at": F.lit(0).cast("bigint"), "_fine": _cell(F.col("_v"))})
    while True:
        cells, values, most = _refined(values, cells, by)
        if most <= small_cell:
            break
        values = values.withColumn("_fine", _finer_cell())
    in_cell = Window.partitionBy(*by, "_at").orderBy("_v")
    placed = (
        values.join(cells, [*by, "_at"])
        .withColumn("_from", F.col("_start") + F.sum("_n").over(in_cell) - F.col("_n"))
        .withColumn("_to", F.col("_from") + F.col("_n"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v")))

    found = placed.join(ranks, by) if by else placed.join(F.broadcast(ranks))
    found = found.groupBy(*by).agg(F.max("_total").alias("_total"), *[at(rank).alias(name) for name, rank in ends.items()])

    def between(name: str, p: Column) -> Column:
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return F.when(low == high, low).otherwise(low + (p - F.floor(p)) * (high - low))

    return found.select(*by, *[between(name, p).alias(name) for name, p in position.items()])


def _refined(values: DataFrame, cells: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame, int]:
    """Cells by ``_fine`` that hold wanted ranks, their values, and the most values in one of them."""
    inside = Window.partitionBy(*by, "_at")
    sums = values.groupBy(*by, "_at", "_fine").agg(
        F.sum("_n").alias("_cell_n"), F.count("*").alias("_k"), F.min("_v").alias("_v0"), F.max("_v").alias("_v1")
    )
    placed = sums.join(cells, [*by, "_at"]).withColumn(
        "_first", F.col("_start") + F.sum("_cell_n").over(inside.orderBy("_fine")) - F.col("_cell_n")
    )
    end = F.col("_first") + F.col("_cell_n")
    here = F.filter("_ranks", lambda r: (r >= F.col("_first")) & (r < end))
    kept = placed.withColumn("_ranks", here).filter(F.size("_ranks") > 0)
    kept = kept.withColumn("_next", F.xxhash64("_at", "_fine"))
    kept = durable(kept.select(*by, "_at", "_fine", "_next", F.col("_first").alias("_start"), "_ranks", "_k", "_v0", "_v1"), "cells")
    most = kept.agg(F.max(F.when(F.col("_v0") < F.col("_v1"), F.col("_k")))).first()[0] or 0
    reached = kept.select(*by, "_at", "_fine", "_next", F.col("_v0").alias("_low"), F.col("_v1").alias("_high"))
    values = values.select(*by, "_at", "_fine", "_v", "_n").join(reached, [*by, "_at", "_fine"])
    values = durable(values.select(*by, "_v", "_n", F.col("_next").alias("_at"), "_low", "_high"), "cell-values")
    return kept.select(*by, F.col("_next").alias("_at"), "_start", "_ranks"), values, most
