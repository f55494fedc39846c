"""Running values along an order, also where one key holds most of the rows.

A window function brings all rows of a key into one task. Here rows are dealt by ranges of
(key, order), each range runs its window alone, and what comes before a range is carried into
it: a segmented prefix scan. Ranges follow each other, so only the first key of a range has
earlier rows elsewhere, and there is one carry row a range at most, however many keys there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from corpuskit.session import durable

RANGE = "_range"

_KINDS = {"sum": F.sum, "max": F.max, "xor": F.bit_xor}


def _both(kind: str, a: Column, b: Column) -> Column:
    if kind == "max":
        return F.greatest(a, b)
    return F.coalesce(a + b if kind == "sum" else a.bitwiseXOR(b), a, b)


@dataclass(frozen=True)
class Ranged:
    """``rows`` with ``_range``, and ``edges``: for each range its first and last key and its last row."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    edges: tuple[Row, ...]
    edge_schema: object

    def having(self, rows: DataFrame) -> Ranged:
        """The same ranges with other columns."""
        return replace(self, rows=rows)

    def key(self) -> Column:
        return F.struct(*self.keys)

    def within(self) -> Window:
        return Window.partitionBy(RANGE, *self.keys).orderBy(*self.order)


def in_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None, last: Sequence[str] = ()
) -> Ranged:
    """The rows, written once, in ranges of (keys, order).

    Ranges are cut where a sample of the rows says, so they are about equal in size whatever a
    key holds; nulls come first, and rows equal in all of ``keys`` and ``order`` share a range.
    There are ``spark.sql.shuffle.partitions`` of them unless given; a row for each goes to the
    driver, with the columns ``last`` of the range's last row. An action.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *keys, *order)
    rows = durable(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")
    key, whole = F.struct(*keys), F.struct(*dict.fromkeys([*keys, *order, *last]))
    edges = rows.groupBy(RANGE).agg(F.min(key).alias("_first_key"), F.max(key).alias("_last_key"), F.max(whole).alias("_last_row"))
    return Ranged(rows, tuple(keys), tuple(order), tuple(sorted(edges.collect(), key=lambda r: r[RANGE])), edges.schema)


def previous(ranged: Ranged, names: Mapping[str, str]) -> Ranged:
    """Adds, under new names, columns of the row before in the same key (null for the first).

    ``names`` maps new names to columns of ``last`` as given to :func:`in_ranges`, or of the order.
    """
    spark = ranged.rows.sparkSession
    # The row before a range's first one is the last of the range before, if that ends with the same key.
    carried = [(b[RANGE], a["_last_row"]) for a, b in zip(ranged.edges, ranged.edges[1:]) if a["_last_key"] == b["_first_key"]]
    shape = f"_at int, _row {ranged.edge_schema['_last_row'].dataType.simpleString()}"
    before = spark.createDataFrame(carried, shape)
    local = ranged.rows.withColumns({n: F.lag(c).over(ranged.within()) for n, c in names.items()})
    local = local.withColumn("_place", F.row_number().over(ranged.within()))
    first_key = spark.createDataFrame([(e[RANGE], e["_first_key"]) for e in ranged.edges], f"_at int, _of {ranged.edge_schema['_first_key'].dataType.simpleString()}")
    heads = first_key.join(before, "_at")
    same = (F.col(RANGE) == F.col("_at")) & ranged.key().eqNullSafe(F.col("_of")) & (F.col("_place") == 1)
    met = local.join(F.broadcast(heads), same, "left")
    out = [F.when(F.col("_at").isNotNull(), F.col("_row")[c]).otherwise(F.col(n)).alias(n) for n, c in names.items()]
    return ranged.having(met.select(*[F.col(f"`{c}`") for c in ranged.rows.columns], *out))


def running(ranged: Ranged, values: Mapping[str, tuple[str, Column]], before: bool = False) -> DataFrame:
    """The rows with running ``values``: ``name -> (kind, column)``, kind ``sum``, ``max`` or ``xor``.

    Over each row and those before it in its key, or with ``before`` over those before it only
    (null for the first). Nulls do not count; rows that tie in the order come in any order.
    """
    spark, key = ranged.rows.sparkSession, ranged.key()
    taken = ranged.rows.withColumns({f"_in_{n}": column for n, (_, column) in values.items()})
    kind = ranged.edge_schema["_first_key"].dataType.simpleString()
    edges = spark.createDataFrame(
        [(e[RANGE], e["_first_key"], e["_last_key"]) for e in ranged.edges], f"{RANGE} int, _edge_first {kind}, _edge_last {kind}"
    )
    # Both edge keys of each range: two rows a range to compute the carries from, and one carry of them is used.
    at_edge = taken.join(F.broadcast(edges), RANGE).filter(key.eqNullSafe(F.col("_edge_first")) | key.eqNullSafe(F.col("_edge_last")))
    totals = at_edge.groupBy(RANGE, key.alias("_key")).agg(*[_KINDS[k](f"_in_{n}").alias(n) for n, (k, _) in values.items()])
    earlier = Window.partitionBy("_key").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        F.col(RANGE).alias("_at"),
        F.col("_key").alias("_of"),
        F.row_number().over(Window.partitionBy("_key").orderBy(RANGE)).alias("_no"),
        *[_KINDS[k](n).over(earlier).alias(f"_carry_{n}") for n, (k, _) in values.items()],
    ).filter("_no > 1")
    frame = ranged.within().rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    local = taken.withColumns({n: _KINDS[k](f"_in_{n}").over(frame) for n, (k, _) in values.items()})
    same = (F.col(RANGE) == F.col("_at")) & key.eqNullSafe(F.col("_of"))
    met = local.join(F.broadcast(carries), same, "left")
    return met.select(
        *[F.col(f"`{c}`") for c in ranged.rows.columns if c not in values],
        *[_both(k, F.col(n), F.col(f"_carry_{n}")).alias(n) for n, (k, _) in values.items()],
    )


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, ranges: int | None = None) -> DataFrame:
    """``df`` with each row's number from 1 in its key's order. An action."""
    return running(in_ranges(df, keys, order, ranges), {name: ("sum", F.lit(1).cast("bigint"))}).drop(RANGE)


def blocks_with_rows_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, block: int = 1 << 16, ranges: int | None = None
) -> DataFrame:
    """``df`` cut into blocks that a window over the last ``rows`` rows can run in alone. An action.

    Adds ``_n``, the row's number in its key, ``_block``, at most ``block + rows`` rows of one
    key, and ``_lead``: true for rows that are only there as those before a block's first ones.
    """
    if not 0 <= rows <= block:
        raise ValueError("rows must lie between 0 and block")
    told = numbered(df, keys, order, "_n", ranges)
    own = F.floor((F.col("_n") - 1) / block)
    lead_of = F.when(F.pmod(F.col("_n") - 1, F.lit(block)) >= block - rows, own + 1)
    in_blocks = F.array_compact(F.array(own, lead_of))
    return told.select("*", F.posexplode(in_blocks).alias("_at", "_block")).withColumn("_lead", F.col("_at") == 1).drop("_at")
