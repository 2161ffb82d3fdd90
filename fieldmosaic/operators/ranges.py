"""Ranks and running sums in an order over all rows or a hot key, range by range instead of in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sums of ranges that are broadcast; more are joined by a shuffle.
BROADCAST_SUMS = 100_000


def place(df: DataFrame, order: str) -> Column:
    """Which range of the numeric column a row is in, from 0 on; nulls are in the first.

    Approximate quantiles cut the order into about as many ranges as there are shuffle partitions. The cuts only
    spread the work.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(df.approxQuantile(order, [k / parts for k in range(1, parts)], 0.01))) if parts > 1 else []

    def among(low: int, high: int) -> Column:
        """The number of cuts at or below the value, if it is from low to high: a search by halves."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(order) < F.lit(float(cuts[middle])), among(low, middle)).otherwise(among(middle + 1, high))

    return F.when(F.col(order).isNull(), 0).otherwise(among(0, len(cuts)))


def running(df: DataFrame, keys: list[str], order: str, sums: dict[str, Column], descending: bool = False, ties: list[str] | None = None, totals: dict[str, Column] | None = None) -> DataFrame:
    """df with, for each name of sums, the sum of its column over the key's rows up to this one in that order.

    order: a numeric column, then the columns of ties. totals: names of sums over all of the key's rows. Sums within a
    range are taken by a window of that range and shifted by the sums of the ranges before it, of which each key has
    few rows.
    """
    totals = totals or {}
    ranged = df.withColumn("__part", place(df, order))
    by = F.col(order).desc() if descending else F.col(order).asc()
    local = Window.partitionBy(*keys, "__part").orderBy(by, *(ties or [])).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumns({f"__{n}": F.sum(c).over(local) for n, c in sums.items()})
    parts = ranged.groupBy(*keys, "__part").agg(*[F.sum(c).alias(f"__sum_{n}") for n, c in sums.items()], *[F.sum(c).alias(f"__all_{n}") for n, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy(F.col("__part").desc() if descending else F.col("__part").asc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    shift = parts.select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__part").alias("__of"), *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__sum_{n}") for n in sums], *[F.sum(f"__all_{n}").over(whole).alias(n) for n in totals])
    # The shuffle by key and range is that of the windows only: few sums go to the rows where they are.
    few = shift.limit(BROADCAST_SUMS + 1).collect()
    if len(few) <= BROADCAST_SUMS:
        shift = F.broadcast(df.sparkSession.createDataFrame(few, shift.schema))
    on = F.col("__part") == F.col("__of")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    met = inside.join(shift, on).withColumns({n: F.col(f"__{n}") + F.col(f"__sum_{n}") for n in sums})
    return met.select(*df.columns, *sums, *totals)
