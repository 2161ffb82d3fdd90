"""Species-partitioned Parquet and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Keys whose counts are broadcast.
_FEW_KEYS = 200_000


def write_partitioned(df: DataFrame, root: str, key: str | list[str] = "scientific_name", rows: int = 2_000_000, mode: str = "append", order: list[str] | None = None) -> None:
    """Snappy Parquet, a folder for each key, with a file for about so many rows of it, in the given order if there is one.

    Rows are counted by key first, so a hot key is dealt over as many tasks as it needs, and a rare one is one file. df is
    gone through twice: write what is dear to compute to a folder before.
    """
    keys = [key] if isinstance(key, str) else key
    counts = df.groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys]).agg(F.ceil(F.count("*") / rows).cast("int").alias("__files"))
    found = counts.limit(_FEW_KEYS + 1).collect()
    if len(found) <= _FEW_KEYS:
        counts = F.broadcast(df.sparkSession.createDataFrame(found, counts.schema))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    # A row's own number, not its values, so that equal rows of a hot key are dealt out, too.
    salted = df.withColumn("__row", F.monotonically_increasing_id()).join(counts, on).withColumn("__salt", F.pmod(F.xxhash64("__row"), F.col("__files")))
    dealt = salted.repartition(parts, *keys, "__salt")
    dealt = dealt.sortWithinPartitions(*keys, *order) if order else dealt
    dealt.select(*df.columns).write.mode(mode).partitionBy(*keys).option("compression", "snappy").parquet(root)


def write_csv(df: DataFrame, path: str, rows: int, order: list[str]) -> None:
    """The first rows in that order, with a header."""
    df.orderBy(*order).limit(rows).write.mode("overwrite").option("header", True).csv(path)
