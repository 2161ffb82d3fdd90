"""Training matrices, scaling and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import ranked
from .ranges import running


def matrix(df: DataFrame, drop: list[str], features: list[str]) -> DataFrame:
    """Without the metadata columns that are there; missing features, nulls and NaN are 0."""
    out = df.drop(*drop)
    for f in features:
        if f not in out.columns:
            out = out.withColumn(f, F.lit(0.0))
    return out.na.fill(0, subset=features)


def _number(c: str):
    """The column without NaN, which aggregates would take for a value."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def minmax(df: DataFrame, columns: list[str], top: float = 100.0) -> DataFrame:
    """Scaled to 0..top; a constant column becomes 0. One row of ranges is broadcast. Nulls and NaN stay as they are."""
    bounds = df.agg(*[f(_number(c)).alias(f"__{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])
    scaled = {c: F.when(F.col(f"__max_{c}") > F.col(f"__min_{c}"), (F.col(c) - F.col(f"__min_{c}")) / F.nullif(F.col(f"__max_{c}") - F.col(f"__min_{c}"), F.lit(0.0)) * top).otherwise(F.when(_number(c).isNull(), F.col(c)).otherwise(F.lit(0.0))) for c in columns}
    return df.join(F.broadcast(bounds)).withColumns(scaled).drop(*bounds.columns)


def standard(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Mean 0 and population deviation 1, within each key if there are keys; a constant column becomes 0. Nulls and NaN
    stay as they are and don't count."""
    keys = keys or []
    stats = df.groupBy(*keys).agg(*[f(_number(c)).alias(f"__{n}_{c}") for c in columns for n, f in (("avg", F.avg), ("sd", F.stddev_pop))])
    scaled = {c: F.when(F.col(f"__sd_{c}") > 0, (F.col(c) - F.col(f"__avg_{c}")) / F.nullif(F.col(f"__sd_{c}"), F.lit(0.0))).otherwise(F.when(_number(c).isNull(), F.col(c)).otherwise(F.lit(0.0))) for c in columns}
    joined = df.join(stats, keys) if keys else df.join(F.broadcast(stats))
    return joined.withColumns(scaled).drop(*[c for c in stats.columns if c not in keys])


def scaler(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """keys, means, deviations (population; arrays in the order of the columns): what scaling new rows takes. Nulls and
    NaN don't count."""
    return df.groupBy(*keys).agg(F.array(*[F.avg(_number(c)) for c in columns]).alias("means"), F.array(*[F.stddev_pop(_number(c)) for c in columns]).alias("deviations"))


def by_stored(value: Column, mean: Column, deviation: Column) -> Column:
    """A value scaled by a stored mean and deviation, as standard() does: 0 if the deviation is 0; raw without a mean."""
    return F.when(mean.isNull(), value).when(deviation > 0, (value - mean) / F.nullif(deviation, F.lit(0.0))).otherwise(F.when(value.isNull() | F.isnan(value), value).otherwise(F.lit(0.0)))


def scaled(df: DataFrame, table: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """df with its columns scaled by what scaler() gave, of these rows or others; keys it doesn't hold stay raw."""
    named = table.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("means").alias("__means"), F.col("deviations").alias("__deviations"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    new = {c: by_stored(F.col(c), F.col("__means")[k], F.col("__deviations")[k]) for k, c in enumerate(columns)}
    return df.join(named, on, "left").withColumns(new).select(*df.columns)


def stratified_folds(df: DataFrame, keys: list[str], label: str = "label", n: int = 5, seed: int = 42, row: str = "id") -> DataFrame:
    """fold 0..n-1: rows of each key and label dealt out in the order of a hash of their id (below 3.4e9)."""
    hashed = df.withColumn("__hash", F.pmod(F.col(row) * F.lit(2654435761) + F.lit(seed), F.lit(4294967296)))
    found = running(hashed, [*keys, label], "__hash", {"__upto": F.lit(1)}, ties=[row])
    return found.withColumn("fold", ((F.col("__upto") - 1) % n).cast("int")).drop("__hash", "__upto")


def contiguous_folds(df: DataFrame, n: int = 5, row: str = "id") -> DataFrame:
    """fold 0..n-1: consecutive stretches in the order of the row's id; the first ones take what is left over."""
    found = ranked(df, row)
    size, rest = F.floor(F.col("__n") / n), F.col("__n") % n
    wide = rest * (size + 1)
    fold = F.when(F.col("__rank") < wide, F.floor(F.col("__rank") / (size + 1))).otherwise(rest + F.floor((F.col("__rank") - wide) / F.greatest(size, F.lit(1))))
    return found.withColumn("fold", fold.cast("int")).drop("__rank", "__n")
