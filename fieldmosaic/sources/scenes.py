"""Land-cover scenes on disk: Parquet by calendar month and coarse tile, of which a job reads what its points need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .writers import write_partitioned

#: Cells along a tile's side; partitions that are broadcast to prune a scan.
TILE, FEW_PARTITIONS = 32, 200_000
_KEYS = ["month", "tile_x", "tile_y"]


def _tile(cell: str, tile: int) -> Column:
    return F.floor(F.col(cell) / tile).cast("int")


def _month(day: Column) -> Column:
    """Months as numbers, 201904 for April 2019."""
    return F.year(day) * 100 + F.month(day)


def write_scenes(scenes: DataFrame, root: str, tile: int = TILE, mode: str = "append", rows: int = 2_000_000) -> None:
    """scenes (cx, cy, scene_ts, label) to a folder for each month and tile, sorted by cell and time within each file.

    Scenes without a time or a cell have no place in the store and are left out.
    """
    placed = scenes.select("cx", "cy", "scene_ts", "label", _month(F.col("scene_ts")).alias("month"), _tile("cx", tile).alias("tile_x"), _tile("cy", tile).alias("tile_y"))
    write_partitioned(placed.where("month is not null and tile_x is not null and tile_y is not null"), root, _KEYS, rows, mode, order=["cx", "cy", "scene_ts"])


def read_scenes(spark: SparkSession, root: str) -> DataFrame:
    """cx, cy, scene_ts, label, month, tile_x, tile_y."""
    return spark.read.parquet(root)


def scenes_near(points: DataFrame, root: str, stage: Callable[[DataFrame], DataFrame], months: int = 3, tile: int = TILE, radius: int = 0, first: str = "2017-01-01", last: str = "2024-12-31") -> DataFrame:
    """The store's scenes that points (cx, cy, date) from first to last may need: of the tiles within so many cells of
    theirs, from `months` before their date on.

    The months and tiles of all points are listed and written first; the scan takes them as a filter on its partitions
    at run time, so that folders of no point aren't read. tile must be what the store was written with.
    """
    start = F.trunc(F.add_months("date", -months), "month")
    wanted = points.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).select("cx", "cy", F.explode(F.sequence(start, F.trunc("date", "month"), F.expr("interval 1 month"))).alias("m"))
    for c in ("x", "y"):
        low, high = (F.floor((F.col(f"c{c}") + d) / tile).cast("int") for d in (-radius, radius))
        wanted = wanted.withColumn(f"tile_{c}", F.explode(F.sequence(low, high)))
    needed = stage(wanted.select(_month(F.col("m")).alias("month"), "tile_x", "tile_y").distinct())
    few = needed.limit(FEW_PARTITIONS + 1).count() <= FEW_PARTITIONS
    # The period is a filter that the optimiser can see on both sides; without one it wouldn't look for partitions.
    since = F.add_months(F.lit(first).cast("date"), -months)
    inside = needed.where(F.col("month").between(_month(since), _month(F.lit(last).cast("date"))))
    return read_scenes(points.sparkSession, root).join(F.broadcast(inside) if few else inside, _KEYS, "left_semi").select("cx", "cy", "scene_ts", "label")
