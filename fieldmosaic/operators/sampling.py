"""Reproducible background points and dates by integer hashing; nothing depends on partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spatial
from .ranges import running
from .spatial import any_index, bounding_box, in_any, points_in_any


#: Ids below it give unlike draws.
_MOST_IDS = 400_000_000


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) for each key below 3.4e9."""
    return F.pmod(key * F.lit(2654435761) + F.lit(seed), F.lit(4294967296)) / F.lit(4294967296.0)


def with_random_date(df: DataFrame, key: str = "id", seed: int = 123, first: str = "2017-01-01", last: str = "2024-12-31") -> DataFrame:
    """rand, obs_date: first plus the floor of rand times the days up to last, so last itself isn't reached."""
    days = F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date"))
    drawn = df.withColumn("rand", uniform(F.col(key), seed))
    return drawn.withColumn("obs_date", F.date_format(F.date_add(F.lit(first).cast("date"), F.floor(F.col("rand") * days).cast("int")), "yyyy-MM-dd"))


def background_points(spark: SparkSession, vertices: DataFrame, edges: DataFrame, n: int, seed: int = 42, stage: Callable[[DataFrame], DataFrame] | None = None, band: float = 0.25) -> DataFrame:
    """id, longitude, latitude: the first n of a sequence of uniform points in the bounding box that are in a polygon.

    Candidates are drawn in growing numbers until there are enough, in the order of id. ValueError if the polygons take
    up so little of the box that a thousand candidates for each point, or the ids that the draws allow, don't do. stage:
    writes a frame and reads it again; without it, candidates are tested as often as they are used.
    """
    box = bounding_box(vertices).first()
    if box.x_min is None or n > _MOST_IDS // 2:
        raise ValueError("no polygons to draw points in" if box.x_min is None else f"at most {_MOST_IDS // 2} points")
    index, levels = any_index(edges, band, stage)
    tried = 2 * n
    while tried <= min(2000 * n, _MOST_IDS):
        ids = spark.range(tried)
        # Two draws from unlike multiples of the id, as one sequence would lie on few lines.
        x, y = uniform(F.col("id") * 7 + 1, seed), uniform(F.pmod(F.col("id") * F.col("id") * 31 + F.col("id") * 13 + 5, F.lit(3_000_000_000)), seed + 1)
        drawn = ids.select(F.col("id").alias("obs_id"), (box.x_min + x * (box.x_max - box.x_min)).alias("longitude"), (box.y_min + y * (box.y_max - box.y_min)).alias("latitude"))
        found = in_any(drawn, index, levels, band)
        found = stage(found) if stage else found
        last = _nth(found, n)
        if last is not None:
            return found.where(F.col("obs_id") <= last).withColumnRenamed("obs_id", "id")
        tried *= 4
    raise ValueError(f"fewer than {n} of {tried // 4} points are in a polygon")


def _nth(df: DataFrame, n: int, block: int = 65_536) -> int | None:
    """The n-th smallest obs_id, if there are so many; all are different and not below 0. Counts of blocks of ids come first."""
    for r in sorted(df.groupBy(F.floor(F.col("obs_id") / block).alias("b")).count().collect()):
        if n <= r["count"]:
            own = df.where((F.col("obs_id") >= r["b"] * block) & (F.col("obs_id") < (r["b"] + 1) * block))
            return sorted(x[0] for x in own.select("obs_id").collect())[n - 1]
        n -= r["count"]
    return None


#: The share of draws that should be in a polygon at least, and cells that a cover of thin polygons may have for it.
_HIT, _MOST_CELLS = 0.005, 4_000_000


def _area_cells(edges: DataFrame, size: float, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """gx, gy, full, weight, upto of the cells of that size that polygons are in: full if a polygon holds all of it, weight is
    a cell's share of the sphere (in radians of longitude times the sine of latitude), upto the sum in the order of gy, then
    gx."""
    index, _ = spatial.cover(edges, size, stage)
    up = F.pow(F.lit(float(spatial.FACTOR)), F.col("level"))
    own = index.select(*[F.floor(F.col(c) / up).alias(c) for c in ("gx", "gy")], ((F.col("level") == 0) & F.col("x1").isNull()).alias("full"))
    cells = own.groupBy("gx", "gy").agg(F.max("full").alias("full"))
    sine = lambda row: F.sin(F.radians(F.greatest(F.least((row + spatial.SHIFT_Y) * size, F.lit(90.0)), F.lit(-90.0))))
    weighted = stage(cells.withColumn("weight", (sine(F.col("gy") + 1) - sine(F.col("gy"))) * F.radians(F.lit(size))))
    return stage(running(weighted, [], "gy", {"upto": F.col("weight")}, ties=["gx"]))


def points_by_area(spark: SparkSession, edges: DataFrame, n: int, stage: Callable[[DataFrame], DataFrame], seed: int = 42, size: float = 0.25) -> DataFrame:
    """id, longitude, latitude: the first n of a sequence of points that are uniform, by area on the sphere, in the polygons.

    A draw picks a cell of the polygons' cover by cumulated area and then a place in it; only where a border crosses the
    cell can it be outside. Where polygons are so thin that few draws would be inside, cells are made smaller first. Each
    place of several polygons counts once. ValueError if the polygons have no area.
    """
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    area = F.abs(F.sum((x1 * F.sin(F.radians(y2)) - x2 * F.sin(F.radians(y1))) / 2)) * F.radians(F.lit(1.0))
    least = edges.groupBy("poly_id").agg(area.alias("a")).agg(F.max("a")).first()[0] or 0.0
    if not least > 1e-18 or n > _MOST_IDS // 2:
        raise ValueError("no area to draw points in" if n <= _MOST_IDS // 2 else f"at most {_MOST_IDS // 2} points")
    while True:
        cells = _area_cells(edges, size, stage)
        whole, count, full = cells.agg(F.max("upto"), F.count("*"), F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))), F.lit(0.0))).first()
        if max(least, full) / whole >= _HIT or count * spatial.FACTOR > _MOST_CELLS:
            break
        size /= spatial.FACTOR
    step = whole / count
    spans = cells.select("gx", "gy", (F.col("upto") - F.col("weight")).alias("low"), F.col("upto").alias("high"))
    spans = spans.select("*", F.explode(F.sequence(F.floor(F.col("low") / step), F.floor(F.col("high") / step))).alias("slot"))
    tried = 2 * n
    while tried <= _MOST_IDS:
        # Three draws from unlike multiples of the id; those of a place are taken at finer grain than those of a cell.
        i = F.col("obs_id")
        u = [uniform(i * 7 + 1, seed), uniform(F.pmod(i * i * 31 + i * 13 + 5, F.lit(3_000_000_000)), seed + 1), uniform(F.pmod(i * i * 17 + i * 29 + 11, F.lit(3_000_000_000)), seed + 2)]
        drawn = spark.range(tried).select(F.col("id").alias("obs_id")).select("obs_id", (u[0] * whole).alias("at"), u[1].alias("u"), u[2].alias("v")).withColumn("slot", F.floor(F.col("at") / step))
        met = drawn.join(spans, "slot").where((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high")))
        low, high = (F.sin(F.radians((F.col("gy") + k + spatial.SHIFT_Y) * size)) for k in (0, 1))
        placed = met.select("obs_id", ((F.col("gx") + spatial.SHIFT_X + F.col("u")) * size).alias("longitude"), F.degrees(F.asin(low + F.col("v") * (high - low))).alias("latitude"))
        placed = stage(placed)
        found = stage(points_in_any(placed, edges, size, stage))
        if found.limit(n).count() >= n:
            return found.orderBy("obs_id").limit(n).withColumnRenamed("obs_id", "id")
        tried *= 4
    raise ValueError(f"fewer than {n} of {tried // 4} points are in a polygon")
