"""Land cover from a long table of scenes: cells (cx, cy), scene time and a class label 0 to 8; class 1 is forest."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLASSES, FOREST = range(9), 1


def disk(radius: int) -> list[tuple[int, int]]:
    """Cell offsets within a radius."""
    return [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if x * x + y * y <= radius * radius]


def _around(radius: int) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x, y in disk(radius)]))


def spread(df: DataFrame, radius: int) -> DataFrame:
    """Each row once for every cell within the radius, with that cell's nx, ny."""
    return df.withColumn("__d", _around(radius)).withColumns({"nx": F.col("cx") + F.col("__d.dx"), "ny": F.col("cy") + F.col("__d.dy")}).drop("__d")


def mode(df: DataFrame, keys: list[str]) -> DataFrame:
    """The most frequent label of each key; of ties the lowest. Counts come first, so that a hot key is few rows."""
    counts = df.groupBy(*keys, "label").agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("label"))).alias("best")).select(*keys, F.col("best.label").alias("label"))


#: Cells that are broadcast to leave out the scenes of others.
_FEW_CELLS = 200_000


def of_cells(scenes: DataFrame, points: DataFrame) -> DataFrame:
    """The scenes of cells (cx, cy) that have points, as far as those are few enough to be sent to all tasks."""
    cells = points.select("cx", "cy").distinct()
    few = cells.limit(_FEW_CELLS + 1).collect()
    if len(few) > _FEW_CELLS:
        return scenes
    return scenes.join(F.broadcast(points.sparkSession.createDataFrame(few, cells.schema)), ["cx", "cy"], "left_semi")


def lookback(points: DataFrame, scenes: DataFrame, keys: list[str], months: int = 3) -> DataFrame:
    """keys and label: the mode of each point's cell (cx, cy) over the scenes of the months before its date.

    From `months` before the date up to, not including, the date. Modes are taken once for each cell and date that points
    have, however many those are: dates are copied to the calendar months that they need and meet scenes by cell and month
    only. Points then look theirs up. Rows that are equal in keys are one point: if they differ in place or date, their
    counts are added up.
    """
    of = ["cx", "cy", "date"]
    placed = points.groupBy(*keys).agg(F.count("*").alias("__rows"), F.min(F.struct(*of)).alias("__at"))
    own = [c for c in of if c not in keys]
    single = placed.where("__rows = 1").select(*keys, *[F.col("__at")[c].alias(c) for c in own])
    copied = placed.where("__rows > 1").select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    several = points.select(*keys, *own).join(copied, same, "left_semi")
    counts = _counts_before(points.select(*of).distinct(), of_cells(scenes, points), months)
    first = F.min(F.struct((-F.col("n")).alias("m"), F.col("label"))).alias("best")
    best = counts.groupBy(*of).agg(first)
    one = single.join(best, of).select(*keys, F.col("best.label").alias("label"))
    added = several.join(counts, of).groupBy(*keys, "label").agg(F.sum("n").alias("n"))
    return one.unionByName(added.groupBy(*keys).agg(first).select(*keys, F.col("best.label").alias("label")))


def _counts_before(wanted: DataFrame, scenes: DataFrame, months: int) -> DataFrame:
    """cx, cy, date, label, n: how often each label came in the months before the date, for cells and dates once each."""
    start = F.add_months("date", -months)
    wanted = wanted.select("cx", "cy", "date", F.explode(F.sequence(F.trunc(start, "month"), F.trunc("date", "month"), F.expr("interval 1 month"))).alias("month"))
    daily = scenes.groupBy("cx", "cy", F.to_date("scene_ts").alias("day"), "label").agg(F.count("*").alias("n")).withColumn("month", F.trunc("day", "month"))
    met = wanted.join(daily, ["cx", "cy", "month"]).where((F.col("day") >= F.add_months("date", -months)) & (F.col("day") < F.col("date")))
    return met.groupBy("cx", "cy", "date", "label").agg(F.sum("n").alias("n"))


def running_counts(scenes: DataFrame) -> DataFrame:
    """cx, cy, month, before, days: of each cell and calendar month between the first and last of all scenes, how often each
    label came before the month (an array by label), and the month's own counts (day, label, n).

    A month holds at most a count for each of its days and labels, and a cell a row for each month.
    """
    daily = scenes.where("label is not null").groupBy("cx", "cy", F.to_date("scene_ts").alias("day"), "label").agg(F.count("*").alias("n"))
    own = daily.groupBy("cx", "cy", F.trunc("day", "month").alias("month")).agg(F.collect_list(F.struct("day", "label", "n")).alias("days"), *[F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in CLASSES])
    span = daily.agg(F.trunc(F.min("day"), "month").alias("first"), F.trunc(F.max("day"), "month").alias("last"))
    every = daily.select("cx", "cy").distinct().join(F.broadcast(span)).select("cx", "cy", F.explode(F.sequence("first", F.add_months("last", 1), F.expr("interval 1 month"))).alias("month"))
    earlier = Window.partitionBy("cx", "cy").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    before = F.array(*[F.coalesce(F.sum(f"n{k}").over(earlier), F.lit(0)) for k in CLASSES])
    return every.join(own, ["cx", "cy", "month"], "left").select("cx", "cy", "month", before.alias("before"), "days")


def lookback_asof(points: DataFrame, counts: DataFrame, keys: list[str], months: int = 3) -> DataFrame:
    """What lookback() gives, from running_counts(): keys and label.

    Each cell and date that points have looks up how often each label of its cell came before the date, and before the
    start of its months; the difference is what came between. Points look up the result: they are neither copied by month
    nor grouped again.
    """
    of = ["cx", "cy", "date"]
    ends = counts.agg(F.min("month").alias("__first"), F.max("month").alias("__last"))
    wanted = points.select(*of).distinct().select(*of, F.col("date").alias("__to"), F.add_months("date", -months).alias("__from")).join(F.broadcast(ends))
    label = F.sequence(F.lit(0), F.lit(max(CLASSES)))

    def until(df: DataFrame, day: str, name: str) -> DataFrame:
        """df with counts by label before that day; beyond the months that are known, those of the nearest."""
        at = counts.select(F.col("cx").alias("__x"), F.col("cy").alias("__y"), F.col("month").alias("__m"), "before", "days")
        month = F.least(F.greatest(F.trunc(day, "month"), "__first"), "__last")
        met = df.join(at, (F.col("cx") == F.col("__x")) & (F.col("cy") == F.col("__y")) & (month == F.col("__m")))
        own = lambda k: F.aggregate(F.filter(F.col("days"), lambda d: (d["label"] == k) & (d["day"] < F.col(day))), F.lit(0).cast("long"), lambda s, d: s + d["n"])
        return met.withColumn(name, F.transform(label, lambda k: F.get("before", k) + F.coalesce(own(k), F.lit(0)))).drop("__x", "__y", "__m", "before", "days")

    met = until(until(wanted, "__to", "__upto"), "__from", "__less")
    between = F.zip_with("__upto", "__less", lambda a, b: a - b)
    best = F.array_max("__n")
    found = met.withColumn("__n", between).where(best > 0).select(*of, (F.array_position("__n", best) - 1).cast("int").alias("label"))
    return points.select(*keys, *[c for c in of if c not in keys]).join(found, of).select(*keys, "label")


def season(scenes: DataFrame, year: int, months: list[int], span: bool = False) -> DataFrame:
    """cx, cy, label: the mode over the given months of a year; span: over all months from the first to the last."""
    in_months = F.month("scene_ts").between(min(months), max(months)) if span else F.month("scene_ts").isin(months)
    return mode(scenes.where((F.year("scene_ts") == year) & in_months), ["cx", "cy"])


def percent_cover(cells: DataFrame, radius: int, keys: list[str] | None = None, name: str = "dw_class_{k}_pct_{r}") -> DataFrame:
    """keys, cx, cy and nine percentages of the known cells within the radius; where the cell itself is known.

    Each cell's label goes to the cells around it: one aggregation for all classes.
    """
    keys = keys or []
    near = spread(cells, radius).groupBy(*keys, F.col("nx").alias("cx"), F.col("ny").alias("cy")).agg(*[F.avg(F.when(F.col("label") == k, 100.0).otherwise(0.0)).alias(name.format(k=k, r=radius)) for k in CLASSES])
    return near.join(cells.select(*keys, "cx", "cy"), [*keys, "cx", "cy"], "left_semi")


def percent_cover_wide(cells: DataFrame, radius: int, name: str = "dw_class_{k}_pct_{r}") -> DataFrame:
    """As percent_cover() for large radii: prefix sums along rows, two lookups for each row of the disk.

    Work grows with the radius instead of its square. Counts are exact. Rows are known by the cells that exist; a
    prefix at a place without a cell is that of the last cell before it.
    """
    w = Window.partitionBy("cy").orderBy("cx")
    one = [F.when(F.col("label") == k, 1).otherwise(0) for k in CLASSES]
    prefix = cells.select("cx", "cy", F.row_number().over(w).alias("n"), *[F.sum(c).over(w).alias(f"s{k}") for k, c in zip(CLASSES, one)])
    until = prefix.select("cy", "cx", (F.lead("cx").over(w)).alias("next"), "n", *[f"s{k}" for k in CLASSES])
    spans = [(dy, int((radius * radius - dy * dy) ** 0.5)) for dy in range(-radius, radius + 1)]
    ends = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(x).alias("dx"), F.lit(s).alias("sign")) for dy, half in spans for x, s in ((half, 1), (-half - 1, -1))]))
    asked = cells.select("cx", "cy", ends.alias("e")).select("cx", "cy", (F.col("cy") + F.col("e.dy")).alias("row"), (F.col("cx") + F.col("e.dx")).alias("x"), F.col("e.sign").alias("sign"))
    # The last cell at or before x: both sides in one ordered window of the row.
    both = until.select(F.col("cy").alias("row"), F.col("cx").alias("x"), F.lit(0).alias("sign"), F.struct("n", *[f"s{k}" for k in CLASSES]).alias("p"), F.lit(None).cast("int").alias("cx"), F.lit(None).cast("int").alias("cy"))
    both = both.unionByName(asked.withColumn("p", F.lit(None).cast(both.schema["p"].dataType)))
    filled = both.withColumn("p", F.last("p", ignorenulls=True).over(Window.partitionBy("row").orderBy("x", F.abs("sign")).rowsBetween(Window.unboundedPreceding, 0))).where("sign <> 0")
    total = [F.sum(F.col("sign") * F.coalesce(F.col(f"p.{c}"), F.lit(0))).alias(c) for c in ("n", *[f"s{k}" for k in CLASSES])]
    return filled.groupBy("cx", "cy").agg(*total).select("cx", "cy", *[(F.col(f"s{k}") * 100.0 / F.col("n")).alias(name.format(k=k, r=radius)) for k in CLASSES])


def forest_core(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, cx, cy, core: 1 for forest cells with no known other class within one cell."""
    keys = keys or []
    other = spread(cells.where(F.col("label") != FOREST), 1).select(*keys, F.col("nx").alias("cx"), F.col("ny").alias("cy")).distinct().withColumn("near", F.lit(1))
    joined = cells.join(other, [*keys, "cx", "cy"], "left")
    return joined.select(*keys, "cx", "cy", F.when((F.col("label") == FOREST) & F.col("near").isNull(), 1).otherwise(0).alias("core"))


def forest_edge(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, cx, cy, edge: 1 for forest cells with another class on at least one of four sides."""
    keys = keys or []
    other = spread(cells.where(F.col("label") != FOREST), 1).where((F.col("nx") != F.col("cx")) | (F.col("ny") != F.col("cy")))
    other = other.select(*keys, F.col("nx").alias("cx"), F.col("ny").alias("cy")).distinct().withColumn("near", F.lit(1))
    joined = cells.join(other, [*keys, "cx", "cy"], "left")
    return joined.select(*keys, "cx", "cy", F.when((F.col("label") == FOREST) & F.col("near").isNotNull(), 1).otherwise(0).alias("edge"))


#: Cells along a tile's side; weights of the smoothing kernel along an axis (binomial, about one cell wide).
TILE, SMOOTH = 256, (1, 4, 6, 4, 1)
#: Least slope of a border, in units of the mask after smoothing by weights that sum to 256; the cells that it needs.
SLOPE, RIM = 128, 4


def _shift(a: np.ndarray, dx: int, dy: int) -> np.ndarray:
    """The value of each cell's neighbour at (dx, dy); nothing outside."""
    out = np.zeros_like(a)
    h, w = a.shape
    out[max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)] = a[max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)]
    return out


def canny(forest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared slope and thinned borders (0 or 1) of a dense 0/1 mask; all in whole numbers, so no sum is rounded.

    Smoothing by SMOOTH along both axes, Sobel slopes, and of cells with a slope of SLOPE or more those that no
    neighbour along the slope exceeds. The slope's direction is one of four, parted at 22.5 degrees (2414 / 1000).
    """
    v = forest.astype(np.int64)
    v = sum(w * _shift(v, d, 0) for w, d in zip(SMOOTH, range(-2, 3)))
    v = sum(w * _shift(v, 0, d) for w, d in zip(SMOOTH, range(-2, 3)))
    across = lambda a, turn: sum(w * (_shift(a, *turn(1, d)) - _shift(a, *turn(-1, d))) for w, d in ((1, -1), (2, 0), (1, 1)))
    gx, gy = across(v, lambda x, y: (x, y)), across(v, lambda x, y: (y, x))
    slope = gx * gx + gy * gy
    flat, steep = 1000 * np.abs(gx) >= 2414 * np.abs(gy), 1000 * np.abs(gy) >= 2414 * np.abs(gx)
    edge = slope >= SLOPE * SLOPE
    for here, (dx, dy) in ((flat, (1, 0)), (steep & ~flat, (0, 1)), (~flat & ~steep & ((gx > 0) == (gy > 0)), (1, 1)), (~flat & ~steep & ((gx > 0) != (gy > 0)), (-1, 1))):
        edge &= ~here | ((slope >= _shift(slope, dx, dy)) & (slope >= _shift(slope, -dx, -dy)))
    return slope, edge.astype(np.int64)


def _layers(label: np.ndarray) -> np.ndarray:
    """[class 0 to 8, core, edge] masks of a dense grid of labels, -1 where unknown."""
    known, forest = label >= 0, label == FOREST
    other = known & ~forest
    near = other | _shift(other, 1, 0) | _shift(other, -1, 0) | _shift(other, 0, 1) | _shift(other, 0, -1)
    return np.stack([*(label == k for k in CLASSES), forest & ~near, known & (canny(forest)[1] > 0)]).astype(np.int64)


def _disk_sums(layers: np.ndarray, radius: int, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """[layer, cell]: sums over the disk around each cell (y, x), by prefix sums along rows. Disks must lie inside."""
    prefix = np.zeros((layers.shape[0], layers.shape[1], layers.shape[2] + 1), np.int64)
    np.cumsum(layers, axis=2, out=prefix[:, :, 1:])
    total = np.zeros((layers.shape[0], len(y)), np.int64)
    for dy in range(-radius, radius + 1):
        half = math.isqrt(radius * radius - dy * dy)
        total += prefix[:, y + dy, x + half + 1] - prefix[:, y + dy, x - half]
    return total


def feature_names(radii: tuple[int, ...], metres: int = 100) -> list[str]:
    return [n for r in radii for n in (*[f"dw_class_{k}_pct_{r * metres}m" for k in CLASSES], f"forest_edge_{r * metres}", f"forest_core_pct_{r * metres}")]


def _features(layers: np.ndarray, radii: tuple[int, ...], y: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """Columns of feature_names() of known cells."""
    out = []
    for r in radii:
        total = _disk_sums(layers, r, y, x)
        n = total[:9].sum(0)
        out += [total[k] * 100.0 / n for k in CLASSES] + [total[10], total[9] * 100.0 / n]
    return out


def _tiled(cells: DataFrame, reach: int) -> DataFrame:
    """Each cell once for every tile (tx, ty) that it lies in or within `reach` cells of."""
    span = lambda c: F.sequence(F.floor((F.col(c) - reach) / TILE), F.floor((F.col(c) + reach) / TILE))
    return cells.select("*", F.explode(span("cx")).alias("tx")).select("*", F.explode(span("cy")).alias("ty"))


def _schema(keys: list[str], kinds: dict[str, str], radii: tuple[int, ...]) -> str:
    columns = [f"{k} {kinds[k]}" for k in keys] + ["cx int", "cy int"]
    return ", ".join(columns + [f"{n} {'long' if n.startswith('forest_edge') else 'double'}" for n in feature_names(radii)])


def all_features(cells: DataFrame, radii: tuple[int, ...] = (1, 100), keys: list[str] | None = None) -> DataFrame:
    """keys, cx, cy and 11 features for each radius (in cells of 100 m): nine percentages, border cells, core percentage.

    One shuffle: cells (one row for each) go to tiles of TILE by TILE, and to those that they are near of. A task has
    one tile at a time as a dense grid, of a size that only the radius and the number of columns determine; sums over
    disks are taken from prefix sums along rows, so work grows with the radius and not with its square.
    """
    keys = keys or []
    reach = max(radii) + RIM
    side = TILE + 2 * reach
    names = feature_names(radii)

    def run(key, found):
        *own, tx, ty = key
        x, y = found["cx"].to_numpy() - tx * TILE + reach, found["cy"].to_numpy() - ty * TILE + reach
        label = np.full((side, side), -1, np.int64)
        label[y, x] = found["label"].to_numpy()
        inside = (label >= 0)[reach : reach + TILE, reach : reach + TILE]
        at_y, at_x = (v + reach for v in np.nonzero(inside))
        columns = {k: pd.Series([v] * len(at_y), dtype=object if isinstance(v, str) else None) for k, v in zip(keys, own)}
        columns |= {"cx": at_x - reach + tx * TILE, "cy": at_y - reach + ty * TILE}
        return pd.DataFrame(columns | dict(zip(names, _features(_layers(label), radii, at_y, at_x))))

    tiled = _tiled(cells.select(*keys, "cx", "cy", "label"), reach)
    return tiled.groupBy(*keys, "tx", "ty").applyInPandas(run, _schema(keys, dict(cells.dtypes), radii))


def forest_borders(cells: DataFrame) -> DataFrame:
    """cx, cy, slope2, edge of known cells: squared slopes and thinned borders of forest, by canny() tile by tile."""
    side = TILE + 2 * RIM

    def run(key, found):
        tx, ty = key
        x, y = found["cx"].to_numpy() - tx * TILE + RIM, found["cy"].to_numpy() - ty * TILE + RIM
        label = np.full((side, side), -1, np.int64)
        label[y, x] = found["label"].to_numpy()
        slope, edge = canny(label == FOREST)
        at_y, at_x = (v + RIM for v in np.nonzero((label >= 0)[RIM:-RIM, RIM:-RIM]))
        return pd.DataFrame({"cx": at_x - RIM + tx * TILE, "cy": at_y - RIM + ty * TILE, "slope2": slope[at_y, at_x], "edge": edge[at_y, at_x]})

    tiled = _tiled(cells.select("cx", "cy", "label"), RIM)
    return tiled.groupBy("tx", "ty").applyInPandas(run, "cx int, cy int, slope2 long, edge long")


def point_features(points: DataFrame, scenes: DataFrame, radii: tuple[int, ...] = (1, 100), months: int = 3) -> DataFrame:
    """obs_id and the features of each point (obs_id, cx, cy, date) over its own months.

    The composite of a point's date is each cell's most frequent label (of ties the lowest) in the months before it.
    Points whose own cell has no scene in those months are left out. Scenes are counted by cell, day and label, and go
    with the points to groups of a tile and a quarter of a year, a row for each day; a group walks through its dates in
    order, adding and removing days, so its size depends on the tile and not on the number of points, which are taken once
    for each cell and date, nor on that of scenes: eight bytes for each cell, day and label.
    """
    reach, names = max(radii) + RIM, feature_names(radii)
    quarter = lambda c: F.year(c) * 4 + F.quarter(c)
    tile = lambda c: F.floor(F.col(c) / TILE)
    epoch = F.lit("1970-01-01").cast("date")
    wanted = points.where("date is not null").select("cx", "cy", "date").distinct()
    wanted = wanted.select("*", tile("cx").alias("tx"), tile("cy").alias("ty"), quarter("date").alias("q"), F.datediff("date", epoch).alias("day"), F.datediff(F.add_months("date", -months), epoch).alias("since"))
    daily = scenes.where("label is not null").groupBy("cx", "cy", F.to_date("scene_ts").alias("d"), "label").agg(F.count("*").alias("n"))
    # A day may count for dates up to so many months later; a month more than that covers short months.
    near = F.explode(F.sequence(quarter("d"), quarter(F.add_months("d", months + 1)))).alias("q")
    daily = _tiled(daily.select("cx", "cy", F.datediff("d", epoch).alias("day"), "label", "n", near), reach)
    daily = daily.join(wanted.select("tx", "ty", "q").distinct(), ["tx", "ty", "q"], "left_semi")
    # A day of a tile is one row: places within the tile and its surroundings, with the label as the last digit, and counts.
    side = TILE + 2 * reach
    at = (((F.col("cy") - F.col("ty") * TILE + reach) * side + (F.col("cx") - F.col("tx") * TILE + reach)) * 9 + F.col("label")).cast("int")
    days = daily.groupBy("tx", "ty", "q", "day").agg(F.collect_list(F.struct(at.alias("at"), F.col("n").cast("int").alias("n"))).alias("c"))
    days = days.select("tx", "ty", "q", "day", F.col("c.at").alias("at"), F.col("c.n").alias("n"))

    def run(key, asked: pa.Table, days: pa.Table) -> pa.Table:
        tx, ty = (k.as_py() for k in key[:2])
        px, py, now, since = (asked.column(c).to_numpy() for c in ("cx", "cy", "day", "since"))
        # Of the tile and its surroundings, what the points' disks reach.
        x0, y0 = px.min() - reach, py.min() - reach
        wide, high = px.max() + reach + 1 - x0, py.max() + reach + 1 - y0
        days = days.sort_by("day")
        day = days.column("day").to_numpy()
        at, n = (days.column(c).combine_chunks() for c in ("at", "n"))
        counts, first, last = np.zeros(high * wide * 9, np.int64), 0, 0
        taken, columns = [], {c: [] for c in names}

        def put(a: int, b: int, sign: int) -> None:
            """Adds or takes away the counts of the days a to b."""
            for k in range(a, b):
                place, much = at[k].values.to_numpy().astype(np.int64), n[k].values.to_numpy()
                place, label = np.divmod(place, 9)
                y, x = np.divmod(place, side)
                y, x = y + ty * TILE - reach - y0, x + tx * TILE - reach - x0
                inside = (x >= 0) & (x < wide) & (y >= 0) & (y < high)
                counts[((y * wide + x) * 9 + label)[inside]] += sign * much[inside]  # a place and label is there once a day

        order = np.lexsort((since, now))
        new = np.concatenate([[True], (now[order][1:] != now[order][:-1]) | (since[order][1:] != since[order][:-1])])
        for rows in np.split(order, np.flatnonzero(new)[1:]):
            upto, start = np.searchsorted(day, now[rows[0]]), np.searchsorted(day, since[rows[0]])
            if start >= last:  # nothing of what is counted counts any more
                counts[:] = 0
                first = last = start
            put(last, upto, 1)
            put(first, start, -1)
            first, last = start, upto
            grid = counts.reshape(high, wide, 9)
            label = np.where(grid.any(2), grid.argmax(2), -1)
            ax, ay = px[rows] - x0, py[rows] - y0
            known = label[ay, ax] >= 0
            if known.any():
                taken.append(rows[known])
                for c, v in zip(names, _features(_layers(label), radii, ay[known], ax[known])):
                    columns[c].append(v)
        rows = np.concatenate(taken) if taken else np.zeros(0, np.int64)
        out = asked.select(["date", "cx", "cy"]).take(pa.array(rows))
        for c, v in columns.items():
            kind = pa.int64() if c.startswith("forest_edge") else pa.float64()
            out = out.append_column(c, pa.array(np.concatenate(v) if v else np.zeros(0), kind))
        return out

    by = ["tx", "ty", "q"]
    found = wanted.groupBy(*by).cogroup(days.groupBy(*by)).applyInArrow(run, _schema(["date"], dict(wanted.dtypes), radii))
    return points.select("obs_id", "date", "cx", "cy").join(found, ["date", "cx", "cy"]).drop("date", "cx", "cy")


def sample_grid(points: DataFrame, grid: DataFrame, x0: float, y0: float, size: float) -> DataFrame:
    """Points with the grid's values at their cell (floor of the distance from the origin over the cell's size).

    Points outside of known cells, or with a null feature, are left out.
    """
    at = points.withColumns({"cx": F.floor((F.col("longitude") - x0) / size).cast("int"), "cy": F.floor((F.col("latitude") - y0) / size).cast("int")})
    return at.join(grid, ["cx", "cy"]).na.drop("any", subset=[c for c in grid.columns if c not in ("cx", "cy")])
