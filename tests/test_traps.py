"""Hand-made cases for what goes wrong easily."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmosaic.functions import dates, names
from fieldmosaic.operators import clean, features, landcover, metrics, sampling, spatial
from fieldmosaic.plans import models
from fieldmosaic.sources import readers, writers


def test_tsv_rows_that_are_short_or_long(spark, tmp_path):
    path = tmp_path / "dump.tsv"
    path.write_text('A B\tC\tD\n1\t"x\ty"\t3\n4\t5\n6\t7\t8\t9\n\t\t\n', encoding="utf-8")
    df = readers.ingest_tsv(spark, str(path), ["A B", "C", "D"])
    assert sorted(map(tuple, names.normalize_columns(df).collect()), key=str) == sorted([("1", "x\ty", "3"), ("4", "5", None)], key=str)


def test_names(spark):
    assert names.normal_name(" AGE/SEX ") == "age/sex" and names.normal_name(" AGE // SEX ", "strict") == "age_sex"
    with pytest.raises(ValueError):
        names.normalize_columns(spark.createDataFrame([(1, 2)], ["A B", "a_b"]))
    with pytest.raises(KeyError):
        names.drop_columns(spark.range(1), ["missing"])
    assert names.drop_columns(spark.range(1), ["missing"], strict=False).columns == ["id"]
    got = spark.createDataFrame([(" A b C ",), (None,)], "s string").select(names.species_key("s")).collect()
    assert [r[0] for r in got] == ["a_b_c", None]


def test_csv_files_of_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('system:index,x,.geo\n1,2,"{""type"":""Point"",""coordinates"":[3,4]}"\n')
    (tmp_path / "b.csv").write_text("x,rand\n5,0.5\n")
    df = readers.read_csv_groups(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    rows = sorted(map(tuple, df.select("x", "rand", "`.geo`").collect()))
    assert rows == [("2", None, '{"type":"Point","coordinates":[3,4]}'), ("5", "0.5", None)]
    with pytest.raises(TypeError):
        readers.union_by_name([spark.range(1), spark.range(1).selectExpr("cast(id as string) as id")])


def test_dates(spark):
    df = spark.createDataFrame([(2023, 2, 30, "2023-02-30"), (2024, 2, 29, "2024-02-29"), (None, 1, 1, None)], "y int, m int, d int, s string")
    got = df.select(dates.from_parts(df.y, df.m, df.d), dates.lenient_date(df.s), dates.year_of(df.s)).collect()
    assert [str(r[0]) for r in got] == ["None", "2024-02-29", "None"] == [str(r[1]) for r in got]
    assert [r[2] for r in got] == [2023, 2024, None]


def test_null_effort_passes_only_if_stationary(spark):
    rows = [(1, "A b", "2018-01-01", "Stationary", None), (2, "A b", "2018-01-01", "Traveling", None), (3, "A b", "x", "Stationary", 0.0), (4, "A b", "2016-12-31", "Stationary", 0.0), (5, "A b", "2024-01-01", "Traveling", 0.05)]
    df = spark.createDataFrame(rows, "obs_id long, scientific_name string, observation_date string, protocol_name string, effort_distance_km double")
    assert {r.obs_id for r in clean.clean_observations(df).collect()} == {1, 5}


def test_polygons_with_holes_edges_and_overlap(spark):
    def ring(poly, r, points):
        return [(poly, r, k, float(x), float(y)) for k, (x, y) in enumerate([*points, points[0]])]

    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    rows = ring(1, 0, square) + ring(1, 1, [(1, 1), (3, 1), (3, 3), (1, 3)]) + ring(2, 0, [(3.5, 3.5), (6, 3.5), (6, 6), (3.5, 6)])
    vertices = spark.createDataFrame(rows, "poly_id long, ring_id int, seq int, x double, y double")
    read = readers.wkb_vertices(readers.to_wkb(vertices))
    assert sorted(map(tuple, read.collect())) == sorted(rows)
    points = {1: (0.5, 0.5), 2: (2, 2), 3: (0, 2), 4: (4, 4), 5: (3.7, 3.7), 6: (5, 1), 7: (1, 2), 8: (2, 0), 9: (-1, 0), 10: (5, 4)}
    df = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in points.items()], "obs_id long, longitude double, latitude double")
    got = {(r.obs_id, r.poly_id) for r in spatial.points_in_polygons(df, spatial.edges_of(read)).collect()}
    assert got == {(1, 1), (3, 1), (4, 1), (4, 2), (5, 1), (5, 2), (7, 1), (8, 1), (10, 2)}
    assert {r.obs_id for r in spatial.points_in_any(df, spatial.edges_of(read)).collect()} == {1, 3, 4, 5, 7, 8, 10}


def test_points_by_area(spark):
    """Thin polygons have their points; overlaps count once; nearer the pole there are fewer for each degree."""
    sliver = [(1, 0.0, 0.0, 4.0, 4.0), (1, 4.0, 4.0, 4.0, 4.001), (1, 4.0, 4.001, 0.0, 0.0)]
    edges = spark.createDataFrame(sliver, "poly_id long, x1 double, y1 double, x2 double, y2 double")
    got = sampling.points_by_area(spark, edges, 200, lambda df: df).collect()
    assert len({r.id for r in got}) == 200 and all(r.longitude <= r.latitude <= r.longitude * 1.00025 + 1e-12 for r in got)
    box = lambda k, x, y, e, n: [(k, x, y, e, y), (k, e, y, e, n), (k, e, n, x, n), (k, x, n, x, y)]
    two = spark.createDataFrame([*box(1, 0.0, 0.0, 8.0, 80.0), *box(2, 4.0, 0.0, 12.0, 80.0)], edges.schema)
    got = sampling.points_by_area(spark, two, 3000, lambda df: df, size=2.0).collect()
    third = [sum(4 * k <= r.longitude < 4 * k + 4 for r in got) / 3000 for k in range(3)]
    assert all(abs(t - 1 / 3) < 0.04 for t in third)
    assert abs(sum(r.latitude > 30 for r in got) / 3000 - (np.sin(np.radians(80)) - 0.5) / np.sin(np.radians(80))) < 0.04


@pytest.mark.parametrize("dense,size", [(256, 0.25), (2, 1.0), (5, 40.0)])
def test_cell_cover_is_all_edges(spark, monkeypatch, tmp_path, dense, size):
    """Every point against every edge of every polygon, in plain loops: cells inside, crossed and cut up give the same."""
    monkeypatch.setattr(spatial, "DENSE", dense)
    monkeypatch.setattr(spatial, "LEVELS", 4)

    def written(df):
        path = str(tmp_path / str(len(list(tmp_path.iterdir()))))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rng = np.random.default_rng(7)
    shapes = []
    for n, r in ((3, 2.0), (40, 1.5), (150, 3.0)):
        turn, radius = np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(0.2, r, n)
        x, y = rng.uniform(-2, 2, 2)
        shapes.append([[(x + a * np.cos(t), y + a * np.sin(t)) for a, t in zip(radius, turn)]])
    comb = [(0.0, 0.0)] + [(0.25 * k, 1.0 if k % 2 else 0.25) for k in range(1, 12)] + [(3.0, 0.0)]
    steps = [p for k in range(6) for p in ((0.5 * k - 2, 0.5 * k - 2), (0.5 * k - 1.5, 0.5 * k - 2))] + [(1.0, 1.0), (-2.0, 1.0)]
    shapes += [[comb], [steps], [[(-4.0, -4.0), (4.0, -4.0), (4.0, 4.0), (-4.0, 4.0)], [(-1.0, -1.0), (-1.0, 1.0), (1.0, 1.0), (1.0, -1.0)]], [[(0.0, 0.0), (3.0, 3.0000001), (3.0, 3.0)]]]
    edges = [(k, *ring[i - 1], *ring[i]) for k, rings in enumerate(shapes) for ring in rings for i in range(len(ring))]
    points = [tuple(p) for p in rng.uniform(-4.5, 4.5, (400, 2))] + [p for rings in shapes[:2] + shapes[3:] for ring in rings for p in ring]
    points += [(x + dx, y) for x, y in comb + steps for dx in (-0.3, 0.125)] + [((a + c) / 2, (b + d) / 2) for k, a, b, c, d in edges if k > 2]
    want = set()
    for i, (x, y) in enumerate(points):
        for k in range(len(shapes)):
            odd = on = False
            for _, x1, y1, x2, y2 in (e for e in edges if e[0] == k):
                across = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
                on |= across == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
                odd ^= (y1 > y) != (y2 > y) and (across > 0 if y2 > y1 else across < 0)
            if on or odd:
                want.add((i, k))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)] + [(-1, None, 0.0)], "obs_id long, longitude double, latitude double")
    es = spark.createDataFrame([(k, *map(float, e)) for k, *e in edges], "poly_id long, x1 double, y1 double, x2 double, y2 double")
    got = {(r.obs_id, r.poly_id) for r in spatial.points_in_polygons(df, es, size, written).collect()}
    assert got == want
    index, levels = spatial.cover(es, size, written)
    most = index.where("x1 is not null").groupBy("level", "gx", "gy", "poly_id").count().agg({"count": "max"}).first()[0]
    assert (levels > 1) == (dense < 200) and (most <= dense or levels == spatial.LEVELS)
    assert spatial.points_in_polygons(df, es.limit(0), size, written).count() == 0


def test_polygons_over_each_other_are_one_cover(spark, monkeypatch):
    """A place's work for points in any polygon doesn't grow with the polygons over it; pairs aren't grouped."""
    rng = np.random.default_rng(3)
    centres = [(k, *rng.uniform(-1, 1, 2), rng.uniform(0.8, 1.6)) for k in range(15)]
    corners = [[(x + r, y), (x, y + r), (x - r, y), (x, y - r), (x + r, y)] for _, x, y, r in centres]
    edges = spark.createDataFrame([(k, *map(float, (*a, *b))) for k, c in enumerate(corners) for a, b in zip(c, c[1:])], "poly_id long, x1 double, y1 double, x2 double, y2 double")
    at = [(i, *map(float, p)) for i, p in enumerate(rng.uniform(-3, 3, (200, 2)))] + [(900, None, 1.0)]
    points = spark.createDataFrame(at, "obs_id long, longitude double, latitude double")
    pairs = {(i, k) for i, x, y in at if x is not None for k, a, b, r in centres if abs(x - a) + abs(y - b) <= r}
    found = spatial.points_in_polygons(points, edges, 0.5, same)
    assert {tuple(r) for r in found.collect()} == pairs
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.obs_id for r in spatial.points_in_any(points, edges, 0.5, same).collect()} == {i for i, _ in pairs}
    monkeypatch.setattr(spatial, "DENSE", 3)
    monkeypatch.setattr(spatial, "LEVELS", 2)
    index, levels = spatial.any_cover(edges, 0.5, same)
    rows = index.groupBy("level", "gx", "gy").count().collect()
    assert levels > 1 and all(r["count"] <= 3 for r in rows if r["level"] < levels - 1)
    assert index.where("x1 is null").count() == index.where("x1 is null").select("level", "gx", "gy").distinct().count() > 10


def test_points_of_a_cell_are_decided_together(spark, monkeypatch):
    """No row is made for a point and an edge that don't meet; cells of many points are dealt, batches may end in a polygon."""
    monkeypatch.setattr(spatial, "PLACES", 40)
    rng = np.random.default_rng(11)
    at = [(i, *map(float, p)) for i, p in enumerate(rng.uniform(-2, 2, (300, 2)))] + [(None, 0.0, 0.0), (800, 0.5, None), (801, 1.0, 0.0), (802, -0.25, 0.75)]
    shapes = [(k, *rng.uniform(-0.5, 0.5, 2), rng.uniform(0.5, 1.5)) for k in range(6)] + [(9, 0.0, 0.0, 1.0)]
    corners = [[(x + r * np.cos(t), y + r * np.sin(t)) for t in np.linspace(0, 2 * np.pi, 20)[:-1]] for _, x, y, r in shapes[:-1]] + [[(1.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (0.0, -1.0)]]
    edges = [(s[0], *map(float, (*a, *b))) for s, c in zip(shapes, corners) for a, b in zip(c, [*c[1:], c[0]])]
    want = set()
    for i, x, y in at:
        for k, *_ in shapes if x is not None and y is not None else []:
            own = [((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1), x1, y1, x2, y2) for p, x1, y1, x2, y2 in edges if p == k]
            on = any(a == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2) for a, x1, y1, x2, y2 in own)
            if on or sum((y1 > y) != (y2 > y) and (a > 0 if y2 > y1 else a < 0) for a, x1, y1, x2, y2 in own) % 2:
                want.add((i, k))
    points = spark.createDataFrame(at, "obs_id long, longitude double, latitude double")
    found = spatial.points_in_polygons(points, spark.createDataFrame(edges, "poly_id long, x1 double, y1 double, x2 double, y2 double"), 1.0, same)
    assert "Join Inner" not in found._jdf.queryExecution().optimizedPlan().toString()
    for rows in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        got = [tuple(r) for r in found.collect()]
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert set(got) == want and len(got) == len(want) > 300 and {(None, 9), (801, 9), (802, 9)} <= want


def test_counts_in_boxes_make_no_pairs(spark, monkeypatch):
    """Every box against every point, in plain loops; many points at one place, null ids, groups of few places."""
    monkeypatch.setattr(spatial, "PLACES", 50)
    rng = np.random.default_rng(8)
    at = [(int(i), float(x), float(y)) for i, (x, y) in enumerate(rng.integers(-12, 12, (700, 2)) / 8)] + [(5000 + k, 0.5, 0.5) for k in range(200)] + [(None, 0.5, 0.5), (9000, None, 0.0)]
    points = spark.createDataFrame(at, "obs_id long, longitude double, latitude double")
    rows = [(k, 0, s, float(x), float(y)) for k in range(40) for s, (x, y) in enumerate(rng.integers(-12, 12, (4, 2)) / 8)] + [(99, 0, 0, 70.0, 70.0)]
    vertices = spark.createDataFrame(rows, "poly_id long, ring_id int, seq int, x double, y double")
    want = {}
    for k in range(40):
        x, y = [r[3] for r in rows if r[0] == k], [r[4] for r in rows if r[0] == k]
        found = [i for i, a, b in at if a is not None and min(x) <= a <= max(x) and min(y) <= b <= max(y)]
        if found:
            known = [i for i in found if i is not None]
            want[k] = (len(found), min(known), max(known))
    got = spatial.counts_in_boxes(points, vertices, 0.0, same).collect()
    assert {r.poly_id: (r.n, r.first_id, r.last_id) for r in got} == want and len(want) > 20


def test_boxes_clip_their_records(spark, monkeypatch):
    """Each box's own records are made, row by row, and what is counted is the clip; batches may end anywhere."""
    import pyarrow as pa

    monkeypatch.setattr(spatial, "PLACES", 50)
    rng = np.random.default_rng(9)
    at = [(int(i), float(x), float(y)) for i, (x, y) in enumerate(rng.integers(-12, 12, (300, 2)) / 8)] + [(None, 0.5, 0.5), (900, None, 0.0), (901, 0.5, 0.5)]
    points = spark.createDataFrame(at, "obs_id long, longitude double, latitude double")
    boxes = {k: sorted(rng.integers(-12, 12, 2) / 8) + sorted(rng.integers(-12, 12, 2) / 8) for k in range(25)} | {50: [-3.0, 3.0, -3.0, 3.0]}
    vertices = spark.createDataFrame([(k, 0, s, float(b[s]), float(b[2 + s])) for k, b in boxes.items() for s in (0, 1)], "poly_id long, ring_id int, seq int, x double, y double")
    want = sorted((k, -1 if i is None else i) for k, (x0, x1, y0, y1) in boxes.items() for i, x, y in at if x is not None and x0 <= x <= x1 and y0 <= y <= y1)
    got = sorted((r.poly_id, -1 if r.obs_id is None else r.obs_id) for r in spatial.clip_to_boxes(points, vertices, 0.0, 0.25, same).collect())
    assert got == want and len(want) > 600
    assert {r.poly_id: r.n for r in spatial.counts_in_boxes(points, vertices, 0.0, same).collect()} == {k: sum(p == k for p, _ in want) for k in {p for p, _ in want}}
    row = {c: None for c in ("obs_id", "longitude", "latitude", "poly_id", "x0", "x1", "y0", "y1")} | {"gx": 0, "gy": 0, "g": 0}
    rows = [row | {"shape": 0, "obs_id": i, "longitude": x, "latitude": y} for i, x, y in ((7, 2.0, 1.0), (None, 1.0, 1.0), (3, 0.0, 5.0))]
    rows += [row | {"shape": 1, "poly_id": k, "x0": x0, "x1": 2.0, "y0": 0.0, "y1": y1} for k, x0, y1 in ((1, 1.0, 1.0), (2, 0.0, 9.0), (3, 1.5, 0.5))]
    rows += [row | {"gx": 1, "shape": 1, "poly_id": 4, "x0": 0.0, "x1": 9.0, "y0": 0.0, "y1": 9.0}]
    kinds = pa.schema([(c, pa.int64() if c in ("obs_id", "poly_id", "gx", "gy", "g", "shape") else pa.float64()) for c in rows[0]])
    for size in (1, 2, 3, 7):
        batches = (pa.RecordBatch.from_pylist(rows[k : k + size], schema=kinds) for k in range(0, 7, size))
        assert [(poly.as_py(), ids.to_pylist()) for ids, poly in spatial.clips(batches) if len(ids)] == [(1, [None, 7]), (2, [3, None, 7])]


def test_multipolygon_wkb(spark):
    import struct

    part = lambda o, x: struct.pack(f"{o}BII"[0:1] + "BII", 1 if o == "<" else 0, 3, 1) + struct.pack(f"{o}I8d", 4, x, 0, x + 1, 0, x, 1, x, 0)
    raw = struct.pack("<BII", 1, 6, 2) + part("<", 0) + part(">", 5)
    df = spark.createDataFrame([(1, bytearray(raw)), (2, None)], "poly_id long, geometry binary")
    assert {(r.ring_id, r.seq, r.x) for r in readers.wkb_vertices(df).collect()} == {(k, s, x + (s == 1)) for k, x in ((0, 0.0), (1, 5.0)) for s in range(4)}


def test_constant_columns_and_missing_features(spark):
    df = spark.createDataFrame([(1, 5.0, None, "m"), (2, 5.0, float("nan"), "m")], "id long, a double, b double, meta string")
    out = features.matrix(df, ["meta", "none"], ["a", "b", "c"]).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, 5.0, 0.0, 0.0), (2, 5.0, 0.0, 0.0)]
    assert {r.a for r in features.minmax(df, ["a"]).collect()} == {0.0} == {r.a for r in features.standard(df, ["a"]).collect()}


def test_folds(spark):
    df = spark.range(1003).selectExpr("id", "cast(id % 3 = 0 as int) as label", "1 as k")
    sizes = [r["count"] for r in features.contiguous_folds(df).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [201, 201, 201, 200, 200]
    firsts = [r[0] for r in features.contiguous_folds(df).groupBy("fold").agg({"id": "min"}).orderBy("fold").select("min(id)").collect()]
    assert firsts == [0, 201, 402, 603, 803]
    one = {tuple(r) for r in features.stratified_folds(df, ["k"]).select("id", "fold").collect()}
    assert one == {tuple(r) for r in features.stratified_folds(df.repartition(7), ["k"]).select("id", "fold").collect()}
    spread = features.stratified_folds(df, ["k"]).groupBy("label", "fold").count().collect()
    assert all(max(r["count"] for r in spread if r.label == v) - min(r["count"] for r in spread if r.label == v) <= 1 for v in (0, 1))


def test_metrics_with_ties_and_one_class(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 0, 0.5), ("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.3)], "g string, label int, score double")
    auc = {r.g: r.auc for r in metrics.roc_auc(df, ["g"]).collect()}
    assert auc["a"] == 0.875 and auc["b"] is None
    flipped = {r.g: r.auc for r in metrics.roc_auc(df.withColumn("score", -df.score), ["g"]).collect()}
    assert flipped["a"] == 1 - auc["a"]
    best = {r.g: (r.threshold, round(r.f1, 6)) for r in metrics.best_f1(df, ["g"]).collect()}
    assert best["a"] == (0.5, 0.8) and best["b"] == (0.3, 1.0)


def test_land_cover(spark):
    cells = spark.createDataFrame([(x, y, 1 if x < 6 else 3) for x in range(12) for y in range(12) if (x, y) != (5, 5)], "cx int, cy int, label int")
    small, wide = (f(cells, 3).collect() for f in (landcover.percent_cover, landcover.percent_cover_wide))
    a, b = ({(r.cx, r.cy): [round(v, 9) for v in r[2:]] for r in rows} for rows in (small, wide))
    assert a == b and len(a) == 143 and all(abs(sum(v) - 100) < 1e-6 for v in a.values())
    edge = {(r.cx, r.cy) for r in landcover.forest_edge(cells).collect() if r.edge}
    assert edge == {(5, y) for y in range(12) if y != 5}
    core = {(r.cx, r.cy) for r in landcover.forest_core(cells).collect() if r.core}
    assert core == {(x, y) for x in range(5) for y in range(12)}
    solid = spark.createDataFrame([(x, y, 1 if x < 6 else 3) for x in range(12) for y in range(12)], "cx int, cy int, label int")
    canny = {(r.cx, r.cy) for r in landcover.forest_borders(solid).collect() if r.edge and 2 < r.cy < 9 and 2 < r.cx < 9}
    assert canny and {x for x, _ in canny} <= {5, 6}


@pytest.mark.parametrize("tile", [256, 5])
def test_features_over_tiles(spark, monkeypatch, tile):
    """Percentages, borders and cores of disks, cell by cell, wherever the tiles end; coordinates may be negative."""
    monkeypatch.setattr(landcover, "TILE", tile)
    rng = np.random.default_rng(3)
    known = {(x, y): int(rng.choice([1, 1, 1, 3, 7])) for x in range(-9, 9) for y in range(-6, 8) if rng.random() < 0.9}
    cells = spark.createDataFrame([(x, y, v, "k") for (x, y), v in known.items()], "cx int, cy int, label int, period string")
    border = {(r.cx, r.cy): r.edge for r in landcover.forest_borders(cells).collect()}
    core = {(r.cx, r.cy): r.core for r in landcover.forest_core(cells).collect()}
    got = {(r.cx, r.cy): r.asDict() for r in landcover.all_features(cells, (1, 4), ["period"]).collect()}
    assert set(got) == set(border) == set(core) == set(known) and any(border.values())
    for (x, y), row in got.items():
        for r in (1, 4):
            near = [p for p in known if (p[0] - x) ** 2 + (p[1] - y) ** 2 <= r * r]
            assert row["period"] == "k" and row[f"forest_edge_{r}00"] == sum(border[p] for p in near)
            assert math.isclose(row[f"forest_core_pct_{r}00"], 100 * sum(core[p] for p in near) / len(near))
            assert all(math.isclose(row[f"dw_class_{k}_pct_{r}00m"], 100 * sum(known[p] == k for p in near) / len(near)) for k in range(9))


def test_point_features_walk_through_dates(spark, monkeypatch):
    """The same as composing every date's cells by themselves."""
    monkeypatch.setattr(landcover, "TILE", 7)
    rng = np.random.default_rng(5)
    scene = lambda: (int(rng.integers(-5, 12)), int(rng.integers(-5, 12)), f"{rng.integers(2018, 2020)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d} 10:00:00", int(rng.choice([1, 1, 4, 8])))
    scenes = spark.createDataFrame([scene() for _ in range(9000)], "cx int, cy int, s string, label int").selectExpr("cx", "cy", "to_timestamp_ntz(s) as scene_ts", "label")
    points = spark.createDataFrame([(k, *scene()[:3]) for k in range(40)] + [(90, 50, 50, "2018-06-01"), (91, 0, 0, None)], "obs_id int, cx int, cy int, s string").selectExpr("obs_id", "cx", "cy", "to_date(substr(s, 1, 10)) as date")
    got = {r.obs_id: r.asDict() for r in landcover.point_features(points, scenes, (1, 3)).collect()}
    dates = points.where("date is not null").select("date").distinct()
    every = dates.crossJoin(scenes.select("cx", "cy").distinct())
    composed = landcover.lookback(every, scenes, ["date", "cx", "cy"])
    grid = {(r.date, r.cx, r.cy): r.asDict() for r in landcover.all_features(composed, (1, 3), ["date"]).collect()}
    asked = {p.obs_id: (p.date, p.cx, p.cy) for p in points.collect()}
    assert set(got) == {i for i, at in asked.items() if at in grid} and len(got) > 20
    for i, row in got.items():
        want = grid[asked[i]]
        assert all(math.isclose(row[c], want[c], abs_tol=1e-9) for c in row if c != "obs_id")


def test_numbers_that_are_missing_do_not_spoil_scaling(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, float("nan")), (4, None)], "id int, f double")
    for scaled, want in ((features.standard(df, ["f"]), [-1.0, 1.0]), (features.minmax(df, ["f"]), [0.0, 100.0])):
        rows = {r.id: r.f for r in scaled.collect()}
        assert [rows[1], rows[2]] == want and math.isnan(rows[3]) and rows[4] is None


@pytest.mark.parametrize("few", [200_000, 0])
def test_polygons_by_broadcast_and_by_shuffle(spark, monkeypatch, few):
    monkeypatch.setattr(spatial, "BROADCAST_EDGES", few)
    ring = [(0.0, 0.0), (3.0, 0.0), (3.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    hole = [(1.0, 0.5), (2.0, 0.5), (2.0, 1.5), (1.0, 1.5), (1.0, 0.5)]
    vertices = spark.createDataFrame([(1, r, k, x, y) for r, points in enumerate((ring, hole)) for k, (x, y) in enumerate(points)], "poly_id long, ring_id int, seq int, x double, y double")
    points = [(k, x / 4, y / 4) for k, (x, y) in enumerate((x, y) for x in range(-2, 15) for y in range(-2, 11))] + [(900, None, 1.0)]
    found = spatial.points_in_polygons(spark.createDataFrame(points, "obs_id long, longitude double, latitude double"), spatial.edges_of(vertices))
    want = {k for k, x, y in points if x is not None and 0 <= x <= 3 and 0 <= y <= 2 and not (1 < x < 2 and 0.5 < y < 1.5)}
    assert {r.obs_id for r in found.collect()} == want


def test_ranges_of_a_hot_key(spark):
    """Running sums don't depend on where ranges are cut; ties and nulls have their place."""
    from fieldmosaic.operators import ranges

    rows = [("a" if k % 10 else None, float(k % 50) if k % 7 else None, k) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, v double, k int").repartition(3)
    got = {r.k: (r.upto, r.n) for r in ranges.running(df, ["g"], "v", {"upto": F.lit(1)}, ties=["k"], totals={"n": F.lit(1)}).collect()}
    for g in ("a", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert all(got[r[2]] == (i, len(own)) for i, r in enumerate(own, 1))


@pytest.mark.parametrize("few", [100_000, 0])
def test_rows_are_shuffled_once_for_running_sums(spark, monkeypatch, few):
    """Few sums of ranges go to the rows; with many, the join has the same results."""
    from fieldmosaic.operators import ranges

    monkeypatch.setattr(ranges, "BROADCAST_SUMS", few)
    rows = [("a" if k % 10 else None, k % 2, float(k % 50), k) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, label int, v double, id long").repartition(3)
    found = ranges.running(df, ["g", "label"], "v", {"upto": F.lit(1)}, ties=["id"], totals={"n": F.lit(1)})
    got = {r.id: (r.upto, r.n) for r in found.collect()}
    for g, label in {r[:2] for r in rows}:
        own = sorted((r for r in rows if r[:2] == (g, label)), key=lambda r: r[2:])
        assert all(got[r[3]] == (i, len(own)) for i, r in enumerate(own, 1))
    if few:
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_mode_ties_and_month_ends(spark):
    points = spark.sql("select 1 as obs_id, 0 as cx, 0 as cy, date'2020-05-31' as date")
    scenes = spark.createDataFrame([(0, 0, f"2020-0{m}", k) for m, k in (("2-28 12:00:00", 7), ("2-29 00:00:00", 4), ("5-30 23:00:00", 2), ("5-31 00:00:00", 8))], "cx int, cy int, s string, label int").selectExpr("cx", "cy", "to_timestamp_ntz(s) as scene_ts", "label")
    assert [tuple(r) for r in landcover.lookback(points, scenes, ["obs_id"]).collect()] == [(1, 2)]


def test_types_come_with_the_rows(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("a\tb\tc\td\te\tf\n1\t1\t2020-02-29\ttrue\t\t7\n-2\t.5e3\t2021-12-31\tFALSE\t\tx\n\t3\t2021-02-03\t\t\t2020-02-30\n")
    rows, found = readers.ingest_inferred(spark, str(tmp_path), list("abcdef"), lambda df: same(df))
    assert dict(rows.dtypes) == {"a": "bigint", "b": "double", "c": "date", "d": "boolean", "e": "string", "f": "string"}
    assert [r.b for r in rows.orderBy("c").collect()] == [1.0, 3.0, 500.0]
    at = {r.name: r for r in found.collect()}
    assert (at["a"].known, at["b"].not_bigint, at["b"].not_double, at["e"].known, at["f"].not_bigint, at["f"].not_date) == (2, 1, 0, 0, 2, 3)
    # Counts of parts add up.
    text = spark.createDataFrame([("1",), ("2.5",), (None,), ("x",)], "a string")
    whole, parts = (d.agg(*readers.type_counts(text)).first().asDict() for d in (text, text.where("a < 'x'"))), text.where("a >= 'x'").agg(*readers.type_counts(text)).first().asDict()
    whole, part = whole
    assert whole == {k: part[k] + parts[k] for k in part} and readers.types_of(["a"], part) == {"a": "double"} and readers.types_of(["a"], whole) == {"a": "string"}


def test_csv_headers_in_two_jobs(spark, tmp_path):
    """Many files, few headers: the number of jobs stays; quotes, empty files, headers alone and repeated ones."""
    import csv

    want = []
    for k in range(30):
        names = [["id", "a b", "x"], ["x", "id"], ["id", "only, here"]][k % 3]
        with open(tmp_path / f"s_{k:02d}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(names)
            for j in range(k % 4):
                row = {n: f'{k}-{j} "q", {n}' for n in names}
                out.writerow([row[n] for n in names])
                want.append(tuple(row.get(n) for n in ("id", "a b", "x", "only, here")))
            if k == 3:
                out.writerow(names)
    (tmp_path / "s_empty.csv").write_text("")
    (tmp_path / "other.csv").write_text("id,z\n1,2\n")
    tracker, counts = spark.sparkContext.statusTracker(), []
    for pattern in ("s_0*.csv", "s_*.csv"):
        spark.sparkContext.setJobGroup(pattern, pattern)
        df = readers.read_csv_glob(spark, str(tmp_path / pattern))
        got = sorted((tuple(r) for r in df.collect()), key=str)
        counts.append(len(tracker.getJobIdsForGroup(pattern)))
    assert df.columns == ["id", "a b", "x", "only, here"] and got == sorted(want, key=str) and counts[0] == counts[1]
    with pytest.raises(ValueError):
        readers.read_csv_groups(spark, [str(tmp_path / "s_empty.csv")])


def _scenes(spark):
    rng = np.random.default_rng(12)
    rows = [(int(rng.integers(-3, 3)), int(rng.integers(0, 40)), f"20{rng.integers(17, 20)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d} {rng.integers(0, 24):02d}:30:00", int(rng.integers(0, 9))) for _ in range(3000)]
    scenes = spark.createDataFrame(rows, "cx int, cy int, s string, label int").selectExpr("cx", "cy", "to_timestamp_ntz(s) as scene_ts", "label")
    points = [(k, int(rng.integers(-4, 4)), int(rng.integers(0, 8)), f"20{rng.integers(16, 22)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}") for k in range(300)]
    points += [(1000 + k, 0, 3, d) for k, d in enumerate(("2018-05-31", "2018-05-31", "2019-12-31", "2017-01-01", "2020-03-01", None))]
    return scenes, spark.createDataFrame(points, "obs_id long, cx int, cy int, d string").selectExpr("obs_id", "cx", "cy", "cast(d as date) as date")


def test_asof_lookback_is_lookback(spark):
    """Points before, between and behind all scenes, in cells with and without, at month ends and without a date."""
    scenes, points = _scenes(spark)
    one = sorted(tuple(r) for r in landcover.lookback(points, scenes, ["obs_id"]).collect())
    two = sorted(tuple(r) for r in landcover.lookback_asof(points, landcover.running_counts(scenes), ["obs_id"]).collect())
    assert one == two and len(one) > 50
    none = landcover.running_counts(scenes.limit(0))
    assert landcover.lookback_asof(points, none, ["obs_id"]).count() == 0


def test_lookback_takes_each_cell_and_date_once(spark, monkeypatch):
    """However many points share a cell and date; rows of one key add up, and cells of no point aren't counted."""
    scenes, points = _scenes(spark)
    asked, counts = [], landcover._counts_before
    monkeypatch.setattr(landcover, "_counts_before", lambda wanted, kept, months: asked.append((wanted, kept)) or counts(wanted, kept, months))
    copies = points.crossJoin(spark.range(5).withColumnRenamed("id", "k"))
    want = sorted(tuple(r) for r in landcover.lookback(points, scenes, ["obs_id"]).collect())
    got = sorted(tuple(r) for r in landcover.lookback(copies, scenes, ["obs_id", "k"]).collect())
    assert got == sorted((i, k, label) for i, label in want for k in range(5)) and len(want) > 50
    assert asked[1][0].count() == points.select("cx", "cy", "date").distinct().count() < copies.count() // 4
    few = points.where("cy = 3")
    landcover.lookback(few, scenes, ["obs_id"])
    assert asked[2][1].where("cy <> 3").count() == 0 < asked[2][1].count()
    one = landcover.lookback(copies, scenes, ["k"]).collect()
    assert len(one) == 5 and len({r.label for r in one}) == 1
    assert sorted(tuple(r) for r in landcover.lookback_asof(copies, landcover.running_counts(scenes), ["obs_id", "k"]).collect()) == got


def test_scene_store_reads_only_the_points_folders(spark, tmp_path):
    from fieldmosaic.sources import scenes as store

    scenes, points = _scenes(spark)
    few = points.where("cy < 3 and date between '2018-03-01' and '2018-06-30'")
    store.write_scenes(scenes.where("cx < 1"), str(tmp_path), tile=4, rows=50)
    store.write_scenes(scenes.where("cx >= 1"), str(tmp_path), tile=4, rows=50)
    whole = store.read_scenes(spark, str(tmp_path))
    assert whole.count() == 3000 and {"month", "tile_x", "tile_y"} < set(whole.columns)
    near = store.scenes_near(few, str(tmp_path), same, tile=4)
    assert "dynamicpruning" in near._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).lower()
    read = {r[0] for r in near.selectExpr("input_file_name()").collect()}
    assert read and all(any(f"month={m}/" in f for m in (201712, *range(201801, 201807))) for f in read)
    want, got = (sorted(tuple(r) for r in landcover.lookback(few, s, ["obs_id"]).collect()) for s in (scenes, near))
    assert want == got and got
    wide = store.scenes_near(few, str(tmp_path), same, tile=4, radius=5).count()
    assert near.count() < wide < 3000


def same(df):
    """In place of writing a frame: take its rows, so that they are computed once."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("few", [50_000, 0])
def test_poisson_models_agree(spark, monkeypatch, few):
    monkeypatch.setattr(models, "BROADCAST_MODELS", few)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2))
    y = rng.poisson(np.exp(0.3 + x @ [0.5, -0.8])).astype(float)
    rows = [(["a", "b", "bad"][i % 3], float(x[i, 0]) if i % 3 < 2 else None, float(x[i, 1]), float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "species string, f1 double, f2 double, target double")
    found = {r.species: r for r in models.fit(df, ["species"], ["f1", "f2"], same, alpha=0.1).collect()}
    assert found["bad"].status == "fail" and found["bad"].error and found["a"].status == "ok"
    for k, name in enumerate(["a", "b"]):
        z, t = np.column_stack([np.ones(len(x[k::3])), x[k::3]]), y[k::3]
        mu = np.exp(z @ found[name].beta)
        score = z.T @ (mu - t) / len(t) + 0.1 * np.array([0, *found[name].beta[1:]])
        assert np.abs(score).max() < 1e-8
    only = df.where("species = 'a'")
    glm = models.glm(only, ["f1", "f2"], alpha=0.1).stages[-1]
    assert np.allclose([glm.intercept, *glm.coefficients], found["a"].beta, atol=1e-5)
    fitted = models.fit(df, ["species"], ["f1", "f2"], same)
    assert all(abs(r.gradient) < 1e-9 for r in models.gradient(df.where("species <> 'bad'"), fitted, ["species"], ["f1", "f2"]).collect())
    scored = models.score(df, fitted, ["species"], ["f1", "f2"])
    assert scored.where("species = 'bad'").where("score is not null").count() == 0 == scored.where("species <> 'bad' and score is null").count()


def test_writers_and_background(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "o'x")], "id long, scientific_name string")
    writers.write_partitioned(df, str(tmp_path / "p"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "p")).select("id", "scientific_name").collect()} == {(1, "a"), (2, None), (3, "o'x")}
    square = spark.createDataFrame([(1, 0, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)])], "poly_id long, ring_id int, seq int, x double, y double")
    thin = spark.createDataFrame([(1, 0, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (1.0, 1.0), (1.0, 1.0), (0.0, 0.0)])], square.schema)
    with pytest.raises(ValueError):
        sampling.background_points(spark, thin, spatial.edges_of(thin), 20)
    with pytest.raises(ValueError):
        sampling.background_points(spark, square.limit(0), spatial.edges_of(square.limit(0)), 20)
    line = spatial.edges_of(thin)
    with pytest.raises(ValueError):
        sampling.points_by_area(spark, line, 20, same)
    many = spark.createDataFrame([(k, "a" if k < 90 else "b") for k in range(100)], df.schema)
    writers.write_partitioned(many, str(tmp_path / "q"), rows=30)
    files = [f.rsplit("/", 2)[1] for f in spark.read.parquet(str(tmp_path / "q")).inputFiles()]
    assert files.count("scientific_name=b") == 1 < files.count("scientific_name=a") <= 3
    one = sampling.background_points(spark, square, spatial.edges_of(square), 300).collect()
    assert len(one) == 300 and all(r.longitude + r.latitude <= 1 for r in one)
    assert abs(sum(r.longitude for r in one) / 300 - 1 / 3) < 0.06 and abs(sum(r.latitude for r in one) / 300 - 1 / 3) < 0.06
    ids = spark.createDataFrame([(3 * k,) for k in range(100)], "obs_id long")
    assert [sampling._nth(ids, n, 7) for n in (1, 57, 100, 101)] == [0, 168, 297, None]
    dated = sampling.with_random_date(spark.range(2000)).agg({"obs_date": "max", "rand": "avg"}).first()
    assert dated["max(obs_date)"] <= "2024-12-30" and math.isclose(dated["avg(rand)"], 0.5, abs_tol=0.05)


def test_streamed_ingest(spark, tmp_path):
    from fieldmosaic.streaming.ingest import ingest

    folder, root = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    head = "obs_id\tscientific_name\tobservation_date\tprotocol_name\teffort_distance_km\tlongitude\tlatitude\n"
    (folder / "a.tsv").write_text(head + "1\tA b\t2018-01-01\tStationary\t\t1\t2\n2\tA b\t2018-01-01\tTraveling\t5\t1\t2\n1\tA b\t2018-01-01\tStationary\t\t1\t2\n")
    run = ingest(spark, str(folder), str(root), str(tmp_path / "state"), head.strip().split("\t"))
    run.processAllAvailable()
    (folder / "b.tsv").write_text(head + "3\tC\t2018-01-02\tTraveling\t0.01\t1\t2\n1\tA b\t2018-01-01\tStationary\t\t1\t2\n")
    run.processAllAvailable()
    run.stop()
    assert sorted((r.obs_id, r.scientific_name) for r in spark.read.parquet(str(root)).collect()) == [("1", "a_b"), ("3", "c")]


def test_streamed_ingest_takes_old_dates(spark, tmp_path):
    """Later files hold records of years before the newest one, and repeats of records long ago."""
    from fieldmosaic.streaming.ingest import ingest

    folder, root = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    head = "obs_id\tscientific_name\tobservation_date\tprotocol_name\teffort_distance_km\tlongitude\tlatitude\n"
    row = lambda i, name, date: f"{i}\t{name}\t{date}\tStationary\t\t1\t2\n"
    files = [row(1, "A b", "2024-12-30") + row(2, "A b", "2017-01-01"), row(3, "C", "2017-01-02") + row(4, "A b", "2020-06-01"), row(2, "A b", "2017-01-01") + row(1, "C", "2024-12-30") + row(5, "C", "2018-03-04")]
    run = ingest(spark, str(folder), str(root), str(tmp_path / "state"), head.strip().split("\t"))
    for k, text in enumerate(files):
        (folder / f"{k}.tsv").write_text(head + text)
        run.processAllAvailable()
    run.stop()
    got = sorted((r.obs_id, r.scientific_name) for r in spark.read.parquet(str(root)).collect())
    assert got == [("1", "a_b"), ("2", "a_b"), ("3", "c"), ("4", "a_b"), ("5", "c")]


def test_index_of_ids(spark, tmp_path):
    """Batches that fail between ids and records, come twice, or meet a root from before the index."""
    from fieldmosaic.streaming import ingest

    root = str(tmp_path / "root")
    rows = lambda *ids: spark.createDataFrame([(i, "a_b") for i in ids], "obs_id long, scientific_name string")
    held = lambda: sorted((r.obs_id for r in spark.read.parquet(root).collect()), key=str)
    writers.write_partitioned(rows(1, 2, None), root)
    ingest.append_new(rows(2, 3, 3, 4), root, 0)
    assert held() == [1, 2, 3, 4, None]
    ingest.append_new(rows(2, 3, 3, 4), root, 0)
    assert held() == [1, 2, 3, 4, None]
    # The ids of batch 1 were written, its records weren't, or only one of them.
    writers.write_partitioned(ingest._numbered(rows(5, 6), 1), root + "_ids", "bucket")
    writers.write_partitioned(rows(5), root)
    ingest.append_new(rows(1, 5, 6, 7), root, 1)
    assert held() == [1, 2, 3, 4, 5, 6, 7, None]
    index = spark.read.parquet(root + "_ids")
    assert sorted(int(r.obs_id) for r in index.select("obs_id").distinct().collect()) == list(range(1, 8))
    (bucket,) = ingest._numbered(rows(6), 2).select("bucket").first()
    files = index.where(f"bucket = {bucket}").selectExpr("input_file_name()").distinct().collect()
    assert files and all(f"/bucket={bucket}/" in r[0] for r in files)


def test_streamed_counts(spark, tmp_path):
    from fieldmosaic.streaming.ingest import monthly_counts

    df = spark.sql("select 'a_b' as scientific_name, date'2020-01-01' + cast(id as int) as date from range(40)")
    df.write.parquet(str(tmp_path / "in"))
    run = monthly_counts(spark, str(tmp_path / "in"), df.schema).writeStream.format("memory").queryName("counted").outputMode("complete").start()
    run.processAllAvailable()
    run.stop()
    assert sum(r["count"] for r in spark.table("counted").collect()) == 40


def test_ranks_do_not_depend_on_partitions(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    one, two = ({tuple(r) for r in clean.ordered_slices(d, 10, "k").collect()} for d in (df.repartition(5), df.coalesce(1)))
    n = len(one)
    assert one == two == {(7 * i, i // (n // 10 + 1)) for i in range(n)}
    hot = df.withColumn("g", F.when(F.col("k") % 5 > 0, "hot"))
    got = {(r.g, r.k): r.slice for r in clean.ordered_slices(hot, 4, "k", ["g"]).collect()}
    for g in ("hot", None):
        own = sorted(k for h, k in got if h == g)
        assert [got[g, k] for k in own] == [i // (len(own) // 4 + 1) for i in range(len(own))]


def test_alpha_sweep_scales_within_species(spark, monkeypatch):
    """The penalties are the reference's, on features of mean 0 and deviation 1 for each species."""
    from fieldmosaic.plans import queries

    class Seen(Exception):
        pass

    def stop(df, keys, columns, alphas, stage):
        raise Seen(df, alphas)

    monkeypatch.setattr(queries.models, "cross_validate", stop)
    with pytest.raises(Seen) as e:
        queries.alpha_sweep(spark, "/root/testdata/sf0.001")
    df, alphas = e.value.args
    assert alphas == [1e-6, 1e-4, 1e-3, 1e-2, 0.1, 1.0]
    for r in df.groupBy("species").agg({"f1": "avg"}).join(df.groupBy("species").agg({"f1": "stddev_pop"}), "species").collect():
        assert abs(r["avg(f1)"]) < 1e-6 and (math.isclose(r["stddev_pop(f1)"], 1, rel_tol=1e-6) or r["stddev_pop(f1)"] == 0)


def _presences(n, seed, species=("a", "b", None)):
    rng = np.random.default_rng(seed)
    x = rng.normal([5.0, -2.0], [3.0, 0.5], size=(n, 2))
    y = (rng.random(n) < 1 / (1 + np.exp(1 - (x @ [0.4, 1.0])))).astype(int)
    return [(i, species[i % len(species)], float(x[i, 0]), float(x[i, 1]), 7.0, int(y[i]), 1.0 if y[i] else 1e-4, i % 5) for i in range(n)]


_PRESENCES = "id long, species string, f1 double, f2 double, same double, label int, target double, fold int"


def test_variants_are_separate_fits(spark, monkeypatch):
    """Rows are shared, results aren't: each fold and penalty is what a fit of just its rows gives, null keys included."""
    monkeypatch.setattr(models, "BROADCAST_MODELS", 8)  # two groups of models
    rows = _presences(240, 3)
    rows[0] = (*rows[0][:2], None, *rows[0][3:])  # fold 0 of species a can only be held
    df = spark.createDataFrame(rows, _PRESENCES)
    found = models.fit_variants(df, ["species"], ["f1", "f2"], same, [(None, 0.01), *[(k, a) for k in range(2) for a in (0.01, 1.0)]], fold="fold").collect()
    assert len(found) == 15
    for r in (r for r in found if r.held == 1 or r.alpha == 1.0 and r.species is None):
        part = df.where(df.species.eqNullSafe(r.species)).where("true" if r.held is None else f"fold <> {r.held}")
        (one,) = models.fit(part, ["species"], ["f1", "f2"], same, alpha=r.alpha).collect()
        assert (one.status, one.n) == (r.status, r.n) and (r.status == "fail" or np.allclose(one.beta, r.beta, atol=1e-9))
    assert {(r.held, r.status) for r in found if r.species == "a"} == {(None, "fail"), (0, "ok"), (1, "fail")}
    scored = models.cross_validate(df.where("fold < 3"), ["species"], ["f1", "f2"], [0.01, 1.0], same)
    assert scored.count() == 2 * df.where("fold < 3").count()
    gone = scored.where("score is null").select("species", "fold", "id").distinct().collect()
    assert all(r.species == "a" for r in gone) and {r.fold for r in gone} == {0, 1, 2}


def test_slopes_of_variants(spark):
    """Each model's slope is that over its own training rows, null keys and folds included, and no row is sorted for it."""
    rows = _presences(120, 5)
    rows[7] = (*rows[7][:7], None)  # trains everywhere
    df = spark.createDataFrame(rows, _PRESENCES)
    fitted = models.fit_variants(df, ["species"], ["f1", "f2"], same, [(None, 0.01), (0, 0.01), (0, 1.0), (3, 1.0)], fold="fold", rounds=2)
    moved = fitted.withColumn("status", F.lit("ok"))  # not at the optimum, so that slopes aren't zero
    slopes = models.gradient(df, moved, ["species"], ["f1", "f2"], fold="fold")
    got = {(r.species, r.held, r.alpha, r.term): (r.n, r.gradient) for r in slopes.collect()}
    assert len(got) == 3 * 4 * 3
    for m in moved.collect():
        own = [r for r in rows if r[1] == m.species and (m.held is None or r[7] != m.held)]
        x, y = np.array([(1, *r[2:4]) for r in own]), np.array([r[6] for r in own])
        want = x.T @ (np.exp(x @ m.beta) - y) / len(own) + m.alpha * np.array([0, *m.beta[1:]])
        for term, slope in zip(["intercept", "f1", "f2"], want):
            n, found = got[m.species, m.held, m.alpha, term]
            assert n == len(own) and math.isclose(found, slope, rel_tol=1e-9, abs_tol=1e-12)
    assert max(abs(g) for _, g in got.values()) > 1e-3
    one = models.gradient(df, models.fit(df, ["species"], ["f1", "f2"], same), ["species"], ["f1", "f2"])
    for found in (slopes, one):
        assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def _stored(spark):
    df = spark.createDataFrame(_presences(300, 4), _PRESENCES)
    names = ["f1", "f2", "same"]
    scaler = features.scaler(df, names, ["species"])
    scaled = features.scaled(df, scaler, names, ["species"])
    cuts = spark.createDataFrame([("a", 0.3), ("b", 0.4), (None, 0.5)], "species string, threshold double")
    fitted = models.fit(scaled, ["species"], names, same)
    return df, names, scaled, fitted, models.stored(df, fitted, ["species"], names, same, scaler, cuts)


def test_stored_models_scale_new_rows(spark, tmp_path):
    """A row alone, in a batch and in a stream: one result, by the scaler, top and threshold of the training rows."""
    df, names, scaled, fitted, table = _stored(spark)
    table.write.parquet(str(tmp_path / "models"))
    table = spark.read.parquet(str(tmp_path / "models"))
    assert table.count() == 3 and {r.threshold for r in table.collect()} == {0.3, 0.4, 0.5}
    train = models.predict_presence(df, table, ["species"], names)
    by_hand = metrics.normalized(models.score(scaled, fitted, ["species"], names), ["species"])
    a, b = ({r.id: r.intensity for r in d.collect()} for d in (train, by_hand))
    assert len(a) == 300 and all(math.isclose(a[k], b[k], abs_tol=1e-8) for k in a)
    new = spark.createDataFrame([(*r[:4], 9.0) for r in _presences(40, 9, ("a", "b", None, "unknown"))] + [(99, "a", None, 1.0, 7.0)], "id long, species string, f1 double, f2 double, same double")
    got = {r.id: (r.intensity, r.present) for r in models.predict_presence(new, table, ["species"], names).collect()}
    assert got[99] == (None, None) and {got[k] for k in range(3, 40, 4)} == {(None, None)}
    for k in (0, 1, 2):
        (alone,) = models.predict_presence(new.where(f"id = {k}"), table, ["species"], names).collect()
        assert (alone.intensity, alone.present) == got[k] and alone.present == int(alone.intensity >= {0: 0.3, 1: 0.4, 2: 0.5}[k])
    batch = models.predict_presence(new, table, ["species"], names, mode="batch").groupBy("species").agg({"intensity": "max"}).collect()
    assert {r.species: r[1] for r in batch} == {"a": 1.0, "b": 1.0, None: 1.0, "unknown": None}
    with pytest.raises(ValueError):
        models.predict_presence(new, table, ["species"], names, mode="none")
    new.write.parquet(str(tmp_path / "new"))
    stream = models.predict_presence(spark.readStream.schema(new.schema).parquet(str(tmp_path / "new")), table, ["species"], names)
    run = stream.writeStream.format("memory").queryName("presences").option("checkpointLocation", str(tmp_path / "state")).start()
    run.processAllAvailable()
    run.stop()
    assert {r.id: (r.intensity, r.present) for r in spark.table("presences").collect()} == got


def test_report_is_that_of_its_parts(spark):
    rng = np.random.default_rng(8)
    rows = [("x" if i % 2 else "y", float(round(rng.random(), 1)), int(rng.random() < 0.4)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, score double, label int")
    best = {r.g: r for r in metrics.best_f1(df, ["g"]).collect()}
    auc = {r.g: r.auc for r in metrics.roc_auc(df, ["g"]).collect()}
    for cuts in (None, {"x": 0.55, "y": 2.0}):
        table = cuts and spark.createDataFrame(list(cuts.items()), "g string, threshold double")
        for r in metrics.report(df, ["g"], table).collect():
            at = cuts[r.g] if cuts else best[r.g].threshold
            cells = [sum(g == r.g and (s >= at) == p and y == q for g, s, y in rows) for p, q in ((False, 0), (True, 0), (False, 1), (True, 1))]
            assert [r.tn, r.fp, r.fn, r.tp] == cells and r.threshold == at and math.isclose(r.auc, auc[r.g])
            assert math.isclose(r.f1, 2 * r.tp / max(2 * r.tp + r.fp + r.fn, 1))
