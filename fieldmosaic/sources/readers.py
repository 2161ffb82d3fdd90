"""Delimited text, species-partitioned Parquet and polygons."""

from __future__ import annotations

import csv
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A quoted, tab-separated dump as strings. Rows with more fields than columns are left out, short ones are padded.
    Lines of nothing but white space and tabs hold no record.

    Fields are counted in a further column, as the reader's own drop mode would lose short rows too.
    """
    extra = "__more"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, extra]])
    rows = spark.read.csv(path, schema=schema, sep="\t", quote='"', escape='"', header=True, mode="PERMISSIVE", enforceSchema=True)
    return rows.where(F.col(extra).isNull()).drop(extra)


def read_inferred(spark: SparkSession, path: str, sep: str = "\t", ratio: float = 1.0) -> DataFrame:
    """A delimited dump with the types that its values have; ratio: the share of rows that is looked at for them.

    A pass of its own over the data: jobs that know their columns name them instead.
    """
    return spark.read.csv(path, sep=sep, quote='"', escape='"', header=True, inferSchema=True, samplingRatio=ratio)


#: Types that a column of text may have, the narrower first, and what a value of each looks like.
LATTICE = {"bigint": r"^[+-]?[0-9]{1,18}$", "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$", "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "boolean": "^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$"}


def type_counts(df: DataFrame) -> list[Column]:
    """Aggregates over columns of text: for the k-th, n<k> known values and n<k>_<type> that aren't of each type.

    They are plain sums, so those of parts, files or batches add up to those of the whole.
    """
    out = []
    for k, c in enumerate(df.columns):
        value = F.col(f"`{c}`")
        out.append(F.count(value).alias(f"n{k}"))
        for t, pattern in LATTICE.items():
            is_one = value.rlike(pattern) if t != "date" else value.rlike(pattern) & value.try_cast("date").isNotNull()
            out.append(F.count(F.when(value.isNotNull() & ~is_one, 1)).alias(f"n{k}_{t}"))
    return out


def types_of(columns: list[str], counts: dict[str, int]) -> dict[str, str]:
    """The narrowest type that all known values of each column have; string if there is none, or no known value."""
    fits = lambda k: [t for t in LATTICE if counts[f"n{k}"] and not counts[f"n{k}_{t}"]]
    return {c: next(iter(fits(k)), "string") for k, c in enumerate(columns)}


def ingest_inferred(spark: SparkSession, path: str, columns: list[str], stage: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """A quoted, tab-separated dump (see ingest_tsv) with the types that its values have, and name, type, known and
    not_<type> of each column. The counts are taken while the rows are written: one pass over the dump."""
    rows, seen = ingest_tsv(spark, path, columns), Observation()
    staged = stage(rows.observe(seen, *type_counts(rows)))
    counts = seen.get
    types = types_of(rows.columns, counts)
    table = [(c, types[c], counts[f"n{k}"], *[counts[f"n{k}_{t}"] for t in LATTICE]) for k, c in enumerate(rows.columns)]
    found = spark.createDataFrame(table, "name string, type string, known long, " + ", ".join(f"not_{t} long" for t in LATTICE))
    return typed(staged, {c: t for c, t in types.items() if t != "string"}), found


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast leniently: a value that doesn't parse becomes null and its row stays."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows under all columns, null where a frame lacks one. A column must have one type throughout."""
    types: dict[str, str] = {}
    for df in frames:
        for c, t in df.dtypes:
            if types.setdefault(c, t) != t:
                raise TypeError(f"column {c} is {types[c]} and {t}")
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_csv_groups(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV files (or patterns) whose headers differ, as strings under all their columns; null where a file lacks one.

    Two jobs, however many files there are: the first lines of all files are found in one pass over their lines, and then
    all files are one read by place, each value taken from where its file's own header has the column. Only the different
    headers reach the driver. A line that repeats its file's header holds no record; a header is one line.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("__file"), "value", F.monotonically_increasing_id().alias("at"))
    firsts = lines.groupBy("__file").agg(F.min_by("value", "at").alias("line"))
    found = firsts.groupBy("line").agg(F.min("__file").alias("first")).orderBy("first").collect()
    headers = [(r["line"], next(csv.reader([r["line"].removeprefix("\ufeff")]), [])) for r in found]
    names = list(dict.fromkeys(n for _, fields in headers for n in fields))
    if not names:
        raise ValueError(f"no header in {paths}")
    for _, fields in headers:
        if len(set(fields)) < len(fields):
            raise ValueError(f"a header names a column twice: {fields}")
    wide = T.StructType([T.StructField(f"__c{k}", T.StringType()) for k in range(max(len(f) for _, f in headers))])
    rows = spark.read.csv(paths, schema=wide, header=False, escape='"').select("*", F.col("_metadata.file_path").alias("__file"))
    own = firsts.join(F.broadcast(spark.createDataFrame(headers, "line string, __fields array<string>")), "line").select("__file", "__fields")
    met = rows.join(own, "__file").withColumn("__values", F.array(*wide.names))
    met = met.where(F.slice("__values", 1, F.size("__fields")) != F.col("__fields"))
    place = lambda n: F.array_position("__fields", n).cast("int") - 1
    return met.select(*[F.when(place(n) >= 0, F.get("__values", F.greatest(place(n), F.lit(0)))).alias(n) for n in names])


def read_csv_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """All CSV files that the pattern names, whatever their headers."""
    return read_csv_groups(spark, pattern)


def species_partition(spark: SparkSession, root: str, species: str) -> DataFrame:
    """One species of a partitioned dataset; only its folder is read."""
    return spark.read.parquet(root).where(F.lower("scientific_name") == species)


def to_wkb(vertices: DataFrame) -> DataFrame:
    """poly_id, geometry: little-endian WKB polygons of vertices (poly_id, ring_id, seq, x, y)."""
    points = F.array_sort(F.collect_list(F.struct("seq", "x", "y")))
    rings = vertices.groupBy("poly_id", "ring_id").agg(points.alias("points"))
    polygons = rings.groupBy("poly_id").agg(F.array_sort(F.collect_list(F.struct("ring_id", "points"))).alias("rings"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rings in batch.column("rings").to_pylist():
                raw = struct.pack("<BII", 1, 3, len(rings))
                for ring in rings:
                    raw += struct.pack("<I", len(ring["points"])) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in ring["points"])
                out.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column("poly_id"), pa.array(out, pa.binary())], ["poly_id", "geometry"])

    return polygons.mapInArrow(run, f"poly_id {dict(vertices.dtypes)['poly_id']}, geometry binary")


def _rings(raw: bytes) -> Iterator[list[tuple[float, float]]]:
    """Rings of a WKB polygon or multipolygon of either byte order."""

    def one(at: int) -> tuple[list, int]:
        order = "<" if raw[at] else ">"
        (kind,) = struct.unpack_from(f"{order}I", raw, at + 1)
        (n,) = struct.unpack_from(f"{order}I", raw, at + 5)
        at, rings = at + 9, []
        for _ in range(n):
            if kind == 3:
                (m,) = struct.unpack_from(f"{order}I", raw, at)
                flat = struct.unpack_from(f"{order}{2 * m}d", raw, at + 4)
                rings.append(list(zip(flat[::2], flat[1::2])))
                at += 4 + 16 * m
            elif kind == 6:
                more, at = one(at)
                rings += more
            else:
                raise ValueError(f"geometry type {kind} isn't a polygon")
        return rings, at

    yield from one(0)[0]


def wkb_vertices(polygons: DataFrame) -> DataFrame:
    """poly_id, ring_id, seq, x, y of polygons (poly_id, geometry: WKB). Holes are rings like others; null has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for poly, raw in zip(batch.column("poly_id").to_pylist(), batch.column("geometry").to_pylist()):
                for r, ring in enumerate(_rings(raw) if raw else ()):
                    for s, (x, y) in enumerate(ring):
                        for c, v in zip(out, (poly, r, s, x, y)):
                            c.append(v)
            kinds = [batch.schema.field("poly_id").type, pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["poly_id", "ring_id", "seq", "x", "y"])

    return polygons.select("poly_id", "geometry").mapInArrow(run, f"poly_id {dict(polygons.dtypes)['poly_id']}, ring_id int, seq int, x double, y double")
