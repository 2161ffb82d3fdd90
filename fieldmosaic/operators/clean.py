"""Cleaning of occurrence records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import from_parts, lenient_date, year_of
from ..functions.names import species_key
from .ranges import running


def clean_observations(occ: DataFrame, first_year: int = 2017, last_year: int = 2024, most_km: float = 0.1) -> DataFrame:
    """Records of those years with little effort distance, or stationary ones. A null distance passes only if stationary."""
    years = year_of(F.col("observation_date")).between(first_year, last_year)
    effort = (F.col("effort_distance_km") < most_km) | (F.col("protocol_name") == "Stationary")
    kept = occ.where(years & effort)
    return kept.withColumn("scientific_name", species_key(F.col("scientific_name"))).withColumn("date", lenient_date(F.col("observation_date")))


def clean_records(gbif: DataFrame, most_m: float = 100.0) -> DataFrame:
    """Records without nulls, with a date that exists and a coordinate uncertainty of at most so many metres."""
    dated = gbif.withColumn("date", from_parts(F.col("year"), F.col("month"), F.col("day")))
    columns = ["obs_id", "basisofrecord", "species", "latitude", "longitude", "coordinateuncertaintyinmeters", "date"]
    return dated.select(*columns).na.drop("any").where(F.col("coordinateuncertaintyinmeters") <= most_m)


def only_species(df: DataFrame, names: DataFrame, column: str = "scientific_name") -> DataFrame:
    """Rows whose species is in the list (column species), both by their key."""
    keys = names.select(species_key(F.col("species")).alias("__key")).distinct()
    return df.join(keys, species_key(F.col(column)) == F.col("__key"), "left_semi")


def ordered_slices(df: DataFrame, n: int, order: str, key: list[str] | None = None) -> DataFrame:
    """Slice numbers 0..n-1 of rows in order, n // slices + 1 rows each, within each key.

    Ranks are counted range by range, of a hot key, too: rows of a range are numbered by themselves and then shifted by
    how many the earlier ones hold, so that no task sees all rows.
    """
    found = ranked(df, order, key)
    step = F.floor(F.col("__n") / n) + 1
    return found.withColumn("slice", F.floor(F.col("__rank") / step).cast("int")).drop("__rank", "__n")


def ranked(df: DataFrame, order: str, key: list[str] | None = None) -> DataFrame:
    """df with __rank (from 0) and __n, within each key, by a distinct, not null, numeric order, without a single-task window."""
    found = running(df, key or [], order, {"__upto": F.lit(1)}, totals={"__n": F.lit(1)})
    return found.withColumn("__rank", F.col("__upto") - 1).drop("__upto")


def run_status(results: DataFrame) -> DataFrame:
    """species, status, error of the runs that failed."""
    return results.where(F.col("status") == "fail").select("species", "status", "error")
