"""Observation dumps that arrive in a folder: cleaned and appended by species as they come."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import clean_observations
from ..sources.readers import typed
from ..sources.writers import write_partitioned


#: Parts that the index of ids is cut into, by a hash of the id.
BUCKETS = 256
_INDEX = "obs_id string, batch long, bucket int"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """What the path holds; None if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _numbered(ids: DataFrame, batch: int) -> DataFrame:
    id_text = F.col("obs_id").cast("string")
    return ids.select(id_text.alias("obs_id"), F.lit(batch).cast("long").alias("batch"), F.pmod(F.xxhash64(id_text), F.lit(BUCKETS)).cast("int").alias("bucket"))


def append_new(batch: DataFrame, root: str, number: int) -> None:
    """Append the records of a batch whose obs_id root doesn't hold, one of each; those without an id all stay.

    The ids that root holds are also kept beside it, in root + "_ids", by buckets of their hash and with the number of the
    batch they came with. A batch reads only the buckets that its own ids fall into, and nothing of the records: a small
    batch touches a small part of the history. Ids are written before records; so if ids of this very number are there, the
    batch came before and may have failed in between, and root itself is asked, too. Coming twice it adds nothing the
    second time, save records without an id. A root without an index gets one first.
    """
    spark, ids_at = batch.sparkSession, root.rstrip("/") + "_ids"
    kind = dict(batch.dtypes)["obs_id"]
    batch = batch.persist()
    index, held = _read(spark, ids_at, _INDEX), _read(spark, root, f"obs_id {kind}")
    if index is None and held is not None:
        write_partitioned(_numbered(held.where("obs_id is not null").distinct(), -1), ids_at, "bucket")
        index = _read(spark, ids_at, _INDEX)
    named = batch.where("obs_id is not null").dropDuplicates(["obs_id"])
    own = _numbered(named, number)
    if index is not None:
        near = index.where(F.col("bucket").isin([r["bucket"] for r in own.select("bucket").distinct().collect()]))
        mine = near.where(F.col("batch") == number).select("obs_id")
        gone = near.where(F.col("batch") != number).select(F.col("obs_id").cast(kind).alias("obs_id"))
        named = named.join(gone, "obs_id", "left_anti").persist()
        own = _numbered(named, number).join(mine, "obs_id", "left_anti").select("obs_id", "batch", "bucket")
        if held is not None and mine.limit(1).count():
            named = named.join(held, "obs_id", "left_anti")
    # What is read is fixed before anything is written.
    named, own = named.persist(), own.persist()
    named.count(), own.count()
    write_partitioned(own, ids_at, "bucket")
    write_partitioned(named.select(*batch.columns).unionByName(batch.where("obs_id is null")), root)
    for df in (named, own, batch):
        df.unpersist()


def ingest(spark: SparkSession, folder: str, root: str, checkpoint: str, columns: list[str]):
    """A running query over tab-separated files in folder: columns must hold obs_id and those that cleaning reads.

    Batches are appended to root by species. A record whose obs_id root already holds is dropped, however long ago it
    came; records of any observation date are taken, in any order. Files that are there already are read first, then
    the query waits; call processAllAvailable().
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.readStream.schema(schema).option("sep", "\t").option("header", True).csv(folder)
    cleaned = clean_observations(typed(raw, {"effort_distance_km": "double", "longitude": "double", "latitude": "double"}))
    return cleaned.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, number: append_new(df, root, number)).start()


def monthly_counts(spark: SparkSession, root: str, schema: T.StructType, window: str = "30 days", late: str = "60 days"):
    """A streaming frame of records by species and window over cleaned Parquet; windows close behind the watermark."""
    rows = spark.readStream.schema(schema).parquet(root).withColumn("seen", F.col("date").cast("timestamp"))
    return rows.withWatermark("seen", late).groupBy("scientific_name", F.window("seen", window)).count()
