"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that a Python task works on at once.
CHUNK_BYTES = 2_000_000
#: Bytes of the rows that Spark hands to a Python task at once; its own bound is 10,000 rows, however long.
BATCH_BYTES = 1_800_000
#: Rows that may be broadcast; tables beyond it are joined by a shuffle.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is made only if a local session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again, which cuts its lineage.

    A lost executor then costs only the tasks that ran there: finished stages are read from the folder.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Collect the driver's garbage, as Spark removes the files of a shuffle when nothing refers to it any more.

    Python's comes first, as its frames hold Spark's. Spark's listeners hold a query's plan until they have heard of its
    end: without a moment's wait, the last query's files stay.
    """
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.5)
    spark._jvm.System.gc()


def release(*staged: DataFrame) -> None:
    """Remove what stage() wrote for these, once everything that is made of them is written itself, and shuffles' files."""
    for df in staged:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if staged:
        sweep(staged[0].sparkSession)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is counted to have at most that many rows, otherwise as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def repeats(df: DataFrame, *columns: str) -> bool:
    """Whether any rows are equal in these columns."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under fixed names: other columns can't clash with the operator's own."""
    return df.select(*[df[f"`{c}`"].alias(name) for name, c in cols.items()])


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """df.mapInArrow(run, schema) by batches of some BATCH_BYTES, or of as many as the session says itself.

    A batch lies in the executor and in the Python task, by vectors that double as they grow, so long rows by the
    thousand cost each of them a multiple of the texts. The bound stays set in the session, as plans are run later.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about size bytes; a longer text is a slice of its own."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text)).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            n = (n or 0) + 64
            if i > start and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if len(lengths) > start:
            yield batch.slice(start)


def crc_of_id(column: str = "doc_id"):
    """crc32 of the id written as text, as the contracts split the rows."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
