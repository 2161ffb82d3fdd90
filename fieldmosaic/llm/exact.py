"""Exact deduplication over a cuckoo-filter index of live digests (operator 9).

The key of a text is its SHA-256. Each task first combines its own rows by key, so a text that a third of all
rows share reaches the index once per task. Keys are dealt to BUCKETS digest ranges; a task goes through the
sorted ranges one by one and holds the index of one range only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Digest ranges, each indexed on its own: 65,536 take 5e10 documents at under a million each.
BUCKETS = 1 << 16
_SLOTS, _KICKS = 4, 200


class CuckooIndex:
    """A cuckoo filter of 16-bit marks in front of buckets of whole keys with a value each.

    A key without a mark in its two filter buckets is certainly absent. A mark is a hit only if the key itself
    is in its content bucket. When an insertion finds no room after _KICKS moves, the filter doubles and is
    filled anew from the stored keys.
    """

    def __init__(self, buckets: int = 8) -> None:
        self._build(buckets, [])

    def _build(self, buckets: int, stored: list[tuple[bytes, object]]) -> None:
        while True:
            self.mask = buckets - 1
            self.marks: list[list[int]] = [[] for _ in range(buckets)]
            self.content: list[list[list]] = [[] for _ in range(buckets)]
            self.size = 0
            if all(self._put(k, v) for k, v in stored):
                return
            buckets *= 2

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[8:10], "little") or 1
        first = int.from_bytes(key[:8], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, at: int, mark: int) -> int:
        return at ^ (mark * 0x5BD1E995 >> 7 & self.mask)

    def _put(self, key: bytes, value: object) -> bool:
        mark, first, second = self._places(key)
        for at in (first, second):
            if len(self.marks[at]) < _SLOTS:
                self.marks[at].append(mark)
                break
        else:
            at = first
            for kick in range(_KICKS):
                slots = self.marks[at]
                slots.append(mark)
                mark = slots.pop(kick % _SLOTS)
                at = self._other(at, mark)
                if len(self.marks[at]) < _SLOTS:
                    self.marks[at].append(mark)
                    break
            else:
                return False
        self.content[first].append([key, value])
        self.size += 1
        return True

    def find(self, key: bytes) -> list | None:
        """The [key, value] entry that the index holds, or None."""
        mark, first, second = self._places(key)
        if mark not in self.marks[first] and mark not in self.marks[second]:
            return None
        return next((x for x in self.content[first] if x[0] == key), None)

    def insert(self, key: bytes, value: object) -> None:
        """For a key that isn't there yet."""
        if not self._put(key, value):
            self._build(2 * (self.mask + 1), [tuple(x) for x in self.entries()] + [(key, value)])

    def delete(self, key: bytes) -> bool:
        entry = self.find(key)
        if entry is None:
            return False
        mark, first, second = self._places(key)
        self.content[first].remove(entry)
        self.marks[first if mark in self.marks[first] else second].remove(mark)
        self.size -= 1
        return True

    def entries(self) -> Iterator[list]:
        for x in self.content:
            yield from x


def _later(a: tuple, b: tuple) -> bool:
    """Whether row b (doc_id, row) stays rather than a: the larger id, null being the smallest, then the later row."""
    return (b[0] is not None, b[0] or 0, b[1]) > (a[0] is not None, a[0] or 0, a[1])


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, digest (32 bytes) and a number of each row, written once so that the numbers hold."""
    rows = common.pick(docs, doc_id=doc_id, text=text)
    rows = rows.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), F.monotonically_increasing_id().alias("row"))
    return common.stage(rows, "keys")


_GROUP = "digest binary, keep_id long, keep_row long, group_size long"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each key and about 200,000 rows of a task."""
    held: dict[bytes, list] = {}
    for batch in batches:
        for key, i, row in zip(*(c.to_pylist() for c in batch.columns)):
            x = held.get(key)
            if x is None:
                held[key] = [i, row, 1]
            else:
                x[2] += 1
                if _later(x, (i, row)):
                    x[:2] = i, row
        if len(held) >= 200_000:
            yield _rows(held.items())
            held = {}
    if held:
        yield _rows(held.items())


def _rows(items) -> pa.RecordBatch:
    keys, values = zip(*items)
    ids, rows, counts = zip(*values)
    cols = [pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(cols, ["digest", "keep_id", "keep_row", "group_size"])


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by bucket: each bucket's keys pass through an index of their own."""
    index, now = CuckooIndex(), None
    ready: list = []
    for batch in batches:
        for bucket, key, i, row, n in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != now:
                ready += index.entries()
                index, now = CuckooIndex(), bucket
                if len(ready) > 20_000:
                    yield _rows(ready)
                    ready = []
            entry = index.find(key)
            if entry is None:
                index.insert(key, [i, row, n])
                continue
            held = entry[1]
            held[2] += n
            if _later(held, (i, row)):
                held[:2] = i, row
    ready += index.entries()
    if ready:
        yield _rows(ready)


def groups(rows: DataFrame) -> DataFrame:
    """Of keyed() rows: digest, keep_id, keep_row and group_size, one row for each text."""
    partial = rows.select("digest", "doc_id", "row").mapInArrow(_combine, _GROUP)
    bucket = F.conv(F.hex(F.substring("digest", 31, 2)), 16, 10).cast("int") % F.lit(BUCKETS)
    dealt = partial.select(bucket.alias("bucket"), "*").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_indexed, _GROUP)


def update_index(index: DataFrame, added: DataFrame, deleted: DataFrame) -> DataFrame:
    """The live digests after changes: index, added and deleted have digest; the result has digest and n.

    index may have n (1 if not). Each added row counts one, each deleted row takes one; a digest whose count
    reaches zero is deleted from the index. Deletions of what isn't live change nothing. Nulls are ignored.
    """
    n = F.col("n").cast("long") if "n" in index.columns else F.lit(1).cast("long")
    events = index.select("digest", F.lit(0).alias("step"), n.alias("n"))
    for step, df, sign in ((1, added, 1), (2, deleted, -1)):
        events = events.unionByName(df.groupBy("digest").agg((F.count("*") * sign).alias("n")).select("digest", F.lit(step).alias("step"), "n"))
    bucket = F.conv(F.hex(F.substring("digest", 31, 2)), 16, 10).cast("int") % F.lit(BUCKETS)
    dealt = events.where("digest is not null").select(bucket.alias("bucket"), "*").repartition("bucket").sortWithinPartitions("bucket", "step")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, now = CuckooIndex(), None

        def out():
            held = list(index.entries())
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.binary()), pa.array([v for _, v in held], pa.int64())], ["digest", "n"])

        for batch in batches:
            for b, key, _, n in zip(*(c.to_pylist() for c in batch.columns)):
                if b != now:
                    if index.size:
                        yield out()
                    index, now = CuckooIndex(), b
                entry = index.find(key)
                if entry is None:
                    if n > 0:
                        index.insert(key, n)
                elif entry[1] + n > 0:
                    entry[1] += n
                else:
                    index.delete(key)
        if index.size:
            yield out()

    return dealt.mapInArrow(run, "digest binary, n long")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and so are equal to empty ones. Of equal texts the row with the largest doc_id is
    kept; of repeated ids with the same text exactly one row is kept; a null id is the smallest. Empty tables
    give empty results; other columns are ignored.
    """
    rows = keyed(docs, text, doc_id)
    found = groups(rows).withColumnRenamed("digest", "of")
    joined = rows.join(found, rows["digest"] == found["of"])
    return joined.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without the rows that exact_groups() drops; all columns stay.

    The texts are dealt by digest and id, so a text that many rows share isn't gathered in one task. They are dealt
    again only if rows are found that are equal in both.
    """
    rows = keyed(docs, text, doc_id)
    found = groups(rows).select(F.col("digest").alias("__of"), F.col("keep_id").alias("__id"))
    marked = docs.withColumn("__digest", F.unhex(F.sha2(F.coalesce(docs[f"`{text}`"], F.lit("")), 256)))
    kept = marked.join(found, (F.col("__digest") == F.col("__of")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")), "left_semi")
    if common.repeats(rows, "digest", "doc_id"):
        kept = kept.dropDuplicates(["__digest", doc_id])
    return kept.drop("__digest")


def op9_exact(spark, sf_dir: str) -> DataFrame:
    """Exact groups of all documents."""
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
  count(*) over (partition by coalesce(text, '')) as group_size,
  doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents
"""
