"""What filters do in every order they may be applied in (operator 11).

Documents are reduced to the set of filters that they fail, and these sets to counts: at most 2^n a part. Under a set, a
filter removes at one step in just those orders that begin with filters outside the set and go on with that filter, and
the orders of one beginning are neighbours by Lehmer rank. So each set and step is a few intervals of ranks: counts are
added where an interval starts, taken off where it ends, and a running sum over the ranks gives all orders at once.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

FILTERS = "ABCDE"
#: Parts whose 120 orders a task works out at once.
PARTS = 200
_SPACE = r"[\x20\x09-\x0D]+"


def lehmer_interval(start: list[int], n: int) -> tuple[int, int]:
    """Ranks (from, to) of the permutations of 0 to n-1, in lexicographic order, that begin with `start`."""
    free, rank = list(range(n)), 0
    for k, x in enumerate(start):
        rank += free.index(x) * math.factorial(n - 1 - k)
        free.remove(x)
    return rank, rank + math.factorial(n - len(start))


def removal_intervals(n: int) -> Iterator[tuple[int, int, int, int]]:
    """(set, step from 0, from, to): the ranks at which what fails the filters of the set (bits) is removed at that step."""
    for mask in range(1, 1 << n):
        inside = [f for f in range(n) if mask >> f & 1]
        outside = [f for f in range(n) if not mask >> f & 1]
        for step in range(len(outside) + 1):
            for before in itertools.permutations(outside, step):
                for f in inside:
                    yield mask, step, *lehmer_interval([*before, f], n)


def removed_by_rank(counts: np.ndarray, n: int) -> np.ndarray:
    """counts[..., set] to removed[..., step, rank], by differences at interval ends and one running sum over ranks."""
    orders = math.factorial(n)
    ends = np.zeros((1 << n, n, orders + 1), np.int64)
    for mask, step, start, end in removal_intervals(n):
        ends[mask, step, start] += 1
        ends[mask, step, end] -= 1
    differences = np.tensordot(counts, ends, axes=([-1], [0]))
    return np.cumsum(differences[..., :-1], axis=-1)


_SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """part, mask, n, good, toxic (documents that fail just the filters of mask, bit k being filters[k]) to a row for
    each part, order of the filters and step.

    Masks may come several times; their counts add up. Up to seven filters, as all orders are listed.
    """
    n = len(filters)
    if not 1 <= n <= 7:
        raise ValueError("one to seven filters")
    summed = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    # At most 2^n rows a part, whatever its size.
    sets = summed.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.array(list(itertools.permutations(range(n))))
        names = np.array(["".join(filters[f] for f in o) for o in order])
        fails = np.array([[mask >> f & 1 for f in range(n)] for mask in range(1 << n)])
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS):
                rows = batch.slice(at, PARTS).to_pydict()
                p = len(rows["part"])
                held = np.zeros((p, 3, 1 << n), np.int64)
                for k, own in enumerate(rows["sets"]):
                    for x in own:
                        held[k, :, x["mask"]] = x["n"], x["good"], x["toxic"]
                lost = removed_by_rank(held, n).transpose(0, 1, 3, 2)  # part, measure, rank, step
                removed, good, toxic = lost[:, 0], lost[:, 1], lost[:, 2]
                kept = held[:, 0].sum(-1)[:, None, None] - np.cumsum(removed, axis=-1)
                redundant = (held[:, 0] @ fails)[:, order] - removed
                unique = held[:, 0][:, 1 << np.arange(n)][:, order]
                shapley = np.stack([(removed * (order == f)).sum((1, 2)) for f in range(n)], 1)[:, order]
                size = p * order.size
                steps = pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), p * len(order)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(rows["part"], object), order.size), pa.string()), pa.array(np.tile(np.repeat(names, n), p), pa.string()), steps, *[pa.array(x.reshape(size)) for x in (kept, removed, redundant, unique, good, toxic, shapley)]],
                    [x.split()[0] for x in _SCHEMA.split(", ")],
                )

    return sets.mapInArrow(run, _SCHEMA)


def text_filters(text: Column) -> list[Column]:
    """Whether a text fails A (under 50 words), B (under 65 % distinct words), C (over 5 % capitals), D (a symbol)."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]")]


def failed(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """A row for each document: part, mask of the filters A to E that it fails, good and toxic (0 or 1).

    E is for texts that a smaller doc_id has, too; repeated rows of one id aren't smaller than each other, and a null id
    is neither smaller nor larger than any. Null texts and parts are empty ones; an empty text fails A, and E if it is
    repeated. A document is good (toxic) if any of its label rows says 1; labels without an id are no one's. Texts are
    compared by SHA-256. Empty tables give no rows; other columns are ignored.
    """
    rows = common.pick(docs, doc_id=doc_id, text=text, part=part)
    whole = F.coalesce("text", F.lit(""))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_filters(whole))), F.lit(0))
    slim = common.stage(rows.select("doc_id", F.coalesce("part", F.lit("")).alias("part"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("sha"), mask.alias("mask")), "audit")
    marks = common.pick(labels, id="doc_id", quality="quality", toxic="toxic").where("id is not null")
    marks = marks.groupBy("id").agg(*[F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    labelled = slim.join(marks, slim["doc_id"] == marks["id"], "left")
    # Joined by text and id together, so that a text of many copies isn't one key.
    first = slim.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("first")).select(F.col("sha").alias("of"), "first")
    met = labelled.join(first, (F.col("sha") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left")
    again = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return met.select("part", (F.col("mask") + F.when(again, 1 << 4).otherwise(0)).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The five filters in all 120 orders over all documents, for each source."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return interactions(failed(docs, labels).select("part", "mask", F.lit(1).alias("n"), "good", "toxic"))


OP11_SQL = r"""
with marks as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels where doc_id is not null group by doc_id),
d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by coalesce(text, '')) as first from documents),
m as (select part, concat(case when len(ws) < 50 then 'A' else '' end, case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 'B' else '' end,
    case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end, case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end,
    case when d.doc_id > first then 'E' else '' end) as mask, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from d left join marks on d.doc_id = marks.doc_id),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, mask),
l(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
o as (select concat(a.x, b.x, c.x, d.x, e.x) as filter_order from l a, l b, l c, l d, l e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, cast(step as int) as step, substr(filter_order, step, 1) as f, substr(filter_order, 1, step - 1) as earlier from o, range(1, 6) as r(step)),
r as (select part, filter_order, step, f,
    sum(case when contains(mask, f) and translate(mask, earlier, '') = mask then n else 0 end) as removed,
    sum(case when contains(mask, f) and translate(mask, earlier, '') <> mask then n else 0 end) as redundant,
    sum(case when mask = f then n else 0 end) as unique_fails,
    sum(case when contains(mask, f) and translate(mask, earlier, '') = mask then good else 0 end) as good_lost,
    sum(case when contains(mask, f) and translate(mask, earlier, '') = mask then toxic else 0 end) as toxic_lost, sum(n) as total
  from c, s group by part, filter_order, step, f)
select part, filter_order, step, cast(total - sum(removed) over (partition by part, filter_order order by step) as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, f) as bigint) as shapley from r"""
