"""Language identification by prediction by partial matching (operator 4).

Each language has a context tree over bytes, of orders 0 to DEPTH, with escapes by method C: a byte seen c times
after a context seen n times with d different bytes has c/(n+d), and d/(n+d) escapes to the next shorter
context; below order 0 all bytes are alike. Statistics are frozen after training, so code lengths are exact
sums, and the language of the shortest code wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, contexts

DEPTH = 3
UNKNOWN = "und"
#: Bytes of text that are scored at once.
_SCORED = 500_000
_PLAIN = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether a character of the text is a letter; numerals and other signs that stand in words aren't."""
    return _PLAIN.search(text) is not None or any(map(str.isalpha, text))


def escape_c(c, n, d):
    return c / (n + d), d / (n + d)


class Trees(dict[str, contexts.Tree]):
    """A tree for each language; table: all grams, if memory doesn't hold them all."""

    table: DataFrame | None = None


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> Trees:
    """A tree for each language that occurs; rows with null text or language are passed over.

    Counts cover all rows and every gram; what the trees hold in memory is bounded by contexts.HELD.
    """
    known = common.pick(rows, kind=lang, text=text).where("kind is not null and text is not null")
    held, table, beyond = contexts.frequent(contexts.count(known, DEPTH, str.encode), DEPTH)
    trees = Trees({k: contexts.Tree(orders, escape_c, k, beyond) for k, orders in held.items()})
    trees.table = table
    return trees


def _best(names: list[str], bits: np.ndarray, size: np.ndarray, lettered: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and share of each column of bits, a row for each name; size: the bytes of each text.

    Shares are of the probability that a language gives to a byte, on average, so they don't sharpen with length.
    """
    if not names:
        return [UNKNOWN] * len(lettered), np.zeros(len(lettered))
    best, share = bits.argmax(0), 1 / np.exp((bits - bits.max(0)) / np.maximum(size, 1)).sum(0)
    return [names[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered.tolist())], np.where(lettered, share, 0.0)


def predict(rows: DataFrame, trees: dict[str, contexts.Tree], text: str = "text", keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The kept columns, lang_pred and score (the language's share among all, by code length a byte).

    names: what the two are called, for tables that have such columns themselves and keep them.

    lang_pred is `und` with score 0 if the text is null or has no letter, or if there are no trees; of equally
    short codes the first language in the order of their names wins. Row by row, without a shuffle, unless there are
    more grams than memory holds; then those that it can't tell are joined to the table.
    """
    spark = rows.sparkSession
    known, shared = sorted(trees), spark.sparkContext.broadcast([trees[k] for k in sorted(trees)])
    # A text that is kept goes to the tasks once.
    source = text if text in keep else "__text"
    kept = rows.select(*[rows[f"`{c}`"] for c in keep], *([] if text in keep else [rows[f"`{text}`"].alias("__text")]))
    table = getattr(trees, "table", None)
    if table is not None:
        return _predict_joined(kept, source, known, shared, table, keep, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, source, _SCORED):
            texts = [t or "" for t in batch.column(source).to_pylist()]
            code, starts = contexts.grams([t.encode() for t in texts], DEPTH)
            bits = np.array([contexts.sums(tree.log(code), starts) for tree in shared.value])
            lang, score = _best(known, bits, np.diff(starts, append=len(code)), np.array([has_letter(t) for t in texts], bool))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(lang, pa.string()), pa.array(score)], [*keep, *names])

    schema = kept.drop("__text").schema.add(names[0], "string").add(names[1], "double")
    return common.map_in_arrow(kept, run, schema)


def _predict_joined(kept: DataFrame, source: str, known: list[str], shared, table: DataFrame, keep: tuple[str, ...], names: tuple[str, str]) -> DataFrame:
    """predict() where the trees in memory aren't whole: sums of what they tell, and the rest by the table."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, source, _SCORED):
            texts = [t or "" for t in batch.column(source).to_pylist()]
            code, starts = contexts.grams([t.encode() for t in texts], DEPTH)
            lettered = np.array([has_letter(t) for t in texts], bool)
            of = np.repeat(np.arange(len(texts)), np.diff(starts, append=len(code)))
            bits, parts = [], []
            for k, tree in enumerate(shared.value):
                log, unknown = tree.told(code)
                bits.append(contexts.sums(log, starts))
                unknown &= lettered[of]
                parts.append(np.stack([of[unknown].astype(np.uint64), np.full(unknown.sum(), k, np.uint64), code[unknown]]))
            (text_of, kind, gram), times = np.unique(np.concatenate(parts, 1), axis=1, return_counts=True)
            at = np.searchsorted(text_of, np.arange(len(texts) + 1).astype(np.uint64)).astype(np.int32)
            asked = pa.StructArray.from_arrays([pa.array(kind.astype(np.int32)), pa.array(gram.astype(np.int64)), pa.array(times.astype(np.int32))], ["kind", "code", "times"])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(known) * len(texts) + 1, len(known)), pa.int32()), pa.array(np.array(bits).T.ravel()))
            own = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*own, batch.column("__row"), pa.array(np.diff(starts, append=len(code))), pa.array(lettered), lists, pa.ListArray.from_arrays(pa.array(at), asked)], [*keep, "__row", "__bytes", "__lettered", "__bits", "__asked"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, place = batch.num_rows, {c: i for i, c in enumerate(batch.schema.names)}
            bits = np.array(batch.column(place["__bits"]).to_pylist(), float).reshape(n, len(known)).T.copy()
            for i, more in enumerate(batch.column(place["__more"]).to_pylist()):
                for m in more or ():
                    bits[m["kind"], i] += m["log"]
            size = batch.column(place["__bytes"]).to_numpy(zero_copy_only=False)
            lang, score = _best(known, bits, size, np.array(batch.column(place["__lettered"]).to_pylist(), bool))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(lang, pa.string()), pa.array(score)], [*keep, *names])

    own = kept.drop("__text").schema
    schema = T.StructType([*own.fields, T.StructField("__row", T.LongType()), T.StructField("__bytes", T.LongType()), T.StructField("__lettered", T.BooleanType()), T.StructField("__bits", T.ArrayType(T.DoubleType())), T.StructField("__asked", T.ArrayType(T.StructType().add("kind", "integer").add("code", "long").add("times", "integer")))])
    part = common.stage(common.map_in_arrow(kept.withColumn("__row", F.monotonically_increasing_id()), told, schema), "told")
    asked = part.select(F.col("__row").alias("row"), F.explode("__asked").alias("a")).select("row", "a.*")
    number = F.create_map(*[x for k, name in enumerate(known) for x in (F.lit(name), F.lit(k))])
    numbered = table.withColumn("kind", number[F.col("kind")])
    values = contexts.told_by_table(asked.select("kind", "code").distinct(), numbered, DEPTH, *escape_c(F.col("n"), F.col("total"), F.col("different")))
    each = asked.join(values, ["kind", "code"]).groupBy("row", "kind").agg(F.sum(F.col("times") * F.col("log")).alias("log"))
    more = each.groupBy(F.col("row").alias("__of")).agg(F.collect_list(F.struct("kind", "log")).alias("__more"))
    done = part.drop("__asked").join(more, part["__row"] == more["__of"], "left").drop("__row", "__of")
    return done.mapInArrow(best, T.StructType([*own.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]))


def held_out(column: str = "doc_id"):
    return F.coalesce(common.crc_of_id(column) % 4 == 2, F.lit(False))


def op4_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", held_out())
    trees = train(docs.where("not held_out"))
    return predict(docs, trees, keep=("doc_id", "held_out"))
