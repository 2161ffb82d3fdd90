"""Quality classifier: histogram gradient-boosted trees over document statistics (operator 10).

Statistics are taken of every whole text in one pass. The trees are fitted on at most about SAMPLE labelled rows
(chosen by a hash of their id, so the choice doesn't depend on partitions), whose statistics are all that comes to
the driver. Fitted trees are complete and stored level by level in arrays; scoring steps all documents of a
chunk down one level at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Labelled rows to fit on, at most (give or take the hash's chance).
SAMPLE = 40_000
BINS, DEPTH, TREES, RATE, SHRINK = 64, 5, 80, 0.15, 1.0

_CLASSES = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "space": " ", "line": "\n", "blank": "\t\r\x0b\x0c", "stop": ".", "comma": ",", "mark": "!?", "quote": "\"'", "pipe": "|", "hash": "#", "money": "$", "other_sign": "%&*", "tag": "<>{}[]=/\\_", "bracket": "()", "at": "@+-:;"}
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _k, _chars in enumerate(_CLASSES.values()):
    _CLASS[[ord(c) for c in _chars]] = _k
_CLASS[128:] = len(_CLASSES) + 1
_N_CLASSES = len(_CLASSES) + 2
NAMES = [*_CLASSES, "control", "beyond_ascii", "log_bytes", "log_words", "word_length", "longest_word", "distinct_words", "top_word", "repeated_words", "short_words", "upper_words", "plain_words", "log_lines", "line_length", "repeated_lines", "top_line", "entropy"]


def statistics(texts: list[str]) -> np.ndarray:
    """A row of NAMES for each text."""
    raw = [t.encode() for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    x = np.frombuffer(b"".join(raw), np.uint8)
    of = np.repeat(np.arange(len(raw)), size)
    counts = np.bincount(of * _N_CLASSES + _CLASS[x], minlength=len(raw) * _N_CLASSES).reshape(-1, _N_CLASSES)
    by_byte = np.bincount(of * 256 + x, minlength=len(raw) * 256).reshape(-1, 256) / np.maximum(size, 1)[:, None]
    entropy = -(by_byte * np.log2(np.where(by_byte > 0, by_byte, 1))).sum(1)
    rest = []
    for t in texts:
        words, lines = t.split(), [s for s in t.split("\n") if s]
        seen, seen_lines, n = Counter(words), Counter(lines), max(len(words), 1)
        length = list(map(len, words))
        rest.append((
            math.log1p(len(words)), sum(length) / n, max(length, default=0), len(seen) / n, max(seen.values(), default=0) / n,
            sum(1 for a, b in zip(words, words[1:]) if a == b) / n, sum(1 for k in length if k < 3) / n, sum(map(str.isupper, words)) / n, sum(map(str.isalpha, words)) / n,
            math.log1p(len(lines)), len(t) / max(len(lines), 1), 1 - len(seen_lines) / max(len(lines), 1), max(seen_lines.values(), default=0) / max(len(lines), 1),
        ))
    return np.column_stack([counts / np.maximum(size, 1)[:, None], np.log1p(size), np.array(rest).reshape(len(texts), -1), entropy])


@dataclass
class Trees:
    """edges: bin borders of each feature; feature, border: [tree, inner node by level]; leaf: [tree, leaf]."""

    edges: list[np.ndarray]
    feature: np.ndarray
    border: np.ndarray
    leaf: np.ndarray
    start: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)]).astype(np.int16)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        binned, rows = self.bins(x), np.arange(len(x))
        total = np.full(len(x), self.start)
        for feature, border, leaf in zip(self.feature, self.border, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[rows, feature[node]] > border[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosting on logistic loss; splits by the second-order gain over all features' histograms."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])] if len(x) else [np.zeros(0)] * len(NAMES)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
    start = math.log(share / (1 - share))
    inner = 2**DEPTH - 1
    out = Trees(edges, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int16), np.zeros((0, inner + 1)), start)
    if not len(x) or y.min() == y.max():
        return out
    binned, n_features = out.bins(x).astype(np.int64), x.shape[1]
    flat = binned + np.arange(n_features) * BINS
    margin, features, borders, leaves = np.full(len(x), start), [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, border, node = np.zeros(inner, np.int64), np.full(inner, BINS, np.int16), np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            width, first = 2**level, 2**level - 1
            key = (((node - first) * n_features * BINS)[:, None] + flat).ravel()
            size = width * n_features * BINS
            hist_g, hist_h = (np.bincount(key, np.repeat(v, n_features), size).reshape(width, n_features, BINS) for v in (g, h))
            left_g, left_h = hist_g.cumsum(2), hist_h.cumsum(2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = left_g**2 / (left_h + SHRINK) + (all_g - left_g) ** 2 / (all_h - left_h + SHRINK) - all_g**2 / (all_h + SHRINK)
            gain = np.where((left_h > 1) & (all_h - left_h > 1), gain, 0).reshape(width, -1)
            best = gain.argmax(1)
            split = gain[np.arange(width), best] > 1e-6
            feature[first : first + width] = np.where(split, best // BINS, 0)
            border[first : first + width] = np.where(split, best % BINS, BINS)
            node = 2 * node + 1 + (binned[np.arange(len(x)), feature[node]] > border[node])
        at = node - inner
        leaf = -RATE * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + SHRINK)
        margin += leaf[at]
        features.append(feature)
        borders.append(border)
        leaves.append(leaf)
    return Trees(edges, np.array(features), np.array(borders), np.array(leaves), start)


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text", trees: Trees | None = None) -> DataFrame:
    """The kept columns with x (the statistics) or, if trees are given, score. Null texts count as empty."""
    kept = docs.select(*[docs[f"`{c}`"] for c in keep], F.coalesce(docs[f"`{text}`"], F.lit("")).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, "__text"):
            x = statistics(batch.column("__text").to_pylist())
            if shared.value is None:
                value = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            else:
                value = pa.array(shared.value.scores(x))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [value], [*keep, "x" if shared.value is None else "score"])

    schema = kept.drop("__text").schema
    return kept.mapInArrow(run, schema.add("x", T.ArrayType(T.DoubleType())) if trees is None else schema.add("score", "double"))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE, doc_id: str = "doc_id") -> Trees:
    """Trees fitted on docs whose doc_id has a label 0 or 1 (column quality of labels); null labels are passed over.

    Of more than `sample` labelled rows, about that many are taken by a hash of doc_id. A doc_id that has both labels
    counts once for each, however often they are repeated. Without both labels present the score is constant. Other
    columns of docs are ignored.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").alias("__id"), "quality").distinct()
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    found = common.pick(docs, doc_id=doc_id, text=text).join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    rows = with_statistics(found, ["quality"]).toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(NAMES))
    return fit(x, rows.column("quality").to_numpy().astype(float))


def predict(docs: DataFrame, trees: Trees, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns and score, the probability of label 1, of every row; empty tables give empty results."""
    return with_statistics(docs, list(keep), text, trees)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labelled ones that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", F.coalesce(common.crc_of_id() % 5 == 0, F.lit(False)))
    trees = train(docs.where("not held_out"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return predict(docs, trees, ("doc_id", "held_out")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
