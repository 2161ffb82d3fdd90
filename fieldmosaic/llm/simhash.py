"""SimHash near-duplicates joined by Golay-code fuzzy keys (operator 8).

The 64 bits are three segments: A and B of 23 bits, C of 18. The (23, 12) Golay code is perfect: every 23-bit
word is within 3 bits of one codeword. Two words that differ in at most one bit share a codeword if a word at
distance 3 from its own also takes the five codewords at distance 4: six keys of 12 bits, else one.

At most 3 wrong bits over A, B and C always leave one of these cases, each a key that both fingerprints have:
  C right, and A or B at most one wrong;  A right and B at most one wrong;  B right and A at most one wrong;
  A or B right and a half of C right;     A at most one wrong, a half of B and a half of C right.
Every key has some 30 bits or more, so that unrelated fingerprints seldom meet. All candidates that meet are
verified bit by bit; only a spanning forest of each key's links goes on, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

#: x^11+x^10+x^6+x^5+x^4+x^2+1, which generates the code.
_GENERATOR = 0b110001110101
_A, _B = (1 << 23) - 1, 23


def _remainders(n: int, shift: int) -> np.ndarray:
    """Of x << shift for all x of n bits, by the generator."""
    x = np.arange(1 << n, dtype=np.int64) << shift
    for bit in range(22, 10, -1):
        x = np.where(x >> bit & 1, x ^ _GENERATOR << bit - 11, x)
    return x


class Golay:
    def __init__(self) -> None:
        self.low, self.high = _remainders(12, 0), _remainders(11, 12)
        words = np.array([0, *(1 << np.arange(23)), *(1 << i | 1 << j for i in range(23) for j in range(i)), *(1 << i | 1 << j | 1 << k for i in range(23) for j in range(i) for k in range(j))], np.int64)
        self.error = np.zeros(2048, np.int64)
        self.error[self.low[words & 4095] ^ self.high[words >> 12]] = words
        messages = np.arange(4096, dtype=np.int64) << 11
        code = messages | self.low[messages & 4095] ^ self.high[messages >> 12]
        sevens = code[np.bitwise_count(code) == 7]
        # What to add to the nearest codeword's index, for each syndrome: 0, and five more behind three wrong bits.
        self.near = np.full((2048, 6), -1, np.int64)
        self.near[:, 0] = 0
        for s in np.flatnonzero(np.bitwise_count(self.error) == 3):
            e = self.error[s]
            self.near[s, 1:] = sevens[(sevens & e) == e] >> 11

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of 23-bit words: which word, and the index of a codeword near it."""
        s = self.low[x & 4095] ^ self.high[x >> 12]
        near = self.near[s]
        row, col = np.nonzero(near >= 0)
        return row, (x ^ self.error[s])[row] >> 11 ^ near[row, col]


def fingerprints(texts: list[str], words: int = 3) -> np.ndarray:
    """Of texts, lower-cased in A-Z: shingles hashed by XXH64 with seed 42, each bit by majority."""
    h = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = []
    for text in texts:
        w = text.encode().lower().split()
        n = max(len(w) - words + 1, min(len(w), 1))
        counts.append(n)
        line = b" ".join(w)
        if n <= 1:
            if n:
                hashes.append(h(line, 42))
            continue
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
        starts = np.concatenate([[0], ends[: n - 1]]).tolist()
        hashes += [h(line[a:b], 42) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]
    counts = np.array(counts, np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ends = np.cumsum(counts[some])
        totals = np.add.reduceat(bits, ends - counts[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * totals > counts[some][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprints(docs: DataFrame, words: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, key (a hash of the text) and fp (the 64 bits as a long) of each row; null texts have no words, and so zero."""
    rows = common.pick(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, "text"):
            fp = fingerprints(batch.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(fp.view(np.int64))], ["doc_id", "key", "fp"])

    return common.map_in_arrow(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, key long, fp long")


def _fuzzy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    golay = Golay()
    for batch in batches:
        for start in range(0, batch.num_rows, 20_000):
            fp = batch.column("fp").slice(start, 20_000).to_numpy(zero_copy_only=False)
            x = fp.view(np.uint64)
            a, b, c = ((x >> np.uint64(s) & np.uint64(m)).astype(np.int64) for s, m in ((0, _A), (_B, _A), (46, (1 << 18) - 1)))
            halves_c, halves_b = (c & 511, c >> 9), (b & 4095, b >> 12)
            (ra, ka), (rb, kb) = golay.keys(a), golay.keys(b)
            everyone = np.arange(len(fp))
            found = [(ra, c[ra] << 12 | ka), (rb, c[rb] << 12 | kb), (rb, a[rb] << 12 | kb), (ra, b[ra] << 12 | ka)]
            found += [(everyone, s << 9 | half) for s in (a, b) for half in halves_c]
            found += [(ra, (half_b[ra] << 9 | half_c[ra]) << 12 | ka) for half_b in halves_b for half_c in halves_c]
            for kind, (row, key) in enumerate(found):
                yield pa.RecordBatch.from_arrays([pa.array(kind << 40 | key), pa.array(fp[row])], ["key", "fp"])


def forest(x: np.ndarray, most: int = 3) -> list[tuple[int, int]]:
    """Links of a spanning forest of all pairs in x that differ in most bits or fewer.

    From each found fingerprint, those not found yet are compared at once; near copies, of which a key may
    have very many, are so found in few steps.
    """
    left, links = x.view(np.uint64).copy(), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= most
            if near.any():
                found = left[near]
                links += [(int(at.view(np.int64)), int(f)) for f in found.view(np.int64)]
                queue += list(found)
                left = left[~near]
    return links


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by key: links within each key."""

    def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(first, append=len(key))
        two = first[size == 2]
        near = np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= 3
        a, b = fp[two][near], fp[two + 1][near]
        more = [x for s, n in zip(first[size > 2].tolist(), size[size > 2].tolist()) for x in forest(np.unique(fp[s : s + n]))]
        if more:
            m = np.array(more, np.int64)
            a, b = np.concatenate([a, m[:, 0]]), np.concatenate([b, m[:, 1]])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy(zero_copy_only=False)])
        fps = np.concatenate([fps, batch.column("fp").to_numpy(zero_copy_only=False)])
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if cut:  # the last key may go on
            yield links(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
    if len(keys):
        yield links(keys, fps)


def near_links(distinct: DataFrame) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that connect all within 3 bits of each other."""
    keyed = distinct.select("fp").mapInArrow(_fuzzy_keys, "key long, fp long")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_verified, "a long, b long").where("a <> b")


def near_groups(docs: DataFrame, words: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, key, fp and component_id, the smallest id reachable over links of 3 bits.

    Null and empty texts have fingerprint zero and link like any other. Ties can't occur: a component's id is a
    minimum. Null ids are passed over by it. Rows of equal fingerprint are one node of the graph, so copies
    never meet in pairs. Empty tables give empty results; other columns are ignored.
    """
    rows = common.stage(with_fingerprints(docs, words, text, doc_id), "fingerprints")
    nodes = common.stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    labels = components(common.stage(near_links(nodes).distinct(), "near"))
    least = nodes.join(labels, nodes["fp"] == labels["node"]).groupBy("label").agg(F.min("least_id").alias("component"))
    linked = labels.join(least, "label").select(F.col("node").alias("fp"), "component")
    named = nodes.join(linked, "fp", "left").select(F.col("fp").alias("of"), F.coalesce("component", "least_id").alias("component_id"))
    # Written first, so that the join's inputs are plain shuffles, of which Spark splits those that copies make large.
    named = common.stage(named, "named")
    return rows.join(named, rows["fp"] == named["of"]).select("doc_id", "key", "fp", "component_id")


def deduplicated(docs: DataFrame, words: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each component of near_groups(), that of its smallest id; all columns stay.

    A component of null ids only keeps each of its texts once. Texts are dealt by id and hash, and again only if rows
    are found that are equal in both.
    """
    groups = common.stage(near_groups(docs, words, text, doc_id), "components")
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id"), F.col("key").alias("__of"))
    keyed = docs.withColumn("__key", F.xxhash64(F.coalesce(docs[f"`{text}`"], F.lit(""))))
    found = keyed.join(kept, (F.col("__key") == F.col("__of")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")), "left_semi")
    if common.repeats(groups, "key", "doc_id"):
        found = found.dropDuplicates(["__key", doc_id])
    return found.drop("__key")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
