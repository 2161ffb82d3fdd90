"""Variable-order byte contexts: counting them with Spark, and trees that score bytes by their longest context.

A gram of order k is a byte with the k bytes before it, packed into a long with the byte in the lowest place.
Every gram that occurs counts. All trees together hold the HELD most frequent grams in memory, under the full counts
of their contexts; what is beyond them stays in tables, and memory has a filter of bits that says of most grams and
contexts that they aren't there. Only grams of a text that occur but aren't held, and a few that the filter takes for
such, are joined to the tables, with the same results.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Grams that all trees hold in memory together, at some 40 bytes each.
HELD = 1 << 22
#: Bits of the filter for each gram or context beyond HELD, the power of two of its bits at most, and bits set for each.
SPREAD, FILTER, PROBES = 24, 28, 5
#: What stands before a text.
PAD = 10
#: Different grams, by blocks of text, that a task holds at once.
_SORTED = 1_500_000


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram of each byte of all texts, and where each text starts; every text begins after PAD bytes."""
    pad = bytes([PAD]) * depth
    x = np.frombuffer(pad + pad.join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    code = x[depth:].astype(np.uint64)
    for k in range(1, depth + 1):
        code |= x[depth - k : len(x) - k].astype(np.uint64) << np.uint64(8 * k)
    starts = np.cumsum(size) - size
    if len(texts) > 1:
        keep = np.ones(len(code), bool)
        ends = (starts + size + depth * np.arange(len(texts)))[:-1]
        keep[(ends[:, None] + np.arange(depth)).ravel()] = False
        code = code[keep]
    return code, starts


def count(rows: DataFrame, depth: int, prepare: Callable[[str], bytes]) -> DataFrame:
    """kind, code, n: how often each gram of the full depth occurs in the texts (column text) of each kind."""

    def flush(held: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for kind, parts in held.items():
            code, n = (np.concatenate(v) for v in zip(*parts))
            order = np.argsort(code)
            code = code[order]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
            n = np.add.reduceat(n[order], first) if len(code) else n
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(first), pa.string()), pa.array(code[first].astype(np.int64)), pa.array(n, pa.int64())], ["kind", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for batch in common.chunks(batches, "text"):
            by: dict[str, list[bytes]] = {}
            for kind, text in zip(batch.column("kind").to_pylist(), batch.column("text").to_pylist()):
                by.setdefault(kind, []).append(prepare(text))
            for kind, texts in by.items():
                held.setdefault(kind, []).append(np.unique(grams(texts, depth)[0], return_counts=True))
                size += len(held[kind][-1][0])
            if size > _SORTED:
                yield from flush(held)
                held, size = {}, 0
        yield from flush(held)

    found = common.map_in_arrow(rows.select("kind", "text"), run, "kind string, code long, n long")
    return found.groupBy("kind", "code").agg(F.sum("n").alias("n"))


@dataclass
class Order:
    """What memory holds of one order of a kind: sorted grams with their counts, and for each how often its context was
    seen (total) and with how many different bytes. whole: no gram of the order is left out."""

    code: np.ndarray
    n: np.ndarray
    total: np.ndarray
    different: np.ndarray
    whole: bool


def _salt(kind: str, k: int, what: str) -> int:
    return zlib.crc32(f"{kind}:{k}:{what}".encode())


def _cells(salt: np.ndarray, code: np.ndarray, log: int) -> Iterator[np.ndarray]:
    """The places of numbers in a filter of 2**log bits, one array for each of their bits."""
    x = code ^ (salt * np.uint64(0x9E3779B97F4A7C15))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    step = (x << np.uint64(32) | x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) | np.uint64(1)
    for i in range(PROBES):
        yield x + np.uint64(i) * step >> np.uint64(64 - log)


@dataclass
class Filter:
    """Bits of the grams and contexts that memory doesn't hold: what lacks one of its bits is none of them."""

    log: int
    bits: np.ndarray

    def may(self, kind: str, k: int, what: str, code: np.ndarray) -> np.ndarray:
        out = np.ones(len(code), bool)
        for cell in _cells(np.array([_salt(kind, k, what)], np.uint64), code, self.log):
            out &= (self.bits[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _filter(beyond: DataFrame) -> Filter:
    """Of rows of kind, k, what and code. With over 2**FILTER / SPREAD of them it tells less and less, never wrongly."""
    log = max(10, min(FILTER, (SPREAD * beyond.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salt, code = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in ("salt", "code"))
            cell = np.unique(np.concatenate(list(_cells(salt, code, log))))
            at, first = np.unique(cell >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (cell & np.uint64(63)), first) if len(first) else cell
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(bits.view(np.int64))], ["at", "bits"])

    salted = beyond.select(F.crc32(F.concat_ws(":", "kind", F.col("k").cast("string"), "what").cast("binary")).alias("salt"), "code")
    found = salted.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << log - 6, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Filter(log, out)


def frequent(counts: DataFrame, depth: int) -> tuple[dict[str, list[Order]], DataFrame | None, Filter | None]:
    """Of count(): each kind's orders with the most frequent grams, HELD at most over all of them.

    And all grams, as a written table of kind, k, code, n, total, different, with the filter of the grams that aren't
    held and of the contexts that have no held gram; None if all grams are held.
    """
    counts = common.stage(counts, "grams")
    orders = counts.select("kind", "n", F.posexplode(F.array(*[F.col("code").bitwiseAND((1 << 8 * (k + 1)) - 1) for k in range(depth + 1)])).alias("k", "code"))
    summed = common.stage(orders.groupBy("kind", "k", "code").agg(F.sum("n").alias("n")), "orders")
    context = F.shiftright("code", 8).alias("context")
    contexts = summed.groupBy("kind", "k", context).agg(F.sum("n").alias("total"), F.count("*").alias("different"), F.max("n").alias("most"))
    grams = common.stage(summed.select("*", context).join(contexts, ["kind", "k", "context"]).drop("context"), "contexts")
    # Sizes by powers of two of the counts: at most 64 rows for each kind and order.
    power = lambda n: F.floor(F.log2(n) + 1e-9).cast("int")
    sizes = grams.groupBy("kind", "k", power("n").alias("power")).agg(F.count("*").alias("size")).collect()
    least, held = 64, 0
    for p in sorted({r["power"] for r in sizes}, reverse=True):
        held += sum(r["size"] for r in sizes if r["power"] == p)
        if held > HELD:
            break
        least = p
    pruned = {(r["kind"], r["k"]) for r in sizes if r["power"] < least}
    table = grams.where(power("n") >= least).toArrow()
    k, code, n, total, different = (table.column(c).to_numpy() for c in ("k", "code", "n", "total", "different"))
    coded = pc.dictionary_encode(table.column("kind")).combine_chunks()
    kind, number = coded.indices.to_numpy(), {name: i for i, name in enumerate(coded.dictionary.to_pylist())}
    out = {}
    for name in sorted({r["kind"] for r in sizes}):
        out[name] = []
        for order in range(depth + 1):
            at = np.flatnonzero((kind == number.get(name, -1)) & (k == order))
            at = at[np.argsort(code[at])]
            out[name].append(Order(code[at].astype(np.uint32 if order < 4 else np.uint64), *(x[at].astype(np.float64) for x in (n, total, different)), (name, order) not in pruned))
    if not pruned:
        return out, None, None
    beyond = grams.where(power("n") < least).select("kind", "k", F.lit("gram").alias("what"), "code")
    alone = grams.where(power("most") < least).select("kind", "k", F.lit("context").alias("what"), F.shiftright("code", 8).alias("code")).distinct()
    return out, grams, _filter(beyond.union(alone))


class Lookup:
    """Places of numbers in a sorted array, by a sparse table in front of binary search. Only the array is pickled.

    spare: how much larger the table is than the array, as a power of two.
    """

    def __init__(self, keys: np.ndarray, spare: int = 2) -> None:
        self.__setstate__((keys, spare))

    def __getstate__(self) -> tuple[np.ndarray, int]:
        return self.keys, self.spare

    def __setstate__(self, state: tuple[np.ndarray, int]) -> None:
        self.keys, self.spare = state
        bits = max(4, int(len(self.keys)).bit_length() + self.spare)
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        for at in range(0, len(self.keys), 1 << 16):  # in steps, for little memory beside the table
            part = self.keys[at : at + (1 << 16)]
            self.slots[self._slot(part)] = np.arange(at, at + len(part), dtype=np.int32)

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each, or -1."""
        if not len(self.keys):
            return np.full(len(x), -1, np.int32)
        x = x.astype(self.keys.dtype, copy=False)  # else binary search would widen all keys
        at = self.slots[self._slot(x)]
        other = np.flatnonzero((at >= 0) & (self.keys[at] != x))
        if len(other):
            place = np.minimum(np.searchsorted(self.keys, x[other]), len(self.keys) - 1)
            at[other] = np.where(self.keys[place] == x[other], place, -1)
        return at


class Tree:
    """Log probabilities (base e) of bytes after their contexts.

    weigh(c, n, d): probability of a gram seen c times and the share left to grams not seen, where its context was
    seen n times with d different bytes, held in memory or not.
    kind and beyond: the kind's name and the filter of frequent(), if an order isn't whole.
    """

    def __init__(self, orders: list[Order], weigh: Callable, kind: str = "", beyond: Filter | None = None) -> None:
        self.depth, self.kind, self.beyond = len(orders) - 1, kind, beyond
        self.levels: list[tuple[Lookup, np.ndarray, Lookup, np.ndarray, np.ndarray, bool]] = []
        for o in orders:
            context, of = np.unique(o.code >> o.code.dtype.type(8), return_inverse=True)
            seen, rest = weigh(o.n, o.total, o.different)
            left, different = np.zeros(len(context)), np.zeros(len(context))
            left[of], different[of] = np.log(rest), o.different
            self.levels.append((Lookup(o.code), np.log(seen), Lookup(context), left, np.bincount(of, minlength=len(context)) == different, o.whole))

    def _log(self, k: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        if k < 0:
            return np.full(len(code), -np.log(256.0)), None
        code = code & np.uint64((1 << 8 * (k + 1)) - 1)
        grams, seen, contexts, left, complete, whole = self.levels[k]
        at = grams.find(code)
        out = seen[at] if len(seen) else np.zeros(len(code))
        unknown = None
        if len(miss := np.flatnonzero(at < 0)):
            context = contexts.find(code[miss] >> np.uint64(8))
            if not whole:
                open_ = np.ones(len(miss), bool)
                if self.beyond is not None:
                    open_ = self.beyond.may(self.kind, k, "gram", code[miss])
                    alone = np.flatnonzero(context < 0)
                    open_[alone] |= self.beyond.may(self.kind, k, "context", code[miss[alone]] >> np.uint64(8))
                if len(left):
                    open_ &= ~((context >= 0) & complete[context])
                unknown = np.zeros(len(code), bool)
                unknown[miss[open_]] = True
                out[miss[open_]] = 0.0
                miss, context = miss[~open_], context[~open_]
            below, deeper = self._log(k - 1, code[miss])
            out[miss] = np.where(context >= 0, left[context] if len(left) else 0.0, 0.0) + below
            if deeper is not None:
                unknown = np.zeros(len(code), bool) if unknown is None else unknown
                unknown[miss[deeper]] = True
                out[miss[deeper]] = 0.0
        return out, unknown

    def log(self, code: np.ndarray) -> np.ndarray:
        """Of grams that memory can tell; 0 for others."""
        return self._log(self.depth, code)[0]

    def told(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log() and which grams memory can't tell."""
        out, unknown = self._log(self.depth, code)
        return out, np.zeros(len(code), bool) if unknown is None else unknown


def told_by_table(asked: DataFrame, grams: DataFrame, depth: int, seen: Column, rest: Column) -> DataFrame:
    """kind, code, log of the asked (distinct kind, code of the full depth), by the table of all grams of frequent().

    seen and rest: the probability of a gram and the share left to others, over the columns n, total and different.
    """
    places = asked.select("kind", F.col("code").alias("of"), F.posexplode(F.array(*[F.col("code").bitwiseAND((1 << 8 * (k + 1)) - 1) for k in range(depth + 1)])).alias("k", "code"))
    places = places.withColumn("context", F.shiftright("code", 8))
    values = grams.select("kind", "k", "code", F.log(seen).alias("seen"))
    contexts = grams.groupBy("kind", "k", F.shiftright("code", 8).alias("context")).agg(F.first(F.log(rest)).alias("left"))
    found = places.join(values, ["kind", "k", "code"], "left").join(contexts, ["kind", "k", "context"], "left")
    best = found.groupBy("kind", "of").agg(F.max(F.when(F.col("seen").isNotNull(), F.col("k"))).alias("best"), F.collect_list(F.struct("k", F.coalesce("seen", F.lit(0.0)).alias("seen"), F.coalesce("left", F.lit(0.0)).alias("left"))).alias("steps"))
    step = lambda total, s: total + F.when(s["k"] > F.coalesce("best", F.lit(-1)), s["left"]).when(s["k"] == F.col("best"), s["seen"]).otherwise(0.0)
    start = F.when(F.col("best").isNull(), -float(np.log(256.0))).otherwise(0.0)
    return best.select("kind", F.col("of").alias("code"), F.aggregate("steps", start, step).alias("log"))


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each text's values; texts may be empty."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    return np.diff(total[np.append(starts, len(values))])
