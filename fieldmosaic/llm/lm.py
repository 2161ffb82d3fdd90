"""Language-model scores by a probabilistic suffix tree over words (operator 5).

The root is the smoothed distribution of single words over all training documents. The tree grows from it one word of
context at a time, up to DEPTH words (a text's start counts as one). A context that occurs `context` times or more, and
whose shorter suffix is a state (the root always is), becomes a state if the words that follow it depart from what
that suffix predicts: twice the log likelihood gained must pass DIVERGENCE. A state s with n continuations, L of them
by words that follow it `least` times or more, predicts
    P(w | s) = (c(s, w) + (n - L + SMOOTHING) P(w | suffix of s)) / (n + SMOOTHING),
which sums to one. Each word is scored by the longest suffix of what precedes it that is a state. All counts are
absolute, so the tree grows with the input.

Words and sequences of words are known by 64-bit keys, mixed so that different words have equal ones by chance only (about
one pair in 2^64); the key of a sequence is made of the keys of its two sequences shorter by one word.

A position is a word with up to DEPTH words before it. Positions of all texts are dealt by the word before, so a part has all
that the tree holds after that word: it counts the positions of training texts, grows its piece of the tree, and adds up
what each position gains over the root, text by text. Neither sequences nor the tree are written. A context that is
a large share of all positions (`Hot`) would make one part large: what follows it is counted beforehand from the texts
(listed(), hot_tables()) and given to the parts; its positions are dealt by the shortest longer context that isn't hot. Parts
are worked off in ROUNDS rounds, each with a pass over the texts, as all positions at once are several times the texts.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, contexts

#: Words of context at most.
DEPTH = 3
#: Least count of a listed continuation, and of a context, unless others are asked for.
LEAST, CONTEXT = 2, 2
DIVERGENCE = 12.0
SMOOTHING = 1.0
#: Words whose counts are in memory at most (some 32 bytes each), words with a short code, and other keys with one.
HELD_WORDS, HELD, CODED = 1 << 20, 1 << 20, 1 << 18
#: Sequences that a task combines at once, and bytes of text.
_COMBINED, _BLOCK = 1_500_000, 2_000_000
#: Sequences of all tasks that a part gets at most, as they are counted.
_PART = 4_000_000
#: Positions of all texts that a part gets, about, and of these that are counted at once.
_WINDOWS_PART, _COUNTED = 2_000_000, 300_000
#: Words whose positions a task sends at once; rounds that parts are worked off in at most, and words that are worth one.
_SENT, ROUNDS, _ROUND = 600_000, 3, 8_000_000
#: The key that stands for all words that can't be listed.
_OTHER = np.uint64(0x3C6EF372FE94F82B)
#: Bytes of text whose words a part sums up.
_TEXT_PART = 256_000_000
#: Kinds of what parts get: texts' own rows, positions, questions for words' counts, and tables that answer them.
_ROW, _WINDOWS, _ASKED, _AFTER, _LEFT, _BELOW, _COUNTS, _PRINT = range(8)
#: The key of a text's start, and log2 of the bits, at most, that tell keys which a table can't hold.
_BEGIN, _SPARSE = np.uint64(0x5851F42D4C957F2D), 27


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_END = np.uint64(0xD6E8FEB86659FD93)
_STEP, _MASKS = np.uint64(0x9E3779B97F4A7C15), np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one map of 64 bits whose every bit depends on all of x's."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _word_keys(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the words in bytes; begins: where a text does. Words end at white space and texts' ends.

    A word's key is made of its length and the sum of its eighths of bytes, each mixed with its own place in the word first:
    what is summed doesn't depend on place and bytes apart, so no pattern of letters cancels out.
    """
    letter = ~_SPACE[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    first[begins[begins < len(data)]] |= letter[begins[begins < len(data)]]
    at = np.flatnonzero(first)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    ends = letter.copy()
    ends[:-1] &= ~letter[1:] | first[1:]
    size = np.flatnonzero(ends) + 1 - at
    low = np.zeros(len(data) + 8, np.uint8)
    low[: len(data)] = _LOWER[data]
    eights = np.ndarray((len(data),), np.dtype("<u8"), low, 0, (1,))  # eight bytes from each place on
    lanes = size + 7 >> 3
    starts = np.cumsum(lanes) - lanes
    nth = np.arange(lanes.sum()) - np.repeat(starts, lanes)
    left = np.minimum(np.repeat(size, lanes) - 8 * nth, 8)
    value = eights[np.repeat(at, lanes) + 8 * nth] & _MASKS[left]
    total = np.add.reduceat(_mix(value + (nth + 1).astype(np.uint64) * _STEP), starts)
    return at, _mix(total + size.astype(np.uint64) * _STEP)


def word_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all texts' words, each text after its start and before its end; where each text begins.

    A-Z are lower-cased. Texts are gone through in blocks that end between words, so a very long one costs memory for
    its words only.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    begins = offsets[:-1] - offsets[0]
    places, keys, a = [], [], 0
    while a < len(data):
        b = a + _BLOCK
        if b < len(data):
            space = np.flatnonzero(_SPACE[data[b : b + _BLOCK]])
            while not len(space) and b < len(data):
                b += _BLOCK
                space = np.flatnonzero(_SPACE[data[b : b + _BLOCK]])
            b += int(space[0]) if len(space) else 0
        own = begins[(begins >= a) & (begins < b)] - a
        at, key = _word_keys(data[a:b], own)
        places.append(at + a)
        keys.append(key)
        a = b
    place, key = (np.concatenate(v) for v in (places, keys)) if places else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    words = np.diff(np.searchsorted(place, begins), append=len(place)) if len(begins) else np.zeros(0, np.int64)
    starts = np.cumsum(words + 2) - (words + 2)
    out = np.full(len(key) + 2 * len(words), _END, np.uint64)
    out[starts] = _BEGIN
    out[np.arange(len(key)) + 2 * np.repeat(np.arange(len(words)), words) + 1] = key
    return out, starts


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of sequences from those of their contexts (all but the last word) and of their suffixes (all but the first)."""
    x = (a ^ a >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) + (b ^ b >> np.uint64(29))
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ x >> np.uint64(29)


def sequences(x: np.ndarray, starts: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of words' keys: for sequences of 2 words up to order, the places where they end, their contexts and suffixes."""
    place = np.arange(len(x)) - np.repeat(starts, np.diff(starts, append=len(x)))
    now = x
    for k in range(2, order + 1):
        at = np.flatnonzero(place >= k - 1)
        context, suffix = now[at - 1], now[at]
        yield at, context, suffix
        if k < order:
            now = now.copy()
            now[at] = mixed(context, suffix)


def _texts(rows: DataFrame, text: str) -> DataFrame:
    return common.pick(rows, text=text).select(F.coalesce("text", F.lit("")).alias("text"))


def _size(rows: DataFrame, text: str) -> int:
    return rows.agg(F.sum(F.octet_length(rows[f"`{text}`"]).cast("long") + 1)).first()[0] or 0


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, to be read by _unpack()."""
    return b"".join(np.array([ord(a.dtype.char), len(a)], np.int64).tobytes() + a.tobytes() for a in arrays)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n = np.frombuffer(data, np.int64, 2, at).tolist()
        out.append(np.frombuffer(data, chr(kind), n, at + 16))
        at += 16 + out[-1].nbytes
    return out


def _small(n: np.ndarray) -> np.ndarray:
    return n.astype(np.min_scalar_type(int(n.max()) if len(n) else 0))


class Ids:
    """Short codes of keys: the places of frequent ones in a sorted array, and behind it those of a block's own others."""

    def __init__(self, keys: np.ndarray) -> None:
        self.frequent = contexts.Lookup(np.sort(keys), 1)

    def code(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the keys that aren't frequent."""
        code = self.frequent.find(keys).astype(np.int64)
        rare = np.flatnonzero(code < 0)
        names, of = np.unique(keys[rare], return_inverse=True)
        code[rare] = len(self.frequent.keys) + of
        return code, names

    def keys(self, code: np.ndarray, names: np.ndarray) -> np.ndarray:
        known = code < len(self.frequent.keys)
        out = np.empty(len(code), np.uint64)
        out[known] = self.frequent.keys[code[known]]
        out[~known] = names[code[~known] - len(self.frequent.keys)]
        return out


class Ranked(Ids):
    """Ids whose codes are ranks by count, so that their higher bytes are mostly zeros and compress."""

    def __init__(self, keys: np.ndarray, n: np.ndarray) -> None:
        super().__init__(keys)
        self.by_rank = np.argsort(-n[np.argsort(keys)], kind="stable").astype(np.int32)
        self.rank = np.empty(len(keys), np.int32)
        self.rank[self.by_rank] = np.arange(len(keys), dtype=np.int32)

    def code(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code, names = super().code(keys)
        known = code < len(self.rank)
        code[known] = self.rank[code[known]]
        return code, names

    def keys(self, code: np.ndarray, names: np.ndarray) -> np.ndarray:
        known = code < len(self.rank)
        place = code.copy()
        place[known] = self.by_rank[code[known]]
        return super().keys(place, names)


def _combined(key: np.ndarray, n: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key once, sorted, with its sum of n; the others belong to the key."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    sums = np.add.reduceat(n[order].astype(np.int64), first) if len(key) else np.zeros(0, np.int64)
    return key[first], sums, *(v[order[first]] for v in others)


def _cuts(key: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins among sorted keys, and the end; parts are ranges of keys."""
    return np.searchsorted((key >> np.uint64(32)).astype(np.int64) * parts >> 32, np.arange(parts + 1))


def _batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())], ["part", "data"])


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    """The arrays as one; the list is emptied, so that they are in memory twice one list at a time."""
    out = np.concatenate(arrays)
    arrays.clear()
    return out


def _blocks(context: np.ndarray, suffix: np.ndarray, parts: int, ids: tuple[Ids, Ids]) -> pa.RecordBatch:
    """Sequences, combined by key, as one block for each part: codes of contexts by their differences, of suffixes, counts."""
    key, n, context, suffix = _combined(mixed(context, suffix), np.ones(len(context), np.int64), context, suffix)
    cut, rows = _cuts(key, parts), []
    for p in np.flatnonzero(np.diff(cut)).tolist():
        (lead, leads), (follow, follows) = (i.code(v[cut[p] : cut[p + 1]]) for i, v in zip(ids, (context, suffix)))
        order = np.argsort(lead, kind="stable")
        step, follow = np.diff(lead[order], prepend=0), follow[order]
        planes = [(step & 255).astype(np.uint8), _small(step >> 8), (follow & 65535).astype(np.uint16), _small(follow >> 16)]
        rows.append((p, _pack(leads, follows, *planes, _small(n[cut[p] : cut[p + 1]][order]))))
    return _batch(rows)


def _sequences_of(data: bytes, ids: tuple[Ids, Ids]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """context, suffix and n of a block."""
    leads, follows, low, high, follow, more, n = _unpack(data)
    lead = np.cumsum(low.astype(np.int64) | high.astype(np.int64) << 8)
    return ids[0].keys(lead, leads), ids[1].keys(follow.astype(np.int64) | more.astype(np.int64) << 16, follows), n


def word_counts(rows: DataFrame, text: str = "text", parts: int | None = None) -> DataFrame:
    """key and n of the words of all rows; the end of each text counts as a word. Null texts count as empty."""
    if not parts:
        parts = max(_partitions(rows), -(-(rows.agg(F.sum(F.octet_length(rows[f"`{text}`"]).cast("long"))).first()[0] or 0) // _TEXT_PART))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            key, n = _combined(*(np.concatenate(v) for v in zip(*held)))
            cut = _cuts(key, parts)
            return _batch([(p, _pack(key[cut[p] : cut[p + 1]], _small(n[cut[p] : cut[p + 1]]))) for p in np.flatnonzero(np.diff(cut)).tolist()])

        for batch in common.chunks(batches, "text"):
            x, _ = word_keys(batch.column("text"))
            held.append(np.unique(x[x != _BEGIN], return_counts=True))
            size += len(held[-1][0])
            if size > _COMBINED:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [_unpack(data) for batch in batches for data in batch.column("data").to_pylist()]
        if blobs:
            key, n = _combined(*(np.concatenate(v) for v in zip(*blobs)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    dealt = common.map_in_arrow(_texts(rows, text), run, "part int, data binary").repartitionById(parts, "part")
    return dealt.mapInArrow(summed, "key long, n long")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sparse(table: DataFrame) -> tuple[int, np.ndarray]:
    """Bits in longs, set for the column key's values: keys without their bit aren't in the table.

    64 bits for each key of a small table, 2**_SPARSE at most; the first number says how a key's bit is found.
    """
    log = max(10, min(_SPARSE, (64 * table.count()).bit_length()))
    cell = F.shiftrightunsigned("key", 64 - log)
    found = table.groupBy(F.shiftright(cell, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - log}) & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << log - 6, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return 64 - log, out


def _may(sparse: tuple[int, np.ndarray], key: np.ndarray) -> np.ndarray:
    shift, bits = sparse
    cell = key >> np.uint64(shift)
    return (bits[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)


def listed(rows: DataFrame, order: int, contexts_of: DataFrame, suffixes_of: DataFrame, parts: int, text: str = "text", least: int = LEAST) -> tuple[DataFrame, Broadcast]:
    """key, context, suffix and n of the sequences of so many words that occur `least` times or more in all rows.

    contexts_of, suffixes_of: tables with the keys (and n) of the order below that are open as contexts and as
    suffixes. All sequences of these are found, and a few of others may be. Beside the table, what its tasks share: to be
    destroyed when the table is written.
    """
    spark = rows.sparkSession
    ids = tuple(Ids(_most(t.select("key", "n"), CODED)[0].column("key").to_numpy().view(np.uint64)) for t in (contexts_of, suffixes_of))
    shared = spark.sparkContext.broadcast((*map(_sparse, (contexts_of, suffixes_of)), ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_lead, may_follow, ids = shared.value
        held, size = [], 0
        for batch in common.chunks(batches, "text"):
            *_, (_, context, suffix) = sequences(*word_keys(batch.column("text")), order)
            known = _may(may_lead, context)
            known[known] = _may(may_follow, suffix[known])
            held.append((context[known], suffix[known]))
            size += len(held[-1][0])
            if size > _COMBINED:
                yield _blocks(*(np.concatenate(v) for v in zip(*held)), parts, ids)
                held, size = [], 0
        if size:
            yield _blocks(*(np.concatenate(v) for v in zip(*held)), parts, ids)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value[2]
        blobs = [_sequences_of(data, ids) for batch in batches for data in batch.column("data").to_pylist()]
        if blobs:
            context, suffix, n = (np.concatenate(v) for v in zip(*blobs))
            key, n, context, suffix = _combined(mixed(context, suffix), n, context, suffix)
            often = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(v[often].view(np.int64)) for v in (key, context, suffix, n)], ["key", "context", "suffix", "n"])

    dealt = common.map_in_arrow(_texts(rows, text), run, "part int, data binary").repartitionById(parts, "part")
    return dealt.mapInArrow(summed, "key long, context long, suffix long, n long"), shared


def _states(found: DataFrame, totals: DataFrame) -> DataFrame:
    """The contexts of found (key, context, n, below: the word's probability by the context's suffix) that are states.

    context, total (totals: context, total), escape (what the total leaves to words that aren't listed) and left (log10 of
    the share of P by the suffix that the state leaves to them).
    """
    sums = found.groupBy("context").agg(F.sum("n").alias("__in"), F.sum("below").alias("__below"), F.sum(F.col("n") * F.log(F.col("n") / F.col("below"))).alias("__gain"))
    sums = sums.join(totals, "context").withColumn("total", F.greatest("total", "__in"))
    rest = 1 - F.col("__in") / F.col("total")
    gain = F.col("__gain") - F.col("__in") * F.log("total") + F.when(rest > 1e-12, F.col("total") * rest * F.log(rest / F.greatest(1 - F.col("__below"), F.lit(1e-12)))).otherwise(0.0)
    escape = F.col("total") - F.col("__in") + SMOOTHING
    return sums.where(2 * gain > DIVERGENCE).select("context", "total", escape.alias("escape"), F.log10(escape / (F.col("total") + SMOOTHING)).alias("left"))


def _after(found: DataFrame, states: DataFrame) -> DataFrame:
    """Of found's rows whose context is a state: key, n, seen (the word's probability) and v (what it adds to a score)."""
    seen = (F.col("n") + F.col("escape") * F.col("below")) / (F.col("total") + SMOOTHING)
    met = found.join(states, "context").withColumn("seen", seen)
    return met.select("key", "n", "seen", (F.log10(F.col("seen") / F.col("below")) - F.col("left")).alias("v"))


def hot_tables(training: DataFrame, words: DataFrame, total: int, distinct: int, text: str = "text", least: int = LEAST, context: int = CONTEXT) -> tuple[list[np.ndarray], list[DataFrame], list[DataFrame]]:
    """The tree below contexts that occur `context` times or more.

    For contexts of one word up to DEPTH: a table of their keys, n and key of the suffix (0: none) at the driver; the words after
    states among them (context, key, seen and v, what each adds to a score) and these states (context, left).
    words: key and n of all words, with the total of n and the number of distinct keys.
    """
    parts = max(_partitions(training), -(-total // _PART))
    begins = words.where(F.col("key") == _signed(int(_END))).select(F.lit(_signed(int(_BEGIN))).alias("key"), "n")
    found, hot, tables, lefts = words.where(F.col("key") != _signed(int(_END))).unionByName(begins).withColumn("suffix", F.lit(0).cast("long")), [], [], []
    below = words.where(F.col("n") >= least).select("key", "n", ((F.col("n") + 0.1) / (total + 0.1 * (distinct + 1))).alias("below"))
    follows = below
    for order in range(2, DEPTH + 2):
        open_contexts = found.where(F.col("n") >= context)
        top = open_contexts.select("key", "n", "suffix").toArrow()
        if not top.num_rows:
            break
        hot.append(np.stack([top.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("key", "n", "suffix")]))
        new, shared = listed(training, order, open_contexts, follows, parts, text, least)
        new = common.stage(new.join(below.select(F.col("key").alias("suffix"), "below"), "suffix", "left"), "listed")
        shared.destroy()
        common.sweep(training.sparkSession)
        totals = open_contexts.select(F.col("key").alias("context"), F.col("n").alias("total"))
        states = common.stage(_states(new.where("below is not null"), totals), "states")
        table = common.stage(_after(new.where("below is not null"), states), "after")
        tables.append(table.join(new.select("key", "context"), "key").select("context", "key", "seen", "v"))
        lefts.append(states.select("context", "left"))
        # What isn't listed after a state can't be after a longer one; but it may lead to one.
        found, below = new.select("key", "n", "suffix"), table.select("key", "n", F.col("seen").alias("below"))
        follows = below if order == DEPTH else found
    common.sweep(training.sparkSession)
    return hot, tables, lefts


def _signed(key: int) -> int:
    return int(np.uint64(key).astype(np.int64))


def _most(table: DataFrame, size: int) -> tuple[pa.Table, DataFrame]:
    """The rows of table (key, n, ...) with the largest n, at most size of them, and the rest."""
    power = F.floor(F.log2("n") + 1e-9).cast("int")
    sizes = {r["power"]: r["size"] for r in table.groupBy(power.alias("power")).agg(F.count("*").alias("size")).collect()}
    least, held = 64, 0
    for p in sorted(sizes, reverse=True):
        held += sizes[p]
        if held > size:
            break
        least = p
    return table.where(power >= least).toArrow(), table.where(power < least)


def _lookup(table: pa.Table, value: str) -> tuple[contexts.Lookup, np.ndarray]:
    key, v = table.column("key").to_numpy().view(np.uint64), table.column(value).to_numpy()
    order = np.argsort(key)
    return contexts.Lookup(key[order], 1), v[order]


def _home(key: np.ndarray, parts: int) -> np.ndarray:
    """The part of a key: parts are ranges of keys, as in _cuts()."""
    return (key >> np.uint64(32)).astype(np.int64) * parts >> 32


def _questions(of: np.ndarray, key: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """Blocks of the keys that the texts of a chunk ask for: each key once, with its texts and how often they have it."""
    order = np.lexsort((of, key))
    of, key = of[order], key[order]
    entry = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (key[1:] != key[:-1])])) if len(of) else np.zeros(0, np.int64)
    times, of, key = np.diff(entry, append=len(of)), of[entry], key[entry]
    cut = _cuts(key, parts)
    for p in np.flatnonzero(np.diff(cut)).tolist():
        a, b = cut[p], cut[p + 1]
        name, n = np.unique(key[a:b], return_counts=True)
        yield p, _pack(name, _small(n), _small(of[a:b]), _small(times[a:b]))


def _answered(raw: bytes, key: np.ndarray, n: np.ndarray) -> bytes | None:
    """Of a block of questions, and the sorted keys and counts of a part's words: its texts with gained logarithms and words met."""
    name, times_of, of, times = _unpack(raw)
    at = np.minimum(np.searchsorted(key, name), max(len(key) - 1, 0))
    hit = key[at] == name if len(key) else np.zeros(len(name), bool)
    at, hit, of = np.repeat(at, times_of), np.repeat(hit, times_of), of.astype(np.int64)
    if not hit.any():
        return None
    texts, local = np.unique(of[hit], return_inverse=True)
    gain = np.log10(n[at[hit]] + 0.1) - math.log10(0.1)
    return _pack(_small(texts), *(np.bincount(local, v * times[hit]) for v in (gain, np.ones(len(gain)))))


class Hot:
    """Contexts that are many positions' by length, and the parts that these are dealt to."""

    def __init__(self, tables: list[np.ndarray], total: int, parts: int) -> None:
        self.parts, self.found = parts, []
        for key, n, suffix in (t[:, np.argsort(t[0])] for t in tables):
            self.found.append((contexts.Lookup(key, 1), -(-n.astype(np.int64) * parts // max(total, 1)), suffix))

    def deal(self, w: list[np.ndarray], has: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """The part of each position, and the length of the longest hot context.

        w: the keys of the words before it, nearest first; has: how many there are. Positions are dealt by the shortest
        context that isn't hot, so its part has all that follows it; those of the longest, if it is hot, at will.
        """
        part, level = _home(w[0], self.parts), np.zeros(len(has), np.uint8)
        at, key = np.arange(len(has)), w[0]
        for k, (lookup, spread, _) in enumerate(self.found, 1):
            place = lookup.find(key)
            at, key, place = (v[place >= 0] for v in (at, key, place))
            level[at] = k
            deeper = has[at] > k if k < DEPTH else np.zeros(len(at), bool)
            part[at] = _home(key, self.parts)
            if k == DEPTH:
                part[at] = (part[at] + (at + salt) % spread[place]) % self.parts
                break
            at, key, place = at[deeper], key[deeper], place[deeper]
            home, key = part[at], _context([v[at] for v in w], k + 1)
            part[at] = (home + (key >> np.uint64(7)).astype(np.int64) % spread[place]) % self.parts
        return part, level

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Each hot context with the parts that ask for what follows it: its own and those of longer ones that end in it."""
        out = []
        for k, (lookup, spread, suffix) in enumerate(self.found):
            i = np.repeat(np.arange(len(spread)), np.minimum(spread, self.parts))
            nth = np.arange(len(i)) - np.repeat(np.cumsum(np.minimum(spread, self.parts)) - np.minimum(spread, self.parts), np.minimum(spread, self.parts))
            part, key = (_home(lookup.keys[i], self.parts) + nth) % self.parts, lookup.keys[i]
            out.append((key, part))
            above = suffix[i]
            for shorter, _, suffixes in reversed(self.found[:k]):
                out.append((above, part))
                at = shorter.find(above)
                above = suffixes[at]
        key, part = (np.concatenate(v) for v in zip(*out)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        pairs = np.unique(np.stack([key, part.astype(np.uint64)]), axis=1)
        return pairs[0], pairs[1].astype(np.int64)


def _context(w: list[np.ndarray], length: int) -> np.ndarray:
    """The key of the words before a position, nearest first in w."""
    if length == 1:
        return w[0]
    if length == 2:
        return mixed(w[1], w[0])
    return mixed(_context(w[1:], length - 1), _context(w, length - 1))


def _windows(key: np.ndarray, at: np.ndarray, of: np.ndarray, learn: np.ndarray, has: np.ndarray, ids: Ids, hot: Hot, salt: int, parts: range) -> Iterator[tuple[int, bytes]]:
    """Blocks of positions `at` among words' keys, dealt to these parts: up to DEPTH words before each and the word itself, as codes.

    of: each one's text; learn: whether it counts; has: how many words there are before it.
    """
    part, level = hot.deal([key[np.maximum(at - k, 0)] for k in range(1, DEPTH + 1)], has, salt)
    code, names = ids.code(key)
    order = np.flatnonzero((part >= parts.start) & (part < parts.stop))
    order = order[np.argsort(part[order], kind="stable")]
    cut = np.searchsorted(part[order], np.arange(hot.parts + 1))
    known = len(ids.frequent.keys)
    for p in np.flatnonzero(np.diff(cut)).tolist():
        own = order[cut[p] : cut[p + 1]]
        columns = np.stack([np.where(has[own] >= k, code[np.maximum(at[own] - k, 0)], 0) for k in range(DEPTH + 1)])
        rare = columns >= known
        used, local = np.unique(columns[rare], return_inverse=True)
        columns[rare] = known + local
        planes = [v for c in columns for v in ((c & 255).astype(np.uint8), (c >> 8 & 255).astype(np.uint8), _small(c >> 16))]
        raw = _pack(names[used - known], level[own], learn[own].astype(np.uint8), has[own].astype(np.uint8), _small(np.diff(of[own], prepend=0)), *planes)
        yield p, np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _windows_of(data: bytes, known: int, named: int) -> list[np.ndarray]:
    """The block's names; codes of the words (the word itself, then those before it, nearest first), level, learn, has and of.

    Codes of names begin at known, and are moved on by named.
    """
    names, level, learn, has, of, *planes = _unpack(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True))
    codes = [planes[k].astype(np.int32) | planes[k + 1].astype(np.int32) << 8 | planes[k + 2].astype(np.int32) << 16 for k in range(0, len(planes), 3)]
    return [names, *(np.where(c >= known, c + named, c) for c in codes), level, learn.astype(bool), has, np.cumsum(of, dtype=np.int32)]


def _buckets(codes: list[np.ndarray], level: np.ndarray, has: np.ndarray, ids: Ids, names: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of a part in groups of some _COUNTED that share no context which is counted here."""
    size = -(-len(has) // _COUNTED)
    if size == 1:
        yield np.arange(len(has))
        return
    bucket = np.zeros(len(has), np.uint8 if size < 256 else np.int32)
    for a in range(0, len(has), _COUNTED):
        w = [ids.keys(c[a : a + _COUNTED].astype(np.int64), names) for c in codes[1:]]
        length = np.minimum(np.minimum(level[a : a + _COUNTED] + 1, has[a : a + _COUNTED]), DEPTH)
        for k in range(1, DEPTH + 1):
            own = np.flatnonzero(length == k)
            bucket[a + own] = (_context([v[own] for v in w], k) >> np.uint64(9)).astype(np.int64) % size
    for k in range(size):
        own = np.flatnonzero(bucket == k)
        if len(own):
            yield own


def _gains(w: list[np.ndarray], level: np.ndarray, learn: np.ndarray, has: np.ndarray, below: np.ndarray, given: list[np.ndarray], left_of: list[np.ndarray], least: int, context: int) -> np.ndarray:
    """What the tree adds to the logarithm of each position's probability.

    below: the word's probability by the root, NaN where it isn't listed. Contexts of up to `level` words are hot: given has
    keys, seen and v of words after them, sorted by key, left_of their states' keys and left. Longer ones have all their
    positions here and are counted.
    """
    out, at, sequence = np.zeros(len(has)), np.arange(len(has)), w[0]
    for k in range(1, DEPTH + 1):
        go = has[at] >= k
        at, sequence, below = at[go], sequence[go], below[go]
        before = _context([v[at] for v in w[1:]], k)
        sequence = mixed(before, sequence)
        seen, gain, state = np.full(len(at), np.nan), np.zeros(len(at)), np.zeros(len(at), bool)
        hot = np.flatnonzero(level[at] >= k)
        if len(hot) and len(left_of[0]):
            place = np.minimum(np.searchsorted(left_of[0], before[hot]), len(left_of[0]) - 1)
            met = left_of[0][place] == before[hot]
            state[hot] = met
            gain[hot[met]] = left_of[1][place[met]]
            if len(given[0]):
                place = np.minimum(np.searchsorted(given[0], sequence[hot]), len(given[0]) - 1)
                met = given[0][place] == sequence[hot]
                seen[hot[met]] = given[1][place[met]]
                gain[hot[met]] += given[2][place[met]]
        own = np.flatnonzero(level[at] < k)
        if len(own):
            key, first, of_key = np.unique(sequence[own], return_index=True, return_inverse=True)
            n = np.bincount(of_key, learn[at[own]], len(key))
            names, of_context = np.unique(before[own][first], return_inverse=True)
            total, under = np.bincount(of_context, n, len(names)), below[own][first]
            often = (n >= least) & (total[of_context] >= context) & ~np.isnan(under)
            of, n_often, b = of_context[often], n[often], under[often]
            inside, covered = np.bincount(of, n_often, len(names)), np.bincount(of, b, len(names))
            with np.errstate(divide="ignore", invalid="ignore"):
                rest = 1 - inside / total
                more = np.where(rest > 1e-12, total * rest * np.log(rest / np.maximum(1 - covered, 1e-12)), 0.0)
                won = np.bincount(of, n_often * np.log(n_often / b), len(names)) - inside * np.log(total) + more
                states = (inside > 0) & (2 * won > DIVERGENCE)
                escape = total - inside + SMOOTHING
                left = np.log10(escape / (total + SMOOTHING))
            predicted = np.full(len(key), np.nan)
            predicted[often] = np.where(states[of], (n_often + escape[of] * b) / (total[of] + SMOOTHING), np.nan)
            with np.errstate(divide="ignore", invalid="ignore"):
                v = np.where(np.isnan(predicted), 0.0, np.log10(predicted / under) - left[of_context])
            own_context = of_context[of_key]
            state[own], seen[own] = states[own_context], predicted[of_key]
            gain[own] = np.where(states[own_context], left[own_context] + v[of_key], 0.0)
        out[at] += gain
        # No context is a state whose suffix isn't one.
        at, sequence, below = at[state], sequence[state], seen[state]
    return out


def _summed(rows: pa.Table) -> pa.Table:
    """A chunk's rows with the answers of a round's parts added up: a row for each kind."""
    kind, out = rows.column("__kind").to_numpy(), [rows.filter(pa.array(np.isin(rows.column("__kind").to_numpy(), [_ROW, _PRINT])))]
    for k, columns in ((_WINDOWS, 1), (_ASKED, 2)):
        found = [_unpack(raw) for raw in rows.filter(pa.array(kind == k)).column("__data").to_pylist()]
        if found:
            texts, local = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            sums = [np.bincount(local, np.concatenate([f[c] for f in found])) for c in range(1, columns + 1)]
            one = _packed([(0, _pack(_small(texts), *sums))], k, rows.column("__chunk")[0].as_py(), rows.column("__size")[0].as_py())
            out.append(pa.Table.from_batches([_widened(one, rows.schema)]))
    return pa.concat_tables(out)


def _added(rows: pa.Table) -> pa.Table:
    """A chunk's texts with the sums of all rounds."""
    kind = rows.column("__kind").to_numpy()
    texts = rows.filter(pa.array(kind == _ROW))
    sums, prints = np.zeros((3, int(rows.column("__size")[0].as_py()))), set()
    for k, raw in zip(kind.tolist(), rows.column("__data").to_pylist()):
        if k == _PRINT:
            prints.add(raw)
        elif k != _ROW:
            of, *values = _unpack(raw)
            for i, v in zip((0,) if k == _WINDOWS else (1, 2), values):
                sums[i][of] += v
    if len(prints) > 1:
        raise ValueError("the rows came in another order when they were read again; write them to a table first")
    own = texts.column("__doc").to_numpy()
    base, words = texts.column("__base").to_numpy() + sums[1][own], texts.column("__known").to_numpy() + np.rint(sums[2][own]).astype(np.int64)
    kept = [texts.column(i) for i in range(rows.schema.get_field_index("__chunk"))]
    return pa.table([*kept, texts.column("__tokens"), pa.array(words), pa.array(base), pa.array(base + sums[0][own])], [*rows.schema.names[: len(kept)], "n_tokens", "n_known", "base_score", "score"])


def _delivered(table: DataFrame, kind: int, schema: T.StructType) -> DataFrame:
    """Rows of a table (part and numbers) as blocks of that kind for their parts."""
    names = table.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            order = np.argsort(part, kind="stable")
            own, first = np.unique(part[order], return_index=True)
            values = [batch.column(c).to_numpy()[order] for c in names]
            rows = [(p, _pack(*(v[a:b] for v in values))) for p, a, b in zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(part)])]
            yield _packed(rows, kind, -1, 0)

    blocks = table.mapInArrow(run, "__chunk long, __size long, __part int, __kind int, __data binary")
    return blocks.select(*[F.col(f"`{f.name}`") if f.name in blocks.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _packed(rows: list[tuple[int, bytes]], kind: int, chunk: int, size: int) -> pa.RecordBatch:
    n = len(rows)
    columns = [pa.array([chunk] * n, pa.int64()), pa.array([size] * n, pa.int64()), pa.array([p for p, _ in rows], pa.int32()), pa.array([kind] * n, pa.int32()), pa.array([d for _, d in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["__chunk", "__size", "__part", "__kind", "__data"])


def _widened(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """The batch with nulls for the columns it lacks."""
    found = set(batch.schema.names)
    return pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) if f.name in found else pa.nulls(batch.num_rows, f.type) for f in schema], schema=schema)


def _rare_pairs(training: DataFrame, rare_words: DataFrame, words: DataFrame, hot: Hot, total: int, distinct: int, text: str, least: int, context: int) -> DataFrame | None:
    """part, key and below: for words that memory doesn't hold, listed after one word, the root's probability, for the part that asks."""
    listed_words = rare_words.where(F.col("n") >= least)
    if not listed_words.limit(1).count():
        return None
    begins = words.where(F.col("key") == _signed(int(_END))).select(F.lit(_signed(int(_BEGIN))).alias("key"), "n")
    open_words = words.unionByName(begins).where(F.col("n") >= context)
    pairs, shared = listed(training, 2, open_words, listed_words, max(_partitions(training), -(-total // _PART)), text, least)
    below = listed_words.select(F.col("key").alias("suffix"), ((F.col("n") + 0.1) / (total + 0.1 * (distinct + 1))).alias("below"))
    part = F.shiftright(F.shiftrightunsigned("context", 32) * hot.parts, 32).cast("int")
    # Hot contexts' own tables know these words.
    out = common.stage(pairs.join(below, "suffix").select(part.alias("part"), "key", "below"), "rare")
    shared.destroy()
    return out


def scored(rows: DataFrame, training: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: int = LEAST, context: int = CONTEXT, learns: str | None = None) -> DataFrame:
    """The kept columns with n_tokens, n_known, train_tokens, base_score and score.

    base_score: sum over words and the end of log10((c + 0.1) / (N + 0.1 (V + 1))) with c, N and V from the
    training rows; score: the same with the suffix tree's probabilities, of which `least` and `context` are the least counts. Null texts count as empty: one token,
    the end. Without training rows every c is 0 and both scores are equal. Repeated rows have repeated results;
    empty tables give empty results; other columns are ignored. Texts over the chunk size are worked on one by one.
    learns: a condition on rows, if training is the rows where it holds; they are then dealt once instead of twice.
    """
    spark = rows.sparkSession
    words = common.stage(word_counts(training, text), "words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    base = math.log10(total + 0.1 * (distinct + 1))
    tokens = total * (_size(rows, text) + (0 if learns else _size(training, text))) // max(_size(training, text), 1)
    parts = max(_partitions(rows), -(-tokens // _WINDOWS_PART))
    # A context is hot with an eighth of a part's positions, so that no part has many times another's.
    tables, after, lefts = hot_tables(training, words, total, distinct, text, least, max(context, total // (8 * parts)))
    hot = Hot(tables, total, parts)
    (often_words, rare_words), coded = _most(words, HELD_WORDS), _most(words, HELD)[0]
    # Texts' starts and words that can't be listed are frequent, too.
    ids = Ranked(np.append(coded.column("key").to_numpy().view(np.uint64), [_BEGIN, _OTHER]), np.append(coded.column("n").to_numpy(), [total, total]))
    shared = spark.sparkContext.broadcast((*_lookup(often_words, "n"), _sparse(rare_words), _sparse(rare_words.where(F.col("n") >= min(least, context))), ids, hot))

    kept = rows.select(*[rows[f"`{c}`"] for c in keep], F.coalesce(rows[f"`{text}`"], F.lit("")).alias("__text"), F.coalesce(F.expr(learns), F.lit(False)).alias("__learn") if learns else F.lit(False).alias("__learn"), F.lit(True).alias("__scores"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept.schema.fields[: len(keep)]])
    for name, kind in zip(("__chunk", "__size", "__doc", "__tokens", "__known", "__base", "__part", "__kind", "__data"), ("long", "long", "long", "long", "long", "double", "integer", "integer", "binary")):
        schema = schema.add(name, kind)
    if not learns:
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in kept.schema.fields[: len(keep)]]
        kept = kept.unionAll(training.select(*none, F.coalesce(training[f"`{text}`"], F.lit("")), F.lit(True), F.lit(False)))
    empty_arrow = spark.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch], now: range) -> Iterator[pa.RecordBatch]:
        often_words, count, rare_words, twice, ids, hot = shared.value
        # Chunks of a task are numbered from a number of its own.
        chunk, docs = TaskContext.get().partitionId() << 40, 0
        held, asked, out = [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            for batch in out:
                yield _widened(pa.RecordBatch.from_arrays([*batch.columns, pa.array([docs] * batch.num_rows, pa.int64())], [*batch.schema.names, "__size"]), empty_arrow)
            lengths = np.cumsum([0] + [len(h[0]) for h in held[:-1]])
            key, of, learn, has = (np.concatenate([h[i] for h in held]) for i in (0, 2, 3, 4))
            at = np.concatenate([h[1] + a for h, a in zip(held, lengths.tolist())])
            seen = _mix(key + np.arange(len(key), dtype=np.uint64) * _STEP).sum(dtype=np.uint64)
            yield _widened(_packed([(now[(chunk >> 40) % len(now)], seen.tobytes())], _PRINT, chunk, docs), empty_arrow)
            for kind, blocks in ((_WINDOWS, _windows(key, at, of, learn, has, ids, hot, chunk, now)), (_ASKED, _questions(*(np.concatenate(x) for x in zip(*asked)), hot.parts))):
                blocks = [b for b in blocks if b[0] in now]
                if blocks:
                    yield _widened(_packed(blocks, kind, chunk, docs), empty_arrow)

        for batch in common.chunks(batches, "__text"):
            key, starts = word_keys(batch.column("__text"))
            sizes = np.diff(starts, append=len(key))
            of = np.repeat(np.arange(batch.num_rows), sizes)
            learn, scores = (batch.column(c).to_pandas().to_numpy(bool) for c in ("__learn", "__scores"))
            word = key != _BEGIN
            at = often_words.find(key)
            n = np.where((at >= 0) & word, count[at], 0) if len(count) else np.zeros(len(key), np.int64)
            rare = word & (n == 0)
            rare[rare] = _may(rare_words, key[rare])
            asks = rare & scores[of]
            asked.append((of[asks] + docs, key[asks]))
            place = np.arange(len(key)) - np.repeat(starts, sizes)
            # Words that are too few can neither follow nor be part of a context, nor can what goes before them there.
            rare[rare] = _may(twice, key[rare])
            leads = (n >= context) | rare | ~word
            at = np.flatnonzero((place[1:] >= 1) & leads[:-1]) + 1 if total else np.zeros(0, np.int64)
            has = np.ones(len(at), np.int64)
            for k in range(2, DEPTH + 1):
                has += (has == k - 1) & (place[at] >= k) & leads[np.maximum(at - k, 0)]
            held.append((np.where(leads | (n >= least), key, _OTHER), at, of[at] + docs, learn[of[at]], has))
            if now.start == 0 and scores.any():  # the first round has the texts' own rows
                sure = contexts.sums(np.where(word, np.log10(n + 0.1) - base, 0.0), starts)
                known = contexts.sums((n > 0).astype(float), starts).astype(np.int64)
                mine = np.flatnonzero(scores)
                one = batch.take(pa.array(mine))
                columns = [*[one.column(i) for i in range(len(keep))], pa.array([chunk] * len(mine), pa.int64()), pa.array(mine + docs), *(pa.array(v[mine]) for v in (sizes - 1, known, sure))]
                columns += [pa.array([now[(chunk >> 40) % len(now)]] * len(mine), pa.int32()), pa.array([_ROW] * len(mine), pa.int32())]
                out.append(pa.RecordBatch.from_arrays(columns, [*keep, "__chunk", "__doc", "__tokens", "__known", "__base", "__part", "__kind"]))
            docs += batch.num_rows
            if sum(len(h[0]) for h in held) > min(_SENT, _COMBINED):
                yield from flush()
                chunk, docs, held, asked, out = chunk + 1, 0, [], [], []
        if held:
            yield from flush()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often_words, count, *_, ids, _ = shared.value
        blocks = {kind: [] for kind in (_WINDOWS, _ASKED, _AFTER, _LEFT, _BELOW, _COUNTS)}
        for batch in batches:
            kind = batch.column("__kind").to_numpy()
            own = batch.filter(pa.array(np.isin(kind, [_ROW, _PRINT])))
            if own.num_rows:
                yield own
            for k, *block in zip(kind.tolist(), *(batch.column(c).to_pylist() for c in ("__chunk", "__size", "__data"))):
                if k in blocks:
                    blocks[k].append(block)

        def table(kind: int, columns: int) -> list[np.ndarray]:
            found = [_unpack(data) for *_, data in blocks.pop(kind)]
            found = [np.concatenate(v) for v in zip(*found)] if found else [np.zeros(0, np.int64)] * columns
            key, first = np.unique(found[0].view(np.uint64), return_index=True)
            return [key, *(v[first] for v in found[1:])]

        key, n = table(_COUNTS, 2)
        for chunk, size, data in blocks.pop(_ASKED):
            answer = _answered(data, key, n)
            if answer:
                yield _widened(_packed([(0, answer)], _ASKED, chunk, size), empty_arrow)
        windows, sizes, named, names = [], [], 0, []
        packed = blocks.pop(_WINDOWS)[::-1]
        while packed:  # a block goes when it is unpacked
            chunk, size, data = packed.pop()
            own, *others = _windows_of(data, len(ids.rank), named)
            windows.append(others)
            sizes.append((chunk, size, len(others[0])))
            names.append(own)
            named += len(own)
        if not windows:
            return
        names = np.concatenate(names)
        columns = [list(v) for v in zip(*windows)]
        windows.clear()
        *codes, level, learn, has, of = (_joined(v) for v in columns)
        gains, given, left_of, (pair, others) = np.zeros(len(has)), table(_AFTER, 3), table(_LEFT, 2), table(_BELOW, 2)
        for own in _buckets(codes, level, has, ids, names):
            w = [ids.keys(c[own].astype(np.int64), names) for c in codes]
            at = often_words.find(w[0])
            n = np.where(at >= 0, count[at], 0) if len(count) else np.zeros(len(at), np.int64)
            below = np.where(n >= least, (n + 0.1) / (total + 0.1 * (distinct + 1)), np.nan)
            if len(pair):
                other = np.flatnonzero(at < 0)
                asked = mixed(w[1][other], w[0][other])
                place = np.minimum(np.searchsorted(pair, asked), len(pair) - 1)
                met = pair[place] == asked
                below[other[met]] = others[place[met]]
            gains[own] = _gains(w, level[own], learn[own], has[own], below, given, left_of, least, context)
        a = 0
        for chunk, size, n in sizes:
            texts, local = np.unique(of[a : a + n], return_inverse=True)
            sums = np.bincount(local, gains[a : a + n])
            a += n
            yield _widened(_packed([(0, _pack(_small(texts), sums))], _WINDOWS, chunk, size), empty_arrow)

    asking, asks_in = hot.places()
    where = spark.createDataFrame(pa.table({"context": pa.array(asking.view(np.int64)), "part": pa.array(asks_in, pa.int32())}))
    rare_part = F.shiftright(F.shiftrightunsigned("key", 32) * parts, 32).cast("int")
    given = [(_COUNTS, rare_words.select(rare_part.alias("part"), "key", "n"))]
    for table, left in zip(after, lefts):
        given.append((_AFTER, table.join(F.broadcast(where), "context").select("part", "key", "seen", "v")))
        given.append((_LEFT, left.join(F.broadcast(where), "context").select("part", F.col("context").alias("key"), "left")))
    pairs = _rare_pairs(training, rare_words, words, hot, total, distinct, text, least, context)
    if pairs is not None:
        given.append((_BELOW, pairs))
    rounds, done = min(ROUNDS, parts, max(1, -(-tokens // _ROUND))), []
    for r in range(rounds):
        now = range(parts * r // rounds, parts * (r + 1) // rounds)
        # What the round before left in the shuffle goes first.
        common.sweep(spark)
        dealt = common.map_in_arrow(kept, functools.partial(run, now=now), schema)
        for kind, table in given:
            dealt = dealt.unionAll(_delivered(table.where(F.col("part").between(now.start, now.stop - 1)), kind, schema))
        answers = dealt.withColumn("__part", F.col("__part") - now.start).repartitionById(len(now), "__part").mapInArrow(work, schema)
        done.append(common.stage(answers.groupBy("__chunk").applyInArrow(_summed, schema), "round"))
    shared.destroy()
    summed = functools.reduce(DataFrame.unionAll, done)
    results = T.StructType(schema.fields[: len(keep)]).add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")
    done = common.stage(summed.groupBy("__chunk").applyInArrow(_added, results), "scored")
    common.sweep(spark)
    return done.select(*[F.col(f"`{c}`") for c in keep], "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op5_suffix_tree(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents by what the training documents hold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", F.coalesce(common.crc_of_id() % 10 == 0, F.lit(False)))
    return scored(docs, docs.where("not held_out"), keep=("doc_id", "held_out"), learns="not held_out")
