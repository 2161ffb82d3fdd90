"""Removal of repeated byte strings by suffix sorting over a difference cover (operator 2).

The cover sample holds, for every string of LENGTH bytes, a position inside it at the same place wherever the string
occurs: of its seeds (SEED bytes each) the one of least hash, the leftmost of equals. A sampled position m owns the
strings whose choice it is; they start at m - t for a run of offsets t. This content-defined cover takes the place
of a periodic one, of which each string would need several positions.

1. Sampled positions go to buckets by their seed's hash, with a hash of the whole span of their strings. Spans that
   occurred earlier are repeats as a whole; a task passes on only the first of those that it has itself, so that a
   passage of very many documents is few rows. A seed with one span only is done.
2. Where a seed has several spans, the bytes of each span's first occurrence are fetched and dealt to seed buckets.
   One bucket at a time is suffix-sorted: sampled suffixes to the right, reversed prefixes to the left, with the common
   lengths of neighbours. A string at offset t is then known by two ranks, of its left t bytes and of its right
   LENGTH - t bytes, so ties of any number are resolved without comparing strings again; the first of equal ranks
   stays.
3. The found intervals are dealt by document, merged, and cut out.

A seed whose spans would fill a bucket by themselves (as counted in a sixteenth of the documents) is split from the
start: its strings are dealt by a 128-bit hash of each, and no bucket grows with one seed. The number of buckets
follows from the bytes of all texts. Both only spread the work; the result is the same.

All shuffled rows are blocks of packed arrays. Spans are compared by 64-bit hashes within seeds of equal 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

LENGTH, SEED = 100, 32
#: Largest offset of a string's sampled position.
REACH = LENGTH - SEED
#: Seed buckets for each partition, and bytes of text for each partition at most.
FINE, PART_BYTES = 8, 64_000_000
#: One document in so many is looked at for seeds that fill a bucket, and their spans there at least.
LOOK, FEW = 16, 16
CHUNK = 6_000_000
#: Entries of results that a task gathers over its buckets before it passes them on.
HELD = 2_000_000
_DEALT = "part int, kind int, data binary"
_DONE, _OPEN, _SPANS, _STRINGS = 1, 2, 3, 4


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, to be read by unpack() with the same types."""
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def unpack(data: bytes, *types: str) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, len(types)).tolist()
    out, at = [], 8 * len(types)
    for n, kind in zip(sizes, types):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def sample(x: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: each sampled position's text, place in x, greatest and least offset, seed's hash."""
    long = np.flatnonzero(size >= LENGTH)
    n = size[long] - LENGTH + 1
    none = np.zeros(0, np.int64)
    if not len(long):
        return none, none, none, none, none.astype(np.uint64)
    h = x.astype(np.uint64) + np.uint64(1)
    for k in range(SEED.bit_length() - 1):
        h = h[: -(1 << k)] * np.uint64(0xD6E8FEB86659FD93 + 2 * k) + h[1 << k :]
        h ^= h >> np.uint64(32)
    seed = _mix(h)
    least = seed & np.uint64(0xFFFFFFFF00000000) | np.arange(len(seed), dtype=np.uint64)
    width, wanted = 1, REACH + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    ends = np.cumsum(n)
    p = np.repeat(starts[long] - (ends - n), n) + np.arange(int(ends[-1]))
    m = (least[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
    last = np.append(first[1:], len(m)) - 1
    of = np.repeat(long, n)[first]
    return of, m[first], m[first] - p[first], m[first] - p[last], seed[m[first]]


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = [t.encode() for t in batch.column("text").to_pylist()]
    size = np.array([len(r) for r in raw], np.int64)
    whole = b"".join(raw)
    return np.frombuffer(whole, np.uint8), np.cumsum(size) - size, size, whole


def _blocks(part: np.ndarray, kind: int, docs: np.ndarray, of: np.ndarray, arrays: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """Rows of each part: the documents that occur ([n, 2]), and the arrays with each entry's document first."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(part)]):
        at = order[a:b]
        used, local = np.unique(of[at], return_inverse=True)
        yield int(part[a]), kind, pack(docs[used].ravel(), local.astype(np.uint32), *[x[at] for x in arrays])


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["part", "kind", "data"])


def _gather(blobs: list[bytes], *types: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Blocks of _blocks() as one: documents, each entry's document, and the other arrays."""
    docs, of, rest, n = [], [], [], 0
    for data in blobs:
        d, local, *arrays = unpack(data, "i8", "u4", *types)
        docs.append(d.reshape(-1, 2))
        of.append(local.astype(np.int64) + n)
        rest.append(arrays)
        n += len(docs[-1])
    if not blobs:
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64), [np.zeros(0, t) for t in types]
    return np.concatenate(docs), np.concatenate(of), [np.concatenate(a) for a in zip(*rest)]


class _Held:
    """Results of one bucket after another, passed on as one block for each document's part, so that their number depends
    on the tasks and not on the buckets."""

    def __init__(self, kind: int, parts: int, *types: str) -> None:
        self.kind, self.parts, self.types = kind, parts, types
        self.found, self.n = [], 0

    def add(self, docs: np.ndarray, of: np.ndarray, *arrays: np.ndarray) -> None:
        used, local = np.unique(of, return_inverse=True)
        self.found.append((docs[used], local, [a.astype(t) for a, t in zip(arrays, self.types)]))
        self.n += len(of)

    def rows(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        """What is held as rows, if there are so many entries."""
        if self.n < least:
            return
        docs, of, arrays = zip(*self.found)
        before = np.cumsum([0, *map(len, docs[:-1])])
        docs, of = np.concatenate(docs), np.concatenate([o + b for o, b in zip(of, before)])
        self.found, self.n = [], 0
        yield _batch(list(_blocks(_home(docs, self.parts)[of], self.kind, docs, of, [np.concatenate(a) for a in zip(*arrays)])))


def _home(docs: np.ndarray, parts: int) -> np.ndarray:
    """The part that a document's intervals go to."""
    return (_mix(docs[:, 0].view(np.uint64) ^ _mix(docs[:, 1].view(np.uint64))) % np.uint64(parts)).astype(np.int64)


def _in_order(docs: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Entries sorted by document id, text key and place."""
    return np.lexsort((at, docs[of, 1], docs[of, 0]))


def _later(same: np.ndarray, docs: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of entries in order, where same says that one is like the one before: those that have an earlier like.

    Rows that are equal in id and text are one document, so an entry at the first one's place isn't later.
    """
    start = np.flatnonzero(~same)[np.cumsum(~same) - 1]
    return same & ~((docs[of] == docs[of[start]]).all(1) & (at == at[start]))


def _strings(whole: bytes, m: np.ndarray, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of spans: which span, the place and the two halves of a hash of each of their strings."""
    h, n = xxhash.xxh3_128_digest, high - low + 1
    which = np.repeat(np.arange(len(m)), n)
    at = np.repeat(m - high - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    two = np.frombuffer(b"".join([h(whole[p : p + LENGTH]) for p in at.tolist()]), np.uint64).reshape(-1, 2)
    return which, at, two


def _string_blocks(docs: np.ndarray, of: np.ndarray, at: np.ndarray, two: np.ndarray, parts: int) -> list[tuple[int, int, bytes]]:
    """Strings by their hashes; those that are repeats within the chunk are done."""
    order = np.lexsort((at, docs[of, 1], docs[of, 0], two[:, 1], two[:, 0]))
    of, at, two = of[order], at[order].astype(np.int32), two[order]
    same = np.concatenate([[False], (two[1:] == two[:-1]).all(1)])
    done = _later(same, docs, of, at)
    rows = list(_blocks(_home(docs, parts)[of[done]], _DONE, docs, of[done], [at[done], at[done] + np.int32(LENGTH)]))
    of, at, two = of[~same], at[~same], two[~same]
    # One bucket of a partition takes all of its strings, whose results are then a block for each document's part.
    return rows + list(_blocks((two[:, 0] % np.uint64(parts)).astype(np.int64) * FINE, _STRINGS, docs, of, [at, two[:, 0].copy(), two[:, 1].copy()]))


def _done_strings(blobs: list[bytes], repeats: _Held) -> None:
    docs, of, (at, a, b) = _gather(blobs, "i4", "u8", "u8")
    order = np.lexsort((at, docs[of, 1], docs[of, 0], b, a))
    of, at, a, b = of[order], at[order], a[order], b[order]
    same = np.concatenate([[False], (a[1:] == a[:-1]) & (b[1:] == b[:-1])])
    done = _later(same, docs, of, at)
    repeats.add(docs, of[done], at[done], at[done] + np.int32(LENGTH))


def hot_seeds(rows: DataFrame, parts: int) -> np.ndarray:
    """Hashes of the seeds that have more spans than a bucket's share of all, at most one for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, "text", CHUNK):
            x, starts, size, _ = _texts(batch)
            seed, n = np.unique(sample(x, starts, size)[4], return_counts=True)
            often = n > 1
            yield pa.RecordBatch.from_arrays([pa.array([None, *seed[often].view(np.int64).tolist()], pa.int64()), pa.array([int(n.sum()), *n[often].tolist()], pa.int64())], ["seed", "n"])

    counts = rows.where(F.pmod("key", F.lit(LOOK)) == 0).select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    counts = common.stage(counts.where(F.col("seed").isNull() | (F.col("n") >= FEW)), "seeds")
    total = counts.where("seed is null").first()
    if total is None:
        return np.zeros(0, np.uint64)
    found = counts.where(F.col("seed").isNotNull() & (F.col("n") > max(FEW, total["n"] // (parts * FINE)))).select("seed").toArrow()
    return np.sort(found.column("seed").to_numpy().view(np.uint64))


def _cover(parts: int, hot: np.ndarray):
    """Step 1, mapping: sampled positions by seed, strings of hot seeds; repeats within the chunk are done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = xxhash.xxh3_64_intdigest
        for batch in common.chunks(batches, "text", CHUNK):
            x, starts, size, whole = _texts(batch)
            docs = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key")]).astype(np.int64)
            of, m, high, low, seed = sample(x, starts, size)
            if not len(m):
                continue
            span = np.array([h(whole[a:b]) for a, b in zip((m - high).tolist(), (m - low + LENGTH).tolist())], np.uint64)
            span ^= _mix((high * 128 + low).astype(np.uint64))
            at = m - starts[of]
            order = np.lexsort((at, docs[of, 1], docs[of, 0], span, seed))
            of, at, high, low, seed, span = (v[order] for v in (of, at, high, low, seed, span))
            same = np.concatenate([[False], (seed[1:] == seed[:-1]) & (span[1:] == span[:-1])])
            done = _later(same, docs, of, at)
            rows = []
            rows += _blocks(_home(docs, parts)[of[done]], _DONE, docs, of[done], [(at - high)[done].astype(np.int32), (at - low)[done].astype(np.int32) + np.int32(LENGTH)])
            f = ~same
            if len(hot):
                known = f & (hot[np.minimum(np.searchsorted(hot, seed), len(hot) - 1)] == seed)
                if known.any():
                    which, place, two = _strings(whole, at[known] + starts[of[known]], high[known], low[known])
                    own = of[known][which]
                    rows += _string_blocks(docs, own, place - starts[own], two, parts)
                    f &= ~known
            rows += _blocks((seed[f] % np.uint64(parts * FINE)).astype(np.int64), 0, docs, of[f], [seed[f], span[f], at[f].astype(np.int32), high[f].astype(np.uint8), low[f].astype(np.uint8)])
            yield _batch(rows)

    return run


def _first_spans(parts: int):
    """Step 1, reducing: spans that occurred earlier are done; first ones of seeds with several spans are open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {0: [], _STRINGS: []}
        repeats, opened = _Held(_DONE, parts, "i4", "i4"), _Held(_OPEN, parts, "i4", "u1", "u1")

        def out() -> None:
            if held[0]:
                bucket(held[0], repeats, opened)
            if held[_STRINGS]:
                _done_strings(held[_STRINGS], repeats)
            held.update({0: [], _STRINGS: []})

        for batch in batches:
            for part, kind, data in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "data"))):
                if kind == _DONE:
                    docs, of, arrays = _gather([data], "i4", "i4")
                    repeats.add(docs, of, *arrays)
                    continue
                if part != now:
                    out()
                now = part
                held[kind].append(data)
            for found in (repeats, opened):
                yield from found.rows(HELD)
        out()
        for found in (repeats, opened):
            yield from found.rows()

    def bucket(blobs: list[bytes], repeats: _Held, opened: _Held) -> None:
        docs, of, (seed, span, at, high, low) = _gather(blobs, "u8", "u8", "i4", "u1", "u1")
        order = np.argsort(seed)
        sorted_seed = seed[order]
        lone = np.ones(len(order), bool)
        lone[1:] &= sorted_seed[1:] != sorted_seed[:-1]
        lone[:-1] &= sorted_seed[1:] != sorted_seed[:-1]
        order = order[~lone]
        of, seed, span, at, high, low = (v[order] for v in (of, seed, span, at, high, low))
        order = np.lexsort((at, docs[of, 1], docs[of, 0], span, seed))
        of, seed, span, at, high, low = (v[order] for v in (of, seed, span, at, high, low))
        if not len(of):
            return
        at, high, low = at.astype(np.int32), high.astype(np.int32), low.astype(np.int32)
        same = np.concatenate([[False], (seed[1:] == seed[:-1]) & (span[1:] == span[:-1])])
        done = _later(same, docs, of, at)
        repeats.add(docs, of[done], (at - high)[done], (at - low)[done] + np.int32(LENGTH))
        f = np.flatnonzero(~same)
        number = np.cumsum(np.concatenate([[True], seed[f][1:] != seed[f][:-1]])) - 1
        spans = np.bincount(number)[number]
        f = f[spans > 1]
        opened.add(docs, of[f], at[f], high[f], low[f])

    return run


def _by_document(types: tuple[str, ...], merge) -> object:
    """Blocks of one part after another: a row for each document with what merge() makes of its entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(blobs: list[bytes]) -> pa.RecordBatch:
            docs, of, arrays = _gather(blobs, *types)
            order = _in_order(docs, of, arrays[0])
            ids = docs[of[order]]
            arrays = [a[order] for a in arrays]
            first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(1)]))
            data = [pack(*merge(*[a[i:j] for a in arrays])) for i, j in zip(first.tolist(), [*first[1:].tolist(), len(ids)])]
            return pa.RecordBatch.from_arrays([pa.array(ids[first, 0]), pa.array(ids[first, 1]), pa.array(data, pa.binary())], ["of_id", "of_key", "data"])

        now, blobs = None, []
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                if part != now and blobs:
                    yield out(blobs)
                    blobs = []
                now = part
                blobs.append(data)
        if blobs:
            yield out(blobs)

    return run


def _joined(rows: DataFrame, blocks: DataFrame, parts: int, types: tuple[str, ...], merge, how: str) -> DataFrame:
    """rows (id, key, ...) with data, what their blocks hold."""
    dealt = blocks.select("part", "data").repartitionById(parts, "part").sortWithinPartitions("part")
    per_doc = dealt.mapInArrow(_by_document(types, merge), "of_id long, of_key long, data binary")
    return rows.join(per_doc, (rows["id"] == per_doc["of_id"]) & (rows["key"] == per_doc["of_key"]), how)


def _fetch(parts: int):
    """Step 2, mapping: the bytes of open spans by seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = xxhash.xxh3_64_intdigest
        for batch in common.chunks(batches, "text", CHUNK):
            docs = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key")]).astype(np.int64)
            part, of, places, highs, lows, pieces = [], [], [], [], [], []
            for k, (text, data) in enumerate(zip(batch.column("text").to_pylist(), batch.column("data").to_pylist())):
                raw = text.encode()
                for m, high, low in zip(*(v.tolist() for v in unpack(data, "i4", "u1", "u1"))):
                    part.append(h(raw[m : m + SEED]) % (parts * FINE))
                    of.append(k)
                    places.append(m)
                    highs.append(high)
                    lows.append(low)
                    pieces.append(raw[m - high : m - low + LENGTH])
            if not part:
                continue
            # A span's bytes are packed as a text of fixed width: left part, right part.
            wide = np.zeros((len(pieces), REACH + LENGTH), np.uint8)
            sizes = np.array([len(x) for x in pieces])
            col = np.repeat(REACH - np.array(highs) - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            wide[np.repeat(np.arange(len(pieces)), sizes), col] = np.frombuffer(b"".join(pieces), np.uint8)
            fixed = wide.view(f"V{REACH + LENGTH}").ravel()
            yield _batch(list(_blocks(np.array(part, np.int64), _SPANS, docs, np.array(of), [np.array(places, np.int32), np.array(highs, np.uint8), np.array(lows, np.uint8), fixed])))

    return run


def ranks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of bytes, and the common length of each row and the one before it in that order."""
    n, width = text.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = text
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    text = text[order]
    common_length = np.zeros(n, np.int64)
    if n > 1:
        differ = text[1:] != text[:-1]
        common_length[1:] = np.where(differ.any(1), differ.argmax(1), width)
    return order, common_length


def later_strings(wide: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """[span, offset]: whether the string at that offset equals one of an earlier span at the same offset.

    wide: REACH bytes before each sampled position and LENGTH from it on; spans in the order of their place.
    """
    n = len(wide)
    right_order, right_common = ranks(wide[:, REACH:])
    left_order, left_common = ranks(np.ascontiguousarray(wide[:, REACH - 1 :: -1]))
    out = np.zeros((n, REACH + 1), bool)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for t in range(REACH + 1):
        own = np.flatnonzero((low <= t) & (t <= high))
        if len(own) < 2:
            continue
        right[right_order] = np.cumsum(right_common < LENGTH - t)
        left[left_order] = np.cumsum(left_common < t)
        first = np.unique(left[own] * (n + 1) + right[own], return_index=True)[1]
        again = np.ones(len(own), bool)
        again[first] = False
        out[own[again], t] = True
    return out


def _sorted_buckets(parts: int):
    """Step 2, reducing, one bucket after another."""

    def of_spans(blobs: list[bytes], repeats: _Held) -> None:
        docs, of, (at, high, low, fixed) = _gather(blobs, "i4", "u1", "u1", f"V{REACH + LENGTH}")
        order = _in_order(docs, of, at)
        mine, place = docs[of[order]], at[order]
        order = order[np.concatenate([[True], (mine[1:] != mine[:-1]).any(1) | (place[1:] != place[:-1])])]
        of, at, high, low = of[order], at[order], high[order].astype(np.int32), low[order].astype(np.int32)
        wide = fixed[order].view(np.uint8).reshape(-1, REACH + LENGTH)
        again = later_strings(wide, high, low)
        edge = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, begin = np.nonzero(edge == 1)
        stop = np.nonzero(edge == -1)[1] - 1  # offsets begin..stop repeat: starts at - stop .. at - begin
        repeats.add(docs, of[row], at[row] - stop, at[row] - begin + LENGTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, repeats = None, [], _Held(_DONE, parts, "i4", "i4")
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                if part != now and held:
                    of_spans(held, repeats)
                    held = []
                now = part
                held.append(data)
            yield from repeats.rows(HELD)
        if held:
            of_spans(held, repeats)
        yield from repeats.rows()

    return run


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals sorted by start as maximal runs; touching ones are one."""
    reach = np.maximum.accumulate(stop)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(start)) - 1
    return start[new], reach[last]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.chunks(batches, "text"):
        kept, at, starts, stops, sizes = [], [0], [], [], []
        for text, data in zip(batch.column("text").to_pylist(), batch.column("data").to_pylist()):
            raw = text.encode()
            sizes.append(len(raw))
            a, b = (v.tolist() for v in unpack(data, "i4", "i4")) if data is not None else ([], [])
            kept.append(b"".join(raw[i:j] for i, j in zip([0, *b], [*a, len(raw)])))
            starts += a
            stops += b
            at.append(len(starts))
        spans = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(stops, pa.int32())], ["start", "stop"]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), spans, pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def _dealt(blocks: DataFrame, parts: int) -> DataFrame:
    """FINE buckets to a partition; what is done already is dealt evenly."""
    return blocks.repartitionById(parts, F.when(F.col("kind") == _DONE, F.col("part")).otherwise(F.floor(F.col("part") / FINE)).cast("int"))


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, spans (array of start, stop: removed bytes), kept (binary: the rest).

    A byte goes if a string of LENGTH bytes over it also starts earlier: in a document of smaller id, or earlier in the
    same one. Null texts count as empty; texts under LENGTH bytes lose nothing. A null id comes after all others.
    Rows of the same id are told apart by a hash of their text, in whose order they stand; rows equal in id and text
    are one document, and each gets its result. Empty tables give empty results; other columns are ignored.
    """
    rows = common.pick(docs, doc_id=doc_id, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("id"), F.xxhash64("text").alias("key"), "text")
    long = rows.where(F.octet_length("text") >= LENGTH).select("id", "key", "text")
    size = long.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    sampled = long.mapInArrow(_cover(parts, hot_seeds(long, parts)), _DEALT)
    first = common.stage(_dealt(sampled, parts).sortWithinPartitions("part").mapInArrow(_first_spans(parts), _DEALT), "spans")
    asked = _joined(rows.select("id", "key", "text"), first.where(F.col("kind") == _OPEN), parts, ("i4", "u1", "u1"), lambda *v: v, "inner")
    fetched = asked.select("id", "key", "text", "data").mapInArrow(_fetch(parts), _DEALT)
    again = _dealt(fetched, parts).sortWithinPartitions("part").mapInArrow(_sorted_buckets(parts), _DEALT)
    done = common.stage(again, "strings").unionByName(first.where(F.col("kind") == _DONE))
    final = _joined(rows, done, parts, ("i4", "i4"), merged, "left").select("doc_id", "text", "data")
    schema = final.select("doc_id").schema.add("n_bytes", "long")
    schema = schema.add("spans", T.ArrayType(T.StructType().add("start", "integer").add("stop", "integer"))).add("kept", "binary")
    return final.mapInArrow(_cut, schema)


def op2_repeats(spark, sf_dir: str) -> DataFrame:
    """What is removed from every document."""
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
