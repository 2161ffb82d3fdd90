"""SentencePiece BPE encoding and decoding with vectorised merge rounds (operator 1).

A word is U+2581 and what follows it up to the next one. No piece of the vocabularies this module takes
crosses a word's start (that is checked), so words are encoded apart and each distinct word of a task once.

Rounds: all symbols of all words lie in one flat array. Each round finds each word's smallest pair rank
(segmented minimum), merges that rank's occurrences from the left, drops the consumed symbols, and takes
finished words out, until no pair remains. A rank whose piece can grow at the same or a smaller rank is merged
one occurrence at a time, which keeps the order of a priority queue in every case.

Words of over LONG characters are first cut between characters that stand side by side in no piece, as no merge can
cross there. What is then still longer than QUEUED is merged by a priority queue, as rounds would cost its square.

Runs of U+2581 rank below all else; they are split apart from words, as leftmost merging does.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SPACE = "▁"
_NONE = np.int32(2**31 - 1)
#: Symbols from here on are characters that no piece starts a merge with: the value less this is the code point.
_LOOSE = 1 << 21
#: Characters of a word beyond which it is cut where no piece can cross, and of a stretch beyond which it is queued.
LONG, QUEUED = 64, 1_000
#: What the library must encode as this module does, or the model isn't of the kind that it takes.
_PROBES = ["Plain words, 12.50 and more.", " two  spaces ", "ﬁne Ａ ① é é \t\n\u00a0x", "日本語 Ωmega", "haaaaaaaaa ababababab", "\u2581under ￾"]
#: Distinct words that a task remembers before it starts anew.
MEMORY = 400_000


def _starts(seg: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before."""
    out = np.ones(len(seg), bool)
    np.not_equal(seg[1:], seg[:-1], out=out[1:])
    return out


class _Numbers(dict):
    """Numbers keys as they come and lists the new ones."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class PieceModel:
    """Merge tables of a sentencepiece BPE model file with byte fallback and the identity normaliser."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.n, self.end = n, sp.eos_id()
        self.bytes_at = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        texts, scores = [sp.id_to_piece(i) for i in range(n)], np.array([sp.get_score(i) for i in range(n)])
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(SPACE in texts[i].lstrip(SPACE) or re.match(f"{SPACE}{{2,}}[^{SPACE}]", texts[i]) for i in plain):
            raise ValueError("pieces that cross a word's start aren't supported")
        self.runs = {len(texts[i]): i for i in plain if set(texts[i]) == {SPACE}}
        self.longest_run = max(self.runs)
        self.rests = [self._merged_run(k) for k in range(self.longest_run)]
        if any(self._merged_run(k) != self._split_run(k) for k in range(3 * self.longest_run)):
            raise ValueError("these white-space pieces aren't supported")
        symbol = {texts[i]: i for i in plain}
        rank_of = np.full(n, _NONE, np.int32)
        rank_of[plain] = np.unique(-scores[plain], return_inverse=True)[1]
        for c in sorted({c for i in plain for c in texts[i]} - symbol.keys()):
            symbol[c] = n + len(symbol)  # in pieces, but none itself
        self.char = np.full(0x110000, -1, np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.char[ord(c)] = i
        self.code_of = {i: ord(c) for c, i in symbol.items() if i >= n}
        keys, merged, unsafe = [], [], np.zeros(n, bool)
        for i in plain:
            t = texts[i]
            for cut in range(1, len(t)):
                a, b = symbol.get(t[:cut]), symbol.get(t[cut:])
                if a is not None and b is not None and set(t) != {SPACE}:
                    keys.append(a << 32 | b)
                    merged.append(i)
                    for x in (a, b):
                        if x < n and rank_of[i] <= rank_of[x]:
                            unsafe[x] = True
        order = np.argsort(keys)
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int32)[order]
        self.ranks = rank_of[self.merged]
        self.unsafe_rank = np.zeros(int(rank_of[plain].max()) + 1, bool)
        self.unsafe_rank[rank_of[unsafe & (rank_of < _NONE)]] = True
        sides = {ord(a) << 32 | ord(b) for i in plain for a, b in zip(texts[i], texts[i][1:])}
        self.sides = np.array(sorted(sides), np.int64)
        self.queue_of: dict[int, tuple[int, int]] | None = None
        # Pairs of the first 255 characters and U+2581 are looked up directly.
        self.common = np.full(_LOOSE + 1, -1, np.int32)
        usual = [(k, int(self.char[c])) for k, c in enumerate([*range(255), ord(SPACE)]) if self.char[c] >= 0]
        for k, i in usual:
            self.common[i] = k
        self.common_rank, self.common_piece = np.full(65536, _NONE, np.int32), np.full(65536, -1, np.int32)
        at = np.array([[a * 256 + b for b, _ in usual] for a, _ in usual]).ravel()
        left, right = np.meshgrid([i for _, i in usual], [i for _, i in usual], indexing="ij")
        self.common_rank[at], self.common_piece[at] = self.pairs(left.ravel(), right.ravel())
        # Decoding: the bytes of each id.
        shown = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else bytes([int(t[3:5], 16)]) if sp.is_byte(i) else t.replace(SPACE, " ").encode() for i, t in enumerate(texts)]
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.hidden = np.array([sp.is_control(i) for i in range(n)])
        self.spaced = np.array([t.startswith(SPACE) for t in texts])
        self.out = np.frombuffer(b"".join(shown), np.uint8)
        self.out_len = np.array([len(x) for x in shown], np.int64)
        self.out_at = np.concatenate([[0], np.cumsum(self.out_len)[:-1]])
        ids, at = Encoder(self).encode(_PROBES)
        if [p.tolist() for p in np.split(ids, at[1:-1])] != sp.encode(_PROBES):
            raise ValueError("only BPE models with byte fallback and the identity normaliser are supported")

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece that each pair of neighbours makes."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.merged[at], -1)

    def _stretches(self, code: np.ndarray, size: np.ndarray) -> np.ndarray:
        """True where a word begins, or where a long word can be cut."""
        begin = np.zeros(len(code), bool)
        begin[(np.cumsum(size) - size)[size > 0]] = True
        long = np.flatnonzero(np.repeat(size > LONG, size) & ~begin)
        if len(long):
            side = code[long - 1].astype(np.int64) << 32 | code[long]
            at = np.minimum(np.searchsorted(self.sides, side), len(self.sides) - 1)
            begin[long[self.sides[at] != side]] = True
        return begin

    def _queue(self, sym: np.ndarray) -> list[int]:
        """Symbols of one stretch after all merges, smallest rank and then leftmost first."""
        if self.queue_of is None:
            self.queue_of = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        of, s, n = self.queue_of, sym.tolist(), len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(x[0], i, s[i], s[i + 1], x[1]) for i in range(n - 1) if (x := of.get(s[i] << 32 | s[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, piece = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue
            s[i], s[j] = piece, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if x := of.get(piece << 32 | s[k]):
                    heapq.heappush(heap, (x[0], i, piece, s[k], x[1]))
            if (h := before[i]) >= 0 and (x := of.get(s[h] << 32 | piece)):
                heapq.heappush(heap, (x[0], h, s[h], piece, x[1]))
        return [x for x in s if x >= 0]

    def rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without runs of U+2581, and where each word's ids start (one entry more than words)."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = self._stretches(code, size)
        seg = (np.cumsum(begin) - 1).astype(np.int32)
        word_of = np.repeat(np.arange(len(words), dtype=np.int32), size)[begin]
        sym = self.char[code]
        sym = np.where(sym < 0, _LOOSE + code, sym)
        done_sym, done_seg = [], []
        sizes = np.bincount(seg, minlength=len(word_of))
        for k in np.flatnonzero(sizes > QUEUED).tolist():
            a = int(np.searchsorted(seg, k))
            found = np.array(self._queue(sym[a : a + sizes[k]]), np.int32)
            done_sym.append(found)
            done_seg.append(np.full(len(found), k, np.int32))
        if done_sym:
            keep = np.flatnonzero(np.repeat(sizes <= QUEUED, sizes))
            sym, seg = sym[keep], seg[keep]
        rank, piece = self._edge(sym, seg)
        while len(sym):
            first = np.flatnonzero(_starts(seg))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(first, append=len(sym))
            over = least == _NONE
            if 2 * np.count_nonzero(over) >= len(over):  # finished words go once they are many
                over = np.repeat(over, size)
                done_sym.append(sym[over])
                done_seg.append(seg[over])
                keep = np.flatnonzero(~over)
                sym, seg, rank, piece = sym[keep], seg[keep], rank[keep], piece[keep]
                continue
            at = np.flatnonzero((rank == np.repeat(least, size)) & (rank != _NONE))
            near = seg[at]
            new = _starts(near)
            if (odd := self.unsafe_rank[rank[at]]).any():
                at = at[new | ~odd]
                near = seg[at]
            # Of touching occurrences, every second one, from the left.
            begin = np.ones(len(at), bool)
            begin[1:] = (at[1:] != at[:-1] + 1) | (near[1:] != near[:-1])
            if not begin.all():
                i = np.arange(len(at))
                at = at[(i - np.maximum.accumulate(np.where(begin, i, 0))) % 2 == 0]
            sym[at] = piece[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            keep = np.flatnonzero(keep)
            sym, seg, rank, piece = sym[keep], seg[keep], rank[keep], piece[keep]
            fresh = at - np.arange(len(at))
            mark = np.zeros(len(sym), bool)
            mark[fresh] = True
            mark[np.maximum(fresh - 1, 0)] = True
            fresh = np.flatnonzero(mark)
            right = np.minimum(fresh + 1, len(sym) - 1)
            r, p = self.pairs(sym[fresh], sym[right])
            lone = (right == fresh) | (seg[right] != seg[fresh])
            r[lone] = _NONE
            rank[fresh], piece[fresh] = r, p
        if not done_sym:
            return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
        sym, seg = np.concatenate(done_sym), np.concatenate(done_seg)
        order = np.argsort(seg, kind="stable")
        return self._bytes(sym[order], word_of[seg[order]], len(words))

    def _edge(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, piece = np.full(len(sym), _NONE, np.int32), np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            a, b = self.common[np.minimum(sym[:-1], _LOOSE)], self.common[np.minimum(sym[1:], _LOOSE)]
            known = (a >= 0) & (b >= 0)
            at = a * 256 + b
            rank[:-1], piece[:-1] = self.common_rank[at], self.common_piece[at]
            rest = np.flatnonzero(~known)
            rank[rest], piece[rest] = self.pairs(sym[rest], sym[rest + 1])
            rank[:-1][seg[1:] != seg[:-1]] = _NONE
        return rank, piece

    def _bytes(self, sym: np.ndarray, seg: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece become the ids of their bytes."""
        if (odd := np.flatnonzero(sym >= self.n)).size:
            raw = [chr(self.code_of[s] if s < _LOOSE else s - _LOOSE).encode() for s in sym[odd].tolist()]
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(x) for x in raw]
            starts = np.cumsum(times) - times
            sym, seg = np.repeat(sym, times), np.repeat(seg, times)
            into = np.repeat(starts[odd], times[odd]) + np.concatenate([np.arange(len(x)) for x in raw])
            sym[into] = self.bytes_at[np.frombuffer(b"".join(raw), np.uint8)]
        return sym, np.concatenate([[0], np.cumsum(np.bincount(seg, minlength=n))])

    def _merged_run(self, n: int) -> list[int]:
        """Lengths of the pieces of n times U+2581 alone, by leftmost merging."""
        out = [1] * n
        while (i := next((i for i in range(len(out) - 1) if out[i] + out[i + 1] in self.runs), None)) is not None:
            out[i : i + 2] = [out[i] + out[i + 1]]
        return out

    def _split_run(self, n: int) -> list[int]:
        full, rest = divmod(n, self.longest_run)
        return [self.longest_run] * full + self.rests[rest]

    def run(self, n: int) -> list[int]:
        return [self.runs[k] for k in self._split_run(n)]


class Encoder:
    """Encodes texts; distinct words are remembered up to MEMORY of them."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, units: list[str]) -> None:
        """A unit stands for U+2581 and its text; each space that it starts with is a further U+2581 before that."""
        m = self.model
        bodies = [u.lstrip(" ") for u in units]
        flat, at = m.rounds([SPACE + x if x else "" for x in bodies])
        if odd := [k for k, (u, x) in enumerate(zip(units, bodies)) if len(u) != len(x) or not x]:
            parts = np.split(flat, at[1:-1])
            for k in odd:
                runs, ids = len(units[k]) - len(bodies[k]) + 1, parts[k].tolist()
                alone = not ids or ids[0] == m.runs[1]
                parts[k] = np.array(m.run(runs if alone else runs - 1) + (ids[1:] if alone else ids), np.int32)
            flat, at = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        self.flat, self.at = np.concatenate([self.flat, flat]), np.concatenate([self.at, self.at[-1] + at[1:]])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids without an end, and where each text's ids start."""
        if len(self.known) > MEMORY:
            self.forget()
        units, counts = [], []
        for t in texts:
            if SPACE in t:
                t = t.replace(SPACE, " ")
            if not t:
                found = []
            elif t[0] == " " or t[-1] == " " or "  " in t:
                found = [x[1:] for x in re.findall(" +[^ ]*", f" {t}")]
            else:
                found = t.split(" ")
            units += found
            counts.append(len(found))
        which = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        size = self.at[which + 1] - self.at[which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.at[which] - (ends - size), size) + np.arange(total)]
        starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return ids, np.concatenate([[0], ends])[starts]


def decode(model: PieceModel, ids: np.ndarray, at: np.ndarray) -> list[str]:
    """Texts of flat ids; at has each text's start and, last, the end."""
    size = model.out_len[ids]
    ends = np.cumsum(size)
    raw = model.out[np.repeat(model.out_at[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
    byte_at = np.concatenate([[0], ends])
    seen = np.concatenate([[0], np.cumsum(~model.hidden[ids])])
    texts = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        lead = a + int(np.searchsorted(seen[a : b + 1], seen[a], side="right")) - 1
        cut = 1 if lead < b and model.spaced[ids[lead]] else 0
        part = raw[byte_at[a] + cut : byte_at[b]]
        try:
            texts.append(part.decode())
        except UnicodeDecodeError:
            texts.append(_mend(model, ids[a:b], cut))
    return texts


def _mend(model: PieceModel, ids: np.ndarray, cut: int) -> str:
    """As decode(), for byte ids that aren't whole characters: each byte that fits nowhere is one U+FFFD."""
    out, run = [], bytearray()

    def flush() -> None:
        while run:
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[:n]).decode())
                    del run[:n]
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                del run[0]

    for i in ids.tolist():
        piece = model.out[model.out_at[i] : model.out_at[i] + model.out_len[i]].tobytes()
        if model.is_byte[i]:
            run += piece
        else:
            flush()
            out.append(piece.decode())
    flush()
    return "".join(out)[cut:]


_MODELS: dict[str, PieceModel] = {}


def model_at(path: str) -> PieceModel:
    """One per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_end: bool = True, decoded: bool = True) -> DataFrame:
    """The kept columns, ids (array of int) and, if asked for, decoded (the text that the ids stand for).

    Row by row, without a shuffle; a task holds about common.CHUNK_BYTES of text at once, so long texts cost
    memory and time in proportion to their length (words without a space: to it and its logarithm). A null text counts as empty and has only the end id; empty tables give
    empty results; repeated rows give repeated results; other columns of docs are ignored.
    model_path must be readable where the tasks run.
    """
    kept = docs.select(*[docs[f"`{c}`"] for c in keep], F.coalesce(docs[f"`{text}`"], F.lit("")).alias("__text"))
    fields = list(kept.schema.fields[:-1]) + [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("decoded", T.StringType())] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        encoder = Encoder(model)
        for batch in common.chunks(batches, "__text"):
            ids, at = encoder.encode(batch.column("__text").to_pylist())
            if with_end:
                ids = np.insert(ids, at[1:], model.end)
                at = at + np.arange(len(at))
            out = [batch.column(i) for i in range(len(keep))]
            out.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
            if decoded:
                out.append(pa.array(decode(model, ids, at), pa.string()))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    return common.map_in_arrow(kept, run, T.StructType(fields))


def op1_pieces(spark, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    done = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
