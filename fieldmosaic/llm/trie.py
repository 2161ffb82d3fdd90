"""Prefix tries of conversations by the Euler-tour technique (operator 12).

A node is a distinct sequence of turns; its key is the exclusive-or of hashes of (position, turn), so that keys of all
prefixes are running sums which blocks of a long conversation can share. Every node has an arc that enters it and one
that leaves it; their successors are its first child, its next sibling or its parent, which makes one list of all arcs.
The list is ranked by contraction: arcs whose random number is above both neighbours' are taken out, round after round,
until few are left, and are put back in the reverse order. Sums over the arcs' places, taken in blocks, give what a
subtree holds: the sum where it is left less the sum where it is entered.

No conversation, parent or group of equal ends is gathered by one task. Keys have 128 bits of SHA-256 digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ranges
from . import common

#: Turns of a conversation, and places of the tour, that are summed in one window.
BLOCK = 4_096
#: Children of one parent that are linked in one window, on average at most.
SIBLINGS = 4_096
#: A list of so many items is walked by one task instead of being contracted further.
WALK = 1 << 15
#: Ids of one piece of text that is hashed.
PIECE = 1_000
_END = -1


def positions(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, pos (from 1 on), sha (of role and text) and bytes (of the text in UTF-8) of every turn.

    In the order of turn, null first; equal turns by role, then by text. Null roles and texts are empty; repeated rows are
    turns of their own. Rows without a conv_id belong to no conversation and are left out.
    """
    rows = common.pick(turns, conv_id=conv_id, turn=turn, role=role, text=text).where("conv_id is not null")
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    # A conversation of very many turns is ranked range by range.
    within = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    ranged = rows.withColumn("part", ranges.place(rows, "turn"))
    slim = common.stage(ranged.select("conv_id", "part", F.row_number().over(within).cast("long").alias("i"), F.unhex(F.sha2(content, 256)).alias("sha"), F.octet_length("text").cast("long").alias("bytes")), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = slim.groupBy("conv_id", "part").agg(F.count("*").alias("n")).select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return slim.join(shift, ["conv_id", "part"]).select("conv_id", (F.col("i") + F.col("before")).alias("pos"), "sha", "bytes")


def branched(placed: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: (turns, members).

    Conversation c takes the first h turns of c - c % family (all if it has fewer, none if it is absent) and then its own
    behind its first h, h being crc32 of its decimal id % most. turns: as positions(); members: conv_id and length,
    those without a turn included.
    """
    n = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % family
    h = F.when(F.col("conv_id") == base, F.lit(0)).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    own = n.select("conv_id", "n", base.alias("base"), h.alias("h"))
    of = n.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    members = common.stage(own.join(of, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "members")
    kept = placed.join(members, "conv_id").where("pos > h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "sha", "bytes")
    first = placed.where(F.col("pos") < most).withColumnRenamed("conv_id", "base")
    lent = first.join(members.where("taken > 0").select("conv_id", "base", "taken"), "base").where("pos <= taken").select("conv_id", "pos", "sha", "bytes")
    return kept.unionByName(lent), members.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos, bytes, k1, k2 (the key of the first pos turns) and p1, p2 (that of one turn less)."""
    hashed = turns.select("conv_id", "pos", "bytes", F.floor((F.col("pos") - 1) / BLOCK).alias("block"), F.xxhash64("pos", "sha").alias("g1"), F.xxhash64("sha", "pos").alias("g2"))
    local = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = hashed.withColumns({"x1": F.bit_xor("g1").over(local), "x2": F.bit_xor("g2").over(local)})
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = hashed.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("b1"), F.bit_xor("g2").alias("b2"))
    above = blocks.select("conv_id", "block", F.bit_xor("b1").over(before).alias("a1"), F.bit_xor("b2").over(before).alias("a2")).where("block > 0")
    key = {f"k{k}": F.col(f"x{k}").bitwiseXOR(F.coalesce(f"a{k}", F.lit(0))) for k in (1, 2)}
    parent = {f"p{k}": F.col(f"k{k}").bitwiseXOR(F.col(f"g{k}")) for k in (1, 2)}
    return inside.join(above, ["conv_id", "block"], "left").withColumns(key).withColumns(parent).select("conv_id", "pos", "bytes", "k1", "k2", "p1", "p2")


def _walked(links: DataFrame) -> DataFrame:
    """Places of a list that is known to be short, by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, at = {}, None
        for batch in batches:
            for item, prev, next_, gap in zip(*(batch.column(c).to_pylist() for c in ("item", "prev", "next", "gap"))):
                after[item] = next_, gap
                at = item if prev == _END else at
        items, places, place = [], [], 0
        while at is not None and at != _END:
            items.append(at), places.append(place)
            at, gap = after[at]
            place += gap
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(places, pa.int64())], ["item", "place"])

    return links.coalesce(1).mapInArrow(run, "item long, place long")


def list_ranks(links: DataFrame, walk: int | None = None) -> DataFrame:
    """item, prev, next (-1 at the ends) of one list to item, place (from 0 on).

    About a third of the items goes in each round, so that the work of all rounds is in proportion to the list and their
    number to its logarithm. Every round is written to the shared folder.
    """
    now, rounds = common.stage(links.select("item", "prev", "next", F.lit(1).cast("long").alias("gap")), "list"), []
    while now.count() > (WALK if walk is None else walk):
        luck = lambda c: F.xxhash64(F.lit(len(rounds)), F.col(c))  # noqa: B023, E731
        top = (F.col("prev") != _END) & (F.col("next") != _END) & (luck("item") > luck("prev")) & (luck("item") > luck("next"))
        none = F.lit(None).cast("long")
        out, kept = now.where(top), now.where(~top).select("*", none.alias("new_prev"), none.alias("new_next"), none.alias("more"))
        # What goes tells its neighbours: no two of these are neighbours, so an item hears of one on each side at most.
        to_prev = out.select(F.col("prev").alias("item"), none.alias("prev"), none.alias("next"), none.alias("gap"), none.alias("new_prev"), F.col("next").alias("new_next"), F.col("gap").alias("more"))
        to_next = out.select(F.col("next").alias("item"), none.alias("prev"), none.alias("next"), none.alias("gap"), F.col("prev").alias("new_prev"), none.alias("new_next"), none.alias("more"))
        heard = kept.unionByName(to_prev).unionByName(to_next).groupBy("item").agg(*[F.max(c).alias(c) for c in kept.columns if c != "item"])
        rounds.append(out)
        now = common.stage(heard.select("item", F.coalesce("new_prev", "prev").alias("prev"), F.coalesce("new_next", "next").alias("next"), (F.col("gap") + F.coalesce("more", F.lit(0))).alias("gap")), "list")
    places = common.stage(_walked(now), "places")
    for out in reversed(rounds):
        after = places.select(F.col("item").alias("next"), F.col("place").alias("next_place"))
        back = out.join(after, "next").select("item", (F.col("next_place") - F.col("gap")).alias("place"))
        places = common.stage(places.unionByName(back), "places")
    return places


def running_sums(df: DataFrame, place: str, columns: list[str], n: int) -> DataFrame:
    """df with sum_<column> over all rows up to this one; place: each of 0 to n-1 once. Blocks are summed one by one."""
    if n <= BLOCK:
        return df.withColumns({f"sum_{c}": F.sum(c).over(Window.partitionBy(F.lit(0)).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)) for c in columns})
    block = f"__block_{place}"  # blocks of blocks have a name of their own
    blocked = df.withColumn(block, F.floor(F.col(place) / BLOCK))
    local = Window.partitionBy(block).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    inside = blocked.withColumns({f"__{c}": F.sum(c).over(local) for c in columns})
    totals = blocked.groupBy(block).agg(*[F.sum(c).alias(f"__all_{c}") for c in columns])
    above = running_sums(totals, block, [f"__all_{c}" for c in columns], -(-n // BLOCK))
    above = above.select(block, *[(F.col(f"sum___all_{c}") - F.col(f"__all_{c}")).alias(f"__before_{c}") for c in columns])
    return inside.join(above, block).select(*df.columns, *[(F.col(f"__{c}") + F.col(f"__before_{c}")).alias(f"sum_{c}") for c in columns])


def joined_digests(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, digest: SHA-256 of each key's values (long), ascending, in decimal with commas between.

    Values are sorted by ranges, so that a key of very many is many tasks' work, and put together in pieces of text. Only
    these pass through one task a key, one batch at a time, as the digest of a text can't be taken in parallel.
    """
    names, types = [*keys, "first", "ids"], {**dict(rows.dtypes), "first": "bigint", "ids": "string"}

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in (*keys, value)]
            out: list[list] = [[] for _ in names]
            last, held = None, []
            for *key, x in zip(*cols):
                if held and (key != last or len(held) == PIECE):
                    for c, v in zip(out, (*last, held[0], ",".join(map(str, held)))):
                        c.append(v)
                    held = []
                last = key
                held.append(x)
            if held:
                for c, v in zip(out, (*last, held[0], ",".join(map(str, held)))):
                    c.append(v)
            kinds = [batch.schema.field(k).type for k in keys] + [pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = digest = kinds = None
        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys] + [pa.string()]
            out: list[list] = [[] for _ in kinds]
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids"))):
                if key == last:
                    digest.update(b",")
                else:
                    if last is not None:
                        for c, v in zip(out, (*last, digest.hexdigest())):
                            c.append(v)
                    last, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], [*keys, "digest"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*last, digest.hexdigest()), kinds)], [*keys, "digest"])

    own = ", ".join(f"{k} {types[k]}" for k in keys)
    pieces = rows.select(*keys, value).repartitionByRange(*keys, value).sortWithinPartitions(*keys, value).mapInArrow(packed, f"{own}, first bigint, ids string")
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(hashed, f"{own}, digest string")


def _tour(nodes: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(kids: parent, n_children; arcs: item, prev, next): 2 id enters a node, 2 id + 1 leaves it.

    Children are linked in the order of a salt and then of their id. There are as many salts as keep the children of a
    parent that has most nodes in groups of some SIBLINGS.
    """
    salted = nodes.where("parent is not null").select("id", "parent", F.pmod(F.xxhash64("id"), F.lit(n // SIBLINGS + 1)).alias("salt"))
    near = salted.select("id", F.lead("id").over(Window.partitionBy("parent", "salt").orderBy("id")).alias("next")).where("next is not null")
    groups = salted.groupBy("parent", "salt").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
    far = groups.select(F.col("last").alias("id"), F.lead("first").over(Window.partitionBy("parent").orderBy("salt")).alias("next")).where("next is not null")
    pairs = near.unionByName(far)
    none = F.lit(None).cast("long")
    beside = pairs.select("id", "next", none.alias("prev")).unionByName(pairs.select(F.col("next").alias("id"), none.alias("next"), F.col("id").alias("prev"))).groupBy("id").agg(F.max("next").alias("next_sibling"), F.max("prev").alias("prev_sibling"))
    kids = groups.groupBy("parent").agg(F.min(F.struct("salt", "first"))["first"].alias("first_child"), F.max(F.struct("salt", "last"))["last"].alias("last_child"), F.sum("n").alias("n_children"))
    kids = common.stage(kids, "kids")
    met = nodes.select("id", "parent").join(kids.withColumnRenamed("parent", "id"), "id", "left").join(beside, "id", "left")
    enter, leave = lambda c: F.col(c) * 2, lambda c: F.col(c) * 2 + 1
    end = F.lit(_END).cast("long")
    arcs = F.array(
        F.struct(enter("id").alias("item"), F.coalesce(leave("prev_sibling"), enter("parent"), end).alias("prev"), F.coalesce(enter("first_child"), leave("id")).alias("next")),
        F.struct(leave("id").alias("item"), F.coalesce(leave("last_child"), enter("id")).alias("prev"), F.coalesce(enter("next_sibling"), leave("parent"), end).alias("next")),
    )
    return kids.select("parent", "n_children"), met.select(F.explode(arcs).alias("a")).select("a.*")


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each node of the trie of all sequences: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.

    turns: conv_id, pos, sha, bytes, as positions() gives them, pos from 1 on without gaps. members: conv_id, length of
    every conversation, once each; those of length 0 are members of the root alone. saved_tokens: what a subtree spares if
    each node's last turn is kept once, in bytes. No members, no nodes.
    """
    rows = common.stage(prefixes(turns), "prefixes")
    grouped = rows.groupBy(F.col("pos").alias("depth"), "k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("bytes"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    named = common.stage(grouped.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    above = named.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = common.stage(named.join(above, ["depth", "p1", "p2"], "left").select("id", "depth", "k1", "k2", "conv_id", "n_convs", "bytes", "parent", "parent_conv_id"), "nodes")
    n = nodes.count()
    kids, arcs = _tour(nodes, n)
    places = list_ranks(arcs)
    # What an arc carries: a node counts where it is entered.
    carried = nodes.join(kids.withColumnRenamed("parent", "id"), "id", "left").select("id", F.coalesce("n_children", zero).alias("n_children"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    tour = places.select("place", F.shiftright("item", 1).alias("id"), (F.col("item") % 2).alias("out"))
    weights = tour.join(carried, "id").select("place", "id", "out", "n_children", F.when((F.col("out") == 0) & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaf"), F.when(F.col("out") == 0, F.col("saved")).otherwise(zero).alias("saved"))
    summed = running_sums(common.stage(weights, "tour"), "place", ["leaf", "saved"], 2 * n)
    whole = lambda c: F.sum(F.when(F.col("out") == 1, F.col(f"sum_{c}")).otherwise(F.col(c) - F.col(f"sum_{c}")))
    subtree = summed.groupBy("id").agg(F.max("n_children").alias("n_children"), whole("leaf").alias("n_leaves"), whole("saved").alias("saved_tokens"))
    last = rows.join(members.where("length > 0"), "conv_id").where("pos = length").select(F.col("pos").alias("depth"), "k1", "k2", "conv_id")
    turnless = members.where("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id")
    ends = joined_digests(common.stage(last.unionByName(turnless), "ends"), ["depth", "k1", "k2"], "conv_id")
    out = nodes.join(subtree, "id").join(ends, ["depth", "k1", "k2"], "left")
    empty = F.lit(hashlib.sha256().hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("digest", empty).alias("ends_sha256"))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each begun like the first of its family."""
    return trie(*branched(common.stage(positions(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "placed")))


OP12_SQL = f"""
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
c as (select conv_id, count(*) as n, conv_id - conv_id % 5 as base, xor(list_reduce(list_concat([cast(4294967295 as bigint)], flatten([[ord(x), -1, -1, -1, -1, -1, -1, -1, -1] for x in regexp_extract_all(cast(conv_id as varchar), '.')])),
  lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, (a & 1) * 3988292384) end), 4294967295) % 9 as crc from t group by conv_id),
m as (select c.conv_id, c.base, c.n, case when c.conv_id = c.base then 0 else c.crc end as h, case when c.conv_id = c.base then 0 else least(c.crc, coalesce(b.n, 0)) end as taken from c left join c b on b.conv_id = c.base),
r as (select m.conv_id, t.pos as p, role, text from m join t on t.conv_id = m.base where t.pos <= m.taken
  union all select m.conv_id, taken + t.pos - h, role, text from m join t on t.conv_id = m.conv_id where t.pos > h),
k as (select conv_id, p, octet_length(encode(text)) as bytes, list(concat(length(role), ':', length(text), ':', role, text)) over (partition by conv_id order by p rows between unbounded preceding and current row) as path from r),
nodes as (select p as depth, path, min(conv_id) as conv_id, count(*) as n_convs, min(bytes) as bytes from k group by p, path
  union all select 0, cast([] as varchar[]), min(conv_id), count(*), 0 from m having count(*) > 0),
kids as (select depth - 1 as depth, path[:depth - 1] as path, count(*) as n from nodes where depth > 0 group by all),
w as (select nodes.*, coalesce(kids.n, 0) as n_children, case when kids.n is null then 1 else 0 end as leaf, (n_convs - 1) * bytes as saved from nodes left join kids on kids.depth = nodes.depth and kids.path = nodes.path),
a as (select k.p as depth, k.path, w.leaf, w.saved from w join k on k.conv_id = w.conv_id and k.p <= w.depth union all select 0, cast([] as varchar[]), leaf, saved from w),
s as (select depth, path, sum(leaf) as n_leaves, sum(saved) as saved_tokens from a group by depth, path),
e as (select depth, path, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as digest from
  (select m.conv_id, coalesce(x.p, 0) as depth, coalesce(x.path, cast([] as varchar[])) as path from m left join k x on x.conv_id = m.conv_id and x.p = m.taken + greatest(m.n - m.h, 0)) as y group by depth, path)
select w.conv_id, cast(w.depth as bigint) as depth, up.conv_id as parent_conv_id, cast(w.n_convs as bigint) as n_convs, cast(w.n_children as bigint) as n_children, cast(s.n_leaves as bigint) as n_leaves,
  cast(s.saved_tokens as bigint) as saved_tokens, coalesce(e.digest, '{hashlib.sha256().hexdigest()}') as ends_sha256
from w join s on s.depth = w.depth and s.path = w.path left join nodes up on up.depth = w.depth - 1 and up.path = w.path[:w.depth - 1] left join e on e.depth = w.depth and e.path = w.path"""
