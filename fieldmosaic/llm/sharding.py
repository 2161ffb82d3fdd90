"""Shards by a weighted hash tree of regions, racks and shards (operator 13).

A row descends from the root: at each node the children draw for the row, each by a hash of its id and the child's name, and
the largest draw wins, in proportion to the children's weights. A child's draw depends on nothing but itself, so when
weights change, rows move only into children that became heavier and out of those that became lighter: all movement is
inside the subtrees whose weights changed, and from their siblings in proportion.

Only DataFrame functions are used; the tree is a few literals in the plan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ranges
from . import common

#: Regions, racks a region and shards a rack of the tree that the query starts from.
REGIONS, RACKS, SHARDS = 2, 4, 5
#: Bits of a draw; a double holds them exactly.
_BITS = 52
_HEX = _BITS // 4


@dataclass(frozen=True)
class Node:
    """A leaf has a shard; the weight of an inner node is what its leaves weigh."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own


def balanced(regions: int = REGIONS, racks: int = RACKS, shards: int = SHARDS) -> Node:
    """A tree of regions * racks * shards leaves of weight 1, numbered from the left."""
    leaf = iter(range(regions * racks * shards))
    return Node("", tuple(Node(f"{r}", tuple(Node(f"{r}.{k}", tuple(Node(f"{r}.{k}.{s}", shard=next(leaf)) for s in range(shards))) for k in range(racks))) for r in range(regions)))


def leaves(tree: Node) -> list[Node]:
    return [x for c in tree.children for x in leaves(c)] if tree.children else [tree]


def grown(tree: Node, by: int = 1, weight: float = 1.0) -> Node:
    """The tree with so many more shards, each in a region and a rack of its own.

    No weight below an old region changes then, so rows move into the new shards and nowhere else. Shards added to an old
    rack would make its region heavier, and some of what moves there would fall to its other shards.
    """
    n, r = len(leaves(tree)), len(tree.children)
    new = tuple(Node(f"{r + k}", (Node(f"{r + k}.0", (Node(f"{r + k}.0.0", shard=n + k, own=weight),)),)) for k in range(by))
    return Node(tree.name, (*tree.children, *new))


def _draw(id_text: Column, node: Node) -> Column:
    """The larger, the likelier the node wins: ln(u) / weight, u in (0, 1) from the row's id and the node's name."""
    digits = F.substring(F.md5(F.concat(id_text, F.lit(f"|{node.name}")).cast("binary")), 1, _HEX)
    u = (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << _BITS))
    return F.ln(u) / F.lit(float(node.weight))


def _winner(id_text: Column, node: Node) -> Column:
    """Which of the node's children wins, from 0 on; of equal draws the first. Children of weight 0 don't take part."""
    live = [(k, c) for k, c in enumerate(node.children) if c.weight > 0]
    if len(live) == 1:
        return F.lit(live[0][0])
    return -F.greatest(*[F.struct(_draw(id_text, c).alias("draw"), F.lit(-k).alias("child")) for k, c in live])["child"]


def with_shard(df: DataFrame, tree: Node, doc_id: str = "doc_id", name: str = "shard") -> DataFrame:
    """df with the shard of each row, which its id and the tree alone decide.

    Rows of one id, and rows without an id (whose text is empty), share a shard. Nodes of weight 0 get nothing; ValueError if all are 0.
    """
    if tree.weight <= 0 or any(x.own < 0 or not math.isfinite(x.own) for x in leaves(tree)):
        raise ValueError("weights must be 0 or more, and some more")
    id_text = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    level, at, steps = [tree], F.lit(0), 0
    # A column for each level: where a row is among the level's nodes. Only children of that node draw.
    while any(n.children for n in level):
        below, choice = [], F.lit(None)
        for k, node in enumerate(level):
            place = F.lit(len(below)) + _winner(id_text, node) if node.children and node.weight > 0 else F.lit(len(below))
            choice = F.when(at == k, place) if k == 0 else choice.when(at == k, place)
            below += node.children or (node,)
        df = df.withColumn(f"__level{steps}", choice)
        level, at, steps = below, F.col(f"__level{steps}"), steps + 1
    found = F.element_at(F.array(*[F.lit(n.shard) for n in level]), at + 1)
    return df.withColumn(name, found.cast("int")).drop(*[f"__level{k}" for k in range(steps)])


def with_slot(df: DataFrame, keys: list[str], order: str, ties: list[str]) -> DataFrame:
    """df with slot: the row's place from 0 on among those of its key, in the order of a numeric column, then of ties.

    A shard isn't one task: its rows are ranked range by range, and ranges are shifted by the counts of those before.
    """
    return ranges.running(df, keys, order, {"slot": F.lit(1)}, ties=ties).withColumn("slot", (F.col("slot") - 1).cast("long"))


def sharded(docs: DataFrame, tree: Node, bigger: Node | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (by the bigger tree; null without one) and slot of every document.

    size: UTF-8 bytes of the text and 16 more; a null text is an empty one. Slots go by id (null first), then checksum,
    then size; equal rows get neighbouring ones. An empty table gives no rows; other columns are ignored.
    """
    rows = common.pick(docs, doc_id=doc_id, text=text)
    slim = rows.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    found = with_shard(slim, tree)
    found = with_shard(found, bigger, name="grown_shard") if bigger else found.withColumn("grown_shard", F.lit(None).cast("int"))
    return with_slot(common.stage(found, "shards"), ["shard"], "doc_id", ["text_crc32", "size"])


def op13_hash_tree(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by their ids, and where one more shard would put them."""
    tree = balanced()
    found = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"), tree, grown(tree))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _sql_level(name: str, source: str, parent: str, tree: list[Node]) -> str:
    """A step of the descent as SQL: rows of source, with the winner among the children of the node named in `parent`."""
    values = ", ".join(f"('{n.name}', '{c.name}', {k}, {float(c.weight)})" for n in tree for k, c in enumerate(n.children))
    u = f"(cast(cast(concat('0x', substr(md5(concat(id, '|', child)), 1, {_HEX})) as bigint) as double) + 0.5) / cast({1 << _BITS} as double)"
    return f"""{name} as (select id, child as {name}_node from (select id, child, row_number() over (partition by id order by ln({u}) / cast(w as double) desc, k) as rk
  from {source}, (values {values}) as t(parent, child, k, w) where t.parent = {parent}) as x where rk = 1)"""


def _sql(tree: Node, bigger: Node) -> str:
    steps = []
    for p, t in (("a", tree), ("b", bigger)):
        racks = [k for r in t.children for k in r.children]
        steps += [_sql_level(f"{p}1", "ids", "''", [t]), _sql_level(f"{p}2", f"{p}1", f"{p}1_node", list(t.children)), _sql_level(f"{p}3", f"{p}2", f"{p}2_node", racks)]
        steps.append(f"{p} as (select id, shard from {p}3 join (values {', '.join(f"('{x.name}', {x.shard})" for x in leaves(t))}) as t(node, shard) on node = {p}3_node)")
    return f"""with bits as (select list(c order by i) as crc from (select i, list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1], lambda a, x: xor(a >> 1, (a & 1) * 3988292384)) as c from range(256) as r(i)) as x),
d as (select doc_id, coalesce(cast(doc_id as varchar), '') as id, octet_length(encode(coalesce(text, ''))) + 16 as size,
  xor(list_reduce(list_concat([cast(4294967295 as bigint)], [cast(concat('0x', h) as bigint) for h in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]), lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1])), 4294967295) as text_crc32 from documents, bits),
ids as (select distinct id from d), {", ".join(steps)}
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'key' as law, cast(a.shard as int) as shard,
  cast(row_number() over (partition by a.shard order by doc_id nulls first, text_crc32, size) - 1 as bigint) as slot, cast(b.shard as int) as grown_shard
from d join a on d.id = a.id join b on d.id = b.id"""


OP13_SQL = _sql(balanced(), grown(balanced()))
