import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

pytest.importorskip("fieldmosaic.llm.sharding")
from fieldmosaic.llm import sharding
from fieldmosaic.llm.sharding import Node, balanced, grown, leaves


def plain(tree, doc_id):
    """Walk down the tree, one draw after another."""
    node = tree
    while node.children:
        best = None
        for c in node.children:
            if c.weight > 0:
                digits = hashlib.md5(f"{'' if doc_id is None else doc_id}|{c.name}".encode()).hexdigest()[:13]
                draw = math.log((int(digits, 16) + 0.5) / 2**52) / c.weight
                if best is None or draw > best[0]:
                    best = draw, c
        node = best[1]
    return node.shard


def test_against_plain(spark):
    rng = random.Random(5)
    ids = [None, None, -3, 2**62, *range(300), 7, 7, 7]
    texts = [None, "", "é" * 5, "x" * 100_000, "same"]
    rows = [(i, rng.choice(texts), 1, "s", 2) for i in ids] + [(7, "same", 1, "s", 2)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, size string, slot int")
    tree = balanced()
    got = sharding.sharded(df, tree, grown(tree)).collect()
    assert len(got) == len(rows)
    raw = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == raw
    slots = defaultdict(list)
    for r in got:
        assert r.shard == plain(tree, r.doc_id) and r.grown_shard == plain(grown(tree), r.doc_id)
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size))
    for own in slots.values():
        own.sort()
        assert [x[0] for x in own] == list(range(len(own))) and own == sorted(own, key=lambda x: x[1:])


def test_growth_takes_only_into_the_new_shard(spark):
    tree = balanced()
    df = sharding.with_shard(sharding.with_shard(spark.range(20_000), tree, "id"), grown(tree, 2), "id", "more")
    got = df.collect()
    moved = [r for r in got if r.shard != r.more]
    assert {r.more for r in moved} == {40, 41} and 0.5 < len(moved) / (20_000 * 2 / 42) < 1.5
    counts = Counter(r.shard for r in got)
    assert len(counts) == 40 and max(counts.values()) < 1.3 * 20_000 / 40


def test_movement_stays_where_weights_change(spark):
    def weighted(w, gone=()):
        shards = [[[(r, k, s) for s in range(3)] for k in range(2)] for r in range(2)]
        return Node("", tuple(Node(f"{r}", tuple(Node(f"{r}.{k}", tuple(Node(f"{r}.{k}.{s}", shard=6 * r + 3 * k + s, own=w.get(6 * r + 3 * k + s, 0.0 if 6 * r + 3 * k + s in gone else 1.0)) for _, _, s in rack)) for k, rack in enumerate(region))) for r, region in enumerate(shards)))

    was, now = weighted({}), weighted({4: 3.0})
    df = sharding.with_shard(sharding.with_shard(spark.range(20_000), was, "id"), now, "id", "then").collect()
    for r in df:
        if r.shard != r.then:
            old, new = (r.shard // 6, r.shard // 3, r.shard), (r.then // 6, r.then // 3, r.then)
            # The first level at which it differs is left for the heavier child, which leads to shard 4.
            k = next(k for k in range(3) if old[k] != new[k])
            assert new[k] == (0, 1, 4)[k]
    share = Counter(r.then for r in df)
    assert abs(share[4] / 20_000 - 3 / 14) < 0.02
    without = sharding.with_shard(spark.range(2_000), weighted({}, gone=(3, 4, 5)), "id").collect()
    assert {r.shard for r in without} == {0, 1, 2, *range(6, 12)}
    with pytest.raises(ValueError):
        sharding.with_shard(spark.range(1), weighted({}, gone=range(12)), "id")


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.sharded(df, balanced(), grown(balanced())).collect() == []
    assert len(leaves(grown(balanced(), 3))) == 43
