import hashlib
import random
import zlib
from collections import defaultdict

import pytest

pytest.importorskip("fieldmosaic.llm.trie")
from fieldmosaic.llm import trie


def plain(rows):
    """The contract in plain loops, over rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = v if base == c else own.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    out = {}
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = lambda n: [x for x in members if len(x) == len(n) + 1 and x[:-1] == n]
        ends = sorted(c for c in own if len(made[c]) == len(node))
        out[len(node), min(own), len(own), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(), node] = (min(members[node[:-1]]) if node else None, len(kids(node)), sum(not kids(n) for n in below), sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n))
    return sorted((c, d, *v[:1], n, *v[1:], e) for (d, c, n, e, _), v in out.items())


def drawn(seed):
    rng = random.Random(seed)
    texts = [None, "", "a", "é", "bb", "user"]
    rows = [(c, rng.choice([None, 0, 1, 2, 5]), rng.choice([None, "", "user", "a"]), rng.choice(texts)) for c in [*range(0, 24), -7, -5, 31, 33, 60] for _ in range(rng.choice([1, 1, 2, 3, 9]))]
    rows += [(c, t, "user", "same") for c in range(40, 60) for t in range(6)] + [(None, 1, "user", "x")] * 3
    return rows + rows[:5]


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "conv_id long, turn long, role string, text string, pos int, sha string")
    got = trie.trie(*trie.branched(trie.positions(df))).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0], r[1], r[2] is not None, r[2:]))


@pytest.mark.parametrize("small", [False, True])
def test_against_plain(spark, monkeypatch, small):
    """small: every block, group and piece is cut, so that all shifts and links between them are used."""
    if small:
        for name, value in {"BLOCK": 3, "SIBLINGS": 4, "WALK": 5, "PIECE": 2}.items():
            monkeypatch.setattr(trie, name, value)
    rows = drawn(1)
    want = sorted(plain(rows), key=lambda r: (r[0], r[1], r[2] is not None, r[2:]))
    assert run(spark, rows) == want


def test_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "WALK", 50)
    n = 2_000
    turns = [(4, k, "user", f"t{k}") for k in range(n)] + [(1_000, k, "user", f"t{k}") for k in range(n - 1)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    placed = trie.positions(df)
    members = placed.groupBy("conv_id").count().withColumnRenamed("count", "length")
    got = {r.depth: r for r in trie.trie(placed, members).collect()}
    assert len(got) == n + 1 and got[n].n_convs == 1 and got[0].n_leaves == 1
    assert got[n - 1].saved_tokens == len(f"t{n - 2}") and got[0].saved_tokens == sum(len(f"t{k}") for k in range(n - 1))


def test_list_ranks(spark):
    order = list(range(700))
    random.Random(2).shuffle(order)
    links = [(x, order[k - 1] if k else -1, order[k + 1] if k + 1 < len(order) else -1) for k, x in enumerate(order)]
    df = spark.createDataFrame(sorted(links), "item long, prev long, next long")
    got = trie.list_ranks(df, walk=100).collect()
    assert sorted((r.place, r.item) for r in got) == list(enumerate(order))


def test_empty(spark):
    assert run(spark, [(None, 0, "a", "b")]) == []
    (root,) = trie.trie(spark.createDataFrame([], "conv_id long, pos long, sha binary, bytes long"), spark.createDataFrame([(3, 0)], "conv_id long, length long")).collect()
    assert tuple(root) == (3, 0, None, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())
