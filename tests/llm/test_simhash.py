import random

import numpy as np
import pytest
import xxhash

pytest.importorskip("fieldmosaic.llm.simhash")
from fieldmosaic.llm import simhash


def plain(text):
    w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if x]
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    texts = ["", " \n", "One", "one two", "É One\x0btwo x  three\tfour", "a b c " * 50, "a b c d e f g"]
    assert simhash.fingerprints(texts).tolist() == [plain(t) for t in texts]


def test_keys_meet_within_three_bits():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    x = rng.integers(0, 2**63, 400)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, 4), replace=False):
            y[i] ^= np.int64(np.uint64(1 << int(b)).view(np.int64))
    keys = []
    for z in (x, y):
        of = {}
        for batch in simhash._fuzzy_keys(iter([pa.RecordBatch.from_arrays([pa.array(z)], ["fp"])])):
            for k, f in zip(batch.column("key").to_pylist(), batch.column("fp").to_pylist()):
                of.setdefault(f, set()).add(k)
        keys.append(of)
    assert all(keys[0][a] & keys[1][b] for a, b in zip(x.tolist(), y.tolist()))


def test_components_against_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    texts = ["", None, "  ", "one"]
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, texts[3])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    fp = [plain(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), 10**9), rows[i][0])
    want = sorted((rows[i][0], fp[i], least[find(i)]) for i in range(len(rows)))
    got = sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_groups(df).collect())
    assert got == want
    assert simhash.near_groups(df.limit(0)).count() == 0


def test_long_chains(spark):
    from fieldmosaic.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901)], "a long, b long")
    assert {(r.node, r.label) for r in components(links).collect()} == {(i, 0) for i in range(201)} | {(900, 900), (901, 900)}
