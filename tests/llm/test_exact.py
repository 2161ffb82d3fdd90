import hashlib
import random

import pytest

pytest.importorskip("fieldmosaic.llm.exact")
from fieldmosaic.llm import exact


def test_index_against_a_set():
    rng, index, live = random.Random(1), exact.CuckooIndex(2), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(800)]
    for step in range(6000):
        k = rng.choice(keys)
        if k in live and rng.random() < 0.5:
            assert index.delete(k)
            del live[k]
        elif k not in live:
            assert index.find(k) is None and not index.delete(k)
            index.insert(k, step)
            live[k] = step
        assert index.size == len(live)
    assert {k: v for k, v in index.entries()} == live
    assert all(index.find(k)[1] == v for k, v in live.items())


def test_same_marks_overflow_and_grow():
    index = exact.CuckooIndex(1)
    keys = [i.to_bytes(8, "little") + (7).to_bytes(2, "little") + b"x" * 22 for i in range(100)]
    for k in keys:
        index.insert(k, 0)
    assert index.size == 100 and all(index.find(k) for k in keys)


def _want(rows):
    by = {}
    for n, (i, t) in enumerate(rows):
        by.setdefault(t or "", []).append(i)
    return by


def test_groups(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["", None, "a", "b", "c" * 5000, f"t{i}"])) for i in range(300)] + [(5, "a"), (5, "a"), (None, "a"), (None, "only"), (None, "only")]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, digest string, row int").repartition(7)
    got = exact.exact_groups(df).collect()
    by = _want(rows)
    assert len(got) == len(rows)
    sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in by.items()}
    kept = {}
    for r in got:
        ids = sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        if r.kept:
            assert r.doc_id == r.keep_id and r.text_sha256 not in kept
            kept[r.text_sha256] = 1
    assert kept.keys() == sha.keys()
    left = exact.deduplicated(df).collect()
    assert len(left) == len(sha) and {(r.doc_id, r.text or "") for r in left} == {(max((i for i in v if i is not None), default=None), t) for t, v in by.items()}
    assert exact.exact_groups(df.limit(0)).count() == 0


def test_update(spark):
    d = [hashlib.sha256(str(i).encode()).digest() for i in range(6)]
    f = lambda *x: spark.createDataFrame([(d[i],) for i in x], "digest binary")
    got = exact.update_index(f(0, 1, 2), f(3, 3, 1), f(0, 3, 5)).collect()
    assert {(bytes(r.digest), r.n) for r in got} == {(d[1], 2), (d[2], 1), (d[3], 1)}
