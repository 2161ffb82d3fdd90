import random

import numpy as np
import pytest

pytest.importorskip("fieldmosaic.llm.repeats")
from fieldmosaic.llm import repeats


def brute(rows):
    """Spans of each row by going through all strings in order."""
    order = sorted(set((d if d is not None else 2**63 - 1, t or "") for d, t in rows))
    assert len({d for d, _ in order}) == len(order)
    seen, out = set(), {}
    for d, t in order:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            s = raw[p : p + 100]
            if s in seen:
                gone[p : p + 100] = True
            seen.add(s)
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[d] = (len(raw), list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())), raw[:0] + bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return [(d, *out[d if d is not None else 2**63 - 1]) for d, _ in rows]


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    passages = ["".join(word() for _ in range(rng.choice([15, 20, 22, 25, 40, 80]))) for _ in range(12)]
    texts = []
    for _ in range(120):
        t = ""
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            cut = rng.randrange(0, 20) if rng.random() < 0.5 else 0
            t += rng.choice(["", word(), word() * 3]) + p[cut:]
        if rng.random() < 0.2:
            k = rng.randrange(len(t))
            t = t[:k] + "Z" + t[k + 1 :]
        texts.append(t)
    texts += ["a" * 5000, "ab" * 400, "", None, "x" * 99, "y" * 100, "y" * 100, texts[0], texts[1] + "q", " " * 300]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    return rows + [rows[3], rows[3], (None, texts[5])]


@pytest.mark.parametrize("few,chunk", [(16, 6_000_000), (1, 3_000), (16, 3_000)])
def test_against_brute_force(spark, monkeypatch, few, chunk):
    """few = 1, and every document looked at: most seeds that occur twice are split into their strings."""
    monkeypatch.setattr(repeats, "FEW", few)
    monkeypatch.setattr(repeats, "LOOK", 1 if few == 1 else 16)
    monkeypatch.setattr(repeats, "FINE", 8 if few > 1 else 1 << 20)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    rows = corpus(few + chunk)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, part int").repartition(3)
    got = [(r.doc_id, r.n_bytes, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in repeats.without_repeats(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.without_repeats(df).count() == 0
    short = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, bytes(r.kept), len(r.spans)) for r in repeats.without_repeats(short).collect()) == [(1, b"a", 0), (2, b"", 0)]


def test_sorted_ranks():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (300, 20)).astype(np.uint8)
    order, common = repeats.ranks(x)
    rows = [bytes(r) for r in x[order]]
    assert rows == sorted(rows)
    for i in range(1, 300):
        k = int(common[i])
        assert rows[i][:k] == rows[i - 1][:k] and (k == 20 or rows[i][k] != rows[i - 1][k])


def test_results_of_a_task_are_few_rows():
    """One block for each document's part, not one for each part and bucket."""
    import numpy as np
    import pyarrow as pa

    from fieldmosaic.llm import repeats

    parts, rng = 40, np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    passages = [word(400) for _ in range(20)]
    texts = [word(50) + passages[k % 20] + word(50) for k in range(200)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(200)), "key": list(range(200)), "text": texts})
    mapped = pa.Table.from_batches(repeats._cover(parts, np.zeros(0, np.uint64))(iter([batch]))).sort_by("part")
    rows = sum(b.num_rows for b in repeats._first_spans(parts)(iter(mapped.to_batches())))
    assert 0 < rows <= 2 * parts
