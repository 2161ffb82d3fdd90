import itertools
import random

import numpy as np
import pytest

pytest.importorskip("fieldmosaic.llm.audit")
from fieldmosaic.llm import audit


def test_intervals_cover_each_rank_once():
    for n in (1, 3, 5):
        orders = list(itertools.permutations(range(n)))
        for mask in range(1, 1 << n):
            counts = np.zeros(1 << n, np.int64)
            counts[mask] = 1
            got = audit.removed_by_rank(counts, n)
            for rank, order in enumerate(orders):
                step = next(k for k, f in enumerate(order) if mask >> f & 1)
                assert got[:, rank].tolist() == [int(k == step) for k in range(n)]


def plain(docs, labels):
    """The contract, document by document and order by order."""
    import re

    texts = {}
    for i, t, *_ in docs:
        if i is not None:
            texts[t or ""] = min(i, texts.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {d[2] or "" for d in docs}:
        own = [(i, t or "") for i, t, s in docs if (s or "") == part]
        fails = []
        for i, t in own:
            words = re.findall(r"[^\x20\x09-\x0D]+", t)
            fails.append({f for f, x in zip("ABCDE", (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search("[#$%&*|]", t), i is not None and i > texts[t])) if x})
        share = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = list(range(len(own)))
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                share[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in x for x in fails) - len(gone), sum(x == {f} for x in fails), sum(own[k][0] in good for k in gone), sum(own[k][0] in toxic for k in gone), f]
    # The sums over all orders are known once all orders of a part were walked through.
    sums = {}
    for (part, _, _), v in out.items():
        sums[part, v[-1]] = sums.get((part, v[-1]), 0) + v[1]
    return {k: (*v[:-1], sums[k[0], v[-1]]) for k, v in out.items()}


def test_against_plain(spark):
    rng = random.Random(3)
    words = ["a", "B", "ccc", "DDD", "e$", "f|", "gé", "HH", "ÄÖ", "x"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 3, 49, 50, 60, 200]))) for _ in range(25)]
    texts += [" ".join(f"w{k}" for k in range(n)) + tail for n in (49, 50, 70) for tail in ("", " \t\x0b", "\xa0z", " %")]
    docs = [(rng.choice([None, *range(60)]), rng.choice([None, "", *texts]), rng.choice([None, "", "s1", "s2"])) for _ in range(150)]
    docs += docs[:9]
    labels = [(rng.choice([None, *range(70)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    # Columns of other names, and of the operator's own names, are let be.
    d = spark.createDataFrame([(*r, 7, "q") for r in docs], "doc_id long, text string, source string, mask int, part string")
    lab = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, id int")
    counts = audit.failed(d, lab)
    got = audit.interactions(counts.selectExpr("part", "mask", "1 as n", "good", "toxic")).collect()
    want = plain(docs, labels)
    assert len(got) == len(want)
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == want


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string, source string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.failed(d, lab).selectExpr("part", "mask", "1 as n", "good", "toxic")).collect() == []
    with pytest.raises(ValueError):
        audit.interactions(d, "ABCDEFGH")
