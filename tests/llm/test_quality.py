import math
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("fieldmosaic.llm.quality")
from fieldmosaic.llm import quality


def test_statistics():
    x = quality.statistics(["", "AB cd cd\ncd1, é!", "a" * 100_000])
    assert x.shape == (3, len(quality.NAMES)) and np.isfinite(x).all()
    at = dict(zip(quality.NAMES, x[1]))
    assert at["upper"] == 2 / 17 and at["mark"] == 1 / 17 and at["beyond_ascii"] == 2 / 17 and at["repeated_words"] == 1 / 5 and at["upper_words"] == 1 / 5


def by_hand(t):
    """All statistics of one text, one after another."""
    raw, words, lines = t.encode(), t.split(), [s for s in t.split("\n") if s]
    kinds = {b: k for k, chars in quality._CLASSES.items() for b in chars.encode()}
    shares = Counter("beyond_ascii" if b > 127 else kinds.get(b, "control") for b in raw)
    out = {k: shares[k] / max(len(raw), 1) for k in [*quality._CLASSES, "control", "beyond_ascii"]}
    n, m = max(len(words), 1), max(len(lines), 1)
    out |= {"log_bytes": math.log(1 + len(raw)), "log_words": math.log(1 + len(words)), "word_length": sum(len(w) for w in words) / n}
    out |= {"longest_word": max([len(w) for w in words] or [0]), "distinct_words": len(set(words)) / n, "top_word": max([words.count(w) for w in words] or [0]) / n}
    out |= {"repeated_words": sum(words[k] == words[k - 1] for k in range(1, len(words))) / n, "short_words": sum(len(w) <= 2 for w in words) / n}
    out |= {"upper_words": sum(w.isupper() for w in words) / n, "plain_words": sum(w.isalpha() for w in words) / n}
    out |= {"log_lines": math.log(1 + len(lines)), "line_length": len(t) / m, "repeated_lines": 1 - len(set(lines)) / m, "top_line": max([lines.count(x) for x in lines] or [0]) / m}
    counts = Counter(raw)
    return out | {"entropy": -sum(c / len(raw) * math.log2(c / len(raw)) for c in counts.values())}


def test_all_statistics_by_hand():
    texts = ["", "AB cd cd\ncd1, é!", "x\n\nx\ny | # $5 50% <a href='b'>(c)</a> \"q\"; w@z.de\t\x01\r\n", "THE THE 12 a_b ﬁ 日本 " * 7, " \n "]
    for row, t in zip(quality.statistics(texts), texts):
        want = by_hand(t)
        assert sorted(want) == sorted(quality.NAMES)
        for name, v in zip(quality.NAMES, row):
            assert math.isclose(v, want[name], rel_tol=1e-9, abs_tol=1e-12), (t, name)


def test_fit_is_a_plain_boosting_loop(monkeypatch):
    for name, v in (("BINS", 8), ("DEPTH", 3), ("TREES", 6)):
        monkeypatch.setattr(quality, name, v)
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(90, 4)), 1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > -0.3)).astype(float)
    trees = quality.fit(x, y)
    binned = trees.bins(x)
    margin = [trees.start] * 90
    assert math.isclose(trees.start, math.log(y.mean() / (1 - y.mean())))
    for feature, border, leaf in zip(trees.feature, trees.border, trees.leaf):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p]
        rows_of = {0: list(range(90))}
        for node in range(7):
            rows, best = rows_of[node], (1e-6, None, None)
            part = lambda at: (sum(g[r] for r in at), sum(h[r] for r in at))
            for f in range(4):
                for b in range(8):
                    (lg, lh), (rg, rh) = part([r for r in rows if binned[r, f] <= b]), part([r for r in rows if binned[r, f] > b])
                    if lh > 1 and rh > 1:
                        gain = lg**2 / (lh + 1) + rg**2 / (rh + 1) - (lg + rg) ** 2 / (lh + rh + 1)
                        if gain > best[0] + 1e-9:
                            best = (gain, f, b)
            assert (feature[node], border[node]) == ((0, 8) if best[1] is None else best[1:])
            rows_of[2 * node + 1] = [r for r in rows if binned[r, feature[node]] <= border[node]]
            rows_of[2 * node + 2] = [r for r in rows if binned[r, feature[node]] > border[node]]
        for k in range(8):
            at = rows_of[7 + k]
            want = -quality.RATE * sum(g[r] for r in at) / (sum(h[r] for r in at) + 1)
            assert math.isclose(leaf[k], want, abs_tol=1e-9)
            for r in at:
                margin[r] += want


def test_traversal_is_that_of_the_tree():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, len(quality.NAMES)))
    y = ((x[:, 3] > 0) ^ (x[:, 5] > 0.5)).astype(float)
    trees = quality.fit(x, y)
    got, binned = trees.scores(x[:50]), trees.bins(x[:50])
    for r in range(50):
        total = trees.start
        for f, b, leaf in zip(trees.feature, trees.border, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if binned[r, f[node]] > b[node] else 1)
            total += leaf[node - len(f)]
        assert np.isclose(got[r], 1 / (1 + np.exp(-total)))
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.95


def test_frames(spark):
    docs = spark.createDataFrame([(i, ("good text here. " if i % 2 else "BAD!! ### ") * 5, "s") for i in range(200)] + [(None, None, "s"), (3, "", "s")], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1, None), (None, 1)], "doc_id long, quality int")
    trees = quality.train(docs, labels)
    got = quality.predict(docs, trees).collect()
    assert len(got) == 202 and all(0 <= r.score <= 1 for r in got)
    assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in got[:200] if r.doc_id not in (None, 3))
    assert quality.predict(docs.limit(0), trees).count() == 0
    assert {r.score for r in quality.predict(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.op10_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("score", "quality").toPandas()
    rank = got["score"].rank().to_numpy()
    one = got["quality"].to_numpy() == 1
    auc = (rank[one].sum() - one.sum() * (one.sum() + 1) / 2) / (one.sum() * (~one).sum())
    print("auc", auc, "accuracy", ((got["score"] >= 0.3) == one).mean())
    assert auc > 0.8
