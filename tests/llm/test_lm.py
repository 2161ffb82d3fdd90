import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("fieldmosaic.llm.lm")
from fieldmosaic.llm import lm


def tokens(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w] + [None]


class Plain:
    """The tree by dictionaries of words: counts of all sequences, states grown from the root, scores word by word."""

    def __init__(self, texts, least=lm.LEAST, context=lm.CONTEXT):
        self.n = Counter()
        for t in texts:
            s = ["<s>", *tokens(t)]
            for i in range(len(s)):
                for k in range(1, lm.DEPTH + 2):
                    if i - k + 1 >= 0:
                        self.n[tuple(s[i - k + 1 : i + 1])] += 1
        words = {g[0]: c for g, c in self.n.items() if len(g) == 1 and g[0] != "<s>"}
        self.total, self.distinct = sum(words.values()), len(words)
        self.next = {}
        for g, c in self.n.items():
            if len(g) > 1 and c >= least and self.n[g[:-1]] >= context:
                self.next.setdefault(g[:-1], {})[g[-1]] = c
        self.states = {()}
        for k in range(1, lm.DEPTH + 1):
            for s, after in self.next.items():
                if len(s) == k and s[1:] in self.states and 2 * self.gain(s, after) > lm.DIVERGENCE:
                    self.states.add(s)

    def gain(self, s, after):
        n, inside = max(self.n[s], sum(after.values())), sum(after.values())
        below = {w: self.p(w, s[1:]) for w in after}
        rest = 1 - inside / n
        more = n * rest * math.log(rest / max(1 - sum(below.values()), 1e-12)) if rest > 1e-12 else 0.0
        return sum(c * math.log(c / n / below[w]) for w, c in after.items()) + more

    def p(self, w, s):
        """Of a word after a state."""
        if not s:
            return (self.n[(w,)] + 0.1) / (self.total + 0.1 * (self.distinct + 1))
        after = self.next[s]
        inside = sum(after.values())
        n = max(self.n[s], inside)
        return (after.get(w, 0) + (n - inside + lm.SMOOTHING) * self.p(w, s[1:])) / (n + lm.SMOOTHING)

    def score(self, text):
        s, out = ["<s>", *tokens(text)], 0.0
        for i in range(1, len(s)):
            k = next(k for k in range(min(lm.DEPTH, i), -1, -1) if tuple(s[i - k : i]) in self.states)
            out += math.log10(self.p(s[i], tuple(s[i - k : i])))
        return out


@pytest.mark.parametrize("held", [lm.HELD_WORDS, 5])
def test_base_scores(spark, monkeypatch, held):
    monkeypatch.setattr(lm, "HELD_WORDS", held)
    rng = random.Random(3)
    vocabulary = [f"W{i}" for i in range(30)] + ["É", "é", "the", "The"]
    texts = [rng.choice([" ", "\n", "\t "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(40))) for _ in range(80)] + [None, "", "the " * 3000]
    rows = [(i, t, i % 4 == 0, "x") for i, t in enumerate(texts)] + [(1, texts[1], False, "x"), (None, "unseen words", True, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean, key string").repartition(3)
    got = lm.scored(df, df.where("not held")).collect()
    c = Counter(w for _, t, h, _ in rows if not h for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = [(i if i is not None else -1, len(tokens(t)), sum(w in c for w in tokens(t)), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t, _, _ in rows]
    have = [(r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got]
    for a, b in zip(sorted(have), sorted(want), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)
    assert all(r.score < 0 for r in got if r.n_tokens > 1)
    assert lm.scored(df.limit(0), df).count() == 0
    none = lm.scored(df, df.limit(0)).collect()
    assert len(none) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 and r.score == r.base_score for r in none)


def corpus():
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = ["m n o p", "k n p q r", "x n o q", "d e", "e d d"]
    texts = [" ".join(rng.choice([*passages, *vocabulary[:12], rng.choice(vocabulary)]) for _ in range(rng.randrange(50))) for _ in range(150)] + ["", None, "once only"]
    return list(enumerate(texts)) + [(3, texts[3])]


@pytest.mark.parametrize("held,combined,least,context", [(lm.HELD, lm._COMBINED, 2, 2), (40, 100, 2, 2), (0, 5000, 4, 8)])
def test_scores_are_those_of_a_plain_tree(spark, monkeypatch, held, combined, least, context):
    """Whatever is in memory, and however little is combined at once."""
    monkeypatch.setattr(lm, "HELD", held)
    monkeypatch.setattr(lm, "_COMBINED", combined)
    monkeypatch.setattr(lm, "_PART", 500)
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, gain double").repartition(3)
    plain = Plain([t for d, t in rows if d % 3], least, context)
    assert {len(s) for s in plain.states} == {0, 1, 2, 3}
    got = sorted((r.doc_id, r.score) for r in lm.scored(df, df.where("doc_id % 3 > 0"), keep=("doc_id", "gain"), least=least, context=context).collect())
    for (d, a), (e, b) in zip(got, sorted((d, plain.score(t)) for d, t in rows), strict=True):
        assert d == e and math.isclose(a, b, rel_tol=1e-9)


@pytest.mark.parametrize("rounds,counted", [(3, 60), (1, 10**6)])
def test_only_hot_contexts_are_listed(spark, monkeypatch, rounds, counted):
    """Sequences of other contexts are counted where their positions are dealt to, in any number of rounds, and not written."""
    listed, stage = [], lm.common.stage

    def kept(df, name):
        out = stage(df, name)
        if name == "listed":
            listed.append(out.select("context").distinct().count())
        return out

    monkeypatch.setattr(lm.common, "stage", kept)
    monkeypatch.setattr(lm, "ROUNDS", rounds)
    monkeypatch.setattr(lm, "_ROUND", 100)
    monkeypatch.setattr(lm, "_COUNTED", counted)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    plain = Plain([t for d, t in rows if d % 3])
    got = sorted((r.doc_id, r.score) for r in lm.scored(df, df.where("doc_id % 3 > 0"), learns="doc_id % 3 > 0").collect())
    for (d, a), (e, b) in zip(got, sorted((d, plain.score(t)) for d, t in rows), strict=True):
        assert d == e and math.isclose(a, b, rel_tol=1e-9)
    contexts = [len({g[:-1] for g in plain.n if len(g) == k}) for k in (2, 3, 4)]
    assert all(0 < n < of / 2 for n, of in zip(listed, contexts))


def test_states_are_written_once_for_each_context(spark, monkeypatch):
    """What is on disk beside each other: a row for each state, and what scores take of the words after it."""
    written, stage = [], lm.common.stage

    def kept(df, name):
        out = stage(df, name)
        written.append((name, out.columns, out.count(), out.select(out.columns[0]).distinct().count()))
        return out

    monkeypatch.setattr(lm.common, "stage", kept)
    df = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(2)
    lm.scored(df, df)
    assert [c for n, c, *_ in written if n == "after"] == [["key", "n", "seen", "v"]] * lm.DEPTH
    states = [(rows, contexts) for n, _, rows, contexts in written if n == "states"]
    assert len(states) == lm.DEPTH and all(rows == contexts > 0 for rows, contexts in states)


def test_a_swept_shuffle_is_gone(spark):
    """Files of the shuffle of a query that was just written."""
    done = lm.common.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    tracked = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    assert tracked.size() > 0
    lm.common.sweep(spark)
    time.sleep(2)
    assert tracked.size() == 0 and done.count() == 7


def test_predictions_sum_to_one():
    plain = Plain([t for _, t in corpus()])
    words = [g[0] for g in plain.n if len(g) == 1 and g[0] != "<s>"]
    unseen = plain.p("never", ())
    for s in plain.states:
        assert math.isclose(sum(plain.p(w, s) for w in words) + plain.p("never", s), 1, rel_tol=1e-9), (s, unseen)


@pytest.mark.parametrize("block", [7, 2_000_000])
def test_word_keys(monkeypatch, block):
    """Equal words, and only they, have equal keys, wherever they stand; texts may be empty, long or sliced."""
    monkeypatch.setattr(lm, "_BLOCK", block)
    rng = random.Random(2)
    texts = ["", "  ", "a A b", "b", "ab", "É é\x85É\u2003x", "\tab\x0bAB\n", "z" * 5000 + " q"] + ["".join(rng.choice("ab \nC") for _ in range(rng.randrange(60))) for _ in range(200)]
    key, starts = lm.word_keys(pa.array(["left out", *texts]).slice(1))
    name = {}
    for a, b, t in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], texts):
        want = [b"<", *t.encode().lower().split(), b">"]
        assert b - a == len(want)
        for k, w in zip(key[a:b].tolist(), want):
            assert name.setdefault(w, k) == k
    assert len(set(name.values())) == len(name)
    assert len(lm.word_keys(pa.array([], pa.string()))[0]) == 0


@pytest.mark.parametrize("log", [1, 3, 6, 11, 12])
def test_patterned_words_differ(spark, log):
    """Words made to cancel out in sums of powers, whole and in parts, and words that differ by zero bytes or order."""
    morse = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << log))
    other = morse.translate(str.maketrans("ab", "ba"))
    words = [morse, other, morse + other, other + morse, morse + "\0", "\0" + morse, morse * 3, other * 3, morse[::-1] + "c"]
    key, _ = lm.word_keys(pa.array([" ".join(words)]))
    assert len(set(key[1:-1].tolist())) == len(set(words))
    if log == 11:
        df = spark.createDataFrame([(0, morse), (1, other), (2, morse)], "doc_id long, text string")
        got = {r.doc_id: r for r in lm.scored(df, df.where("doc_id > 0")).collect()}
        want = 2 * math.log10(1.1 / (4 + 0.1 * 4)) + (math.log10(2.1 / 1.1))
        assert all(math.isclose(got[k].base_score, want, rel_tol=1e-9) and got[k].n_known == 2 for k in got)


def test_sequences():
    x, starts = np.array([9, 1, 2, 9, 3], np.uint64), np.array([0, 3])
    found = [(at.tolist(), c.tolist(), s.tolist()) for at, c, s in lm.sequences(x, starts, 3)]
    pair = lm.mixed(np.array([9, 1], np.uint64), np.array([1, 2], np.uint64)).tolist()
    assert found == [([1, 2, 4], [9, 1, 9], [1, 2, 3]), ([2], [pair[0]], [pair[1]])]


def test_better_than_word_counts(spark):
    got = [r for r in lm.op5_suffix_tree(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_texts_come_by_bounded_batches(spark):
    """Long texts come to a task by some BATCH_BYTES, not by 10,000 rows; scores don't depend on how rows come."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    long = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("m n o p "), 2500).alias("text"))
    try:
        assert {r.n for r in lm.word_counts(long).collect()} == {600, 600 * 2500}
        sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
        assert max(r.n for r in long.mapInArrow(sizes, "n long").collect()) < 1.1 * lm.common.BATCH_BYTES
        spark.conf.set(key, "2000")
        got = sorted((r.doc_id, r.score) for r in lm.scored(df, df.where("doc_id % 3 > 0"), learns="doc_id % 3 > 0").collect())
        assert spark.conf.get(key) == "2000"  # the session's own bound stays
    finally:
        spark.conf.unset(key)
    plain = Plain([t for d, t in rows if d % 3])
    for (d, a), (e, b) in zip(got, sorted((d, plain.score(t)) for d, t in rows), strict=True):
        assert d == e and math.isclose(a, b, rel_tol=1e-9)


def test_joined_arrays_are_let_go():
    parts = [np.arange(3), np.arange(2)]
    assert lm._joined(parts).tolist() == [0, 1, 2, 0, 1] and not parts
