import random
import re

import pytest

pytest.importorskip("fieldmosaic.llm.contamination")
from fieldmosaic.llm import common, contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[k : k + 13]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out.append((d, len(w), len(hit), sorted(map(str, found)), 0 < len(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.fixture
def far(spark, monkeypatch):
    """The plan of a test side that is too large to broadcast, with several tasks and rows for the frequent terms."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    for name, value in (("HOT", 40), ("SHARE", 0.0)):
        monkeypatch.setattr(contamination, name, value)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_index(spark):
    """Every word's positions, ascending, under its term, once; no words, no lists."""
    texts = ["b a b c a b", "", None, "É é a", "x " * 5000 + "y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in contamination.index(contamination._sources(docs, "text", "doc_id")).collect():
        w = words(texts[r.doc_id])
        assert r.n_words == len(w) and r.terms == sorted(set(w), key=str.encode)
        assert r.lists == [[i for i, x in enumerate(w) if x == t] for t in r.terms]


def test_near_plan(spark):
    """Lists are intersected where the index is read: no exchange below the last condition, and no Python."""
    docs = spark.createDataFrame([(i, f"a b c d e f{i % 9}") for i in range(50)], "doc_id long, text string")
    found = contamination.index(contamination._sources(docs, "text", "doc_id"))
    held = contamination.phrase_matches(found, contamination.item_windows(spark.createDataFrame([(1, "d e f3")], "item_id long, text string")))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Python" not in plan
    assert {r.doc_id for r in held.collect()} == {i for i in range(50) if i % 9 == 3}


def test_far_plan(spark, far):
    """Only lists of terms that may be asked for are dealt by term and salt."""
    docs = spark.createDataFrame([(i, f"a b c d e f{i % 9} " * 9) for i in range(200)], "doc_id long, text string")
    found = contamination.index(contamination._sources(docs, "text", "doc_id"))
    windows = contamination.item_windows(spark.createDataFrame([(i, f"a b f{i}") for i in range(6)], "item_id long, text string"))
    windows = windows.select(contamination.F.concat_ws(" ", "words").alias("wid"), "words", "items")
    asked, counts = contamination._asked(windows, found)
    assert {(r.term, r.offset, tuple(map(tuple, r.rest))) for r in asked.collect()} == {(f"f{i}", 2, ((0, "a"), (1, "b"))) for i in range(6)}
    at = contamination.postings(found, asked, counts)
    assert {r.salts for r in contamination._hot(counts).where("term = 'f1'").collect()} == {6}  # 23 x 9 occurrences
    plan = at._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("bits" in line for line in plan)
    assert at.count() == sum(9 for i in range(200) if i % 9 < 6)


@pytest.mark.parametrize("plan", ["near", "far"])
def test_against_brute_force(spark, request, plan):
    if plan == "far":
        request.getfixturevalue("far")
    rng = random.Random(3)
    vocabulary = ["the", "The", "É", "é", "a1", "x-y", "of", "ÉTÉ", "b"] + [f"w{i}" for i in range(30)]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 5, 12, 13, 14, 30]))) for i in range(12)] + [(50, None), (51, "!!"), (52, "the of"), (53, "the of")]
    docs = []
    for i in range(60):
        t = text(rng.randrange(0, 60))
        if rng.random() < 0.5:
            w = words(rng.choice(items)[1])
            t += " " + " ".join(w[rng.randrange(3) :]) + " " + text(rng.randrange(5))
        docs.append((i, t))
    docs += [(70, None), (71, ""), (3, docs[3][1]), (3, "the of"), (None, "the of"), (80, "of the " * 4000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, key string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in contamination.contamination(df, bench).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = brute(docs, items)
    assert sorted(got, key=key) == sorted(want, key=key)
    left = contamination.clean_documents(df, bench).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == sorted((d or 0, t or "") for (d, t), w in zip(docs, want) if not w[4])
    assert contamination.contamination(df.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in contamination.contamination(df, bench.limit(0)).collect())


@pytest.mark.parametrize("plan", ["near", "far"])
def test_proximity(spark, request, plan):
    if plan == "far":
        request.getfixturevalue("far")
    docs = spark.createDataFrame([(1, "a b c d rare f g h"), (2, "rare x x x x d"), (3, None)], "doc_id long, text string")
    q = spark.createDataFrame([(9, ["d", "rare", "f"]), (8, ["rare", "d"])], "query_id long, words array<string>")
    assert {(r.doc_id, r.query_id, r.pos) for r in contamination.proximity_matches(docs, q, 3).collect()} == {(1, 9, 5), (1, 8, 4)}  # f is the rarest word of 9
