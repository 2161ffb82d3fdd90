import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("fieldmosaic.llm.language")
from fieldmosaic.llm import common, contexts, language


def _slow(train, text, depth=3):
    """Code length in nats of text by one language, counted gram by gram."""
    seen = [{} for _ in range(depth + 1)]
    for t in train:
        b = b"\n" * depth + t.encode()
        for i in range(depth, len(b)):
            for k in range(depth + 1):
                at = seen[k].setdefault(b[i - k : i], {})
                at[b[i]] = at.get(b[i], 0) + 1
    total, b = 0.0, b"\n" * depth + text.encode()
    for i in range(depth, len(b)):
        for k in range(depth, -1, -1):
            at = seen[k].get(b[i - k : i])
            if at:
                n = sum(at.values()) + len(at)
                if b[i] in at:
                    total -= math.log(at[b[i]] / n)
                    break
                total -= math.log(len(at) / n)
        else:
            total += math.log(256)
    return total


def test_exact_code_lengths(spark):
    rng = random.Random(1)
    texts = {k: ["".join(rng.choice(a) for _ in range(rng.randrange(1, 200))) for _ in range(20)] for k, a in (("xx", "abcab é"), ("yy", "bcdz\n "))}
    df = spark.createDataFrame([(t, k) for k, v in texts.items() for t in v] + [(None, "xx"), ("aaa", None)], "text string, lang string").repartition(3)
    trees = language.train(df)
    assert sorted(trees) == ["xx", "yy"]
    tests = ["", "abcab", "zzz é", "qqq\n", "b"]
    code, starts = contexts.grams([t.encode() for t in tests], 3)
    for k in trees:
        got = -contexts.sums(trees[k].log(code), starts)
        assert np.allclose(got, [_slow(texts[k], t) for t in tests])


def test_predictions(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 3, "en" if i % 2 else "de", "s") for i in range(40)]
    trees = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string"))
    odd = spark.createDataFrame([(1, None, None), (2, "", "x"), (3, "12 !_ \u00bd \u00b2 \u2167", "x"), (4, "the dog", None), (4, "the dog", None), (None, "die katze" * 9000, "x")], "doc_id long, text string, lang_pred string")
    got = sorted((r.doc_id or 0, r.lang_pred, round(r.score, 3)) for r in language.predict(odd, trees).collect())
    assert got[0][1] == "de" and [g[1] for g in got[1:]] == ["und"] * 3 + ["en"] * 2 and all(0 <= g[2] <= 1 for g in got)
    assert language.predict(odd.limit(0), trees).count() == 0
    both = language.predict(odd, trees, keep=("doc_id", "lang_pred"), names=("found", "share"))
    assert both.columns == ["doc_id", "lang_pred", "found", "share"] and {r.found for r in both.collect()} == {"und", "en", "de"}
    assert {r.lang_pred for r in language.predict(odd, {}).collect()} == {"und"}
    assert language.train(odd.select("text", odd["lang_pred"].alias("lang")).limit(0)) == {}


@pytest.mark.parametrize("held", [contexts.HELD, 60, 0])
def test_rare_grams_count(spark, monkeypatch, held):
    """Shares are those of all grams, however rare, in memory or joined; a language has many rare continuations."""
    monkeypatch.setattr(contexts, "HELD", held)
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    texts = {"xx": ["ab " * 60_000] + ["".join(rng.choice(letters) for _ in range(40)) for _ in range(8)], "yy": ["cd " * 60_000] + ["".join(rng.choice("abcdz ") for _ in range(90)) for _ in range(8)]}
    trees = language.train(spark.createDataFrame([(t, k) for k, v in texts.items() for t in v], "text string, lang string").repartition(3))
    assert sorted(trees) == ["xx", "yy"] and (trees.table is None) == (held == contexts.HELD > 1000)
    tests = ["a" + letters[3], "ab cd", letters[5] * 2 + "zz", texts["xx"][2][:9], "abz b", "d\u00e9", "", "a"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tests)] + [(3, tests[3]), (9, None)], "doc_id long, text string").repartition(2)
    got = language.predict(rows, trees).collect()
    assert len(got) == len(tests) + 2
    for r in got:
        if r.doc_id == 9 or not tests[r.doc_id]:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        x, y = (_slow(texts[k], tests[r.doc_id]) for k in ("xx", "yy"))
        assert r.lang_pred == ("xx" if x <= y else "yy") and math.isclose(r.score, 1 / (1 + math.exp(-abs(x - y) / len(tests[r.doc_id].encode()))), rel_tol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.op4_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got) > 100


def test_letters():
    assert not any(map(language.has_letter, ["", "12", "\u00bd \u00b2", "\u2167", "_", "\u0663"]))
    assert all(map(language.has_letter, ["1a", "\u00e9", "12 \u4e00", "\u02b0"]))


def test_filter_tells_what_is_unseen(spark, monkeypatch):
    """With memory for half of the grams, nothing is asked for a script that a language never saw, and all that is seen is."""
    monkeypatch.setattr(contexts, "HELD", 400)
    rng = random.Random(7)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 300)]
    own = ["".join(rng.choice(letters) for _ in range(60)) for _ in range(30)]
    trees = language.train(spark.createDataFrame([(t, "xx") for t in own] + [("abc abd " * 900, "yy")], "text string, lang string").repartition(3))
    assert trees.table is not None
    code, _ = contexts.grams([("kein Wort davon " * 200).encode()], language.DEPTH)
    assert trees["xx"].told(code)[1].sum() < 0.02 * len(code)
    trees["xx"].beyond = None
    assert trees["xx"].told(code)[1].sum() > 0.5 * len(code)


def test_tasks_get_bounded_batches(spark):
    """Rows of 20 kB come to a task by some BATCH_BYTES, not by Spark's 10,000 rows, and a kept text comes once."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    rows = spark.range(0, 1000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("der hund "), 2200).alias("text"), F.lit("de").alias("lang"))
    trees = language.train(rows.limit(2))
    found = language.predict(rows, trees, keep=("doc_id", "text", "lang"), names=("found", "share"))
    assert "__text" not in found._jdf.queryExecution().toString()
    got = rows.mapInArrow(sizes, "n long, size long").collect()  # the bound holds in the session, as plans are run later
    assert sum(r["n"] for r in got) == 1000 and max(r["size"] for r in got) < 1.1 * common.BATCH_BYTES
    assert found.where("found = 'de' and length(text) = 19800 and lang = 'de'").count() == 1000


@pytest.mark.parametrize("held", [contexts._SORTED, 5])
def test_counts_by_blocks(spark, monkeypatch, held):
    """Grams are combined over a task's texts before they are shuffled, and none is lost if they are passed on early."""
    monkeypatch.setattr(contexts, "_SORTED", held)
    rows = spark.range(0, 500, 1, 1).select(F.when(F.col("id") % 2 == 0, "xx").otherwise("yy").alias("kind"), F.repeat(F.lit("ab"), 5000).alias("text"))
    got = {(r.kind, r.code): r.n for r in contexts.count(rows, 1, str.encode).collect()}
    a, b, start = ord("a"), ord("b"), contexts.PAD
    assert got == {(k, code): 250 * n for k in ("xx", "yy") for code, n in ((start << 8 | a, 1), (a << 8 | b, 5000), (b << 8 | a, 4999))}
