import random
import zlib

import pytest

pytest.importorskip("fieldmosaic.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
from tests.llm.test_contamination import brute as hit_words
from tests.llm.test_simhash import plain as fingerprint


def by_hand(docs, items):
    """Rows (doc_id, text) that the stages keep, told by plain loops. All texts with a letter are of a known language."""
    left = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    last = {}
    for i, t in left:
        last[t] = max(i, last.get(t, -1))
    left = sorted((i, t) for t, i in last.items())
    fps = [fingerprint(t) for _, t in left]
    group = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    left = [x for k, x in enumerate(left) if group[k] == k]
    return [x for x, h in zip(left, hit_words(left, items)) if not h[4]]


def test_all_stages(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["the", "and", "in", "er", "on", "st"]) for _ in range(rng.randrange(1, 4)))
    fremd = lambda: "".join(rng.choice(["der", "ung", "ich", "ä", "sch"]) for _ in range(rng.randrange(1, 4)))
    items = [(k, " ".join(word() for _ in range(30))) for k in range(5)]
    docs = []
    for k in range(120):
        docs.append((" ".join((word if k % 3 else fremd)() for _ in range(rng.randrange(20, 90))), "en" if k % 3 else "de"))
    docs += [docs[k] for k in range(10)]
    docs += [(docs[k][0] + " " + word(), "en") for k in range(20, 40)]
    docs += [(items[k % 5][1] + " " + word(), "en") for k in range(8)] + [("12 34 !!", "en"), ("", "en"), (None, None)]
    rows = [(k, t, lang if k % 11 else None, f"src{k % 3}", len(t or "")) for k, (t, lang) in enumerate(docs)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = by_hand([(r[0], r[1]) for r in rows], items)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in want)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = dict(want)
    for r in got:
        ids = sp.encode(text[r.doc_id]) + [sp.eos_id()]
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded == sp.decode(ids)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([], schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_language_stage_keeps_what_is_torn_between_three(spark):
    """Where three languages are alike, the best share is a third, and the text stays."""
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    learnt = [i for i in range(200) if i not in held][:9]
    rows = [(i, "one two three", ("aa", "bb", "cc")[k % 3], "s", 13) for k, i in enumerate(learnt)] + [(held[0], "two", "aa", "s", 3), (held[1], "12 !", "aa", "s", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.known_language(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted([*learnt, held[0]])


def test_stages_take_clashing_columns(spark, tmp_path):
    names = ["lang_pred", "score", "quality", "ids", "key", "row", "words", "digest", "decoded", "n_tokens"]
    docs = spark.createDataFrame([(k, f"some text {k % 3}", "en", "s", 11, *range(10)) for k in range(12)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    spark.createDataFrame([(1, "some text 2")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
        left.append(out.count())
        docs = out
    assert left == [12, 3, 3, 2, 2]
