import random
import time

import numpy as np
import pytest

pytest.importorskip("fieldmosaic.llm.pieces")
from fieldmosaic.llm import pieces

P = pytest.importorskip("public_tokenizers")
PATH = P.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "   x", "\ta\nb\r\n", "▁x▁▁y ", "aaaaaaaaaaaaa", "é́ ﬁ ①", "<s>hi</s><0x0A>", "😀 벨y \x00", "1234 56", "a" * 500, " " * 40, "x" + " " * 37 + "y", ";\r ();\r", "====----====", "　\xa0"]


def _check(texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    m = pieces.model_at(PATH)
    ids, at = pieces.Encoder(m).encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    want = sp.encode(texts)
    for t, g, w in zip(texts, got, want):
        assert g == w, t
    assert pieces.decode(m, ids, at) == [sp.decode(x) for x in want]


def test_like_the_library():
    rng = random.Random(5)
    alphabet = "abcdefgh \n▁ éßñ.,!?()[]{}<>=-_#$%&*0123456789ABCabc 中文字ゼ😀\t\r"
    _check(ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(3000)])
    _check(["".join(rng.choice("aeintor ") for _ in range(rng.randrange(60))) for _ in range(2000)])


def test_long_words():
    """Unspaced texts of hundreds of thousands of characters, in time that doesn't grow with their square."""
    rng = random.Random(9)
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    prose = "thequickbrownfoxjumpsoverthelazydogandinternationalisationofcommunities"
    texts = ["data:," + "".join(rng.choice(base64) for _ in range(400_000)), "".join(prose[k : k + 9] for k in (rng.randrange(60) for _ in range(25_000)))]
    texts += ["a" * 200_000, "ha" * 60_000, "".join(rng.choice("abh") for _ in range(30_000)), "".join(rng.choice("中文字ゼ日本語") for _ in range(50_000)), "=-" * 30_000 + " x", "=" * 5_001]
    began = time.process_time()
    _check(texts)
    assert time.process_time() - began < 60


def test_decode_of_any_ids():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    m, rng = pieces.model_at(PATH), np.random.default_rng(3)
    for _ in range(300):
        ids = np.where(rng.random(9) < 0.4, rng.integers(0, 259, 9), rng.integers(0, 32000, 9))
        assert pieces.decode(m, ids, np.array([0, 9])) == [sp.decode(ids.tolist())]


def test_frame(spark):
    rows = [(1, "ab cd", "x"), (2, None, None), (None, "", "y"), (1, "ab cd", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.doc_id or 0, tuple(r.ids), r.decoded) for r in pieces.encode_documents(df, PATH).collect())
    assert got[0] == (0, (2,), "") and got[3] == (2, (2,), "") and got[1] == got[2] and got[1][2] == "ab cd"
    assert pieces.encode_documents(df.limit(0), PATH).count() == 0
