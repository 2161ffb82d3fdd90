import random
import re

import pytest

pytest.importorskip("fieldmosaic.llm.personal")
from fieldmosaic.llm import personal

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def base(text):
    out = []
    for k, p in PLAIN.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[k]
            if ok:
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans(spark):
    rng = random.Random(7)
    bits = ["a.b@c.de", "x@y", "@", "_d@e.f", "é", " ", "1.2.3.4", "300.1.1.1", "000000012.1.2.3", "4111 1111 1111 1111", "4111111111111112", "5500-0000-0000-0004", "+1 (017) 555-7713", "+49 30", "+", "12", ".", "-", "\n", "word", "(555) 123-4567", "378282246310005", "😀", "9" * 30, "me (at) site (dot) org"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(400)]
    texts += [None, "", "1" * 60_000, "a" * 60_000 + "@b.c", "1.2.3.4 " * 3000, "x" * 30_000 + "+1 " + "2 " * 30_000, "a@b.c_d@e.f", "1.2.3.4.5.6.7.8"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(4, texts[4], "x"), (4, "z@y.xx", "x"), (None, "z@y.xx", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string").repartition(5)
    got = personal.personal_data(df).collect()
    assert len(got) == len(rows)
    have = sorted((r.doc_id if r.doc_id is not None else -1, [(s.kind, s.start, s.stop) for s in r.spans if s.base]) for r in got)
    want = sorted((i if i is not None else -1, base(t or "")) for i, t, _ in rows)
    assert have == want
    order = {k: n for n, k in enumerate(personal.KINDS)}
    for r in got:
        keys = [(order[s.kind], s.start) for s in r.spans]
        assert keys == sorted(keys)
        fixed = [s for s in r.spans if s.base]
        assert all(s.base or all(s.stop <= b.start or s.start >= b.stop for b in fixed) for s in r.spans)
    assert personal.personal_data(df.limit(0)).count() == 0


def test_method_adds_spans(spark):
    rng = random.Random(1)
    rows = [(i, f"please call ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} or +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} today") for i in range(60)]
    got = personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(len(r.spans) == 2 and sum(s.base for s in r.spans) == 1 for r in got)
    out = personal.masked(spark.createDataFrame(rows[:1] + [(77, None)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in out}[77] == "" and "[phone]" in {r.doc_id: r.text for r in out}[0]


def test_added_spans_are_right(spark):
    """Precision and recall of what the method adds, on templates of personal data and of numbers that are none."""
    rng = random.Random(11)
    n = lambda a, b: rng.randrange(a, b)
    rows, truth = [], {}
    for i in range(300):
        phone = f"({n(201, 989)}) {n(201, 989)}-{n(1000, 9999)}"
        mail = f"{rng.choice(['ann', 'bob', 'cy'])}{n(1, 99)} (at) site{n(1, 99)} (dot) {rng.choice(['org', 'com', 'net'])}"
        real, text = rng.choice([("phone", f"Please call {phone} today."), ("phone", f"Tel: {phone}"), ("email", f"Write to {mail} for more."), (None, f"Order {n(100, 999)}-{n(1000, 9999)} of version {n(1, 9)}.{n(1, 9)} shipped."), (None, f"It took {n(1, 9)}:{n(10, 59)} and {n(100, 999)} steps."), (None, "Nothing to see here, move along.")])
        rows.append((i, text))
        truth[i] = {(real, text.index(x), text.index(x) + len(x)) for x in (phone, mail) if real and x in text}
    got = {r.doc_id: {(s.kind, s.start, s.stop) for s in r.spans} for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit, found, wanted = (sum(len(x) for x in v) for v in ([got[i] & truth[i] for i in truth], got.values(), truth.values()))
    assert hit >= 0.9 * wanted and hit >= 0.9 * found, (hit, found, wanted)


def test_spans_of_the_method_stand_apart(spark):
    """Candidates in a row that overlap their neighbours: one that is left out hides none behind it."""
    text = "call (555) 123-4567 (555) 123-4567 or 555-123-4567.555-123-4567.555-123-4567 now"
    rows = spark.createDataFrame([(1, 5, text)], "doc_id long, key long, text string")
    found = sorted((r.start, r.stop, r.base) for r in personal.candidates(rows).collect())
    assert found and all(b[0] >= a[1] for a, b in zip(found, found[1:]) if not (a[2] and b[2]))


def test_reliabilities_recover_the_truth():
    rng = random.Random(2)
    true = [(0.95, 0.1), (0.8, 0.2), (0.9, 0.3), (0.7, 0.05), (0.6, 0.4)]
    count = {}
    for _ in range(20000):
        y = rng.random() < 0.3
        v = tuple(int(rng.random() < (a if y else b)) if rng.random() < 0.8 else None for a, b in true)
        count[v] = count.get(v, 0) + 1
    prior, rates = personal.reliabilities(list(count.items()), 200)
    assert abs(prior - 0.3) < 0.03 and all(abs(x - y) < 0.06 for r, t in zip(rates, true) for x, y in zip(r, t))


def test_query_against_brute_force(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = personal.op3_personal(spark, sf).collect()
    assert len(got) == len(text)
    for r in got:
        want = base(text[r.doc_id])
        assert [r[f"n_{k}"] for k in personal.KINDS] == [sum(x[0] == k for x in want) for k in personal.KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(",")) or not joined
