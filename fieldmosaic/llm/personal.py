"""Personal data by weak supervision (operator 3), in DataFrame functions only.

Base spans follow four patterns with a check each and always stay. Further candidates come from wider patterns.
Five labelers vote on every candidate, yes, no or not at all: two regex labelers (the base pattern with its check;
a strict shape), a gazetteer (endings, prefixes, reserved ranges) and two context labelers (words that point to
such data, and signs that speak against it). Expectation-maximisation over the counts of vote patterns (at most
3^5 for each kind, whatever the input's size) estimates each labeler's reliability and each pattern's probability.
With those as soft labels, a naive Bayes classifier of spans is trained over bucketed features of the span and of
what stands around it; its verdict adds candidates that no base span touches.

Positions come from splitting a text by the same pattern: the pieces' and matches' lengths, summed up in order.
Where the patterns here are possessive or look behind, they match what the plain ones match, without
backtracking over long runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\((?:at|AT)\)|\[(?:at|AT)\]| (?:at|AT) ) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\((?:dot|DOT)\)|\[(?:dot|DOT)\]| (?:dot|DOT) ) ?[A-Za-z0-9-]{2,63}+)++",
    "ip": r"(?=[0-9A-Fa-f])(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?=[0-9])(?<![0-9A-Za-z+.-])[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9A-Za-z])",
    "phone": r"(?=[(0-9])(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
# Words near a span that speak for its kind, and those that speak against any kind.
_CUES = {
    "email": "e-?mail|mail|contact|write|correo|courriel|adresse|address",
    "ip": r"\bip\b|host|server|address|adresse|login|client|remote",
    "card": r"card|visa|master|amex|credit|karte|carte|tarjeta|payment|konto",
    "phone": r"phone|\btel\b|\btel[.:]|call|mobile|cell|fax|telefon|téléphone|teléfono|contact|whatsapp",
}
_AGAINST = r"version|\bv\.|isbn|issn|order|invoice|serial|token|sku|build|\bid\b|\bref\b|part no|sha|hash|http"
_ENDINGS = "com|org|net|edu|gov|io|de|fr|es|uk|info|eu|ch|at|it|nl|us|ca|mx|ar|biz|dev|app"
LABELERS = ("pattern", "shape", "gazetteer", "cue", "against")
BEFORE, AFTER = 32, 16


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(x: Column, i: Column) -> Column:
        twice = x.cast("int") * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x.cast("int"))

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _octets_fit(match: Column) -> Column:
    def fits(x: Column) -> Column:
        short = F.regexp_replace(x, "^0+", "")
        return (F.length(short) < 3) | (F.length(short) == 3) & (short <= "255")

    return F.forall(F.split(match, r"\."), fits)


def _may_hold(wide: bool, kind: str) -> Column:
    """A cheap sign without which a text has no match of the pattern."""
    text = F.col("text")
    if kind == "email" and not wide:
        return F.contains(text, F.lit("@"))
    if kind == "email":
        signs = [F.contains(text, F.lit(s)) for s in ("(at)", "(AT)", "[at]", "[AT]", " at ", " AT ")]
        ends = [F.contains(text, F.lit(s)) for s in ("dot", "DOT")]
        return (signs[0] | signs[1] | signs[2] | signs[3] | signs[4] | signs[5]) & (ends[0] | ends[1])
    if kind == "ip":
        return F.contains(text, F.lit(":")) if wide else text.rlike(r"[0-9]\.[0-9]")
    if kind == "phone" and not wide:
        return F.contains(text, F.lit("+"))
    return text.rlike("[0-9]")


def _passes(kind: Column, match: Column) -> Column:
    """Whether a match of a base pattern is a base span."""
    n = F.length(_digits(match))
    return (
        F.when(kind == "ip", _octets_fit(match))
        .when(kind == "card", F.when(n.between(16, 19), _luhn(_digits(match))).otherwise(False))
        .when(kind == "phone", n.between(8, 15))
        .otherwise(True)
    )


def _matches(rows: DataFrame) -> DataFrame:
    """doc_id, key, kind, wide, n, gap, match, before, after: all matches, n counting those of a kind in a text."""
    sets, pieces = [], None
    for wide, patterns in ((False, _BASE), (True, _WIDE)):
        for kind in KINDS:
            matches = F.when(_may_hold(wide, kind), F.regexp_extract_all("text", F.lit(patterns[kind]), F.lit(0)))
            sets.append(F.struct(F.lit(kind).alias("kind"), F.lit(wide).alias("wide"), matches.alias("matches")))
            here, split = (F.col("s.kind") == kind) & (F.col("s.wide") == wide), F.split("text", patterns[kind], -1)
            pieces = F.when(here, split) if pieces is None else pieces.when(here, split)
    # The outer form, as Spark would match everything twice to leave out empty arrays first. Texts are split for matches only.
    each = rows.select("doc_id", "key", "text", F.explode_outer(F.array(*sets)).alias("s")).where("size(s.matches) > 0")
    each = each.select("doc_id", "key", "s", pieces.alias("pieces"))
    parts = F.transform("s.matches", lambda m, i: F.struct(F.length(F.col("pieces")[i]).alias("gap"), m.alias("match"), F.right(F.col("pieces")[i], F.lit(BEFORE)).alias("before"), F.left(F.col("pieces")[i + 1], F.lit(AFTER)).alias("after")))
    listed = each.select("doc_id", "key", "s.kind", "s.wide", parts.alias("parts")).groupBy("doc_id", "key", "kind", "wide").agg(F.first("parts").alias("parts"))
    return listed.select("doc_id", "key", "kind", "wide", F.posexplode("parts").alias("n", "p")).select("doc_id", "key", "kind", "wide", "n", "p.*")


def candidates(rows: DataFrame) -> DataFrame:
    """Base spans and wider candidates of rows (doc_id, key, text): doc_id, key, kind, start, stop, base, match, before, after.

    start and stop are code points, stop exclusive. Wider candidates that touch a base span of the same text are left out,
    and those that touch one that is kept to their left.
    """
    w = Window.partitionBy("doc_id", "key", "kind", "wide").orderBy("n")
    gone, matched = F.sum("gap").over(w), F.sum(F.length("match")).over(w)
    placed = _matches(rows).select("doc_id", "key", "kind", "wide", (gone + matched - F.length("match")).alias("start"), (gone + matched).alias("stop"), "match", "before", "after")
    base = placed.where(~F.col("wide")).withColumn("base", _passes(F.col("kind"), F.col("match")))
    # A base match that fails its check may still be voted on, if it looks like its kind.
    failed = (F.col("kind") == "card") & F.length(_digits(F.col("match"))).between(15, 19) | (F.col("kind") == "phone") & F.length(_digits(F.col("match"))).between(7, 15)
    every = base.where(F.col("base") | failed).unionByName(placed.where("wide").withColumn("base", F.lit(False)))
    # Candidates that overlap an earlier one give way: base spans first, then by start.
    order = Window.partitionBy("doc_id", "key").orderBy("start", F.col("base").desc(), "stop")
    reach = F.max(F.when(F.col("base"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("stop")) >= F.col("stop"))
    apart = every.withColumn("free", free).where("base or free")
    # What is left may still overlap: of each run of overlapping ones, from the left, those that none kept before reaches.
    upto = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = apart.withColumn("new", F.when(F.coalesce(upto, F.lit(0)) <= F.col("start"), 1).otherwise(0)).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    one = F.struct("start", (~F.col("base")).alias("wider"), "stop", "kind", "base", "match", "before", "after")
    listed = runs.groupBy("doc_id", "key", "run").agg(F.sort_array(F.collect_list(one)).alias("all"))
    none = F.struct(F.lit(0).cast("long").alias("upto"), F.filter("all", lambda x: F.lit(False)).alias("kept"))
    keep = lambda a, x: F.when(x["base"] | (x["start"] >= a["upto"]), F.struct(F.greatest(a["upto"], x["stop"].cast("long")).alias("upto"), F.concat(a["kept"], F.array(x)).alias("kept"))).otherwise(a)
    kept = listed.select("doc_id", "key", F.explode(F.aggregate("all", none, keep)["kept"]).alias("x"))
    return kept.select("doc_id", "key", *[F.col(f"x.{c}").alias(c) for c in ("kind", "start", "stop", "base", "match", "before", "after")])


def votes(found: DataFrame) -> DataFrame:
    """found with a column for each labeler: 1, 0, or null where it abstains."""
    kind, match, before, after = (F.col(c) for c in ("kind", "match", "before", "after"))
    digits = _digits(match)

    def yes(c: Column) -> Column:
        return F.when(c, 1).otherwise(0)

    shape = (
        F.when(kind == "email", yes(match.rlike(r"^[A-Za-z0-9][^@]*@.*\.[A-Za-z]{2,24}$")))
        .when(kind == "ip", yes(match.rlike(r"^(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})$|^[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}$")))
        .when(kind == "card", yes(match.rlike(r"^[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^[0-9]{4}([ -]?)[0-9]{6}\2[0-9]{5}$|^[0-9]{17,19}$")))
        .otherwise(yes(match.rlike(r"^\+[0-9]{1,3}[ .-]|^\([0-9]{3}\)|^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$")))
    )
    gazetteer = (
        F.when(kind == "email", yes(F.lower(match).rlike(rf"[. ](?:{_ENDINGS})$")))
        .when(kind == "ip", yes(~match.rlike(r"^(?:0+|127|255|22[4-9]|23[0-9])\.")))
        .when(kind == "card", yes(digits.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6)") & F.when(F.length(digits) > 2, _luhn(digits)).otherwise(False)))
        .otherwise(yes(match.rlike(r"^\+[1-9]|^\(?[0-9]{3}") & ~digits.rlike(r"^(.)\1+$")))
    )
    around = F.lower(F.concat_ws(" ", before, after))
    cue = F.lit(None).cast("int")
    for k in KINDS:
        cue = F.when((kind == k) & around.rlike(_CUES[k]), 1).otherwise(cue)
    against = F.when(F.lower(before).rlike(rf"(?:{_AGAINST})[^a-z]*$") | before.rlike(r"[A-Za-z0-9_/=\"]$") & (kind != "email") | after.rlike(r"^[A-Za-z0-9_/=\"]"), 0)
    return found.withColumns({"pattern": yes(F.col("base")), "shape": shape, "gazetteer": gazetteer, "cue": cue, "against": against.cast("int")})


def reliabilities(patterns: list[tuple[tuple[int | None, ...], float]], rounds: int = 50) -> tuple[float, list[tuple[float, float]]]:
    """Prior of yes, and each labeler's P(1 | yes), P(1 | no) where it votes, by expectation-maximisation.

    patterns: votes of all labelers with their count. Starts from the majority of votes; counts are smoothed
    by one, so labelers that never vote stay neutral.
    """
    if not patterns:
        return 0.5, [(0.5, 0.5)] * len(LABELERS)
    p = [(sum(v == 1 for v in votes) + 1) / (sum(v is not None for v in votes) + 2) for votes, _ in patterns]
    for _ in range(rounds):
        yes = sum(q * n for q, (_, n) in zip(p, patterns))
        prior = (yes + 1) / (sum(n for _, n in patterns) + 2)
        rates = []
        for k in range(len(LABELERS)):
            voted = [(q, votes[k], n) for q, (votes, n) in zip(p, patterns) if votes[k] is not None]
            rates.append(tuple((sum(w(q) * n * v for q, v, n in voted) + 1) / (sum(w(q) * n for q, _, n in voted) + 2) for w in (lambda q: q, lambda q: 1 - q)))
        p = [posterior(votes, prior, rates) for votes, _ in patterns]
    return prior, rates


def posterior(votes: tuple[int | None, ...], prior: float, rates: list[tuple[float, float]]) -> float:
    """Probability of yes given the votes."""
    odds = math.log(prior / (1 - prior))
    for v, (a, b) in zip(votes, rates):
        if v is not None:
            odds += math.log(a / b) if v else math.log((1 - a) / (1 - b))
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))


def _features(kind: Column, match: Column, before: Column, after: Column) -> list[Column]:
    """Bucketed, so that there are few values; each begins with the kind and a number."""

    def char_class(c: Column) -> Column:
        return F.when(c == "", "edge").when(c.rlike("^[0-9]"), "digit").when(c.rlike(r"^\s"), "space").when(c.rlike("^[A-Za-z]"), "letter").otherwise("sign")

    n = F.length(_digits(match))
    separator = F.regexp_replace(F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace(match, "[0-9A-Za-z]", ""), ""))), ""), r"[^-. ()+@:]", "_")
    checked = F.when(kind == "card", F.when(n.between(2, 19), _luhn(_digits(match)).cast("string")).otherwise("-")).otherwise("-")
    values = [F.least(n, F.lit(20)).cast("string"), F.left(separator, F.lit(6)), char_class(F.right(before, F.lit(1))), char_class(F.left(after, F.lit(1))), char_class(match), checked]
    return [F.concat_ws("|", kind, F.lit(str(k)), v) for k, v in enumerate(values)]


def spans(rows: DataFrame, least: float = 0.5) -> DataFrame:
    """All spans of rows (doc_id, key, text): doc_id, key, kind, start, stop, base. Others than base ones score at least `least`."""
    found = common.stage(votes(candidates(rows)), "candidates")
    patterns = found.groupBy("kind", *LABELERS).count().collect()  # at most 3^5 of each kind
    soft = None
    for k in KINDS:
        own = [(tuple(r[c] for c in LABELERS), r["count"]) for r in patterns if r["kind"] == k]
        prior, rates = reliabilities(own)
        for v, _ in own:
            hit = F.col("kind") == k
            for c, x in zip(LABELERS, v):
                hit &= F.col(c).eqNullSafe(F.lit(x).cast("int"))
            soft = F.when(hit, posterior(v, prior, rates)) if soft is None else soft.when(hit, posterior(v, prior, rates))
    if soft is None:
        return found.select("doc_id", "key", "kind", "start", "stop", "base")
    marked = found.withColumn("p", soft).withColumn("x", F.array(*_features(F.col("kind"), F.col("match"), F.col("before"), F.col("after"))))
    totals = {r["kind"]: (r["yes"], r["no"]) for r in marked.groupBy("kind").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()}
    table = marked.select("kind", "p", F.explode("x").alias("f")).groupBy("kind", "f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()  # a few hundred
    weight = {r["f"]: math.log((r["yes"] + 1) / (totals[r["kind"]][0] + 2)) - math.log((r["no"] + 1) / (totals[r["kind"]][1] + 2)) for r in table}
    start = {k: math.log((yes + 1) / (no + 1)) for k, (yes, no) in totals.items()}
    of = F.create_map(*[F.lit(x) for f, v in sorted(weight.items()) for x in (f, v)])
    bias = F.create_map(*[F.lit(x) for k, v in sorted(start.items()) for x in (k, v)])
    odds = F.aggregate("x", bias[F.col("kind")], lambda a, f: a + of[f])
    score = 1 / (1 + F.exp(-odds))
    return marked.where(F.col("base") | (score >= least)).select("doc_id", "key", "kind", "start", "stop", "base")


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id and spans (array of kind, start, stop, base; by kind as in KINDS, then start).

    Null and empty texts have no spans. Repeated rows have repeated results; rows of the same id with other text
    don't mix. Empty tables give empty results; other columns are ignored.
    """
    rows = common.pick(docs, doc_id=doc_id, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    found = spans(rows)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    sorted_spans = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), F.col("start"), F.col("stop"), F.col("kind"), F.col("base"))))
    per_doc = found.groupBy(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key")).agg(sorted_spans.alias("spans"))
    keys = rows.select("doc_id", "key")
    joined = keys.join(per_doc, keys["doc_id"].eqNullSafe(per_doc["of_id"]) & (keys["key"] == per_doc["of_key"]), "left")
    return joined.select("doc_id", F.transform(F.coalesce("spans", F.array().cast(per_doc.schema["spans"].dataType)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["base"].alias("base"))).alias("spans"))


def masked(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text with every span replaced by its kind in brackets; null texts become empty. Spans that overlap are one."""
    rows = common.pick(docs, doc_id=doc_id, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    found = spans(rows).groupBy(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key")).agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind"))).alias("spans"))
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["of_id"]) & (rows["key"] == found["of_key"]), "left")
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(a: Column, s: Column) -> Column:
        between = F.col("text").substr((a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        return F.when(s["start"] >= a["at"], F.struct(F.concat(a["out"], between, F.lit("["), s["kind"], F.lit("]")).alias("out"), s["stop"].alias("at"))).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["stop"]).alias("at")))

    done = F.aggregate("spans", zero, step)
    rest = F.concat(done["out"], F.col("text").substr((done["at"] + 1).cast("int"), F.length("text")))
    return joined.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(rest).alias("text"))


def op3_personal(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["base"])

    def text_of(c) -> Column:
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def of_kind(kind: str):
        return lambda s: s["base"] & (s["kind"] == kind)

    counts = [F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text_of(base), 256).alias("base_sha256"), text_of("spans").alias("spans"))
