"""Benchmark decontamination over a positional inverted index (operator 7), in DataFrame functions only.

Texts are split into words once, and the index is written to the shared folder: for each document its terms in order,
and for each term the sorted list of its positions. A document's lists stay together, so making the index shuffles
nothing. Terms are counted over all documents from the lengths of their lists. A window is asked for under its rarest
term; the lists of its other terms, from the rarest on, are intersected with the rarest one's, each by its offset: a
posting goes on only while the next list holds the position that the window asks for.

The test side is broadcast only if it is counted to be small; the intersection then takes place where the index is read.
Beyond that, a filter of 2**MASK bits, which is broadcast at any size, leaves out lists of terms that aren't asked for,
the others are dealt by term, and what they may match goes back to the document's index; a term of very many lists is
dealt over as many tasks as its count asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
#: Characters of test-side rows that may be broadcast.
BROADCAST_CHARS = 20_000_000
#: Where the test side is too large to broadcast: occurrences of a term that one task may have, or a share of all
#: occurrences if that is more, so that at most 1 / SHARE terms have more.
HOT, SHARE = 100_000, 1e-4
#: The power of two of the filter's bits; as longs they are at most 2**18 rows.
MASK = 24
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(_WORD), F.lit(0))


def item_windows(items: DataFrame, text: str = "text", item_id: str = "item_id", size: int = WINDOW) -> DataFrame:
    """words (array) and items (sorted ids) of each distinct window: size consecutive words of an item.

    An item of fewer words is one window; one of none, or of null text, has no window.
    """
    rows = common.pick(items, item_id=item_id, text=text).select("item_id", words_of(F.coalesce("text", F.lit(""))).alias("words")).where("size(words) > 0")
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1))))
    single = rows.select("item_id", "words", at.alias("at")).select("item_id", F.slice("words", F.col("at"), F.lit(size)).alias("words"))
    return single.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def _fits(df: DataFrame, size: Column | None = None) -> bool:
    """Whether a test-side table may be broadcast: counted rows and characters are under fixed bounds."""
    n, chars = df.agg(F.count("*"), F.coalesce(F.sum(size if size is not None else F.lit(1)), F.lit(0))).first()
    return n <= common.BROADCAST_ROWS and chars <= BROADCAST_CHARS


def index(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_words, terms and lists of docs (doc_id, key, text), written once.

    terms: the distinct words in order; lists: for each of them its positions, ascending. Pairs of word and position
    are sorted, and cut where the word changes, which takes a document's length times its logarithm.
    """
    words = docs.select("doc_id", "key", words_of(F.col("text")).alias("words"))
    pairs = F.sort_array(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))))
    sorted_ = words.select("doc_id", "key", F.size("words").alias("n_words"), pairs.alias("pairs"))

    def word(i: Column) -> Column:
        return F.get("pairs", i)["word"]

    every = F.when(F.col("n_words") > 0, F.sequence(F.lit(0), F.col("n_words") - 1)).otherwise(F.array().cast("array<int>"))
    firsts = sorted_.select("*", F.filter(every, lambda i: (i == 0) | (word(i) != word(i - 1))).alias("firsts"))
    stop = lambda k: F.coalesce(F.get("firsts", k + 1), F.col("n_words")) - 1
    lists = F.transform("firsts", lambda i, k: F.transform(F.sequence(i, stop(k)), lambda j: F.get("pairs", j)["at"]))
    return common.stage(firsts.select("doc_id", "key", "n_words", F.transform("firsts", word).alias("terms"), lists.alias("lists")), "index")


def _each_list(found: DataFrame) -> DataFrame:
    """index() with a row for each term: term, and slot, its place among the lists."""
    # The outer form, as Spark would read the terms twice to leave out empty arrays first.
    return found.select("*", F.posexplode_outer("terms").alias("slot", "term")).where("term is not null")


def term_counts(found: DataFrame, terms: DataFrame) -> DataFrame:
    """term and n, its occurrences in all documents (of index()), for those of the terms that occur."""
    flat = _each_list(found).select("term", F.size(F.get("lists", F.col("slot"))).cast("long").alias("n"))
    if _fits(terms, F.length("term")):
        return flat.join(F.broadcast(terms), "term").groupBy("term").agg(F.sum("n").alias("n"))
    return flat.groupBy("term").agg(F.sum("n").alias("n")).join(terms, "term")


def rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """windows (wid, words, items) whose words all occur: wid, term, offset, rest, length, items.

    term: the rarest word (of ties the first in the window), and its offset. rest: the others' offsets and terms, rarest first.
    """
    flat = windows.select("wid", "words", "items", F.posexplode("words").alias("offset", "term"))
    each = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("offset"), F.col("term"))
    ranked = flat.join(counts, "term", "left").groupBy("wid").agg(F.sort_array(F.collect_list(each)).alias("by"), F.first("items").alias("items"))
    by = F.col("by")
    rest = F.transform(F.slice("by", 2, F.size("by")), lambda x: F.struct(x["offset"].alias("offset"), x["term"].alias("term")))
    return ranked.where(by[0]["n"] > 0).select("wid", by[0]["term"].alias("term"), by[0]["offset"].alias("offset"), rest.alias("rest"), F.size("by").alias("length"), "items")


def _cell(term: Column) -> tuple[Column, Column]:
    """The long and the bit in it that a term has in the filter."""
    h = F.xxhash64(term)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    return F.shiftright(h, 6).bitwiseAND((1 << MASK - 6) - 1), bit


def _may_be_asked(flat: DataFrame, asked: DataFrame) -> DataFrame:
    """Rows of flat without most of those whose term isn't in asked, without a shuffle of them."""
    at, bit = _cell(F.col("term"))
    mask = asked.groupBy(at.alias("at")).agg(F.bit_or(bit).alias("bits"))  # bounded by its number of keys
    return flat.join(F.broadcast(mask), at == F.col("at")).where(F.col("bits").bitwiseAND(bit) != 0).drop("at", "bits")


def _hot(counts: DataFrame) -> DataFrame:
    """term and salts, for the terms with so many occurrences that they are dealt over several tasks."""
    bound = max(HOT, int(SHARE * (counts.agg(F.sum("n")).first()[0] or 0)))
    return counts.where(F.col("n") > bound).select("term", F.ceil(F.col("n") / bound).cast("int").alias("salts"))


def _list_of(term: Column) -> Column:
    """The positions of a term in the row's document, null if it has none."""
    return F.get("lists", (F.array_position("terms", term) - 1).cast("int"))


def postings(found: DataFrame, asked: DataFrame, counts: DataFrame) -> DataFrame:
    """Positions (pos) of the asked terms: doc_id, key, n_words, terms, lists, pos, and the columns of asked.

    found: index(). asked: rarest(). counts: term_counts().
    """
    kept = ["doc_id", "key", "n_words", "terms", "lists"]
    size = F.length(F.concat_ws(" ", "rest.term")) + F.length("term") + 20 * F.size("items")
    if _fits(asked, size):
        met = _each_list(found).join(F.broadcast(asked), "term").withColumn("at", F.get("lists", F.col("slot")))
        return met.select(*kept, *asked.columns, F.explode("at").alias("pos"))
    hot, salts = F.broadcast(_hot(counts)), F.coalesce("salts", F.lit(1))  # 1 / SHARE rows at most
    salted = asked.join(hot, "term", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    once = found.dropDuplicates(["doc_id", "key"]) if common.repeats(found, "doc_id", "key") else found
    dealt = _may_be_asked(_each_list(once), asked).join(hot, "term", "left")
    dealt = dealt.select(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), "term", F.get("lists", F.col("slot")).alias("at"), F.pmod(F.xxhash64("key"), salts).cast("int").alias("salt"))
    may = dealt.join(salted, ["term", "salt"]).drop("salt")
    met = may.join(once, (F.col("of_key") == F.col("key")) & F.col("of_id").eqNullSafe(F.col("doc_id")))
    return met.select(*kept, *asked.columns, F.explode("at").alias("pos"))


def _asked(windows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The windows (wid, words, items) under their rarest terms, and term_counts() of all their words."""
    terms = common.stage(windows.select(F.explode("words").alias("term")).distinct(), "terms")
    counts = common.stage(term_counts(found, terms), "counts")
    return common.stage(rarest(windows, counts), "asked"), counts


def phrase_matches(found: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, key, n_words, and found: array of (start, length, items) of the windows that a document holds.

    windows: words, items, with at most WINDOW words each. found: index() of the documents.
    """
    windows = common.stage(windows.select(F.concat_ws(" ", "words").alias("wid"), "words", "items"), "windows")
    at = postings(found, *_asked(windows, found))
    start = F.col("pos") - F.col("offset")

    def holds(other: Column) -> Column:
        """Whether the list of another word, shifted by its offset, holds the start."""
        return F.coalesce(F.array_contains(_list_of(other["term"]), start + other["offset"]), F.lit(False))

    # Code is generated for the rarest of the others, so that documents are copied only for the few postings that go on.
    second = F.get("rest", F.lit(0))
    at = at.where(second.isNull() | holds(second))
    # Not a filter, which Spark would put into the one above; nulls aren't collected.
    whole = F.when(F.forall(F.slice("rest", 2, WINDOW), holds), F.struct(start.alias("start"), "length", "items"))
    held = at.select("doc_id", "key", "n_words", whole.alias("found")).groupBy("doc_id", "key", "n_words")
    return held.agg(F.array_distinct(F.collect_list("found")).alias("found")).where("size(found) > 0")


def proximity_matches(docs: DataFrame, queries: DataFrame, within: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, query_id, pos: where all words of a query (query_id, words) lie, in any order, at most `within`
    words from its rarest word, whose position pos is. Null texts hold no words; a query of no words has no match.
    """
    found = index(_sources(docs, text, doc_id))
    asked = queries.select("query_id", F.array_distinct("words").alias("words")).where("size(words) > 0")
    asked = common.stage(asked.select(F.col("query_id").alias("wid"), "words", F.array("query_id").alias("items")), "queries")
    at = postings(found, *_asked(asked, found))
    near = F.forall("rest", lambda r: F.coalesce(F.exists(_list_of(r["term"]), lambda q: F.abs(q - F.col("pos")) <= within), F.lit(False)))
    return at.where(near).select("doc_id", F.col("items")[0].alias("query_id"), "pos")


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _sources(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows are told apart by id and text: repeated rows share a result, other texts of the same id don't mix."""
    rows = common.pick(docs, doc_id=doc_id, text=text)
    return rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _key(F.col("text")).alias("key"))


def _hits(found: DataFrame, items: DataFrame, item_text: str, item_id: str) -> DataFrame:
    """of_id, of_key, hit_words, n_hit, items of the documents that hold a window."""
    per_doc = phrase_matches(found, item_windows(items, item_text, item_id))
    spans = F.array_sort(F.transform("found", lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["length"]).alias("stop"))))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))
    covered = F.aggregate(spans, zero, lambda a, x: F.struct((a["n"] + F.greatest(x["stop"] - F.greatest(x["start"], a["stop"]), F.lit(0))).alias("n"), F.greatest(a["stop"], x["stop"]).alias("stop")))
    names = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda x: F.transform(x["items"], lambda i: i.cast("string"))))))
    return per_doc.select(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), F.col("n_words").alias("hit_words"), covered["n"].cast("long").alias("n_hit"), names.alias("items"))


def _contaminated(hit: Column, words: Column) -> Column:
    return (hit > 0) & (20 * hit >= words)


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated: one row per row of docs.

    A word inside any occurrence of a benchmark window is hit; contaminated: hit words are some and at least a
    twentieth. Null texts have no words and aren't contaminated; nor is anything if there are no items. Repeated
    rows have repeated results; items of the same text are all reported; null item ids are passed over.
    """
    found = index(_sources(docs, text, doc_id))
    hits = _hits(found, items, item_text, item_id)
    counted = found.select("doc_id", "key", F.col("n_words").cast("long").alias("n_words"))
    joined = counted.join(hits, counted["doc_id"].eqNullSafe(hits["of_id"]) & (counted["key"] == hits["of_key"]), "left")
    hit, names = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("doc_id", "n_words", hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), names.alias("items"), _contaminated(hit, F.col("n_words")).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """docs without contaminated rows, by the rules of contamination(); all columns stay."""
    bad = _hits(index(_sources(docs, text, doc_id)), items, item_text, item_id).where(_contaminated(F.col("n_hit"), F.col("hit_words")))
    bad = common.stage(bad.select(F.col("of_id").alias("__id"), F.col("of_key").alias("__of")), "contaminated")
    keyed = docs.withColumn("__key", _key(docs[f"`{text}`"]))
    return keyed.join(common.small(bad), F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__of")), "left_anti").drop("__key")


def op7_contamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark words in every document."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = contamination(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP7_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
v as (select distinct item_id, array_to_string(w[i : i + 12], ' ') as win, least(len(w), 13) as n
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from v),
g as (select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
m as (select g.doc_id, g.i, g.n, v.item_id from g join v on g.win = v.win and g.n = v.n),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from m) group by doc_id),
k as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names from m group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(k.n_items, 0) as n_items,
  sha256(coalesce(k.names, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.w) as contaminated
from d left join h on d.doc_id = h.doc_id left join k on d.doc_id = k.doc_id
"""
