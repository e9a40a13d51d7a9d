"""Benchmark decontamination with a positional inverted index, in SQL
functions only.

The index stores a posting (term, document, position) for every document
word that some benchmark item has. Of each item window the rarest terms'
postings are moved back by the terms' offsets in the item; where the moved
lists meet, the document may hold the item's window. Such alignments are
checked word by word against the whole document: runs of equal words that
fill a window are phrase matches.

Proximity matches have candidates of their own. If an item may lack l of its
words, each match holds one of its l + 1 rarest words, those that no document
has included; the text around every posting of these is checked for enough
of the item's words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonehour.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class MatchSpec:
    """``window`` words make a phrase (the whole item if it has fewer).
    ``lists``: postings lists of a window that must meet. ``near_share`` of
    an item's distinct words, in any order, within a stretch of ``slop`` words
    on either side more than the item has are a proximity match. ``block_rows``: terms or anchors that are broadcast
    at a time, and a tenth of the words of items; a benchmark with more takes
    several turns."""

    window: int = 10
    lists: int = 2
    slop: int = 10
    near_share: float = 0.8
    block_rows: int = 20_000


def words_of(text: str) -> Column:
    """The words of a text column: A-Z lower-cased runs of digits, a-z and
    characters beyond ASCII; none for null."""
    return F.filter(F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), NOT_WORD), lambda w: w != "")


def joined_in_blocks(big: DataFrame, small: DataFrame, on: str, size: Column, block_size: int) -> DataFrame:
    """Inner join with a table of a measured size, broadcast in blocks of
    about ``block_size``; ``size`` is that of all rows of a block."""
    blocks = -(-(small.agg(size).first()[0] or 0) // block_size) or 1
    key = F.pmod(F.xxhash64(on), F.lit(blocks))
    out = None
    for k in range(blocks):
        part = big.join(F.broadcast(small.where(key == k)), on)
        out = part if out is None else out.unionByName(part)
    return out


def item_windows(items: DataFrame, df: DataFrame, spec: MatchSpec) -> DataFrame:
    """ino, start and anchors (item position and term of the window's rarest
    terms, ``df`` says how rare) of each window all of whose terms occur."""
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("item_words") - spec.window)))
    places = items.select("ino", "item_words", start.alias("start")).select("ino", "start", F.posexplode(F.slice("item_words", F.col("start") + 1, spec.window)).alias("at", "word"))
    known = places.join(df, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_rarity = F.array_sort(F.collect_list(F.struct("n", (F.col("start") + F.col("at")).alias("ipos"), "word")))
    return known.groupBy("ino", "start").agg(F.slice(by_rarity, 1, spec.lists).alias("anchors")).where("anchors[0].n > 0")


def near_anchors(items: DataFrame, df: DataFrame, spec: MatchSpec) -> DataFrame:
    """word and ino: of each item's distinct words the rarest, one more than a
    proximity match may lack, as far as they occur."""
    known = items.select("ino", F.explode(F.array_distinct("item_words")).alias("word")).join(df, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ranked = known.groupBy("ino").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("terms"))
    lacking = F.size("terms") - near_need(F.size("terms"), spec)
    return ranked.select("ino", F.explode(F.slice("terms", F.lit(1), lacking + 1)).alias("a")).where("a.n > 0").select("a.word", "ino")


def near_need(n_distinct: Column, spec: MatchSpec) -> Column:
    """How many of an item's distinct words a proximity match has."""
    return F.greatest(F.lit(1), F.ceil(spec.near_share * n_distinct).cast("int"))


def match_benchmark(docs: DataFrame, benchmark: DataFrame, spec: MatchSpec = MatchSpec()) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_words, hits (sorted positions of
    the words in phrase matches), item_ids and near_ids (sorted, as strings:
    items with phrase and with proximity matches) added; columns of these
    names are replaced, all others and every row kept.

    ``benchmark`` (item_id, text). Null and empty texts have no words; an item
    without words, and an empty benchmark, match nothing. Words of an item
    with a null id are hit too, but it is in neither list. Repeated rows of
    either table change nothing for the others.
    """
    added = ("n_words", "hits", "item_ids", "near_ids")
    kept = [c for c in docs.columns if c not in added]
    # a document's key; rows alike in id and text match alike and share it
    row = F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in kept if c != "text"])
    keyed = docs.select(row.alias("row"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("h"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of("text").alias("item_words")).where(F.size("item_words") > 0).distinct()
    items = stored(items.withColumn("ino", F.xxhash64("item_id", "item_words")), "benchmark-items")

    # the index
    terms = stored(items.select(F.explode("item_words").alias("word")).distinct(), "benchmark-terms")
    tokens = keyed.select("k", "h", F.posexplode(words_of("text")).alias("pos", "word"))
    index = stored(joined_in_blocks(tokens, terms, "word", F.count("*"), spec.block_rows).select("word", "k", "h", "pos"), "postings")

    # lists of the rarest terms, moved back by their offsets, and where those of a window meet
    df = stored(index.groupBy("word").agg(F.count("*").alias("n")), "term-counts")
    windows = stored(item_windows(items, df, spec), "benchmark-windows")
    anchors = stored(windows.select("ino", F.explode("anchors").alias("a")).select(F.col("a.word").alias("word"), "ino", F.col("a.ipos").alias("ipos")).distinct(), "benchmark-anchors")
    moved = joined_in_blocks(index, anchors, "word", F.count("*"), spec.block_rows).select("k", "h", "ino", (F.col("pos") - F.col("ipos")).alias("diag"), "ipos")
    met = moved.groupBy("k", "h", "ino", "diag").agg(F.collect_set("ipos").alias("found"))
    wanted = windows.groupBy("ino").agg(F.collect_set(F.transform("anchors", lambda a: a["ipos"])).alias("wanted")).join(items, "ino")
    wanted = stored(wanted, "benchmark-wanted")
    words = F.sum(F.size("item_words") + F.lit(spec.lists) * F.size("wanted"))
    aligned = joined_in_blocks(met, wanted, "ino", words, 10 * spec.block_rows).where(F.exists("wanted", lambda w: F.size(F.array_except(w, F.col("found"))) == 0))
    places = aligned.select("k", "h", F.struct("item_id", "diag", "item_words").alias("place"))

    # places of the words one of which a proximity match must hold
    rare = stored(near_anchors(items, df, spec), "benchmark-near-anchors")
    spots = joined_in_blocks(index, rare, "word", F.count("*"), spec.block_rows).groupBy("k", "h", "ino").agg(F.collect_set("pos").alias("at"))
    spots = joined_in_blocks(spots, items, "ino", F.sum(F.size("item_words")), 10 * spec.block_rows)
    spots = spots.select("k", "h", F.struct("item_id", "at", "item_words").alias("spot"))
    places = places.unionByName(spots, allowMissingColumns=True).groupBy("k", "h").agg(F.collect_list("place").alias("places"), F.collect_list("spot").alias("spots"))
    places = stored(places, "alignments")

    # word by word, against the whole text
    def check(a: Column, words: Column) -> Column:
        m = F.size(a["item_words"])
        full = F.least(m, F.lit(spec.window))
        equal = F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.coalesce(F.get(words, a["diag"] + i) == F.get(a["item_words"], i), F.lit(False)))
        starts = F.filter(F.sequence(F.lit(0), m - full), lambda s: F.forall(F.slice(equal, s + 1, full), lambda x: x))
        return F.struct(a["item_id"].alias("item_id"), F.flatten(F.transform(starts, lambda s: F.sequence(a["diag"] + s, a["diag"] + s + full - 1))).alias("hits"))

    def near(a: Column, words: Column) -> Column:
        stretch = F.size(a["item_words"]) + 2 * spec.slop

        def enough(part: Column) -> Column:
            return F.size(F.array_intersect(part, a["item_words"])) >= near_need(F.size(F.array_distinct(a["item_words"])), spec)

        def first(at: Column) -> Column:
            return F.greatest(at - stretch + 1, F.lit(0))

        # all stretches around a place at once, then one by one
        return F.exists(a["at"], lambda at: enough(F.slice(words, first(at) + 1, at - first(at) + stretch)) & F.exists(F.sequence(first(at), at), lambda s: enough(F.slice(words, s + 1, stretch))))

    def ids(column: str, keep) -> Column:
        found = F.filter(column, lambda c: keep(c) & c["item_id"].isNotNull())
        return F.coalesce(F.array_sort(F.array_distinct(F.transform(found, lambda c: c["item_id"]))), F.array().cast("array<string>"))

    both = keyed.withColumn("n_words", F.size(words_of("text")).cast("long")).join(places.hint("merge"), ["k", "h"], "left")
    # split again where there is something to check, once per document
    def judged(words: Column) -> Column:
        return F.struct(F.transform("places", lambda a: check(a, words)).alias("checked"), F.filter("spots", lambda a: near(a, words)).alias("near"))

    judgement = F.when(F.col("places").isNotNull(), F.get(F.transform(F.array(words_of("text")), judged), 0))
    hits = F.array_sort(F.array_distinct(F.flatten(F.transform("checked", lambda c: c["hits"]))))
    return both.select("row", "text", "n_words", judgement.alias("judgement")).select("row", "text", "n_words", "judgement.*").select(
        *[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in kept],
        "n_words",
        F.coalesce(hits, F.array().cast("array<int>")).alias("hits"),
        ids("checked", lambda c: F.size(c["hits"]) > 0).alias("item_ids"),
        ids("near", lambda c: F.lit(True)).alias("near_ids"),
    )
