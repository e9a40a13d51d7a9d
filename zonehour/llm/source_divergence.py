"""Source divergence audit by pair tasks over sorted sparse arrays.

Within a language, two sources are apart by the sum over all kept terms of the
difference of the term's smoothed shares. A source is an array of (term id,
count), sorted by id and cut into blocks of ids. A task co-groups two groups'
blocks, intersects each pair of arrays by galloping and prices the overlap,
the terms of one side and, at the end, those that both lack.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonehour.llm.common import stored
from zonehour.operators.positions import dense_positions

SCALE = 10**9
# byte -> itself for a letter's byte, A-Z lower-cased, else a space
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BATCH_BYTES = 8 << 20  # of texts counted at once; a longer text is counted alone


@dataclass(frozen=True)
class DivergenceSpec:
    """A language keeps the terms in ``min_docs`` of its documents. ``smooth``
    is added to every count. ``top`` terms are reported per group. A block
    holds ``block_terms`` ids, a task ``tile`` sources a side on average."""

    min_docs: int = 30
    smooth: int = 5
    top: int = 50
    block_terms: int = 4096
    tile: int = 64


def count_batch(texts: pa.Array, groups: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Group, term, occurrences and documents of the terms of ``texts`` (bytes)."""
    found = [x.translate(LETTERS).split() if x else [] for x in texts.to_pylist()]
    sizes = np.array([len(x) for x in found], np.int64)
    words = pa.array([w for x in found for w in x], pa.binary()).dictionary_encode()
    codes, n_terms = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(words.dictionary))
    doc = np.repeat(np.arange(len(found)), sizes)
    pairs, times = np.unique(doc * n_terms + codes, return_counts=True)
    keys, at = np.unique(groups[pairs // n_terms] * n_terms + pairs % n_terms, return_inverse=True)
    n = np.bincount(at, weights=times, minlength=len(keys)).astype(np.int64)
    return keys // n_terms, words.dictionary.take(pa.array(keys % n_terms)).cast(pa.string()), n, np.bincount(at, minlength=len(keys))


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs of whole texts, summed in
    each task and then by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch.select(["lang", "source"])])
            names = table.group_by(["lang", "source"]).aggregate([])
            number = {(a, b): k for k, (a, b) in enumerate(zip(names["lang"].to_pylist(), names["source"].to_pylist()))}
            groups = np.array([number[x] for x in zip(table["lang"].to_pylist(), table["source"].to_pylist())], np.int64)
            texts = batch.column("text").cast(pa.large_binary())
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < len(batch):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BATCH_BYTES, "right")))
                group, term, n, n_docs = count_batch(texts.slice(lo, hi - lo), groups[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [*[names[c].combine_chunks().take(pa.array(group)) for c in ("lang", "source")], term, pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )
                lo = hi

    long = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return long.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column, smooth: int) -> Column:
    """1 + floor(SCALE * (count + smooth) / (total + smooth * terms)), exact."""
    top = (count + smooth).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + terms * smooth).cast("decimal(19,0)")
    return F.try_divide(top - top % F.nullif(bottom, F.lit(0)), bottom).cast("long") + 1


def shares(counts: np.ndarray, total: int, terms: int, smooth: int) -> np.ndarray:
    """The same of an array, by long division in steps of 1000: no product
    leaves 64 bits while total + smooth * terms is below 9e15."""
    bottom = total + smooth * terms
    rest, out = counts.astype(np.int64) + smooth, 0
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // bottom
        rest = rest % bottom
    return out + 1


def gallop(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """For each of the sorted ``small`` the place of the first of the sorted
    ``large`` not below it. Steps double until they pass it, then halve."""
    at = np.zeros(len(small), np.int64)
    step = 1
    while step <= len(large):
        step *= 2
    while step := step // 2:
        ahead = at + step
        at = np.where((ahead <= len(large)) & (large[np.minimum(ahead, len(large)) - 1] < small), ahead, at)
    return at


def price(a: tuple, b: tuple) -> tuple[int, int]:
    """Sum of the differences over the terms that a or b holds, and how many
    these are. A side is its ids, their shares and the share of an absent
    term."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (ids, p, p0), (other, q, q0) = a, b
    if not len(other):
        return 0, 0
    at = gallop(ids, other)
    hit = at < len(other)
    hit[hit] = other[at[hit]] == ids[hit]
    met = at[hit]
    both, one = np.abs(p[hit] - q[met]).sum(), np.abs(p[~hit] - q0).sum()
    rest = np.abs(q - p0).sum() - np.abs(q[met] - p0).sum()
    return int(both + one + rest), len(ids) + len(other) - len(met)


def pair_sums(arrays: DataFrame, spec: DivergenceSpec) -> DataFrame:
    """lang, a, b (a before b), priced and present of every two sources of a
    language, summed over its blocks. ``arrays`` has lang, source, total,
    terms, tiles, block, ids and counts."""
    smooth = spec.smooth

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        same = key[2].as_py() == key[3].as_py()

        def sides(table: pa.Table) -> list[tuple]:
            out = []
            for r in table.sort_by("source").to_pylist():
                counts = np.array(r["counts"] + [0], np.int64)
                p = shares(counts, r["total"], r["terms"], smooth)
                out.append((r["source"], (np.array(r["ids"], np.int64), p[:-1], p[-1])))
            return out

        ls = sides(left)
        rs = ls if same else sides(right)
        rows = []
        for k, (a, x) in enumerate(ls):
            for b, y in rs[k + 1 :] if same else rs:
                rows.append((key[0].as_py(), min(a, b), max(a, b), *price(x, y)))
        columns = list(zip(*rows)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))], ["lang", "a", "b", "priced", "present"])

    tiled = arrays.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")))
    last = F.col("tiles") - 1
    left = tiled.withColumn("i", F.col("tile")).withColumn("j", F.explode(F.sequence("tile", last)))
    tiled = tiled.select(*[F.col(c).alias(c) for c in tiled.columns])  # columns of its own: the cogroup reads both
    right = tiled.withColumn("j", F.col("tile")).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), "tile"))).where("i < j")
    keys = ("lang", "block", "i", "j")
    summed = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "lang string, a string, b string, priced bigint, present bigint")
    return summed.groupBy("lang", "a", "b").agg(F.sum("priced").alias("priced"), F.sum("present").alias("present"))


def audit_sources(docs: DataFrame, spec: DivergenceSpec = DivergenceSpec()) -> DataFrame:
    """lang, source, part, item, value and rank of ``docs`` (text, lang,
    source; other columns are not read).

    Part ``pair``: every other source of the language and how far it is, all
    ranks. Part ``term``: the ``top`` terms that the source holds and uses
    more than its language. Null text, lang and source count as ''. Groups
    without terms take part with count 0 everywhere; a language that keeps no
    term has value 0. Repeated rows count each. Ties rank by item. No rows
    give none.
    """
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stored(count_terms(read), "divergence-counts")
    groups = stored(read.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")), "divergence-groups")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= spec.min_docs)
    terms = dense_positions(stored(kept.drop("docs"), "divergence-terms"), [F.col("lang"), F.col("term")], name="id")
    held = stored(counts.drop("docs").join(terms, ["lang", "term"]), "divergence-held")

    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))
    sources = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / spec.tile).alias("tiles"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    stats = groups.select("lang", "source").join(sources, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    stats = stored(stats.na.fill(0, ["terms", "lang_total", "total"]), "divergence-stats")

    priced = held.join(stats, ["lang", "source"]).select(
        "lang",
        "source",
        F.col("term").alias("item"),
        (share(F.col("n"), F.col("total"), F.col("terms"), spec.smooth) - share(F.col("in_lang"), F.col("lang_total"), F.col("terms"), spec.smooth)).alias("value"),
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    top = priced.where("value > 0").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= spec.top)

    block = F.floor(F.col("id") / spec.block_terms)
    entries = held.groupBy("lang", "source", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries"))
    blocks = terms.select("lang", block.alias("block")).distinct()
    arrays = stats.join(blocks, "lang").join(entries, ["lang", "source", "block"], "left")
    arrays = arrays.select("lang", "source", "total", "terms", "tiles", "block", *[F.coalesce(F.col(f"entries.{c}"), F.array().cast("array<bigint>")).alias(name) for c, name in (("id", "ids"), ("n", "counts"))])
    sums = pair_sums(arrays, spec)

    one, two = stats.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "terms"), stats.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    absent = F.abs(share(F.lit(0), F.col("total_a"), F.col("terms"), spec.smooth) - share(F.lit(0), F.col("total_b"), F.col("terms"), spec.smooth))
    apart = F.when(F.col("terms") > 0, F.col("priced") + (F.col("terms") - F.col("present")) * absent).otherwise(0)
    pairs = one.join(two, "lang").where("a < b").join(sums, ["lang", "a", "b"], "left").select("lang", "a", "b", apart.cast("long").alias("value"))
    pairs = stored(pairs, "divergence-pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    apart_ranked = both.withColumn("rank", F.row_number().over(ranked))
    out = ("lang", "source", "part", "item", "value", "rank")
    return apart_ranked.withColumn("part", F.lit("pair")).select(*out).unionByName(top.withColumn("part", F.lit("term")).select(*out))
