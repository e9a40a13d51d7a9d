"""Mixing sources to target weights by hash-threshold histograms.

Each source has a target of words. Whole copies of it come first; of what is
left, a document is taken once more if its hash lies below its source's
threshold. The threshold is found by counting words per source and range of
hashes, and refining only the range that holds the boundary. No document is
sorted, and a larger budget takes a superset.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonehour.llm.common import joined_small, stored
from zonehour.operators.positions import dense_positions

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, NUMBER_BITS, LEVEL_BITS = 60, 63, 12
OWN = ("size", "hash", "source_size", "target", "copies")


@dataclass(frozen=True)
class MixSpec:
    """``weights`` are dealt to the sources in code point order (null last)
    and repeat. The mix has ``share`` times the words of all sources, and at
    most ``most`` times (a whole number) those of any one."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most: int = 2


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source) with ``size``, the words of the whole
    text (null: 0), and ``hash``, 60 bits of the id and the text."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return docs.withColumns(
        {
            "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
            "hash": F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long"),
        }
    )


def source_targets(sizes: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """``sizes`` (source, source_size), one row per source, with ``target``.

    Targets share ``share`` of all sizes by weight. A target beyond ``most``
    of its source's size stops there, and the excess goes to the others by
    weight until none is above. Each round is one sum over the table; only
    three numbers of it come to the driver.
    """
    weights = F.array(*[F.lit(float(w)) for w in spec.weights])
    ranked = dense_positions(sizes, [F.col("source").asc_nulls_last()])
    weighed = stored(ranked.select("source", "source_size", F.get(weights, (F.col("position") % len(spec.weights)).cast("int")).alias("weight")), "mix-sources")
    limit = F.col("source_size") * F.lit(float(spec.most))
    level, before = 0.0, -1.0
    while level != before:
        full = F.col("weight") * level > limit
        everything, held, weight = weighed.agg(F.sum("source_size"), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        before, level = level, (spec.share * (everything or 0) - (held or 0.0)) / weight if weight else level
    return weighed.select("source", "source_size", F.least(limit, F.col("weight") * level).alias("target"))


def shares(bits: int) -> list[int]:
    """The shifts that cut a key of ``bits`` bits into levels, top first."""
    return [max(0, bits - LEVEL_BITS * (k + 1)) for k in range(-(-bits // LEVEL_BITS))]


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source of ``budgets`` (source, rest) the boundary row: cut_hash,
    cut_number and whether it is taken itself; no row where all are.

    ``rows`` are stored (source, size, hash, number). In the order of hash and
    number, a row is taken if the sizes before it and half its own are within
    ``rest``. Rows are counted by source and range of the hash; the first
    range that is not taken whole is refined by the next bits, over its rows
    alone, and at last by the row's number, which only parts rows of one hash.
    """
    edges, found = stored(budgets, "mix-edges"), None
    by_hash = Window.partitionBy("source").orderBy("range")
    for key, shift in [("hash", s) for s in shares(HASH_BITS)] + [("number", s) for s in shares(NUMBER_BITS)]:
        counted = rows.groupBy("source", F.shiftright(key, shift).alias("range")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.min("hash").alias("cut_hash"), F.min("number").alias("cut_number")
        )
        summed = joined_small(counted.withColumn("before", F.sum("words").over(by_hash) - F.col("words")), edges, "source", "range")
        over = summed.where(F.col("before") + F.col("words") > F.col("rest"))
        least = over.groupBy("source").agg(F.min_by(F.struct("range", "before", "words", "n", "cut_hash", "cut_number", "rest"), "range").alias("edge"))
        edge = stored(least.select("source", "edge.*"), "mix-ranges")
        alone = edge.where("n = 1").select("source", "cut_hash", "cut_number", (F.col("before") + F.col("words") / 2 <= F.col("rest")).alias("taken"))
        found = alone if found is None else found.unionByName(alone)
        edges = stored(edge.where("n > 1").select("source", "range", (F.col("rest") - F.col("before")).alias("rest")), "mix-edges")
        if edges.isEmpty():
            break
        inside = joined_small(rows, edges.select("source", "range"), "source", "hash").where(F.shiftright(key, shift) == F.col("range"))
        rows, edges = stored(inside.drop("range"), "mix-boundary"), edges.drop("range")
    return stored(found, "mix-thresholds")


def mix_sources(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """``docs`` (source, size and hash as in ``measured``, and any others) with
    ``source_size``, ``target`` and ``copies``, how often the mix takes the row.

    Every row is returned, those not taken with 0 copies. ``size`` times
    ``copies`` sums up to a source's target within half a row's size. Columns
    of these names are replaced, others pass through. A null source is a
    source, the last in order. Rows without words change nothing. Reruns take
    the same rows; of rows that are equal in id and text, the same number. No
    rows give none.
    """
    others = [c for c in docs.columns if c not in OWN]
    rows = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col("source").cast("string").alias("source"), "size", "hash", F.monotonically_increasing_id().alias("number")
        ),
        "mix-rows",
    )
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(spec.most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int")
    plan = stored(source_targets(sizes, spec).withColumn("whole", whole), "mix-plan")
    budgets = plan.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"))
    cuts = thresholds(rows.where("size > 0").select("source", "size", "hash", "number"), budgets)
    plan = stored(joined_small(plan, cuts, "source", "source"), "mix-plan")
    here = (F.col("hash") == F.col("cut_hash")) & (F.col("number") == F.col("cut_number"))
    below = (F.col("hash") < F.col("cut_hash")) | (F.col("hash") == F.col("cut_hash")) & (F.col("number") < F.col("cut_number"))
    once = F.when(F.col("cut_hash").isNull(), F.col("target") > F.col("whole") * F.col("source_size")).otherwise(below | here & F.col("taken"))
    mixed = joined_small(rows, plan, "source", "hash").withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + once.cast("int")).otherwise(0))
    return mixed.select(*[F.col("row").getField(c).alias(c) for c in others], *OWN)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of ``mix_sources`` as often as it is taken."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
