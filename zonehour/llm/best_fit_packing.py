"""Conflict-constrained best-fit packing of documents into fixed-size bins.

A text counts one token per UTF-8 byte (the ids of a byte-level model) and
one end token. Texts over the capacity are cut into pieces. Pieces are dealt
at random into packing groups of a bounded size; inside a group, longest
first, each piece goes to the tightest open bin that holds neither its
source nor its duplicate cluster yet.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonehour.llm.common import stored

SCHEMA = "bin_id bigint, slot int, doc_id bigint, piece bigint, start bigint, n_tokens bigint, bin_offset bigint"


def pack(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int, int]]:
    """Best-fit in the given order: (bin, slot, offset in the bin) per item.

    Bins are kept by residual; at one residual, bins with the same source and
    cluster bitmaps are alike and share a stack. The successor search begins
    at the least residual that holds the item and goes on until a compatible
    bin is found, so the result is the tightest compatible bin; of several
    such, one whose bitmaps came up first. None is no source, no cluster.
    """
    source_bit = {s: 1 << k for k, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    seen: set = set()
    twice = dict.fromkeys(c for c in clusters if c is not None and (c in seen or seen.add(c)))
    cluster_bit = {c: 1 << k for k, c in enumerate(twice)}  # a cluster met once can't conflict
    open_bins: list[dict] = [{} for _ in range(capacity + 1)]
    residuals = 0  # bit r: some open bin has residual r
    filled: list[int] = []  # slots used, by bin
    out = []
    for n, s, c in zip(lengths, sources, clusters):
        bits = source_bit.get(s, 0), cluster_bit.get(c, 0)
        found, rest = None, residuals >> n
        at = n - 1
        while rest:
            step = (rest & -rest).bit_length()
            at, rest = at + step, rest >> step
            found = next((k for k in open_bins[at] if not (k[0] & bits[0] or k[1] & bits[1])), None)
            if found is not None:
                break
        if found is None:
            at, have, number = capacity, (0, 0), len(filled)
            filled.append(0)
        else:
            stack, have = open_bins[at][found], found
            number = stack.pop()
            if not stack:
                del open_bins[at][found]
                if not open_bins[at]:
                    residuals &= ~(1 << at)
        out.append((number, filled[number], capacity - at))
        filled[number] += 1
        if left := at - n:
            open_bins[left].setdefault((have[0] | bits[0], have[1] | bits[1]), []).append(number)
            residuals |= 1 << left
    return out


def best_fit_packing(docs: DataFrame, capacity: int = 8192, cluster: Column | None = None, group_pieces: int = 4096, clusters: DataFrame | None = None) -> DataFrame:
    """Pack ``docs`` (doc_id, text, source) into bins of ``capacity`` tokens.

    One row per piece: bin_id, slot and bin_offset (place in the bin), doc_id,
    piece, start (first token of the piece in its document), n_tokens. No bin
    holds two pieces of one source or of one duplicate cluster. ``cluster``
    is the cluster id (default: a hash of the text, so exact copies conflict);
    ``clusters`` (hash, cluster) has another id for some of these hashes.

    Every row is packed, repeated rows and rows with a null doc_id too. A null
    or empty text is its end token alone. A null source or cluster (the
    default cluster of a null text) conflicts with nothing. Equal lengths go
    in a fixed random order. Groups hold about ``group_pieces`` pieces, drawn
    by a hash of the row's number, whatever the sources, so a hot source is
    spread over all groups.
    """
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            (F.xxhash64("text") if cluster is None else F.xxhash64(cluster)).alias("hash"),
            (F.col("text") if cluster is None else cluster).isNull().alias("alone"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("n"),
        ),
        "packing-rows",
    )
    if clusters is not None:
        found = clusters.select("hash", F.col("cluster").alias("found"))
        rows = stored(rows.join(found, "hash", "left").withColumn("hash", F.coalesce("found", "hash")).drop("found"), "packing-clusters")
    cap = F.lit(capacity)
    pieces = rows.select(
        "row",
        "doc_id",
        "source",
        F.when(~F.col("alone"), F.col("hash")).alias("cluster"),
        "n",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / cap))).alias("piece"),
    ).select("row", "doc_id", "source", "cluster", "piece", (F.col("piece") * cap).alias("start"), F.least(cap, F.col("n") - F.col("piece") * cap).alias("n_tokens"))
    total = rows.agg(F.sum(F.ceil(F.col("n") / cap))).first()[0] or 0
    groups = max(1, math.ceil(total / group_pieces))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_tokens", "descending"), ("order", "ascending"), ("row", "ascending"), ("piece", "ascending")])
        placed = pack(*(table.column(c).to_pylist() for c in ("n_tokens", "source", "cluster")), capacity)
        bins, slots, offsets = zip(*placed)
        number = key[0].as_py() << 32
        return pa.table(
            {
                "bin_id": pa.array([number + b for b in bins], pa.int64()),
                "slot": pa.array(slots, pa.int32()),
                **{c: table.column(c) for c in ("doc_id", "piece", "start", "n_tokens")},
                "bin_offset": pa.array(offsets, pa.int64()),
            }
        )

    return (
        pieces.withColumn("order", F.xxhash64("row", F.lit(2)))
        .withColumn("packing_group", F.pmod(F.xxhash64("row", "piece", F.lit(1)), F.lit(groups)))
        .groupBy("packing_group")
        .applyInArrow(run, SCHEMA)
    )
