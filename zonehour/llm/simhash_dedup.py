"""Near-duplicates by SimHash and an inverted index of fingerprint bytes.

A fingerprint has 8 positional bytes. Two fingerprints that differ in up to
d bits share at least 8 - d of them. The index lists distinct fingerprints
under every choice of 8 - d byte positions with their values, so a pair that
reaches this count meets in a list, and a list holds at most 256**d
fingerprints, as they can differ in d bytes only. Within a list the bits of
these d bytes are compared by trying the few masks of up to d set bits, not
by pairs, and only a spanning forest of the links goes on: components come
out whole without all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonehour.llm.common import stored, text_bytes
from zonehour.llm.components import connected_components

BYTES = 8


def simhash(words: list[bytes], shingle: int) -> int:
    """64 bits, each set if set in over half of the shingles' XXH64 hashes
    (seed 42), repeats included; 0 without words."""
    import xxhash

    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash_of(b" ".join(words), 42)
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, 50_000):
        part = words[at : at + 50_000 + shingle - 1]
        h = np.array([hash_of(b" ".join(x), 42) for x in zip(*(part[k:] for k in range(shingle)))], dtype=">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """``docs`` with fp (the fingerprint as a signed bigint) added."""
    schema = docs.select("*", F.lit(None).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.lower() and bytes.split() treat ASCII only: A-Z, and space and \t to \r
            fp = [simhash(x.lower().split(), shingle) if x else 0 for x in text_bytes(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(fp, np.uint64).view(np.int64))], names=[*batch.schema.names, "fp"])

    return docs.mapInArrow(run, schema)


def list_links(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of the sorted distinct ``values``) of a spanning forest of
    the links between values that differ in up to ``bits`` bits."""
    width = max(1, int(np.bitwise_or.reduce(values)).bit_length())
    masks = [sum(1 << b for b in c) for k in range(1, bits + 1) for c in combinations(range(width), k)]
    if len(values) <= len(masks):
        i, j = np.triu_indices(len(values), 1)
        close = np.bitwise_count(values[i] ^ values[j]) <= bits
        i, j = i[close], j[close]
    else:
        found = []
        for mask in masks:
            other = values ^ values.dtype.type(mask)
            at = np.minimum(np.searchsorted(values, other), len(values) - 1)
            hit = np.flatnonzero((values[at] == other) & (values < other))
            found.append((hit, at[hit]))
        i, j = (np.concatenate(x) for x in zip(*found))
    root = np.arange(len(values))
    keep = []
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        while root[b] != b:
            root[b] = root[root[b]]
            b = root[b]
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(k)
    return i[keep], j[keep]


def near_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """u, v: links between the fingerprints of ``distinct`` (fp) that differ
    in up to ``max_bits`` (1 to 4) bits, as a spanning forest of each list of
    the index; together they connect what all links connect."""
    choices = list(combinations(range(BYTES), BYTES - max_bits))
    keep = [sum(0xFF << 8 * b for b in c) for c in choices]
    signed = [k - (1 << 64) if k >> 63 else k for k in keep]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(k)).alias("shared")) for i, k in enumerate(signed)])).alias("key")
    lists = distinct.select("fp", keys).groupBy("key.choice", "key.shared").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for choice, fps in zip(batch.column("choice").to_pylist(), batch.column("fps")):
                fps = np.sort(np.asarray(fps.values, np.int64).view(np.uint64))
                # the bytes that may differ, side by side
                rest, shift = np.zeros(len(fps), np.uint64), 0
                for b in range(BYTES):
                    if b not in choices[choice]:
                        rest |= (fps >> np.uint64(8 * b) & np.uint64(0xFF)) << np.uint64(shift)
                        shift += 8
                order = np.argsort(rest)
                i, j = list_links(rest[order], max_bits)
                u.append(fps[order[i]])
                v.append(fps[order[j]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], names=["u", "v"])

    return lists.mapInArrow(run, "u bigint, v bigint").distinct()


def fingerprint_groups(distinct: DataFrame, max_bits: int) -> DataFrame:
    """fp and grp (a fingerprint of its component) of every row of
    ``distinct`` (fp, without repeats)."""
    linked = stored(connected_components(near_links(distinct, max_bits)), "simhash-groups")
    return distinct.select("fp").join(linked.select(F.col("node").alias("fp"), F.col("component").alias("found")), "fp", "left").select("fp", F.coalesce("found", "fp").alias("grp"))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id
    reachable over links of up to ``max_bits`` bits) per row of ``docs``
    (doc_id, text).

    A null, empty or blank text has fingerprint zero, which links like any
    other. Repeated rows are all returned. A null doc_id counts for no
    component's least id (null if all are null). Other columns are ignored.
    """
    rows = stored(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle).drop("text"), "simhash-rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    groups = stored(fingerprint_groups(distinct, max_bits), "simhash-members").join(distinct, "fp")
    least = groups.groupBy("grp").agg(F.min("least").alias("component_id"))
    found = stored(groups.join(least, "grp").select("fp", "component_id"), "simhash-components")
    return rows.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, one of each near-duplicate component: that of the
    least doc_id (a null id last), of equal ids any one. All columns are kept
    as they are."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = fingerprints(packed, shingle).select("row", "doc_id", "fp", F.monotonically_increasing_id().alias("id"))
    rows = stored(marked, "simhash-docs", "zstd")
    distinct = stored(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id")).alias("first")), "simhash-distinct")
    groups = fingerprint_groups(distinct, max_bits)
    winners = distinct.join(groups, "fp").groupBy("grp").agg(F.min("first").alias("first")).select("first.id")
    return rows.join(stored(winners, "simhash-winners").hint("merge"), "id", "left_semi").select("row.*")
