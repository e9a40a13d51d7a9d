"""Vector code compression by active-entry Lloyd.

Vectors are cut into parts, each coded by the nearest entry of its part's
codebook. Each round assigns all parts and moves the entries to their parts'
means. A part whose entry did not move compares only the moved entries with
its stored exact distance; every other part is scanned completely. Ties go to
the lower index either way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from zonehour.llm.common import stored

MOST = 2**63 - 1  # a distance that leaves 64 bits
OWN = ("code", "error")


@dataclass(frozen=True)
class CodeSpec:
    """Components are floor(``scale`` * x). ``entries`` (256 at most) a
    codebook, seeded by the vectors of the smallest ids."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


def whole(x: np.ndarray) -> np.ndarray:
    """The integers of ``x`` as Python's, of any size."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` (whole doubles) and of
    ``entries`` (Python integers), by the fastest numbers that hold them."""
    most = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    bound = 4 * most * most * x.shape[1]
    if bound < 2**53:
        c = entries.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None]).astype(np.int64)
    kind = np.int64 if bound < 2**63 else object
    d = (x.astype(np.int64) if kind is np.int64 else whole(x))[:, None, :] - entries.astype(kind)[None]
    return (d * d).sum(2)


def nearest(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first least of each row, and the least, at most MOST."""
    at = d.argmin(1)
    least = d[np.arange(len(d)), at]
    return at, np.minimum(least, MOST).astype(np.int64)


def assign_part(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, far: np.ndarray) -> None:
    """Writes the nearest entry and its distance of each row into ``code`` and
    ``far``, which hold those before ``moved`` entries moved."""
    stale = moved[code] | (far == MOST)
    if stale.any():
        code[stale], far[stale] = nearest(distances(x[stale], entries))
    active, fixed = np.flatnonzero(moved), ~stale
    if len(active) and fixed.any():
        at, least = nearest(distances(x[fixed], entries[active]))
        at, old, was = active[at], code[fixed], far[fixed]
        better = (least < was) | (least == was) & (at < old)
        code[fixed], far[fixed] = np.where(better, at, old), np.where(better, least, was)


class Codebooks:
    """The entries by part, as Python integers, and which moved last."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries
        self.moved = [np.ones(len(e), bool) for e in entries]

    def move(self, totals: dict[tuple[int, int, int], int]) -> Codebooks:
        """Entries at the floor of their parts' mean; unused ones stay.
        ``totals`` has the sum by part, entry and position, and at -1 the
        count."""
        new = [e.copy() for e in self.entries]
        for (part, entry, at), total in totals.items():
            if at >= 0:
                new[part][entry, at] = total // totals[part, entry, -1]
        out = Codebooks(new)
        out.moved = [(a != b).any(1) for a, b in zip(new, self.entries)]
        return out


def vectors_of(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def lists(values: np.ndarray) -> pa.ListArray:
    n, m = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m, pa.int32()), pa.array(values.ravel()))


def assigned(rows: DataFrame, books: Codebooks, spec: CodeSpec, dim: int, first: bool) -> DataFrame:
    """``rows`` (row, vector, and unless ``first`` codes and far) with the
    codes and distances by ``books``; the vectors become whole numbers."""
    d, scale = dim // spec.parts, float(spec.scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = vectors_of(batch, dim), len(batch)
            if first:
                x = np.floor(x * scale)
                codes, far = np.zeros((n, spec.parts), np.int64), np.full((n, spec.parts), MOST)
            else:
                codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, spec.parts).astype(np.int64)
                far = batch.column("far").flatten().to_numpy(zero_copy_only=False).reshape(n, spec.parts).copy()
            for p in range(spec.parts):
                code, least = codes[:, p].copy(), far[:, p].copy()
                assign_part(x[:, p * d : p * d + d], books.entries[p], books.moved[p], code, least)
                codes[:, p], far[:, p] = code, least
            packed = codes.astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists(x), pa.array([r.tobytes() for r in packed], pa.binary()), lists(far)], ["row", "vector", "codes", "far"])

    kind = StructType([rows.schema["row"], StructField("vector", ArrayType(DoubleType())), StructField("codes", BinaryType()), StructField("far", ArrayType(LongType()))])
    return stored(rows.mapInArrow(run, kind), "vector-codes")


def totals(rows: DataFrame, spec: CodeSpec, dim: int) -> dict[tuple[int, int, int], int]:
    """Sum by part, entry and position, and at -1 the count: summed in each
    task, then over the tasks; parts * entries * (positions + 1) numbers."""
    d = dim // spec.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((spec.parts, spec.entries, d + 1), object)
        for batch in batches:
            x, n = vectors_of(batch, dim), len(batch)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, spec.parts).astype(np.int64)
            exact = np.abs(x).max(initial=0) * n < 2**53
            for p in range(spec.parts):
                code = codes[:, p]
                sums[p, :, d] += np.bincount(code, minlength=spec.entries)
                if exact:
                    for k in range(d):
                        sums[p, :, k] += np.bincount(code, weights=x[:, p * d + k], minlength=spec.entries).astype(np.int64)
                else:
                    np.add.at(sums[p, :, :d], code, whole(x[:, p * d : p * d + d]))
        used = np.argwhere(sums[:, :, d] > 0)
        out = [(int(p), int(e), k if k < d else -1, int(sums[p, e, k])) for p, e in used for k in range(d + 1)]
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0)))], ["part", "entry", "at", "total"])

    parts = rows.select("vector", "codes").mapInArrow(run, "part int, entry int, at int, total decimal(38,0)")
    return {(r.part, r.entry, r.at): int(r.total) for r in parts.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect()}


def compress_vectors(table: DataFrame, vector: str, key: str, spec: CodeSpec = CodeSpec()) -> tuple[DataFrame, list[np.ndarray]]:
    """The other columns of ``table`` with ``code`` (hex, two digits a part)
    and ``error`` (squared distances summed), and the codebooks by part.

    Dropped are rows whose vector is null or empty, holds null, NaN or an
    infinite component (also after scaling), or is not as long as that of the
    smallest ``key``, which counts only if it can be cut into equal parts.
    Seeds are the smallest keys, null last, equal keys by their vectors; fewer
    rows than entries give smaller codebooks. Columns named code or error are
    replaced. An error beyond 64 bits is given as 2**63 - 1. No rows give none.
    """
    if not 1 <= spec.entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    others = [c for c in table.columns if c not in (*OWN, vector)]
    rows = table.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x * F.lit(float(spec.scale))) < F.lit(math.inf)))
    kept = rows.where((F.size("vector") > 0) & (F.size("vector") % spec.parts == 0) & finite)
    order = [F.col("key").asc_nulls_last(), F.col("vector")]
    smallest = kept.orderBy(*order).limit(1).collect()
    dim = len(smallest[0].vector) if smallest else spec.parts
    kept = kept.where(F.size("vector") == dim)
    seeds = [[math.floor(x * spec.scale) for x in r.vector] for r in kept.orderBy(*order).limit(spec.entries).select("vector").collect()]
    d = dim // spec.parts
    whole_seeds = np.array(seeds, object).reshape(len(seeds), dim)
    books = Codebooks([whole_seeds[:, p * d : p * d + d].copy() for p in range(spec.parts)])
    state = assigned(kept.select("row", "vector"), books, spec, dim, first=True)
    for _ in range(spec.rounds):
        books = books.move(totals(state, spec, dim))
        state = assigned(state, books, spec, dim, first=False)
    error = F.least(F.aggregate("far", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    coded = state.select(*[F.col("row").getField(c).alias(c) for c in others], F.lower(F.hex("codes")).alias("code"), error.alias("error"))
    return coded, books.entries
