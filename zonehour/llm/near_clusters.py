"""Near-duplicate clusters of texts: connected components of all pairs whose
sets of word shingles have a Jaccard similarity of at least a bound.

A text of m shingles in such a pair shares at least share * m of them. So a
text with too many shingles that no other has is in no pair; of the others
the rarest shingles, one more than may be missing, are listed, and each pair
meets in a list. First every text is compared with the centre of each of its
lists, so that large groups grow together; then, in lists where several
components are left, the texts of different ones are compared. Copies of one text count once.

What a list carries of a text is of a fixed size: its number of shingles, the
rank of the listed one and, in the second comparison, a parity sketch (each
shingle flips one of its bits). Sizes and ranks bound what two texts can share, and sketches
differ in no more bits than the sets in shingles, so pairs that fail these
tests are not similar. Only the others fetch their shingles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonehour.llm.common import stored, text_bytes
from zonehour.llm.components import connected_components
from zonehour.llm.ppm_scoring import BLOCK_BYTES, squeeze, summed, unsqueeze

ROW_SCHEMA = "bucket int, block bigint, keys binary, n binary"
SPACE = b" \t\n\r\x0b\x0c"
GAP = re.compile(b"[" + SPACE + b"]")
PIECE_BYTES = 1 << 20  # a text is hashed in pieces of about this size, cut at white space
ROW_BYTES = 1 << 20  # of the texts that are compressed together
SKETCH_LONGS = 4
LIST_ROWS = 4096  # rows of a list that one task compares with the list


def byte_values() -> np.ndarray:
    """A random odd number for each byte: A-Z as a-z, white space 0."""
    values = np.random.Generator(np.random.PCG64(42)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    values[list(SPACE)] = 0
    return values


VALUES = byte_values()
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed_bits(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * FACTOR
    return h ^ (h >> np.uint64(29))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The starts of the words of ``text`` and their 64-bit hashes, each a
    polynomial in FACTOR over its bytes' values."""
    places, parts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(text):
        cut = GAP.search(text, at + PIECE_BYTES)
        end = cut.start() if cut else len(text)
        values = VALUES[np.frombuffer(text, np.uint8, end - at, at)]
        inside = values != 0
        inside[1:] &= values[:-1] == 0
        starts = np.flatnonzero(inside)
        if len(starts):
            lengths = np.diff(starts, append=len(values))
            offset = np.arange(starts[0], len(values)) - np.repeat(starts, lengths)
            powers = np.cumprod(np.full(int(lengths.max()), FACTOR))
            parts.append(np.add.reduceat(values[starts[0] :] * powers[offset], starts - starts[0]))
            places.append(starts + at)
        at = end
    return np.concatenate(places), mixed_bits(np.concatenate(parts))


def windows(a: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words, given the words' hashes."""
    h = np.full(max(0, len(a) - size + 1), size, np.uint64)
    for k in range(size):
        h = mixed_bits(h ^ a[k : len(h) + k])
    return h


def shingles(texts: list[bytes], size: int) -> list[np.ndarray]:
    """By text, the 64-bit hashes of its runs of ``size`` words in order, of
    all words if there are fewer."""
    starts, a = word_hashes(b" ".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(starts, ends).tolist()
    h = windows(a, size)
    return [h[i : j - size + 1] if j - i >= size else windows(a[i:j], j - i) if j > i else a[:0] for i, j in zip([0, *last], last)]


def sketch(h: np.ndarray) -> np.ndarray:
    """SKETCH_LONGS numbers of 64 bits, each bit the parity of its shingles."""
    odd = np.bincount((h % np.uint64(64 * SKETCH_LONGS)).astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def may_lack(m: int, share: float) -> int:
    """How many of m shingles a text of a pair may have alone."""
    return m - int(np.ceil(share * m - 1e-9))


def places(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``keys`` is among distinct sorted ones, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def lacks_too_many(h: np.ndarray, keys: np.ndarray, share: float, bits: int) -> bool:
    """Whether the first third of a text's shingles shows that it is in no
    pair. A shingle that occurs nowhere else occurs once in the text, and
    repeats of others only raise the bound."""
    met = places(keys, counted_keys(h[: len(h) // 3 + 1], bits))[1]
    return len(met) - np.count_nonzero(met) > may_lack(len(h), share)


def text_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``docs`` (id, text) in compressed rows of about ROW_BYTES, stored:
    block (a number of consecutive rows of one task), size, ids, and payload,
    an Arrow stream of the ids and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        first, before = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + 16
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // ROW_BYTES, prepend=0)).tolist()
            for i, j in zip([0, *cuts], [*cuts, len(sizes)]):
                if i == j:
                    continue
                sink, part, size = pa.BufferOutputStream(), pa.table(batch.slice(i, j - i).columns, names=["id", "text"]), int(sizes[i:j].sum())
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_table(part)
                row = {"block": [first + before // block_bytes], "size": [size], "ids": [part.column("id").to_pylist()], "payload": [sink.getvalue().to_pybytes()]}
                yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("block", pa.int64()), ("size", pa.int64()), ("ids", pa.list_(pa.int64())), ("payload", pa.binary())]))
                before += size

    return stored(docs.mapInArrow(run, "block bigint, size bigint, ids array<bigint>, payload binary"), "near-texts")


def texts_of(payload: bytes) -> tuple[list[int], list[bytes]]:
    table = pa.ipc.open_stream(payload).read_all()
    return table.column("id").to_pylist(), [x for c in table.column("text").chunks for x in text_bytes(c)]


def counted_keys(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> np.uint64(64 - bits)


def run_lengths(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of sorted numbers, and how often each occurs."""
    starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    return own[starts], np.diff(starts, append=len(own))


def key_rows(own: np.ndarray, block: int, buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """ROW_SCHEMA rows of the sorted keys (of ``bits`` bits) of a block, one
    per bucket that has some, about ROW_BYTES at a time. A bucket is an equal
    range of keys; only its keys are copied at a time."""
    shift, width = max(0, bits - 32), min(bits, 32)
    starts = np.array([-(-(k << width) // buckets) << shift for k in range(buckets)], np.uint64)
    cuts = [*np.searchsorted(own, starts).tolist(), len(own)]
    rows, size = [], 0
    for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            rows.append((bucket, block, *map(squeeze, run_lengths(own[a:b]))))
            size += len(rows[-1][2]) + len(rows[-1][3])
        if rows and (size > ROW_BYTES or b == len(own)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "block", "keys", "n"])
            rows, size = [], 0


def shared_shingles(blocks: DataFrame, size: int, buckets: int, bits: int) -> DataFrame:
    """ROW_SCHEMA rows: the leading ``bits`` of each block's shingles that
    occur several times, with the number of their occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current = None

        def flush() -> Iterator[pa.RecordBatch]:
            own = np.concatenate([np.zeros(0, np.uint64), *held])
            held.clear()
            own.sort()
            yield from key_rows(own, current, buckets, bits)

        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                if block != current and current is not None:
                    yield from flush()
                current = block
                held.extend(counted_keys(h, bits) for h in shingles(texts_of(payload.as_py())[1], size))
        if current is not None:
            yield from flush()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        parts = [unsqueeze(x) for x in table.column("keys").to_pylist()]
        found, total = summed(np.concatenate(parts), np.concatenate([unsqueeze(x) for x in table.column("n").to_pylist()]).astype(np.int64))
        found, total = found[total > 1], total[total > 1]
        mine = [(k[met], at[met]) for k in parts for at, met in [places(found, k)]]
        cols = [[key[0].as_py()] * len(parts), table.column("block").to_pylist(), [squeeze(k) for k, _ in mine], [squeeze(total[at]) for _, at in mine]]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "block", "keys", "n"])

    return stored(blocks.mapInArrow(count, ROW_SCHEMA).groupBy("bucket").applyInArrow(merge, ROW_SCHEMA), "near-shingles")


def candidates(blocks: DataFrame, shared: DataFrame, size: int, share: float, bits: int) -> DataFrame:
    """id, shingles, sketch and rare (those to list, rarest first) of each text
    that may be in a pair, once for all its copies, from the first block that
    has one; alone: how many of its shingles occur nowhere else, which are
    before those in the order."""
    first = blocks.select("block", F.explode("ids").alias("id")).groupBy("id").agg(F.min("block").alias("block"))
    own_ids = first.groupBy("block").agg(F.collect_list("id").alias("ids"))
    known_of = shared.select("block", "keys", "n", F.lit(None).cast("array<bigint>").alias("ids")).unionByName(own_ids.select("block", F.lit(None).cast("binary").alias("keys"), F.lit(None).cast("binary").alias("n"), "ids"))

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        parts = [unsqueeze(x) for x in known.column("keys").to_pylist() if x is not None]
        order = sorted((k for k, part in enumerate(parts) if len(part)), key=lambda k: parts[k][0])  # buckets are ranges
        keys = np.concatenate([np.zeros(0, np.uint64), *(parts[k] for k in order)])
        del parts
        packed = [x for x in known.column("n").to_pylist() if x is not None]
        n = np.concatenate([np.zeros(0, np.uint64), *(unsqueeze(packed[k]) for k in order)])
        todo = {i for ids in known.column("ids").to_pylist() for i in ids or ()}
        kinds = [("shingles", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("rare", pa.list_(pa.int64())), ("alone", pa.int32())]

        def rows(payload: bytes) -> pa.Table:
            out: dict[int, tuple] = {}
            ids, held = texts_of(payload)
            for i, h in zip(ids, shingles(held, size)):
                if i not in todo or not len(h) or not len(keys):
                    continue
                todo.remove(i)
                if lacks_too_many(h, keys, share, bits):
                    continue
                own = np.unique(h)
                at, met = places(keys, counted_keys(own, bits))
                alone = int((~met).sum())
                left = may_lack(len(own), share) - alone
                if left < 0:
                    continue
                rarest = np.lexsort((own[met], n[at[met]]))[: left + 1]
                out[i] = (own.view(np.int64), sketch(own), own[met][rarest].view(np.int64), alone)
            columns = list(zip(*out.values())) or [()] * 4
            return pa.table({"id": pa.array(list(out), pa.int64()), **{c: pa.array(list(x), kind) for (c, kind), x in zip(kinds, columns)}})

        none = pa.table({"id": pa.array([], pa.int64()), **{c: pa.array([], kind) for c, kind in kinds}})
        return pa.concat_tables([none, *(rows(x.as_py()) for x in texts.column("payload"))])

    found = blocks.select("block", "payload").groupBy("block").cogroup(known_of.groupBy("block")).applyInArrow(run, "id bigint, shingles array<bigint>, sketch array<bigint>, rare array<bigint>, alone int")
    return stored(found, "near-candidates")


def listed_texts(sets: DataFrame) -> DataFrame:
    """One row per listed shingle h of a text: id, m (its number of shingles)
    and rank of h among them."""
    of = sets.select("id", F.size("shingles").alias("m"), "alone", F.posexplode("rare").alias("rank", "h"))
    return stored(of.withColumn("rank", F.col("rank") + F.col("alone")).drop("alone"), "near-lists")


def may_be_similar(a: str, b: str, share: float) -> Column:
    """Whether two rows of one list can be of similar texts, by the shingles
    that they share at most, h and those after it."""
    common = F.least(F.col(f"{a}.m") - F.col(f"{a}.rank"), F.col(f"{b}.m") - F.col(f"{b}.rank"))
    sizes = F.least(f"{a}.m", f"{b}.m") >= share * F.greatest(f"{a}.m", f"{b}.m") - 1e-9
    return sizes & (common * (1 + share) >= share * (F.col(f"{a}.m") + F.col(f"{b}.m")) - 1e-9)


def sketches_near(a: str, b: str, share: float) -> Column:
    """Whether the sketches allow two texts to be similar: two sets differ in
    as many shingles as their sketches in bits, or more."""
    differ = sum(F.bit_count(F.col(f"{a}.sketch")[k].bitwiseXOR(F.col(f"{b}.sketch")[k])) for k in range(SKETCH_LONGS))
    return differ * (1 + share) <= (1 - share) * (F.col(f"{a}.m") + F.col(f"{b}.m")) + 1e-9


def near_pairs(pairs: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """The ``pairs`` (u, v) of ids whose sets are similar, stored."""
    both = stored(pairs.distinct(), "near-pairs").join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u").join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")
    common = F.size(F.array_intersect("a", "b"))
    return stored(both.where(common >= share * (F.size("a") + F.size("b") - common) - 1e-9).select("u", "v"), "near-links")


def near_clusters(docs: DataFrame, size: int = 5, share: float = 0.8, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """hash (XXH64 of a text, as by xxhash64) and cluster of the texts of
    ``docs`` (text) that are similar to another one. Words are A-Z lower-cased
    runs of other bytes than ASCII white space. A text without words and a
    null one are in no pair; repeated rows are one text; an empty table gives
    no rows; other columns are not read. A text of any length is hashed whole,
    in pieces; its shingles must fit into a task."""
    spark = docs.sparkSession
    blocks = text_blocks(docs.where("text is not null").select(F.xxhash64("text").alias("id"), "text"), block_bytes)
    n_blocks, n_bytes = blocks.agg(F.count_distinct("block"), F.coalesce(F.sum("size"), F.lit(1))).first()
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks)
    bits = min(64, 6 + int(n_bytes).bit_length())  # a clash makes a shingle look less rare, which loses no pair
    sets = candidates(blocks, shared_shingles(blocks, size, buckets, bits), size, share, bits)
    listed = listed_texts(sets)
    # a list's text with the fewest rarer shingles has the fewest changes of its own, so most copies are near to it
    fields = ["id", "m", "rank"]
    earliest = F.min_by(F.struct(*fields), F.struct("rank", "id"))
    centre = listed.groupBy("h").agg(earliest.alias("u"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h", "u.*")
    met = listed.alias("b").join(centre.alias("a"), "h").where((F.col("a.id") != F.col("b.id")) & may_be_similar("a", "b", share))
    links = near_pairs(met.select(F.least("a.id", "b.id").alias("u"), F.greatest("a.id", "b.id").alias("v")), sets, share)
    parts = stored(connected_components(links), "near-parts")
    of = stored(listed.join(parts, listed["id"] == parts["node"], "left").select("h", *fields, F.coalesce("component", "id").alias("part")), "near-listed-parts")
    mixed = of.groupBy("h").agg(F.count("*").alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("h", F.ceil(F.col("n") / LIST_ROWS).cast("int").alias("cuts"))
    rows = of.join(mixed, "h").join(sets.select("id", "sketch"), "id")
    cut = rows.withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")).alias("a")
    whole = rows.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).alias("b")
    across = cut.join(whole, ["h", "cut"]).where((F.col("a.id") < F.col("b.id")) & (F.col("a.part") != F.col("b.part"))).where(may_be_similar("a", "b", share) & sketches_near("a", "b", share))
    more = near_pairs(across.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")), sets, share)
    return connected_components(links.unionByName(more)).select(F.col("node").alias("hash"), F.col("component").alias("cluster"))
