"""Token ids in directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS`` bits, the lowest first. Level k
holds the k-th chunks of the ids that have one; a bitmap per level says which
of its chunks go on in the next level, and a rank directory (set bits before
each 512-bit block) finds where. So any token is read without decoding its
neighbours.

The file format is a Parquet table with one row per segment (whole
documents, about a million ids), in ascending (part, segment) order:
doc_ids, doc_starts (first id of each document in the segment), n_ids, and
per level ``chunks``, ``more`` (the bitmap, least significant bit first) and
``ranks`` (little-endian 64-bit counts).
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonehour.session import scratch_path

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_IDS = 1 << 20
SEGMENT_SCHEMA = "part int, segment int, doc_ids array<bigint>, doc_starts array<bigint>, n_ids bigint, chunks array<binary>, more array<binary>, ranks array<binary>"
DOC_SCHEMA = "part int, segment int, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"


def encode_ids(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """(chunks, more, ranks) by level of an array of ids below 2**32."""
    rest = np.asarray(ids, np.uint64)
    chunks, more, ranks = [], [], []
    while True:
        goes_on = rest >> np.uint64(CHUNK_BITS) > 0
        bits = np.packbits(goes_on, bitorder="little")
        padded = np.concatenate((bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)))
        ones = np.bitwise_count(padded).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.int64)
        chunks.append((rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes())
        more.append(padded.tobytes())
        ranks.append((np.cumsum(ones) - ones).astype("<i8").tobytes())
        rest = rest[goes_on] >> np.uint64(CHUNK_BITS)
        if not len(rest):
            return chunks, more, ranks


def rank(more: bytes, ranks: bytes, at: np.ndarray) -> np.ndarray:
    """Set bits of a bitmap before positions ``at``: the directory's count at
    the block, the block's 64-bit words before the bit, and the part of the
    bit's word."""
    words = np.frombuffer(more, "<u8")
    word = at >> 6
    first = at // RANK_BITS * (RANK_BITS // 64)
    out = np.frombuffer(ranks, "<i8")[at // RANK_BITS].copy()
    for k in range(RANK_BITS // 64 - 1):
        inside = first + k < word
        out[inside] += np.bitwise_count(words[first[inside] + k])
    below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return out + np.bitwise_count(words[word] & below)


def access(chunks: list[bytes], more: list[bytes], ranks: list[bytes], at: np.ndarray) -> np.ndarray:
    """The ids at positions ``at`` (any order, repeats allowed)."""
    at = np.asarray(at, np.int64)
    out = np.zeros(len(at), np.uint64)
    open_ = np.arange(len(at))
    for level, (c, m, r) in enumerate(zip(chunks, more, ranks)):
        out[open_] |= np.frombuffer(c, np.uint8)[at].astype(np.uint64) << np.uint64(level * CHUNK_BITS)
        goes_on = (np.frombuffer(m, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        open_, at = open_[goes_on], at[goes_on]
        if not len(at):
            break
        at = rank(m, r, at)
    return out.astype(np.uint32)


def access_range(chunks: list[bytes], more: list[bytes], ranks: list[bytes], lo: int, hi: int) -> np.ndarray:
    """The ids at positions lo to hi - 1: what a run of ids has in the next
    level is a run too, which begins at the rank of the first."""
    out = np.zeros(hi - lo, np.uint64)
    open_ = np.arange(hi - lo)
    for level, (c, m, r) in enumerate(zip(chunks, more, ranks)):
        if lo >= hi:
            break
        out[open_] |= np.frombuffer(c, np.uint8)[lo:hi].astype(np.uint64) << np.uint64(level * CHUNK_BITS)
        bits = np.unpackbits(np.frombuffer(m, np.uint8)[lo >> 3 : (hi + 7) >> 3], bitorder="little")[lo & 7 :][: hi - lo] > 0
        open_ = open_[bits]
        lo = int(rank(m, r, np.array([lo]))[0])
        hi = lo + len(open_)
    return out.astype(np.uint32)


LETTERS = "A-Za-zÀ-ÖØ-öø-ʯΑ-ΡΣ-ώЀ-ҁ"  # letters in every version of Unicode
SIGNS = r"!-&(-/:-@\[-`{-~"  # of ASCII, without the apostrophe
MARK = "\x1f"  # leads a piece that has no space before it


class PieceEncoder:
    """Encodes texts through a tokenizer of byte-level BPE whose words may
    take one space before them, with a cache of pieces.

    Such a tokenizer splits before a space that a visible character follows,
    and between letters and the signs after them, so a text's ids are those
    of its pieces, each encoded by the tokenizer once. Signs that end a word
    are a piece of their own: there are far fewer words than words with signs.
    """

    CACHE = 600_000  # the cache starts anew once it has more pieces
    JOINED = 500  # pieces given to the tokenizer as one text

    @staticmethod
    def of_worker(tokenizer_json: str) -> PieceEncoder:
        """The encoder of this Python worker, whose cache outlives a task."""
        state = sys.modules.setdefault("token_codes_worker", types.ModuleType("token_codes_worker"))
        encoders = state.__dict__.setdefault("encoders", {})
        key = zlib.crc32(tokenizer_json.encode())
        if key not in encoders:
            encoders[key] = PieceEncoder(tokenizer_json)
        return encoders[key]

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.encode_special_tokens = True
        self.tok.model._resize_cache(0)  # the pieces are kept here, and each is encoded once
        vocab = self.tok.get_vocab()
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, k in vocab.items():
            self.n_bytes[k] = len(token)
        self.cache: defaultdict[str, bytes | bytearray] = defaultdict(bytearray)  # of pieces, the space before them left out
        self.odd = re.compile(r" (?![!-~\w])")
        self.cut = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
        self.cut_marked = re.compile(rf"(?<=[!-~\w]) (?=[!-~\w{MARK}])")
        self.signs = re.compile(rf"[{SIGNS}](?<=[{LETTERS}].)[{SIGNS}]*(?=[ \n]|\Z)")

    def alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(self, parts: list[str], before: str) -> Iterator[bytes]:
        """The ids of parts that end visibly, each with ``before`` before it."""
        for at in range(0, len(parts), self.JOINED):
            some = parts[at : at + self.JOINED]
            ids = np.array(self.tok.encode_batch_fast([before + before.join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum([len(p.encode()) + len(before) for p in some])
            cuts = (4 * (np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1)).tolist()
            raw = ids.tobytes()
            yield from (raw[a:b] for a, b in zip([0, *cuts], cuts))

    def learned(self, pieces: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """The pieces with their ids."""
        plain, signs, rest = [], [], []
        for p in pieces:
            (rest if p[-1].isspace() else signs if p[0] == MARK else plain).append(p)
        yield from zip(plain, self.joined(plain, " "))
        word = " a"  # signs are encoded after a word, whose ids are left out
        n = len(self.alone([word])[0])
        yield from ((p, ids[n:]) for p, ids in zip(signs, self.joined([p[1:] for p in signs], word)))
        yield from zip(rest, self.alone([p[1:] if p[0] == MARK else " " + p for p in rest]))

    def pieces(self, text: str) -> list[str]:
        cut = self.cut if MARK in text else self.cut_marked
        odd = self.odd.search(text)
        if cut is self.cut_marked:
            text = self.signs.sub(rf" {MARK}\g<0>", text)
        return cut.split(text) if odd else text.split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.pieces(x) for x in texts]
        first = self.alone([x[0] for x in split])
        if len(self.cache) > self.CACHE:
            self.cache.clear()
        known = len(self.cache)
        try:
            found = [list(map(self.cache.__getitem__, x[1:])) for x in split]
            new = dict(islice(reversed(self.cache.items()), len(self.cache) - known))  # still empty, in ``found`` too
            for p, ids in self.learned(new):
                new[p].extend(ids)
                self.cache[p] = ids
        except BaseException:
            self.cache.clear()
            raise
        return [np.frombuffer(a + b"".join(x), np.uint32) for a, x in zip(first, found)]


def write_ids(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 0) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) and write the ids in
    ascending doc_id order to ``path``, ``end_id`` after each document.

    A null or empty text is its end id alone. Null doc_ids come first; rows
    of one doc_id go by a hash of the text, repeated rows in input order, and
    may go to several files. Other columns are ignored; an empty table gives
    an empty Parquet table. A document lies in one segment, so the longest
    document must fit into a task.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["doc_id", "hash", "row"]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
    )
    shipped = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, segment, coder = TaskContext.get().partitionId(), 0, None
        doc_ids: list = []
        found: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            sizes = [len(x) for x in found]
            chunks, more, ranks = encode_ids(np.concatenate(found))
            starts = np.cumsum(sizes) - sizes
            columns = ([part], [segment], [doc_ids], [starts.tolist()], [int(sum(sizes))], [chunks], [more], [ranks])
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), *[pa.list_(pa.binary())] * 3)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "segment", "doc_ids", "doc_starts", "n_ids", "chunks", "more", "ranks"])

        def small(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
            ids, texts, size = [], [], 0
            for k, x in zip(batch.column("doc_id"), batch.column("text")):
                ids.append(k.as_py())
                texts.append(x.as_py() or "")
                size += len(texts[-1])
                if size > 2_000_000:
                    yield ids, texts
                    ids, texts, size = [], [], 0
            if ids:
                yield ids, texts

        for batch in batches:
            for ids, texts in small(batch):
                coder = coder or PieceEncoder.of_worker(shipped.value)
                for k, x in zip(ids, coder.encode(texts)):
                    doc_ids.append(k)
                    found.append(np.append(x, np.uint32(end_id)))
                    held += len(found[-1])
                    if held >= SEGMENT_IDS:
                        yield flush()
                        segment, doc_ids, found, held = segment + 1, [], [], 0
        if found:
            yield flush()

    ordered.mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def read_documents(segments: DataFrame) -> DataFrame:
    """Per document of a written table: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), all read by random access to the codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                starts = r["doc_starts"]
                ends = [*starts[1:], r["n_ids"]]
                crc = []
                at = 0
                while at < len(starts):  # about a hundred thousand ids at a time
                    to = at + 1
                    while to < len(starts) and ends[to] - starts[at] <= 100_000:
                        to += 1
                    ids = access_range(r["chunks"], r["more"], r["ranks"], starts[at], ends[to - 1]).astype("<u4")
                    crc += [zlib.crc32(ids[a - starts[at] : b - starts[at]].tobytes()) for a, b in zip(starts[at:to], ends[at:to])]
                    at = to
                n = len(starts)
                columns = ([r["part"]] * n, [r["segment"]] * n, r["doc_ids"], starts, [b - a for a, b in zip(starts, ends)], crc)
                kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "segment", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    docs = segments.mapInArrow(run, DOC_SCHEMA)
    # ids before a segment: those of the parts before its part, and of its part's segments before it
    sizes = segments.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    own = Window.partitionBy("part").orderBy("segment")
    starts = sizes.withColumn("own_start", F.sum("n_ids").over(own) - F.col("n_ids")).join(before, "part")
    starts = starts.select("part", "segment", (F.col("part_start") + F.col("own_start")).alias("segment_start"))
    return docs.join(starts, ["part", "segment"]).select("doc_id", (F.col("segment_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer_json: str, end_id: int = 0) -> DataFrame:
    """``write_ids`` to a fresh path of the shared scratch folder, and what
    ``read_documents`` reads from it."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-codes")
    write_ids(docs, path, tokenizer_json, end_id)
    return read_documents(spark.read.schema(SEGMENT_SCHEMA).parquet(path))
