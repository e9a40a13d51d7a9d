"""Language-model scores of whole texts: prediction by partial matching over
bytes, beside a smoothed unigram score of words.

A node of the byte-context trie is a context of up to DEPTH bytes and the
symbol after it; every node met in training is kept. A symbol not
met in a context escapes to the next shorter one with probability d / (t + d)
(t symbols met there, d different ones; method C), and symbols of the longer
context are excluded there. Below the empty context the symbols not met are
alike.

The counts grow with the corpus and never meet in one place. Documents go
into blocks. Each block sums its own and deals them to buckets, one row with
sorted keys per bucket; a bucket's rows are merged in one task, and each
block gets the corpus counts of its own words and the probabilities of its
own nodes back. A bucket holds all nodes whose contexts end in the same LOW
bytes, so only the nodes of shorter contexts, at most 256**LOW, meet.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonehour.llm.common import stored, text_bytes

EDGE = 0xFF  # never a byte of UTF-8: stands before a text, and is its end symbol
DEPTH = 5
LOW = 2  # contexts of fewer bytes are counted over all buckets
BLOCK_BYTES = 32 << 20  # text of a block, besides its last document
BUFFER = 1 << 22  # symbols counted at a time
CHUNK = 1 << 18  # symbols scored at a time
WORDS, NODES, SUMS = 0, 1, 2  # kinds of count rows
COUNT_SCHEMA = "kind tinyint, bucket int, block bigint, keys binary, n binary"


def framed(text: bytes) -> np.ndarray:
    """The lower-cased (A-Z) bytes between start edges and the end."""
    return np.frombuffer(bytes([EDGE]) * DEPTH + text.lower() + bytes([EDGE]), np.uint8)


def node_codes(s: np.ndarray, order: int) -> np.ndarray:
    """Per symbol after the start edges the code of its context of ``order``
    bytes and itself, the symbol lowest."""
    n = len(s) - DEPTH
    code = np.zeros(n, np.uint64)
    for k in range(DEPTH - order, DEPTH + 1):
        code = code << np.uint64(8) | s[k : k + n]
    return code


def shorter(codes: np.ndarray, order: int) -> np.ndarray:
    """The codes cut to contexts of ``order`` bytes."""
    return codes & np.uint64((1 << 8 * (order + 1)) - 1)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their n."""
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, byte planes of their differences deflated."""
    steps = np.diff(numbers.astype(np.uint64), prepend=np.uint64(0))
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unsqueeze(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def word_key(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, 42)


def log10(x: np.ndarray) -> np.ndarray:
    """log10, 0 for x = 0: such norms and escapes are of contexts whose
    symbols are all excluded, which cost nothing to leave."""
    return np.log10(np.where(x > 0, x, 1.0))


@dataclass
class Level:
    """Contexts of one length. ``nodes`` (codes) with log10 n; ``contexts``
    with log10 norm t + d and escape of their own, and, for the context one
    byte shorter, norm and escape without the symbols met here."""

    nodes: np.ndarray
    log_n: np.ndarray
    contexts: np.ndarray
    norm: np.ndarray
    escape: np.ndarray
    next_norm: np.ndarray
    next_escape: np.ndarray


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


@dataclass
class Trie:
    """Pretrained trie: ``levels`` by context length, ``top`` the log10 p of
    the nodes of the longest, ``rest`` that of a symbol never met."""

    levels: list[Level]
    top: np.ndarray
    rest: float

    @classmethod
    def build(cls, nodes: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
        """From (sorted codes, n) by context length, 0 to DEPTH. Of every node
        the one with a context one byte shorter is there too."""
        levels: list[Level] = []
        low_t = low_d = low_n = np.zeros(0)
        for order, (codes, n) in enumerate(nodes):
            n = n.astype(np.float64)
            contexts, of = np.unique(codes >> np.uint64(8), return_inverse=True)
            t, d = np.bincount(of, n, len(contexts)), np.bincount(of, minlength=len(contexts)).astype(float)
            next_t, next_d = t * 0, d * 0
            if order and len(codes):
                low = levels[-1]
                below = np.searchsorted(low.contexts, shorter(contexts, order - 2) if order > 1 else contexts * np.uint64(0))
                met = low_n[np.searchsorted(low.nodes, shorter(codes, order - 1))]
                next_t, next_d = low_t[below] - np.bincount(of, met, len(contexts)), low_d[below] - d
            levels.append(Level(codes, log10(n), contexts, log10(t + d), log10(d) - log10(t + d), log10(next_t + next_d), np.where(next_d > 0, log10(next_d) - log10(next_t + next_d), 0.0)))
            low_t, low_d, low_n = t, d, n
        last = levels[-1]
        top = last.log_n - last.norm[np.searchsorted(last.contexts, last.nodes >> np.uint64(8))] if len(last.nodes) else last.log_n
        left = 256 - len(levels[0].nodes)
        return cls(levels, top, -float(np.log10(left)) if left else 0.0)

    def log_probs(self, s: np.ndarray) -> np.ndarray:
        """log10 p of each symbol of a framed text."""
        return self.code_log_probs(node_codes(s, DEPTH))

    def code_log_probs(self, codes: np.ndarray) -> np.ndarray:
        """log10 p of the symbols of nodes of DEPTH bytes of context."""
        out = np.zeros(len(codes))
        hit, at = find(self.levels[DEPTH].nodes, codes)
        out[hit] = self.top[at[hit]]
        left = np.flatnonzero(~hit)
        # norm and escape of the context at hand, if a longer one was known
        norm, escape = np.full(len(left), np.nan), np.full(len(left), np.nan)
        for order in range(DEPTH, -1, -1):
            if not len(left):
                return out
            level, code = self.levels[order], shorter(codes[left], order)
            known, of = find(level.contexts, code >> np.uint64(8))
            if len(level.contexts):
                norm = np.where(np.isnan(norm), level.norm[of], norm)
                escape = np.where(np.isnan(escape), level.escape[of], escape)
                hit, at = find(level.nodes, code)
                out[left[hit]] += level.log_n[at[hit]] - norm[hit]
                out[left[known & ~hit]] += escape[known & ~hit]
                norm = np.where(known, level.next_norm[of], np.nan)[~hit]
                escape = np.where(known, level.next_escape[of], np.nan)[~hit]
                left = left[~hit]
        out[left] += self.rest
        return out

    def score(self, text: bytes) -> float:
        """log10 p of a whole text with its end."""
        s, total = framed(text), 0.0
        for lo in range(0, len(s) - DEPTH, CHUNK):
            total += float(self.log_probs(s[lo : lo + CHUNK + DEPTH]).sum())
        return total


def in_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``docs`` (doc_id, train, text) with block, a number of consecutive rows
    of one task, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        first, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            before = size + np.cumsum(sizes) - sizes
            size += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([pa.array(first + before // block_bytes, pa.int64()), *batch.columns], names=["block", *batch.schema.names])

    return stored(docs.mapInArrow(run, "block bigint, doc_id bigint, train boolean, text string"), "scoring-blocks", "zstd")


def count_rows(blocks: DataFrame, buckets: int) -> DataFrame:
    """COUNT_SCHEMA rows of each block, stored: its words (the empty word is
    the end) and the trie's deepest nodes with their counts in its training
    texts, 0 for those of other texts only.

    A word's bucket comes from its hash, a node's from the last LOW bytes of
    its context, so that all symbols of a context of LOW bytes or more and of
    those that it ends in fall into the same bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        codes, n_codes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []
        unseen: list[np.ndarray] = []
        held_size = 0
        words: Counter = Counter()
        others: set[bytes] = set()
        current = None

        def merge() -> None:
            nonlocal codes, n_codes, held, unseen, held_size
            new, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            other = np.unique(np.concatenate([np.zeros(0, np.uint64), *unseen]))
            codes, n_codes = summed(np.concatenate([codes, new, other]), np.concatenate([n_codes, n, np.zeros(len(other), np.int64)]))
            held, unseen, held_size = [], [], 0

        def rows(kind: int, block: int, bucket: np.ndarray, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            order = np.lexsort((keys, bucket))
            bucket, keys, n = bucket[order], keys[order], n[order]
            found, first = np.unique(bucket, return_index=True)
            ends = [*first[1:].tolist(), len(keys)]
            parts = list(zip(first.tolist(), ends))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([kind] * len(parts), pa.int8()),
                    pa.array(found.tolist(), pa.int32()),
                    pa.array([block] * len(parts), pa.int64()),
                    pa.array([squeeze(keys[a:b]) for a, b in parts], pa.binary()),
                    pa.array([squeeze(n[a:b]) for a, b in parts], pa.binary()),
                ],
                names=["kind", "bucket", "block", "keys", "n"],
            )

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal codes, n_codes
            extra = others.difference(words)
            keys = np.array([word_key(w) for part in (words, extra) for w in part], np.uint64)
            n = np.zeros(len(keys), np.int64)
            n[: len(words)] = np.fromiter(words.values(), np.int64, len(words))
            words.clear()
            others.clear()
            yield rows(WORDS, current, keys % np.uint64(buckets), keys, n)
            merge()
            ends = codes >> np.uint64(8) & np.uint64((1 << 8 * LOW) - 1)
            yield rows(NODES, current, (ends * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets), codes, n_codes)
            codes, n_codes = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        for batch in batches:
            for block, train, text in zip(batch.column("block").to_pylist(), batch.column("train").to_pylist(), text_bytes(batch.column("text"))):
                if block != current:
                    if current is not None:
                        yield from flush()
                    current = block
                tokens = (text or b"").lower().split()
                tokens.append(b"")
                (words if train else others).update(tokens)
                new = node_codes(framed(text or b""), DEPTH)
                (held if train else unseen).append(new)
                held_size += len(new)
                if held_size >= BUFFER:
                    merge()
        if current is not None:
            yield from flush()

    return stored(blocks.mapInArrow(run, COUNT_SCHEMA), "scoring-rows")


def low_nodes(rows: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """The trie's nodes with contexts shorter than LOW bytes, by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column("keys").to_pylist(), batch.column("n").to_pylist()):
                codes, n = summed(shorter(unsqueeze(keys), LOW - 1), unsqueeze(n).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(codes[n > 0].astype(np.int64)), pa.array(n[n > 0])], names=["code", "n"])

    counts = rows.where(F.col("kind") == NODES).select("keys", "n").mapInArrow(run, "code bigint, n bigint")
    found = counts.groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    codes, n = found["code"].to_numpy(np.uint64), found["n"].to_numpy(np.int64)
    return [summed(shorter(codes, order), n) for order in range(LOW)]


def merged_counts(rows: DataFrame) -> DataFrame:
    """COUNT_SCHEMA rows of whole buckets, stored: the words of each block
    with their counts in the corpus; the deepest nodes of each block with the
    log10 p of their symbols (the bits of a double as ``n``); and a row
    of SUMS per bucket of words with the sum of all counts (``keys``) and the
    number of words met in training (``n``)."""
    shipped = rows.sparkSession.sparkContext.broadcast(low_nodes(rows))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kind, bucket = key[0].as_py(), key[1].as_py()
        parts = [unsqueeze(x) for x in table.column("keys").to_pylist()]
        keys = np.concatenate(parts)
        n = np.concatenate([unsqueeze(x) for x in table.column("n").to_pylist()]).astype(np.int64)
        found, total = summed(keys, n)
        value = total
        if kind == NODES:
            nodes = [(found[total > 0], total[total > 0])]
            for order in range(DEPTH - 1, LOW - 1, -1):
                nodes.insert(0, summed(shorter(nodes[0][0], order), nodes[0][1]))
            value = Trie.build([*shipped.value, *nodes]).code_log_probs(found).view(np.uint64)
        made = [(kind, bucket, block, squeeze(k), squeeze(value[np.searchsorted(found, k)])) for block, k in zip(table.column("block").to_pylist(), parts)]
        if kind == WORDS:
            made.append((SUMS, bucket, -1, squeeze(total.sum(keepdims=True)), squeeze(np.array([(total > 0).sum()]))))
        kinds = (pa.int8(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["kind", "bucket", "block", "keys", "n"])

    return stored(rows.groupBy("kind", "bucket").applyInArrow(run, COUNT_SCHEMA), "scoring-counts")


def count_words(counts: DataFrame) -> tuple[int, int]:
    """Training tokens, different training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(int(unsqueeze(k)[0]), int(unsqueeze(n)[0])) for k, n in zip(*(batch.column(c).to_pylist() for c in ("keys", "n")))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*got) if got else [()] * 2)], names=["tokens", "words"])

    sums = counts.where(F.col("kind") == SUMS).select("keys", "n").mapInArrow(run, "tokens bigint, words bigint")
    return tuple(sums.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "words")]).first())


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score
    per row of ``docs`` (doc_id, text, train as boolean).

    The trie and the word counts are learned from rows with ``train``. Tokens
    are the words (runs of other bytes than ASCII white space, A-Z
    lower-cased) and one end; words are told apart by 64-bit hashes. With N
    tokens, V different ones and c of a token in the training rows,
    base_score adds log10((c + 0.5) / (N + 0.5 (V + 1))) per token. score is
    the log10 probability of the text's bytes and end under the trie.

    A null text counts as empty: its end token alone. A null ``train`` is
    false. Without training rows every symbol has probability 1/256. Repeated
    rows are all scored and, in training, all counted; other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = in_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("train", F.lit(False)).alias("train"), "text"), block_bytes)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = merged_counts(count_rows(blocks, buckets))
    n_train, n_words = count_words(counts)
    known = counts.where(F.col("kind") != SUMS).select("block", "kind", "keys", "n")

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        import pandas as pd

        def table_of(kind: int) -> tuple[np.ndarray, np.ndarray]:
            own = known.filter(pa.array([k == kind for k in known.column("kind").to_pylist()], pa.bool_()))
            # a key of several files of a block is there more than once, with one value
            keys, values = (np.concatenate([np.zeros(0, np.uint64), *map(unsqueeze, own.column(x).to_pylist())]) for x in ("keys", "n"))
            keys, first = np.unique(keys, return_index=True)
            return keys, values[first]

        keys, c = table_of(WORDS)
        codes, log_p = table_of(NODES)
        place, log_p = pd.Index(codes), log_p.view(np.float64)

        def score(text: bytes) -> float:
            s, total = framed(text), 0.0
            for lo in range(0, len(s) - DEPTH, CHUNK):
                total += float(log_p[place.get_indexer(node_codes(s[lo : lo + CHUNK + DEPTH], DEPTH))].sum())
            return total

        bottom = np.log10(n_train + 0.5 * (n_words + 1))
        lp_of: dict[bytes, float] = {}
        unknown = float(np.log10(0.5) - bottom)
        out = []
        for chunk in texts.column("text").chunks:
            for text in text_bytes(chunk):
                text = text or b""
                tokens = text.lower().split()
                tokens.append(b"")
                new = list(set(tokens).difference(lp_of))
                if new and len(keys):
                    h = np.array([word_key(w) for w in new], np.uint64)
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    lp = np.where((keys[at] == h) & (c[at] > 0), np.log10(c[at] + 0.5) - bottom, np.nan)
                    lp_of.update(zip(new, lp.tolist()))
                got = np.array([lp_of.get(w, np.nan) for w in tokens])
                missing = int(np.isnan(got).sum())
                out.append((len(tokens), len(tokens) - missing, float(np.nansum(got)) + missing * unknown, score(text)))
        n_tokens, n_known, base, score = zip(*out) if out else ((), (), (), ())
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "train": texts.column("train"),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array([n_train] * len(out), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    schema = "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)
