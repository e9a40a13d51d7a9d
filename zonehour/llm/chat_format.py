"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole and encoded once with character offsets.
The loss mask comes from intersecting the sorted spans of the assistant
texts with the token spans by binary search.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the template's control strings
TURN, END = "<|turn|>", "<|end|>"

FORMAT_SCHEMA = "conv_id bigint, formatted string, input_ids array<int>, loss_mask array<tinyint>, loss_spans array<array<int>>"
READ_SCHEMA = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def escape(text: str) -> str:
    """No ``<|`` is left in the result, so control strings can't occur in it."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def render(turns: list[tuple[str, str]], loss_role: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of the escaped texts that
    bear loss, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{TURN}{escape(role)}".replace("\n", "\\n") + "\n"
        body = escape(text)
        if role == loss_role and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(TURN, at):
            raise ValueError(f"no turn begins at character {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        turns.append((unescape(formatted[at + len(TURN) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def mask_tokens(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[list[int]]]:
    """Mask of the tokens that overlap a span, and the character spans that
    the masked tokens cover inside the spans, merged.

    ``offsets`` has a row (start, end) per token in text order. A token that
    lies across a span's border counts for the part inside only.
    """
    if not spans or not len(offsets):
        return np.zeros(len(offsets), np.int8), []
    starts, ends = (np.array(x, np.int64) for x in zip(*spans))
    first = np.searchsorted(ends, offsets[:, 0], side="right")
    n = np.maximum(np.searchsorted(starts, offsets[:, 1], side="left") - first, 0)  # spans that a token meets
    token = np.repeat(np.arange(len(offsets)), n)
    span = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    lo, hi = np.maximum(offsets[token, 0], starts[span]), np.minimum(offsets[token, 1], ends[span])
    token, lo, hi = token[lo < hi], lo[lo < hi], hi[lo < hi]
    mask = np.zeros(len(offsets), bool)
    mask[token] = True
    if not len(lo):
        return mask.astype(np.int8), []
    top = np.maximum.accumulate(hi)  # tokens that share a character overlap
    first = np.flatnonzero(np.concatenate(([True], lo[1:] > top[:-1])))
    last = np.concatenate((first[1:], [len(lo)])) - 1
    return mask.astype(np.int8), [[int(a), int(b)] for a, b in zip(lo[first], top[last])]


def format_conversations(turns: DataFrame, tokenizer_json: str, loss_role: str = "assistant") -> DataFrame:
    """One row per ``conv_id`` of ``turns`` (conv_id, turn, role, text).

    Columns out: conv_id, formatted, input_ids, loss_mask (1 per loss token),
    loss_spans (character [start, end) under the mask).

    Turns go in the order of (turn, role, text), a null turn first; repeated
    rows are all kept. A null role or text counts as empty; null conv_ids
    form one conversation. Other columns are ignored, an empty table gives
    no rows. A conversation's text must fit into one task, as the result has
    it in one row.
    """
    whole = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.struct(
                F.col("turn").cast("long").alias("turn"),
                F.coalesce(F.col("role"), F.lit("")).alias("role"),
                F.coalesce(F.col("text"), F.lit("")).alias("text"),
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    shipped = turns.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer, processors

        tok = None
        for batch in batches:
            if tok is None:
                tok = Tokenizer.from_str(shipped.value)
                tok.encode_special_tokens = True
                tok.post_processor = processors.ByteLevel(trim_offsets=False)  # token spans tile the text
            convs = [[(t["role"], t["text"]) for t in x] for x in batch.column("turns").to_pylist()]
            for at in range(0, len(convs), 256):
                made = [render(x, loss_role) for x in convs[at : at + 256]]
                coded = tok.encode_batch([x for x, _ in made], add_special_tokens=False)
                masks = [mask_tokens(np.array(e.offsets, np.int64).reshape(-1, 2), s) for e, (_, s) in zip(coded, made)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("conv_id").slice(at, 256),
                        pa.array([x for x, _ in made], pa.string()),
                        pa.array([e.ids for e in coded], pa.list_(pa.int32())),
                        pa.array([m for m, _ in masks], pa.list_(pa.int8())),
                        pa.array([s for _, s in masks], pa.list_(pa.list_(pa.int32()))),
                    ],
                    names=["conv_id", "formatted", "input_ids", "loss_mask", "loss_spans"],
                )

    return whole.mapInArrow(run, FORMAT_SCHEMA)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``format_conversations`` wrote, read from its
    ``formatted`` and ``loss_spans`` alone: the parsed turns, and the
    unescaped text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns = parse(text)
                loss = "".join(unescape(text[a:b]) for a, b in spans)
                all_turns = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((len(turns), hashlib.sha256(all_turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, READ_SCHEMA)


def load_tokenizer(path: str) -> str:
    """The tokenizer file's JSON text (read on the driver, sent to tasks)."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    json.loads(text)
    return text
