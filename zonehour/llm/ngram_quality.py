"""Quality rules: counting rules and n-gram perplexity bands by language.

The language model is a modified Kneser-Ney model of characters. Its symbols
are the UTF-16 units of the texts, none folded together, so an n-gram of ORDER
symbols is one 64-bit number. Spark counts the n-grams of all texts and
estimates the model by joins; it is a table that grows with the corpus and is
never in one place.

The model is learned from the texts that it scores, so it has every n-gram of
them and a text's cost is the sum of its n-grams' costs. The most frequent
n-grams, HEAD at most, are looked up in sorted arrays that every task gets; a
text's other n-grams, if there are any, are joined with the rest of the table.
Costs are whole numbers, so that sums don't depend on their order.

A text has a perplexity per character and one per word. Symbols glued to words
hardly move the first, as their repeats are cheap, but they raise the second;
tables of single words have a high first and a low second.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonehour.llm.common import stored, text_bytes

ORDER = 4
BITS = 16  # of a symbol
SYMBOLS = 1 << BITS
START = 0xD800  # before a text; in one, this unit has a low surrogate after it, which no text begins with
CHUNK = 1 << 18  # symbols counted or scored at a time
BUFFER = 1 << 21  # n-grams sorted at a time, and different ones that a task holds
HEAD = 1 << 21  # n-grams that every task gets
COST_UNIT = 2.0**-32  # of a cost, in nats


@dataclass(frozen=True)
class QualitySpec:
    """Base rules: fewer words than ``min_words``, or more than
    ``max_repeat_pct`` percent of words in repeated 3-word windows, fail.
    Bands of a language, for the log perplexity per character and per word:
    (lower, upper) fences times the quartiles' distance, at least
    ``least`` of it, beyond the quartiles of its base-passing texts, which are
    counted in steps. As the mean over a short text varies more, the bands of
    a text of n words are wider by sqrt(1 + short_words / n)."""

    min_words: int = 50
    max_repeat_pct: int = 50
    char_fences: tuple[float, float] = (4.0, 2.5)
    char_least: float = 0.03
    char_step: float = 0.002
    word_fences: tuple[float, float] = (2.0, 3.0)
    word_least: float = 0.3
    word_step: float = 0.01
    short_words: int = 60

    def bands(self) -> dict[str, tuple[tuple[float, float], float, float]]:
        return {"log_ppl": (self.char_fences, self.char_least, self.char_step), "word_log_ppl": (self.word_fences, self.word_least, self.word_step)}


def symbols(text: bytes) -> np.ndarray:
    """The UTF-16 units of a UTF-8 text, after ORDER - 1 starts."""
    units = np.frombuffer(text.decode("utf-8", "replace").encode("utf-16-le"), "<u2")
    return np.concatenate((np.full(ORDER - 1, START, np.uint16), units))


def grams(s: np.ndarray) -> np.ndarray:
    """The n-grams that end at each position from ORDER - 1 on, as 64-bit
    numbers, the last symbol lowest."""
    n = len(s) - ORDER + 1
    code = np.zeros(n, np.int64)
    for k in range(ORDER):
        code = (code << BITS) | s[k : k + n]
    return code


def gram_chunks(s: np.ndarray) -> Iterator[np.ndarray]:
    for lo in range(0, len(s) - ORDER + 1, CHUNK):
        yield grams(s[lo : lo + CHUNK + ORDER - 1])


def count_grams(docs: DataFrame) -> DataFrame:
    """gram and n of all whole texts of ``docs`` (text). Each task sums its
    own counts before the shuffle, until it holds more than BUFFER n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []
        size = 0

        def add() -> None:
            nonlocal found, n, size
            own, times = np.unique(np.concatenate(held), return_counts=True)
            found, place = np.unique(np.concatenate((found, own)), return_inverse=True)
            n = np.bincount(place, np.concatenate((n, times)), len(found)).astype(np.int64)
            held.clear()
            size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(found), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(found[at : at + 50_000]), pa.array(n[at : at + 50_000])], names=["gram", "n"])

        for batch in batches:
            for text in text_bytes(batch.column("text")):
                for part in gram_chunks(symbols(text)) if text else ():
                    held.append(part)
                    size += len(part)
                    if size >= BUFFER:
                        add()
                        if len(found) > BUFFER:
                            yield from rows()
                            found, n = found[:0], n[:0]
        if held:
            add()
        yield from rows()

    return docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the
    numbers of n-grams met one to four times. Where one of the first three is
    0 (tiny or saturated corpora) they are 0.5, 1 and 1.5."""
    n1, n2, n3, n4 = counts.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
    if not n1 or not n2 or not n3:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return [min(max(d, 0.1), k + 0.9) for k, d in enumerate(found)]


def estimate(counted: DataFrame) -> DataFrame:
    """gram, n and p (given the symbols before its last one) of the counted
    ORDER-grams. Lower orders count how many different symbols precede an
    n-gram; below order 1 is the uniform law."""
    by_order = {ORDER: counted}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1))
        by_order[order] = stored(by_order[order + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("n")), "quality-grams")
    lower = None
    for order in range(1, ORDER + 1):
        of = by_order[order].withColumn("ctx", F.shiftrightunsigned("gram", BITS))
        d = discounts(of)
        n = F.col("n")
        kept = sum(F.lit(x) * F.count_if(n == k if k < 3 else n >= 3) for k, x in enumerate(d, 1))
        contexts = of.groupBy("ctx").agg(F.sum("n").alias("total"), kept.alias("kept"))
        own = n - F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        of = of.join(contexts, "ctx")
        if lower is None:
            of = of.withColumn("below", F.lit(1 / SYMBOLS))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))
            of = of.withColumn("suffix", suffix).join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix")
        lower = of.select("gram", "n", ((own + F.col("kept") * F.col("below")) / F.col("total")).alias("p"))
    return lower


def fit_kneser_ney(docs: DataFrame) -> DataFrame:
    """gram, n and cost (-ln p in COST_UNIT) of the n-grams of all texts of
    ``docs`` (text), stored."""
    model = estimate(stored(count_grams(docs), "quality-grams"))
    return stored(model.select("gram", "n", F.round(-F.log("p") / F.lit(COST_UNIT)).cast("long").alias("cost")), "quality-model")


def split_model(model: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
    """The n-grams met at least 2**k times, for the least k that leaves no
    more than ``most``, and their costs, by n-gram; and the table of the
    others, if there are any."""
    sizes = dict(model.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*")).collect())
    bits = max(sizes, default=0) + 1
    left = most
    while bits > 1 and sizes.get(bits - 1, 0) <= left:
        bits -= 1
        left -= sizes.get(bits, 0)
    often = F.col("n") >= F.lit(1 << bits - 1)
    head = model.where(often).select("gram", "cost").toArrow().sort_by("gram")
    return head.column("gram").to_numpy(), head.column("cost").to_numpy(), model.where(~often).select("gram", "cost") if bits > 1 else None


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words. Words are
    runs of other bytes than ASCII white space."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    chars = text.decode("utf-8", "replace")
    blank = sum(map(chars.count, " \t\n\v\f\r"))
    marks = sum(map(text.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 3:
        number: dict[bytes, int] = {}
        a = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        pairs = np.unique(a[:-1] * len(number) + a[1:], return_inverse=True)[1]
        _, place, times = np.unique(pairs[:-1] * len(number) + a[2:], return_inverse=True, return_counts=True)
        twice = times[place] > 1
        hit = np.zeros(len(words), bool)
        for k in range(3):
            hit[k : len(words) - 2 + k] |= twice
        repeated = int(hit.sum())
    return len(words), len(chars) - blank, marks, len(lines) - len(set(lines)), repeated


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


INNER = ("quality_row", "quality_symbols", "quality_cost", "quality_others")  # columns that only ``measure`` has


def measure(docs: DataFrame, grams_known: np.ndarray, costs: np.ndarray, text: str, spec: QualitySpec) -> DataFrame:
    """``docs`` with MEASURES, base_failed and INNER added: a number of the
    row, and for texts that pass the base rules (else null) the number of
    symbols, the cost of the known n-grams and the list of the others."""
    schema = T.StructType(list(docs.schema.fields))
    for c in MEASURES:
        schema = schema.add(c, "long")
    schema = schema.add("base_failed", "boolean").add("quality_row", "long").add("quality_symbols", "long").add("quality_cost", "long").add("quality_others", T.ArrayType(T.LongType()))
    shipped = docs.sparkSession.sparkContext.broadcast((grams_known, costs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, cost_of = shipped.value
        number = TaskContext.get().partitionId() << 33
        kinds = [*[pa.int64()] * 5, pa.bool_(), *[pa.int64()] * 3, pa.list_(pa.int64())]

        def cost(s: np.ndarray) -> tuple[int, np.ndarray]:
            total, others = 0, [np.zeros(0, np.int64)]
            for part in gram_chunks(s):
                part.sort()  # neighbours are near to each other in the arrays too
                at = np.searchsorted(known, part)
                at[at == len(known)] = 0
                met = known[at] == part if len(known) else np.zeros(len(part), bool)
                total += int(cost_of[at[met]].sum())
                others.append(part[~met])
            return total, np.concatenate(others)

        for batch in batches:
            rows, held, first = [], 0, 0
            for i, x in enumerate(text_bytes(batch.column(text)), 1):
                counts = base_counts(x)
                failed = counts[0] < spec.min_words or 100 * counts[4] > spec.max_repeat_pct * counts[0]
                length = own = others = None
                if not failed:
                    s = symbols(x)
                    length, (own, others) = len(s) - ORDER + 1, cost(s)
                    held += len(others)
                rows.append((*counts, failed, number, length, own, others))
                number += 1
                if i == batch.num_rows or held > BUFFER:
                    part = batch.slice(first, i - first)
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=[*batch.schema.names, *MEASURES, "base_failed", *INNER])
                    rows, held, first = [], 0, i

    return docs.mapInArrow(run, schema)


def perplexities(measured: DataFrame, rest: DataFrame | None) -> DataFrame:
    """Stored rows of ``measure`` with log_ppl (mean negative ln p per symbol)
    and word_log_ppl (per word) instead of INNER; ``rest`` (gram, cost) has
    the n-grams listed as others."""
    total = F.col("quality_cost")
    if rest is not None:
        listed = measured.select("quality_row", F.explode("quality_others").alias("gram")).groupBy("quality_row", "gram").agg(F.count("*").alias("times"))
        more = listed.join(rest, "gram").groupBy("quality_row").agg(F.sum(F.col("times") * F.col("cost")).alias("quality_more"))
        measured = measured.drop("quality_others").join(more, "quality_row", "left")
        total = total + F.coalesce("quality_more", F.lit(0))
    nats = total * F.lit(COST_UNIT)
    found = measured.withColumn("log_ppl", nats / F.col("quality_symbols")).withColumn("word_log_ppl", nats / F.col("n_words")).drop(*INNER, "quality_more")
    return found if rest is None else stored(found, "quality-perplexities", "zstd")


def perplexity_bands(measured: DataFrame, lang: str, spec: QualitySpec) -> DataFrame:
    """band_lang and per measure its quartiles, from exact counts of its steps
    by language (a null language is one of its own)."""
    columns = list(spec.bands())
    step = F.create_map(*[F.lit(x) for c, (_, _, width) in spec.bands().items() for x in (c, width)])[F.col("measure")]
    long = measured.where(~F.col("base_failed")).select(F.col(lang).alias("band_lang"), *columns).unpivot(["band_lang"], columns, "measure", "value")
    steps = long.groupBy("band_lang", "measure", F.floor(F.col("value") / step).alias("at")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy("band_lang", "measure")
    steps = steps.withColumn("upto", F.sum("n").over(whole.orderBy("at"))).withColumn("all", F.sum("n").over(whole))

    def quartile(measure: str, q: int) -> Column:
        reached = (F.col("measure") == measure) & (F.col("upto") * 4 >= F.col("all") * q)
        return F.min(F.when(reached, (F.col("at") + 0.5) * step)).alias(f"{measure}_q{q}")

    return steps.groupBy("band_lang").agg(*[quartile(c, q) for c in columns for q in (1, 3)])


def judge_quality(docs: DataFrame, spec: QualitySpec = QualitySpec(), text: str = "text", lang: str = "lang", carry_text: bool = False) -> DataFrame:
    """Every row of ``docs`` with MEASURES, base_failed, log_ppl, word_log_ppl,
    their bands (lo, hi, word_lo, word_hi) and kept added (columns of these
    names are replaced), without the text unless ``carry_text``.

    A row is kept if it passes the base rules and both log perplexities lie in
    their language's bands (null for a text that fails them). A null or empty
    text has no words and fails. Repeated rows are judged alike. A language
    with one text has bands around it.
    """
    quartiles = [f"{c}_q{q}" for c in spec.bands() for q in (1, 3)]
    added = {*MEASURES, *INNER, "quality_more", "base_failed", "log_ppl", "word_log_ppl", "lo", "hi", "word_lo", "word_hi", "kept", "band_lang", *quartiles}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    model = fit_kneser_ney(docs.select(F.col(text).alias("text")))
    known, costs, rest = split_model(model, HEAD)
    measured = measure(docs, known, costs, text, spec)
    measured = perplexities(stored(measured if carry_text else measured.drop(text), "quality-measures", "zstd"), rest)
    bands = stored(perplexity_bands(measured, lang, spec), "quality-bands")
    joined = measured.join(bands, measured[lang].eqNullSafe(bands["band_lang"]), "left")
    wider = F.when(F.col("n_words") > 0, F.sqrt(1 + F.lit(spec.short_words) / F.col("n_words")))
    inside = F.lit(True)
    for c, names in (("log_ppl", ("lo", "hi")), ("word_log_ppl", ("word_lo", "word_hi"))):
        fences, least, _ = spec.bands()[c]
        q1, q3 = F.col(f"{c}_q1"), F.col(f"{c}_q3")
        for name, start, sign, fence in zip(names, (q1, q3), (-1, 1), fences):
            joined = joined.withColumn(name, start + sign * wider * F.greatest(F.lit(least), F.lit(fence) * (q3 - q1)))
        inside = inside & F.col(c).between(F.col(names[0]), F.col(names[1]))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop("band_lang", *quartiles)
