"""Language identification by hierarchical discrimination.

One-versus-one linear support vector machines choose the language family
first, and then the language among those of the family. Features are hashed
character 1- to 3-grams of the lower-cased letters, of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonehour.llm.common import stored

# fixed values: families of ISO 639-1 codes; any other language is a family of its own
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "sr", "mk", "pl", "cs", "sk", "sl", "hr", "bs"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "pa", "gu"),
}
UNDETERMINED = "und"
HASH_RANGE_BITS = 12  # 4,096 ranges of hashes


@dataclass(frozen=True)
class LanguageSpec:
    """``sample_texts``: bound on the distinct texts per language that the
    machines are fitted on, those with the smallest hashes. ``slices``: so
    many pieces of a fitting text, each of up to ``slice_chars``, are fitted
    besides the whole, so that short texts are met too. ``max_rounds``:
    passes of the fit. ``slope``: steepness of the score over the margin."""

    dim: int = 1 << 13
    sample_texts: int = 300
    slices: int = 2
    slice_chars: int = 120
    cost: float = 1.0
    max_rounds: int = 30
    slope: float = 4.0


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def features(text: str, dim: int) -> np.ndarray:
    """Unit vector of the hashed 1- to 3-grams' log counts; each run of other
    characters than letters is one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((codes >= 97) & (codes <= 122)) | (codes >= 0xC0) & (codes != 0xD7) & (codes != 0xF7) & ~((codes >= 0x2000) & (codes < 0x2C00))
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    if len(keep):
        keep[0] = True
        keep[1:] |= letter[:-1]
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint64)
    counts = np.zeros(dim)
    gram = np.zeros(len(codes), np.uint64)
    for n in (1, 2, 3):
        gram = (gram[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        counts += np.bincount((gram >> np.uint64(40)) % np.uint64(dim), minlength=dim)
    out = np.log1p(counts)
    return (out / max(1e-9, np.sqrt(out @ out))).astype(np.float32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit_svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dim: int, cost: float, rounds: int) -> np.ndarray:
    """Weights of a linear support vector machine (squared hinge loss, dual
    coordinate descent, the classes weighed alike), the bias last. A row of
    ``x`` is the places below ``dim`` and the values of its other than zero
    features."""
    x = [(np.append(at, dim).astype(np.int64), np.append(v, 1).astype(np.float64)) for at, v in x]
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    slack = 1 / (2 * cost * weight)
    diagonal = np.array([v @ v for _, v in x]) + slack
    alpha, w = np.zeros(len(x)), np.zeros(dim + 1)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        largest = 0.0
        for i in order.permutation(len(x)):
            at, v = x[i]
            g = y[i] * (w[at] @ v) - 1 + slack[i] * alpha[i]
            new = max(0.0, alpha[i] - g / diagonal[i])
            if step := new - alpha[i]:
                w[at] += step * y[i] * v
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w


@dataclass
class LanguageModel:
    """``families``: family -> its languages. ``weights``: by problem, (level,
    a, b), positive margins speak for a."""

    spec: LanguageSpec
    families: dict[str, list[str]]
    weights: dict[tuple[str, str, str], np.ndarray]

    def choose(self, level: str, names: list[str], x: np.ndarray) -> tuple[str, float]:
        """The name with the most wins, then the largest sum of margins; the
        score is the mean win probability against the others."""
        if len(names) == 1:
            return names[0], 1.0
        wins, margins, p = ({n: 0.0 for n in names} for _ in range(3))
        for a, b in combinations(names, 2):
            w = self.weights[level, a, b]
            m = float(x @ w[:-1] + w[-1])
            for n, own in ((a, m), (b, -m)):
                wins[n] += own > 0
                margins[n] += own
                p[n] += 1 / (1 + np.exp(-self.spec.slope * own))
        best = max(names, key=lambda n: (wins[n], margins[n]))
        return best, p[best] / (len(names) - 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not has_letter(text):
            return UNDETERMINED, 0.0
        x = features(text, self.spec.dim).astype(np.float64)
        fam, p = self.choose("family", sorted(self.families), x)
        lang, q = self.choose("language", self.families[fam], x)
        return lang, p * q


def smallest_hashes(rows: DataFrame, n: int) -> DataFrame:
    """lang and hash of the ``n`` smallest distinct hashes of each lang of
    ``rows``. The counts of ranges of hashes tell which ranges can hold them,
    so that no task reads all hashes of a language."""
    known = stored(rows.select("lang", "hash", F.shiftright("hash", 64 - HASH_RANGE_BITS).alias("range")).distinct(), "language-hashes")
    counts = known.groupBy("lang", "range").agg(F.count("*").alias("n"))
    below = F.sum("n").over(Window.partitionBy("lang").orderBy("range")) - F.col("n")
    ranges = stored(counts.withColumn("below", below).where(F.col("below") < n).select("lang", "range"), "language-ranges")
    first = Window.partitionBy("lang").orderBy("hash")
    return known.join(ranges, ["lang", "range"]).withColumn("k", F.row_number().over(first)).where(F.col("k") <= n).select("lang", "hash")


def fit_language_model(docs: DataFrame, spec: LanguageSpec = LanguageSpec()) -> LanguageModel:
    """Fit on the rows of ``docs`` (text, lang). Rows with a null text or lang
    are left out. The fitting sample has up to ``sample_texts`` distinct
    texts per language, so its size does not grow with the rows; the number
    of languages bounds the machines, which the driver holds."""
    spark = docs.sparkSession
    rows = docs.select("text", "lang", F.xxhash64("text").alias("hash")).where("text is not null and lang is not null")
    sample = rows.join(stored(smallest_hashes(rows, spec.sample_texts), "language-sample"), ["lang", "hash"]).dropDuplicates(["lang", "hash"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "hash", "text"))):
                parts = [text]
                for k in range(spec.slices):
                    at = (h + k * 7919) % max(1, len(text) - spec.slice_chars)
                    parts.append(text[at : at + spec.slice_chars])
                made = [features(x, spec.dim) for x in parts if has_letter(x)]
                at = [np.flatnonzero(x).astype(np.int32) for x in made]
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang] * len(made), "hash": [h] * len(made), "part": list(range(len(made))), "at": [a.tobytes() for a in at], "x": [x[a].tobytes() for x, a in zip(made, at)]},
                    schema=pa.schema([("lang", pa.string()), ("hash", pa.int64()), ("part", pa.int32()), ("at", pa.binary()), ("x", pa.binary())]),
                )

    made = sample.mapInArrow(vectors, "lang string, hash bigint, part int, at binary, x binary")
    made = stored(made, "language-features")
    families: dict[str, list[str]] = {}
    for lang in sorted(r.lang for r in made.select("lang").distinct().collect()):
        families.setdefault(family(lang), []).append(lang)
    problems = [("family", a, b, x, y) for a, b in combinations(sorted(families), 2) for x, y in ((a, families[a]), (b, families[b]))]
    problems += [("language", a, b, x, [x]) for langs in families.values() for a, b in combinations(langs, 2) for x in (a, b)]
    model = LanguageModel(spec, families, {})
    if not problems:
        return model
    sides = spark.createDataFrame([(lv, a, b, 1 if x == a else -1, lang) for lv, a, b, x, langs in problems for lang in langs], "level string, a string, b string, side int, lang string")

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("hash", "ascending"), ("part", "ascending")])
        x = [(np.frombuffer(a.as_py(), np.int32), np.frombuffer(v.as_py(), np.float32)) for a, v in zip(table.column("at"), table.column("x"))]
        w = fit_svm(x, np.array(table.column("side").to_pylist(), np.float64), spec.dim, spec.cost, spec.max_rounds)
        return pa.table({**{c: table.column(c)[:1].cast(pa.string()) for c in ("level", "a", "b")}, "w": pa.array([w.tobytes()], pa.binary())})

    fitted = made.join(sides, "lang").groupBy("level", "a", "b").applyInArrow(fit, "level string, a string, b string, w binary")
    model.weights = {(r.level, r.a, r.b): np.frombuffer(bytes(r.w), np.float64) for r in fitted.collect()}
    return model


def predict_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) added; columns of these
    names are replaced, all others and every row kept.

    A null or empty text and one without a letter is ``und`` with score 0, as
    is every text if the model learned no language. With one learned language
    every other text is of it, with score 1.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shipped.value.predict(x.as_py()) for x in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in made], pa.string()), pa.array([p for _, p in made], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
