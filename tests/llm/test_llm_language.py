"""Language identification against a brute-force version: features counted
one n-gram at a time, machines solved exactly from their Gram matrix."""

import re
import zlib
from collections import Counter
from itertools import combinations
from math import exp, log1p

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from zonehour.llm import queries as Q
from zonehour.llm.language_id import LanguageSpec, family

SF = "/root/testdata/sf0.001"
SPEC = LanguageSpec()
OTHER = re.compile("[^a-zÀ-ÖØ-öø-῿Ⰰ-\U0010ffff]+")


def vector(text):
    counts = Counter()
    codes = [32, *map(ord, OTHER.sub(" ", text.lower())), 32]
    for i in range(len(codes)):
        h = 0
        for n, c in enumerate(codes[i : i + 3], 1):
            h = (h + c + n) * 0x9E3779B97F4A7C15 % 2**64
            counts[(h >> 40) % SPEC.dim] += 1
    out = np.zeros(SPEC.dim + 1)
    for place, n in counts.items():
        out[place] = log1p(n)
    out /= np.sqrt(out @ out)
    out[-1] = 1  # the bias
    return out


def machine(x, y):
    """Weights of the squared-hinge machine: rows within the margin solve a
    linear system, found again until they stay the same."""
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    slack = share / SPEC.cost  # 1 / (2 cost weight), a class's weight being 1 / (2 share)
    gram, inside = x @ x.T, np.ones(len(y), bool)
    for _ in range(200):
        a = np.zeros(len(y))
        a[inside] = np.linalg.solve(gram[np.ix_(inside, inside)] + np.diag(slack[inside]), y[inside])
        now = y * (gram @ a) < 1
        if (now == inside).all():
            return x.T @ a
        inside = now
    raise AssertionError("no fixed set of rows within the margin")


def fitted(training):
    """machines by pair of sets of languages, from (text, lang) rows; every
    language has fewer distinct texts than the sample takes."""
    parts = {}
    for text, lang in {(t, la) for t, la in training if t is not None and la is not None}:
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        h -= (h >> 63) << 64
        at = [(h + k * 7919) % max(1, len(text) - SPEC.slice_chars) for k in range(SPEC.slices)]
        parts.setdefault(lang, []).extend(p for p in [text, *(text[a : a + SPEC.slice_chars] for a in at)] if any(map(str.isalpha, p)))
    assert all(len(p) < 3 * SPEC.sample_texts for p in parts.values())
    vectors = {lang: np.array([vector(p) for p in found]) for lang, found in parts.items()}
    families = {}
    for lang in sorted(vectors):
        families.setdefault(family(lang), []).append(lang)
    machines = {}
    for level, sides in [("family", families), *(("language", {x: [x] for x in langs}) for langs in families.values())]:
        for a, b in combinations(sorted(sides), 2):
            xa, xb = (np.concatenate([vectors[x] for x in sides[s]]) for s in (a, b))
            machines[level, a, b] = machine(np.concatenate([xa, xb]), np.repeat([1.0, -1.0], [len(xa), len(xb)]))
    return families, machines


def predicted(text, families, machines):
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0
    x, score = vector(text), 1.0

    def best(level, names):
        nonlocal score
        margins = {n: [x @ machines[level, n, o] if (level, n, o) in machines else -(x @ machines[level, o, n]) for o in names if o != n] for n in names}
        name = max(names, key=lambda n: (sum(m > 0 for m in margins[n]), sum(margins[n])))
        if margins[name]:
            score *= sum(1 / (1 + exp(-SPEC.slope * m)) for m in margins[name]) / len(margins[name])
        return name

    lang = best("language", families[best("family", sorted(families))])
    return lang, score


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def test_query_against_brute_force(spark, docs):
    held_out = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs}
    model = fitted([(r.text, r.lang) for r in docs if not held_out[r.doc_id]])
    got = {r.doc_id: r for r in Q.op9_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        lang, score = predicted(r.text, *model)
        assert (got[r.doc_id].held_out, got[r.doc_id].lang_pred) == (held_out[r.doc_id], lang)
        assert got[r.doc_id].score == pytest.approx(score, abs=0.005)


def test_stage_keeps_what_brute_force_keeps(spark, docs):
    model = fitted([(r.text, r.lang) for r in docs])
    want = {}
    for r in docs:
        lang, score = predicted(r.text, *model)
        assert abs(score - corpus_pipeline.MIN_LANGUAGE_SCORE) > 0.005
        if lang != "und" and score >= corpus_pipeline.MIN_LANGUAGE_SCORE:
            want[r.doc_id] = lang
    kept = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert {r.doc_id: r.lang for r in kept.collect()} == want
    assert len(want) > len(docs) // 2
