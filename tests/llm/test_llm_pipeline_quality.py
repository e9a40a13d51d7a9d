"""What the pipeline's quality stage keeps of its own input, by brute force,
and what run() packs."""

import math
import re
from collections import Counter

from test_llm_brute import SF, WORD, brute_kept, brute_kneser_ney, folded

import corpus_pipeline
from zonehour.llm import queries as Q
from zonehour.llm.ngram_quality import ORDER, QualitySpec


def stage_kept(rows):
    """doc_ids that pass the base rules and their language's bands."""
    spec, p, cache, per_char, per_word, n_words = QualitySpec(), brute_kneser_ney([r.text or "" for r in rows]), {}, {}, {}, {}
    for r in rows:
        words = WORD.findall((r.text or "").encode())
        windows = Counter(zip(words, words[1:], words[2:]))
        repeats = len({i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)})
        if len(words) < spec.min_words or 100 * repeats > spec.max_repeat_pct * len(words):
            continue
        s = folded(r.text)
        grams = [s[i - ORDER + 1 : i + 1] for i in range(ORDER - 1, len(s))]
        for g in grams:
            if g not in cache:
                cache[g] = math.log(p(g[:-1], g[-1]))
        total = -sum(cache[g] for g in grams)
        per_char[r.doc_id], per_word[r.doc_id], n_words[r.doc_id] = total / len(grams), total / len(words), len(words)
    return brute_kept({r.doc_id: r.lang for r in rows if r.doc_id in per_char}, n_words, per_char, per_word)


def test_symbols_and_tables_are_rejected_and_prose_is_kept(spark):
    """On sf0.1: of the texts that pass the base rules, those with symbols
    glued to their words go, most tables of words go, prose stays."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    odd = re.compile(r"[^A-Za-zÀ-ÿ\s.,;:'\"!?()-]")
    judged = {r.doc_id: r for r in Q.op2_ngram_quality(spark, "/root/testdata/sf0.1").where("not base_failed").select("doc_id", "kept").collect()}
    kept = {"glued": [], "table": [], "prose": []}
    for r in docs.collect():
        if r.doc_id in judged:
            share = len(odd.findall(r.text)) / len(r.text)
            kind = "table" if r.text.count(" | ") > len(r.text.split()) / 4 else "glued" if share > 0.15 else "prose" if share < 0.02 else None
            if kind:
                kept[kind].append(judged[r.doc_id].kept)
    rate = {kind: sum(x) / len(x) for kind, x in kept.items()}
    assert len(kept["glued"]) > 300 and len(kept["prose"]) > 7000
    assert rate["glued"] <= 0.02 and rate["table"] <= 0.5 and rate["prose"] >= 0.99


def test_quality_stage_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).persist()
        if name == "quality":
            rows = before.collect()
            kept = {r.doc_id for r in docs.collect()}
            assert kept == stage_kept(rows) and kept < {r.doc_id for r in rows}
    size = {r.doc_id: len((r.text or "").encode()) + 1 for r in docs.collect()}
    packed = Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        packed[r.doc_id] += r.n_tokens
    assert packed == size
