"""The queries that SQL can't express against brute-force versions, on the
whole smallest tables."""

import math
import re
import struct
import zlib
from collections import Counter
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from zonehour.llm import queries as Q
from zonehour.llm.ngram_quality import ORDER, SYMBOLS, QualitySpec
from zonehour.llm.simhash_dedup import near_links

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


def folded(text):
    """The starts and the UTF-16 units of a text, none folded."""
    units = text.encode("utf-16-le")
    return (0xD800,) * (ORDER - 1) + struct.unpack(f"<{len(units) // 2}H", units)


def brute_kept(langs, n_words, log_ppl, word_log_ppl):
    """Ids (the keys of each) whose log perplexities both lie in the bands of
    their language."""
    spec, kept = QualitySpec(), set(langs)
    for value, (lower, upper), least, step in ((log_ppl, spec.char_fences, spec.char_least, spec.char_step), (word_log_ppl, spec.word_fences, spec.word_least, spec.word_step)):
        by_lang = {}
        for k, lang in langs.items():
            by_lang.setdefault(lang, []).append((math.floor(value[k] / step) + 0.5) * step)
        for k, lang in langs.items():
            steps = sorted(by_lang[lang])
            q1, q3 = (steps[math.ceil(len(steps) * q / 4) - 1] for q in (1, 3))
            wider = math.sqrt(1 + spec.short_words / n_words[k])
            if not q1 - wider * max(least, lower * (q3 - q1)) <= value[k] <= q3 + wider * max(least, upper * (q3 - q1)):
                kept.discard(k)
    return kept


def brute_kneser_ney(texts):
    """p(symbol | context) of interpolated modified Kneser-Ney, from the text
    book's sums over dictionaries."""
    top = Counter()
    for t in texts:
        s = folded(t)
        top.update(s[i - ORDER + 1 : i + 1] for i in range(ORDER - 1, len(s)))
    counts = {ORDER: top}
    for n in range(ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    followers, discount = {}, {}
    for n, grams in counts.items():
        for g, c in grams.items():
            followers.setdefault(g[:-1], {})[g[-1]] = c
        met = Counter(grams.values())
        if all(met[k] for k in (1, 2, 3)):
            y = met[1] / (met[1] + 2 * met[2])
            d = [k - (k + 1) * y * met[k + 1] / met[k] for k in (1, 2, 3)]
            discount[n] = [min(max(x, 0.1), k - 0.1) for k, x in zip((1, 2, 3), d)]
        else:
            discount[n] = [0.5, 1.0, 1.5]

    def p(context, symbol):
        lower = p(context[1:], symbol) if context else 1 / SYMBOLS
        found = followers.get(context)
        if not found:
            return lower
        d = discount[len(context) + 1]
        total, kept = sum(found.values()), sum(d[min(c, 3) - 1] for c in found.values())
        own = found.get(symbol, 0)
        return (own - d[min(own, 3) - 1] if own else 0) / total + kept / total * lower

    return p


def test_quality_against_brute_force(spark, docs):
    got = {r.doc_id: r for r in Q.op2_ngram_quality(spark, SF).collect()}
    p, cache = brute_kneser_ney([r.text or "" for r in docs]), {}
    n_words, log_ppl, word_log_ppl = {}, {}, {}
    for r in docs:
        words = WORD.findall((r.text or "").encode())
        windows = Counter(zip(words, words[1:], words[2:]))
        repeats = len({i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)})
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x.encode())]
        want = (
            len(words),
            sum(len(w.decode()) for w in words),
            len(re.findall(r"[#*$%&|<>]", r.text or "")),
            len(lines) - len(set(lines)),
            repeats,
            len(words) < 50 or 100 * repeats > 50 * len(words),
        )
        assert got[r.doc_id][1:7] == want
        if not want[-1]:
            s = folded(r.text)
            for i in range(ORDER - 1, len(s)):
                g = s[i - ORDER + 1 : i + 1]
                if g not in cache:
                    cache[g] = math.log(p(g[:-1], g[-1]))
            total = -sum(cache[s[i - ORDER + 1 : i + 1]] for i in range(ORDER - 1, len(s)))
            n_words[r.doc_id], log_ppl[r.doc_id], word_log_ppl[r.doc_id] = want[0], total / (len(s) - ORDER + 1), total / want[0]
            assert got[r.doc_id].log_ppl == pytest.approx(log_ppl[r.doc_id], abs=1e-9)
            assert got[r.doc_id].word_log_ppl == pytest.approx(word_log_ppl[r.doc_id], abs=1e-9)
    assert {k for k, r in got.items() if r.kept} == brute_kept({r.doc_id: r.lang for r in docs if r.doc_id in log_ppl}, n_words, log_ppl, word_log_ppl)


def brute_simhash(text):
    words = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    """The least key reachable from each key of ``fps`` over all links."""
    root = {k: k for k in fps}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits and top(a) != top(b):
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {k: top(k) for k in fps}


def test_simhash_against_brute_force(spark, docs):
    fps = {r.doc_id: brute_simhash(r.text) for r in docs}
    least = brute_components(fps, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in Q.op7_simhash_dedup(spark, SF).collect()}
    assert got == {k: (f"{fps[k]:016x}", least[k]) for k in fps}
    assert len(set(least.values())) < len(fps)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_near_links_connect_what_all_pairs_connect(spark, bits):
    fps = [xxhash.xxh64_intdigest(str(k // 12).encode(), 1) for k in range(360)]
    fps = sorted({x ^ sum(1 << (7 * k * j + k) % 64 for j in range(k % 5)) for k, x in enumerate(fps)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = near_links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), bits).collect()
    assert all(0 < ((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= bits for r in links)
    place = {x: k for k, x in enumerate(signed)}
    root = list(range(len(fps)))
    for r in links:
        a, b = root[place[r.u]], root[place[r.v]]
        root = [min(a, b) if x in (a, b) else x for x in root]
    assert dict(enumerate(root)) == brute_components(dict(enumerate(fps)), bits)


def test_token_codes_against_the_library(spark, docs):
    tok = Tokenizer.from_file(Q.TOKENIZER)
    tok.encode_special_tokens = True
    want, start = [], 0
    for r in docs:
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    assert sorted(tuple(r) for r in Q.op10_token_codes(spark, SF).collect()) == want


def test_exact_shuffle_places_every_document(spark, docs):
    rows = Q.op8_exact_shuffle(spark, SF).collect()
    size_of = {r.doc_id: (len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted((k, *v) for k, v in size_of.items())
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(Q.SHARDS)}
    assert all(x == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def assert_packed(rows, docs, capacity):
    """Every document lies in the bins whole, gapless and free of conflicts."""
    meta = {r.doc_id: (r.source, r.text) for r in docs}
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
        bins.setdefault(r.bin_id, []).append(r)
    for k, (_, text) in meta.items():
        at = 0
        for start, n in sorted(pieces.pop(k)):
            assert start == at
            at += n
        assert at == len((text or "").encode()) + 1
    assert not pieces
    for held in bins.values():
        held.sort(key=lambda r: r.slot)
        assert [r.slot for r in held] == list(range(len(held)))
        assert [r.bin_offset for r in held] == [sum(x.n_tokens for x in held[:i]) for i in range(len(held))]
        assert sum(r.n_tokens for r in held) <= capacity
        for part in (0, 1):
            keys = [meta[r.doc_id][part] for r in held if meta[r.doc_id][part] is not None]
            assert len(keys) == len(set(keys))


def test_packing_places_every_document(spark, docs):
    assert_packed(Q.op3_best_fit_packing(spark, SF).collect(), docs, 8192)


def test_pipeline_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept."""
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    sure = stages["language"](spark, rows, SF).persist()
    assert {r.doc_id for r in rows.collect()} >= {r.doc_id for r in sure.collect()}
    good = stages["quality"](spark, sure, SF).persist()
    for r in good.collect():
        words = WORD.findall((r.text or "").encode())
        assert len(words) >= 50
    fps = {r.doc_id: brute_simhash(r.text) for r in good.collect()}
    single = stages["near_duplicates"](spark, good, SF).persist()
    kept = {r.doc_id for r in single.collect()}
    assert kept == set(brute_components(fps, corpus_pipeline.MAX_BITS).values())

    def words(text):
        return re.findall("[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        windows.setdefault(n, set()).update(tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n)
    clean = set()
    for r in single.collect():
        w = words(r.text)
        if not any(tuple(w[i : i + n]) in found for n, found in windows.items() for i in range(len(w) - n + 1)):
            clean.add(r.doc_id)
    last = stages["decontamination"](spark, single, SF).persist()
    assert {r.doc_id for r in last.collect()} == clean and clean < kept
    assert_packed(stages["packing"](spark, last, SF).collect(), last.collect(), corpus_pipeline.CAPACITY)
    assert last.where(F.col("lang").isNull()).count() == 0
