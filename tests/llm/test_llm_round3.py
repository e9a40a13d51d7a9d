"""Source mixing, source divergence and vector codes: kernels against brute
force, awkward tables, hot keys and repeated rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonehour.llm import common
from zonehour.llm import source_divergence as D
from zonehour.llm import vector_codes as V
from zonehour.llm.common import joined_small, stored
from zonehour.llm.source_mixing import MixSpec, measured, mix_sources, repeated, source_targets

SCHEMA = "doc_id bigint, text string, lang string, source string, size string, hash string, target string, rank string, row string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", "h", "t", "r", "w") for r in rows], SCHEMA)


# ---- source mixing ----


def test_targets_share_by_weight_up_to_twice_the_size(spark):
    sizes = {"a": 10, "b": 1000, None: 400, "c": 1, "d": 0}
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], (5, 2, 1, 5, 2)))
    level = next(x for x in np.linspace(0, 2000, 2_000_001) if sum(min(2 * n, weights[s] * x) for s, n in sizes.items()) >= 1.5 * 1411)
    assert got == {s: pytest.approx(min(2 * n, weights[s] * level), abs=0.01) for s, n in sizes.items()}
    assert sum(got.values()) == pytest.approx(1.5 * 1411)


@pytest.mark.parametrize("bits", [12, 20])
def test_mix_reaches_its_targets(spark, monkeypatch, bits):
    """A hot source, one very long document, many rows without words, and
    repeated rows that only their number tells apart."""
    monkeypatch.setattr("zonehour.llm.source_mixing.LEVEL_BITS", bits)
    rows = [(k, "w " * (k % 7), "en", "hot") for k in range(600)] + [(1000 + k, "x y z", "en", "b") for k in range(120)]
    rows += [(7, "same words here", "en", "c")] * 90 + [(2000, "long " * 500, "en", None), (2001, None, "en", None), (None, "", "en", "d")]
    docs = measured(table(spark, rows)).drop("target")
    first, again = mix_sources(docs), mix_sources(docs.repartition(5))
    assert first.columns == ["doc_id", "text", "lang", "source", "rank", "row", "size", "hash", "source_size", "target", "copies"]
    got = first.collect()
    assert len(got) == len(rows)
    key = lambda r: tuple(map(str, (r.doc_id, r.source, r.copies)))
    assert sorted(map(key, got)) == sorted(map(key, again.collect()))
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= 2 and (r.size > 0 or r.copies == 0)
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in target)
    assert repeated(first).count() == sum(r.copies for r in got)


def test_larger_budget_takes_a_superset(spark):
    docs = measured(table(spark, [(k, "a b c", "en", "s%d" % (k % 3)) for k in range(300)]))
    small, large = ({r.doc_id: r.copies for r in mix_sources(docs, MixSpec(share=x)).collect()} for x in (0.5, 0.8))
    assert all(large[k] >= n for k, n in small.items())


def test_mix_of_no_rows(spark):
    assert mix_sources(measured(table(spark, [(1, "a", "en", "s")])).where("false")).count() == 0
    assert [r.copies for r in mix_sources(measured(table(spark, [(1, None, None, None)]))).collect()] == [0]


def test_joined_small_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(common, "SMALL_BYTES", 0)
    rows = spark.createDataFrame([(k, None if k % 3 else "a") for k in range(50)], "n bigint, key string")
    small = stored(spark.createDataFrame([(None, 1), ("a", 2)], "key string, value int"), "small")
    got = joined_small(rows, small, "key", "n")
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.n, r.value) for r in got.collect()) == [(k, 1 if k % 3 else 2) for k in range(50)]


# ---- source divergence ----


def test_gallop_finds_the_first_not_below():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (1, 1), (7, 1000), (200, 200), (3, 64)):
        small, large = np.unique(rng.integers(0, 500, n)), np.unique(rng.integers(0, 500, m))
        assert (D.gallop(small, large) == np.searchsorted(large, small)).all()


def test_price_equals_the_sum_over_terms():
    rng = np.random.default_rng(2)
    for n, m in ((0, 0), (0, 4), (30, 2), (25, 40)):
        a, b = (dict(zip(rng.choice(60, k, replace=False).tolist(), rng.integers(1, 99, k).tolist())) for k in (n, m))
        side = lambda x, p0: (np.array(sorted(x), np.int64), np.array([x[k] for k in sorted(x)], np.int64), p0)
        want = sum(abs(a.get(t, 3) - b.get(t, 8)) for t in a.keys() | b.keys())
        assert D.price(side(a, 3), side(b, 8)) == D.price(side(b, 8), side(a, 3)) == (want, len(a.keys() | b.keys()))


def test_shares_are_exact_for_large_counts():
    counts = [0, 1, 10**12, 7 * 10**14]
    got = D.shares(np.array(counts), 8 * 10**15, 10**9, 5)
    assert got.tolist() == [1 + 10**9 * (c + 5) // (8 * 10**15 + 5 * 10**9) for c in counts]


def brute_audit(rows, spec):
    words = [((lang or ""), (source or ""), (text or "").encode().translate(D.LETTERS).split()) for _, text, lang, source in rows]
    docs, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, found in words:
        docs.update((lang, w) for w in set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), n in docs.items() if x == lang and n >= spec.min_docs]
        share = lambda c: {t: 1 + 10**9 * (c[t] + spec.smooth) // (sum(c[x] for x in kept) + spec.smooth * len(kept)) for t in kept}
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t.decode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, spec.top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:top]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("spec", [D.DivergenceSpec(min_docs=3, block_terms=4, tile=2, top=4), D.DivergenceSpec(min_docs=3)])
def test_audit_equals_brute_force(spark, spec):
    rng = np.random.default_rng(3)
    vocabulary = ["Ab", "ab", "c", "déjà", "Ünder", "x" * 300, "zz", "q1r", "don't", "e", "f", "日本"]
    rows = [(k, " ".join(rng.choice(vocabulary, rng.integers(0, 9))), ["en", "fr", None][k % 3], None if k % 11 == 0 else "s%d" % (k % 9 if k % 2 else 1)) for k in range(200)]
    rows += [(900, None, "en", "silent"), (901, "only once", "xx", "a"), (902, "", "xx", "b"), (903, "e " * 50_000, "fr", "s1"), (903, "e " * 50_000, "fr", "s1")]
    got = sorted(tuple(r) for r in D.audit_sources(table(spark, rows), spec).collect())
    assert got == brute_audit(rows, spec)
    assert {x[4] for x in got if x[0] == "xx"} == {0}


def test_audit_of_no_rows(spark):
    assert D.audit_sources(table(spark, [(1, "a", "en", "s")]).where("false")).count() == 0


# ---- vector codes ----


def brute_codes(vectors, spec):
    d = len(vectors[0]) // spec.parts
    x = [[math.floor(spec.scale * v) for v in row] for row in vectors]
    books = [[row[p * d : p * d + d] for row in x[: spec.entries]] for p in range(spec.parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(row[p * d : p * d + d], e)), k) for k, e in enumerate(books[p])) for p in range(spec.parts)] for row in x]

    for _ in range(spec.rounds):
        found = assign()
        for p in range(spec.parts):
            for k in range(len(books[p])):
                members = [row[p * d : p * d + d] for row, f in zip(x, found) if f[p][1] == k]
                if members:
                    books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    found = assign()
    return ["".join("%02x" % k for _, k in f) for f in found], [sum(e for e, _ in f) for f in found], books


@pytest.mark.parametrize("size", [1.0, 1e7, 1e11, 1e30])
def test_codes_equal_brute_force(spark, size):
    """Exact in doubles, 64-bit and Python integers; a few distinct values, so
    that ties and unmoved entries are frequent."""
    rng = np.random.default_rng(5)
    spec = V.CodeSpec(parts=4, entries=6, rounds=4)
    vectors = (rng.integers(-3, 4, (90, 8)) * size / 8).tolist()
    df = spark.createDataFrame([(k, v, "x", "y") for k, v in enumerate(vectors)], "id bigint, v array<double>, code string, vector string").repartition(3)
    coded, books = V.compress_vectors(df, "v", "id", spec)
    got = sorted(coded.collect())
    codes, errors, want = brute_codes(vectors, spec)
    assert [b.tolist() for b in books] == want
    if size < 1e29:
        assert [r.code for r in got] == codes and [r.error for r in got] == [min(e, V.MOST) for e in errors]
    assert coded.columns == ["id", "vector", "code", "error"]


def test_active_entries_equal_a_complete_scan():
    rng = np.random.default_rng(6)
    x = rng.integers(-5, 6, (500, 3)).astype(float)
    entries = rng.integers(-5, 6, (12, 3)).astype(object)
    code, far = np.zeros(500, np.int64), np.full(500, V.MOST)
    V.assign_part(x, entries, np.ones(12, bool), code, far)
    for _ in range(20):
        moved = rng.random(12) < 0.3
        entries = entries.copy()
        entries[moved] = rng.integers(-5, 6, (moved.sum(), 3))
        V.assign_part(x, entries, moved, code, far)
        at, least = V.nearest(V.distances(x, entries))
        assert (at == code).all() and (least == far).all()


def test_codes_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0] * 16), (5, [0.5] * 16), (5, [0.5] * 16), (1, None), (2, []), (3, [nan] + [0.0] * 15), (4, [inf] + [0.0] * 15), (6, [None] + [0.0] * 15), (0, [1.0] * 3), (7, [2.0] * 32)]
    df = spark.createDataFrame(rows, "id bigint, v array<float>")
    coded, books = V.compress_vectors(df, "v", "id")
    assert sorted((r.id is None, r.code[:2], r.error) for r in coded.collect()) == [(False, "00", 0), (False, "00", 0), (True, "02", 0)]
    assert [len(b) for b in books] == [3] * 16
    none, books = V.compress_vectors(df.where("false"), "v", "id")
    assert none.count() == 0 and all(len(b) == 0 for b in books)
