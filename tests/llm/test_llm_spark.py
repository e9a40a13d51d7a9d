"""The operators on awkward tables, and the queries against DuckDB or a
brute-force version on the smallest tables."""

import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import corpus_pipeline  # noqa: E402
from check_oracle import canon, duck  # noqa: E402
from zonehour.llm import queries as Q  # noqa: E402
from zonehour.llm.best_fit_packing import best_fit_packing  # noqa: E402
from zonehour.llm.chat_format import format_conversations, load_tokenizer, read_back  # noqa: E402
from zonehour.llm.components import connected_components  # noqa: E402
from zonehour.llm.decontaminate import match_benchmark  # noqa: E402
from zonehour.llm.exact_shuffle import exact_shuffle, hypergeometric  # noqa: E402
from zonehour.llm.language_id import fit_language_model, predict_languages, smallest_hashes  # noqa: E402
from zonehour.llm.ngram_quality import judge_quality  # noqa: E402
from zonehour.llm.ppm_scoring import score_documents  # noqa: E402
from zonehour.llm.simhash_dedup import keep_one, simhash_components  # noqa: E402
from zonehour.llm.token_codes import encode_documents  # noqa: E402
from zonehour.llm.url_reputation import filter_urls  # noqa: E402

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000
# clashing names: the operators' own columns, and internal ones
SCHEMA = "doc_id bigint, text string, lang string, source string, shard string, kept string, fp string, hits string, block string"
ROWS = [
    (1, "the cat sat on the mat and the dog ran off with a bone", "en", "a"),
    (1, "the cat sat on the mat and the dog ran off with a bone", "en", "a"),
    (2, "The cat sat on the mat and the dog ran off with a bone", "en", None),
    (3, None, None, "b"),
    (4, "", "en", "b"),
    (None, "le chat est sur la table avec le chien", "fr", "c"),
    (None, None, "fr", "c"),
    (5, "12 34 \n\n ...", "en", "a"),
    (6, LONG, "en", "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_matches_duckdb(spark, con, name):
    got, want = canon(Q.QUERIES[name](spark, SF).toPandas()), canon(con.execute(Q.ORACLE_SQL[name]).df())
    assert got == want


def test_chat_format_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "assistant", "a <|end|> \\ b"), (None, 1, "assistant", "é"), (2, 3, "ro\nle", LONG)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    got = {r.conv_id: r for r in read_back(format_conversations(turns, load_tokenizer(Q.TOKENIZER))).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[None].loss_chars, got[2].loss_chars) == (3, 13, 1, 0)
    assert read_back(format_conversations(turns.where("false"), load_tokenizer(Q.TOKENIZER))).count() == 0


def test_packing_odd_rows(odd):
    got = best_fit_packing(odd, capacity=100).collect()
    sizes = Counter()
    for r in got:
        sizes[r.bin_id] += r.n_tokens
    assert max(sizes.values()) <= 100
    assert sum(r.n_tokens for r in got) == sum(len((r[1] or "").encode()) + 1 for r in ROWS)
    assert best_fit_packing(odd.where("false")).count() == 0


def test_url_filter_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, "nothing", "x"), (3, "HTTP://A.B.co.uk:80?q#f", "x"), (3, "http://u@net/", "x"), (None, "x://example.net/en/", "x")], "page_id bigint, url string, bound string")
    labels = spark.createDataFrame([(3, True), (3, True), (None, True), (2, None)], "page_id bigint, bad boolean")
    got = sorted((r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, labels, Q.URL_RULES).collect())
    assert [r[:2] for r in got] == [("", ""), ("", ""), ("a.b.co.uk:80", ""), ("example.net", "/en/"), ("u@net", "/")]
    assert got[3][2:] == ("example.net/en/", "allow")
    assert filter_urls(pages.where("false"), labels, Q.URL_RULES).count() == 0
    assert {r.verdict for r in filter_urls(pages, labels.where("false"), ()).collect()} == {"allow"}


def test_exact_shuffle(spark, odd):
    draws = spark.range(20000).select(F.expr(hypergeometric("7L", "9L", "6L", "((shiftrightunsigned(xxhash64(id, 3L), 12) + 0.5d) / 4503599627370496d)")).alias("x"))
    assert draws.agg(F.avg("x")).first()[0] == pytest.approx(6 * 7 / 16, abs=0.03)
    got = exact_shuffle(odd, 4)
    assert got.columns[-2:] == ["shard", "slot"] and set(got.columns) == {*odd.columns, "slot"}
    rows = got.collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [2, 2, 2, 3]
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(4))
    assert exact_shuffle(odd.where("false"), 4).count() == 0


def test_exact_shuffle_many_chunks(spark):
    rows = exact_shuffle(spark.range(0, 100_001, numPartitions=5), 3, seed=9)
    got = {r.shard: (r.n, r.lo, r.hi, r.mean) for r in rows.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.avg("id").alias("mean")).collect()}
    assert sorted(x[0] for x in got.values()) == [33333, 33334, 33334]
    assert all(lo == 0 and hi == n - 1 and abs(mean - 50_000) < 1000 for n, lo, hi, mean in got.values())
    assert rows.select("id").distinct().count() == 100_001


def test_language_held_out_accuracy(spark, odd):
    got = Q.op9_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    model = fit_language_model(odd)
    rows = predict_languages(odd, model).collect()
    assert len(rows) == len(ROWS) and all(r.lang_pred == "und" and r.score == 0 for r in rows if not r.text or r.doc_id == 5)
    assert {r.lang_pred for r in predict_languages(odd, fit_language_model(odd.where("false"))).collect()} == {"und"}


@pytest.mark.parametrize("n", [1, 300, 5000])
def test_smallest_hashes_equal_brute_force(spark, n):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit("a")).otherwise(F.lit("b")).alias("lang"), F.xxhash64(F.col("id") % 4001).alias("hash"))
    by_lang = {}
    for r in rows.distinct().collect():
        by_lang.setdefault(r.lang, []).append(r.hash)
    got = [(r.lang, r.hash) for r in smallest_hashes(rows, n).collect()]
    assert sorted(got) == sorted((k, h) for k, hashes in by_lang.items() for h in sorted(hashes)[:n])
    assert smallest_hashes(rows.where("false"), n).count() == 0


def test_quality_odd_rows(spark, odd):
    rows = judge_quality(odd.withColumn("text", F.when(F.col("doc_id") == 2, F.concat(*[F.lit(f"w{i} ") for i in range(60)])).otherwise(F.col("text")))).collect()
    assert len(rows) == len(ROWS)
    assert {r.doc_id for r in rows if r.kept} == {2} and all(r.n_words == 0 for r in rows if r.doc_id in (3, 4))
    assert judge_quality(odd.where("false")).count() == 0


def test_scoring_odd_rows(spark, odd):
    rows = score_documents(odd.withColumn("train", F.col("doc_id") == 1)).collect()
    assert len(rows) == len(ROWS)
    train = 2 * 15
    assert {r.train_tokens for r in rows} == {train}
    by = {(r.doc_id, r.n_tokens): r for r in rows}
    assert by[3, 1].n_known == 1 and by[2, 15].n_known == 15 and by[6, 60001].n_known == 1
    assert score_documents(odd.withColumn("train", F.lit(None).cast("boolean"))).where("n_known > 0").count() == 0
    assert score_documents(odd.where("false").withColumn("train", F.lit(True))).count() == 0


def test_scoring_against_brute_force(spark):
    import math

    got = {r.doc_id: r for r in Q.op5_ppm_scoring(spark, SF).collect()}
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    counts: Counter = Counter()
    for k, t in docs:
        if zlib.crc32(str(k).encode()) % 5 != 1:
            counts.update(t.encode().lower().split() + [b""])
    n, v = sum(counts.values()), len(counts)
    for k, t in docs:
        words = t.encode().lower().split() + [b""]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert got[k].base_score == pytest.approx(base) and got[k].score < 0


def test_decontamination_odd_rows(spark, odd):
    bench = spark.createDataFrame([(7, "Cat sat on the mat, and the dog ran off with"), (8, "le chien"), (9, None), (10, "..."), (None, "34"), (7, "Cat sat on the mat, and the dog ran off with")], "item_id bigint, text string")
    rows = match_benchmark(odd, bench).collect()
    assert len(rows) == len(ROWS)
    by = {(r.doc_id, r.text and r.text[:3]): r for r in rows}
    assert by[1, "the"].item_ids == ["7"] and by[1, "the"].hits == list(range(1, 12)) and by[2, "The"].near_ids == ["7"]
    assert by[None, "le "].item_ids == ["8"] and by[5, "12 "].hits == [1] and by[5, "12 "].item_ids == []
    assert by[3, None].n_words == 0 and by[3, None].hits == []
    assert match_benchmark(odd, bench.where("false")).where("size(hits) > 0").count() == 0
    assert match_benchmark(odd.where("false"), bench).count() == 0


def test_simhash_odd_rows(spark, odd):
    rows = simhash_components(odd).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows if r.doc_id}
    assert by[3].fingerprint == "0" * 16 and by[3].component_id == by[4].component_id == 3
    assert by[1].component_id == by[2].component_id == 1
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (False, 5), (False, 6), (True, 0)]
    assert simhash_components(odd.where("false")).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 200, 201: 200}


def test_token_codes_odd_rows(spark, odd):
    got = encode_documents(odd, load_tokenizer(Q.TOKENIZER)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 1, 2, 3, 4, 5, 6]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert got[5].n_tokens == 1 and got[5].ids_crc32 == zlib.crc32(b"\0\0\0\0")
    assert encode_documents(odd.where("false"), load_tokenizer(Q.TOKENIZER)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).persist()
        assert docs.columns == columns, name
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept
    contaminated = {r.doc_id for r in Q.op6_decontaminate(spark, SF).where("contaminated").collect()}
    failed = {r.doc_id for r in Q.op2_ngram_quality(spark, SF).where("base_failed").collect()}
    assert kept and not kept & (contaminated | failed)
    fingerprints = Counter(r.fingerprint for r in Q.op7_simhash_dedup(spark, SF).collect() if r.doc_id in kept)
    assert max(fingerprints.values()) == 1
