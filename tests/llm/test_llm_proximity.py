"""Proximity matches against brute force, with words replaced, inserted and
moved."""

import random
import re

import duckdb
import pytest

from zonehour.llm import queries as Q
from zonehour.llm.decontaminate import MatchSpec, match_benchmark

ITEM = "alder birch cedar elm fir hazel larch maple oak pine".split()
LONG = [f"stone{k}" for k in range(25)] + ITEM[:3]


def words(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", text.lower())


def brute_near(doc, item, spec):
    """Some stretch of the item's length and slop on both sides holds enough
    of its distinct words."""
    d, i = words(doc), words(item)
    length = len(i) + 2 * spec.slop
    return any(len({*d[s : s + length]} & {*i}) >= spec.near_share * len({*i}) for s in range(len(d)))


def changed(at, *new):
    return [*ITEM[:at], *new, *ITEM[at + 1 :]]


def documents():
    rng = random.Random(3)
    filler = [f"f{k}" for k in range(200)]
    own = [changed(k, "nowhere") for k in range(10)]  # replaced by a word of no item
    own += [changed(k, "f1", "f2", ITEM[k]) for k in range(10)]  # inserted
    own += [changed(k, "stone1") for k in range(10)]
    own += [[w for k, w in enumerate(ITEM) if k not in (a, a + 2)] for a in range(8)]
    own += [ITEM[::-1], ITEM[:7], ITEM[:8], LONG[4:], LONG[:20] + ITEM, LONG[::2], []]
    for _ in range(60):
        part = rng.sample([*ITEM, *LONG], rng.randint(5, 25))
        for _ in range(rng.randint(0, 30)):
            part.insert(rng.randrange(len(part) + 1), rng.choice(filler))
        own.append(part)
    return [" ".join([*rng.choices(filler, k=rng.randint(0, 20)), *x, *rng.choices(filler, k=rng.randint(0, 20))]) for x in own]


@pytest.mark.parametrize("spec", [MatchSpec(), MatchSpec(slop=2, near_share=0.6, block_rows=3)])
def test_near_ids_equal_brute_force(spark, spec):
    docs = documents()
    items = {"1": " ".join(ITEM), "2": " ".join(LONG), "3": "nobody has any of this", "4": "pine, oak; absent"}
    got = match_benchmark(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"), spark.createDataFrame(list(items.items()), "item_id string, text string"), spec)
    want = {k: sorted(i for i, t in items.items() if brute_near(d, t, spec)) for k, d in enumerate(docs)}
    assert {r.doc_id: r.near_ids for r in got.collect()} == want
    assert all("1" in want[k] for k in range(10)) and any(not x for x in want.values())


@pytest.mark.parametrize("at", range(10))
def test_a_replaced_word_that_occurs_nowhere_else(spark, at):
    """The whole corpus lacks the word, in every place of the item."""
    rows = match_benchmark(spark.createDataFrame([(1, " ".join(changed(at, "other"))), (2, "far off")], "doc_id bigint, text string"), spark.createDataFrame([(1, " ".join(ITEM))], "item_id bigint, text string")).collect()
    assert {r.doc_id: (r.near_ids, r.item_ids) for r in rows} == {1: (["1"], []), 2: ([], [])}


def test_query_equals_its_sql_on_changed_passages(spark, tmp_path):
    """Rows alike, null and empty texts, null and repeated item ids included."""
    docs = [*enumerate(documents()), (0, " ".join(ITEM)), (0, " ".join(ITEM)), (900, None), (901, ""), (None, " ".join(LONG))]
    items = [(1, " ".join(ITEM)), (2, " ".join(LONG)), (2, " ".join(LONG)), (2, "absent words"), (3, "nobody has any of this"), (None, "pine, oak; hazel"), (5, None), (6, "...")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = Q.op6_decontaminate(spark, str(tmp_path))
    want = con.execute(Q.ORACLE_SQL["op6_decontaminate"])
    assert [c[0] for c in want.description] == got.columns
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr)
    assert any(r[6] and not r[2] for r in rows) and any(r[2] for r in rows)
