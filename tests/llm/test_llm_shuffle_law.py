"""The draws of the shuffle against their exact laws."""

from collections import Counter
from itertools import product
from math import comb, factorial, prod, sqrt

import pytest
from pyspark.sql import functions as F

from zonehour.llm.exact_shuffle import communication_matrix, deal, hypergeometric

U = "((shiftrightunsigned(xxhash64(id, 3L), 12) + 0.5d) / 4503599627370496d)"


def assert_law(met, law):
    """Counts ``met`` by value follow the probabilities ``law``; values
    expected less than 5 times are taken together."""
    assert sum(law.values()) == pytest.approx(1) and set(met) <= set(law)
    n = sum(met.values())
    cells = [(met[x], n * p) for x, p in law.items() if n * p >= 5]
    rest = (n - sum(m for m, _ in cells), n - sum(e for _, e in cells))
    cells += [rest] if rest[1] >= 1 else []
    free = max(1, len(cells) - 1)
    assert sum((m - e) ** 2 / e for m, e in cells) < free + 5 * sqrt(2 * free)


@pytest.mark.parametrize("good,bad,n", [(7, 9, 6), (1, 30, 4), (40, 2, 41), (500, 700, 300), (100_000, 3, 50_000), (5, 0, 3), (0, 5, 3), (6, 6, 0), (6, 6, 12)])
def test_hypergeometric_law(spark, good, bad, n):
    drawn = spark.range(20_000).select(F.expr(hypergeometric(f"{good}L", f"{bad}L", f"{n}L", U)).alias("x"))
    total = comb(good + bad, n)
    law = {k: comb(good, k) * comb(bad, n - k) / total for k in range(max(0, n - bad), min(good, n) + 1)}
    assert_law(Counter({r.x: r["count"] for r in drawn.groupBy("x").count().collect()}), law)


def test_whole_matrices_have_the_law_of_a_permutation(spark):
    """Each of 20,000 nodes deals the same shards to chunks of 2, 3 and 1 rows."""
    chunks, shards = (2, 3, 1), (3, 2, 1)
    children = ", ".join(f"named_struct('index', id * 3 + {k}, 'n', {n}L)" for k, n in enumerate(chunks))
    nodes = spark.range(20_000).select(F.expr(f"array({children})").alias("children"), F.array(*[F.lit(x).cast("long") for x in shards]).alias("counts"))
    dealt = nodes.select(F.transform(F.expr(deal(5, 0, 3)), lambda c: c["counts"]).alias("m")).groupBy("m").count().collect()
    law = {}
    rows = [[x for x in product(range(4), repeat=3) if sum(x) == n] for n in chunks]
    for m in product(*rows):
        if tuple(map(sum, zip(*m))) == shards:
            ways = prod(map(factorial, chunks)) * prod(map(factorial, shards))
            law[m] = ways / (factorial(sum(chunks)) * prod(factorial(x) for r in m for x in r))
    assert_law(Counter({tuple(map(tuple, r.m)): r["count"] for r in dealt}), law)


def test_matrix_of_a_deep_tree_keeps_its_sums(spark):
    sizes, n = [700, 0, 1, 1299], [k % 14 for k in range(300)]
    n[7] += 2000 - sum(n)
    rows = communication_matrix(spark.createDataFrame(list(enumerate(n)), "index bigint, n bigint"), sizes, 11).collect()
    assert sorted((r["index"], sum(r.counts)) for r in rows) == list(enumerate(n))
    assert [sum(r.counts[j] for r in rows) for j in range(4)] == sizes
    assert min(x for r in rows for x in r.counts) >= 0
