"""Uniform shuffle into shards of exact sizes, in SQL functions only.

Chunks of the input are the rows, shards the columns of a communication
matrix: how many rows of a chunk go to a shard. The matrix is drawn from the
law that a uniform permutation of all rows would give it. A tree over the
chunks deals the shards' sizes down: the counts of a node are dealt to its
children by exact multivariate hypergeometric draws. Then each chunk
permutes its rows and sends runs of them as its matrix row says, and each
shard permutes what it got.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonehour.llm.common import stored

CHUNK_BITS = 14  # a chunk: up to 2**14 consecutive rows of an input partition
FAN_BITS = 4  # a node of the tree has up to 2**4 children
BUCKET_ROWS = 1 << 14  # rows that one window of the last permutation orders, on average


def uniform(*key: Column | int) -> Column:
    """A number in (0, 1) fixed by the key."""
    return (F.shiftrightunsigned(F.xxhash64(*[F.lit(k) if isinstance(k, int) else k for k in key]), 12).cast("double") + 0.5) / float(1 << 52)


def let(name: str, value: str, body: str) -> str:
    """SQL text of ``body`` with ``name`` bound to ``value``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric(good: str, bad: str, n: str, u: str) -> str:
    """SQL text of a hypergeometric draw: of good + bad rows n are drawn, how
    many are good. The arguments are SQL texts of bigints, u of a double in
    (0, 1).

    Inversion from the mode outward: the weights of neighbouring counts
    follow from their ratio. Counts beyond 12 standard deviations (and 30)
    of the mode have less weight than a double's last bit of the sum.
    """
    size = f"({good} + {bad})"
    mode = f"greatest(0L, {n} - {bad}, least({good}, {n}, cast(floor(({n} + 1d) * ({good} + 1d) / ({size} + 2d)) as bigint)))"
    reach = f"cast(30 + 12 * sqrt({n} * 1d * {good} / greatest(1L, {size}) * {bad} / greatest(1L, {size})) as bigint)"
    up = f"(a.w * ({good} - k) / (k + 1d) * ({n} - k) / ({bad} - {n} + k + 1d))"
    down = f"(a.w * k / ({good} - k + 1d) * ({bad} - {n} + k) / ({n} - k + 1d))"
    above = "filter(sequence(s.mode, greatest(s.mode, s.hi - 1)), k -> k < s.hi)"
    below = "filter(sequence(s.mode, least(s.mode, s.lo + 1), -1), k -> k > s.lo)"

    def total(ks: str, w: str) -> str:
        return f"aggregate({ks}, named_struct('w', 1d, 't', 0d), (a, k) -> named_struct('w', {w}, 't', a.t + {w}), a -> a.t)"

    def walk(ks: str, w: str, start: str, step: str) -> str:
        first = f"named_struct('w', 1d, 't', {start}, 'k', s.mode)"
        return f"aggregate({ks}, {first}, (a, k) -> if(a.t > g.goal, a, named_struct('w', {w}, 't', a.t + {w}, 'k', k {step})), a -> a.k)"

    pick = f"if(g.goal < 1d, s.mode, if(g.goal < 1d + t.up, {walk(above, up, '1d', '+ 1')}, {walk(below, down, '1d + t.up', '- 1')}))"
    pick = let("g", f"named_struct('goal', {u} * (1d + t.up + t.down))", pick)
    pick = let("t", f"named_struct('up', {total(above, up)}, 'down', {total(below, down)})", pick)
    return let("m", f"named_struct('mode', {mode}, 'reach', {reach})", let("s", f"named_struct('mode', m.mode, 'lo', greatest(0L, {n} - {bad}, m.mode - m.reach), 'hi', least({good}, {n}, m.mode + m.reach))", pick))


def deal(seed: int, level: int, shards: int) -> str:
    """SQL text: the matrix rows (index, n, counts by shard) of a node's
    ``children`` (index, n), dealt from the node's ``counts``."""
    key = f"xxhash64({seed}L, {level}, c.index, j)"
    u = f"((shiftrightunsigned({key}, 12) + 0.5d) / {1 << 52}d)"
    # d: of the child, rows still to draw (n), rows of the shards not yet passed (rest), drawn counts (got)
    draw = hypergeometric("h.good", "(d.rest - h.good)", "d.n", u)
    one = let("h", "named_struct('good', element_at(b.rest, j))", let("x", draw, "named_struct('n', d.n - x, 'rest', d.rest - h.good, 'got', concat(d.got, array(x)))"))
    start = "named_struct('n', c.n, 'rest', aggregate(b.rest, 0L, (p, q) -> p + q), 'got', cast(array() as array<bigint>))"
    got = f"aggregate(sequence(1, {shards}), {start}, (d, j) -> {one}, d -> d.got)"
    step = let("got", got, "named_struct('rest', zip_with(b.rest, got, (p, q) -> p - q), 'out', concat(b.out, array(named_struct('index', c.index, 'n', c.n, 'counts', got))))")
    first = "named_struct('rest', counts, 'out', cast(array() as array<struct<index: bigint, n: bigint, counts: array<bigint>>>))"
    return f"aggregate(array_sort(children), {first}, (b, c) -> {step}, b -> b.out)"


def communication_matrix(chunks: DataFrame, sizes: list[int], seed: int) -> DataFrame:
    """index, n and counts (rows by shard) of every chunk of ``chunks``
    (index from 0 without gaps, n). The n add up to that of ``sizes``."""
    spark = chunks.sparkSession
    depth = 0
    last = chunks.agg(F.max("index")).first()[0] or 0
    while last >> (FAN_BITS * depth):
        depth += 1
    node = lambda level: F.shiftright("index", FAN_BITS * level)
    counts = F.array(*[F.lit(x).cast("long") for x in sizes])
    made = spark.range(1).select(F.col("id").alias("index"), counts.alias("counts"))
    for level in range(depth - 1, -1, -1):
        totals = chunks.groupBy(node(level).alias("index")).agg(F.sum("n").alias("n"))
        children = totals.groupBy(F.shiftright("index", FAN_BITS).alias("parent")).agg(F.collect_list(F.struct("index", "n")).alias("children"))
        dealt = children.join(made.select(F.col("index").alias("parent"), "counts"), "parent").select(F.explode(F.expr(deal(seed, level, len(sizes)))).alias("c"))
        made = stored(dealt.select("c.index", "c.n", "c.counts"), "shuffle-matrix")
    return made


def exact_shuffle(rows: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """``rows`` with shard (0 to shards - 1) and slot (0, 1, ... within its
    shard): a uniform random order of all rows, cut into shards whose sizes
    differ by one at most.

    Every row is placed, nulls, repeated rows and all; an empty table gives
    no rows. Columns of the input called shard or slot are replaced, all
    others kept as they are.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    mid = F.monotonically_increasing_id()
    placed = stored(rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), mid.alias("id")), "shuffle-rows")
    part, local = F.shiftright("id", 33), F.shiftright(F.col("id").bitwiseAND(F.lit((1 << 33) - 1)), CHUNK_BITS)
    found = stored(placed.groupBy(part.alias("part"), local.alias("local")).agg(F.count("*").alias("n")), "shuffle-chunks")
    # number the chunks: those of the input partitions before, and the place in the own one
    parts = found.groupBy("part").agg((F.max("local") + 1).alias("k"))
    before = parts.select("part", (F.sum("k").over(Window.orderBy("part")) - F.col("k")).alias("before"))
    chunks = stored(found.join(before, "part").select("part", "local", (F.col("before") + F.col("local")).alias("index"), "n"), "shuffle-index")
    total = chunks.agg(F.sum("n")).first()[0] or 0
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix(chunks.select("index", "n"), sizes, seed)
    runs = chunks.join(matrix.select("index", "counts"), "index").select("part", "local", "counts")

    # permute in the chunk; ranks below counts[0] go to shard 0, the next counts[1] to shard 1, ...
    in_chunk = Window.partitionBy("part", "local").orderBy(uniform(seed, 1, F.col("id")), "id")
    ranked = placed.withColumn("part", part).withColumn("local", local).withColumn("rank", F.row_number().over(in_chunk) - 1)
    shard = F.expr("aggregate(counts, named_struct('left', cast(rank as bigint), 'j', 0), (a, c) -> if(a.left < 0, a, named_struct('left', a.left - c, 'j', if(a.left < c, a.j, a.j + 1))), a -> a.j)")
    buckets = max(1, total // shards // BUCKET_ROWS)
    sent = ranked.join(runs, ["part", "local"]).select("row", "id", shard.alias("shard"), uniform(seed, 2, F.col("id")).alias("u"))
    sent = stored(sent.withColumn("bucket", F.floor(F.col("u") * buckets)), "shuffle-sent")

    # permute in the shard: order by u, bucket by bucket
    filled = sent.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = filled.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("start"))
    in_bucket = Window.partitionBy("shard", "bucket").orderBy("u", "id")
    slots = sent.withColumn("rank", F.row_number().over(in_bucket) - 1).join(starts, ["shard", "bucket"])
    return slots.select(*[F.col("row").getField(c).alias(c) for c in names], "shard", (F.col("start") + F.col("rank")).alias("slot"))
