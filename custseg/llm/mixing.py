"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custseg.llm.common import running_before, word_count
from custseg.session import materialise

#: Rows of one source that share a slice of its permutation (one window each).
SLICE_ROWS = 4_096
#: Blocks an output shard holds on average.
SHARD_BLOCKS = 8_192


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   most_repeats: int = 2) -> DataFrame:
    """Per source of ``sizes`` (source, size): ``source_size, rows, target`` (rows: those with words).

    Sources in code-point order (null last) take the ``weights`` in turn and divide ``share``
    times all words. A target above ``most_repeats`` times its source is cut there and the
    excess is shared again by weight among the others. The fixed point of that is a water
    level: in ascending order of capacity per weight, a source is cut as long as the level left
    for it and all later ones reaches its capacity. One row per source passes the windows.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("rows"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), turn + 1)
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * most_repeats)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    used = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("source_size").over(whole) * share - used) / left)
    cut = F.col("cap") <= F.col("weight") * F.col("level")
    # the first uncut source has the level of all uncut ones; later rows take too much off
    final = F.max(F.when(~cut, F.col("level"))).over(whole)
    target = F.when(cut | final.isNull(), F.col("cap").cast("double")) \
        .otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * final))
    return per.select("source", "source_size", "rows", target.alias("target"))


def _ln_gamma(x: str) -> str:
    """SQL text of ln gamma(x) for x >= 1: Stirling's series at x + 8, shifted back."""
    z = f"({x} + 8D)"
    shift = " * ".join(f"({x} + {i}D)" for i in range(8))
    return (f"(({z} - 0.5D) * ln({z}) - {z} + 0.918938533204672742D + 1D / (12D * {z})"
            f" - 1D / (360D * {z} * {z} * {z}) - ln({shift}))")


def _ln_choose(n: str, k: str) -> str:
    return f"({_ln_gamma(f'({n} + 1D)')} - {_ln_gamma(f'({k} + 1D)')} - {_ln_gamma(f'({n} - {k} + 1D)')})"


def hypergeometric(u: str, good: str, total: str, draws: str) -> str:
    """SQL text of a hypergeometric variate by inversion of the uniform ``u``: the number of
    ``good`` items among ``draws`` from ``total``.

    The sum runs over the support, cut at 12 standard deviations on either side, where the
    omitted mass is below the spacing of doubles, so a draw from n blocks costs O(sqrt(n)).
    """
    mean = f"({draws} * 1D * {good} / greatest({total}, 1))"
    width = (f"(12D * sqrt({mean} * (1D - {good} * 1D / greatest({total}, 1)) * "
             f"(({total} - {draws}) * 1D / greatest({total} - 1, 1))) + 12D)")
    low = f"greatest(0L, {draws} + {good} - {total}, cast(floor({mean} - {width}) AS BIGINT))"
    high = f"least({good}, {draws}, cast(ceil({mean} + {width}) AS BIGINT))"
    first = (f"exp({_ln_choose(f'({good} * 1D)', 'c.lo')} + "
             f"{_ln_choose(f'(({total} - {good}) * 1D)', f'({draws} - c.lo)')}"
             f" - {_ln_choose(f'({total} * 1D)', f'({draws} * 1D)')})")
    step = (f"s.p * (({good} - k) * 1D * ({draws} - k)) / ((k + 1D) * ({total} - {good} - {draws} + k + 1D))")
    return (f"element_at(transform(array(named_struct('lo', {low}, 'hi', {high})), c -> "
            f"aggregate(sequence(c.lo, c.hi), "
            f"named_struct('p', {first}, 'sum', 0D, 'x', c.lo), "
            f"(s, k) -> named_struct('p', {step}, 'sum', s.sum + s.p, "
            f"'x', IF(s.sum + s.p < {u} AND k < c.hi, k + 1L, s.x)), s -> s.x)), 1)")


def splitting_tree(quotas: DataFrame, depth: int, seed: int = 0) -> DataFrame:
    """Split exact ``quotas`` (source_no, quota) among 2**depth shards -> (shard, source_no, quota).

    Every node holds one quota per source. Its left child takes half of its blocks, composed by
    a multivariate hypergeometric draw: source after source, a hypergeometric number of what is
    still to be drawn; the right child takes the rest. Quotas add up exactly on every level. A
    node's randomness depends on (seed, level, node, source) alone, so retries and reruns agree.
    """
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("source_no", "quota"))).alias("q")) \
        .select(F.lit(0).cast("long").alias("node"), "q")
    for level in range(depth):
        u = (f"((pmod(xxhash64({seed}, {level}, node, x.source_no), 1099511627776L) + 0.5D) / 1099511627776D)")
        drawn = hypergeometric(u, "x.quota", "a.rest", "a.draws")
        nodes = nodes.withColumn("left", F.expr(f"""
            aggregate(q,
                named_struct('rest', aggregate(q, 0L, (t, x) -> t + x.quota),
                             'draws', aggregate(q, 0L, (t, x) -> t + x.quota) div 2,
                             'out', cast(array() AS array<bigint>)),
                (a, x) -> element_at(transform(array({drawn}), d -> named_struct(
                    'rest', a.rest - x.quota, 'draws', a.draws - d, 'out', concat(a.out, array(d)))), 1),
                a -> a.out)"""))
        halves = F.expr("""array(
            named_struct('node', node * 2, 'q', zip_with(q, left, (x, d) ->
                named_struct('source_no', x.source_no, 'quota', d))),
            named_struct('node', node * 2 + 1, 'q', zip_with(q, left, (x, d) ->
                named_struct('source_no', x.source_no, 'quota', x.quota - d))))""")
        nodes = nodes.select(F.explode(halves).alias("n")).select("n.node", "n.q")
        # a plan holds one level: the draws are large expressions, the nodes few small rows
        nodes = materialise(nodes.repartition("node") if level >= 6 else nodes, "mix_tree")
    return nodes.select(F.col("node").alias("shard"), F.explode("q").alias("x")) \
        .select("shard", "x.source_no", "x.quota").filter("quota > 0")


def _unit(*cols: Column) -> Column:
    """A uniform in [0, 1) from a hash of ``cols``."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most_repeats: int = 2, seed: int = 17,
        cut: bool = True, shard_blocks: int = SHARD_BLOCKS, carry: bool = False) -> DataFrame:
    """Mix ``docs`` to target weights; one row per (input row, epoch) that exists:
    ``uid, doc_id, source, size, source_size, target, epoch, taken, shard, place`` and, with
    ``carry``, the input row as the struct ``row``. ``taken`` = 0 and a null shard mark what the
    mix leaves out.

    A block is one pass over one document. Each source's blocks are permuted, epoch by epoch; the
    quota of a source is the exact number of blocks, in that order, that reach its target. The
    last block is cut at the target (``cut``) or taken whole if that is nearer. The splitting
    tree divides the quotas among the shards, each shard then takes its disjoint range of every
    permutation, and ``place`` is the order of a local shuffle.

    Positions in a permutation come from sums per slice of it (``SLICE_ROWS`` rows each), so a
    source with a third of all rows is spread over many windows. Sizes, not texts, are shuffled.

    Null text has no words and, like an empty one, is never taken (target and size stay defined); a
    null source is a source of its own, last in order; null or repeated identifiers are fine, rows
    count one by one; the draw depends on their content, not on their order or partitions (rows
    equal in identifier, source and text are ordered by their place in a written table). An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"),
                       F.xxhash64(F.col(id_col), F.col(source_col), F.col(text_col)).alias("hash"),
                       F.monotonically_increasing_id().alias("uid"),
                       *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []))
    base = materialise(base, "mix_rows")
    number = Window.orderBy(F.col("source").asc_nulls_last())
    targets = source_targets(base.select("source", "size"), weights, share, most_repeats)
    sources = materialise(targets.withColumn("source_no", F.row_number().over(number)), "mix_sources") \
        .withColumnRenamed("source", "name")
    rows = base.drop("row").join(sources, F.col("source").eqNullSafe(F.col("name"))).drop("name")

    blocks = (rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most_repeats - 1))))
              .withColumn("order", _unit(F.lit(seed), F.col("epoch"), F.col("hash")))
              .withColumn("slice", F.col("epoch") * F.ceil(F.col("rows") / SLICE_ROWS)
                          + F.floor(F.col("order") * F.ceil(F.col("rows") / SLICE_ROWS))))
    real = blocks.filter("size > 0")
    slices = real.groupBy("source_no", "slice").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("blocks"))
    before = running_before(slices, "slice", {"words_before": "words", "blocks_before": "blocks"}, ("source_no",)) \
        .select("source_no", "slice", "words_before", "blocks_before")
    inside = Window.partitionBy("source_no", "slice").orderBy("order", "uid")
    prior = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (real.join(before, ["source_no", "slice"])
              .withColumn("start", F.coalesce(F.sum("size").over(prior), F.lit(0)) + F.col("words_before"))
              .withColumn("rank", F.row_number().over(inside) - 1 + F.col("blocks_before")))
    goal = F.round("target").cast("long")
    if cut:
        taken = F.greatest(F.lit(0), F.least(F.col("size"), goal - F.col("start")))
    else:
        taken = F.when(2 * (goal - F.col("start")) > F.col("size"), F.col("size")).otherwise(F.lit(0))
    placed = materialise(placed.select("uid", "source_no", "epoch", "rank", "hash", taken.cast("long").alias("taken"))
                         .filter("taken > 0"), "mix_blocks")

    quotas = placed.groupBy("source_no").agg(F.count(F.lit(1)).alias("quota"))
    total = placed.count()
    depth = max(0, math.ceil(math.log2(max(1, total / shard_blocks))))
    leaves = splitting_tree(quotas, depth, seed)
    ranges = running_before(leaves, "shard", {"low": "quota"}, ("source_no",))
    # a shard's range of a permutation meets a block through the bins that both lie in
    bins = quotas.select("source_no", F.greatest(F.lit(1), F.ceil(F.col("quota") / 2 ** depth)).alias("bin_size"))
    met = (ranges.join(bins, "source_no")
           .withColumn("bin", F.explode(F.sequence(F.floor(F.col("low") / F.col("bin_size")),
                                                   F.floor((F.col("low") + F.col("quota") - 1) / F.col("bin_size")))))
           .select("source_no", "bin", "shard", "low", "quota"))
    drawn = (placed.join(F.broadcast(bins), "source_no")
             .withColumn("bin", F.floor(F.col("rank") / F.col("bin_size")))
             .join(met, ["source_no", "bin"])
             .filter("rank >= low AND rank < low + quota")
             .select("uid", "epoch", "taken", "shard",
                     _unit(F.lit(seed), F.col("shard"), F.col("epoch"), F.col("hash")).alias("place")))
    out = rows.select("uid", "doc_id", "source", "size", "source_size", "target") \
        .join(drawn, "uid", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    if carry:
        out = out.join(base.select("uid", "row"), "uid")
    return out


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: the columns of ``docs``, whole rows, repeated as often as drawn, in
    files per shard and in shuffled order within a shard."""
    rows = mix(docs, cut=False, carry=True, **options).filter("taken > 0")
    return rows.repartition("shard").sortWithinPartitions("shard", "place").select("row.*")


def taken_words(mixed: DataFrame) -> DataFrame:
    """Digest of ``mix``: one row per input row with the words taken over all epochs."""
    return mixed.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum("taken").alias("taken"), F.count("shard").alias("blocks"),
        F.min("shard").alias("first_shard")).drop("uid")
