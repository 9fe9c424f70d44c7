"""Approximate nearest neighbours by inner product: NN-descent graph and greedy graph search."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from custseg.session import materialise

#: Neighbours kept per node, members of a neighbourhood that are joined in a round, rows of the
#: blocks that give the first graph, and the share of new edges at which the descent ends.
#: A block is one matrix product, far cheaper than a round, so large blocks save rounds.
NEIGHBOURS, JOINED, BLOCK, SETTLED = 64, 60, 8192, 0.04
#: Trees that deal the nodes of a band with several blocks to them, sampled nodes per leaf that the trees
#: are fitted on, and leaves of all bands together; larger bands have leaves of several blocks.
TREES, PER_LEAF, LEAVES = 8, 64, 512
#: Rows of a block that are compared with all of it at a time.
SLICE = 512
#: Search: nodes a query keeps, and nodes it expands per round.
BEAM, EXPAND = 96, 24
#: Ratio of the norms in a band of nodes, nodes drawn from a band to enter it by, and those of them
#: that a query starts at.
BAND, SAMPLE, ENTRIES = 1.25, 512, 32


def inner_product(a: Column, b: Column) -> Column:
    """Sum of products in double precision, in order of the components."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda s, x: s + x)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, vec`` without vectors that are null, zero or hold null or non-finite components."""
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
            .filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
            .filter(~F.coalesce(odd, F.lit(True))).filter(F.exists("vec", lambda x: x != 0)))


def norm_of(vec: Column) -> Column:
    """Euclidean norm, free of overflow in the squares."""
    peak = F.array_max(F.transform(vec, lambda x: F.abs(x.cast("double"))))
    # the peak is bound once: inside the sum it would be sought again for every component
    return F.transform(F.array(peak), lambda p: p * F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + (x / p) * (x / p))))[0]


@F.pandas_udf(BinaryType())
def _pack(vectors: pd.Series) -> pd.Series:
    """Directions as bytes for building and walking the graph: a 32-bit factor and 16-bit components, whose
    product is the unit vector. Every vector has its own factor, so no other one takes its bits.
    Final scores never use them."""
    if not len(vectors):
        return pd.Series([], dtype=object)
    x = np.array(vectors.tolist(), np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    factor = (1 / np.sqrt((x * x).sum(1)) / 32767).astype(np.float32)
    rows = np.rint(x * 32767).astype(np.int16)
    return pd.Series([f.tobytes() + r.tobytes() for f, r in zip(factor, rows)])


def _matrix(packed) -> np.ndarray:
    raw = np.frombuffer(b"".join(packed), np.int16).reshape(len(packed), -1)
    return raw[:, 2:].astype(np.float32) * np.ascontiguousarray(raw[:, :2]).view(np.float32)


def _best(edges: DataFrame, by: str, other: str, keep: int) -> DataFrame:
    """The ``keep`` best distinct ``other`` of each ``by``; ``old`` tells those that were there."""
    once = edges.repartition(by).groupBy(by, other).agg(F.max("s").alias("s"), F.max("old").alias("old"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("s"), other))
    return once.withColumn("place", place).filter(F.col("place") <= keep).drop("place")


def _fit_tree(x: np.ndarray, levels: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the normals and offsets of its cells: a cell is halved at the median of its rows along the
    difference of two of them."""
    tree, cell = [], np.zeros(len(x), np.int64)
    for level in range(levels):
        normal, cut = np.zeros((1 << level, x.shape[1]), np.float32), np.zeros(1 << level, np.float32)
        for k in range(1 << level):
            own = x[cell == k]
            if len(own) > 1:
                a, b = rng.choice(len(own), 2, replace=False)
                normal[k] = own[a] - own[b]
                cut[k] = np.median(own @ normal[k])
        tree.append((normal, cut))
        cell = _leaf(x, tree[-1:], cell)
    return tree


def _leaf(x: np.ndarray, tree: list[tuple[np.ndarray, np.ndarray]], cell: np.ndarray) -> np.ndarray:
    """The cells below ``cell`` that the rows of ``x`` come to."""
    for normal, cut in tree:
        cell = 2 * cell + (np.einsum("ij,ij->i", x, normal[cell]) > cut[cell])
    return cell


def _dealt(nodes: DataFrame, bands: DataFrame, block: int, trees: int, seed: int) -> DataFrame:
    """``band, tree, leaf, part, node, packed``: every node once per tree of its band, in blocks of about
    ``block`` nodes. The trees are fitted on a bounded sample and deal all nodes. A band of one block has one tree
    without a cut; a leaf of several blocks is cut by hash."""
    known = {r["band"]: r["n"] for r in bands.select("band", "n").collect()}
    levels = {band: max(0, round(math.log2(n / block))) for band, n in known.items()}
    over = max(0, math.ceil(math.log2(sum(1 << v for v in levels.values() if v) / LEAVES))) if any(levels.values()) else 0
    cut = {band: v - over for band, v in levels.items() if v > over}
    forest = {}
    if cut:
        share = F.broadcast(nodes.sparkSession.createDataFrame(
            [(band, (PER_LEAF << v) / known[band]) for band, v in cut.items()], "band long, p double"))
        drawn = nodes.join(share, "band").filter(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 40)) < F.col("p") * (1 << 40))
        sample = drawn.select("band", "node", "packed").orderBy("band", "node").toPandas()
        for band, own in sample.groupby("band"):
            x, rng = _matrix(own["packed"].tolist()), np.random.default_rng(seed)
            forest[band] = [_fit_tree(x, cut[band], rng) for _ in range(trees)]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            band = batch["band"].to_numpy()
            x = _matrix(batch["packed"].tolist()) if forest and len(batch) else None
            for tree in range(trees if forest else 1):
                leaf = np.zeros(len(batch), np.int64)
                there = np.full(len(batch), tree == 0)
                for b, grown in forest.items():
                    at = np.flatnonzero(band == b)
                    leaf[at], there[at] = _leaf(x[at], grown[tree], leaf[at]), True
                yield batch.assign(tree=tree, leaf=leaf)[there]

    places = nodes.select("band", "node", "packed").mapInPandas(deal, "band long, tree int, leaf long, node long, packed binary")
    places = materialise(places, "ann_places")
    # few rows: trees times leaves, and the bands
    blocks = places.groupBy("band", "tree", "leaf").agg(F.greatest(F.lit(1), F.round(F.count(F.lit(1)) / block)).cast("long").alias("parts"))
    return places.join(F.broadcast(blocks), ["band", "tree", "leaf"]) \
        .withColumn("part", F.pmod(F.xxhash64("node", F.lit(seed), "tree"), F.col("parts")))


def _block_graph(nodes: DataFrame, bands: DataFrame, k: int, block: int, seed: int, trees: int = TREES) -> DataFrame:
    """``v, w, s``: the best ``k`` neighbours of each node within its blocks."""
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        x, ids = _matrix(rows["packed"].tolist()), rows["node"].to_numpy()
        n = min(k, len(ids) - 1)
        near, scores = np.empty((len(ids), n), np.int64), np.empty((len(ids), n), np.float32)
        for at in range(0, len(ids) if n else 0, SLICE):
            s = x[at:at + SLICE] @ x.T
            np.fill_diagonal(s[:, at:], -np.inf)
            top = np.argpartition(s, s.shape[1] - n, axis=1)[:, -n:]
            near[at:at + SLICE], scores[at:at + SLICE] = ids[top], np.take_along_axis(s, top, 1)
        return pd.DataFrame({"v": ids, "w": list(near), "s": list(scores)})

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vs, ws, ss = [], [], []
            for v, w, s in zip(batch["v"], batch["w"], batch["s"]):
                order = np.lexsort((w, -s))
                once = np.sort(np.unique(w[order], return_index=True)[1])[:k]
                vs.append(np.full(len(once), v))
                ws.append(w[order[once]])
                ss.append(s[order[once]])
            if vs:
                yield pd.DataFrame({"v": np.concatenate(vs), "w": np.concatenate(ws), "s": np.concatenate(ss)})

    found = _dealt(nodes, bands, block, trees, seed).groupBy("band", "tree", "leaf", "part") \
        .applyInPandas(join, "v long, w array<long>, s array<float>")
    # a node has one short list per tree
    lists = found.groupBy("v").agg(F.flatten(F.collect_list("w")).alias("w"), F.flatten(F.collect_list("s")).alias("s"))
    return lists.mapInPandas(best, "v long, w long, s float")


def neighbour_graph(nodes: DataFrame, bands: DataFrame, k: int = NEIGHBOURS, joined: int = JOINED, block: int = BLOCK,
                    settled: float = SETTLED, seed: int = 5, trees: int = TREES) -> DataFrame:
    """NN-descent by angle over ``nodes`` (node, packed, band) within each of ``bands`` (band, n): edges
    ``v, w, s``, the ``k`` best found per node.

    The descent starts from the best within blocks of nodes that lie near one another: ``trees`` of random cuts
    deal the nodes to leaves, so most neighbours are found by matrix products and few rounds are left.
    Each round joins every neighbourhood: ``joined`` different members drawn by hash from a node's neighbours
    and the nodes it is a neighbour of, compared with one another; what beats a member's worst
    neighbour is a candidate edge. The draw bounds a group even at hubs. Rounds end when fewer
    than ``settled`` of all edges are new.
    """
    # several trees: the descent only reaches what the first graph connects
    edges = materialise(_block_graph(nodes, bands, k, block, seed, trees), "ann_edges")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vs, ws, ss = [], [], []
            for ids, worst, packed in zip(batch["ids"], batch["worst"], batch["packed"]):
                x = _matrix(packed)
                s = x @ x.T
                np.fill_diagonal(s, -np.inf)
                i, j = np.nonzero(s > worst[:, None])
                vs.append(ids[i])
                ws.append(ids[j])
                ss.append(s[i, j])
            if vs:
                yield pd.DataFrame({"v": np.concatenate(vs), "w": np.concatenate(ws), "s": np.concatenate(ss)})

    round_no = 0
    while True:
        round_no += 1
        draw = F.xxhash64("u", "m", F.lit(seed + 1 + round_no))
        pairs = edges.select(F.col("v").alias("u"), F.col("w").alias("m")) \
            .unionByName(edges.select(F.col("w").alias("u"), F.col("v").alias("m")))
        # a mutual neighbour is listed twice and takes one place
        drawn = (pairs.withColumn("place", F.dense_rank().over(Window.partitionBy("u").orderBy(draw, "m")))
                 .filter(F.col("place") <= joined).select("u", "m").distinct())
        worst = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("worst"))
        full = F.when(F.col("n") >= k, F.col("worst")).otherwise(F.lit(float("-inf"))).cast("float")
        members = nodes.join(worst.select(F.col("v").alias("node"), full.alias("worst")), "node", "left") \
            .select(F.col("node").alias("m"), "packed", F.coalesce("worst", F.lit(float("-inf")).cast("float")).alias("worst"))
        groups = drawn.join(members, "m").groupBy("u").agg(
            F.collect_list("m").alias("ids"), F.collect_list("worst").alias("worst"),
            F.collect_list("packed").alias("packed")).drop("u")
        found = groups.mapInPandas(compare, "v long, w long, s float")
        both = found.withColumn("old", F.lit(0)).unionByName(edges.select("v", "w", "s").withColumn("old", F.lit(1)))
        edges = materialise(_best(both, "v", "w", k), "ann_edges")
        total, new = edges.agg(F.count(F.lit(1)), F.sum(1 - F.col("old"))).first()
        if not total or (new or 0) < settled * total:
            return edges.select("v", "w", "s")


def enter(asked: DataFrame, nodes: DataFrame, bands: list[Row], top: int, sample: int = SAMPLE,
          entries: int = ENTRIES) -> DataFrame:
    """The bands a query of ``asked`` (a, packed, node) has to search and where it enters them:
    ``a, band, starts``.

    About ``sample`` nodes of each band, drawn by hash, are compared with every query; the best ``entries`` of
    a band are where its search starts. A band is left out only if its largest norm is below the
    score of ``top`` other nodes of the samples (both for a query of norm 1), since no inner
    product exceeds the norm; the margin covers the rounding of the packed vectors.
    """
    share = F.broadcast(nodes.sparkSession.createDataFrame([(r["band"], sample / r["n"]) for r in bands], "band long, p double"))
    drawn = nodes.join(share, "band").filter(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 40)) < F.col("p") * (1 << 40))
    known = drawn.select("band", "node", "packed", "norm").orderBy("band", "node").toPandas()
    largest = {r["band"]: r["largest"] for r in bands}
    names, norms = known["node"].to_numpy(), known["norm"].to_numpy()
    packed, of_band = known["packed"].tolist(), known["band"].to_numpy()

    def starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        there = _matrix(packed) if packed else None
        for batch in batches:
            out = []
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at:at + 1024]
                least = np.full(len(part), -np.inf)
                near = None
                if packed:
                    near = (_matrix(part["packed"].tolist()) @ there.T).astype(np.float64)
                    sure = (near - 1e-3) * norms
                    sure[part["node"].to_numpy()[:, None] == names] = -np.inf
                    if len(names) >= top:
                        least = -np.partition(-sure, top - 1, axis=1)[:, top - 1]
                for band, size in largest.items():
                    here = np.flatnonzero(of_band == band)
                    best = np.argsort(-near[:, here] * norms[here], axis=1, kind="stable")[:, :entries] if len(here) else None
                    for row in np.flatnonzero(size * (1 + 1e-6) >= least):
                        out.append((part["a"].iat[row], band, names[here[best[row]]] if len(here) else []))
            yield pd.DataFrame(out, columns=["a", "band", "starts"])

    return asked.select("a", "packed", "node").mapInPandas(starts, "a long, band long, starts array<long>")


def search(queries: DataFrame, first: DataFrame, nodes: DataFrame, edges: DataFrame, beam: int = BEAM,
           expand: int = EXPAND) -> DataFrame:
    """Greedy search of the graph: ``queries`` (q, packed), starting at the nodes ``first`` (q, c) of one
    band -> (q, node) of the ``beam`` nodes found with the largest inner products.

    Each round every query expands its ``expand`` best nodes not yet expanded, scores their neighbours
    and keeps the ``beam`` best; it ends when its whole beam is expanded. Frontiers, not
    vectors, are what a round ships besides one packed vector per scored node.
    """
    vectors = nodes.select(F.col("node").alias("c"), F.col("packed").alias("there"), "weight")
    here = queries.select("q", F.col("packed").alias("here"))

    @F.pandas_udf("float")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype="float32")
        return pd.Series(np.einsum("ij,ij->i", _matrix(left.tolist()), _matrix(right.tolist())))

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.join(vectors, "c").join(here, "q").select("q", "c", (similar("here", "there") * F.col("weight")).alias("s"))

    near = materialise(_best(scored(first).withColumn("old", F.lit(0)), "q", "c", beam), "ann_beam")
    while True:
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "c"))
        open_ = near.filter("old = 0").withColumn("rank", rank).filter(F.col("rank") <= expand).select("q", "c")
        open_ = materialise(open_, "ann_open")
        if open_.isEmpty():
            return near.select("q", F.col("c").alias("node"))
        reached = open_.join(edges, F.col("c") == F.col("v")).select("q", F.col("w").alias("c"), F.lit(0).alias("seen")) \
            .unionByName(near.select("q", "c", F.lit(1).alias("seen"))) \
            .groupBy("q", "c").agg(F.max("seen").alias("seen")).filter("seen = 0").drop("seen")
        done = open_.select("q", "c", F.lit(1).alias("done"))
        kept = near.join(done, ["q", "c"], "left").select("q", "c", "s", F.coalesce("done", "old").alias("old"))
        near = materialise(_best(kept.unionByName(scored(reached).withColumn("old", F.lit(0))), "q", "c", beam), "ann_beam")


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 20, top: int = 20,
            **options) -> DataFrame:
    """Each query's ``top`` nearest found: ``query_id, rank, vec_id, score``. Queries are the rows whose
    identifier is divisible by ``every``; candidates are all rows but the query's own.

    Equal vectors are one node of the graph, which holds its ``top`` + 1 smallest identifiers: more of
    one vector can never be among a query's nearest, so a hot vector costs one node. Scores are exact
    double inner products of the original vectors; ties go to the smaller identifier. With fewer
    candidates than ``top`` all that are found are returned.

    Nodes are dealt to bands of nearly one norm, each with a graph by angle. A query searches every band that
    can hold one of its nearest, so a vector of any norm is reached through nodes like it.

    Vectors null, zero or holding null or non-finite components, and rows with a null identifier,
    take no part; repeated identifiers are rows of their own. Vectors must have one length. An
    empty table gives no rows.
    """
    rows = usable(vectors, id_col, vec_col)
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    copy = F.row_number().over(Window.partitionBy("vec", "vec_id").orderBy("place"))
    written = materialise(rows.withColumn("place", place).filter(F.col("place") <= top + 1).withColumn("copy", copy),
                          "ann_members")
    for naming in itertools.count():  # a node is named by the hash of its vector; the next one if two vectors share it
        node_of = F.xxhash64("vec", F.lit(naming))
        members = written.withColumn("node", node_of)
        if members.filter("place = 1").groupBy("node").count().filter("count > 1").isEmpty():
            break
    heads = members.filter("place = 1").select("node", "vec").withColumn("norm", norm_of(F.col("vec")))
    limit = heads.agg(F.max("norm")).first()[0] or 1.0
    band = F.floor(F.log(F.lit(limit) / F.col("norm")) / math.log(BAND)).alias("band")
    nodes = materialise(heads.select("node", _pack("vec").alias("packed"), "norm", band), "ann_nodes")
    # few rows: the bands double in norm every three or four
    known = nodes.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("largest")).orderBy("band").collect()
    bands = nodes.sparkSession.createDataFrame([tuple(r) for r in known], "band long, n long, largest double")
    edges = neighbour_graph(nodes, bands, **options)

    asked = rows.filter(F.col("vec_id") % every == 0)
    asked = materialise(asked.select(F.monotonically_increasing_id().alias("a"), "vec_id", "vec", node_of.alias("node"),
                                     _pack("vec").alias("packed")), "ann_queries")
    # one search per query and band; in the query's own band it starts at its neighbours as well
    tours = materialise(enter(asked, nodes, known, top).withColumn("q", F.monotonically_increasing_id()), "ann_tours")
    own = asked.join(nodes.select("node", "band"), "node").join(tours.select("a", "q", "band"), ["a", "band"]).select("q", "node")
    first = (own.select("q", F.col("node").alias("c"))
             .unionByName(own.join(edges, F.col("node") == F.col("v")).select("q", F.col("w").alias("c")))
             .unionByName(tours.select("q", F.explode("starts").alias("c"))))
    weighed = nodes.join(F.broadcast(bands.select("band", "largest")), "band") \
        .select("node", "packed", (F.col("norm") / F.col("largest")).cast("float").alias("weight"))
    found = search(tours.join(asked.select("a", "packed"), "a").select("q", "packed"), first, weighed, edges)
    exact = (found.join(tours.select("q", "a"), "q")
             .join(asked.select("a", F.col("vec_id").alias("query_id"), F.col("vec").alias("asked"), F.col("node").alias("own")), "a")
             .join(members, "node").filter("NOT (vec_id = query_id AND node = own AND copy = 1)")
             .select("a", "query_id", "vec_id", inner_product(F.col("asked"), F.col("vec")).alias("score")))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "vec_id"))
    return exact.withColumn("rank", rank).filter(F.col("rank") <= top) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
