"""Mean silhouette on Euclidean distances with a certified error, without all pairs and without a sample.

A row's mean distance to a cluster is a sum over groups of that cluster's rows. A far group is summed from
its moments: with r = x - mean, D = |r|, d = y - mean, t = |d| / D and u the cosine between r and d,

    |x - y|  =  D sqrt(1 - 2 t u + t^2)  =  D (C0(u) + t C1(u) + t^2 C2(u) + ...)

with the Gegenbauer polynomials of index -1/2. Up to t^p this is a polynomial in r / D^2 whose coefficients are
sums over the group's rows. As |Cn(u)| = |P(n-2)(u) - P(n)(u)| / (2n - 1) <= 2 / (2n - 1) (P: Legendre), the
rest is at most 2 M / ((2p + 1) D^(p-1) (D - radius)), where M is the sum of |d|^(p+1). So every far group has a
certified error; near groups are opened. Order p is 2 for a loose tolerance and up to ``ORDER`` for a tight one:
at order 2 a tolerance of 1e-5 opens nearly all pairs of rows.

1. Equal rows of one cluster are one place with a weight: a hot place costs one row.
2. A k-d tree of at most ``MAX_CELLS`` cells, cut at medians of a hashed sample (the sample only places the
   cuts), deals the places to chunks of bounded size. Moments per (cell, cluster) go to every task.
3. Which (cell, group) pairs are opened is decided from cell bounds: the largest relative error per group
   is sought whose total certified error stays within half of the tolerance.
4. Opened pairs of cells are computed chunk against chunk: the nodes of a k-d tree inside the chunk, the
   largest first, are again summed from moments where that is certified (the other half of the tolerance);
   what is left of the smallest nodes is opened.

With a given tolerance the opened pairs per chunk are bounded by geometry, so the work grows in
proportion to the rows once there are enough cells.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .knn_join import _squared

#: Cells at most, places a chunk holds at most, rows of the sample per cell, places of a leaf and of a block.
MAX_CELLS = 1024
CHUNK_ROWS = 2048
SAMPLE_ROWS = 64
LEAF_ROWS = 32
BLOCK_ROWS = 64
#: Order of the expansions below a tolerance of ``LOOSE`` and the coefficients that they may have at most.
ORDER, COEFFICIENTS, LOOSE = 8, 256, 1e-3
#: Places of the nodes of a chunk's tree at these orders, and nodes that a block gathers before it sums them.
NODE_ROWS, PENDING = (1024, 256, 64), 128
#: Neighbouring chunks that share a task's work, as a power of two at most.
TEAM_BITS = 2


def order_for(width: int, tolerance: float) -> int:
    """2 for a loose tolerance, else the highest order that keeps the coefficients few in ``width`` dimensions."""
    if tolerance >= LOOSE:
        return 2
    return max([2] + [p for p in range(3, ORDER + 1) if math.comb(width + p, p) <= COEFFICIENTS])


@functools.cache
def _basis(width: int, order: int) -> tuple[dict, list, tuple]:
    """Exponents of the monomials up to ``order`` -> their number, by degree; each one's (parent, variable); and the matrix that
    makes the coefficients of the expansion from the sums of the monomials of y - mean (first entry of each row, columns, values)."""
    def exponents(n: int) -> list[tuple]:
        return [tuple(c.count(j) for j in range(width)) for c in itertools.combinations_with_replacement(range(width), n)]

    def ways(e: tuple) -> float:
        return math.factorial(sum(e)) / math.prod(map(math.factorial, e))

    number = {e: i for i, e in enumerate(e for n in range(order + 1) for e in exponents(n))}
    parents = []
    for e in list(number)[1:]:
        v = next(j for j in range(width) if e[j])
        parents.append((number[e[:v] + (e[v] - 1,) + e[v + 1:]], v))
    matrix: dict[tuple[int, int], float] = {}
    for n in range(order + 1):
        for j in range(n // 2 + 1):
            # of t^n Cn(u), with u = cos(r, d): the term in (|d|^2 / D^2)^j (r.d / D^2)^(n - 2j)
            term = (-1) ** j * math.prod(i - 0.5 for i in range(n - j)) * 2 ** (n - 2 * j) \
                / (math.factorial(j) * math.factorial(n - 2 * j))
            for a in exponents(n - 2 * j):
                for b in exponents(j):
                    for c in exponents(j):
                        to = tuple(x + 2 * y for x, y in zip(a, b))
                        of = tuple(x + 2 * y for x, y in zip(a, c))
                        at = number[to], number[of]
                        matrix[at] = matrix.get(at, 0.0) + term * ways(a) * ways(b) * ways(c)
    entries = sorted(matrix)
    row, column = np.array(entries).T
    return number, parents, (np.searchsorted(row, np.arange(len(number))), column, np.array([matrix[at] for at in entries]))


def _monomials(d: np.ndarray, order: int) -> np.ndarray:
    """Monomials (rows of the result) of the rows of ``d``."""
    _, parents, _ = _basis(d.shape[1], order)
    out = np.empty((len(parents) + 1, len(d)))
    out[0] = 1
    by = np.ascontiguousarray(d.T)
    for i, (parent, v) in enumerate(parents, 1):
        np.multiply(out[parent], by[v], out=out[i])
    return out


def _coefficients(sums: np.ndarray, width: int, order: int) -> np.ndarray:
    """Coefficients of the expansions from the sums of monomials; groups are columns."""
    start, column, value = _basis(width, order)[2]
    return np.add.reduceat(value[:, None] * sums[column], start, axis=0)


def _polynomial(coef: np.ndarray, q: list[np.ndarray], number: dict, degree: int, powers: tuple = ()) -> np.ndarray:
    """Horner's scheme, one variable after the other: the part of the polynomials (columns of ``coef``) of at most ``degree`` in
    the variables that ``powers`` leaves open."""
    at = len(powers)
    if at == len(q) or not degree:
        return coef[number[powers + (0,) * (len(q) - at)]]
    out = None
    for i in range(degree, -1, -1):
        part = _polynomial(coef, q, number, degree - i, (*powers, i))
        if out is None:
            out = part
        elif out.ndim == 1:
            out = q[at] * out
            out += part
        else:
            out *= q[at]
            out += part
    return out


class Cuts:
    """A full binary tree of median cuts along the widest dimension."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.dim = np.zeros((1 << depth) - 1, np.int64)
        self.at = np.zeros((1 << depth) - 1)
        parts = {0: sample}
        for node in range((1 << depth) - 1):
            x = parts.pop(node)
            if len(x):
                self.dim[node] = np.ptp(x, axis=0).argmax()
                self.at[node] = self._halving(np.sort(x[:, self.dim[node]]))
            right = x[:, self.dim[node]] > self.at[node]
            parts[2 * node + 1], parts[2 * node + 2] = x[~right], x[right]

    @staticmethod
    def _halving(values: np.ndarray) -> float:
        """The value up to which the left side of the most even cut goes: equal values stay together, so a
        cut at the median itself could leave nothing on the right."""
        middle = values[len(values) // 2]
        low, high = np.searchsorted(values, middle, "left"), np.searchsorted(values, middle, "right")
        if low and (high == len(values) or abs(2 * low - len(values)) <= abs(2 * high - len(values))):
            return float(values[low - 1])
        return float(middle)

    def cell(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.dim[node]] > self.at[node])
        return node - ((1 << self.depth) - 1)


def moments(x: np.ndarray, w: np.ndarray, mean: np.ndarray, order: int = 2) -> tuple[np.ndarray, float, float]:
    """Coefficients of the expansion, sum of the distances to the power ``order`` + 1 and radius of weighted rows
    about ``mean``."""
    d = x - mean
    far = np.sqrt((d * d).sum(1))
    coef = _coefficients((_monomials(d, order) @ w)[:, None], x.shape[1], order)[:, 0]
    return coef, float((w * far ** (order + 1)).sum()), float(far.max(initial=0.0))


class Groups:
    """Groups of rows by their moments: n, mean, coefficients, sum of high powers, radius, cluster."""

    def __init__(self, n, mean, coef, high, radius, cluster, order: int = 2):
        self.n, self.mean, self.coef, self.high, self.radius, self.cluster = n, mean, coef, high, radius, cluster
        self.order = order

    @classmethod
    def of(cls, x: np.ndarray, w: np.ndarray, cluster: np.ndarray, parts: list[np.ndarray], order: int) -> Groups:
        """The groups of the rows in ``parts``, each of one cluster."""
        rows = np.concatenate(parts)
        size = np.array([len(part) for part in parts])
        start = np.cumsum(size) - size
        n = np.add.reduceat(w[rows], start)
        mean = np.add.reduceat(x[rows] * w[rows][:, None], start) / n[:, None]
        d = x[rows] - np.repeat(mean, size, axis=0)
        far = np.sqrt((d * d).sum(1))
        sums = np.add.reduceat(_monomials(d, order) * w[rows], start, axis=1)
        return cls(n, mean, _coefficients(sums, x.shape[1], order).T, np.add.reduceat(w[rows] * far ** (order + 1), start),
                   np.maximum.reduceat(far, start), cluster[rows[start]], order)

    @classmethod
    def joined(cls, parts: list[Groups]) -> Groups:
        names = ("n", "mean", "coef", "high", "radius", "cluster")
        return cls(*(np.concatenate([getattr(part, a) for part in parts]) for a in names), parts[0].order)

    def __getitem__(self, some: np.ndarray) -> Groups:
        return Groups(self.n[some], self.mean[some], self.coef[some], self.high[some], self.radius[some],
                      self.cluster[some], self.order)

    def error(self, distance: np.ndarray) -> np.ndarray:
        """Certified error of each group's sum for rows at least ``distance`` from its mean; infinite where the
        rows may lie inside the group."""
        p = self.order
        gap = distance - self.radius
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            bound = np.where(gap > 0, 2 * self.high / ((2 * p + 1) * distance ** (p - 1) * gap), np.inf)
        return np.where(self.radius == 0, 0.0, np.where(np.isfinite(bound), bound, np.inf))

    def sums(self, x: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """The expanded sum of distances from each row to each group."""
        number = _basis(x.shape[1], self.order)[0]
        out = np.empty_like(distance)
        for at in range(0, len(self.n), PENDING):
            here = slice(at, at + PENDING)
            far = distance[:, here]
            square = np.where(far > 0, far * far, 1.0)
            q = [(x[:, j:j + 1] - self.mean[here, j][None]) / square for j in range(x.shape[1])]
            out[:, here] = far * _polynomial(np.ascontiguousarray(self.coef[here].T), q, number, self.order)
        return out


def _leaves(x: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """``rows`` halved at medians of the widest dimension until none of the parts is above ``size``."""
    out, todo = [], [rows]
    while todo:
        part = todo.pop()
        if len(part) <= size:
            out.append(part)
            continue
        dim = np.ptp(x[part], axis=0).argmax()
        order = part[np.argsort(x[part, dim], kind="stable")]
        todo += [order[:len(order) // 2], order[len(order) // 2:]]
    return out


def _tree(x: np.ndarray, w: np.ndarray, cluster: np.ndarray, order: int) -> tuple[list[np.ndarray], Groups, np.ndarray, np.ndarray]:
    """Nodes of a k-d tree per cluster as rows and groups, parents first; each node's parent (-1: none) and whether it is a leaf."""
    parts, parent, leaf, levels = [], [], [], []
    last = [(np.flatnonzero(cluster == c), -1) for c in np.unique(cluster)]
    for size in NODE_ROWS if order > 2 else (LEAF_ROWS,):
        begun = len(parts)
        for rows, above in last:
            pieces = _leaves(x, rows, size)
            if len(pieces) == 1 and above >= 0:
                continue  # the node above is as small
            if above >= 0:
                leaf[above] = False
            parts += pieces
            parent += [above] * len(pieces)
            leaf += [True] * len(pieces)
        if len(parts) > begun:
            levels.append(Groups.of(x, w, cluster, parts[begun:], order))
        last = [(parts[k], k) for k in range(len(parts)) if leaf[k]]
    return parts, Groups.joined(levels), np.array(parent), np.array(leaf)


def add_far(x: np.ndarray, block: np.ndarray, far: list[Groups], sums: np.ndarray) -> None:
    """Add the expanded distances from the rows ``block`` to the groups to ``sums``."""
    groups = Groups.joined(far)
    of = np.zeros((len(groups.n), sums.shape[1]))
    of[np.arange(len(of)), groups.cluster] = 1
    sums[block] += groups.sums(x[block], np.sqrt(_squared(x[block], groups.mean))) @ of


def add_chunk(x: np.ndarray, blocks: list[np.ndarray], y: np.ndarray, w: np.ndarray, cluster: np.ndarray, relative: float,
              sums: np.ndarray, errors: np.ndarray, order: int = 2, tree: tuple | None = None,
              allowed: np.ndarray | None = None, pending: list[list[Groups]] | None = None) -> None:
    """Add the distances from ``x`` to the weighted rows ``y`` to ``sums`` (rows x clusters), certified in
    ``errors``: nodes whose relative error is at most ``relative``, or whose error is at most ``allowed`` (blocks x
    clusters) per unit of weight, by moments, all others row by row. With ``pending`` a block's groups are
    gathered there until they are enough to be summed at once."""
    k = sums.shape[1]
    parts, groups, parent, leaf = tree or _tree(y, w, cluster, order)
    weight = np.zeros((len(y), k))
    weight[np.arange(len(y)), cluster] = w
    of = np.zeros((len(groups.n), k))
    of[np.arange(len(of)), groups.cluster] = 1
    rows, size = np.concatenate(blocks), np.array([len(block) for block in blocks])
    d = np.minimum.reduceat(np.sqrt(_squared(x[rows], groups.mean)), np.cumsum(size) - size)
    error = groups.error(d)
    limit = relative * d
    if allowed is not None:
        limit = np.maximum(limit, allowed[:, groups.cluster])
    done = error <= limit * groups.n
    take = done.copy()
    for node in np.flatnonzero(parent >= 0):  # parents come first
        take[:, node] &= ~done[:, parent[node]]
        done[:, node] |= done[:, parent[node]]
    errors[rows] += np.repeat(np.where(take, error, 0.0) @ of, size, axis=0)
    for number in np.flatnonzero(take.any(1)):
        some = groups[take[number]]
        if pending is None:
            add_far(x, blocks[number], [some], sums)
            continue
        pending[number].append(some)
        if sum(len(g.n) for g in pending[number]) >= PENDING:
            add_far(x, blocks[number], pending[number], sums)
            pending[number] = []
    near = leaf & ~done
    for number in np.flatnonzero(near.any(1)):
        at = np.concatenate([parts[node] for node in np.flatnonzero(near[number])])
        sums[blocks[number]] += np.sqrt(_squared(x[blocks[number]], y[at])) @ weight[at]


def scores(own: np.ndarray, sums: np.ndarray, errors: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Silhouette of each row and its certified error."""
    rows = np.arange(len(own))
    others = np.where(np.arange(len(sizes))[None] == own[:, None], np.inf, 0.0)

    def value(a_sum, b_sums):
        a = np.maximum(a_sum, 0) / np.maximum(sizes[own] - 1, 1)
        b = (np.maximum(b_sums, 0) / sizes[None] + others).min(1)
        top = np.maximum(a, b)
        return np.where((sizes[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0)

    s = value(sums[rows, own], sums)
    high = value(sums[rows, own] - errors[rows, own], sums + errors)
    low = value(sums[rows, own] + errors[rows, own], sums - errors)
    return s, np.maximum(high - s, s - low)


def _opened(cells: dict, groups: Groups, cell_of: np.ndarray, k: int, tolerance: float) -> np.ndarray:
    """Which (cell, group) pairs to open: as few as keep the total certified error at half of the tolerance."""
    centre, reach, weight = cells["centre"], cells["reach"], cells["n"]
    nearest = np.maximum(np.sqrt(_squared(centre, groups.mean)) - reach[:, None], 0.0)
    error = np.vstack([groups.error(row) for row in nearest])
    of = np.zeros((len(groups.n), k))
    of[np.arange(len(of)), groups.cluster] = 1
    least = (groups.n[None] * nearest) @ of
    with np.errstate(divide="ignore", invalid="ignore"):
        # a row of the group costs the same wherever it is, and its error counts in its cluster's sum
        share = np.where(error == 0, 0.0, error / (groups.n[None] * (least / (groups.n @ of))[:, groups.cluster]))
    share = np.where(np.isnan(share), np.inf, share)

    def total(limit: float) -> float:
        part = np.where(share <= limit, np.where(np.isfinite(error), error, 0.0), 0.0) @ of
        with np.errstate(divide="ignore", invalid="ignore"):
            worst = np.where(part > 0, part / least, 0.0).max(1)
        return float((2 * worst * weight).sum() / weight.sum())

    low, high = 0.0, 1.0
    for _ in range(30):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) <= tolerance / 2 else (low, mid)
    return share > low


def silhouette(labelled: DataFrame, features: list[str], label_col: str = "cluster", tolerance: float = 0.01,
               max_cells: int = MAX_CELLS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mean silhouette on Euclidean distances -> one row (silhouette, error): ``error`` is certified, at most
    ``tolerance``, and 0 where everything had to be opened.

    s = (b - a) / max(a, b) with a the mean distance to the other rows of the own cluster and b the smallest
    mean distance to another cluster; 0 for a row alone in its cluster or if both are 0. Rows with a null
    label or a null or NaN feature take no part; with fewer than two clusters both numbers are null. Labels
    are few: their count bounds what every task holds (cells x labels).
    """
    spark = labelled.sparkSession
    x = [F.col(f).cast("double") for f in features]
    whole = F.col(label_col).isNotNull()
    for v in x:
        whole = whole & v.isNotNull() & ~F.isnan(v)
    places = materialise(labelled.where(whole).groupBy(F.array(*x).alias("x"), F.col(label_col).alias("label"))
                         .agg(F.count(F.lit(1)).cast("double").alias("w")), "silhouette_places")
    sizes = {r["label"]: r["n"] for r in places.groupBy("label").agg(F.sum("w").alias("n")).collect()}
    if len(sizes) < 2:
        return spark.createDataFrame([(None, None)], "silhouette double, error double")
    labels = sorted(sizes)
    k, width = len(labels), len(features)
    size = np.array([sizes[c] for c in labels])
    number = F.array_position(F.array(*[F.lit(c) for c in labels]), F.col("label")).cast("int") - 1

    n = places.count()
    depth = max(0, min(int(math.log2(max_cells)), math.ceil(math.log2(n / chunk_rows))))
    sample = places.select("x").orderBy(F.xxhash64("x"), "x").limit(SAMPLE_ROWS << depth).collect()
    cuts = Cuts(np.array([r["x"] for r in sample]), depth)

    def deal(batches):
        import pyarrow as pa
        for batch in batches:
            rows = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cuts.cell(rows).astype(np.int32))],
                                             names=[*batch.schema.names, "cell"])

    def pack(batches):
        import pyarrow as pa

        def chunk(t):
            rows = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return pa.RecordBatch.from_arrays(
                [pa.array([t.column("cell")[0].as_py()], pa.int32()), pa.array([rows.tobytes()]),
                 pa.array([t.column("w").to_numpy().tobytes()]),
                 pa.array([t.column("c").to_numpy().astype(np.int32).tobytes()])], names=["cell", "x", "w", "c"])

        held = None
        for batch in batches:
            held = pa.concat_tables([*([held] if held else []), pa.Table.from_batches([batch])])
            while held.num_rows:
                cell = held.column("cell").to_numpy()
                end = int(np.searchsorted(cell, cell[0], "right"))
                if end == held.num_rows and end < chunk_rows:
                    break
                yield chunk(held.slice(0, min(end, chunk_rows)))
                held = held.slice(min(end, chunk_rows))
        if held is not None and held.num_rows:
            yield chunk(held)

    dealt = places.select("x", "w", number.alias("c")).mapInArrow(deal, "x array<double>, w double, c int, cell int")
    chunks = dealt.repartitionByRange("cell", F.xxhash64("x")).sortWithinPartitions("cell", F.xxhash64("x")) \
        .mapInArrow(pack, "cell int, x binary, w binary, c binary") \
        .select(F.monotonically_increasing_id().alias("chunk"), "*")
    chunks = materialise(chunks, "silhouette_chunks")

    def unpack(row):
        return (np.frombuffer(row["x"], np.float64).reshape(-1, width), np.frombuffer(row["w"], np.float64),
                np.frombuffer(row["c"], np.int32))

    order = order_for(width, tolerance)
    means = _cell_means(chunks, unpack, width)
    cells, groups, cell_of = _cell_moments(chunks, unpack, means, width, order)
    opened = _opened(cells, groups, cell_of, k, tolerance)
    shared = spark.sparkContext.broadcast((opened, groups, cell_of, size, tolerance / 8))
    near = [(int(a), int(b)) for a in range(len(opened)) for b in np.unique(cell_of[opened[a]])]
    # at most cells x cells rows
    near_rows = spark.createDataFrame(near, "cell int, other int")
    # neighbouring chunks meet the same others, so some of them share a task's copy and tree of each
    team = F.shiftright("chunk", max(0, min(TEAM_BITS, depth - 6)))
    others = chunks.select(team.alias("team"), "cell").join(F.broadcast(near_rows), "cell").select("team", "other").distinct()
    meet = others.join(chunks.select(F.col("cell").alias("other"), "chunk", "x", "w", "c"), "other") \
        .select("team", "chunk", "other", "x", "w", "c", F.lit(1).alias("turn"))
    own = chunks.select(team.alias("team"), "chunk", F.col("cell").alias("other"), "x", "w", "c", F.lit(0).alias("turn"))
    work = own.unionByName(meet).repartition("team").sortWithinPartitions("team", "turn")

    def score(batches):
        import pyarrow as pa
        mask, cell_groups, cell_at, count, relative = shared.value
        of = np.zeros((len(cell_groups.n), len(count)))
        of[np.arange(len(of)), cell_groups.cluster] = 1
        states, at, total, wrong = [], None, 0.0, 0.0

        def begin(x, w, c, cell):
            blocks = _leaves(x, np.arange(len(x)), BLOCK_ROWS)
            sums, errors = np.zeros((len(x), len(count))), np.zeros((len(x), len(count)))
            allowed = np.zeros((len(blocks), len(count)))
            far = ~mask[cell]
            some = cell_groups[far]
            with np.errstate(divide="ignore", invalid="ignore"):
                share = 1 / ((mask[cell] * cell_groups.n) @ of)  # of the cluster's rows that may be opened
            for number, block in enumerate(blocks):
                if far.any():
                    d = np.sqrt(_squared(x[block], some.mean))
                    sums[block] = some.sums(x[block], d) @ of[far]
                    errors[block] = some.error(d) @ of[far]
                middle = x[block].mean(0)
                reach = np.sqrt(((x[block] - middle) ** 2).sum(1)).max()
                # no mean distance is below the distance to the mean
                least = np.maximum(np.sqrt(_squared(middle[None], cell_groups.mean)) - reach, 0.0) * cell_groups.n @ of
                allowed[number] = np.where(np.isfinite(share), relative * least[0] * share, 0.0)
            return {"x": x, "w": w, "c": c, "cell": cell, "blocks": blocks, "sums": sums, "errors": errors,
                    "allowed": allowed, "pending": [[] for _ in blocks]}

        def finish():
            nonlocal total, wrong
            for state in states:
                for block, far in zip(state["blocks"], state["pending"]):
                    if far:
                        add_far(state["x"], block, far, state["sums"])
                s, e = scores(state["c"], state["sums"], state["errors"], count)
                total += float((s * state["w"]).sum())
                wrong += float((e * state["w"]).sum())
            states.clear()

        for batch in batches:
            for row in batch.to_pylist():
                y, w, c = unpack(row)
                if row["team"] != at:
                    finish()
                    at = row["team"]
                if row["turn"] == 0:
                    states.append(begin(y, w, c, row["other"]))
                    continue
                trees = {}
                for state in states:
                    open_ = np.unique(cell_groups.cluster[mask[state["cell"]] & (cell_at == row["other"])])
                    take = np.isin(c, open_)
                    if take.any():
                        if tuple(open_) not in trees:
                            trees[tuple(open_)] = _tree(y[take], w[take], c[take], order)
                        add_chunk(state["x"], state["blocks"], y[take], w[take], c[take], relative, state["sums"],
                                  state["errors"], order, trees[tuple(open_)], state["allowed"], state["pending"])
        finish()
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([wrong])], names=["total", "wrong"])

    rows = float(size.sum())
    return work.mapInArrow(score, "total double, wrong double") \
        .agg((F.sum("total") / rows).alias("silhouette"), (F.sum("wrong") / rows).alias("error"))


def _cell_means(chunks: DataFrame, unpack, width: int) -> dict:
    """(cell, cluster) -> (n, mean)."""
    names = [f"s{j}" for j in range(width)]

    def sums(batches):
        import pandas as pd
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                x, w, c = unpack(row)
                for g in np.unique(c):
                    own = c == g
                    out.append((row["cell"], int(g), float(w[own].sum()), *(x[own] * w[own][:, None]).sum(0)))
            yield pd.DataFrame(out, columns=["cell", "c", "n", *names])

    found = chunks.mapInPandas(sums, "cell int, c int, n double, " + ", ".join(f"{s} double" for s in names)) \
        .groupBy("cell", "c").agg(*[F.sum(s).alias(s) for s in ["n", *names]]).collect()
    return {(r["cell"], r["c"]): (r["n"], np.array([r[s] for s in names]) / r["n"]) for r in found}


def _cell_moments(chunks: DataFrame, unpack, means: dict, width: int, order: int) -> tuple[dict, Groups, np.ndarray]:
    """Centre, reach and weight of every cell; the groups (cell, cluster) by their moments; the groups' cells."""
    n_cells = max(cell for cell, _ in means) + 1
    weight, centre = np.zeros(n_cells), np.zeros((n_cells, width))
    for (cell, _), (n, mean) in means.items():
        weight[cell] += n
        centre[cell] += n * mean
    centre /= np.maximum(weight, 1)[:, None]
    names = ["cell", "c", "reach", "high", "radius", "coef"]

    def spread(batches):
        import pandas as pd
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                x, w, c = unpack(row)
                reach = float(np.sqrt(((x - centre[row["cell"]]) ** 2).sum(1)).max())
                for g in np.unique(c):
                    own = c == g
                    coef, high, radius = moments(x[own], w[own], means[row["cell"], int(g)][1], order)
                    out.append((row["cell"], int(g), reach, high, radius, coef))
            yield pd.DataFrame(out, columns=names)

    parts = materialise(chunks.mapInPandas(spread, "cell int, c int, reach double, high double, radius double, coef array<double>"),
                        "silhouette_moments")
    coefs = parts.select("cell", "c", F.posexplode("coef").alias("i", "v")).groupBy("cell", "c", "i").agg(F.sum("v").alias("v")) \
        .groupBy("cell", "c").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("coef"))
    found = parts.groupBy("cell", "c").agg(F.max("reach").alias("reach"), F.sum("high").alias("high"), F.max("radius").alias("radius")) \
        .join(coefs.select("cell", "c", F.col("coef.v").alias("coef")), ["cell", "c"]).orderBy("cell", "c").collect()
    reach = np.zeros(n_cells)
    for r in found:
        reach[r["cell"]] = max(reach[r["cell"]], r["reach"])
    groups = Groups(np.array([means[r["cell"], r["c"]][0] for r in found]),
                    np.array([means[r["cell"], r["c"]][1] for r in found]),
                    np.array([r["coef"] for r in found]), np.array([r["high"] for r in found]),
                    np.array([r["radius"] for r in found]), np.array([r["c"] for r in found]), order)
    return {"centre": centre, "reach": reach, "n": weight}, groups, np.array([r["cell"] for r in found])
