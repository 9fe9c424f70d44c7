"""Exact k-nearest-neighbour join of two tables of any size.

1. Pivots: at most ``MAX_PIVOTS`` points, chosen by hash. Every point goes to the Voronoi cell of its
   nearest pivot. Of points at one place only the k smallest ids can ever be neighbours (ties break
   by id), so a place that a third of all points share costs k rows.
2. Blocks: the points, range-partitioned by (cell, distance to the pivot, id), are cut into blocks of
   bounded size; a block is a ring of a cell with an inner and an outer radius. The bounds of all
   blocks (at most ``MAX_BLOCKS`` + pivots + partitions rows) are the only thing sent to every task.
3. Visits: the pivots' k smallest radii bound each query's k-th distance from above. A query visits the
   blocks that its ball can reach by the triangle inequality (ring) and by the bisector of the two
   pivots (cell): border queries are replicated, nothing else.
4. Matching: visits and blocks meet in groups of one block and at most about ``GROUP_QUERIES`` queries;
   numpy computes the distances inside a group, each query's k best of every block are merged.

Every bound is one-sided and widened by the rounding error, so the result is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

MAX_PIVOTS = 1024
#: A block holds at least this many rows at most (more only where that would make over MAX_BLOCKS blocks).
BLOCK_ROWS = 4096
MAX_BLOCKS = 65_536
#: Queries of one visit row, and about how many meet a block in one group.
PACK_QUERIES = 2048
GROUP_QUERIES = 65_536
#: Dimensions from which points count as wide: distances come from a matrix product first, and as balls hardly
#: prune there, a block holds ``WIDE_BLOCKS`` times as many rows and cells are no smaller than blocks, so
#: that a query is sent to few blocks.
WIDE, WIDE_BLOCKS = 16, 4
#: Cells of the bisector and ring tests whose radii are merged for a query's bound.
NEAR_CELLS = 8
#: Relative widening of the bounds against rounding.
SLACK = 1e-9


def vector(features: list[str] | str) -> Column:
    """Feature columns, or one array column, as an array of doubles."""
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(f).cast("double") for f in features])


def _whole(x: str) -> Column:
    """Whether every component of the array is a number (null, NaN and infinite ones are not)."""
    return F.coalesce(F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))), F.lit(False))


def _matrix(lists) -> np.ndarray:
    """An Arrow list array of equally long lists of doubles as a matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, summed dimension by dimension."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d = x[:, j:j + 1] - y[:, j][None, :]
        out += d * d
    return out


def _near_pairs(q: np.ndarray, x: np.ndarray, k: int, limit: np.ndarray | None, apart: np.ndarray | None):
    """(row, position, squared distance) of pairs that hold every row's ``k`` nearest of ``x``, by (row, position);
    squared distances are those of ``_squared``. ``limit`` bounds a row's squared distance, ``apart`` marks pairs
    that do not count. None where the products overflow.

    A matrix product gives distances with an error below ``margin``: the k nearest are among those at most twice
    that beyond the k-th of the product, and only they are summed dimension by dimension."""
    middle = x.mean(0)
    a, b = q - middle, x - middle
    with np.errstate(over="ignore", invalid="ignore"):
        a2, b2 = (a * a).sum(1), (b * b).sum(1)
        margin = 8 * (x.shape[1] + 8) * np.finfo(float).eps * (np.sqrt(a2) + np.sqrt(b2.max()) + 2 * np.abs(middle).max()) ** 2
        about = a @ b.T
        about *= -2
        about += a2[:, None]
        about += b2[None, :]
        if not (np.isfinite(margin).all() and np.isfinite(about.sum())):
            return None
    if apart is not None:
        about[apart] = np.inf
    cut = np.partition(about, k - 1, axis=1)[:, k - 1] if k < about.shape[1] else np.full(len(q), np.finfo(float).max)
    cut = np.minimum(cut, np.finfo(float).max)
    if limit is not None:
        cut = np.minimum(cut, limit)
    row, at = np.nonzero(about <= (cut + 2 * margin)[:, None])
    d2 = np.zeros(len(row))
    for j in range(x.shape[1]):
        d = q[row, j] - x[at, j]
        d2 += d * d
    if limit is not None:
        keep = d2 <= limit[row]
        row, at, d2 = row[keep], at[keep], d2[keep]
    return row, at, d2


def _wide_nearest(q: np.ndarray, x: np.ndarray, k: int, limit: np.ndarray | None = None, apart: np.ndarray | None = None):
    """Positions and squared distances of each row's ``k`` nearest of ``x``, by (distance, position); infinite where
    there are fewer. None where the products overflow."""
    k = min(k, len(x))
    pairs = _near_pairs(q, x, k, limit, apart)
    if pairs is None:
        return None
    row, at, d2 = pairs
    order = np.lexsort((at, d2, row))
    row, at, d2 = row[order], at[order], d2[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    best = place < k
    near, far = np.zeros((len(q), k), np.int64), np.full((len(q), k), np.inf)
    near[row[best], place[best]], far[row[best], place[best]] = at[best], d2[best]
    return near, far


def _pivot_distances(x: np.ndarray, pivots: np.ndarray, rows: int = 2048):
    """Distances to the pivots in slices of ``rows``."""
    for at in range(0, len(x), rows):
        yield at, np.sqrt(_squared(x[at:at + rows], pivots))


@dataclass
class Bounds:
    """What every task knows of the points: pivots, rings and the smallest radii per cell."""
    pivots: np.ndarray
    block: np.ndarray            # block ids, by cell
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray            # position of a cell's first block
    reach: np.ndarray            # a cell's largest radius
    near: dict                   # excluded fold -> (cells x k) smallest radii of the other folds

    def threshold(self, distance: np.ndarray, k: int, fold: int) -> np.ndarray:
        """An upper bound of each query's k-th distance, given its distances to the pivots."""
        near = self.near.get(fold, self.near[None])
        best = (distance + near[:, k - 1][None, :]).min(1)
        n = min(NEAR_CELLS, distance.shape[1])
        cells = np.argpartition(distance, n - 1, axis=1)[:, :n] if n < distance.shape[1] else \
            np.broadcast_to(np.arange(n), distance.shape)
        merged = (np.take_along_axis(distance, cells, 1)[:, :, None] + near[cells]).reshape(len(distance), -1)
        best = np.minimum(best, np.partition(merged, k - 1, axis=1)[:, k - 1])
        open_ = np.flatnonzero(~np.isfinite(best))
        if len(open_):          # fewer than k points in the nearest cells: all radii
            every = (distance[open_][:, :, None] + near[None]).reshape(len(open_), -1)
            best[open_] = np.partition(every, k - 1, axis=1)[:, k - 1]
        return best

    def visits(self, distance: np.ndarray, threshold: np.ndarray):
        """(position of the block, rows that visit it) for all blocks that any row must visit."""
        home = distance.argmin(1)
        wide = threshold + SLACK * (1 + threshold + distance.max(1))
        nearest = distance[np.arange(len(distance)), home]
        apart = np.sqrt(_squared(self.pivots[home], self.pivots))
        with np.errstate(divide="ignore", invalid="ignore"):
            bisector = (distance ** 2 - (nearest ** 2)[:, None]) / (2 * apart)
        slack = SLACK * (1 + distance)
        maybe = (distance - self.reach[None, :] <= wide[:, None]) & ((apart == 0) | (bisector <= wide[:, None] + slack))
        for c in np.flatnonzero(maybe.any(0)):
            rows = np.flatnonzero(maybe[:, c])
            d, w = distance[rows, c], wide[rows]
            for b in range(self.first[c], self.first[c + 1]):
                hit = rows[(d - self.high[b] <= w) & (self.low[b] - d <= w)]
                if len(hit):
                    yield b, hit


def _fold_type(col: str | None) -> Column:
    return F.col(col).cast("int") if col else F.lit(None).cast("int")


def _assigned(points: DataFrame, k: int, pivots: np.ndarray) -> DataFrame:
    """The points that can be neighbours (id, label, fold, x) with their cell and radius, written."""
    place = Window.partitionBy("x", "fold").orderBy("id", "label")
    # a row_number limit is applied before the exchange too, so a hot place shuffles k rows a task
    points = points.withColumn("turn", F.row_number().over(place)).where(F.col("turn") <= k).drop("turn")

    def assign(batches):
        import pyarrow as pa
        for batch in batches:
            x = _matrix(batch.column("x"))
            cell, radius = np.empty(len(x), np.int32), np.empty(len(x))
            for at, d in _pivot_distances(x, pivots):
                cell[at:at + len(d)] = d.argmin(1)
                radius[at:at + len(d)] = d.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(radius)],
                                             names=[*batch.schema.names, "cell", "radius"])

    schema = T.StructType([*points.schema.fields, T.StructField("cell", T.IntegerType()),
                           T.StructField("radius", T.DoubleType())])
    return materialise(points.mapInArrow(assign, schema), "knn_cells")


def _blocks(cells: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` points, in id order inside: block, cell, low, high, n, id, label, fold, x."""
    order = ["cell", "radius", "id", "label"]

    def pack(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def block(table):
            radius = table.column("radius").to_numpy()
            table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending"), ("label", "ascending")],
                                               null_placement="at_start"))
            one = lambda name: pa.array([table.column(name).to_pylist()], pa.list_(table.schema.field(name).type))
            x = _matrix(table.column("x").combine_chunks())
            return pa.RecordBatch.from_arrays(
                [pa.array([table.column("cell")[0].as_py()], pa.int32()), pa.array([radius[0]]), pa.array([radius[-1]]),
                 pa.array([len(x)], pa.int32()), one("id"), one("label"), one("fold"), pa.array([x.tobytes()], pa.binary())],
                names=["cell", "low", "high", "n", "id", "label", "fold", "x"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows:
                cell = held.column("cell").to_numpy()
                end = int(np.searchsorted(cell, cell[0], "right"))
                if end == held.num_rows and end < rows:
                    break        # the cell may go on
                yield block(held.slice(0, min(end, rows)))
                held = held.slice(min(end, rows))
        if held is not None and held.num_rows:
            yield block(held)

    kinds = {f.name: f.dataType for f in cells.schema.fields}
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("low", T.DoubleType()),
                           T.StructField("high", T.DoubleType()), T.StructField("n", T.IntegerType()),
                           *[T.StructField(c, T.ArrayType(kinds[c])) for c in ("id", "label", "fold")],
                           T.StructField("x", T.BinaryType())])
    dealt = cells.repartitionByRange(*order).sortWithinPartitions(*order)
    packed = dealt.mapInArrow(pack, schema)
    return materialise(packed.select(F.monotonically_increasing_id().alias("block"), "*"), "knn_blocks")


def _near_radii(cells: DataFrame, k: int, n_cells: int) -> dict:
    """Per excluded fold (None: no fold) the k smallest radii of each cell, infinite where there are fewer."""
    place = Window.partitionBy("cell", "fold").orderBy("radius")
    smallest = (cells.select("cell", "fold", "radius").withColumn("turn", F.row_number().over(place))
                .where(F.col("turn") <= k).collect())
    by_fold: dict = {}
    for r in smallest:
        by_fold.setdefault(r["fold"], {}).setdefault(r["cell"], []).append(r["radius"])
    out = {}
    for excluded in [None, *[f for f in by_fold if f is not None]]:
        table = np.full((n_cells, k), np.inf)
        for c in range(n_cells):
            radii = sorted(r for f, cell in by_fold.items() if f is None or f != excluded for r in cell.get(c, ()))[:k]
            table[c, :len(radii)] = radii
        out[excluded] = table
    return out


def index_points(points: DataFrame, features: list[str] | str, k: int, id_col: str, label_col: str | None = None,
                 fold_col: str | None = None, max_pivots: int = MAX_PIVOTS, block_rows: int = BLOCK_ROWS
                 ) -> tuple[Bounds | None, DataFrame | None]:
    """The bounds and the blocks of ``points`` for neighbour searches of up to ``k``; (None, None) without
    whole points. Points whose vectors are not as long as the first pivot raise an error."""
    rows = points.select(F.col(id_col).alias("id"),
                         (F.col(label_col).cast("int") if label_col else F.lit(None).cast("int")).alias("label"),
                         _fold_type(fold_col).alias("fold"), vector(features).alias("x")).where(_whole("x"))
    if label_col:
        rows = rows.where(F.col("label").isNotNull())
    n = rows.count()
    if n == 0:
        return None, None
    wanted = max(1, min(max_pivots, math.isqrt(n)))
    drawn = rows.select("x", F.xxhash64("x", "id").alias("h")).orderBy("h", "x").limit(wanted).collect()
    drawn = [r["x"] for r in drawn]
    if len(drawn[0]) >= WIDE:
        block_rows *= WIDE_BLOCKS
        drawn = drawn[:max(1, n // block_rows)]
    pivots = np.unique(np.array(drawn, np.float64), axis=0)
    width = F.size("x") == pivots.shape[1]
    rows = rows.withColumn("x", F.when(width, F.col("x")).otherwise(
        F.raise_error(F.lit(f"a vector does not have {pivots.shape[1]} components"))))
    cells = _assigned(rows, k, pivots)
    blocks = _blocks(cells, max(block_rows, -(-n // MAX_BLOCKS)))
    ring = blocks.select("block", "cell", "low", "high").orderBy("cell", "low", "block").toPandas()
    cell = ring["cell"].to_numpy()
    first = np.searchsorted(cell, np.arange(len(pivots) + 1))
    reach = np.full(len(pivots), -np.inf)
    np.maximum.at(reach, cell, ring["high"].to_numpy())
    return Bounds(pivots, ring["block"].to_numpy(), cell, ring["low"].to_numpy(), ring["high"].to_numpy(), first, reach,
                  _near_radii(cells, k, len(pivots))), blocks


def _visit_rows(queries: DataFrame, bounds: Bounds, k: int) -> DataFrame:
    """``block, n, uid, fold, bound, x``: the queries that visit a block, packed by Arrow batch."""
    shared = queries.sparkSession.sparkContext.broadcast(bounds)

    def visit(batches):
        import pyarrow as pa
        known = shared.value
        names = ["block", "n", "uid", "fold", "bound", "x"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            x = _matrix(batch.column("x"))
            uid = batch.column("uid").to_numpy()
            fold = batch.column("fold").fill_null(-1).to_numpy().astype(np.int32)
            for at, d in _pivot_distances(x, known.pivots, PACK_QUERIES):
                rows = slice(at, at + len(d))
                bound = np.empty(len(d))
                for f in np.unique(fold[rows]):
                    same = fold[rows] == f
                    bound[same] = known.threshold(d[same], k, None if f < 0 else int(f))
                out = [[], [], [], [], [], []]
                held = 0
                for b, hit in known.visits(d, bound):
                    part = at + hit
                    values = (int(known.block[b]), len(hit), uid[part].tobytes(), fold[part].tobytes(),
                              bound[hit].tobytes(), x[part].tobytes())
                    for column, v in zip(out, values):
                        column.append(v)
                    held += len(hit) * x.shape[1]
                    if held > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)
                        out, held = [[], [], [], [], [], []], 0
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return materialise(queries.mapInArrow(visit, "block long, n int, uid binary, fold binary, bound binary, x binary"),
                       "knn_visits")


def _nearest_in_block(q: np.ndarray, bound: np.ndarray, folds: np.ndarray, x: np.ndarray, point_folds: np.ndarray, k: int):
    """Positions and squared distances of each query's k nearest points of a block within its bound, by
    (distance, position); infinite where there are fewer."""
    wide = bound + SLACK * (1 + bound)
    if x.shape[1] >= WIDE:
        foreign = folds[:, None] == point_folds[None, :]
        found = _wide_nearest(q, x, k, wide * wide, foreign if foreign.any() else None)
        if found is not None:
            return found
    d2 = _squared(q, x)
    d2[(d2 > (wide * wide)[:, None]) | (folds[:, None] == point_folds[None, :])] = np.inf
    k = min(k, d2.shape[1])
    if k < d2.shape[1]:
        cut = np.partition(d2, k - 1, axis=1)[:, k - 1]
        at = np.argpartition(d2, k - 1, axis=1)[:, :k]
        for i in np.flatnonzero(((d2 <= cut[:, None]).sum(1) > k) & np.isfinite(cut)):   # ties at the k-th distance
            near = np.flatnonzero(d2[i] <= cut[i])
            at[i] = near[np.lexsort((near, d2[i][near]))[:k]]
    else:
        at = np.broadcast_to(np.arange(k), d2.shape)
    d2 = np.take_along_axis(d2, at, 1)
    order = np.lexsort((at, d2), axis=1)
    return np.take_along_axis(at, order, 1), np.take_along_axis(d2, order, 1)


def _matches(visits: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """``uid, near`` (squared distance, id, label): the k best of each query in each block it visits."""
    # one row per block, at most MAX_BLOCKS + pivots + partitions of them
    load = visits.groupBy("block").agg(F.ceil(F.sum("n") / GROUP_QUERIES).alias("slices"))
    left = visits.join(F.broadcast(load), "block").withColumn("slice", F.pmod(F.xxhash64("uid"), F.col("slices"))).drop("slices")
    right = blocks.join(F.broadcast(load), "block") \
        .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).drop("slices")

    def match(key, seekers, points):
        import pyarrow as pa
        if not points.num_rows or not seekers.num_rows:
            return pa.table({"uid": pa.array([], pa.int64()), "near": pa.array([], near_type)})
        one = points.slice(0, 1).to_batches()[0]
        n = one.column("n")[0].as_py()
        x = np.frombuffer(one.column("x")[0].as_py(), np.float64).reshape(n, -1)
        ids, labels = one.column("id").flatten(), one.column("label").flatten()
        folds = one.column("fold").flatten().fill_null(-2).to_numpy().astype(np.int32)
        uids, sizes, at, d2 = [], [], [], []
        step = max(1, 2_000_000 // n)
        for i in range(seekers.num_rows):
            get = lambda name, kind: np.frombuffer(seekers.column(name)[i].as_py(), kind)  # noqa: B023, E731
            q = get("x", np.float64).reshape(-1, x.shape[1])
            uid, bound, fold = get("uid", np.int64), get("bound", np.float64), get("fold", np.int32)
            for lo in range(0, len(q), step):
                part = slice(lo, lo + step)
                found, squared = _nearest_in_block(q[part], bound[part], fold[part], x, folds, k)
                real = np.isfinite(squared)
                any_ = real.any(1)
                uids.append(uid[part][any_])
                sizes.append(real.sum(1)[any_])
                at.append(found[real])
                d2.append(squared[real])
        place = pa.array(np.concatenate(at), pa.int64())
        triples = pa.StructArray.from_arrays([pa.array(np.concatenate(d2)), ids.take(place), labels.take(place)],
                                             fields=list(near_type.value_type))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        return pa.table({"uid": pa.array(np.concatenate(uids)), "near": pa.ListArray.from_arrays(pa.array(ends), triples)})

    id_type = blocks.schema["id"].dataType.elementType
    near = T.ArrayType(T.StructType([T.StructField("d2", T.DoubleType()), T.StructField("id", id_type),
                                     T.StructField("label", T.IntegerType())]))
    from pyspark.sql.pandas.types import to_arrow_type
    near_type = to_arrow_type(near)
    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("near", near)])
    return left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInArrow(match, schema)


def knn_join(queries: DataFrame, points: DataFrame, features: list[str] | str, k: int, id_col: str,
             label_col: str | None = None, fold_col: str | None = None, point_features: list[str] | str | None = None,
             out_col: str = "neighbours", max_pivots: int = MAX_PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``queries`` with ``out_col``: the k nearest ``points`` of each row by Euclidean distance, as an array of
    (distance, id, label), nearest first, ties by id (a null id first).

    With ``fold_col`` (in both tables) a row's neighbours come from the other folds. Points with a null
    label (where one is asked for) or a null, NaN or infinite component take no part; queries with such a
    component, and all if there are no points, get an empty array. Query rows need no id and may repeat.
    With fewer than k points a row has them all.
    """
    bounds, blocks = index_points(points, point_features or features, k, id_col, label_col, fold_col, max_pivots, block_rows)
    if bounds is None:
        id_type = points.schema[id_col].dataType.simpleString()
        return queries.withColumn(out_col, F.array().cast(f"array<struct<distance:double,id:{id_type},label:int>>"))
    # numbered once: the written table gives every later reader the same numbers
    rows = materialise(queries.select(F.struct(*[queries[c] for c in queries.columns]).alias("row"),
                                      F.monotonically_increasing_id().alias("uid"), _fold_type(fold_col).alias("fold"),
                                      vector(features).alias("x")), "knn_queries")
    whole = rows.where(_whole("x")).select("uid", "fold", "x")
    visits = _visit_rows(whole, bounds, k)
    best = _matches(visits, blocks, k).groupBy("uid").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near")).withColumnRenamed("uid", "found")
    joined = rows.join(best, F.col("uid") == F.col("found"), "left")
    near = F.transform(F.col("near"), lambda m: F.struct(
        F.sqrt(m["d2"]).alias("distance"), m["id"].alias("id"), m["label"].alias("label")))
    kind = joined.select(near.alias("n")).schema["n"].dataType
    return joined.select(*[F.col("row")[c].alias(c) for c in queries.columns if c != out_col],
                         F.coalesce(near, F.array().cast(kind)).alias(out_col))
