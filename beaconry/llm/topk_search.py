"""Exact top-k search by inner product: cover trees over queries and data, walked together."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import quoted
from beaconry.session import materialize

#: points of a leaf; leaves are compared as matrices
LEAF = 256
FAN = 16
#: rows of a block of data and of a batch of queries: what a task holds
BLOCK_ROWS = 4096
BATCH_ROWS = 2048
#: cells under an upper cell, and upper cells: what a task needs to place a vector is at most their product of pivots
FAN_CELLS = 256
#: a cell's number is that of its upper cell, then its own in so many bits
CELL_BITS = 16
LOWEST = -(1 << 63)
#: stands for a score that does not fit a long, as its negative does
BEYOND = (1 << 63) - 1


class CoverTree:
    """Points under nested nets. The children's centres of a node are a net of its points: every point is within some
    radius of its centre, and the centres lie at least that radius apart. The radius is the smallest that ``FAN`` centres
    reach when each next centre is the point farthest from those before, so it adapts to points of any dimension."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.center: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray] = []
        self.members: list[np.ndarray] = []
        if len(points):
            work = [self._node(np.arange(len(points)), 0, self._distance(0, np.arange(len(points))))]
            while work:
                work += self._split(work.pop())
        self.heart = points[self.center]
        self.reach = np.array(self.radius)
        with np.errstate(over="ignore"):
            self.norm = np.sqrt((self.heart * self.heart).sum(axis=1))

    def _distance(self, center: int, rows: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            gap = self.points[rows] - self.points[center]
            return np.sqrt((gap * gap).sum(axis=1))

    def _node(self, rows: np.ndarray, center: int, far: np.ndarray) -> int:
        self.center.append(center)
        self.radius.append(float(far.max()) * (1 + 1e-12))
        self.children.append(np.zeros(0, np.int64))
        self.members.append(rows)
        return len(self.center) - 1

    def members_of(self, node: int) -> np.ndarray:
        return self.members[node]

    def _split(self, node: int) -> list[int]:
        rows = self.members[node]
        if len(rows) <= LEAF or self.radius[node] == 0:
            return []
        centers = [self.center[node]]
        far = self._distance(centers[0], rows)
        own = np.zeros(len(rows), np.int64)
        while len(centers) < FAN and far.max() > 0:
            centers.append(int(rows[far.argmax()]))
            again = self._distance(centers[-1], rows)
            nearer = again < far
            own[nearer], far[nearer] = len(centers) - 1, again[nearer]
        found = [self._node(rows[own == n], c, far[own == n]) for n, c in enumerate(centers)]
        self.children[node] = np.array(found)
        return found


def bounds(left: CoverTree, a: np.ndarray, right: CoverTree, b: np.ndarray) -> np.ndarray:
    """Upper bounds on the inner products of any two points covered by pairs of nodes, not below ``LOWEST``.

    What rounding can take away is a share of the norms, also where products cancel out."""
    with np.errstate(over="ignore", invalid="ignore"):
        far = left.norm[a][:, None] + left.reach[a][:, None]
        most = (left.heart[a] @ right.heart[b].T + left.reach[a][:, None] * right.norm[b] + left.norm[a][:, None] * right.reach[b]
                + left.reach[a][:, None] * right.reach[b] + 1e-9 * far * (right.norm[b] + right.reach[b]) + 1e-6)
    return np.maximum(np.where(np.isnan(most), np.inf, most), LOWEST)


def _wrapped(points: np.ndarray) -> np.ndarray:
    """Whole numbers of any size modulo 2**64."""
    size = np.fmod(np.abs(points), 2.0**64).astype(np.uint64).view(np.int64)
    return np.where(points < 0, -size, size)


def wide_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers of any size; those that do not fit a long become plus or minus ``BEYOND``.

    Products modulo 2**64 are right wherever the whole score fits, which is seen from its rounded value; where that
    is too near the limits, Python's numbers decide."""
    out = _wrapped(x) @ _wrapped(y).T
    with np.errstate(over="ignore", invalid="ignore"):
        near, error = x @ y.T, np.abs(x) @ np.abs(y).T * (2.0**-50 * (x.shape[1] + 2))
        fits, over = np.abs(near) + error < 2.0**62, np.abs(near) - error > 2.0**63
    out[over] = np.where(near[over] < 0, -BEYOND, BEYOND)
    for i, j in zip(*np.nonzero(~fits & ~over)):
        score = sum(int(a) * int(b) for a, b in zip(x[i], y[j]))
        out[i, j] = max(-BEYOND, min(BEYOND, score))
    return out


def dual_search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, data: np.ndarray, ids: np.ndarray,
                k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the ``k`` best (row of the query, id, score) among the data, but those below the query's floor.

    Node pairs are opened best bound first. A pair is pruned if its bound is below the worst kth score, or floor, of
    all queries under the query node; equal bounds are opened, as ties go to the smaller id.
    """
    if not len(queries) or not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    scores = np.full((len(queries), k), LOWEST, np.int64)
    names = np.full((len(queries), k), np.iinfo(np.int64).max)
    left, right = CoverTree(queries), CoverTree(data)
    with np.errstate(over="ignore"):
        exact = np.abs(queries).max(initial=0) * np.abs(data).max(initial=0) * queries.shape[1] < 2**52
    worst = floor.copy()
    root = np.zeros(1, np.int64)
    heap = [(-float(bounds(left, root, right, root)[0, 0]), 0, 0)]
    while heap:
        top, a, b = heapq.heappop(heap)
        if -top < worst[left.members[a]].min():
            continue
        if len(left.children[a]) or len(right.children[b]):
            xs = left.children[a] if len(left.children[a]) else np.array([a])
            ys = right.children[b] if len(right.children[b]) else np.array([b])
            limit = bounds(left, xs, right, ys)
            least = np.array([worst[left.members[x]].min() for x in xs])
            for i, j in zip(*np.nonzero(limit >= least[:, None])):
                heapq.heappush(heap, (-float(limit[i, j]), int(xs[i]), int(ys[j])))
            continue
        rows, own = left.members_of(a), right.members_of(b)
        found = (queries[rows] @ data[own].T).astype(np.int64) if exact else wide_products(queries[rows], data[own])
        found[query_ids[rows][:, None] == ids[own]] = LOWEST
        row, column = np.nonzero((found >= worst[rows][:, None]) & (found > LOWEST))
        if not len(row):
            continue
        # the rows' best so far and what may be better, in one order
        which = np.unique(row)
        owner = np.concatenate((np.repeat(which, k), row))
        score = np.concatenate((scores[rows[which]].ravel(), found[row, column]))
        name = np.concatenate((names[rows[which]].ravel(), ids[own[column]]))
        order = np.lexsort((name, ~score, owner))
        place = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        best = order[place < k]
        scores[rows[which]] = score[best].reshape(len(which), k)
        names[rows[which]] = name[best].reshape(len(which), k)
        worst[rows] = np.maximum(floor[rows], scores[rows][:, -1])
    row, rank = np.nonzero((scores > LOWEST) & (scores >= floor[:, None]))
    return row, names[row, rank], scores[row, rank]


def _points(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["point"].tolist(), np.float64).reshape(len(frame), -1)


def _searching(k: int):
    def search(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(data) and len(asked):
            row, ids, scores = dual_search(_points(asked), asked["id"].to_numpy(), asked["floor"].to_numpy(),
                                           _points(data), data["id"].to_numpy(), k)
            out = {"query_id": asked["id"].to_numpy()[row], "vec_id": ids, "score": scores}
        return pd.DataFrame(out).astype("int64")

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _scaled(vectors: DataFrame, is_query, key: str, vector: str, scale: float) -> DataFrame:
    """``id, asks, point`` of all rows with a key and a vector of finite components, scaled and rounded down."""
    def whole(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) >= 2.0**53, y).otherwise(F.floor(y).cast("double"))

    sound = F.forall(quoted(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < float("inf")))
    return vectors.filter(quoted(key).isNotNull() & quoted(vector).isNotNull() & sound).select(
        quoted(key).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(quoted(vector), whole).alias("point"))


def search_rows(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 5,
                scale: float = 256.0) -> DataFrame:
    """For every query its ``k`` best rows of other keys by inner product: ``query_id, rank, vec_id, score``.

    Components become ``floor(scale * x)``, so scores are exact whole numbers; ties go to the smaller key.
    ``is_query`` is a condition on the input's columns. Vectors that are null or hold null or non-finite components,
    before or after scaling, take no part, nor do rows without a key. Every other row counts, however large its
    components: rows that share a key are candidates of their own, and as queries are answered together by the ``k``
    best of all their pairs. Only vectors of the query's length are its candidates; fewer than ``k`` give fewer rows. An
    empty table, or one without queries, gives none. Other columns are not read. A score that does not fit a long is
    null; such scores are beyond all others of their sign, and equal among themselves.

    Data lie in blocks and queries in batches of bounded size, both cut out of cells around sampled pivots, and cells
    lie under upper cells. A batch is first searched in its own cell, which gives every query a floor; then only in
    blocks that can hold a score at or above the lowest floor of the batch, by the bound that also prunes inside the
    trees. Upper cells are compared first, and only under pairs that can matter blocks meet batches.
    """
    return _search(_scaled(vectors, is_query, key, vector, scale), k)


def _nearest(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return ((pivots * pivots).sum(axis=1) - 2 * points @ pivots.T).argmin(axis=1)


def _placing(pivots: list[list[float]]):
    """The cell of a vector: its nearest upper pivot among the first, then the nearest of the pivots under that one.

    Only pivots of a vector's length count; a vector that has none goes to cell 0.
    """
    trees: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for size in sorted({len(p) for p in pivots} - {0}):
        own = np.array([p for p in pivots if len(p) == size], float)
        heads = own[:FAN_CELLS]
        under = _nearest(own, heads)
        trees[size] = heads, [own[under == n] for n in range(len(heads))]

    def cell_of(points: pd.Series) -> pd.Series:
        out = np.zeros(len(points), np.int32)
        sizes = points.map(len).to_numpy()
        for size in np.unique(sizes):
            if size not in trees:
                continue
            heads, below = trees[size]
            own = np.flatnonzero(sizes == size)
            x = np.array(points.iloc[own].tolist(), float)
            top = _nearest(x, heads)
            for n in np.unique(top):
                mine = top == n
                sub = _nearest(x[mine], below[n]) if len(below[n]) else np.zeros(mine.sum(), int)
                out[own[mine]] = (n << CELL_BITS) + sub
        return pd.Series(out)

    # for annotations that are strings, Spark would have to guess
    cell_of.__annotations__ = {"points": pd.Series, "return": pd.Series}
    return cell_of


def _can_reach() -> Column:
    """Whether a pair of covers, ``q_`` and ``d_``, can hold a score at or above the least floor of the queries."""
    reach = F.aggregate(F.zip_with("q_center", "d_center", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) + (
        F.col("q_radius") * F.col("d_norm") + F.col("d_radius") * F.col("q_norm") + F.col("q_radius") * F.col("d_radius"))
    rounding = 1e-9 * (F.col("q_norm") + F.col("q_radius")) * (F.col("d_norm") + F.col("d_radius"))
    # a query that has fewer than k so far takes any block
    return (F.col("q_least") == LOWEST) | (reach + rounding + 1e-6 >= F.col("q_least"))


def _reaching(queries: DataFrame, data: DataFrame, q_by: str, d_by: str) -> DataFrame:
    """Pairs of covers of vectors of one length that can hold a score that counts."""
    left = queries.select(F.col(q_by)["size"].alias("size"), *[F.col(c).alias(f"q_{c}") for c in queries.columns])
    right = data.select(F.col(d_by)["size"].alias("size"), *[F.col(c).alias(f"d_{c}") for c in data.columns])
    return left.join(right, "size").filter(_can_reach())


UPPER_COVER = "top struct<top:int,size:int>, center array<double>, radius double, norm double, least long"


def _upper_cover(frame: pd.DataFrame) -> pd.DataFrame:
    """One cover around the covers of a group."""
    centers, radius = np.array(frame["center"].tolist(), float), frame["radius"].to_numpy(float)
    with np.errstate(over="ignore", invalid="ignore"):
        center = centers.mean(axis=0)
        reach = float((np.sqrt(((centers - center) ** 2).sum(axis=1)) + radius).max()) * (1 + 1e-9)
    least = frame["least"].min() if frame["least"].notna().all() else None
    return pd.DataFrame({"top": [frame["top"].iloc[0]], "center": [center], "radius": [reach], "norm": [float(np.linalg.norm(center))],
                         "least": pd.array([least], "Int64")})


def _search(rows: DataFrame, k: int) -> DataFrame:
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "top-vectors")
    count = rows.count()
    cells = max(1, min(FAN_CELLS * FAN_CELLS, -(-count // BLOCK_ROWS)))
    cell_of = F.pandas_udf(_placing([r.point for r in rows.orderBy(F.xxhash64("row"), "row").limit(cells).collect()]), "int")
    placed = materialize(rows.withColumn("cell", cell_of("point")).withColumn("size", F.size("point")), "top-cells")
    held = placed.groupBy("cell", "size").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("asks").cast("int")).alias("asked"))

    def cut(rows: int, column: str):
        return F.struct("cell", "size", F.pmod(F.xxhash64("row"), F.greatest(F.lit(1), F.ceil(F.col(column) / rows))).alias("nth"))

    parted = materialize(placed.join(held, ["cell", "size"]).select(
        "id", "point", "asks", "cell", "size", cut(BLOCK_ROWS, "rows").alias("block"),
        F.when(F.col("asks"), cut(BATCH_ROWS, "asked")).alias("batch")), "top-blocks")
    data = parted.select("block", "id", "point")
    asked = materialize(parted.filter("asks").select("batch", "id", "point"), "top-queries")

    def searched(pairs: DataFrame, queries: DataFrame) -> DataFrame:
        pairs = materialize(pairs.select("block", "batch"), "top-pairs")
        again = pairs.select(F.col("block").alias("of"), F.col("batch").alias("to"))
        left = data.join(pairs, "block").groupBy("block", "batch")
        right = queries.join(again, queries["batch"] == again["to"]).select(
            "of", "to", F.col("id").alias("id"), F.col("point").alias("point"), "floor").groupBy("of", "to")
        return left.cogroup(right).applyInPandas(_searching(k), "query_id long, vec_id long, score long")

    blocks, batches = _covers(data, "block"), _covers(asked, "batch")
    blocks, batches = materialize(blocks, "top-block-covers"), materialize(batches, "top-batch-covers")
    pairs = batches.select("batch", F.col("batch.size").alias("size"), F.col("batch.cell").alias("cell")).join(
        blocks.select("block", F.col("block.size").alias("size"), F.col("block.cell").alias("cell")), ["size", "cell"])
    first = materialize(
        _best(searched(pairs, asked.withColumn("floor", F.lit(LOWEST))), k), "top-first")
    floors = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    floored = materialize(asked.join(floors, "id", "left").withColumn(
        "floor", F.coalesce("floor", F.lit(LOWEST))), "top-floors")
    least = floored.groupBy("batch").agg(F.min("floor").alias("least"))

    def upper(covers: DataFrame, by: str, name: str) -> DataFrame:
        """Covers of the upper cells, each with the least floor under it."""
        under = covers.select(F.struct(F.shiftright(F.col(by)["cell"], CELL_BITS).alias("top"), F.col(by)["size"].alias("size")).alias("top"),
                              "center", "radius", "least" if "least" in covers.columns else F.lit(None).cast("long").alias("least"))
        return materialize(under.groupBy("top").applyInPandas(_upper_cover, UPPER_COVER), name)

    batches = materialize(batches.join(least, "batch"), "top-batch-floors")
    tops = _reaching(upper(batches, "batch", "top-query-uppers"), upper(blocks, "block", "top-data-uppers"), "top", "top")
    # nodes of the two trees, not rows: upper cells against upper cells, then only what lies under the pairs left
    tops = materialize(tops.select(F.col("q_top").alias("q_top"), F.col("d_top").alias("d_top")), "top-upper-pairs")

    def under(covers: DataFrame, by: str, side: str) -> DataFrame:
        top = F.struct(F.shiftright(F.col(by)["cell"], CELL_BITS).alias("top"), F.col(by)["size"].alias("size"))
        return covers.select(*[F.col(c).alias(f"{side}_{c}") for c in covers.columns], top.alias(f"{side}_top"))

    near = tops.join(under(batches, "batch", "q"), "q_top").join(under(blocks, "block", "d"), "d_top")
    others = near.filter(_can_reach() & (F.col("q_batch.cell") != F.col("d_block.cell"))).select(
        F.col("d_block").alias("block"), F.col("q_batch").alias("batch"))
    rest = searched(others, floored)
    score = F.when(F.abs("score") < BEYOND, F.col("score"))
    return _best(first.select("query_id", "vec_id", "score").unionByName(rest), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))


def _covers(rows: DataFrame, by: str) -> DataFrame:
    """Centre, radius and the centre's norm of each group of points."""
    def cover(frame: pd.DataFrame) -> pd.DataFrame:
        points = _points(frame)
        with np.errstate(over="ignore", invalid="ignore"):
            center = points.mean(axis=0)
            radius = float(np.sqrt(((points - center) ** 2).sum(axis=1)).max()) * (1 + 1e-9)
        return pd.DataFrame({by: [frame[by].iloc[0]], "center": [center], "radius": [radius], "norm": [float(np.linalg.norm(center))]})

    kind = "struct<cell:int,size:int,nth:long>"
    return rows.groupBy(by).applyInPandas(cover, f"{by} {kind}, center array<double>, radius double, norm double")
