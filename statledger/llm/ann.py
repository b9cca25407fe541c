"""Nearest neighbours by inner product: one vantage-point tree per shard, pruned by a relaxed triangle inequality.

Method. With ``M`` the largest norm, a vector ``x`` gets one more component ``sqrt(M^2 - |x|^2)`` and a query a zero, so that the
Euclidean distance falls as the inner product grows. A tree parts its vectors by their distance from a vantage point. A child whose
distances from the vantage point lie in ``[low, high]`` holds nothing nearer to a query at distance ``d`` than
``max(d - high, low - d, 0)``; it is left out when ``factor`` times that exceeds the distance of the k-th best so far. A factor of 1
gives exact search, larger ones prune more and may miss. The top of the tree is grown on at most ``SAMPLE`` vectors and deals all
vectors into regions of about ``SHARD`` rows, whose centres are vantage points too, with the ranges of all rows; a region with more is cut into several shards. Each shard grows its
own tree, down to leaves of ``LEAF``. A query first asks the shards of the region it lies in. The k-th best of these then tells which other
regions can hold anything nearer, and only their shards are asked, in blocks of ``BLOCK`` queries; the best of all are merged per query.

Score. The inner product of the original vectors in double precision, each row summed in the same way, so equal vectors have
equal scores. Ties go to the smaller vec_id.

Defined results. Null, empty and zero vectors, vectors with null or non-finite components, and rows without vec_id take no
part. Rows that repeat a vec_id with an equal vector count once; with another vector, each is a candidate and the query asks
with each (their ranks are those of the best score of each candidate). Vectors of another length than most (ties: the longer) take
no part. Fewer candidates than ``k`` give them all. An empty table gives no rows. Other columns are not looked at.

At scale. A task holds one shard's tree and one block of queries; what a shard gives back is at most ``k`` ids a query. The driver
holds the sample, which is bounded in rows and bytes, and two numbers for each part of the top tree. Vectors are shuffled once a round, in
the type of the table. How many shards a query asks depends on how clustered the vectors are: vectors without any structure let no region be ruled out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .shared import stored

K, FACTOR, SHARD, LEAF, BLOCK = 20, 1.0, 4096, 256, 1024
SAMPLE, SAMPLE_BYTES, SAMPLED_A_REGION = 16384, 32 << 20, 8
SEEN_BYTES = 16 << 20


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part; components stay ``float`` where the table holds such."""
    kind = rows.schema["embedding"].dataType
    kind = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("vector", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(finite & some)


def _distances(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - point) ** 2).sum(1))


def _augmented(vectors: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([vectors, np.sqrt(np.maximum(norm * norm - (vectors**2).sum(1), 0))[:, None]])


def _farthest(points: np.ndarray) -> int:
    """The vantage point of some points: the one farthest from their mean."""
    return int(np.argmax(((points - points.mean(0)) ** 2).sum(1)))


def _nearer(bound: np.ndarray, square: np.ndarray) -> np.ndarray:
    """Whether a bound leaves room for something within the squared distance; the slack covers rounding, so that a factor of 1 stays exact."""
    return bound <= np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + 1e-9


class Regions:
    """Top of the vantage-point tree: deals vectors into regions, and tells which of them a query has to ask.

    Side ``2 i + s`` of node ``i`` holds the vectors on one side of its split; ``below`` names the node that parts it further, or ``-1 - region``.
    A region has its centre as one more vantage point, whose side comes after those of all nodes.
    """

    def __init__(self, sample: np.ndarray, norm: float, regions: int):
        self.norm, self.vantage, self.split, self.below, self.centre = norm, [], [], [], []
        self.top = self._grow(_augmented(sample, norm), regions)
        self.count = len(self.centre)

    def _grow(self, points: np.ndarray, regions: int) -> int:
        if regions > 1 and len(points) > 1:
            vantage = points[_farthest(points)]
            away = _distances(points, vantage)
            split = np.sort(away)[len(points) * (regions // 2) // regions]
            outer = away >= split
            if not outer.all():
                node = len(self.vantage)
                self.vantage.append(vantage)
                self.split.append(split)
                self.below += [0, 0]
                self.below[2 * node] = self._grow(points[~outer], regions // 2)
                self.below[2 * node + 1] = self._grow(points[outer], regions - regions // 2)
                return node
        self.centre.append(points.mean(0) if len(points) else np.zeros(points.shape[1]))
        return -len(self.centre)

    def region_of(self, points: np.ndarray, sides=None) -> np.ndarray:
        """Region of each point; ``sides`` gets (side, least and greatest distance, number) of all sides on the way."""
        regions = np.zeros(len(points), np.int64)

        def visit(node: int, active: np.ndarray) -> None:
            if not len(active):
                return
            if node < 0:
                regions[active] = -1 - node
                if sides is not None:
                    away = _distances(points[active], self.centre[-1 - node])
                    sides.append((2 * len(self.vantage) - 1 - node, away.min(), away.max(), len(active)))
                return
            away = _distances(points[active], self.vantage[node])
            outer = away >= self.split[node]
            for side, chosen in enumerate((~outer, outer)):
                if sides is not None and chosen.any():
                    sides.append((2 * node + side, away[chosen].min(), away[chosen].max(), int(chosen.sum())))
                visit(self.below[2 * node + side], active[chosen])

        visit(self.top, np.arange(len(points)))
        return regions

    def measured(self, sides: dict[int, tuple[float, float, int]], n: int, shard: int) -> None:
        """Take the ranges of all ``n`` vectors, and cut each region into shards of about ``shard`` rows."""
        self.sides = sides
        rows = [sides.get(2 * len(self.vantage) + region, (0, 0, 0))[2] for region in range(self.count)] if self.count > 1 else [n]
        self.parts = np.array([-(-held // shard) for held in rows], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.parts)[:-1]]).astype(np.int64)

    def near(self, points: np.ndarray, square: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Point number and region of all regions that may hold something within the squared distance."""
        who, where = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def left(active: np.ndarray, vantage: np.ndarray, side: int) -> np.ndarray:
            if side not in self.sides:
                return active[:0]
            low, high, _ = self.sides[side]
            away = _distances(points[active], vantage)
            return active[_nearer(np.maximum(np.maximum(away - high, low - away), 0) * factor, square[active])]

        def visit(node: int, active: np.ndarray) -> None:
            if node < 0:
                active = left(active, self.centre[-1 - node], 2 * len(self.vantage) - 1 - node)
                who.append(active)
                where.append(np.full(len(active), -1 - node))
                return
            for side in (2 * node, 2 * node + 1):
                rest = left(active, self.vantage[node], side)
                if len(rest):
                    visit(self.below[side], rest)

        visit(self.top, np.arange(len(points)))
        return np.concatenate(who), np.concatenate(where)


class Tree:
    """Vantage-point tree over augmented vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, leaf: int = LEAF):
        order = np.lexsort((*vectors.T[::-1], ids))
        self.ids, self.vectors = ids[order], vectors[order]
        self.points = _augmented(self.vectors, norm)
        self.leaf, self.top = leaf, norm * norm
        self.root = self._grow(np.arange(len(ids)))

    def _grow(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return ("leaf", np.sort(rows))
        vantage = rows[_farthest(self.points[rows])]
        away = _distances(self.points[rows], self.points[vantage])
        order = np.argsort(away, kind="stable")
        half = len(rows) // 2  # by rank, so that equal distances still part
        children = []
        for side in (order[:half], order[half:]):
            children.append((away[side[0]], away[side[-1]], self._grow(rows[side])))
        return ("node", vantage, children)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, vec_id and score of the ``k`` best of each query that score at least its ``floor``, a query's own id left out."""
        n = len(queries)
        self.square = (queries**2).sum(1)
        self.queries, self.own, self.k, self.factor = queries, own, k, factor
        self.padded = np.hstack([queries, np.zeros((n, 1))])
        self.floor = floor.copy()  # score of the k-th best id
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self._visit(self.root, np.arange(n))
        return self.best

    def _limit(self, active: np.ndarray) -> np.ndarray:
        """Squared distance of the k-th best."""
        return self.square[active] * (1 + 1e-12) + self.top * (1 + 1e-12) - 2 * self.floor[active]

    def _visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if node[0] == "leaf":
            self._look(node[1], active)
            return
        _, vantage, children = node
        away = _distances(self.padded[active], self.points[vantage])
        inner_first = away <= (children[0][1] + children[1][0]) / 2
        for first, chosen in ((0, inner_first), (1, ~inner_first)):
            some, far = active[chosen], away[chosen]
            for side in (first, 1 - first):
                low, high, child = children[side]
                bound = np.maximum(np.maximum(far - high, low - far), 0) * self.factor
                self._visit(child, some[_nearer(bound, self._limit(some))])

    def _look(self, rows: np.ndarray, active: np.ndarray) -> None:
        rough = self.queries[active] @ self.vectors[rows].T
        slack = 1e-9 * (1 + np.abs(rough).max())
        at, place = np.nonzero((rough >= self.floor[active][:, None] - slack) & (self.own[active][:, None] != self.ids[rows][None, :]))
        query, row = active[at], rows[place]
        score = (self.queries[query] * self.vectors[row]).sum(1)
        mine = np.isin(self.best[0], active)
        query = np.concatenate([self.best[0][mine], query])
        ids = np.concatenate([self.best[1][mine], self.ids[row]])
        score = np.concatenate([self.best[2][mine], score])
        order = np.lexsort((-score, ids, query))
        query, ids, score = query[order], ids[order], score[order]
        # an id takes one place, with its best score
        once = np.append([True], (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])) if len(query) else np.zeros(0, bool)
        query, ids, score = query[once], ids[once], score[once]
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        start = np.flatnonzero(np.append([True], query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
        full = rank == self.k - 1
        self.floor[query[full]] = np.maximum(self.floor[query[full]], score[full])
        keep = rank < self.k
        self.best = tuple(np.concatenate([old[~mine], new[keep]]) for old, new in zip(self.best, (query, ids, score), strict=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(column), -1)


def scale_of(size: int, square: float, largest: float) -> tuple[int, float]:
    """Power of two that vectors are divided by, and a bound of their norms after that."""
    if 1e-200 < square < 1e300:
        return 0, float(np.sqrt(square))
    power = int(np.frexp(largest)[1])
    return power, float(np.sqrt(size) * np.ldexp(largest, -power))


def _searching(norm: float, power: int, k: int, factor: float):
    """Rows of a shard come first (``ask`` false), then its queries."""

    def run(batches):
        shard, ids, vectors, tree, asked = None, [], [], None, []

        def answer():
            own, queries, floor = (np.concatenate(x) for x in zip(*asked, strict=True))
            query, near, score = tree.search(queries, own, k, factor, floor)
            asked.clear()
            return pa.RecordBatch.from_arrays([pa.array(own[query]), pa.array(near), pa.array(score)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            shards, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            numbers, matrix = batch.column(2).to_numpy(), np.ldexp(_matrix(batch.column(3)), -power)
            floors = batch.column(4).to_numpy()
            cuts = np.flatnonzero((shards[1:] != shards[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)], strict=True):
                if shards[a] != shard:
                    if asked:
                        yield answer()
                    shard, ids, vectors, tree = shards[a], [], [], None
                if not asks[a]:
                    ids.append(numbers[a:b])
                    vectors.append(matrix[a:b])
                    continue
                if not ids:
                    continue
                tree = tree or Tree(np.concatenate(ids), np.concatenate(vectors), norm)
                for i in range(a, b, BLOCK):
                    part = slice(i, min(i + BLOCK, b))
                    asked.append((numbers[part], matrix[part], floors[part]))
                    if sum(len(x) for x, *_ in asked) >= BLOCK:
                        yield answer()
        if asked:
            yield answer()

    return run


def _measuring(regions: Regions, power: int):
    """Ranges of distances and numbers of rows of all sides of the top tree, summed up per task."""

    def run(batches):
        found: dict[int, tuple[float, float, int]] = {}
        for _, _, _, matrix in _fresh(batches):
            sides: list = []
            regions.region_of(_augmented(np.ldexp(matrix, -power), regions.norm), sides)
            for side, low, high, n in sides:
                old = found.get(side, (np.inf, -np.inf, 0))
                found[side] = (min(old[0], low), max(old[1], high), old[2] + n)
        rows = [(side, float(low), float(high), n) for side, (low, high, n) in found.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("side", "low", "high", "n"), row, strict=True)) for row in rows], schema=_SIDES)

    return run


_SIDES = pa.schema([("side", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("n", pa.int64())])


def _fresh(batches):
    """Batch, numbers of its rows that do not repeat, and their ids and vectors.

    Repeated rows are told by what a task has seen within ``SEEN_BYTES``, so that a hot one neither counts nor fills a shard; a few may come again.
    """
    seen: set = set()
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, matrix, new = batch.column(0).to_numpy(), _matrix(batch.column(1)), []
        if len(seen) * matrix.shape[1] * 8 > SEEN_BYTES:
            seen.clear()
        for i, key in enumerate(zip(ids.tolist(), map(bytes, matrix), strict=True)):
            if key not in seen:
                seen.add(key)
                new.append(i)
        rows = np.array(new, np.int64)
        yield batch, rows, ids[rows], matrix[rows]


def _dealt(shards: np.ndarray, ask: bool, batch: pa.RecordBatch, rows: np.ndarray, floors: np.ndarray) -> pa.RecordBatch:
    taken = batch.take(pa.array(rows))
    columns = [pa.array(shards), pa.array(np.full(len(rows), ask)), taken.column(0), taken.column(1), pa.array(floors)]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "ask", "vec_id", "vector", "floor"])


def _dealing(regions: Regions, power: int):
    """Rows with their shard."""

    def run(batches):
        for batch, rows, ids, matrix in _fresh(batches):
            region = regions.region_of(_augmented(np.ldexp(matrix, -power), regions.norm))
            # id and vector both count, so neither many vectors of an id nor many ids of a vector fill a shard
            mixed = (ids.astype(np.uint64) + matrix.view(np.uint64).sum(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            part = mixed.astype(np.int64) % np.maximum(regions.parts[region], 1)
            yield _dealt(regions.first[region] + part, False, batch, rows, np.zeros(len(rows)))

    return run


def _asking(regions: Regions, power: int, factor: float, others: bool):
    """Queries with each shard they ask: those of their own region, or (``others``) those of all further regions that their floor leaves.

    Queries are stretched to the largest norm, which changes no ranks and brings them nearest to the vectors.
    """

    def run(batches):
        top = regions.norm**2
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                vectors = np.ldexp(_matrix(batch.column(1)), -power)
                most = np.abs(vectors).max(1)
                units = vectors / most[:, None]
                stretch = regions.norm / np.sqrt((units**2).sum(1))
                points = np.hstack([units * stretch[:, None], np.zeros((len(units), 1))])
                floors = batch.column(2).to_numpy()
                own = regions.region_of(points)
                who, where = np.arange(len(own)), own
                if others:
                    # products of vanishing queries have lost their digits and rule nothing out
                    square = np.where(most > 1e-200, 2 * top * (1 + 1e-12) - 2 * (floors / most) * stretch, np.inf)
                    who, where = regions.near(points, square, factor)
                    who, where = who[where != own[who]], where[where != own[who]]
                times = regions.parts[where]
                offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                who, shards = np.repeat(who, times), np.repeat(regions.first[where], times) + offset
                for i in range(0, len(who), 16 * BLOCK):
                    part = slice(i, i + 16 * BLOCK)
                    yield _dealt(shards[part], True, batch, who[part], floors[who[part]])

    return run


def top_of(vectors: DataFrame, n: int, size: int, norm: float, power: int, shard: int) -> Regions:
    """The regions of all vectors: grown on a sample, measured on all."""
    regions, most = -(-n // shard), max(min(SAMPLE, SAMPLE_BYTES // (8 * size)), 2)
    sample = np.zeros((0, size))
    if regions > 1:
        picked = vectors.where(F.rand(7) < most / n) if n > most else vectors
        sample = np.ldexp(np.array([r[0] for r in picked.select("vector").limit(2 * most).collect()], np.float64).reshape(-1, size), -power)
    top = Regions(sample, norm, min(regions, max(len(sample) // min(SAMPLED_A_REGION, shard), 1)))
    found = []
    if top.count > 1:
        sides = vectors.mapInArrow(_measuring(top, power), "side long, low double, high double, n long")
        found = sides.groupBy("side").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()
    top.measured({r["side"]: (r["low"], r["high"], r["n"]) for r in found}, n, shard)
    return top


def asked_shards(vectors: DataFrame, top: Regions, power: int, factor: float, others: bool) -> DataFrame:
    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.mapInArrow(_asking(top, power, factor, others), f"shard long, ask boolean, vec_id long, vector {kind}, floor double")


def nearest(rows: DataFrame, every: int = 20, k: int = K, factor: float = FACTOR, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows of each row whose vec_id is divisible by ``every``."""
    vectors = usable(rows)
    components = F.transform("vector", lambda x: x.cast("double"))
    sizes = vectors.groupBy(F.size("vector").alias("size")).agg(
        F.count("*").alias("n"), F.max(F.aggregate(components, F.lit(0.0), lambda s, x: s + x * x)).alias("square"),
        F.max(F.array_max(F.transform(components, F.abs))).alias("largest"))
    main = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if main is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = vectors.where(F.size("vector") == main["size"])
    power, norm = scale_of(main["size"], main["square"], main["largest"])
    top = top_of(vectors, main["n"], main["size"], norm, power, shard)
    kind = vectors.schema["vector"].dataType.simpleString()
    held = vectors.mapInArrow(_dealing(top, power), f"shard long, ask boolean, vec_id long, vector {kind}, floor double")
    asking = vectors.where(F.col("vec_id") % every == 0).distinct()

    def answers(queries: DataFrame, others: bool) -> DataFrame:
        asked = asked_shards(queries, top, power, factor, others)
        parted = held.union(asked).repartition(F.col("shard")).sortWithinPartitions("shard", "ask", "vec_id")
        return parted.mapInArrow(_searching(norm, power, k, factor), "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))

    none = F.lit(float("-inf"))
    found = answers(asking.withColumn("floor", none), False)
    if top.count > 1:
        found = stored(ranked(found).where(F.col("rank") <= k), "near")
        floors = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        further = asking.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", none))
        found = found.select("query_id", "vec_id", "score").union(answers(further, True))
    best = ranked(found).where(F.col("rank") <= k)
    steps = [power] if abs(power) < 1000 else [power // 2, power - power // 2]  # each a double of its own
    for step in 2 * steps:
        best = best.withColumn("score", F.col("score") * F.lit(2.0**step))
    return best.select("query_id", "rank", "vec_id", "score")
