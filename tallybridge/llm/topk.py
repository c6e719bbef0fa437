"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Sent, by_batch, stored

SCALE = 256
SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF_ROWS = 64
# Regions are fitted on a sample: at most so many of them for a vector length, on so many rows each, on so many
# numbers in all, for so many lengths. Rows beyond that are dealt and searched as well, without the bound of a region.
REGIONS = 1024
SAMPLE_ROWS = 32
SAMPLE_NUMBERS = 1 << 22
LENGTHS = 16
LONG = (1 << 63) - 1


class BallTree:
    """Nodes over blocks of rows: each knows the ball around its rows and halves at the median
    of the coordinate that spreads most. ``order`` lists the rows as the leaves hold them."""

    def __init__(self, points: np.ndarray, leaf: int | None = None):
        self.leaf = leaf or LEAF_ROWS
        self.order = np.arange(len(points))
        self.centres, self.radii, self.spans, self.children = [], [], [], []
        if len(points):
            self._grow(points, 0, len(points))

    def _grow(self, points: np.ndarray, lo: int, hi: int) -> int:
        own = points[self.order[lo:hi]]
        node, centre = len(self.centres), own.mean(0)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((own - centre) ** 2).sum(1).max())))
        self.spans.append((lo, hi))
        self.children.append(None)
        if hi - lo > self.leaf:
            middle = (hi - lo) // 2
            axis = np.argmax(own.max(0) - own.min(0)) if own.shape[1] else 0
            split = np.argpartition(own[:, axis], middle) if own.shape[1] else np.arange(hi - lo)
            self.order[lo:hi] = self.order[lo:hi][split]
            self.children[node] = (self._grow(points, lo, lo + middle), self._grow(points, lo + middle, hi))
        return node


def products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Whole inner products of whole-numbered rows: exact in doubles below 2**53, else in
    Python's integers, cut to the range of a long."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) * max(points.shape[1], 1)
    if top < 2**53:
        return (queries @ points.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], object) @ np.array([[int(x) for x in row] for row in points], object).T
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64)


def upper_bound(queries: np.ndarray, norms: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """The largest inner product of each query with anything in each ball, and no less for rounding."""
    reach = np.sqrt((centres**2).sum(1)) + radii
    return queries @ centres.T + norms[:, None] * (radii + 1e-9 * reach) + 1e-6


def search(
    points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, ids, used), all queries x k, best first, of rows with at least the score ``floor``.

    ``floor`` is each query's kth score so far, from other shards; it rises as rows are found.
    Nodes come by the largest inner product their ball allows any query above its kth
    score; a node that allows none is left out with all below it. Ties go to smaller ids,
    rows of the query's own id are left out; ``used`` tells which places are taken.
    """
    tree, m = BallTree(points), len(queries)
    best, found, used = np.zeros((m, k), np.int64), np.zeros((m, k), np.int64), np.zeros((m, k), bool)
    kth = floor.astype(np.float64)
    norms = np.sqrt((queries**2).sum(1))

    def bound(node: int) -> np.ndarray:
        return upper_bound(queries, norms, tree.centres[node][None], np.array([tree.radii[node]]))[:, 0]

    def push(node: int) -> None:
        above = float((bound(node) - kth).max())
        if above >= 0:
            heapq.heappush(heap, (-above, node))

    heap: list[tuple[float, int]] = []
    if len(points) and m:
        push(0)
    while heap:
        _, node = heapq.heappop(heap)
        if tree.children[node]:
            for child in tree.children[node]:
                push(child)
            continue
        active = np.flatnonzero(bound(node) >= kth)
        if not len(active):
            continue
        rows = tree.order[slice(*tree.spans[node])]
        scores, own = products(queries[active], points[rows]), ids[rows]
        fits = (scores >= kth[active, None]) & (own[None, :] != query_ids[active, None])
        hit = np.flatnonzero(fits.any(1))
        if not len(hit):
            continue
        active = active[hit]
        value = np.concatenate([best[active], scores[hit]], 1)
        name = np.concatenate([found[active], np.broadcast_to(own, (len(hit), len(own)))], 1)
        unused = np.concatenate([~used[active], ~fits[hit]], 1)
        # ~x falls as x rises, without the overflow of -x.
        by = np.lexsort((name, ~value, unused), axis=1)[:, :k]
        best[active], found[active] = np.take_along_axis(value, by, 1), np.take_along_axis(name, by, 1)
        used[active] = ~np.take_along_axis(unused, by, 1)
        full = used[active, k - 1]
        kth[active[full]] = np.maximum(kth[active[full]], best[active[full], k - 1])
    return best, found, used


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, k: int) -> DataFrame:
    """(vec_id, vector, dim, times), once for equal rows, with their number up to ``k``; a null id, a null vector and
    one with a null or non-finite component take no part."""
    v = F.col(vector_column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(id_column).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False)))
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("vector"), F.size(v).alias("dim"))
    return rows.groupBy("vec_id", "vector", "dim").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = pa.concat_arrays(chunks).flatten().to_numpy() if chunks else np.empty(0)
    return np.floor(flat * SCALE).reshape(len(column), dim)


def _searched(vectors: DataFrame, queries: DataFrame, by: list[str], k: int) -> DataFrame:
    """(query, query_id, vec_id, score) of the k best rows of each group's vectors for its queries."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = np.empty(0, np.int64)
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": none, "query_id": none, "vec_id": none, "score": none})
        dim = left["dim"][0].as_py()
        copy = np.repeat(np.arange(left.num_rows), left["times"].to_numpy())
        points, ids, names = _matrix(left["vector"], dim)[copy], left["vec_id"].to_numpy()[copy], right["q_query_id"].to_numpy()
        best, found, used = search(points, ids, _matrix(right["q_vector"], dim), names, right["q_floor"].to_numpy(), k)
        row, place = np.nonzero(used)
        return pa.table({"query": right["q_query"].to_numpy()[row], "query_id": names[row], "vec_id": found[row, place], "score": best[row, place]})

    asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    both = vectors.groupBy(*by).cogroup(asked.groupBy(*[f"q_{c}" for c in by]))
    return both.applyInArrow(run, "query long, query_id long, vec_id long, score long")


def region_centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length the centres of its regions: leaves of a ball tree over the sample rows with the smallest hashes.

    Neighbours in the list are neighbours in the tree.
    """
    counts = rows.groupBy("dim").count().filter((F.col("count") > SHARD_ROWS) & (F.col("dim") > 0))
    centres = {}
    for dim, count in counts.orderBy(F.desc("count"), "dim").limit(LENGTHS).collect():
        wanted = min(REGIONS, -(-count // SHARD_ROWS))
        size = min(SAMPLE_ROWS * wanted, SAMPLE_NUMBERS // dim)
        if size < 2:
            continue
        sample = _matrix(rows.filter(F.col("dim") == dim).orderBy("query").limit(size).select("vector").toArrow()["vector"], dim)
        tree = BallTree(sample, leaf=max(1, -(-len(sample) // wanted)))
        leaves = sorted((tree.spans[n][0], n) for n, below in enumerate(tree.children) if below is None)
        centres[dim] = np.array([tree.centres[n] for _, n in leaves])
    return centres


def placed_in_regions(rows: DataFrame, centres: Sent) -> DataFrame:
    """``rows`` with the region whose centre is nearest and the distance from it; 0 and null for a length without regions."""
    names = rows.columns

    def near(batch: pa.RecordBatch):
        dims, vectors = batch.column(names.index("dim")).to_numpy(), batch.column(names.index("vector"))
        region, distance, known = np.zeros(len(dims), np.int32), np.zeros(len(dims)), np.zeros(len(dims), bool)
        for dim in np.unique(dims):
            if int(dim) not in centres.value:
                continue
            at, own = np.flatnonzero(dims == dim), centres.value[int(dim)]
            points = _matrix(vectors.take(pa.array(at)), int(dim))
            region[at] = np.argmin((own**2).sum(1) - 2 * points @ own.T, axis=1)
            distance[at] = np.sqrt(((points - own[region[at]]) ** 2).sum(1))
            known[at] = True
        yield dict(zip(names, batch.columns, strict=True)) | {
            "region": pa.array(region), "distance": pa.array(distance, mask=~known)
        }

    schema = rows.withColumn("region", F.lit(0)).withColumn("distance", F.lit(0.0).cast("double")).schema
    for field in ("region", "distance"):
        schema[field].nullable = True
    return by_batch(rows, schema, near)


def within_reach(asked: DataFrame, balls: Sent) -> DataFrame:
    """``asked`` with the regions whose ball may hold a row above the query's floor; [0] for a length without regions."""
    names = asked.columns

    def reach(batch: pa.RecordBatch):
        dims, vectors = batch.column(names.index("dim")).to_numpy(), batch.column(names.index("vector"))
        floors = batch.column(names.index("floor")).to_numpy().astype(np.float64)
        regions: list = [[0]] * len(dims)
        for dim in np.unique(dims):
            if int(dim) not in balls.value:
                continue
            at, (numbers, centres, radii) = np.flatnonzero(dims == dim), balls.value[int(dim)]
            points = _matrix(vectors.take(pa.array(at)), int(dim))
            reached = upper_bound(points, np.sqrt((points**2).sum(1)), centres, radii) >= floors[at, None]
            for n, row in zip(at, reached, strict=True):
                regions[n] = numbers[row].tolist()
        yield dict(zip(names, batch.columns, strict=True)) | {"regions": pa.array(regions, pa.list_(pa.int32()))}

    return by_batch(asked, asked.withColumn("regions", F.array(F.lit(0))).schema, reach)


def top_k(
    vectors: DataFrame, *, is_query: Column, k: int, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (over vec_id) names, the ``k``
    rows of other ids with the highest inner product of floor(256 * component), all if there
    are fewer; ties go to the smaller id. Repeated rows are a candidate each.

    Rows are dealt into regions by the nearest of up to REGIONS centres, and a region into shards of about SHARD_ROWS
    by a hash of id and vector, so that any number of equal vectors is spread. A query meets the shard it lives in
    first. The kth score found there bounds what comes after: only regions whose ball, which holds all their
    rows, may reach it are searched, and in these only nodes that may. Queries of near regions travel together in
    blocks of about QUERY_ROWS, and a shard's rows go to the blocks that ask for them; a task holds one shard and one block.
    Vectors of another length than the query's are no candidates. A query id with several vectors is
    several queries; equal rows are one.
    """
    rows = whole_vectors(vectors, id_column, vector_column, k)
    rows = stored(rows.withColumn("query", F.xxhash64("vec_id", "vector")), "vectors")
    spark, centres = rows.sparkSession, region_centres(rows)
    placed = stored(placed_in_regions(rows, Sent(spark, centres)), "regions") if centres else (
        rows.withColumn("region", F.lit(0)).withColumn("distance", F.lit(None).cast("double"))
    )
    sizes = placed.groupBy("dim", "region").agg(
        F.count("*").alias("rows"), F.count_if(is_query).alias("queries"), F.max("distance").alias("radius")
    )
    before = F.sum("queries").over(Window.partitionBy("dim").orderBy("region")) - F.col("queries")
    sizes = sizes.select(
        "dim", "region", "radius", F.ceil(F.col("rows") / SHARD_ROWS).alias("shards"),
        F.floor(before / QUERY_ROWS).alias("first_block"), F.greatest(F.ceil(F.col("queries") / QUERY_ROWS), F.lit(1)).alias("blocks"),
    )
    sizes = stored(sizes, "shards")
    # At most REGIONS rows for each of LENGTHS lengths.
    told = sizes.filter("radius is not null").orderBy("dim", "region").select("dim", "region", "radius").collect() if centres else []
    balls = {}
    for dim, own in centres.items():
        numbers = np.array([r.region for r in told if r.dim == dim], np.int32)
        balls[dim] = (numbers, own[numbers], np.array([r.radius for r in told if r.dim == dim]) * (1 + 1e-9))

    placed = placed.drop("distance").join(sizes.drop("radius"), ["dim", "region"]).withColumn("shard", F.pmod("query", "shards"))
    shard = ["dim", "region", "shard"]
    asked = placed.filter(is_query).withColumnRenamed("vec_id", "query_id")
    asked = asked.withColumn("block", F.col("first_block") + F.pmod(F.shiftright("query", 32), F.col("blocks")))
    asked = asked.select("query", "query_id", "vector", "block", *shard)
    placed = placed.select("vec_id", "vector", "times", *shard)
    lowest = F.lit(-LONG - 1).cast("long")
    home = stored(_searched(placed, asked.withColumn("floor", lowest), shard, k), "home-shard")
    kth = home.groupBy("query_id", "query").agg(F.min("score").alias("kth"), F.count("*").alias("found"))
    kth = kth.select("query_id", "query", F.when(F.col("found") >= k, F.col("kth")).otherwise(lowest).alias("floor"))
    floored = asked.join(kth, ["query_id", "query"], "left").withColumn("floor", F.coalesce("floor", lowest))
    away = within_reach(floored, Sent(spark, balls)).withColumnsRenamed({"region": "home_region", "shard": "home_shard"})
    away = away.withColumn("region", F.explode("regions")).drop("regions").join(sizes.select("dim", "region", "shards"), ["dim", "region"])
    away = away.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    away = away.filter("region <> home_region or shard <> home_shard").select("query", "query_id", "vector", "floor", "block", *shard)
    asking = stored(away.select(*shard, "block").distinct(), "asking")
    rest = _searched(placed.join(asking, shard), away, [*shard, "block"], k)
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = home.union(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
