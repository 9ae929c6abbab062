"""Nearest neighbours by inner product through low-dimensional stable projections (operator 9).

Vectors get one more component, sqrt(M^2 - |x|^2) for the largest norm M, so that the largest inner product is the
smallest distance. Distances are then estimated from a few Gaussian (2-stable) projections: the squared projected
distance over the squared distance is chi-square distributed with as many degrees of freedom. A kd-tree over the
projections, fitted on a bounded sample, deals every vector to a leaf.

Each query first searches its own leaf, which bounds the distance of its k-th neighbour. It then visits the leaves
whose box comes nearer than the projected radius at which the chi-square test holds, and in each verifies vectors in
order of projected distance until the test holds for the best k found. A leaf that many vectors share is cut into
blocks, and queries are dealt into groups by their place in the tree, so a task holds one block and one group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small
from provatab.llm.common import written

# Rows the tree is fitted on; vectors in a block, queries in a group; vectors verified in the first step.
SAMPLE, BLOCK, GROUP, STEP = 20_000, 4_096, 1_024, 256


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half = x / 2
    term = total = 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, degrees) < p else (low, mid)
    return high


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (array of double) of the rows that take part, one per id.

    Left out: null ids, null, empty and zero vectors, vectors with null or non-finite components, and vectors of
    another length than most have (the longer one of equally frequent). Of rows that share an id the smallest vector
    counts.
    """
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where(F.col("vec_id").isNotNull())
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0)
    v = v.where(F.coalesce(finite, F.lit(False))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return v.withColumn("_n", F.size("vector"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


class Tree:
    """Halves a sample at the median of its widest dimension until ``depth``; leaf numbers keep neighbours together."""

    def __init__(self, points: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.dims = np.zeros(max(1, (1 << depth) - 1), np.int64)
        self.cuts = np.zeros(len(self.dims))
        groups = {0: points}
        for node in range((1 << depth) - 1):
            own = groups.pop(node)
            if len(own):
                self.dims[node] = d = int(np.argmax(own.max(0) - own.min(0)))
                self.cuts[node] = np.median(own[:, d])
            right = own[:, self.dims[node]] > self.cuts[node]
            groups[2 * node + 1], groups[2 * node + 2] = own[~right], own[right]

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.dims[node]] > self.cuts[node])
        return node - ((1 << self.depth) - 1)


def _dots(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products whose rounding doesn't depend on the place of a row, so equal vectors tie."""
    return (rows * query).sum(axis=1)


def search_block(ids, points, distances, query_id, query, reach, bound, k, chi) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best ``k`` of a block for one query, and no more than the stopping test asks for.

    distances: squared projected distances of the block. reach: squared norm of the query and the largest norm, so
    that reach - 2 * score is the squared distance. bound: squared distance known to hold the k-th neighbour.
    """
    slack = 1e-9 * reach  # distances are differences of larger numbers
    near = np.flatnonzero((distances <= chi * bound + slack) & (ids != query_id))
    seen, scores, step = near[:0], np.zeros(0), STEP
    while len(near):
        if step < len(near):
            order = np.argpartition(distances[near], step)
            rows, near = near[order[:step]], near[order[step:]]
        else:
            rows, near = near, near[:0]
        seen, scores = np.concatenate([seen, rows]), np.concatenate([scores, points[rows] @ query])
        if len(seen) > k:
            # Sums in another order may differ by rounding, so what comes that close stays for the exact scores.
            least = np.partition(scores, -k)[-k]
            kept = scores >= least - slack
            seen, scores = seen[kept], scores[kept]
            bound = min(bound, max(0.0, reach - 2 * least) * (1 + 1e-9))
            near = near[distances[near] <= chi * bound + slack]
        step *= 4
    exact = _dots(points[seen], query)
    order = np.lexsort((ids[seen], -exact))[:k]
    return ids[seen][order], exact[order]


def nearest(vectors: DataFrame, *, every: int = 20, k: int = 20, dims: int = 24, confidence: float = 0.88, seed: int = 7) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row whose id is divisible by ``every`` its ``k``
    nearest of all other rows found, by inner product in double precision, ties to the smaller id.

    A true neighbour is verified with probability ``confidence`` at least. An empty table, or a single usable vector,
    gives no rows.
    """
    spark = vectors.sparkSession
    own = usable(vectors)
    lengths = own.groupBy("_n").agg(F.count(F.lit(1)).alias("rows"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).alias("norm"))
    common = lengths.orderBy(F.desc("rows"), F.desc("_n")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    width, total, largest = common["_n"], common["rows"], common["norm"]
    gauss = np.random.default_rng(seed).standard_normal((width + 1, dims))
    chi = chi_square_quantile(confidence, dims)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column("vector").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)
                extra = np.sqrt(np.maximum(0.0, largest**2 - (x**2).sum(axis=1)))
                p = x @ gauss[:-1] + extra[:, None] * gauss[-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in p], pa.binary())],
                    names=["vec_id", "x", "p"],
                )

    id_cast = own.where(F.col("_n") == width).select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
    projected = written(id_cast.mapInArrow(project, "vec_id long, x binary, p binary"), "vectors")
    sample = projected.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("p").collect()
    points = np.frombuffer(b"".join(bytes(r["p"]) for r in sample), np.float64).reshape(-1, dims)
    depth = max(0, min(math.ceil(math.log2(max(1.0, total / BLOCK))), int(math.log2(max(1, len(points) // 8)))))
    tree = Tree(points, depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch.column("p"), dims)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.leaf(p).astype(np.int32)), pa.array(list(p), pa.list_(pa.float64()))], names=["vec_id", "x", "p", "leaf", "at"])

    dealt = written(projected.mapInArrow(deal, "vec_id long, x binary, p binary, leaf int, at array<double>"), "leaves")
    bounds = [f(F.col("at")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(dims)]
    leaves = sorted(dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), *bounds).collect())  # at most SAMPLE / 8
    numbers = np.array([r["leaf"] for r in leaves])
    low, high = (np.array([[r[f"{n}{i}"] for i in range(dims)] for r in leaves]) for n in ("low", "high"))
    blocks = {r["leaf"]: math.ceil(r["rows"] / BLOCK) for r in leaves}
    size = spark.createDataFrame([(k_, v) for k_, v in blocks.items()], "leaf int, blocks int")
    hashed = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    stored = dealt.join(F.broadcast(size), "leaf").withColumn("block", hashed).select("leaf", "block", "vec_id", "x", "p")

    # Queries near each other in the tree form a group; a place that many share is dealt into more of them.
    above = max(0, depth - math.ceil(math.log2(max(1.0, total / every / GROUP))))
    asked = dealt.where(F.col("vec_id") % every == 0).join(F.broadcast(size), "leaf").withColumn("place", F.shiftright("leaf", above))
    crowd = asked.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    asked = asked.join(F.broadcast(crowd), "place").withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")).cast("int"))
    asked = asked.select("leaf", "vec_id", "x", "p", "place", "part", "blocks", F.lit(float("inf")).alias("bound"))

    found_schema = "query_id long, vec_id long, score double"

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if left.num_rows and right.num_rows:
            ids, x, p = left.column("vec_id").to_numpy(), _matrix(left.column("x"), width), _matrix(left.column("p"), dims)
            queries = zip(right.column("vec_id").to_pylist(), _matrix(right.column("x"), width), _matrix(right.column("p"), dims), right.column("bound").to_pylist(), strict=True)
            lengths_ = (p**2).sum(axis=1)
            for q, query, at, bound in queries:
                reach = float((query**2).sum()) + largest**2
                distances = lengths_ - 2 * (p @ at) + (at**2).sum()
                got, scores = search_block(ids, x, distances, q, query, reach, bound, k, chi)
                out_q.append(np.full(len(got), q))
                out_v.append(got)
                out_s.append(scores)
        flat = [np.concatenate(c) if c else np.zeros(0) for c in (out_q, out_v, out_s)]
        return pa.table([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)), pa.array(flat[2].astype(np.float64))], names=["query_id", "vec_id", "score"])

    key = ["leaf", "block", "place", "part"]

    def meet(visits: DataFrame) -> DataFrame:
        """Queries (with the blocks they visit) against those blocks, a task for each block and group."""
        pairs = broadcast_if_small(visits.select(*key).distinct().toDF(*key), 200_000)
        return stored.join(pairs, ["leaf", "block"]).groupBy(*key).cogroup(visits.groupBy(*key)).applyInArrow(verify, found_schema)

    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # First one block of the query's own leaf: its k-th best bounds the distance that matters.
    home = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    first = meet(written(home.drop("blocks"), "home"))
    kth = first.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("_kth"))
    bounded = written(asked.drop("bound").join(kth, "vec_id", "left"), "queries")

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own_ in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                x, p = _matrix(own_.column("x"), width), _matrix(own_.column("p"), dims)
                kth_ = own_.column("_kth").to_numpy(zero_copy_only=False).astype(float)
                bound = np.where(np.isnan(kth_), np.inf, np.maximum(0.0, (x**2).sum(axis=1) + largest**2 - 2 * kth_) * (1 + 1e-9))
                gap = np.zeros((len(p), len(numbers)))
                for d in range(dims):
                    gap += np.maximum(0.0, np.maximum(low[:, d] - p[:, d : d + 1], p[:, d : d + 1] - high[:, d])) ** 2
                rows, at = np.nonzero(gap <= chi * bound[:, None])
                pick = pa.array(rows)
                columns = {c: own_.column(c).take(pick) for c in ("vec_id", "x", "p", "place", "part")}
                columns["leaf"] = pa.array(numbers[at].astype(np.int32))
                columns["blocks"] = pa.array(np.array([blocks[n] for n in numbers[at].tolist()], np.int32))
                columns["bound"] = pa.array(bound[rows])
                yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    seen = bounded.mapInArrow(visits, "vec_id long, x binary, p binary, place int, part int, leaf int, blocks int, bound double")
    seen = written(seen.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"), "visits")
    ranked = meet(seen).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
