"""Centroid clustering by Orchard search (operator 13).

Every centroid has a list of the others, nearest first.  A vector starts at one centroid and walks along its list; where it finds
a closer one it jumps to that one's list, marks what it has visited, and stops at the first entry strictly beyond twice its present
distance, as by the triangle inequality nothing from there on can be closer.  All arithmetic is in exact integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podelta.llm.common import arrow_schema, spark_schema, stage

#: Fixed values of the contract.
PARTS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Components beyond this bound have squared distances beyond a long.
LARGEST = 1 << 26


def integers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(key, v): integer vectors floor(scale * x) of the rows with exactly ``parts`` components, none null or non-finite.

    A component beyond ``LARGEST`` raises an error, since its squared distances need not fit a long.
    """
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.when(F.abs(c * scale) < LARGEST, c * scale).otherwise(
        F.raise_error(F.lit(f"a vector component times {scale} reaches {LARGEST}")).cast("double"))))
    return vectors.where((F.size(vector) == parts) & F.coalesce(sound, F.lit(False))).select(F.col(key).alias("key"), whole.alias("v"))


def first_centroids(kept: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The k vectors with the least hash of ``seed:key``; equal hashes (repeated keys) go by the vector.  Fewer rows give fewer."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    return [list(r.v) for r in kept.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, between): per centroid all centroids by squared distance, itself first, and those distances in that order."""
    between = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    order = np.array([np.lexsort((np.arange(len(row)), row, np.arange(len(row)) != c)) for c, row in enumerate(between)])
    return order, np.take_along_axis(between, order, axis=1)


def search(x: np.ndarray, centroids: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance, distances computed) of each row of x; of equal distances the smaller number wins.

    All rows walk in step: each has its own centroid, place in that centroid's list and marks.
    """
    order, between = lists
    n, k = len(x), len(centroids)
    nearest = np.zeros(n, np.int64)
    best = ((x - centroids[0]) ** 2).sum(axis=1)
    place = np.ones(n, np.int64)
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    walk, computed = np.arange(n), n
    while True:
        walk = walk[place[walk] < k]
        at = nearest[walk]
        # Distances here are squares, so twice the distance is four times the square.
        walk = walk[between[at, place[walk]] <= 4 * best[walk]]
        if not len(walk):
            return nearest, best, computed
        candidate = order[nearest[walk], place[walk]]
        place[walk] += 1
        fresh = ~seen[walk, candidate]
        rows, candidate = walk[fresh], candidate[fresh]
        seen[rows, candidate] = True
        d = ((x[rows] - centroids[candidate]) ** 2).sum(axis=1)
        computed += len(rows)
        closer = (d < best[rows]) | ((d == best[rows]) & (candidate < nearest[rows]))
        rows = rows[closer]
        nearest[rows], best[rows], place[rows] = candidate[closer], d[closer], 1


def _matrix(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("v"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, parts).astype(np.int64)


def assign(kept: DataFrame, centroids: list[list[int]], parts: int = PARTS) -> DataFrame:
    """(key, cluster, distance) of every vector."""
    points = np.array(centroids, np.int64).reshape(-1, parts)
    lists = neighbour_lists(points)
    schema = arrow_schema(kept, "key", cluster=pa.int32(), distance=pa.int64())

    def run(batches):
        for batch in batches:
            nearest, best, _ = search(_matrix(batch, parts), points, lists)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nearest, pa.int32()), pa.array(best, pa.int64())], schema=schema)

    return kept.select("key", "v").mapInArrow(run, spark_schema(schema))


def cluster_sums(kept: DataFrame, centroids: list[list[int]], parts: int = PARTS) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (vectors, exact component sums)}; tasks add up their batches, Spark adds the tasks, at most k rows come back."""
    points = np.array(centroids, np.int64).reshape(-1, parts)
    lists = neighbour_lists(points)

    def run(batches):
        total = {}  # Python integers, so sums are exact whatever a task holds
        for batch in batches:
            x = _matrix(batch, parts)
            nearest, _, _ = search(x, points, lists)
            for c in np.unique(nearest).tolist():
                mine = x[nearest == c]
                n, sums = total.get(c, (0, [0] * parts))
                total[c] = n + len(mine), [a + b for a, b in zip(sums, mine.sum(axis=0).tolist())]
        rows = [(c, p, s, n) for c, (n, sums) in total.items() for p, s in enumerate(sums)]
        if rows:
            yield pa.RecordBatch.from_pydict({"cluster": [r[0] for r in rows], "part": [r[1] for r in rows],
                                              "total": [r[2] for r in rows], "n": [r[3] for r in rows]})

    sums = kept.select("v").mapInArrow(run, "cluster long, part long, total long, n long")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sums.groupBy("cluster", "part").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                 F.sum("n").alias("n")).collect():
        out.setdefault(r.cluster, (r.n, [0] * parts))[1][r.part] = int(r.total)
    return out


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
            parts: int = PARTS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """((key, cluster, distance) of every kept vector, final centroids).

    Vectors that are null, of another length, or hold a null or non-finite component are left out; null keys and repeated rows
    stay.  With fewer than k vectors there are as many centroids; with none the result is empty.  Empty clusters keep their
    centroid.  The driver sees k centroids and their sums only.  Other columns are neither read nor returned.
    """
    kept = stage(integers(vectors, key, vector, parts, scale), "vectors")
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        for c, (n, sums) in cluster_sums(kept, centroids, parts).items():
            centroids[c] = [s // n for s in sums]
    if not centroids:
        return kept.select(F.col("key").alias(key), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    return assign(kept, centroids, parts).withColumnRenamed("key", key), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256; at most k sums pass through the driver."""
    sums = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    by_cluster = F.array(*(F.lit(sums.get(c, 0)).cast("long") for c in range(len(centroids) or 1)))
    by_name = F.array(*(F.lit(n) for n in names or [""]))
    return assigned.select("*", F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
                           F.lit(sum(sums.values())).cast("long").alias("inertia"), F.get(by_name, F.col("cluster")).alias("centroid_sha256"))
