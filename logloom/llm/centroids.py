"""Centroid clustering on an incremental distance matrix of exact integers.

Every vector keeps its dot products with the centroids.  Where a centroid moves,
only its components that changed are multiplied and added; with the centroids'
own squared lengths, the argmin over ``|c|^2 - 2 v.c`` is that of the squared
distance, as ``|v|^2`` is the same for all centroids.  All of it is integer
arithmetic, so the kept products never drift from the true ones.

A round is one map over the staged rows (vector, products), which updates,
assigns and writes the next table; the first row of each Arrow batch carries the
batch's sums per cluster, so the new centroids come from that one narrow column.
The driver holds k centroids.  The table before is deleted once the next stands.

Defined results: a vector counts if it has ``dims`` components, none null, NaN
or infinite; others give no row.  Repeated rows stay rows of their own and may
both be start centroids; null ids come last in the choice of those, equal
hashes go by components.  With fewer than k vectors each is a centroid; an
empty table gives no rows; further columns are ignored.  A component beyond
``LARGEST`` after scaling is refused with an error, as its distances would not
fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logloom.llm.common import discard, quoted, staged, table

DIMS, K, ROUNDS, SEED = 64, 8, 10, 3
SCALE, LARGEST = 1024, 1 << 27


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, dims: int = DIMS) -> DataFrame:
    """(id, v): the vectors that count, each component x as floor(SCALE * x)."""
    column = F.col(quoted(vector_col)).cast("array<double>")
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    refused = F.raise_error(F.lit("a component is too large for exact distances"))

    def whole(x):
        return F.when(F.abs(x * SCALE) <= LARGEST, F.floor(x * SCALE).cast("int")).otherwise(refused.cast("int"))

    return (rows.filter((F.size(column) == dims) & finite)
            .select(F.col(quoted(id_col)).alias("id"), F.transform(column, whole).alias("v")))


def start_centroids(vectors: DataFrame, dims: int = DIMS, k: int = K, seed: int = SEED) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r.v for r in first], np.int64).reshape(len(first), dims)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    width = values.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * width), pa.array(values.ravel(), kind))


def update(dots: np.ndarray, vectors: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """``dots`` after the centroids moved: only their nonzero component changes are multiplied."""
    out = dots.copy()
    for j, move in enumerate(moves):
        changed = np.flatnonzero(move)
        if len(changed):
            out[:, j] += vectors[:, changed].astype(np.int64) @ move[changed]
    return out


def nearest(dots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The number of the nearest centroid, the smaller of equally near ones."""
    return ((centroids * centroids).sum(1) - 2 * dots).argmin(1)


def batch_sums(vectors: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Per cluster the count and the componentwise sums, in one row of k * (1 + dims)."""
    sums = np.zeros((k, 1 + vectors.shape[1]), np.int64)
    for j in range(k):
        own = vectors[cluster == j]
        sums[j, 0] = len(own)
        sums[j, 1:] = own.sum(0, dtype=np.int64)
    return sums.ravel()


def _round(state: DataFrame, centroids: np.ndarray, moves: np.ndarray) -> DataFrame:
    """Products brought to ``centroids``, clusters assigned anew, sums with each batch's first row."""
    k, dims = centroids.shape
    first = "dots" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column("v"), dims)
            old = np.zeros((len(v), k), np.int64) if first else _matrix(b.column("dots"), k)
            dots = update(old, v, moves)
            cluster = nearest(dots, centroids)
            sums = pa.array([batch_sums(v, cluster, k).tolist()] + [None] * (len(v) - 1), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("v"), _lists(dots, pa.int64()), pa.array(cluster, pa.int32()), sums],
                ["id", "v", "dots", "cluster", "sums"])

    kind = state.schema["id"].dataType.simpleString()
    return state.select("id", "v", *([] if first else ["dots"])).mapInArrow(
        run, f"id {kind}, v array<int>, dots array<bigint>, cluster int, sums array<bigint>")


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Non-empty clusters' componentwise floor(sum / count); empty ones stay."""
    k, dims = centroids.shape
    parts = state.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    sums = np.zeros(k * (1 + dims), np.int64)
    for r in parts.collect():  # k * (1 + dims) rows
        sums[r["at"]] = r["x"]
    sums = sums.reshape(k, 1 + dims)
    return np.where(sums[:, :1] > 0, sums[:, 1:] // np.maximum(sums[:, :1], 1), centroids)


def cluster(rows: DataFrame, id_col: str, vector_col: str, dims: int = DIMS, k: int = K, rounds: int = ROUNDS,
            seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) per vector that counts, staged, and the final centroids.

    When no centroid moves any more the rounds left would change nothing, so
    they are not run.
    """
    state = staged(integer_vectors(rows, id_col, vector_col, dims), "centroid-vectors")
    centroids = start_centroids(state, dims, k, seed)
    if not len(centroids):
        return state.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, dims), np.int64)
    moves = centroids
    for _ in range(rounds):
        before, state = state, staged(_round(state, centroids, moves), "centroid-round")
        discard(before)
        now = _moved(state, centroids)
        moves, centroids = now - centroids, now
        if not moves.any():
            break
    final = staged(_distances(_round(state, centroids, moves), centroids), "centroid-clusters")
    discard(state)
    return final, centroids


def _distances(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = (centroids * centroids).sum(1)
        for b in batches:
            v = _matrix(b.column("v"), dims).astype(np.int64)
            own = np.asarray(b.column("cluster"))
            dots = _matrix(b.column("dots"), k)[np.arange(len(v)), own]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("cluster"), pa.array((v * v).sum(1) - 2 * dots + lengths[own], pa.int64())],
                ["id", "cluster", "distance"])

    kind = assigned.schema["id"].dataType.simpleString()
    return assigned.select("id", "v", "dots", "cluster").mapInArrow(run, f"id {kind}, cluster int, distance long")


def centroid_sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def op11_centroids(spark, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    facts = [(j, inertia.get(j, 0), sum(inertia.values()), centroid_sha256(c)) for j, c in enumerate(centroids)]
    beside = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.withColumnRenamed("id", "vec_id").join(F.broadcast(beside), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The same rounds as chained common table expressions, from all components of all kept vectors."""
    parts = [f"""
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
              FROM embeddings
              WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {DIMS}),
     e AS MATERIALIZED (SELECT r, unnest(generate_series(1, {DIMS})) AS j, unnest(v) AS x FROM kept),
     s AS (SELECT v, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) - 1 AS k FROM kept),
     c0 AS MATERIALIZED (SELECT k, unnest(generate_series(1, {DIMS})) AS j, unnest(v) AS x FROM s WHERE k < {K})"""]
    for n in range(ROUNDS + 1):
        parts.append(f"""
     d{n} AS (SELECT e.r, c{n}.k, sum((e.x - c{n}.x) * (e.x - c{n}.x))::BIGINT AS d FROM e JOIN c{n} USING (j) GROUP BY ALL),
     a{n} AS MATERIALIZED (SELECT r, arg_min(k, d * {K} + k) AS k, min(d) AS d FROM d{n} GROUP BY r)""")
        if n < ROUNDS:
            parts.append(f"""
     m{n} AS (SELECT a.k, e.j, sum(e.x)::BIGINT AS t, count(*) AS n FROM a{n} a JOIN e USING (r) GROUP BY ALL),
     c{n + 1} AS MATERIALIZED (SELECT c.k, c.j, CASE WHEN m.n IS NULL THEN c.x ELSE (m.t - ((m.t % m.n) + m.n) % m.n) // m.n END AS x
                               FROM c{n} c LEFT JOIN m{n} m USING (k, j))""")
    return ",".join(parts) + f""",
     h AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN h USING (k)
"""


ORACLE = _oracle()
