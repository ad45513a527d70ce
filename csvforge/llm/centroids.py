"""Operator 11: centroid clustering with a pivot table (LAESA).

Vectors become integers, so every distance and every centroid is exact and no result
depends on the order of a sum.  The distances of all vectors to a few fixed pivots are
computed once and stored next to the vectors.  In a round the centroids' distances to
the pivots are known, and by the triangle inequality ``|d(v, p) - d(c, p)|`` bounds
``d(v, c)`` from below for every pivot ``p``; only centroids whose bound does not exceed
the best exact distance so far get an exact integer distance.  Bounds are floats with a
margin above their rounding error, so they never drop the nearest centroid.

Scale: a round is one narrow scan of the stored table.  Tasks return one row of sums
per cluster, so at most tasks x centroids rows are shuffled, whatever a cluster holds.
The driver sees the centroids only (``k`` rows).

Kept are vectors of exactly ``dims`` components, none null or non-finite; all other
rows (null or empty vectors too) are left out.  Repeated rows are vectors of their own;
a repeated id starts a centroid for each of its rows, in the order of their components;
a null id is clustered but starts none.  Equal distances go to the smaller centroid
number.  Fewer vectors than centroids: as many centroids as there are vectors with an
id.  An empty table gives an empty result.  Other columns are not read.  Components
beyond 2^27 after scaling stop the job, because distances would not fit a long.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import Workspace, prepare, table, with_fields

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2                      # of the hash that orders the start vectors
PIVOTS = 12
REACH = 1 << 27               # largest magnitude of a component
MARGIN = 1e-6                 # above the rounding error of float distances up to 2**31
ROWS = 4096                   # vectors a task works on at a time


def integer_vectors(df: DataFrame, vec: str = "embedding", key: str = "vec_id", dims: int = DIMS,
                    scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` of the kept vectors, ``v`` an array of integers."""
    x = F.transform(F.col(vec), lambda e: e.cast("double"))
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    big = F.raise_error(F.concat(F.lit("a component is too large in vector "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    floor = F.transform(x, lambda e: F.when(F.abs(e * scale) <= REACH, F.floor(e * scale).cast("int")).otherwise(big.cast("int")))
    return df.where((F.size(vec) == dims) & whole).select(F.col(key).alias("vec_id"), floor.alias("v"))


def start_vectors(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors whose ids have the smallest hashes, in their order (a top-k; at most k rows)."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where(F.col("vec_id").isNotNull()).select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return [list(r.v) for r in rows]


def choose_pivots(start: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Start vectors that lie far apart: each next one maximizes its distance to those chosen."""
    chosen, far = [0], squares(start, start[0])
    while len(chosen) < min(n, len(start)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squares(start, start[chosen[-1]]))
    return start[chosen]


def squares(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` to ``c``."""
    d = v - c
    return (d * d).sum(axis=1)


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squares(v, p) for p in pivots], axis=1).astype(np.float64))


def nearest(v: np.ndarray, near: np.ndarray, cents: np.ndarray, cnear: np.ndarray):
    """``(centroid, squared distance, exact distances computed)`` of every row of ``v``;
    ``near`` and ``cnear`` are the pivot distances of the vectors and the centroids."""
    bound = np.zeros((len(v), len(cents)))
    for p in range(near.shape[1]):
        np.maximum(bound, np.abs(near[:, p, None] - cnear[None, :, p]), out=bound)
    who = bound.argmin(axis=1)
    d = v - cents[who]
    best = (d * d).sum(axis=1)
    n, first = len(v), who.copy()
    for j in range(len(cents)):
        rows = np.flatnonzero((bound[:, j] <= np.sqrt(best.astype(np.float64)) + MARGIN) & (first != j))
        exact = squares(v[rows], cents[j])
        n += len(rows)
        won = (exact < best[rows]) | ((exact == best[rows]) & (j < who[rows]))
        who[rows[won]], best[rows[won]] = j, exact[won]
    return who, best, n


def _matrix(col, width: int, kind) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _parts(batches):
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def pivot_table(vectors: DataFrame, pivots: np.ndarray, dims: int = DIMS) -> DataFrame:
    """``(vec_id, v, near)``: the vectors with their distances to the pivots."""
    def run(batches):
        for b in _parts(batches):
            near = pivot_distances(_matrix(b.column(1), dims, np.int64), pivots)
            off = np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(off, near.ravel())],
                                             names=["vec_id", "v", "near"])

    return vectors.mapInArrow(run, with_fields(vectors.schema, ("near", ArrayType(DoubleType()))))


def _move(stored: DataFrame, cents: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Centroids after one round: exact floor of the mean, empty ones stay."""
    k, dims = cents.shape
    cnear = pivot_distances(cents, pivots)

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in _parts(batches):
            v = _matrix(b.column(1), dims, np.int64)
            who, _, _ = nearest(v, _matrix(b.column(2), len(pivots), np.float64), cents, cnear)
            n += np.bincount(who, minlength=k)
            np.add.at(total, who, v)
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(n[full])]
                                         + [pa.array(total[full, i]) for i in range(dims)], names=names)

    names = ["cluster", "n"] + [f"s{i}" for i in range(dims)]
    sums = stored.mapInArrow(run, "cluster int, " + ", ".join(f"{c} long" for c in names[1:]))
    out = cents.copy()
    for r in sums.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in names[1:]]).collect():
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
    return out


def assigned(stored: DataFrame, cents: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector of the pivot table."""
    cnear, dims = pivot_distances(cents, pivots), cents.shape[1]

    def run(batches):
        for b in _parts(batches):
            who, best, _ = nearest(_matrix(b.column(1), dims, np.int64), _matrix(b.column(2), len(pivots), np.float64),
                                   cents, cnear)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(who, pa.int32()), pa.array(best, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return stored.mapInArrow(run, with_fields(stored.select("vec_id").schema, ("cluster", "integer"), ("distance", "long")))


def cluster_vectors(df: DataFrame, vec: str = "embedding", key: str = "vec_id", dims: int = DIMS, k: int = CENTROIDS,
                    rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED, pivots: int = PIVOTS):
    """``(clusters, centroids)``: ``(vec_id, cluster, distance)`` per kept vector, a written
    table, and the final centroids as a matrix of integers (None without any vector)."""
    spark = df.sparkSession
    prepare(spark)
    ws = Workspace(spark, "centroids")
    vectors = integer_vectors(df, vec, key, dims, scale)
    start = start_vectors(vectors, k, seed)
    if not start:
        none = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none.where(F.lit(False)), None
    cents = np.asarray(start, dtype=np.int64)
    fixed = choose_pivots(cents, pivots)
    stored = ws.stage(pivot_table(vectors, fixed, dims), "pivots")
    for _ in range(rounds):
        cents = _move(stored, cents, fixed)
    return ws.finish(assigned(stored, cents, fixed)), cents


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cents = cluster_vectors(table(spark, sf_dir, "embeddings"))
    if cents is None:
        return rows.select("*", *[F.lit(0).cast("long").alias(c) for c in ("cluster_inertia", "inertia")],
                           F.lit("").alias("centroid_sha256"))
    sums = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}        # one row per centroid
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents.tolist()]
    per = spark.createDataFrame([(j, s, sum(sums.values()), digest[j]) for j, s in sorted(sums.items())],
                                "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")     # at most 40 rows are sent


def _sql() -> str:
    square = "CAST(list_sum(list_transform(list_zip(e.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [f"""e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, v FROM (SELECT vec_id,
  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))""",
             f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS k, v FROM
  (SELECT sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM e WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {CENTROIDS}))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, b.k AS k, b.d AS d FROM (SELECT rid, min(struct_pack(d := {square}, k := c.k)) AS b
  FROM e CROSS JOIN c{r} c GROUP BY rid))""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN
  (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM
    (SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range({DIMS})) AS i FROM a{r} JOIN e USING (rid))
     GROUP BY k, i) GROUP BY k) m USING (k))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN e USING (rid) JOIN c{ROUNDS} c USING (k)"""


QUERIES = {"op11_centroid_clustering": op11_centroid_clustering}
SQL = {"op11_centroid_clustering": _sql()}
