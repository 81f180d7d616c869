"""Centroid clustering of integer vectors with an incremental distance matrix.

Every vector keeps its exact integer inner product with every centroid.  When a
round moves the centroids, a product changes only by the components that moved:
``dot += sum(change[c] * x[c])`` over the nonzero changes.  The nearest centroid
follows from ``|x|**2 - 2 * dot + |centroid|**2``.

A round is two passes over a written table of (vector, products, cluster): one
sums components per cluster (partial sums in the map tasks, one row a cluster
after the shuffle), one updates the products row by row without a shuffle.  Only
the centroids, a fixed number of rows, pass through the driver; a hot cluster
or a vector repeated millions of times costs its partial sums alone.  A
round's table is deleted once the next one is written.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm import vectors
from riskweave.llm.common import Rounds, importable

CLUSTERS, DIMS, FACTOR, ROUNDS, SEED = 16, 64, 64, 3, "1"

RESULT = ("cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def nearest(square: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid; the smaller number of equals."""
    far = square[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)[None, :]
    number = far.argmin(axis=1)
    return number, far[np.arange(len(far)), number]


def moved(x: np.ndarray, dots: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The products after the centroids changed, from the nonzero changes only."""
    dots = dots.copy()
    for k in np.flatnonzero(change.any(axis=1)):
        at = np.flatnonzero(change[k])
        dots[:, k] += vectors.products(x[:, at], change[k][None, at])[:, 0]
    return dots


def _state(x, dots, number, distance, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, vectors.lists(x, pa.int32()), vectors.lists(dots, pa.int64()),
         pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["id", "x", "dots", "cluster", "distance"])


def _first(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, dims: int, factor: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = vectors.scaled(b.column("vector"), dims, factor)
        dots = vectors.products(x, centroids)
        yield _state(x, dots, *nearest((x * x).sum(axis=1), dots, centroids), b.column("id"))


def _next(batches: Iterator[pa.RecordBatch], change: np.ndarray, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    clusters, dims = centroids.shape
    for b in batches:
        x = vectors.matrix(b.column("x"), dims)
        dots = moved(x, vectors.matrix(b.column("dots"), clusters), change)
        yield _state(x, dots, *nearest((x * x).sum(axis=1), dots, centroids), b.column("id"))


def seeds(kept: DataFrame, clusters: int, dims: int, factor: int, seed: str) -> np.ndarray:
    """The vectors of smallest sha256 of ``<seed>:<id>``, in that order; rows of
    one id follow in the order of their components, rows without an id last."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = (kept.select(mark.alias("mark"), F.transform("vector", lambda x: x.cast("double")).alias("vector"))
            .orderBy(F.asc_nulls_last("mark"), F.asc("vector")).limit(clusters).collect())
    if not rows:
        return np.zeros((0, dims), np.int64)
    return vectors.scaled(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), dims, factor)


def averaged(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster; empty clusters stay."""
    sums = [F.sum(F.col("x")[c]).alias(f"s{c}") for c in range(centroids.shape[1])]
    out = centroids.copy()
    for r in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[r["cluster"]] = [r[f"s{c}"] // r["n"] for c in range(centroids.shape[1])]
    return out


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def cluster(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
            dims: int = DIMS, factor: int = FACTOR, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A null vector, one of another length and one with a null or non-finite
    component is left out; a row without an id is clustered like any other but
    seeds come after rows with an id.  Repeated rows are vectors of their own;
    equal distances go to the smaller number; fewer vectors than ``clusters``
    give as many clusters; other columns are ignored; an empty table gives an
    empty result.  Components beyond ``vectors.MAX_COMPONENT`` after scaling are
    an error, as their products would not be exact.
    """
    importable(rows.sparkSession)
    kept = rows.where(vectors.whole(vector_col, dims)).select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = kept.schema["id"].dataType
    centroids = seeds(kept, clusters, dims, factor, seed)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], T.StructType([T.StructField(id_col, kind), *T.StructType.fromDDL(RESULT)]))
    schema = T.StructType([T.StructField("id", kind), *T.StructType.fromDDL(
        "x array<int>, dots array<long>, cluster int, distance long")])
    tables = Rounds(rows.sparkSession, "centroids")
    state = tables.write(kept.mapInArrow(functools.partial(_first, centroids=centroids, dims=dims, factor=factor), schema))
    for _ in range(rounds):
        before, centroids = centroids, averaged(state, centroids)
        state = tables.write(state.mapInArrow(
            functools.partial(_next, change=centroids - before, centroids=centroids), schema))
    inertia = {r["cluster"]: r["s"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    of = lambda values: F.create_map(*[F.lit(v) for k in inertia for v in (k, values(k))])[F.col("cluster")]
    return state.select(F.col("id").alias(id_col), "cluster", "distance",
                        of(inertia.get).cast("long").alias("cluster_inertia"),
                        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
                        of(lambda k: digest(centroids[k])).alias("centroid_sha256"))


def cluster_sql(clusters: int = CLUSTERS, dims: int = DIMS, factor: int = FACTOR, rounds: int = ROUNDS,
                seed: str = SEED) -> str:
    """DuckDB twin: every distance anew, components as rows (p, x)."""
    steps = [f"""parts AS (SELECT rid, vec_id, unnest(embedding)::DOUBLE AS raw, generate_subscripts(embedding, 1) AS p
  FROM (SELECT row_number() OVER () AS rid, * FROM embeddings WHERE len(embedding) = {dims})),
ok AS (SELECT rid, vec_id, sha256('{seed}:' || vec_id) AS mark FROM parts GROUP BY rid, vec_id HAVING count(raw) = {dims} AND bool_and(isfinite(raw))),
v AS (SELECT rid, p, floor({factor} * raw)::BIGINT AS x FROM parts SEMI JOIN ok USING (rid)),
c0 AS (SELECT k, p, x FROM v JOIN (SELECT rid, row_number() OVER (ORDER BY mark) - 1 AS k FROM ok QUALIFY k < {clusters}) USING (rid))"""]
    assign = """d{n} AS (SELECT rid, k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{n} c USING (p) GROUP BY rid, k),
a{n} AS (SELECT rid, k, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)"""
    for n in range(rounds):
        steps.append(assign.format(n=n))
        steps.append(f"""m{n} AS (SELECT k, p, sum(x) AS s, count(*) AS n FROM v JOIN a{n} USING (rid) GROUP BY k, p),
c{n + 1} AS (SELECT c.k, c.p, CASE WHEN m.n IS NULL THEN c.x ELSE ((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT END AS x
  FROM c{n} c LEFT JOIN m{n} m ON m.k = c.k AND m.p = c.p)""")
    steps.append(assign.format(n=rounds))
    return f"""WITH {", ".join(steps)}
SELECT ok.vec_id, k::INTEGER AS cluster, d::BIGINT AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, h.centroid_sha256
FROM a{rounds} JOIN ok USING (rid)
JOIN (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY k) h USING (k)"""
