"""Centroid clustering of integer vectors in expressions that stay in the JVM.

Distances to the centroids, which are literal arrays, are ``zip_with`` and ``aggregate``;
``array_min`` of (distance, number) chooses the cluster; sums of the components by cluster,
added up where the rows are, move the centroids. Only as many rows as there are centroids
ever reach the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import require
from ..functions.storage import cut_lineage
from .common import quoted

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 16, 3, 64, 64, 1
# Integers beyond this are taken as this, so that a squared distance fits a long.
LARGEST = 1 << 27


def whole_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """``vec_id, v``: the finite vectors of that width as arrays of ``floor(scale * x)``."""
    require(vectors, id_col, vector_col)
    rows = vectors.select(quoted(id_col).alias("vec_id"), quoted(vector_col).cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bound = float(LARGEST)
    whole = F.transform("e", lambda x: F.floor(F.greatest(F.least(x * float(scale), F.lit(bound)), F.lit(-bound))))
    return rows.filter((F.size("e") == width) & finite).select("vec_id", whole.alias("v"))


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """Struct ``distance, cluster`` of the nearest centroid, the smallest number among equals."""
    zero = F.lit(0).cast("bigint")

    def distance(c: list[int]) -> Column:
        there = F.expr(f"array({', '.join(f'{x}L' for x in c)})")
        return F.aggregate(F.zip_with(v, there, lambda a, b: (a - b) * (a - b)), zero, lambda s, d: s + d)

    return F.array_min(
        F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)])
    )


def first_centroids(whole: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors whose ids have the smallest SHA-256; fewer where there are fewer."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    ranked = whole.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v")
    return [list(r.v) for r in ranked.limit(clusters).collect()]


def moved(whole: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid as the floor of its vectors' mean; one without vectors stays."""
    width = len(centroids[0])
    placed = whole.select(nearest(F.col("v"), centroids).alias("best"), "v").select("best.cluster", "v")
    sums = placed.groupBy("cluster").agg(
        F.count("*").alias("n"), *[F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(width)]
    )
    after = list(centroids)
    for r in sums.collect():
        after[r.cluster] = [r[f"s{i}"] // r.n for i in range(width)]
    return after


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
    rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of the vectors.

    A vector is left out if it is NULL, has another number of components, or one that is NULL
    or not finite. Equal distances go to the smaller number; centroids that are equal leave
    the later ones empty, and an empty one stays where it is. Repeated rows and ids are
    vectors of their own; among first centroids of one id the smaller vector comes first, and
    a NULL id counts as an empty one. With fewer vectors than ``clusters`` each is a first
    centroid. An empty table gives an empty one; other columns are left out. Integers are held
    within 2^27, so distances fit a long; sums that do not are given as the largest long.
    """
    whole = whole_vectors(vectors, id_col, vector_col, width, scale)
    centroids = first_centroids(whole, clusters, seed)
    if not centroids:
        kind = whole.schema["vec_id"].dataType.simpleString()
        schema = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = moved(whole, centroids)
    placed = whole.select("vec_id", nearest(F.col("v"), centroids).alias("best"))
    placed = cut_lineage(placed.select("vec_id", "best.cluster", "best.distance"))
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r.cluster: int(r.t) for r in placed.groupBy("cluster").agg(total.alias("t")).collect()}
    most = (1 << 63) - 1

    def by_cluster(values: list, kind: str) -> Column:
        return F.get(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster"))

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return placed.select(
        "vec_id", "cluster", "distance",
        by_cluster([min(inertia.get(i, 0), most) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), most)).cast("bigint").alias("inertia"),
        by_cluster(digests, "string").alias("centroid_sha256"),
    )


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED) -> str:
    """The same rows in DuckDB's SQL."""
    steps = [f"""
        kept AS (
            SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
        ),
        long AS (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept),
        first AS (
            SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM kept
            QUALIFY c < {clusters}
        ),
        c0 AS (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM first)"""]
    for k in range(rounds + 1):
        steps.append(f"""
        d{k} AS (
            SELECT r, c, sum((l.x - m.x) * (l.x - m.x))::BIGINT AS d FROM long l JOIN c{k} m ON l.i = m.i GROUP BY r, c
        ),
        a{k} AS (SELECT r, c, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if k < rounds:
            steps.append(f"""
        s{k} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM long JOIN a{k} USING (r) GROUP BY c, i),
        c{k + 1} AS (
            SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, x)::BIGINT AS x FROM c{k} LEFT JOIN s{k} USING (c, i)
        )""")
    return f"""
    WITH {",".join(steps)},
        h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
           (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
    FROM a{rounds} JOIN kept USING (r) JOIN h USING (c)
    """
