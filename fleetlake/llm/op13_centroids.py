"""Exact integer centroid clustering, centroids filtered by n-simplex projection.

Vectors become integers floor(256 x). Pivots are vectors among the first centroids, chosen one by one as
far as possible from the ones before. The distances of a vector to the pivots, computed once and
cached with it, make it the apex of a simplex over the pivots: its coordinates in the space that the
pivots span, and its height above it. Between two apexes, the Euclidean distance with the heights
subtracted is a lower bound of the true distance, with the heights added an upper bound. In each round
the centroids get apexes of their own; a centroid whose lower bound exceeds the smallest upper bound of
the vector can't be nearest and is dropped, and the rest are compared by exact integer distances
(ties: smaller number). Bounds carry a margin far above the rounding of doubles.

Sums and counts per centroid are exact integers, added up in each task and then by Spark; the driver gets
one row of sums per centroid and component. A centroid's components are the floors of their quotients;
an empty centroid stays. The integer vectors and their apexes are written once to the shared folder.

Kept are vectors with exactly ``dimensions`` components, none null or not finite. Null ids count as the
text '' where first centroids are chosen, equal hashes go by components. With fewer kept vectors than
centroids, each is one; an empty table gives an empty result. Repeated rows count each time. Components
beyond 2^27 after scaling are an error, as squared distances would not fit a long. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import cut_lineage, map_arrow, record_batch, slices, table

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
PIVOTS = 16
SCALE = 256
LARGEST = 1 << 27
ROWS = 4096         # vectors compared at a time
MARGIN = 1e-6       # of the squared lengths at hand
FLAT = 0.05         # least height of a pivot over the ones before, as a share of its distance


def integers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<int>) of the kept vectors."""
    x = F.col("embedding").cast("array<double>")
    good = (F.size("embedding") == dimensions) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))

    def whole(e):
        y = F.floor(e * scale)
        return F.when(F.abs(e) <= LARGEST / scale, y.cast("int")).otherwise(
            F.raise_error(F.lit("a vector component is beyond 2^27 after scaling")).cast("int"))
    return vectors.select("vec_id", "embedding").where(F.coalesce(good, F.lit(False))).select("vec_id", F.transform(x, whole).alias("v"))


class Simplex:
    """A base simplex of pivots, in a frame in which pivot k has coordinates in the first k axes only."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots.astype(np.int64)
        b = (pivots[1:] - pivots[0]).astype(np.float64)
        self.base = np.linalg.qr(b.T)[1].T if len(b) else np.zeros((0, 0))  # rows: pivots 1.. ; lower triangular
        self.squares = (self.base ** 2).sum(axis=1)

    @classmethod
    def choose(cls, rows: np.ndarray, most: int) -> "Simplex":
        """Farthest rows first, measured by the height over the span of the chosen ones."""
        rest = (rows - rows[0]).astype(np.float64)
        length = np.sqrt((rest ** 2).sum(axis=1))
        chosen = [0]
        while len(chosen) < most:
            height = np.sqrt((rest ** 2).sum(axis=1))
            k = int(height.argmax())
            if height[k] <= max(FLAT * length[k], 1.0):
                break
            chosen.append(k)
            axis = rest[k] / height[k]
            rest = rest - np.outer(rest @ axis, axis)
            rest[chosen] = 0
        return cls(rows[chosen])

    def apexes(self, v: np.ndarray) -> np.ndarray:
        """Coordinates and, last, height of each row, from its distances to the pivots alone."""
        d = np.stack([((v - p) ** 2).sum(axis=1) for p in self.pivots], axis=1).astype(np.float64)
        right = (d[:, :1] - d[:, 1:] + self.squares) / 2
        x = np.linalg.solve(self.base, right.T).T if len(self.base) else right
        return np.column_stack([x, np.sqrt(np.maximum(d[:, 0] - (x ** 2).sum(axis=1), 0))])


def assign(v: np.ndarray, apex: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row, its squared distance, and the number of exact comparisons."""
    x, h, y, g = apex[:, :-1], apex[:, -1:], tops[:, :-1], tops[:, -1]
    flat = np.maximum((x ** 2).sum(axis=1)[:, None] + (y ** 2).sum(axis=1) - 2 * x @ y.T, 0)
    margin = MARGIN * ((apex ** 2).sum(axis=1)[:, None] + (tops ** 2).sum(axis=1) + 1)
    low, high = flat + (h - g) ** 2 - margin, flat + (h + g) ** 2 + margin
    open_ = low <= high.min(axis=1)[:, None]
    best = np.full(len(v), -1, dtype=np.int32)
    least = np.full(len(v), np.iinfo(np.int64).max, dtype=np.int64)
    for c in range(len(centroids)):
        rows = np.flatnonzero(open_[:, c])
        d = ((v[rows] - centroids[c]) ** 2).sum(axis=1)
        nearer = d < least[rows]
        least[rows[nearer]], best[rows[nearer]] = d[nearer], c
    return best, least, int(open_.sum())


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(kind)


def _project(simplex: Simplex, dimensions: int):
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int32())), ("apex", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, rows=ROWS):
            apex = simplex.apexes(_matrix(b.column("v"), dimensions, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, apex.size + 1, apex.shape[1], dtype=np.int32)), pa.array(apex.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v").cast(schema.field("v").type), lists], schema=schema)
    return run


def _sums(simplex: Simplex, centroids: np.ndarray):
    tops = simplex.apexes(centroids)
    k, width = centroids.shape
    schema = pa.schema([("cluster", pa.int32()), ("part", pa.int32()), ("sum", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, width + 1), dtype=np.int64)  # the last part counts
        for b in slices(batches, rows=ROWS):
            v = _matrix(b.column("v"), width, np.int64)
            best, _, _ = assign(v, _matrix(b.column("apex"), tops.shape[1], np.float64), centroids, tops)
            np.add.at(sums, best, np.column_stack([v, np.ones(len(v), dtype=np.int64)]))
        at = np.flatnonzero(sums[:, -1])
        yield record_batch(schema, cluster=np.repeat(at, width + 1), part=np.tile(np.arange(width + 1), len(at)), sum=sums[at].ravel())
    return run


def _last(simplex: Simplex, centroids: np.ndarray, marks: list[str]):
    tops = simplex.apexes(centroids)
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("centroid_sha256", pa.string()),
                        ("compared", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, rows=ROWS):
            best, least, compared = assign(_matrix(b.column("v"), centroids.shape[1], np.int64),
                                           _matrix(b.column("apex"), tops.shape[1], np.float64), centroids, tops)
            yield record_batch(schema, vec_id=b.column("vec_id"), cluster=best, distance=least,
                               centroid_sha256=[marks[c] for c in best.tolist()], compared=np.full(len(best), compared / len(best)))
    return run


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes, in the order of their hashes."""
    mark = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in vectors.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()], dtype=np.int64)


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, pivots: int = PIVOTS, dimensions: int = DIMENSIONS,
            carry: bool = False) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector; with
    ``carry`` also ``compared``, the mean number of exact comparisons a vector took in its block."""
    kept = integers(vectors, dimensions).select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    centroids = first_centroids(kept, k)
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] + ["compared"] * carry
    if not len(centroids):
        ddl = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, compared double"
        return vectors.sparkSession.createDataFrame([], ddl).select(*names)
    simplex = Simplex.choose(centroids, min(pivots, dimensions + 1))
    cached = cut_lineage(map_arrow(kept, _project(simplex, dimensions), "vec_id long, v array<int>, apex array<double>"))
    for _ in range(rounds):
        found = map_arrow(cached.select("v", "apex"), _sums(simplex, centroids), "cluster int, part int, sum long")
        sums = np.zeros((len(centroids), dimensions + 1), dtype=np.int64)
        for r in found.groupBy("cluster", "part").agg(F.sum("sum").alias("sum")).collect():
            sums[r["cluster"], r["part"]] = r["sum"]
        full = sums[:, -1] > 0
        centroids = np.where(full[:, None], sums[:, :-1] // np.where(full, sums[:, -1], 1)[:, None], centroids)
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    last = cut_lineage(map_arrow(cached, _last(simplex, centroids, marks),
                                 "vec_id long, cluster int, distance long, centroid_sha256 string, compared double"))
    inertia = last.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # one row per centroid: a proven size bound for the window and the broadcast
    inertia = inertia.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0))))
    return last.join(F.broadcast(inertia), "cluster").select(*names)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors of ``embeddings``."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    apart = "list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))"
    sql = [f"""WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY mark, v) - 1 AS c, v
  FROM (SELECT v, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS mark FROM x ORDER BY mark, v LIMIT 40)
)"""]
    for r in range(6):
        sql.append(f"""a{r} AS MATERIALIZED (
  SELECT x.rid, min({{'d': {apart}::BIGINT, 'c': c.c}}) AS best FROM x, c{r} c GROUP BY x.rid
)""")
        if r < 5:
            sql.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT c, list(floor_mean ORDER BY i) AS v FROM (
      SELECT a.best.c AS c, i, (sum(x.v[i])::HUGEINT - ((sum(x.v[i])::HUGEINT % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
      FROM x JOIN a{r} a USING (rid), range(1, 65) t(i) GROUP BY a.best.c, i) GROUP BY c
  ) m ON m.c = c.c
)""")
    return ",\n".join(sql) + """
SELECT x.vec_id, a.best.c::INTEGER AS cluster, a.best.d AS distance,
  (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM x JOIN a5 a USING (rid) JOIN c5 c ON c.c = a.best.c
"""


ORACLE_SQL = _oracle()
