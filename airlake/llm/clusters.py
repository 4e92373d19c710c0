"""Centroid clustering of vectors; nearest centroids by the threshold algorithm.

Components x become integers floor(256 x), so every distance, sum and mean is exact and no result
depends on the order of the rows. ``cluster`` runs a fixed number of rounds: each vector goes to its
nearest centroid (squared Euclidean distance, ties to the smaller number), then each non-empty
centroid becomes the floor of the mean of its vectors; in the end vectors are assigned once more.

The nearest centroid is found by the threshold algorithm. For every dimension the centroids are
sorted by their value there. From a vector's value the lists are walked outward, one centroid a step
and dimension, the nearer side first; each centroid met is measured exactly. What a centroid not yet
met must at least be away is the sum over dimensions of the squared distance of the next one in each
list, the frontier. A vector stops when that sum strictly exceeds its best exact distance (at
equality a centroid of a smaller number could still tie), or when it has met all centroids.

Tasks hold one block of vectors, the centroids (k x dimension numbers) and their sums; a round sends
k x dimension sums of each task to the aggregation and as many numbers to the driver.

Edge cases: vectors that are null, have another length or a component that is null or not finite are
left out; repeated rows count each; rows of one id are told apart by their vector among the first
centroids; a null id never gives a first centroid but is assigned; fewer vectors than ``k`` give
fewer centroids; an empty table gives no rows. A component of 2**19 or more in size would not leave
the squared distance within 64 bits and is an error. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.tables import bound_arrow, saved, tidy

#: Parameters of the registered query.
CENTROIDS, ROUNDS, SCALE, SEED = 40, 5, 256.0, "2:"
#: Vectors walked at a time.
BLOCK = 2048
#: Bound on the size of an integer component; differences are below 2**28.
_LARGEST = 1 << 27
_FAR = np.int64(1 << 28)


def integers(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the vectors kept, their integer components)."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(lengths == dimension)
    values = column.take(pa.array(places)).flatten()
    floats = values.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dimension)    # null: NaN
    whole = np.isfinite(floats).all(axis=1)
    scaled = np.floor(SCALE * floats[whole])
    if scaled.size and np.abs(scaled).max() >= _LARGEST:
        raise ValueError(f"a vector component is {_LARGEST / SCALE:.0f} or more in size; squared distances would not be exact")
    return places[whole], scaled.astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid, by the threshold algorithm."""
    number = np.empty(len(vectors), np.int64)
    distance = np.empty(len(vectors), np.int64)
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    for at in range(0, len(vectors), BLOCK):
        part = slice(at, at + BLOCK)
        number[part], distance[part] = _walk(vectors[part], centroids, order, lists)
    return number, distance


def _walk(x: np.ndarray, centroids: np.ndarray, order: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, dimension = centroids.shape
    dims = np.arange(dimension)
    right = np.stack([np.searchsorted(lists[:, j], x[:, j]) for j in dims], axis=1)     # next list place above
    left = right - 1                                                                     # and below
    never = np.iinfo(np.int64).max
    measured = np.full((len(x), k), never)                # exact distances of the centroids met
    number, best = np.zeros(len(x), np.int64), np.full(len(x), never)
    open_rows = np.arange(len(x))
    for _ in range(k):
        here = x[open_rows]
        below = np.where(left >= 0, here - lists[np.maximum(left, 0), dims], _FAR)
        above = np.where(right < k, lists[np.minimum(right, k - 1), dims] - here, _FAR)
        frontier = (np.minimum(below, above) ** 2).sum(axis=1)
        go_on = (frontier <= best[open_rows]) & (measured[open_rows] == never).any(axis=1)
        if not go_on.any():
            break
        open_rows, left, right, below, above = open_rows[go_on], left[go_on], right[go_on], below[go_on], above[go_on]
        down = below <= above
        met = np.where(down, order[np.maximum(left, 0), dims], order[np.minimum(right, k - 1), dims])
        left, right = left - down, right + ~down
        new = np.zeros((len(open_rows), k), bool)
        new[np.arange(len(open_rows))[:, None], met] = True
        rows, which = np.nonzero(new & (measured[open_rows] == never))
        rows = open_rows[rows]
        measured[rows, which] = ((x[rows] - centroids[which]) ** 2).sum(axis=1)
        number[open_rows] = measured[open_rows].argmin(axis=1)                           # the first of equals
        best[open_rows] = measured[open_rows, number[open_rows]]
    return number, best


def _sums(vectors: DataFrame, column: str, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number and component sums of the vectors of each centroid."""
    k, dimension = centroids.shape

    def run(batches):
        # a task's sums stay within 64 bits for 2**36 vectors
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimension), np.int64)
        for batch in batches:
            _, x = integers(batch.column(column), dimension)
            which, _ = nearest(x, centroids)
            counts += np.bincount(which, minlength=k)
            np.add.at(sums, which, x)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(full, dimension)), pa.array(np.tile(np.arange(dimension), len(full))), pa.array(np.repeat(counts[full], dimension)), pa.array(sums[full].ravel())],
            names=["cluster", "dim", "n", "total"])

    parts = vectors.select(column).mapInArrow(tidy(run), "cluster long, dim long, n long, total long")
    whole = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in whole.orderBy("cluster", "dim").collect():                                  # k x dimension rows
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    return out


def first_centroids(vectors: DataFrame, id: str, column: str, dimension: int, k: int, seed: str) -> np.ndarray:
    """The ``k`` kept vectors whose ``seed`` and decimal id have the smallest sha256, in that order."""
    def run(batches):
        for batch in batches:
            places, x = integers(batch.column(column), dimension)
            flat = pa.array(x.astype(np.int32).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(id).take(pa.array(places)), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * dimension, flat)], names=["id", "x"])

    kept = vectors.select(id, column).mapInArrow(tidy(run), f"id {vectors.schema[id].dataType.simpleString()}, x array<int>")
    hashed = kept.where("id is not null").select(F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256).alias("hash"), "x")
    return np.array([r["x"] for r in hashed.orderBy("hash", "x").limit(k).collect()], np.int64).reshape(-1, dimension)


def cluster(vectors: DataFrame, dimension: int, id: str = "vec_id", column: str = "embedding", k: int = CENTROIDS,
            rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """(``id``, ``cluster``, ``distance``) of every kept vector, saved, and the final centroids."""
    bound_arrow(vectors.sparkSession)
    centroids = first_centroids(vectors, id, column, dimension, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        for number, (n, sums) in _sums(vectors, column, centroids).items():
            centroids[number] = [s // n for s in sums]                                   # floor, also below zero
    final = centroids.copy()

    def run(batches):
        for batch in batches:
            places, x = integers(batch.column(column), dimension)
            if not len(final):
                places, x = places[:0], x[:0]                                            # nothing to be near to
                which, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
            else:
                which, far = nearest(x, final)
            yield pa.RecordBatch.from_arrays([batch.column(id).take(pa.array(places)), pa.array(which.astype(np.int32)), pa.array(far)], names=[id, "cluster", "distance"])

    schema = f"`{id}` {vectors.schema[id].dataType.simpleString()}, cluster int, distance long"
    return saved(vectors.select(id, column).mapInArrow(tidy(run), schema)), final


def report(vectors: DataFrame, dimension: int, **options) -> DataFrame:
    """Every kept vector with its cluster, distance, the inertia of its cluster and of all, and the
    digest of its centroid."""
    assigned, centroids = cluster(vectors, dimension, **options)
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()   # at most k rows
    total = int(sum(r["s"] for r in sums))
    digests = {c: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for c, x in enumerate(centroids.tolist())}
    table = assigned.sparkSession.createDataFrame([(r["cluster"], int(r["s"]), total, digests[r["cluster"]]) for r in sums],
                                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(assigned.columns[0], "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(dimension: int) -> str:
    """The same result in DuckDB SQL, over ``embeddings``, by comparing every vector with every centroid."""
    square = "list_sum(list_transform(list_zip(k.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    steps = [f"""kept as materialized (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor({SCALE}::double * x::double)::bigint) as q
  from embeddings where len(embedding) = {dimension} and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x::double)))),
c0 as materialized (select row_number() over (order by sha256('{SEED}' || vec_id), q) - 1 as c, q from kept where vec_id is not null qualify c < {CENTROIDS})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} as materialized (select rid, min(struct_pack(d := {square}, c := c.c)) as near from kept k, c{r} c group by rid)")
        if r < ROUNDS:
            steps.append(f"""m{r} as (
  select c, list((s - ((s % n) + n) % n) // n order by dim)::bigint[] as q from (
    select near.c as c, dim, sum(q[dim])::hugeint as s, count(*) as n from a{r} join kept using (rid), range(1, {dimension + 1}) t(dim) group by near.c, dim) group by c),
c{r + 1} as materialized (select o.c, coalesce(m.q, o.q) as q from c{r} o left join m{r} m on m.c = o.c)""")
    return "with " + ",\n".join(steps) + f"""
select vec_id, near.c::int as cluster, near.d as distance, sum(near.d) over (partition by near.c)::bigint as cluster_inertia,
  sum(near.d) over ()::bigint as inertia, sha256(array_to_string(c{ROUNDS}.q, ',')) as centroid_sha256
from a{ROUNDS} join kept using (rid) join c{ROUNDS} on c{ROUNDS}.c = near.c"""
