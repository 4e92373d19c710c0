import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airlake.llm import clusters as C
from llm_helpers import SF_SMALL


def plain(vectors, centroids):
    """Every distance; the first of the smallest."""
    d = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for v in vectors]
    return [min(range(len(c)), key=c.__getitem__) for c in d], [min(c) for c in d]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 6).flatmap(lambda dim: st.tuples(
    st.lists(st.lists(st.integers(-4, 4), min_size=dim, max_size=dim), min_size=1, max_size=12),
    st.lists(st.lists(st.integers(-4, 4), min_size=dim, max_size=dim), min_size=1, max_size=9))))
def test_nearest_with_many_ties(case):
    vectors, centroids = case
    which, far = C.nearest(np.array(vectors, np.int64), np.array(centroids, np.int64))
    assert (which.tolist(), far.tolist()) == plain(vectors, centroids)


def test_nearest_in_many_dimensions_and_at_the_bound():
    rng = np.random.default_rng(3)
    v, c = rng.integers(-600, 600, (3000, 64)), rng.integers(-600, 600, (40, 64))
    which, far = C.nearest(v, c)
    d = ((v[:, None, :] - c[None]) ** 2).sum(2)
    assert (which == d.argmin(1)).all() and (far == d.min(1)).all()
    big = (1 << 27) - 1
    which, far = C.nearest(np.full((1, 64), big), np.full((2, 64), -big))
    assert (which.tolist(), far.tolist()) == ([0], [64 * (2 * big) ** 2])


def test_the_walk_stops_early(monkeypatch):
    """On separated centroids a vector meets few of them."""
    c = np.arange(40)[:, None] * np.full((1, 4), 1000)
    met = []
    where = np.nonzero
    monkeypatch.setattr(C.np, "nonzero", lambda x: met.append(int(x.sum())) or where(x))
    C.nearest(c + 3, c)
    assert sum(met) == 40                                  # the nearest alone: a second would be 1000 away in each list


def expected(rows, dimension, k=40, rounds=5):
    kept = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]
    cents = [q for _, q in seeds]
    if not cents:
        return []
    for r in range(rounds + 1):
        which, far = plain([q for _, q in kept], cents)
        if r < rounds:
            for n in set(which):
                mine = [q for (_, q), w in zip(kept, which) if w == n]
                cents[n] = [sum(col) // len(mine) for col in zip(*mine)]
    inertia = {n: sum(f for f, w in zip(far, which) if w == n) for n in set(which)}
    out = [(i, w, f, inertia[w], sum(far), hashlib.sha256(",".join(map(str, cents[w])).encode()).hexdigest()) for (i, _), w, f in zip(kept, which, far)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    rows = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (1, [9.0, 9.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (None, [0.1, 0.1]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [-0.001, 0.0])] + [(i, [i / 7, -i / 3]) for i in range(10, 90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert got(C.report(df, 2)) == expected(rows, 2)
    few = rows[:4] + rows[8:9]
    assert got(C.report(spark.createDataFrame(few, df.schema), 2)) == expected(few, 2)
    assert got(C.report(spark.createDataFrame(rows[3:8], df.schema), 2)) == []
    assert got(C.report(spark.createDataFrame([], df.schema), 2)) == []


def test_a_component_beyond_exact_range_is_an_error():
    column = pa.array([[1.0, 2.0**19]])
    with pytest.raises(ValueError, match="in size"):
        C.integers(column, 2)


def test_query_against_every_pair(spark):
    from airlake.llm.queries import EMBEDDING_DIMENSION, QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(QUERIES["op12_clusters"](spark, SF_SMALL)) == expected(rows, EMBEDDING_DIMENSION)
