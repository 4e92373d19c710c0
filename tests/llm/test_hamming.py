import numpy as np
import pytest
from airlake.llm import hamming as hm
from airlake.llm.queries import QUERIES
from llm_helpers import SF_SMALL


def brute(index, queries, k, exclude_self=True):
    out = set()
    for q, c in queries:
        rows = sorted({((c ^ d) & (2 ** 64 - 1)).bit_count() * 10 ** 9 + i for i, d in index if not exclude_self or i != q})[:k]
        out |= {(q, r % 10 ** 9, r // 10 ** 9, n + 1) for n, r in enumerate(rows)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, code long")


@pytest.mark.parametrize("k,self_", [(3, True), (10, False)])
def test_search_against_brute_force(spark, monkeypatch, k, self_):
    monkeypatch.setattr(hm, "BLOCK", 17)
    rng = np.random.default_rng(k)
    base = rng.integers(-2 ** 63, 2 ** 63 - 1, 12)
    rows = []
    for i in range(260):                                       # clusters at several distances, ties, and copies
        flips = rng.choice(64, rng.integers(0, 14), replace=False)
        code = int(base[i % 12]) & (2 ** 64 - 1)
        for b in flips:
            code ^= 1 << int(b)
        rows.append((i, code - 2 ** 64 if code >= 2 ** 63 else code))
    rows += [(300 + i, rows[0][1]) for i in range(40)]
    queries = rows[::9]
    got = {tuple(r) for r in hm.search(frame(spark, rows), frame(spark, queries), k, self_).collect()}
    assert got == brute(rows, queries, k, self_)


def test_probes_meet_what_comparing_meets():
    rng = np.random.default_rng(0)
    index = hm.Segments(rng.integers(0, 2 ** 64, 400, dtype=np.uint64) & np.uint64(0x0F0F0F0F0F0F0F0F))
    for radius in (0, 1, 2):
        for code in index.codes[:20]:
            want = np.flatnonzero(np.any([np.bitwise_count(index.cut(index.codes, k) ^ index.cut(code, k)) == radius for k in range(hm.SEGMENTS)], axis=0))
            assert index.at(code, radius, hm.masks(radius)).tolist() == want.tolist()


def test_edge_tables(spark):
    assert hm.search(frame(spark, []), frame(spark, [(1, 5)])).count() == 0
    assert hm.search(frame(spark, [(1, 5)]), frame(spark, [])).count() == 0
    assert [tuple(r) for r in hm.search(frame(spark, [(1, 5), (2, 4), (2, 4)]), frame(spark, [(1, 5)])).collect()] == [(1, 2, 1, 1)]
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (None, [1.0, 2.0]), (3, [1.0]), (4, [None, 1.0]), (5, [2.0, 4.0])], "vec_id long, embedding array<float>")
    got = hm.top_k(vectors.selectExpr("*", "1 AS code", "2 AS id"), vectors, 2)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5, 0, 1), (5, 1, 0, 1)]


def test_query_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [tuple(r) for r in hm.codes(table, 64).collect()]
    x = {r.vec_id: np.array(r.embedding, float) @ np.random.default_rng(3).standard_normal((64, 64)) > 0 for r in table.collect()}
    assert all([(c >> (63 - b)) & 1 for b in range(64)] == x[i].astype(int).tolist() for i, c in rows)
    got = {tuple(r) for r in QUERIES["op9_hamming"](spark, SF_SMALL).collect()}
    assert got == brute(rows, [r for r in rows if r[0] % 100 == 0], hm.TOP)
