import hashlib
import zlib

import pytest

from airlake.llm import manifest as M
from llm_helpers import DOCS, SF_SMALL, make_docs

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def climb(hashes):
    """Root of a list of hashes, and each one's siblings as (side, hash)."""
    paths, places, row = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(row) > 1:
        for k, at in enumerate(places):
            if at ^ 1 < len(row):
                paths[k].append(("left" if at % 2 else "right", row[at ^ 1]))
            else:
                paths[k].append(("none", ""))
            places[k] = at // 2
        row = [digest("".join(row[i: i + 2])) for i in range(0, len(row), 2)]
    return row[0], paths


def fold(leaf, path):
    for side, h in path:
        leaf = digest(h + leaf if side == "left" else leaf + h)
    return leaf


def expected(rows):
    """The report's rows for distinct documents, by the plain construction."""
    order = lambda x: (x is not None, x)
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        members = sorted(groups[g], key=lambda r: (order(r["doc_id"]) if r["doc_id"] is not None else (False, 0), leaf_of(r)))
        trees.append((members, *climb([leaf_of(r) for r in members])))
    root, above = climb([t[1] for t in trees])
    out = []
    for (members, subroot, paths), top in zip(trees, above):
        for r, path in zip(members, paths):
            whole = path + top
            odd = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            used = dict(r, n_chars=r["n_chars"] + 1) if odd and r["n_chars"] is not None else r
            folded = fold(leaf_of(used), whole)
            out.append((r["doc_id"], leaf_of(r), subroot, root, digest("".join(h for _, h in whole)), folded, folded == root))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [1, 1], [5, 1, 300], [257, 2, 1, 1, 64], [1] * 9])
def test_trees_of_many_shapes(spark, sizes):
    rows = [(k * 1000 + i, f"text {k} {i}", f"l{k}" if k else None, "s", i) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, DOCS)
    assert got(M.report(df)) == expected([r.asDict() for r in df.collect()])


def test_edge_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "", "", 0), (2, "é😀" * 40000, "zz", None, None), (2, "other", "zz", "s", 3),
            (-5, "x", "ä", "s", 2**40), (7, "-", "-", "-", 1)]
    df = spark.createDataFrame(rows, DOCS)
    assert got(M.report(df)) == expected([r.asDict() for r in df.collect()])
    assert M.report(make_docs(spark, [])).count() == 0


def test_repeated_rows_prove_themselves(spark):
    """Equal rows are interchangeable leaves: the multiset of results is that of any order."""
    rows = [(4, "same", "en", "s", 4)] * 900 + [(i, "t", "en", "s", 1) for i in range(40, 60)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert got(M.report(df)) == expected([r.asDict() for r in df.collect()])


def test_clashing_columns_do_not_matter(spark):
    from pyspark.sql import functions as F

    df = make_docs(spark, [(i, f"t{i}") for i in range(10)])
    odd = df.withColumns({c: F.lit("x") for c in ("leaf", "tree", "idx", "n", "__group", "__at", "proof", "path")})
    assert got(M.report(odd)) == got(M.report(df))


def test_shuffled_joins_give_the_same_proofs(spark, monkeypatch):
    """Beyond the proven bounds nothing is broadcast."""
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    here = got(M.report(df))
    monkeypatch.setattr(M, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(M, "BROADCAST_GROUPS", 0)
    assert got(M.report(df)) == here


def test_query_against_the_plain_construction(spark):
    from airlake.llm.queries import QUERIES

    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*FIELDS)
    want = expected([r.asDict() for r in df.collect()])
    assert got(QUERIES["op11_manifest"](spark, SF_SMALL)) == want
    assert {r[-1] for r in want} == {True, False}
