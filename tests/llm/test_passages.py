import hashlib
import random
import re
from collections import Counter

import pytest
from airlake.llm import passages as ps
from airlake.llm.queries import QUERIES
from llm_helpers import SF_SMALL, make_docs


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    windows = Counter(tuple(w[k: k + 35]) for w in words for k in range(len(w) - 34))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if windows[tuple(w[k: k + 35])] > 1:
                gone[k: k + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ps, "SHARD_ROWS", 5)
    rng = random.Random(seed)
    vocabulary = ["a", "b", "cé", "😀", "d.", "the", "of"] if seed else ["a", "b"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 120)))) for i in range(30)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (34, 35, 36, 60, 200)]
    for i in range(30):
        t = rng.choice(base).split()
        a = rng.randint(0, len(t) // 2)
        rows.append((100 + i, f"x{i}\t" + " ".join(t[a:]) + rng.choice(["", "\n\n y", f" z{i} " + rng.choice(base)])))
    rows += [(1, None), (2, ""), (None, "a " * 90), (None, "a " * 36), (7, "p q " * 40), (8, rows[3][1]), (8, rows[3][1])]
    assert got(ps.digests(make_docs(spark, rows))) == brute(rows)


def test_anchors_of_equal_windows_at_all_offsets():
    rng = random.Random(6)
    phrase = [f"p{rng.random()}" for _ in range(10)]
    head, tail = [f"h{k}" for k in range(4200)], [f"t{k}" for k in range(60)]
    lost = 0
    for ahead in range(3960, 4140):
        windows = ps.Windows(ps.pa.array([" ".join(head[:ahead]), " ".join(phrase * 5 + tail)]))
        counts, anchors = Counter(windows.runs.tolist()), windows.anchor_of().tolist()
        repeated = Counter(windows.hashes.tolist())
        lost += sum(repeated[h] > 1 and counts[a] < 2 for h, a in zip(windows.hashes.tolist(), anchors))
    assert lost == 0


def test_edge_tables(spark):
    assert ps.digests(make_docs(spark, [])).count() == 0
    assert got(ps.digests(make_docs(spark, [(1, None)]))) == brute([(1, None)])
    twice = [(1, "w%d " * 50 % tuple(range(50)) + "end"), (2, "begin " + "w%d " * 50 % tuple(range(50)))]
    assert sorted(r.text for r in ps.without_repeats(make_docs(spark, twice)).collect()) == ["begin", "end"]


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op6_passages"](spark, SF_SMALL)) == brute(rows)


def test_empty_rows_make_no_shard_large(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 100_000, 1, 4).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"), "id")
    sizes = sorted(r["count"] for r in rows.withColumn("shard", ps._shard(20)).groupBy("shard").count().collect())
    assert len(sizes) == 20 and sizes[-1] < 2 * sizes[10]
