import numpy as np
import pyarrow as pa
from airlake.llm import quality as q
from airlake.llm.queries import QUERIES
from llm_helpers import make_docs
from pyspark.sql import functions as F


def test_trigram_counts_and_frequencies_against_brute_force(spark):
    texts = ["abcabc", "", None, "é x", "ab", "zzzzzz"]

    def one(t):
        out, b = np.zeros(q.BINS), (t or "").encode()
        for k in range(len(b) - 2):
            out[((b[k] << 16 | b[k + 1] << 8 | b[k + 2]) * 2654435761 % 2 ** 32) >> (32 - 11)] += 1
        return np.log1p(out)

    want = np.stack([one(t) for t in texts])
    assert np.allclose(q.trigram_counts(pa.array(texts, pa.string())), want, atol=1e-5)
    seen, n = q.document_frequencies(make_docs(spark, list(enumerate(texts))))
    assert n == len(texts) and (seen == (want > 0).sum(0)).all()


def test_style_shares():
    got = q.style(pa.array(["a a b", "", None, "AB 1!"], pa.string()))
    assert np.allclose(got, [[1 / 3, 1 / 3, 0, 0, 0], [0] * 5, [0] * 5, [0, 0, 2 / 5, 1 / 5, 1 / 5]])


def test_votes_against_brute_force():
    rng = np.random.default_rng(1)
    model = q.Model(np.ones(q.BINS, np.float32), rng.standard_normal((q.BINS + 5, 8)).astype(np.float32), q.unit(rng.standard_normal((40, 8)).astype(np.float32)), rng.integers(0, 2, 40).astype(float))
    texts = pa.array(["".join(rng.choice(list("abcdef "), 50)) for _ in range(20)] + [""])
    x = model.project(texts)
    for vector, got in zip(x, model.vote(texts)):
        cos = model.vectors @ vector
        near = np.argsort(-cos)[: q.NEIGHBOURS]
        w = np.maximum(cos[near], 0).astype(float) ** q.SHARPNESS
        assert abs(got - (w @ model.labels[near] / w.sum() if w.sum() else model.labels.mean())) < 1e-5


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "ab"), (None, "good prose here"), (5, "good prose here"), (5, "good prose here"), (6, "long " * 60_000)]
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, None)], "doc_id long, quality int")
    df = make_docs(spark, rows).withColumn("score", F.lit("old"))
    out = q.score(df, q.fit(df, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.text == "good prose here"}) == 1
    assert q.score(make_docs(spark, []), q.fit(make_docs(spark, []), labels)).count() == 0
    assert [r.score for r in q.score(df, q.fit(df, labels.limit(0))).collect()] == [0.5] * len(rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op7_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out AND quality IS NOT NULL").select("quality", "predicted").collect()
    good, bad = [r for r in rows if r.quality], [r for r in rows if not r.quality]
    assert sum(r.predicted for r in good) >= 0.98 * len(good)
    assert sum(r.predicted for r in bad) <= 0.1 * len(bad)
