import hashlib
import re

import corpus_pipeline as cp

from llm_helpers import SF_SMALL
from test_bpe import reference
from test_mixing import brute_targets
from test_neardup import brute_classes
from test_pii import brute


SF = "/root/testdata/sf0.01"                              # the smallest one with enough toxic labels


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs, now = [], docs
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, now, SF).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert now.dtypes == docs.dtypes
        outs.append(now.collect())
    first = {r.doc_id: r for r in docs.collect()}
    clean, single, masked, mixed, tokens = outs

    kept = {r.doc_id for r in clean}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert len(good & kept) >= 0.97 * len(good) and len(toxic & kept) < 0.4 * len(toxic)
    assert all(first[r.doc_id] == r for r in clean)

    groups = dict(brute_classes(sorted((r.doc_id, r.text) for r in clean)))
    assert sorted(r.doc_id for r in single) == sorted(set(groups.values()))
    assert all(first[r.doc_id] == r for r in single)

    text = {r.doc_id: r.text for r in masked}
    assert set(text) == {r.doc_id for r in single}
    for r in single:
        assert not any(spans for spans in brute(text[r.doc_id]).values())
        if not re.search(r"[0-9@]", r.text):
            assert text[r.doc_id] == r.text
    assert all(r.n_chars == len(r.text) for r in masked)

    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in masked}
    sizes = {}
    for r in masked:
        sizes["0" + r.source] = sizes.get("0" + r.source, 0) + words[r.doc_id]
    target, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for r in mixed:
        assert r.text == text[r.doc_id]
        taken["0" + r.source] += words[r.doc_id]
    largest = {s: max(words[r.doc_id] for r in masked if "0" + r.source == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)

    ref = reference()
    assert len(tokens) == len(mixed)
    for r in tokens:
        assert r.ids == ref.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run_saves_stages_and_reruns_agree(spark):
    a, b = (sorted((r.doc_id, r.decoded_sha256) for r in cp.run(spark, SF_SMALL).collect()) for _ in range(2))
    assert a and a == b


def test_stages_handle_nulls_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (2, "same text of five words", None, "s", 23), (2, "same text of five words", None, "s", 23)], docs.schema)
    for table in (odd, odd.limit(0)):
        now = table
        for _, stage in cp.STAGES:
            now = stage(spark, now, SF_SMALL)
            now.collect()
