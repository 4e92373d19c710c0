import random

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from airlake.llm import tokencounts as K
from llm_helpers import SF_SMALL, make_docs

PATH = P.path(K.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def mixed(n):
    rng, tool = random.Random(5), K.counter(PATH)
    def one():
        kind = rng.random()
        if kind < 0.4:
            return "".join(rng.choice("abcdehinorst  \n%#*é1") for _ in range(rng.randint(0, 60)))
        if kind < 0.8:
            return "".join(rng.choice(tool.pieces) for _ in range(rng.randint(0, 12)))
        return "".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0x3000, 0x30FF), rng.randint(0x1F600, 0x1F640), 32, 32, 0x2581, 10])) for _ in range(rng.randint(0, 30)))
    return [one() for _ in range(n)]


ODD = ["", " ", "   x", "<s> a </s><unk>", "▁▁a", "\x00", "a" * 500, " " * 100, "\t\r\n", "<0x0A>", "％ﬁÅ", "1234567890" * 9, "ab" * 400 + " " + "ba" * 300]


def test_counts_equal_the_library(library):
    tool, texts = K.PrefixCounter(PATH), mixed(5000) + ODD
    assert tool.counts(texts) == [len(library.encode(t)) for t in texts]


def test_every_prefix_equals_the_library(library):
    tool, texts = K.PrefixCounter(PATH), mixed(250) + ODD
    for text, counts in zip(texts, tool.prefixes(texts)):
        assert counts.tolist() == [len(library.encode(text[:k])) for k in range(len(text) + 1)], ascii(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abehtinrs \n.é▁😀", max_size=40))
def test_any_text(text):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert K.counter(PATH).prefixes([text])[0].tolist() == [len(model.encode(text[:k])) for k in range(len(text) + 1)]


def test_budgets_are_answered_from_the_counts(library, monkeypatch):
    tool, texts = K.PrefixCounter(PATH), mixed(300) + ODD
    cut, known = tool.chunks(texts)
    monkeypatch.setattr(tool, "walks", None)               # no further walk
    for text, chunks in zip(texts, cut):
        counts = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        for budget in (0, 1, 2, 5, 17):
            assert tool.longest(chunks, known, budget) == max(k for k, n in enumerate(counts) if n <= budget), ascii(text)


def test_small_generations_change_nothing(library, monkeypatch):
    monkeypatch.setattr(K, "KEPT", 5)
    tool, texts = K.PrefixCounter(PATH), mixed(400) + ODD
    for _ in range(2):
        for at in range(0, len(texts), 50):
            part = texts[at: at + 50]
            assert tool.counts(part) == [len(library.encode(t)) for t in part]
    assert len(tool.known.old) < 1000


def test_edge_rows(spark, library):
    from pyspark.sql import functions as F

    rows = [(1, None), (1, ""), (None, "x y"), (3, "same"), (3, "same"), (4, "word " * 60000), (5, "x" * 300000)]
    df = make_docs(spark, rows).withColumns({"n_tokens": F.lit("old"), "N_BYTES": F.lit(1), "tool": F.lit(0)})
    out = K.count(df, 4096).collect()
    tokens = lambda t: len(library.encode(t))
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in out) == sorted(
        (i or 0, len((t or "").encode()), tokens(t or ""), tokens(t or "") > 4096) for i, t in rows)
    for r in out:
        assert tokens((r.text or "")[:r.limit_chars]) <= 4096
        assert r.limit_chars == len(r.text or "") or tokens(r.text[:r.limit_chars + 1]) > 4096
    cut = {r.doc_id: r.truncated for r in K.truncate(df, 10).collect()}
    assert len(library.encode(cut[5])) <= 10 < len(library.encode("x" * (len(cut[5]) + 1)))
    assert [r.fitting_chars for r in K.fitting(make_docs(spark, [(1, "one two three")]), [0, 2, 99]).collect()] == [[0, 7, 13]]
    assert [r.prefix_tokens for r in K.prefix_counts(make_docs(spark, [(1, "ab"), (2, None)])).orderBy("doc_id").collect()] == [
        [0, len(library.encode("a")), len(library.encode("ab"))], [0]]
    assert K.count(make_docs(spark, []), 5).count() == 0


def test_query_against_the_library(spark, library):
    from airlake.llm.queries import QUERIES

    texts = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op13_token_counts"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
        assert n <= 4096 or len(library.encode(texts[r.doc_id][:r.limit_chars])) <= 4096 < len(library.encode(texts[r.doc_id][:r.limit_chars + 1]))
