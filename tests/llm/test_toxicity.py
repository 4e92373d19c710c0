import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from airlake.llm import toxicity as tx
from airlake.llm.queries import QUERIES
from llm_helpers import make_docs
from pyspark.sql import functions as F

WORDS = "the river runs under a stone bridge and children watch boats drift along while merchants sell bread from wooden carts near market square".split()


def prose(rng, n=40):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = prose(rng).split()
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["grumblor", "snarkface"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, corpus):
    return tx.language_model(tx.letter_counts(make_docs(spark, corpus[0])))


def test_letter_counts_against_brute_force(spark):
    rows = [(1, "Aé b"), (2, None), (3, "x😀yß" * 30), (4, ""), (5, "aaaa")]
    got = tx.letter_counts(make_docs(spark, rows).repartition(1))
    want = np.zeros(27 ** 4)
    text = [0, 0, 0] + [int(tx._FOLD[ord(c)]) if ord(c) < len(tx._FOLD) else 0 for c in " ".join(t for _, t in rows if t)] + [0]
    for k in range(len(text) - 3):
        want[((text[k] * 27 + text[k + 1]) * 27 + text[k + 2]) * 27 + text[k + 3]] += 1
    assert got.sum() == want.sum() and (got.ravel() == want).all()


@pytest.mark.parametrize("disguised", ["grumbl0r", "gr|_|mblor".replace("|_|", "u"), "gruuumblor", "g.r.u.m.b.l.o.r", "GRUMBLOR", "gr-umb-lor", "6rumb1or", "grümblör"])
def test_disguised_words_are_restored(model, disguised):
    assert "grumblor" in tx.Restorer(model).words(f"the {disguised} runs")


@pytest.mark.parametrize("disguised, word", [("snarkfac3", "snarkface"), ("snarkfac€.", "snarkface"), ("grumbloor", "grumblor"), ("gruumbloor", "grumblor"), ("boa7$", "boats"),
                                             ("80475", "boats"), ("$n@rkface.Go", "snarkface"), ("(arts", "carts")])
def test_signs_at_the_end_doubled_letters_and_mostly_signs_are_restored(model, disguised, word):
    assert word in tx.Restorer(model).words(f"the {disguised} runs")


@pytest.mark.parametrize("disguised", ["grrrrrrrruuuuummmmmblooooooooor", "g~~r~~u~~m~~b~~l~~o~~r~~s.market", "children/watch/the/grumbl0r/boats,", "grumbl" + "o" * 5000 + "r",
                                       "x" + "-" * 3000 + "grumb1or" + "'" * 3000 + "x"])
def test_long_tokens_are_read_whole(model, disguised):
    assert "grumblor" in " ".join(tx.Restorer(model).words(f"the {disguised} runs"))


def test_settled_beginnings_change_no_reading(model, monkeypatch):
    rng = random.Random(3)
    tokens = ["".join(rng.choice("abrs1|!.-40xoo") for _ in range(200)) for _ in range(20)]
    decoder = tx.Decoder(model)
    got = [decoder.read(t) for t in tokens]
    monkeypatch.setattr(tx, "SETTLE", 10 ** 9)
    assert got == [decoder.read(t) for t in tokens]


def test_spaced_letters_are_restored(model):
    assert "grumblor" in tx.Restorer(model).words("near g r u m b l o r market")


def exhaustive(decoder, token):
    """The cheapest reading by trying all of them."""
    best = (1e9, "")

    def go(k, state, cost, path):
        nonlocal best
        arcs = decoder.arcs(token)
        if k == len(arcs):
            total = cost + (float(decoder.model[*state, 0]) if state[2] else 0.0)
            best = min(best, (total, " ".join(path.split())))
            return
        for price, letter in arcs[k]:
            if letter is None:
                go(k + 1, state, cost + price, path)
            else:
                more = float(decoder.model[*state, letter]) if letter or state[2] else 0.0
                go(k + 1, (state[1], state[2], letter), cost + price + more, path + (chr(96 + letter) if letter else " "))
    go(0, (0, 0, 0), 0.0, "")
    return best


def test_viterbi_finds_the_cheapest_reading(model, monkeypatch):
    monkeypatch.setattr(tx, "BEAM", 10 ** 9)
    rng = random.Random(8)
    decoder = tx.Decoder(model)
    for _ in range(150):
        token = "".join(rng.choice("abrs1|!.-40x") for _ in range(rng.randint(1, 7)))
        assert decoder.read(token) == exhaustive(decoder, token)[1]


def test_scores_find_disguised_words_and_leave_clean_texts(spark, corpus):
    rows, labels = corpus
    rng = random.Random(9)
    new = [(1000 + i, prose(rng) + " " + w + " " + prose(rng)) for i, w in enumerate(["grumblor", "gr4mblor".replace("4", "u"), "sn4rkf4ce", "s n a r k f a c e", "grummmblor"])]
    clean = [(2000 + i, prose(rng, 60)) for i in range(40)]
    edge = [(3000, None), (3001, ""), (None, "same"), (None, "same"), (3002, "long " * 50_000)]
    df = make_docs(spark, rows + new + clean + edge).withColumn("score", F.lit("old"))
    out = tx.toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    score = {r.doc_id: r.score for r in out}
    assert len(out) == len(rows) + len(new) + len(clean) + len(edge) and all(0 <= r.score <= 1 for r in out)
    assert all(score[i] >= tx.THRESHOLD for i, _ in new), [(i, score[i]) for i, _ in new]
    assert all(score[i] < tx.THRESHOLD for i, _ in clean + edge[:2])


def test_features_of_unbroken_runs_reach_their_end():
    run = "children" * 10 + "grumblor" + "boats" * 10
    got = tx.features(run)
    assert {run[k: k + 4] for k in range(1, len(run) - 3)} <= set(got) and "=" + run not in got
    assert len(got) <= len(run) and "=grumblor" in tx.features("grumblor")


def test_scores_reach_the_end_of_unbroken_runs(spark):
    rng = random.Random(2)
    common = [chr(0x4E00 + k) for k in range(300)]
    clause = lambda: "".join(rng.choice(common) for _ in range(90))
    rows = [(i, clause()[:70] + "\u9f98\u9f99\u9f9a\u9f9b\u9f9c" + clause()[:20] if i % 4 == 0 else clause()) for i in range(200)]
    docs, labels = make_docs(spark, rows), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)], "doc_id long, toxic int")
    got = {r.doc_id: r.score >= tx.THRESHOLD for r in tx.toxicity(docs, labels).collect()}
    assert got == {i: i % 4 == 0 for i, _ in rows}


def test_no_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score < 1e-9 for r in tx.toxicity(make_docs(spark, [(1, "a b")]), none).collect()] == [True]
    assert tx.toxicity(make_docs(spark, []), none).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op5_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out AND toxic IS NOT NULL").select("toxic", "predicted", "score").collect()
    bad, good = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in bad) >= 0.8 * len(bad)
    assert sum(r.predicted for r in good) <= 0.01 * len(good)


def paths(tool, token):
    """Every reading of a token: its letters, with blanks at boundaries."""
    out = {""}
    for here in tool.arcs(token):
        out = {p + ("" if letter is None else chr(96 + letter) if letter else " ") for p in out for _, letter in here}
    return out


def test_what_spelling_rules_out_has_no_reading_with_a_feature():
    rng = random.Random(11)
    tool = tx.Decoder(np.ones((27,) * 4, np.float32))
    ruled_out = 0
    for _ in range(3000):
        token = "".join(rng.choice("aabilgo01l!69-._$x") for _ in range(rng.randint(4, 9)))
        names = ["".join(rng.choice("abilgosx") for _ in range(4)) for _ in range(3)] + ["=" + "".join(rng.choice("ailgo") for _ in range(5)), "^gaol"]
        if tx.Spelling(names)(tx.plain(token)):
            continue
        ruled_out += 1
        for reading in paths(tool, token):
            assert not any(n in tx.features(w) for w in reading.split() for n in names), (token, names, reading)
    assert ruled_out > 1000


def test_scores_are_the_same_with_every_token_decoded(spark, monkeypatch):
    with_test = {r.doc_id: r.score for r in QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    monkeypatch.setattr(tx.Spelling, "__call__", lambda self, token: True)
    everything = {r.doc_id: r.score for r in QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    assert with_test == everything


def test_letters_are_counted_in_little_memory(spark):
    """A task holds some 60 times the text that it works on."""
    class Caught(Exception):
        pass

    class Docs:
        sparkSession = spark

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            raise Caught(run)

    with pytest.raises(Caught) as caught:
        tx.letter_counts(Docs())
    texts = pa.RecordBatch.from_arrays([pa.array(["some words " * 1000] * 350)], names=["text"])
    tracemalloc.start()
    try:
        counted = sum(b.num_rows for b in caught.value.args[0](iter([texts])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert counted and peak < 50 << 20
