import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from airlake.llm import neardup as nd
from airlake.llm import linking
from airlake.llm.linking import components, cross_pairs, near_components
from airlake.llm.queries import QUERIES
from llm_helpers import SF_SMALL, make_docs


def weighted(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[k: k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] * bool(w))


def brute_jp(x, y):
    every = x.keys() | y.keys()
    every = x.keys() | y.keys()
    if {*x.values(), *y.values()} == {1}:                      # plain sets
        return len(x.keys() & y.keys()) / len(every)
    return sum(1 / sum(max(x[i] / x[d], y[i] / y[d]) for i in every) for d in x.keys() & y.keys())


def brute_classes(rows):
    """Connected components over all pairs."""
    sets = [weighted(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    holders = {}
    for i, s in enumerate(sets):
        for d in s:
            holders.setdefault(d, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for d in s for j in holders[d] if j < i}:
            if root(i) != root(j) and (sets[i] == sets[j] or brute_jp(s, sets[j]) >= 0.8 - 1e-9):
                label[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    return sorted((d, min(groups[root(i)]) if sets[i] else d) for i, (d, _) in enumerate(rows))


def texts(rng, n=40):
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore".split()
    base = [[rng.choice(words) for _ in range(rng.randint(1, 150))] for _ in range(8)]
    out = []
    for _ in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice(words)
        if rng.random() < 0.3:
            t = t + t[: rng.randint(0, len(t))]
        out.append(rng.choice([" ", "  ", "\n"]).join(t))
    return out


def test_exact_similarity_against_brute_force():
    rng = random.Random(1)
    many = texts(rng)
    g, w, r = nd.shingles(pa.array(many))
    for i in range(len(many)):
        for j in range(0, i, 5):
            got = nd.probability_jaccard(g[r[i]:r[i + 1]], w[r[i]:r[i + 1]], g[r[j]:r[j + 1]], w[r[j]:r[j + 1]])
            assert got == pytest.approx(brute_jp(weighted(many[i]), weighted(many[j])))


def test_registers_agree_with_the_similarity():
    rng = random.Random(2)
    many = texts(rng, 30)
    g, w, r = nd.shingles(pa.array(many))
    rows = nd.registers(g, w, r, 4096)
    for i in range(len(many)):
        for j in range(0, i, 4):
            assert (rows[i] == rows[j]).mean() == pytest.approx(brute_jp(weighted(many[i]), weighted(many[j])), abs=0.05)


def test_early_termination_changes_nothing():
    """Registers equal those of full processes, run far beyond the stop."""
    g, w, r = nd.shingles(pa.array(["a b c d e f g a b c d e f", "x y"]))
    rows = nd.registers(g, w, r, 16)
    for t in range(2):
        first, holder = np.full(16, np.inf), np.zeros(16, np.uint64)
        for d, weight in zip(g[r[t]:r[t + 1]], w[r[t]:r[t + 1]]):
            time = 0.0
            for turn in range(1, 400):
                noise = nd.mix64(np.array([d]) ^ nd.mix64(np.array([turn], np.uint64)))
                time += -np.log((float(noise[0] >> np.uint64(11)) + 1) * 2.0 ** -53) / weight
                k = int(nd.mix64(noise)[0] % np.uint64(16))
                if time < first[k]:
                    first[k], holder[k] = time, d
        assert (rows[t] == holder).all()


@pytest.mark.parametrize("seed", range(2))
def test_classes_against_brute_force(spark, seed):
    rows = list(enumerate(texts(random.Random(seed + 10), 60)))
    got = sorted((r.doc_id, r.class_id) for r in nd.classes(make_docs(spark, rows)).collect())
    assert got == brute_classes(rows)


def test_edge_rows_and_one_row_of_each_group(spark):
    long = "w%d " * 4000 % tuple(range(4000))
    rows = [(5, "a b c"), (4, "a  b c"), (4, "a  b c"), (1, None), (2, ""), (2, ""), (3, " \n"), (None, "other words in this one here"), (9, long), (10, long + "end"), (None, "a b c")]
    df = make_docs(spark, rows).selectExpr("*", "1 AS item", "2 AS label", "'r' AS row", "3 AS first_id")
    got = nd.deduplicate(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id or 0, r.text) for r in got.collect()), key=repr) == sorted([(1, None), (2, ""), (2, ""), (3, " \n"), (4, "a  b c"), (9, long), (0, "other words in this one here")], key=repr)
    classes = sorted((str(r.doc_id), str(r.class_id)) for r in nd.classes(df).collect())
    assert classes == sorted([("5", "4"), ("4", "4"), ("4", "4"), ("1", "1"), ("2", "2"), ("2", "2"), ("3", "3"), ("None", "None"), ("9", "9"), ("10", "9"), ("None", "4")])
    assert nd.classes(make_docs(spark, [])).count() == 0 and nd.deduplicate(make_docs(spark, [])).count() == 0


def test_components_and_cross_group_rest(spark, monkeypatch):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 9), (20, 21), (8, 9)], "a long, b long")
    items = spark.createDataFrame([(i,) for i in (1, 2, 3, 8, 9, 20, 21, 30)], "item long")
    assert {r.item: r.label for r in components(items, links).collect()} == {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 20: 20, 21: 20, 30: 30}
    # one key for all; only i ~ i + 6 links, so no star around the least item finds the groups
    keys = items.select("item").limit(0).unionByName(spark.range(18).withColumnRenamed("id", "item")).selectExpr("item", "'k' AS key")
    def rest(blocks):
        def run(group):
            at, x = group.column("item").to_numpy(), []
            for i, js in cross_pairs(group.column("label").to_numpy(), group.column("block").to_numpy(), group.column("lo")[0] == group.column("hi")[0]):
                x += [(min(at[i], at[j]), max(at[i], at[j])) for j in js if abs(at[i] - at[j]) == 6]
            return pa.table({"a": pa.array([a for a, _ in x], pa.int64()), "b": pa.array([b for _, b in x], pa.int64())})
        return blocks.groupBy("key", "lo", "hi").applyInArrow(run, "a long, b long")

    for block in (2048, 4):
        monkeypatch.setattr(linking, "BLOCK", block)
        got = near_components(keys.select("item"), keys, lambda p: p.where("b - a = 6"), rest).collect()
        assert {r.item: r.label for r in got} == {i: i % 6 for i in range(18)}


@pytest.mark.parametrize("groups", [[100, 1], [100, 1, 1, 30], [1] * 40, [7, 7], [20]])
def test_blocks_of_the_rest(spark, groups):
    """Items of different groups of a key meet once; one outlier costs a large group one copy."""
    labels = [g for g, n in enumerate(groups) for _ in range(n)]
    rows = [(k, i, g) for k in (1, 2) for i, g in enumerate(labels)]
    sent = linking._blocks(spark.createDataFrame(rows, "key long, item long, label long"), 8).collect()
    tasks = {}
    for r in sent:
        tasks.setdefault((r["key"], r["lo"], r["hi"]), []).append(r)
    met = Counter()
    for (key, lo, hi), group in tasks.items():
        block = np.array([r["block"] for r in group])
        assert max(Counter(block.tolist()).values()) <= 30
        for x, ys in cross_pairs(np.array([r["label"] for r in group]), block, lo == hi):
            met.update((key, *sorted((group[x]["item"], group[y]["item"]))) for y in ys)
    n = len(labels)
    assert met == Counter((k, a, b) for k in (1, 2) for a in range(n) for b in range(a + 1, n) if labels[a] != labels[b])
    if groups == [100, 1]:
        assert len(sent) <= 2 * (100 + 13 + 1)


def test_query_against_brute_force(spark):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    assert sorted((r.doc_id, r.class_id) for r in QUERIES["op4_near_duplicates"](spark, SF_SMALL).collect()) == brute_classes(rows)


def test_memory_of_a_signing_task_is_bounded(monkeypatch):
    """A task makes words and shingles of little text at a time, however much an Arrow batch holds."""
    import tracemalloc

    class Docs:
        """Stands for the frame: hands out the function that a task runs."""
        class sparkSession:
            class conf:
                set = staticmethod(lambda *a: None)

        def select(self, *a):
            return self

        def mapInArrow(self, run, schema):
            self.run = run
            return self

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(2000)]           # 3.6 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array(range(len(texts)))], names=["doc_id", "text", "item"])
    docs = Docs()
    monkeypatch.setattr(nd, "item", lambda: type("Hash", (), {"alias": lambda *a: None})())
    nd.signed(docs)
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in docs.run([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and peak < 40 << 20


def test_groups_of_texts_give_memory_back(monkeypatch):
    """A task on groups isn't told when it ends, so each group of some size does."""
    events, runs = [], []

    class Blocks:
        def join(self, *_):
            return self

        groupBy = join

        def applyInArrow(self, run, schema):
            runs.append(run)

    monkeypatch.setattr(nd, "_compared", lambda group, threshold: [])
    monkeypatch.setattr(nd, "give_back", lambda: events.append("given back"))
    nd._rest(None, 0.8)(Blocks())
    runs[0](pa.table({"text": ["x" * 1000]}))
    assert events == []
    runs[0](pa.table({"text": ["x" * 100_000] * 2}))
    assert events == ["given back"]
