"""Near-duplicates by probability Jaccard of weighted word shingles (ProbMinHash).

A text is the multiset of its runs of five words; the weight of a shingle is how often it
occurs. (A text of one to four words is one shingle.) Each shingle sends arrivals of a Poisson
process whose rate is its weight, with random numbers that depend on the shingle alone, to
random registers; a register keeps the shingle that arrives first. Two texts agree in a register
with their probability Jaccard similarity

    J_P(x, y) = sum over shared d of 1 / sum over i of max(x_i / x_d, y_i / y_d).

A shingle stops sending once its next arrival is later than every register's first, so a text
costs about its number of shingles plus ``REGISTERS`` * log(``REGISTERS``) arrivals.

Registers are banded (``BANDS`` x ``ROWS``); texts that share a band are candidates, and a
candidate pair links if its exact J_P is at least 0.8. At 0.8 a pair shares no band with
probability (1 - 0.8**4)**32, 5e-8. Equal texts are one item, identified by a 64-bit hash.
Groups are connected components (``linking``), so no group is expanded into pairs.

Edge cases: null texts and texts without words are classes of their own; repeated rows are in
one class, of which one row is kept; a class is named by its least doc_id (null if it has only
null ids); an empty table gives an empty one. Extra columns are kept by ``deduplicate`` and not
read by ``classes``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.arrowtext import Words, gram_hashes, mix64, slices
from airlake.llm.linking import cross_pairs, near_components
from airlake.llm.tables import TEXT_BATCH, TEXT_SLICE as SLICE, bound_arrow, give_back, saved, tidy

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 32, 4
REGISTERS = BANDS * ROWS
#: Bytes of a group of texts (words and shingles take some forty times ``SLICE`` while they are made) after
#: which its task gives freed memory back: such tasks are not told when they end.
GROUP_BYTES = 64 << 10


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, weights, ranges): distinct shingles of each text, those of text i in
    ranges[i] to ranges[i + 1], by rising hash."""
    words = Words(column)
    grams, ranges = gram_hashes(words.hashes, words.bounds, SHINGLE)
    counts = words.counts()
    text = np.repeat(np.arange(len(counts)), np.diff(ranges))
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):                                            # whole text as one shingle
        whole = np.array([_folded(words.hashes[words.bounds[i]: words.bounds[i + 1]]) for i in short], np.uint64)
        grams, text = np.concatenate([grams, whole]), np.concatenate([text, short])
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return grams[at], np.diff(np.append(at, len(grams))), np.searchsorted(text[at], np.arange(len(counts) + 1))


def _folded(hashes: np.ndarray) -> np.uint64:
    out = np.array([len(hashes)], np.uint64)
    for h in hashes:
        out = mix64(out ^ h)
    return out[0]


def registers(grams: np.ndarray, weights: np.ndarray, ranges: np.ndarray, size: int = REGISTERS) -> np.ndarray:
    """The first shingle to arrive at each register, one row per text (0 for texts without)."""
    n = len(ranges) - 1
    first = np.full(n * size, np.inf)
    holder = np.zeros(n * size, np.uint64)
    text = np.repeat(np.arange(n), np.diff(ranges))
    live, time, turn = np.arange(len(grams)), np.zeros(len(grams)), 0
    while len(live):
        turn += 1
        with np.errstate(over="ignore"):
            noise = mix64(grams[live] ^ mix64(np.array([turn], np.uint64)))
        time = time - np.log(((noise >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / weights[live]
        place = text[live] * size + (mix64(noise) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = time == first[place]
        holder[place[won]] = grams[live][won]
        last = first.reshape(n, size).max(axis=1)
        on = time <= last[text[live]]
        live, time = live[on], time[on]
    return holder.reshape(n, size)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each text."""
    bands = rows.reshape(len(rows), BANDS, ROWS)
    key = np.broadcast_to(mix64(np.arange(BANDS, dtype=np.uint64)), (len(rows), BANDS)).copy()
    for r in range(ROWS):
        key = mix64(key ^ bands[:, :, r])
    return key.view(np.int64)


def probability_jaccard(a, wa, b, wb) -> float:
    """Exact J_P of two weighted sets (sorted shingles and weights)."""
    both = np.union1d(a, b)
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a)] = wa
    y[np.searchsorted(both, b)] = wb
    shared = (x > 0) & (y > 0)
    if not shared.any():
        return 0.0
    # sum over i of max(x_i, t * y_i) for t = x_d / y_d: sort by x_i / y_i, then prefix sums
    ratio = np.divide(x, y, out=np.full(len(both), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    ratio, below = ratio[order], np.concatenate(([0], np.cumsum(y[order])))
    above = x.sum() - np.concatenate(([0], np.cumsum(x[order])))
    t = (x / np.where(y > 0, y, 1))[shared]
    at = np.searchsorted(ratio, t)
    return float((x[shared] / (t * below[at] + above[at])).sum())


def item(text: str = "text") -> Column:
    """Equal texts are one item."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, item, keys): band keys of every text; none without words."""
    bound_arrow(docs.sparkSession, TEXT_BATCH)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                grams, weights, ranges = shingles(part.column("text"))
                keys = band_keys(registers(grams, weights, ranges))
                full = np.diff(ranges) > 0
                flat = pa.array(keys[full].reshape(-1))
                offsets = pa.array(np.concatenate(([0], np.cumsum(full) * BANDS)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("item"), pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "item", "keys"])

    return docs.select("doc_id", "text", item().alias("item")).mapInArrow(tidy(run), "doc_id long, item long, keys array<long>")


def _verifier(texts: DataFrame, threshold: float):
    """Candidate pairs (a, b) of items -> those whose exact J_P reaches the threshold."""
    def verified(pairs: DataFrame) -> DataFrame:
        def run(batches):
            for batch in batches:
                for part in slices(batch, "text_a", SLICE):
                    a, wa, ra = shingles(part.column("text_a"))
                    b, wb, rb = shingles(part.column("text_b"))
                    near = [probability_jaccard(a[ra[i]:ra[i + 1]], wa[ra[i]:ra[i + 1]], b[rb[i]:rb[i + 1]], wb[rb[i]:rb[i + 1]]) >= threshold - 1e-9
                            for i in range(part.num_rows)]
                    yield part.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

        first = pairs.join(texts.select(F.col("item").alias("a"), F.col("text").alias("text_a")), "a")
        both = first.join(texts.select(F.col("item").alias("b"), F.col("text").alias("text_b")), "b")
        return both.select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), "a long, b long")
    return verified


def _compared(group: pa.Table, threshold: float) -> list[tuple[int, int]]:
    """Links between items of different groups in one block pair of a key. A pair is compared
    only in the first of the bands that it shares."""
    items, labels = np.array(group.column("item")), np.array(group.column("label"))
    keys = np.array(group.column("keys").combine_chunks().flatten()).reshape(len(items), BANDS)
    band = int(np.flatnonzero(keys[0] == group.column("key")[0].as_py())[0])
    before = keys[:, :band]
    grams, weights, ranges = shingles(group.column("text").combine_chunks())
    words, number = np.unique(grams, return_inverse=True)
    size = np.diff(ranges)
    plain = np.maximum.reduceat(weights, ranges[:-1]) == 1
    mark = np.zeros(len(words), bool)
    links = []
    for x, ys in cross_pairs(labels, np.array(group.column("block")), group.column("lo")[0].as_py() == group.column("hi")[0].as_py()):
        ys = ys[~(before[ys] == before[x]).any(axis=1)] if band else ys
        if not len(ys):
            continue
        # exact intersections with all of them at once
        mark[number[ranges[x]: ranges[x + 1]]] = True
        at = np.repeat(ranges[ys], size[ys]) + (np.arange(size[ys].sum()) - np.repeat(np.cumsum(size[ys]) - size[ys], size[ys]))
        common = np.add.reduceat(mark[number[at]].astype(np.int64), np.cumsum(size[ys]) - size[ys])
        mark[number[ranges[x]: ranges[x + 1]]] = False
        similar = common / (size[x] + size[ys] - common)      # J_P of texts without repeated shingles
        for k in np.flatnonzero((common > 0) & ~(plain[ys] & plain[x])):
            y = ys[k]
            similar[k] = probability_jaccard(grams[ranges[x]: ranges[x + 1]], weights[ranges[x]: ranges[x + 1]], grams[ranges[y]: ranges[y + 1]], weights[ranges[y]: ranges[y + 1]])
        links += [(int(min(items[x], items[y])), int(max(items[x], items[y]))) for y in ys[similar >= threshold - 1e-9]]
    return links


def _rest(texts: DataFrame, threshold: float):
    def rest(blocks: DataFrame) -> DataFrame:
        def run(group: pa.Table) -> pa.Table:
            links = _compared(group, threshold)
            if group.nbytes >= GROUP_BYTES:
                give_back()
            return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
        return blocks.join(texts, "item").groupBy("key", "lo", "hi").applyInArrow(run, "a long, b long")
    return rest


def _labelled(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, item, words, label) of every row; ``words``: the text has any."""
    rows = saved(signed(docs))
    items = rows.where("size(keys) > 0").groupBy("item").agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"))
    keys = items.select("item", F.explode("keys").alias("key"))
    # texts of the items that share a band with another, once each
    busy = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    wanted = items.join(keys.join(busy, "key").select("item").distinct(), "item").select(F.col("item").alias("named"), F.col("doc_id").alias("id"), "keys")
    texts = docs.select("doc_id", "text", item().alias("item")).join(wanted, (F.col("item") == F.col("named")) & F.col("doc_id").eqNullSafe(F.col("id")))
    texts = saved(texts.select("item", "text", "keys").dropDuplicates(["item"]))
    keys = texts.select("item", F.explode("keys").alias("key"))
    linked = near_components(texts.select("item"), keys, _verifier(texts, threshold), _rest(texts, threshold))
    return rows.select("doc_id", "item", (F.size("keys") > 0).alias("words")).join(linked, "item", "left").select(
        "doc_id", "item", "words", F.coalesce("label", "item").alias("label"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) of every row: the least doc_id of its group."""
    rows = _labelled(docs.select("doc_id", "text"), threshold)
    names = rows.where("words").groupBy("label").agg(F.min("doc_id").alias("class_id"))
    named = rows.join(names, "label", "left")
    return named.select("doc_id", F.when(F.col("words"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group: that of least doc_id, then least hash. Rows without
    words all stay."""
    rows = _labelled(docs.select("doc_id", "text"), threshold)
    kept = rows.where("words").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "item")).alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("first_id"), F.col("first.item").alias("first_item"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id_"), item().alias("item_"),
                         F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("words_"))
    chosen = packed.where("words_").join(kept, (F.col("item_") == F.col("first_item")) & F.col("id_").eqNullSafe(F.col("first_id")))
    one = Window.partitionBy("item_").orderBy("id_")
    first = chosen.withColumn("place_", F.row_number().over(one)).where("place_ = 1").select("row.*")
    return first.unionByName(packed.where("NOT words_").select("row.*"))
