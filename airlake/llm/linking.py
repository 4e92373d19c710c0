"""Groups of linked items from band keys and a verifier, without pairs inside known groups.

Items that share a key are candidates. Comparing all pairs of a key grows with the square of
a group, so the comparisons go in rounds: first each item with the hub of its key, the item
that shares keys with most others; linked items are joined to groups; then, while that finds
links, the hub of each group of a key with that of the key's first group; at last the exact
rest: the items of a key that lie in different groups are compared in blocks of bounded size,
inside the tasks, and only links come out. Every candidate pair is thus either inside one group
or compared, so the groups are the connected components of all verified candidate pairs.

Hot keys stay partial sums (counts and maxima) in the first rounds; in the last one a key of
any size is cut into blocks, so no task holds more than two of them. The largest group of a key
is not compared with itself, and only the items outside it are copied to several block pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.tables import saved

#: Rounds between the hubs of groups before the exact rest.
ROUNDS = 2
#: Items of a key that a task compares with each other, or with as many others.
BLOCK = 2048


def components(items: DataFrame, links: DataFrame) -> DataFrame:
    """(item, label): the least item reachable over links (a, b); repeated min-label steps with
    pointer jumps, saved in the shared folder each time."""
    both = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    linked = saved(both.groupBy(F.col("a").alias("item")).agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        # the label of a neighbour, and the label of one's own label
        near = both.join(linked.select(F.col("item").alias("b"), "label"), "b").groupBy(F.col("a").alias("item")).agg(F.min("label").alias("near"))
        jump = linked.select(F.col("item").alias("label"), F.col("label").alias("far"))
        new = linked.join(near, "item", "left").join(jump, "label", "left").select("item", F.col("label").alias("old"), F.least("label", "near", "far").alias("label"))
        new = saved(new)
        linked = new.select("item", "label")
        if new.where("old <> label").isEmpty():
            break
    return items.select("item").join(linked, "item", "left").select("item", F.coalesce("label", "item").alias("label"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after links between items of different groups: components of the few groups
    that are linked, not of the items."""
    of = labels.select(F.col("item").alias("a"), F.col("label").alias("la"))
    to = labels.select(F.col("item").alias("b"), F.col("label").alias("lb"))
    edges = saved(links.join(of, "a").join(to, "b").where("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
    ends = edges.select(F.col("a").alias("item")).unionByName(edges.select(F.col("b").alias("item"))).distinct()
    new = components(ends, edges).select(F.col("item").alias("label"), F.col("label").alias("new"))
    return saved(labels.join(new, "label", "left").select("item", F.coalesce("new", "label").alias("label")))


def _blocks(labelled: DataFrame, size: int) -> DataFrame:
    """(key, lo, hi, block, item, label) of the keys of (key, item, label) whose items lie in
    several groups: the block pairs in which every two items of different groups meet.

    The largest group of a key needs no comparison inside. Its items are cut into blocks of
    their own, which meet the blocks of the other items only: each goes out once for every
    ``size`` other items, so one item outside a large group costs that group one copy.
    """
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n")).where("n > main.n")
    count = lambda n: F.ceil(n / F.lit(size)).cast("int")
    main = main.select("key", F.col("main.label").alias("largest"), count(F.col("n") - F.col("main.n")).alias("others"), count(F.col("main.n")).alias("own"))
    dealt = labelled.join(main, "key").withColumn("inner", F.col("label") == F.col("largest"))
    place = F.xxhash64("item")
    dealt = dealt.withColumn("block", F.when(F.col("inner"), F.col("others") + F.pmod(place, "own")).otherwise(F.pmod(place, "others")).cast("int"))
    last = F.when(F.col("inner"), F.col("others")).otherwise(F.col("others") + F.col("own")) - 1
    met = dealt.select("key", "item", "label", "block", F.explode(F.sequence(F.lit(0), last)).alias("other"))
    return met.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "item", "label")


def near_components(items: DataFrame, keys: DataFrame, verified: Callable[[DataFrame], DataFrame],
                    rest: Callable[[DataFrame], DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """(item, label, n_links) for all ``items`` (item).

    ``keys``: (item, key). ``verified`` takes pairs (a, b), a < b, and returns those that link.
    ``rest`` takes (key, lo, hi, block, item, label): for each (key, lo, hi) the items of two
    blocks (or of one, if lo = hi), and returns the links (a, b) between items of different
    labels (and of different blocks, if lo < hi). n_links counts the links that were found.
    """
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    busy = saved(keys.join(shared, "key").select("key", "item", "n"))
    weight = busy.groupBy("item").agg(F.sum("n").alias("weight"))
    candidates = saved(busy.join(weight, "item").select("key", "item", F.struct("weight", "item").alias("rank")))
    ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    hubs = candidates.groupBy("key").agg(F.max("rank").alias("hub"))
    pairs = saved(candidates.join(hubs, "key").where("item <> hub.item").select(*ordered(F.col("item"), F.col("hub.item"))).distinct())
    seen = pairs
    links = saved(verified(pairs))
    labels = saved(components(candidates.select("item").distinct(), links))
    for _ in range(rounds):
        grouped = candidates.join(labels, "item").groupBy("key", "label").agg(F.max("rank").alias("hub"))
        first = grouped.groupBy("key").agg(F.max("hub").alias("first"), F.count("*").alias("n")).where("n > 1")
        pairs = grouped.join(first, "key").where("hub.item <> first.item").select(*ordered(F.col("hub.item"), F.col("first.item")))
        pairs = saved(pairs.distinct().join(seen, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            break
        found = saved(verified(pairs))
        if found.isEmpty():
            break
        seen, links = seen.unionByName(pairs), links.unionByName(found)
        labels = _merged(labels, found)
    found = saved(rest(_blocks(candidates.join(labels, "item").select("key", "item", "label"), BLOCK)).select("a", "b").distinct())
    links = links.unionByName(found)
    labels = _merged(labels, found)
    counts = links.select(F.col("a").alias("item")).unionByName(links.select(F.col("b").alias("item"))).groupBy("item").agg(F.count("*").alias("n_links"))
    return items.select("item").join(labels, "item", "left").join(counts, "item", "left").select(
        "item", F.coalesce("label", "item").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def cross_pairs(labels: np.ndarray, blocks: np.ndarray, one_block: bool):
    """(x, ys) for every item x outside the largest group: the items to compare it with, each
    pair once."""
    _, group, sizes = np.unique(labels, return_inverse=True, return_counts=True)
    small = group != sizes.argmax()
    for x in np.flatnonzero(small):
        with_ = (group != group[x]) & (~small | (np.arange(len(labels)) > x))
        if not one_block:
            with_ &= blocks != blocks[x]
        if with_.any():
            yield x, np.flatnonzero(with_)
