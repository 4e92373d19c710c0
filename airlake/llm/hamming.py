"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector becomes a code: bit i says on which side of a fixed random hyperplane it lies. The
code is cut into segments. If two codes differ in fewer than ``SEGMENTS`` * (r + 1) bits, some
segment of theirs differs in at most r bits. So the search probes, for each query, all segment
values at exactly r bits from its own, for r = 0, 1, 2, ...: once the k-th best verified
distance is below ``SEGMENTS`` * (r + 1), nothing unseen can be as near, and the query is done.
Ties at the k-th place go to the lesser id, and the test above covers them.

The codes lie in partitions, each with the sorted segment values of its codes. A round sends
the open queries, at most ``BLOCK`` at a time, to all partitions; each verifies the codes that
its probes meet and returns its own k best. Spark merges them with the best of earlier rounds.
Codes are kept once, with the least of their ids: more than k cannot reach a top k.

Edge cases: vectors that are null, hold nulls or have another length, and null ids, are left
out of index and queries; repeated rows count once; a query finds itself unless
``exclude_self``; fewer than k rows give fewer hits; an empty table gives an empty result.
Extra columns are not read, so none can clash.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.tables import saved, tidy

#: Code length, segments, hits per query, and queries that are broadcast at a time.
BITS, SEGMENTS, TOP, BLOCK = 64, 4, 10, 16_384
_WIDTH = BITS // SEGMENTS


def codes(vectors: DataFrame, dimension: int, id_: str = "vec_id", vector: str = "embedding", seed: int = 3) -> DataFrame:
    """(id, code): 64-bit codes of all usable vectors, one row per id and code."""
    planes = np.random.default_rng(seed).standard_normal((dimension, BITS))

    def run(batches):
        for batch in batches:
            column = batch.column("v")
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
            bits = np.packbits(np.nan_to_num(x) @ planes > 0, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(bits.reshape(-1).view(">i8").astype(np.int64))], names=["id", "code"])

    usable = vectors.select(F.col(id_).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    usable = usable.where(F.col("id").isNotNull() & (F.size("v") == dimension) & ~F.exists("v", lambda e: e.isNull()))
    return usable.mapInArrow(tidy(run), "id long, code long").distinct()


def masks(radius: int) -> np.ndarray:
    """All segment values with exactly ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(_WIDTH), radius)], np.uint64)


def _classes(index: DataFrame, room: int) -> DataFrame:
    """(code, ids): each code once, with its least ids. A code may stand for very many rows;
    all but the least are dropped row by row, before any list is made."""
    order = Window.partitionBy("code").orderBy("id")
    few = index.select("code", "id").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= room)
    return few.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))


class Segments:
    """The codes of one part of the index, by segment value."""

    def __init__(self, codes_: np.ndarray):
        self.codes = codes_
        self.order, self.values = [], []
        for k in range(SEGMENTS):
            value = self.cut(codes_, k)
            self.order.append(np.argsort(value, kind="stable"))
            self.values.append(value[self.order[-1]])

    @staticmethod
    def cut(codes_: np.ndarray, k: int) -> np.ndarray:
        return (codes_ >> np.uint64(k * _WIDTH)) & np.uint64((1 << _WIDTH) - 1)

    def at(self, code: np.uint64, radius: int, probes: np.ndarray) -> np.ndarray:
        """Numbers of the codes of which a segment is exactly ``radius`` bits from the query's."""
        met = []
        for k in range(SEGMENTS):
            own = self.cut(code, k)
            if len(probes) > len(self.codes):                 # comparing the values is less work than probing
                met.append(self.order[k][np.bitwise_count(self.values[k] ^ own) == radius])
                continue
            wanted = probes ^ own
            first, last = np.searchsorted(self.values[k], wanted, "left"), np.searchsorted(self.values[k], wanted, "right")
            full = np.flatnonzero(last > first)
            met += [self.order[k][a:b] for a, b in zip(first[full], last[full])]
        return np.unique(np.concatenate(met)) if met else np.empty(0, np.int64)


def _round(classes: DataFrame, block: list[tuple[int, int]], radius: int, k: int, exclude_self: bool) -> DataFrame:
    """(query, id, distance): of each part of the index, the k best that the probes at exactly
    ``radius`` meet."""
    shared = classes.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        probes = masks(radius)
        for batch in batches:
            if not batch.num_rows:
                continue
            index = Segments(np.array(batch.column("code")).astype(np.int64).view(np.uint64))
            ids = batch.column("ids")
            begin, every = np.array(ids.offsets) - ids.offsets[0].as_py(), np.array(ids.flatten())
            rows = []
            for query, code in shared.value:
                code = np.array([code], np.int64).view(np.uint64)[0]
                met = index.at(code, radius, probes)
                if not len(met):
                    continue
                distance = np.bitwise_count(index.codes[met] ^ code).astype(np.int64)
                if len(met) > k + 1:                           # one more, for the query itself
                    near = distance <= np.partition(distance, k)[k]
                    met, distance = met[near], distance[near]
                hits = sorted((int(d), int(i)) for d, m in zip(distance, met) for i in every[begin[m]: begin[m + 1]] if not exclude_self or i != query)
                rows += [(query, i, d) for d, i in hits[:k]]
            if rows:
                q, i, d = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(d, pa.int32())], names=["query", "id", "distance"])

    return classes.mapInArrow(tidy(run), "query long, id long, distance int")


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k nearest (query, id, distance), ties by id."""
    order = Window.partitionBy("query").orderBy("distance", "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = TOP, exclude_self: bool = True) -> DataFrame:
    """(query, id, distance, rank): the k nearest of ``index`` (id, code) for each of
    ``queries`` (id, code), by Hamming distance, then id. Exact."""
    classes = saved(_classes(index, k + 1))
    asked = saved(queries.select(F.col("id").alias("query"), "code").distinct())
    results, block = [], []

    def answered(block):
        """All radii for one block; the block is a bounded list on the driver."""
        seen = done = None
        for radius in range(_WIDTH + 1):
            found = _round(classes, block, radius, k, exclude_self)
            best = saved(_best((found if seen is None else found.unionByName(seen.drop("rank"))).distinct(), k))
            last = radius == _WIDTH
            ready = best.where((F.col("rank") == k) & (F.col("distance") < SEGMENTS * (radius + 1))).select("query")
            finished = {r["query"] for r in ready.collect()}   # at most the block
            part = best if last else best.join(ready, "query", "left_semi")
            done = part if done is None else done.unionByName(part)
            block = [q for q in block if q[0] not in finished]
            if not block or last:
                return done
            seen = best.join(ready, "query", "left_anti")

    for row in asked.toLocalIterator():
        block.append((row["query"], row["code"]))
        if len(block) == BLOCK:
            results.append(saved(answered(block)))
            block = []
    if block or not results:
        results.append(answered(block))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def top_k(vectors: DataFrame, queries: DataFrame, dimension: int, id_: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """``search`` over the codes of ``vectors`` for the codes of ``queries``."""
    return search(codes(vectors, dimension, id_, vector), codes(queries, dimension, id_, vector), **options)
