"""Merkle manifest of a dataset, and the proof of every row by pointer jumping.

Rows are leaves. The leaves of a group, in order, form a binary tree: every two consecutive nodes
become the hash of their hashes (hex text), an odd last one the hash of itself, until one node, the
subroot, remains. The subroots in group order form the top tree, whose last node is the root.

``manifest`` numbers the leaves by one range sort (no group is ever in one task), then grows the
trees by ``BLOCK_LEVELS`` levels a pass: a task's group is a block of at most 256 consecutive nodes.
``proofs`` lets every node hold the segment of siblings towards an ancestor, at first its parent.
A self-join of the nodes doubles the ancestor's distance and concatenates the segments; after d
rounds only the nodes of levels that 2^d divides are needed, and those of the top tree. When every
leaf's ancestor is the root, its segment is its proof. All proofs are as long as the path, so the
work is n log n hashes of bytes moved, in log log n rounds.

Ancestors of a join are balanced by construction (2^distance nodes below each). Where few of them
remain, so that nodes would pile up on a key, their number is known from the sizes of the trees and
they are broadcast (``BROADCAST_BYTES``).

Edge cases: nulls are hashed as ``-`` and sort first; a text of any length is hashed whole; rows of
one id are ordered by their leaf hash and, if that is equal too, are interchangeable, so their
proofs are those of neighbouring leaves; the root does not depend on the order they are read in. An
empty table has no rows and no root. Names of other columns do not matter: only the named ones are
read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.tables import saved

#: Levels that one pass grows: a block holds at most 2 ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 8
#: Bytes of node rows, by their proven number, up to which they are broadcast.
BROADCAST_BYTES = 16 << 20
#: Groups (and their parts) up to which the table of their sizes is broadcast: under 2 MB.
BROADCAST_GROUPS = 10_000
#: Number of the top tree; the trees of the groups are numbered from 0 in group order.
TOP = -1
#: A proof is a sequence of steps of 33 bytes: the side of the sibling, and its hash.
STEP, ALONE, LEFT, RIGHT = 33, 0, 1, 2

#: One pass over a block: ``row`` holds the hashes of the level reached, ``out`` all nodes below it.
_PASS = """aggregate(sequence(1, least({bits}, height - {level})),
  struct({level} AS level, shiftleft(block, {bits}) AS base, transform(members, m -> m.hash) AS row,
    cast(array() AS array<struct<level: int, idx: bigint, hash: string, sibling: string>>) AS out),
  (acc, k) -> struct(acc.level + 1 AS level, shiftright(acc.base, 1) AS base,
    transform(sequence(0, shiftright(size(acc.row) + 1, 1) - 1),
      j -> sha2(concat(get(acc.row, 2 * j), coalesce(get(acc.row, 2 * j + 1), '')), 256)) AS row,
    concat(acc.out, transform(acc.row, (h, i) -> struct(acc.level AS level, acc.base + i AS idx, h AS hash, get(acc.row, i ^ 1) AS sibling))) AS out))"""
#: The steps of a proof as structs (side, hash in hex); the root they give; the hash of the siblings.
_STEPS = f"""transform(if(length(proof) > 0, sequence(0, cast(length(proof) / {STEP} AS int) - 1), cast(array() AS array<int>)),
  i -> struct(ascii(substring(proof, i * {STEP} + 1, 1)) AS side, lower(hex(substring(proof, i * {STEP} + 2, {STEP - 1}))) AS hash))"""
_FOLD = f"""aggregate(path, {{leaf}}, (below, s) -> sha2(
  CASE s.side WHEN {LEFT} THEN concat(s.hash, below) WHEN {RIGHT} THEN concat(below, s.hash) ELSE below END, 256))"""
_SIBLINGS = f"sha2(array_join(transform(filter(path, s -> s.side <> {ALONE}), s -> s.hash), ''), 256)"


def field_hash(*fields: Column) -> Column:
    """Hash of fields: each ``-`` if null, else its length in UTF-8 bytes, ``:`` and its text."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves: the bit length of n - 1."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _levels(n: int) -> int:
    return max(n - 1, 0).bit_length()


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Number the rows of every group from 0 in ``order``, without a window over a group.

    One range sort over all rows deals a hot group to many tasks. Returns the saved rows with
    ``__part`` and ``__at``, and for each (group, part) its first place ``first``, the rows of the
    group ``before`` it and in it, ``n``. A row's number is ``__at - first + before``. Rows that
    tie in ``order`` are told apart by where they were read, so a hot key is split as well.
    """
    by = [group, *order, "__tie"]
    ranged = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = saved(ranged.drop("__tie").withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__at", 33).cast("int"))
    parts = placed.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("first"))
    whole = Window.partitionBy(group)                         # at most one row for each task of the sort
    so_far = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return placed, parts.select(group, "__part", "first", F.coalesce(F.sum("__rows").over(so_far), F.lit(0)).alias("before"),
                                F.sum("__rows").over(whole).alias("n"))


def _small(df: DataFrame, is_small: bool) -> DataFrame:
    return F.broadcast(df) if is_small else df


@dataclass
class Manifest:
    """``leaves``: the given columns with ``leaf``, ``tree``, ``idx``, ``n`` (leaves of the tree)
    and ``subroot``; ``nodes``: (tree, level, idx, hash, sibling, height), all but the roots of the
    trees; ``root``: None for an empty table; ``highest``, ``trees``, ``rows``: longest path to the
    root, number of groups, of leaves."""
    leaves: DataFrame
    nodes: DataFrame
    root: str | None
    highest: int
    trees: int
    rows: int


def _grow(leaves: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Nodes and roots of trees from their leaves (tree, idx, hash, n); ``most``: largest ``n``."""
    here, nodes, roots = leaves.withColumn("height", _height(F.col("n"))), [], []
    for level in range(0, max(_levels(most), 1), BLOCK_LEVELS):
        roots.append(here.where(F.col("height") == level).select("tree", "hash"))
        block = F.shiftright("idx", BLOCK_LEVELS)
        blocks = (here.where(F.col("height") > level).groupBy("tree", block.alias("block"), "height")
                  .agg(F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("members")))
        grown = saved(blocks.select("tree", "block", "height", F.expr(_PASS.format(level=level, bits=BLOCK_LEVELS)).alias("grown")))
        nodes.append(grown.select("tree", "height", F.inline("grown.out")))
        here = grown.select("tree", F.col("block").alias("idx"), F.get("grown.row", F.lit(0)).alias("hash"), "height", F.col("grown.level").alias("at"))
        roots.append(here.where(F.col("height") == F.col("at")).select("tree", "hash"))
        here = here.where(F.col("height") > F.col("at")).drop("at")
    everything = nodes[0]
    for more in nodes[1:]:
        everything = everything.unionByName(more)
    every_root = roots[0]
    for more in roots[1:]:
        every_root = every_root.unionByName(more)
    return everything, every_root


def manifest(rows: DataFrame, key: str, group: str, leaf: str = "leaf") -> Manifest:
    """The trees over ``rows``: leaves of a ``group`` ascend by ``key`` (nulls first), groups by
    their bytes (null first); ``leaf`` holds each row's hash."""
    # a text of its own order: null before all others
    named = rows.withColumn("__group", F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")))
    placed, parts = numbered(named, "__group", [key, leaf])
    parts = saved(parts)
    groups = parts.groupBy("__group").agg(F.max("n").alias("n"))
    most, trees, rows_in_all = [x or 0 for x in groups.agg(F.max("n"), F.count(F.lit(1)), F.sum("n")).first()]
    n_parts = parts.count()
    if trees <= 1:
        ranks = groups.withColumn("tree", F.lit(0).cast("bigint"))
    else:
        listed, order = numbered(groups.withColumn("__all", F.lit("")), "__all", ["__group"])
        few = trees <= BROADCAST_GROUPS
        ranks = listed.join(_small(order.drop("n"), few), ["__all", "__part"]).select("__group", "n", (F.col("__at") - F.col("first") + F.col("before")).alias("tree"))
    few = n_parts <= BROADCAST_GROUPS
    # a (group, part) holds at most what one task of the sort held, so this join has no hot key
    parts = saved(parts.drop("n").join(_small(ranks, trees <= BROADCAST_GROUPS), "__group"))
    at = (F.col("__at") - F.col("first") + F.col("before")).alias("idx")

    def located(parts: DataFrame, *more: str) -> DataFrame:
        joined = placed.join(_small(parts, few), ["__group", "__part"])
        return joined.select(*rows.columns, "tree", at, "n", *more)

    nodes, subroots = _grow(located(parts).select("tree", "idx", F.col(leaf).alias("hash"), "n"), most)
    subroots = saved(subroots)
    top, roots = _grow(subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("idx"), "hash", F.lit(trees).cast("bigint").alias("n")), trees)
    root = roots.first()
    with_root = parts.join(_small(subroots.withColumnRenamed("hash", "subroot"), trees <= BROADCAST_GROUPS), "tree")
    return Manifest(located(with_root, "subroot"), nodes.unionByName(top), root and root["hash"],
                    _levels(most) + _levels(trees), trees, rows_in_all)


def proofs(made: Manifest) -> DataFrame:
    """(tree, idx, proof) of every leaf of every tree whose path to the root has a step: pointer
    jumping over the nodes. A lone leaf's start is its place in the top tree."""
    top_height = _levels(made.trees)
    c = F.col
    step = F.expr(f"""CASE WHEN sibling IS NULL THEN unhex('{ALONE:02x}{'00' * (STEP - 1)}')
        WHEN idx % 2 = 1 THEN concat(unhex('{LEFT:02x}'), unhex(sibling)) ELSE concat(unhex('{RIGHT:02x}'), unhex(sibling)) END""")
    # null where the parent, and so the segment's end, is the root
    parent = F.expr(f"""if(tree <> {TOP} AND level + 1 = height,
        if({top_height} = 0, null, named_struct('tree', {TOP}L, 'level', 0, 'idx', tree)),
        if(tree = {TOP} AND level + 1 = {top_height}, null, named_struct('tree', tree, 'level', level + 1, 'idx', shiftright(idx, 1))))""")
    held = made.nodes.select("tree", "level", "idx", step.alias("segment"), parent.alias("up"))
    distance = 1
    while distance < made.highest:
        held = saved(held)
        needed = held.where((c("tree") == TOP) | (c("level") % (2 * distance) == 0))
        target = held.where((c("tree") == TOP) | (c("level") >= distance)).select(
            F.expr("named_struct('tree', tree, 'level', level, 'idx', idx) AS at"), c("segment").alias("more"), c("up").alias("further"))
        # a segment at the root joins nothing, under a key of its own
        needed = needed.withColumn("at", F.expr(f"coalesce(up, named_struct('tree', {TOP - 1}L, 'level', level, 'idx', idx))"))
        bound = math.ceil(2 * made.rows / 2 ** min(distance, 62)) + (64 + 2) * made.trees
        joined = needed.join(_small(target, bound * (STEP * distance + 64) <= BROADCAST_BYTES), "at", "left")
        held = joined.select("tree", "level", "idx", F.expr("concat(segment, coalesce(more, X''))").alias("segment"), c("further").alias("up"))
        distance *= 2
    return held.where(c("level") == 0).select("tree", "idx", c("segment").alias("proof"))


def with_proofs(made: Manifest) -> DataFrame:
    """The leaves with ``proof`` (binary; empty where the leaf is the root) and its steps ``path``."""
    alone = F.col("n") == 1
    start = made.leaves.withColumns({"__tree": F.when(alone, F.lit(TOP).cast("bigint")).otherwise(F.col("tree")),
                                     "__idx": F.when(alone, F.col("tree")).otherwise(F.col("idx"))})
    found = proofs(made).select(F.col("tree").alias("__tree"), F.col("idx").alias("__idx"), "proof")
    return start.join(found, ["__tree", "__idx"], "left").drop("__tree", "__idx").withColumn(
        "proof", F.expr("coalesce(proof, X'')")).withColumn("path", F.expr(_STEPS))


def folded(leaf: str) -> Column:
    """The root that a leaf, an SQL expression, and the steps ``path`` give."""
    return F.expr(_FOLD.format(leaf=leaf))


def tampered(doc_id: Column) -> Column:
    """Rows that the report tampers with: 7 divides the crc32 of the decimal id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof digest of every document, and what its proof makes of a row
    whose ``n_chars`` has been raised by 1 where ``tampered`` says so."""
    c = F.col
    longer = c("n_chars") + F.when(tampered(c("doc_id")), 1).otherwise(0)
    hashed = docs.select("doc_id", "lang", field_hash(*map(c, FIELDS)).alias("leaf"),
                         F.when(tampered(c("doc_id")) & c("n_chars").isNotNull(), field_hash(c("doc_id"), c("source"), c("lang"), longer, c("text"))).alias("altered"))
    made = manifest(saved(hashed), "doc_id", "lang")          # texts are read once; hashes travel
    out = with_proofs(made).select("doc_id", "leaf", "subroot", F.lit(made.root).cast("string").alias("root"), F.expr(_SIBLINGS).alias("proof_sha256"),
                                   folded("coalesce(altered, leaf)").alias("folded_root"))
    return out.withColumn("verified", c("folded_root") == c("root"))


#: Fields of a document's leaf, in their fixed order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _sql_hash(*fields: str) -> str:
    texts = [f"cast({f} as varchar)" for f in fields]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


#: crc32 of the decimal id: for each digit its code is mixed in, then eight steps of the register.
_SQL_CRC = """xor(cast(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(cast(doc_id as varchar), ''),
      lambda d: list_concat([ascii(d)::bigint], [-1, -1, -1, -1, -1, -1, -1, -1]::bigint[])))),
    lambda r, b: case when b >= 0 then xor(r, b) else xor(r >> 1, case when r & 1 = 1 then 3988292384 else 0 end) end) as bigint), 4294967295)"""

#: The same report in DuckDB SQL, over ``documents``.
ORACLE = f"""
with recursive hashed as (
  select doc_id, lang, {_sql_hash(*FIELDS)} as leaf,
    {_sql_hash("doc_id", "source", "lang", f"n_chars + case when {_SQL_CRC} % 7 = 0 then 1 else 0 end", "text")} as used
  from documents),
trees as (select lang, row_number() over (order by lang nulls first) - 1 as tree from hashed group by lang),
leaves as (
  select doc_id, leaf, case when doc_id is null then leaf else used end as used, tree,
    row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by tree) as n
  from hashed join trees on hashed.lang is not distinct from trees.lang),
nodes(tree, level, idx, n, hash) as (
  select tree, 0, idx, n, leaf from leaves
  union all
  select tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' order by idx)) from nodes where n > 1 group by tree, level, idx // 2, n),
subroots as (select tree, hash, level as height from nodes where n = 1),
top(level, idx, n, hash) as (
  select 0, tree, (select count(*) from trees), hash from subroots
  union all
  select level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' order by idx)) from top where n > 1 group by level, idx // 2, n),
path as (
  select l.tree, l.idx, own.level as place, own.idx % 2 as odd, s.hash as sibling
  from leaves l join nodes own on own.tree = l.tree and own.n > 1 and own.idx = l.idx >> own.level
    left join nodes s on s.tree = own.tree and s.level = own.level and s.idx = xor(own.idx, 1)
  union all
  select l.tree, l.idx, r.height + own.level, own.idx % 2, s.hash
  from leaves l join subroots r using (tree) join top own on own.n > 1 and own.idx = l.tree >> own.level
    left join top s on s.level = own.level and s.idx = xor(own.idx, 1)),
folded(tree, idx, place, hash) as (
  select tree, idx, 0, used from leaves
  union all
  select f.tree, f.idx, f.place + 1, sha256(case when p.sibling is null then f.hash when p.odd = 1 then p.sibling || f.hash else f.hash || p.sibling end)
  from folded f join path p on p.tree = f.tree and p.idx = f.idx and p.place = f.place),
ends as (select tree, idx, arg_max(hash, place) as folded_root from folded group by tree, idx),
proofs as (select tree, idx, string_agg(sibling, '' order by place) as siblings from path group by tree, idx)
select doc_id, leaf, r.hash as subroot, t.hash as root, sha256(coalesce(siblings, '')) as proof_sha256, folded_root, folded_root = t.hash as verified
from leaves join subroots r using (tree) join (select hash from top where n = 1) t on true
  join ends using (tree, idx) left join proofs using (tree, idx)
"""
