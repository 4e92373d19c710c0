"""Removal of repeated passages with sharded phrase automata.

A window is ``WINDOW`` consecutive words of one text; a window recurs if its words also start
anywhere else. Every word that a recurring window covers is removed.

1. *Anchors.* Among the runs of ``GRAM`` words in a window, the one of least hash is the
   window's anchor. Equal windows have equal anchors, so only windows whose anchor occurs at
   two places can recur. Anchors are few (about one in 14 words) and are counted by Spark.
2. *Confirmed passages.* Windows with such an anchor are counted by hash (64 bits and 31 bits
   of the anchor's), dealt by the window's hash and merged once per document shard before.
3. *Automata.* Documents lie in shards of about ``SHARD_ROWS``. The confirmed passages of a
   shard's documents are cut into tiles of ``WINDOW`` words; the tiles are compiled into one
   pyahocorasick automaton per shard over word numbers, and all documents of the shard are
   streamed through it. Every hit is an occurrence; tiles cover a passage whole.

A common passage reaches a task at most once for each shard. The shuffled documents are used
by both passes. Words are compared by 64-bit hashes, always in runs of 35.

Edge cases: a null text has no words; texts below 35 words keep all; repeated rows are texts
of their own, so their passages recur; overlapping occurrences within a text count; an empty
table gives an empty one. Extra columns are not read, so none can clash.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.arrowtext import Words, gram_hashes, mix64, slices
from airlake.llm.tables import bound_arrow, tidy

WINDOW, GRAM, SHARD_ROWS = 35, 8, 1024
_PLACE = np.uint64(4095)


def _rolling_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` elements."""
    have, least = 1, x
    while have * 2 <= width:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


class Windows:
    """Windows of all texts of a column, in order: text, first word, hash, anchor."""

    def __init__(self, column: pa.Array, hashes: bool = True):
        self.words = words = Words(column)
        counts = np.maximum(words.counts() - WINDOW + 1, 0)
        #: text i has the windows ranges[i] to ranges[i + 1]
        self.ranges = np.concatenate(([0], np.cumsum(counts)))
        n = int(self.ranges[-1])
        self.anchors = self.runs = np.empty(0, np.uint64)
        self.lengths = np.empty(0, np.int64)
        if not n:
            self.hashes = np.empty(0, np.uint64)
            return
        grams, of = gram_hashes(words.hashes, words.bounds, GRAM, seed=1)
        # the low bits hold the place, so that of equal grams the first one in the window is taken
        span = WINDOW - GRAM + 1
        placed = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
        least = _rolling_min(placed, span)
        starts = np.repeat(of[:-1], counts) + (np.arange(n) - np.repeat(self.ranges[:-1], counts))
        least = least[starts]
        place = starts + ((least.astype(np.int64) - starts) & int(_PLACE))
        # in windows over the end of the low bits' range, the first is found without them
        over = np.flatnonzero((starts & int(_PLACE)) + span - 1 > int(_PLACE))
        if len(over):
            near = starts[over, None] + np.arange(span)
            place[over] = starts[over] + (grams[near] & ~_PLACE).argmin(1)
            least[over] = placed[place[over]]
        text = np.repeat(np.arange(len(counts)), counts)
        change = np.ones(n, bool)
        change[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        #: one entry for each anchor place: its hash, its text, how many windows it has
        begins = np.flatnonzero(change)
        self.runs, self.run_text = least[begins] >> np.uint64(12), text[begins]
        self.lengths = np.diff(np.append(begins, n))
        if hashes:
            self.hashes = gram_hashes(words.hashes, words.bounds, WINDOW)[0]

    def anchor_of(self) -> np.ndarray:
        return np.repeat(self.runs, self.lengths)


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which elements occur in a sorted array."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)
    return ordered[at] == x


def _anchor_counts(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            windows = Windows(part.column("text"), hashes=False)
            if not len(windows.runs):
                continue
            shard = np.array(part.column("shard"))[windows.run_text]
            order = np.lexsort((windows.runs, shard))
            h, s = windows.runs[order], shard[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(h)))
            yield pa.RecordBatch.from_arrays([pa.array(h[at].astype(np.int64)), pa.array(s[at].astype(np.int32)), pa.array(n.astype(np.int64))], names=["anchor", "shard", "n"])


def _candidates(dealers: int):
    """Hashes of a shard's windows whose anchor occurs twice, one blob per dealer."""
    def run(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        known = np.unique(np.array(anchors.column("anchor")).astype(np.uint64)) if anchors.num_rows else np.empty(0, np.uint64)
        found, marks = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for batch in docs.combine_chunks().to_batches() if len(known) else []:
            for part in slices(batch, "text"):
                windows = Windows(part.column("text"))
                if len(windows.runs):
                    hot = np.repeat(_among(windows.runs, known), windows.lengths)
                    found.append(windows.hashes[hot])
                    marks.append(windows.anchor_of()[hot])
        hashes, mark = np.concatenate(found), np.concatenate(marks)
        hashes, first, n = np.unique(hashes, return_index=True, return_counts=True)
        mark = ((mark[first] << np.uint64(1)) & np.uint64(0xFFFFFFFE)).astype(np.uint32) | (n > 1).astype(np.uint32)
        to = (mix64(hashes) % np.uint64(dealers)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        hashes, mark, to = hashes[order], mark[order], to[order]
        cuts = np.flatnonzero(np.diff(to)) + 1
        dealt = to[np.concatenate(([0], cuts))] if len(to) else to
        shard = docs.column("shard")[0].as_py() if docs.num_rows else 0
        return pa.table({"dealer": pa.array(dealt.astype(np.int32)), "shard": pa.array(np.full(len(dealt), shard, np.int32)),
                         "hashes": pa.array([x.tobytes() for x in np.split(hashes, cuts)] if len(to) else [], pa.binary()),
                         "marks": pa.array([x.tobytes() for x in np.split(mark, cuts)] if len(to) else [], pa.binary())})
    return run


def _recurring(blobs: pa.Table) -> pa.Table:
    """Of each shard's windows, those that another shard has too or the shard has twice."""
    hashes = [np.frombuffer(x, np.uint64) for x in blobs.column("hashes").to_pylist()]
    marks = [np.frombuffer(x, np.uint32) for x in blobs.column("marks").to_pylist()]
    shard = np.repeat(np.array(blobs.column("shard")), [len(x) for x in hashes])
    h, m = np.concatenate(hashes), np.concatenate(marks)
    order = np.lexsort((m >> np.uint32(1), h))
    h, m, shard = h[order], m[order], shard[order]
    same = (h[1:] == h[:-1]) & (m[1:] >> np.uint32(1) == m[:-1] >> np.uint32(1))
    again = (m & np.uint32(1)).astype(bool)
    again[1:] |= same
    again[:-1] |= same
    h, shard = h[again], shard[again]
    order = np.argsort(shard, kind="stable")
    h, shard = h[order], shard[order]
    cuts = np.flatnonzero(np.diff(shard)) + 1
    return pa.table({"shard": pa.array(shard[np.concatenate(([0], cuts))].astype(np.int32) if len(h) else np.empty(0, np.int32)),
                     "hashes": pa.array([x.tobytes() for x in np.split(h, cuts)] if len(h) else [], pa.binary())})


def automaton(tiles: list[tuple[int, ...]]) -> ahocorasick.Automaton | None:
    """One automaton over sequences of word numbers; None without tiles."""
    if not tiles:
        return None
    out = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for tile in tiles:
        out.add_word(tile)
    out.make_automaton()
    return out


def _tile_starts(again: np.ndarray) -> np.ndarray:
    """Windows, out of runs of recurring ones, that cover the runs' words: every ``WINDOW``-th
    and the last of each run."""
    edge = np.diff(np.concatenate(([0], again.astype(np.int8), [0])))
    out = [np.append(np.arange(a, b, WINDOW), b - 1) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)


def _removal(docs: pa.Table, confirmed: pa.Table, finish) -> pa.Table:
    """Cover of each of a shard's texts, by its automaton; ``finish(part, words, masks)`` makes
    the rows of the texts of one part."""
    known = np.unique(np.concatenate([np.empty(0, np.uint64)] + [np.frombuffer(x, np.uint64) for x in confirmed.column("hashes").to_pylist()]))
    parts, tiles, seen = [], {}, []
    for batch in docs.combine_chunks().to_batches():
        for part in slices(batch, "text"):
            parts.append(part)
            words = Words(part.column("text"))
            seen.append(words)
    if not parts:
        return None
    numbers = np.unique(np.concatenate([w.hashes for w in seen]), return_inverse=True)[1].astype(np.int64)
    at, numbered = 0, []
    for words in seen:
        numbered.append(numbers[at: at + len(words.hashes)])
        at += len(words.hashes)
    for words, number in zip(seen, numbered) if len(known) else ():
        hashes, ranges = gram_hashes(words.hashes, words.bounds, WINDOW)
        again = _among(hashes, known)
        for i in np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(again)))[ranges])):
            first = words.bounds[i]
            for s in _tile_starts(again[ranges[i]: ranges[i + 1]]):
                key = int(hashes[ranges[i] + s])
                if key not in tiles:
                    tiles[key] = tuple(number[first + s: first + s + WINDOW].tolist())
    machine = automaton([*tiles.values()])
    out = []
    for part, words, number in zip(parts, seen, numbered):
        masks = []
        for a, b in zip(words.bounds[:-1], words.bounds[1:]):
            cover = None
            if machine is not None and b - a >= WINDOW:
                ends = [end for end, _ in machine.iter(tuple(number[a:b].tolist()))]
                if ends:
                    edge = np.zeros(b - a + 1, np.int32)
                    ends = np.array(ends)
                    np.add.at(edge, ends - WINDOW + 1, 1)
                    np.add.at(edge, ends + 1, -1)
                    cover = np.cumsum(edge[:-1]) > 0
            masks.append(cover)
        out.append(finish(part, masks))
    return pa.Table.from_batches(out)


def _kept(raw: bytes, cover) -> tuple[int, int, bytes]:
    words = raw.split()                                       # bytes.split() splits on the same six bytes
    if cover is None:
        return len(words), 0, b" ".join(words)
    return len(words), int(cover.sum()), b" ".join([w for w, gone in zip(words, cover.tolist()) if not gone])


def _shard(shards: int):
    """A document's shard. An empty text has no windows, so any shard will do: such rows, however
    many are alike, spread out. Others are dealt by what they hold, so re-run tasks agree."""
    dealt = F.when(F.col("text") == "", F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64("doc_id", "text"))
    return F.pmod(dealt, F.lit(shards)).cast("int")


def _passes(docs: DataFrame, finish, schema: str) -> DataFrame:
    bound_arrow(docs.sparkSession)
    shards = max(1, -(-docs.count() // SHARD_ROWS))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("shard", _shard(shards))
    counted = rows.select("text", "shard").mapInArrow(tidy(_anchor_counts), "anchor long, shard int, n long")
    total = counted.withColumn("total", F.expr("sum(n) OVER (PARTITION BY anchor)"))
    anchors = total.where("total > 1").select("shard", "anchor")
    grouped = rows.groupBy("shard")
    blobs = grouped.cogroup(anchors.groupBy("shard")).applyInArrow(_candidates(shards), "dealer int, shard int, hashes binary, marks binary")
    confirmed = blobs.groupBy("dealer").applyInArrow(_recurring, "shard int, hashes binary")

    def last(docs_: pa.Table, found: pa.Table) -> pa.Table:
        done = _removal(docs_, found, finish)
        return done if done is not None else pa.table({n: pa.array([], t) for n, t in kinds})

    kinds = [(x.split()[0], {"long": pa.int64(), "string": pa.string()}[x.split()[1]]) for x in schema.split(", ")]
    return grouped.cogroup(confirmed.groupBy("shard")).applyInArrow(last, schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space) of every row."""
    def finish(part, masks):
        rows = [_kept((t or "").encode(), m) for t, m in zip(part.column("text").to_pylist(), masks)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return _passes(docs, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text (kept words joined by one space), n_words, n_removed of every row."""
    def finish(part, masks):
        rows = [_kept((t or "").encode(), m) for t, m in zip(part.column("text").to_pylist(), masks)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([r[2].decode() for r in rows], pa.string()), pa.array([r[0] for r in rows], pa.int64()),
                                           pa.array([r[1] for r in rows], pa.int64())], names=["doc_id", "text", "n_words", "n_removed"])
    return _passes(docs, finish, "doc_id long, text string, n_words long, n_removed long")


#: ``digests`` of ``documents`` in DuckDB SQL.
ORACLE = r"""
with texts as (select row_number() over () as row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
places as (select row_id, unnest(range(1, len(w) + 1)) as p, w from texts),
words as (select row_id, p, w[p] as word, case when p + 34 <= len(w) then md5(array_to_string(w[p:p + 34], ' ')) end as passage from places),
counted as (select *, passage is not null and count(*) over (partition by passage) > 1 as again from words),
covered as (select *, bool_or(again) over (partition by row_id order by p rows between 34 preceding and current row) as gone from counted),
kept as (select row_id, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by p) filter (not gone) as kept from covered group by row_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (row_id)
"""
