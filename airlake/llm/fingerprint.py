"""Document fingerprints by randomised edit embedding.

A walk reads a text from its first character. At step j it writes the character under it and
then moves on or stays, as the j-th of a shared sequence of random functions of characters
says. Walks over texts that differ by an edit meet again soon after it, so edit distance
becomes Hamming distance of what is written. ``BITS`` places of the walk are sampled, each as
one random bit of the character written there. The places are ``BITS`` equal strides of
2**level steps; the level follows the length, and the places of a level are every second of
the level below, so fingerprints of different levels can be compared.

The string is two hex digits of the level, eight of the length and ``BITS`` / 4 of the bits.
Likeness is twice the share of agreeing bits minus one (0 for unrelated texts, 1 for equal
ones), over the places that the walk of either text can reach.

``near_classes`` groups near texts: bands of sampled bits give candidates, likeness verifies.

Edge cases: a null text counts as empty; two empty texts have likeness 1, an empty and another
one about 0; equal texts have equal fingerprints. The next document is the next by doc_id
(null last; equal ids by text), after the last comes the first; a table of one row is its own
next. An empty table gives an empty one. Extra columns are not read, so none can clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlake.llm.linking import cross_pairs, near_components
from airlake.llm.tables import bound_arrow, tidy

BITS, SEED = 512, 20_11
_BASE_LEVEL = BITS.bit_length() - 1
_PERIOD = 4096
_rng = np.random.default_rng(SEED)
#: Random functions of a character class for each step (class 0: the end of a text, which
#: holds the walk): move on or stay; and the bit that a sampled character becomes.
_MOVE = _rng.integers(0, 2, (_PERIOD, 256), dtype=np.uint8)
_MOVE[:, 0] = 0
_BIT = _rng.integers(0, 2, (_PERIOD, 256), dtype=np.uint8)
#: Texts walked in step with each other in numpy; the last few long ones go on one by one.
_FEW = 80
#: Documents per bucket of consecutive ids, at most so many buckets, characters walked at once.
BUCKET_ROWS, MOST_BUCKETS, GROUP_CHARS = 4096, 10_000, 12 << 20


def levels(lengths: np.ndarray) -> np.ndarray:
    """Level of each length: 2**level steps are enough for 2.5 steps a character."""
    return np.maximum(np.ceil(np.log2(2.5 * lengths + 16)).astype(int), _BASE_LEVEL)


def classes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character classes (1-255; 0 ends each text) of all texts in a row, begins and lengths."""
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.zeros(begins[-1], np.uint8)
    at = 0
    while at < len(texts):
        until = max(at + 1, int(np.searchsorted(begins, begins[at] + (1 << 20))) - 1)
        codes = np.frombuffer("\n".join(texts[at:until]).encode("utf-32-le", "surrogatepass"), np.uint32)
        wide = np.uint32(128) + ((codes * np.uint32(2654435761)) >> np.uint32(25))
        out[begins[at]: begins[at] + len(codes)] = np.maximum(np.where(codes < 128, codes, wide), 1).astype(np.uint8)
        at = until
    out[begins[1:] - 1] = 0
    return out, begins[:-1], lengths


def walk(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(levels, lengths, bits) of each text."""
    data, begins, lengths = classes(texts)
    level = levels(lengths) if len(texts) else np.empty(0, int)
    shift = level - _BASE_LEVEL
    places = (np.arange(BITS)[None, :] + 1 << shift[:, None]) - 1 if len(texts) else np.empty((0, BITS), np.int64)
    bits = _BIT[places & (_PERIOD - 1), 0]                     # of a walk that has ended
    ends = begins + lengths
    active = np.argsort(shift, kind="stable")
    active = active[lengths[active] > 0]
    at, step, most = begins[active], 0, BITS
    while len(active) > _FEW:
        cut = np.searchsorted(shift[active], np.arange(64), "right")
        moved = shift[active]
        for _ in range(64):
            sign = data[at]
            row = step & (_PERIOD - 1)
            step += 1
            low = (step & -step).bit_length() - 1              # shifts up to this one sample here
            k = cut[min(low, 63)]
            if k:
                who = active[:k]
                bits[who, np.minimum((step >> moved[:k]) - 1, most - 1)] = _BIT[row, sign[:k]]
            at = at + _MOVE[row, sign]
        on = at < ends[active]
        active, at = active[on], at[on]
    moves, marks = [r.tobytes() for r in _MOVE], [r.tobytes() for r in _BIT]
    for i, p in zip(active.tolist(), at.tolist()):
        text = data[begins[i]: ends[i] + 1].tobytes()
        p, n, s = p - int(begins[i]), int(lengths[i]), int(shift[i])
        stride, j = 1 << s, step
        for k in range(step >> s, BITS):
            last = (k + 1) * stride - 1                        # the step that is sampled
            while j < last and p < n:
                p += moves[j & 4095][text[p]]
                j += 1
            if p >= n:
                break
            sign = text[p]
            bits[i, k] = marks[last & 4095][sign]
            p += moves[last & 4095][sign]
            j = last + 1
    return level, lengths, bits


def written(level: np.ndarray, lengths: np.ndarray, bits: np.ndarray) -> list[str]:
    packed = np.packbits(bits, axis=1)
    return [f"{c:02x}{n:08x}{row.tobytes().hex()}" for c, n, row in zip(level.tolist(), lengths.tolist(), packed)]


def parsed(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    level = np.array([int(f[:2], 16) for f in fingerprints], int)
    lengths = np.array([int(f[2:10], 16) for f in fingerprints], np.int64)
    raw = np.frombuffer(bytes.fromhex("".join(f[10:] for f in fingerprints)), np.uint8).reshape(len(fingerprints), BITS // 8)
    return level, lengths, np.unpackbits(raw, axis=1)


def raised(level: np.ndarray, bits: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Bits at the places of a higher level: every second place, then the ended walk's bits."""
    out = bits.copy()
    for i in np.flatnonzero(to > level):
        step = 1 << int(to[i] - level[i])
        kept = bits[i, step - 1:: step]
        places = (np.arange(BITS) + 1 << int(to[i]) - _BASE_LEVEL) - 1
        out[i] = _BIT[places & (_PERIOD - 1), 0]
        out[i, : len(kept)] = kept
    return out


def likeness(a, b) -> np.ndarray:
    """Likeness of fingerprints pair by pair; ``a`` and ``b`` as ``walk`` returns them."""
    to = np.maximum(a[0], b[0])
    same = raised(a[0], a[2], to) == raised(b[0], b[2], to)
    stride = np.left_shift(1, to - _BASE_LEVEL)
    reach = 2 * np.maximum(a[1], b[1])
    used = np.clip(reach // stride, 1, BITS)
    agree = (same & (np.arange(BITS)[None, :] < used[:, None])).sum(1)
    score = np.maximum(2 * agree / used - 1, 0)
    return np.where((a[1] == 0) & (b[1] == 0), 1.0, score)


def consecutive(docs: DataFrame) -> DataFrame:
    """(doc_id, text, bucket, extra), sorted so that the row after a document is the next one.

    Buckets are ranges of ids between quantiles; each gets a copy (``extra``) of the rows with
    the first id of the bucket after it. Every text moves once.
    """
    spark = docs.sparkSession
    rows = docs.count()
    n = max(1, min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(n)], max(10_000, 4 * n)).alias("q"), F.min("doc_id").alias("least")).first()
    bounds = np.array(sorted({cuts.least, *(cuts.q or [])}) if cuts.least is not None else [0], np.int64)
    nowhere = cuts.least is None                               # no id at all: one bucket
    shared = spark.sparkContext.broadcast(bounds)

    @F.arrow_udf("struct<bucket:int,head:boolean>")
    def place(ids: pa.Array) -> pa.Array:
        cut = shared.value
        missing = np.array(ids.is_null())
        x = np.array(ids.fill_null(0)).astype(np.int64)
        b = np.where(missing, len(cut) - 1, np.searchsorted(cut, x, "right") - 1)
        head = np.where(missing, nowhere, cut[b] == x)
        return pa.StructArray.from_arrays([pa.array(b, pa.int32()), pa.array(head.astype(bool))], names=["bucket", "head"])

    k = len(bounds)
    own = F.struct(F.col("at.bucket").alias("bucket"), F.lit(0).alias("extra"))
    back = F.struct(((F.col("at.bucket") + k - 1) % k).cast("int").alias("bucket"), F.lit(1).alias("extra"))
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("at", place("doc_id"))
    dealt = dealt.select("doc_id", "text", F.explode(F.when(F.col("at.head"), F.array(own, back)).otherwise(F.array(own))).alias("to"))
    dealt = dealt.select("doc_id", "text", "to.bucket", "to.extra").repartition(max(k, 1), "bucket")
    return dealt.sortWithinPartitions("bucket", "extra", F.col("doc_id").asc_nulls_last(), "text")


def edited(text: str, after: str) -> str:
    """The last half of the characters replaced by the first as many of the text after it."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    of every document, where the edited text takes its end from the next document."""
    bound_arrow(docs.sparkSession)

    def results(group, after):
        """group: (doc_id, text) rows in order; after: the text that follows the last one."""
        texts = [t for _, t in group] + [after]
        mixed = [edited(t, u) for t, u in zip(texts, texts[1:])]
        n = len(mixed)
        found = walk(texts + mixed)
        part = lambda a, b: tuple(x[a:b] for x in found)
        first, after_, changed = part(0, n), part(1, n + 1), part(n + 1, None)
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in group], pa.int64()), pa.array(first[1]), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in mixed]),
            pa.array(written(*first)), pa.array(written(*changed)), pa.array(likeness(first, changed)), pa.array(likeness(first, after_))], names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        bucket, group, chars, closed = None, [], 0, False
        for batch in batches:
            for i, text, b, extra in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "extra"))):
                if b != bucket:
                    bucket, group, chars, closed = b, [], 0, False
                if closed:
                    continue
                if extra:
                    closed = True
                    if group:
                        yield results(group, text)
                    group = []
                elif chars > GROUP_CHARS:
                    yield results(group, text)
                    group, chars = [(i, text)], len(text)
                else:
                    group.append((i, text))
                    chars += len(text)

    return consecutive(docs.select("doc_id", "text")).mapInArrow(tidy(run), schema)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint`` to every row (replacing a column of that name)."""
    bound_arrow(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name.lower() != "fingerprint"]
    schema = T.StructType([*fields, T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for batch in batches:
            made = written(*walk([t or "" for t in batch.column(text).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in fields] + [pa.array(made, pa.string())], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)


def near_classes(docs: DataFrame, threshold: float = 0.8, bands: int = 24, width: int = 12) -> DataFrame:
    """(doc_id, class_id, n_links): documents whose fingerprints are linked, directly or over
    others, by a likeness of at least ``threshold``; class_id is the least fingerprint's least
    doc_id, n_links the verified links of the fingerprint.

    Equal fingerprints count once. A fingerprint is banded at its own level and the next.
    """
    prints = fingerprints(docs.select("doc_id", "text")).select("doc_id", "fingerprint")
    chosen = np.random.default_rng(7).permutation(BITS // 2)[: bands * width].reshape(bands, width) if bands * width <= BITS // 2 else \
        np.random.default_rng(7).integers(0, BITS // 2, (bands, width))

    def keys(batches):
        for batch in batches:
            prints_ = batch.column("item").to_pylist()
            level, _, bits = parsed(prints_) if prints_ else (np.empty(0, int), None, np.empty((0, BITS), np.uint8))
            for up in (0, 1):
                there = raised(level, bits, level + up)
                for b in range(bands):
                    packed = np.packbits(there[:, chosen[b]], axis=1)
                    key = [f"{c}:{b}:{row.tobytes().hex()}" for c, row in zip((level + up).tolist(), packed)]
                    yield pa.RecordBatch.from_arrays([pa.array(prints_, pa.string()), pa.array(key, pa.string())], names=["item", "key"])

    def verified(pairs: DataFrame) -> DataFrame:
        def run(batches):
            for batch in batches:
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                near = likeness(parsed(a), parsed(b)) >= threshold if a else np.zeros(0, bool)
                yield batch.filter(pa.array(near))
        return pairs.mapInArrow(tidy(run), pairs.schema)

    def rest(blocks: DataFrame) -> DataFrame:
        def run(group: pa.Table) -> pa.Table:
            names = group.column("item").to_pylist()
            all_, links = parsed(names), []
            one = group.column("lo")[0].as_py() == group.column("hi")[0].as_py()
            for x, ys in cross_pairs(np.unique(group.column("label").to_pylist(), return_inverse=True)[1], np.array(group.column("block")), one):
                near = likeness(tuple(np.repeat(v[x: x + 1], len(ys), axis=0) for v in all_), tuple(v[ys] for v in all_)) >= threshold
                links += [tuple(sorted((names[x], names[y]))) for y in ys[near]]
            return pa.table({"a": pa.array([a for a, _ in links], pa.string()), "b": pa.array([b for _, b in links], pa.string())})
        return blocks.groupBy("key", "lo", "hi").applyInArrow(run, "a string, b string")

    items = prints.select(F.col("fingerprint").alias("item")).distinct()
    classes_ = near_components(items, items.mapInArrow(tidy(keys), "item string, key string"), verified, rest)
    by_print = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    named = classes_.join(by_print, classes_.item == by_print.fingerprint).select("item", "label", "n_links", "least")
    roots = named.groupBy("label").agg(F.min("least").alias("class_id"))
    return prints.join(named.join(roots, "label").select(F.col("item").alias("fingerprint"), "class_id", "n_links"), "fingerprint").select("doc_id", "class_id", "n_links")
