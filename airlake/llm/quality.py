"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

*Vectors.* A text's byte trigrams are hashed into ``BINS``; their damped counts are weighted
by inverse document frequency, which Spark counts over all documents, and scaled to length 1.
A few style terms follow: the shares of words that repeat the word before, of words that
occurred before, of capitals, of signs and of digits.
A truncated SVD of a bounded sample of labelled rows gives the latent axes; every text is
projected on them and scaled to length 1 again.

*Votes.* The labelled vectors (``SAMPLE_ROWS`` x ``AXES`` floats at most, whatever the
corpus) are broadcast. Each task takes exact cosine products of its documents, in blocks, with
all of them; the ``NEIGHBOURS`` nearest vote with the power ``SHARPNESS`` of their cosine.

Edge cases: texts below three bytes, empty and null texts have a zero vector and get the mean
label of the sample; equal texts get equal scores; ties in cosine are broken by the sample's
order; without labels every score is 0.5; an empty table gives an empty one. Input columns
named like an output column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlake.llm.arrowtext import Words, slices, utf8
from airlake.llm.tables import bound_arrow, tidy
from airlake.llm.toxicity import labelled_sample

#: Bounds of the learned part and of the vectors.
SAMPLE_ROWS, BINS, AXES, NEIGHBOURS, SHARPNESS = 4096, 2048, 64, 15, 4
THRESHOLD, STYLE = 0.7, 1.5


#: Kind of each byte: 1 capital, 2 sign, 3 digit.
_KINDS = np.array([1 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else 2 if 33 <= b < 127 and not chr(b).isalnum() else 0 for b in range(256)], np.uint8)


def trigram_counts(column: pa.Array) -> np.ndarray:
    """Damped counts (1 + log n) of hashed byte trigrams, one row per text."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n, BINS), np.float32)
    d = data.astype(np.uint32)
    code = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - BINS.bit_length() + 1)
    text = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    inside = text[:-2] == text[2:]
    counts = np.bincount((text[:-2] * BINS + code)[inside], minlength=n * BINS).reshape(n, BINS).astype(np.float32)
    np.log1p(counts, out=counts)
    return counts


def style(column: pa.Array) -> np.ndarray:
    """Shares (0 to 1) of repeated, recurring, capital, sign and digit parts, one row per text."""
    words = Words(column)
    n = len(words.bounds) - 1
    text = np.repeat(np.arange(n), words.counts())
    many = np.maximum(words.counts(), 1)
    h = words.hashes
    again = np.bincount(text[1:][(h[1:] == h[:-1]) & (text[1:] == text[:-1])], minlength=n) if len(h) else np.zeros(n)
    order = np.lexsort((h, text))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct = np.bincount(text[order][new], minlength=n)
    size = np.maximum(np.diff(words.offsets), 1)
    sums = [np.diff(np.concatenate(([0], np.cumsum(_KINDS[words.data] == k)))[words.offsets]) / size for k in (1, 2, 3)]
    return np.stack([again / many, 1 - np.maximum(distinct, words.counts() == 0) / many, *sums], axis=1).astype(np.float32)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each bin occurs, over all documents; and the number of texts."""
    bound_arrow(docs.sparkSession)

    def run(batches):
        seen, n = np.zeros(BINS, np.int64), 0
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                for at in range(0, part.num_rows, 512):
                    seen += (trigram_counts(part.column(text).slice(at, 512)) > 0).sum(0)
                n += part.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(BINS), -1)), pa.array(np.append(seen, n))], names=["bin", "n"])

    rows = docs.select(text).mapInArrow(tidy(run), "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(rows.column("bin").to_pylist(), rows.column("n").to_pylist()))
    return np.array([found.get(b, 0) for b in range(BINS)], float), found.get(-1, 0)


def unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def latent_axes(x: np.ndarray, axes: int, seed: int = 0) -> np.ndarray:
    """Leading right singular vectors (columns) of ``x``, by randomised subspace iteration."""
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(axes + 16, min(x.shape)))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :axes].astype(np.float32)


def terms(counts: np.ndarray, shares: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.concatenate([unit(counts * idf), STYLE * shares], axis=1)


class Model:
    def __init__(self, idf, axes, vectors, labels):
        self.idf, self.axes, self.vectors, self.labels = idf, axes, vectors, labels

    def project(self, column: pa.Array) -> np.ndarray:
        return unit(terms(trigram_counts(column), style(column), self.idf) @ self.axes)

    def vote(self, column: pa.Array) -> np.ndarray:
        """Scores of a block of texts."""
        if not len(self.labels):
            return np.full(len(column), 0.5)
        cosine = self.project(column) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(float) ** SHARPNESS
        total = weight.sum(1)
        mean = float(self.labels.mean())
        return np.where(total > 0, (weight * self.labels[near]).sum(1) / np.where(total > 0, total, 1), mean)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """The model from all documents (frequencies) and a bounded sample of labelled rows.

    ``labels`` (doc_id, label) must hold only rows that may be learned from.
    """
    seen, n = document_frequencies(docs)
    idf = np.log((n + 1) / (seen + 1)).astype(np.float32) + 0.1
    sample = labelled_sample(labels.select("doc_id", label), label, rows)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                raw = np.concatenate([trigram_counts(part.column("text")), style(part.column("text"))], axis=1).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array([r.tobytes() for r in raw], pa.binary())], names=["doc_id", "y", "raw"])

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", F.col(label).cast("int").alias("y"), "text")
    # a repeated id counts once, so the sample stays within its bound
    texts = texts.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("text").alias("text"))
    table = texts.mapInArrow(tidy(run), "doc_id long, y int, raw binary").toArrow().sort_by("doc_id")
    if not table.num_rows:
        return Model(idf, np.zeros((BINS + 5, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    x = np.stack([np.frombuffer(r, np.float16) for r in table.column("raw").to_pylist()]).astype(np.float32)
    x = terms(x[:, :BINS], x[:, BINS:], idf)
    axes = latent_axes(x, AXES)
    return Model(idf, axes, unit(x @ axes), table.column("y").to_numpy().astype(float))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) to every row."""
    bound_arrow(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in docs.schema.fields if f.name.lower() != "score"]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                for at in range(0, part.num_rows, 512):
                    block = part.slice(at, 512)
                    yield pa.RecordBatch.from_arrays([block.column(f.name) for f in fields] + [pa.array(model.vote(block.column(text)))], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)
