"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

``encode`` cuts every text at white space into chunks that no match of the pre-tokenising
pattern crosses. The library encodes each distinct chunk once (pattern, byte table
and merges inside the library) for as long as it recurs: a worker process keeps one codec and two
generations of chunks, each of a bounded size. Ids and byte offsets of a text are
those of its chunks in order. ``decode`` turns ids back into the characters of the byte table
and these, through the reversed table, into bytes; only whole texts are read as UTF-8, so a
character split over tokens needs no care. Character offsets follow from the byte offsets.

Special tokens are never added, and their strings in a text are ordinary text.

Edge cases: a null text counts as empty and has no tokens; repeated rows get equal results;
an empty table gives an empty one. An input column named like an output column is replaced.
"""

from __future__ import annotations

import array
import gc
import hashlib
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from airlake.llm.arrowtext import slices
from airlake.llm.tables import TEXT_BATCH, TEXT_SLICE as SLICE, bound_arrow, resident, tidy, with_fields

VOCABULARY = "byte_bpe_50k.json"
#: Unicode White_Space, as the pattern's \s has it.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: No match of the pattern crosses from one chunk to another. A run of Latin letters before an
#: ASCII character that is no letter is a match of its own, with one plain space before it;
#: white space before a word is one match but for its last character, which joins the word if
#: it is a plain space.
_CHUNK = re.compile(f" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ]++(?=[\x00-@\\[-`{{-\x7f]|\\Z)|"
                    f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Distinct chunks in a generation, the longest one kept.
CACHE_CHUNKS, CACHE_LENGTH = 80_000, 40


def byte_characters() -> dict[int, str]:
    """The byte-to-character table of byte-level BPE: printable Latin-1 bytes stand for
    themselves, the others take the characters from 256 on, in order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(others)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        # a task has one core; the library's threads would each keep freed memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        back = {c: b for b, c in byte_characters().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in back for c in token):
                self.bytes_of[i] = bytes(back[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.text_of = [str(i) for i in range(len(self.bytes_of))]
        self.known: dict[str, bytes] = {}            # chunk -> its ids as int32
        self.older: dict[str, bytes] = {}            # the generation before

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (int32)."""
        cut = [_CHUNK.findall(t) for t in texts]
        if len(self.known) > CACHE_CHUNKS:
            self.known, self.older = {}, self.known
        known, long, new = self.known, {}, []
        for chunk in set(itertools.chain.from_iterable(cut)).difference(known):
            ids = self.older.get(chunk)
            if ids is None:
                new.append(chunk)
            else:
                known[chunk] = ids
        collecting = gc.isenabled()
        gc.disable()                                  # many small results, none of them in a cycle
        try:
            for at in range(0, len(new), 8192):
                part = new[at: at + 8192]
                for chunk, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                    (known if len(chunk) <= CACHE_LENGTH else long)[chunk] = array.array("i", found.ids).tobytes()
        finally:
            if collecting:
                gc.enable()
        if not long:
            return [np.frombuffer(b"".join(map(known.__getitem__, chunks)), np.int32) for chunks in cut]
        return [np.frombuffer(b"".join([known.get(c) or long[c] for c in chunks]), np.int32) for chunks in cut]

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def offsets(self, ids, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Character offsets (start, end exclusive) of each token; a token that holds a part of
        a character covers that character whole, as the library reports it."""
        ends = np.cumsum(self.lengths[ids])
        if not len(ends):
            return ends, ends
        starts = np.concatenate(([0], ends[:-1]))
        lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        before = np.concatenate(([0], np.cumsum(lead)))       # characters begun before each byte
        return before[starts] - ~lead[starts], before[ends]


def codec(path: str) -> Codec:
    """The worker process's codec, as long as it serves this operator."""
    return resident(("bpe", path), lambda: Codec(path))


def encode(docs: DataFrame, column: str = "text", path: str | None = None, offsets: bool = True, decoded: bool = False) -> DataFrame:
    """Add ``ids`` (int array), ``n_tokens`` and, with ``offsets``, ``token_starts`` and
    ``token_ends`` (character offsets, int arrays) of every whole text. ``decoded`` adds
    ``decoded_sha256``, the digest of the bytes that the ids decode to."""
    path = path or public_tokenizers.path(VOCABULARY)
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField("ids", ints), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("token_starts", ints), T.StructField("token_ends", ints)] * offsets
    fields += [T.StructField("decoded_sha256", T.StringType())] * decoded
    schema = with_fields(docs, *fields)
    kept = [f.name for f in schema.fields[: len(schema.fields) - len(fields)]]
    bound_arrow(docs.sparkSession, TEXT_BATCH)

    def run(batches):
        tool = codec(path)
        for batch in batches:
            for part in slices(batch, column, SLICE):
                texts = [t or "" for t in part.column(column).to_pylist()]
                ids = tool.encode(texts)
                new = [pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())]
                if offsets:
                    spans = [tool.offsets(x, t.encode()) for x, t in zip(ids, texts)]
                    new += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                if decoded:
                    new.append(pa.array([hashlib.sha256(tool.decode(x.tolist())).hexdigest() for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + new, names=schema.names)

    return docs.mapInArrow(tidy(run, keep=True), schema)


def decode(encoded: DataFrame, column: str = "ids", path: str | None = None) -> DataFrame:
    """Add ``decoded`` (binary): the bytes that the ids stand for. Null ids give no bytes."""
    path = path or public_tokenizers.path(VOCABULARY)
    schema = with_fields(encoded, T.StructField("decoded", T.BinaryType()))
    bound_arrow(encoded.sparkSession, TEXT_BATCH)

    def run(batches):
        tool = codec(path)
        for batch in batches:
            raw = [tool.decode(x or ()) for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in schema.names[:-1]] + [pa.array(raw, pa.binary())], names=schema.names)

    return encoded.mapInArrow(tidy(run, keep=True), schema)


def round_trip(docs: DataFrame, keep: list[str], column: str = "text", path: str | None = None) -> DataFrame:
    """Encode every text and decode its ids in one pass, keeping digests instead of the ids.

    Columns: ``keep``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space),
    ``decoded_sha256`` (decoded bytes), ``n_split`` (tokens that end inside a character).
    """
    path = path or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()), T.StructField("n_split", T.LongType())])
    bound_arrow(docs.sparkSession, TEXT_BATCH)

    def run(batches):
        tool = codec(path)
        for batch in batches:
            for part in slices(batch, column, SLICE):
                counts, hashed, decoded, split = [], [], [], []
                for ids in tool.encode([t or "" for t in part.column(column).to_pylist()]):
                    listed = ids.tolist()
                    raw = tool.decode(listed)
                    counts.append(len(listed))
                    hashed.append(hashlib.sha256(" ".join(map(tool.text_of.__getitem__, listed)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(raw).hexdigest())
                    inner = np.frombuffer(raw, np.uint8)[np.cumsum(tool.lengths[ids])[:-1]]
                    split.append(int(((inner & 0xC0) == 0x80).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [pa.array(counts, pa.int64()), pa.array(hashed), pa.array(decoded), pa.array(split, pa.int64())],
                    names=schema.names)

    return docs.mapInArrow(tidy(run, keep=True), schema)
