"""Exact token counts of every prefix of a text, by prefix dynamic programming over BPE pieces.

The merges of byte-pair encoding are local: any run of tokens of an encoded text is the encoding of
its own characters, and a sequence of tokens is an encoding when every two neighbours are the
encoding of the two together. So the encoding of a prefix is that of a shorter prefix and one last
piece, the only one that may follow the shorter prefix's last piece, and

    tokens(prefix) = tokens(prefix without its last piece) + 1.

``PrefixCounter`` walks a text once with this rule; sorted texts share the walk of what they begin
with alike. Budget and truncation questions are look-ups
in the stored counts; nothing is encoded again for another budget. Counts may fall as a text grows
(a merge), so the longest prefix within a budget is looked for behind the last place that has more.

Texts are cut where no piece of the vocabulary spans the cut (before a run of word marks, around
characters that are in no longer piece), so the walk never crosses a cut. Counts of a chunk's
prefixes are kept for as long as it recurs, in two generations of a bounded size.

Edge cases: a null text counts as empty and has no tokens; strings of special tokens are ordinary
text; characters without a piece count their UTF-8 bytes; texts are never cut short, the longest is
one walk; repeated rows get equal results; an empty table gives an empty one. An input column named
like an output column is replaced.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from airlake.llm.arrowtext import slices
from airlake.llm.tables import bound_arrow, tidy, with_fields

VOCABULARY = "piece_bpe_32k.model"
#: Stands for a space, and before the first word.
MARK = "▁"
#: Bytes of text at a time; chunks and pairs kept in a generation; the longest chunk kept.
SLICE, KEPT, KEPT_LENGTH = 2 << 20, 100_000, 48
#: Stands for the start and for a character without a piece: neither merges with what follows.
_NONE = 0xFFFF


class TwoGenerations:
    """A bounded table of recurring keys: ``young`` is filled; when it is full it becomes the old
    generation, from which what is asked for again comes back."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def turn(self) -> None:
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young


class PrefixCounter:
    """Token counts of texts and their prefixes under one sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for probe in (" a  b\t\n", "ﬁ Å", MARK, "x\u0000y "):
            if model.normalize(probe) != self.marked(probe):
                raise ValueError(f"{path}: only models that mark spaces and change nothing else are supported")
        plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(model.is_unused(i) for i in plain):
            raise ValueError(f"{path}: models with unused pieces are not supported")
        #: piece -> score; the neighbours whose piece has the highest score merge first, the leftmost of equals
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.pieces = list(self.score)
        if len(self.pieces) >= _NONE:
            raise ValueError(f"{path}: too many pieces")
        #: every ending of a piece -> its number among the pieces, -1 if it is none
        self.endings = {p[k:]: -1 for p in self.pieces for k in range(len(p))}
        self.endings.update((p, i) for i, p in enumerate(self.pieces))
        longer = [p for p in self.score if len(p) > 1]
        if any(c not in self.score for p in longer for c in p):
            raise ValueError(f"{path}: a character of a piece is no piece")
        if any(a != MARK == b for p in longer for a, b in zip(p, p[1:])):
            raise ValueError(f"{path}: a piece crosses the start of a word")
        inside = "".join(map(re.escape, sorted({c for p in longer for c in p} - {MARK})))
        self.cut = re.compile(f"{MARK}+[{inside}]*|[{inside}]+|.", re.DOTALL)
        self.known = TwoGenerations(KEPT)               # chunk -> counts of its prefixes, as bytes
        self.long: list[str] = []                       # chunks in that table that are too long to stay
        self.pairs = TwoGenerations(4 * KEPT)           # numbers of two pieces -> whether the second may follow the first

    @staticmethod
    def marked(text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def _encodes_itself(self, *pieces: str) -> bool:
        """Whether the pieces are the encoding of their characters: merge by merge."""
        parts = [c for p in pieces for c in p]
        score = self.score.get
        while len(parts) > 1:
            best, at = None, 0
            for k in range(len(parts) - 1):
                s = score(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts == list(pieces)

    def _fits(self, pair: int) -> bool:
        """Whether the second piece may follow the first (or begin, after none)."""
        fits = self.pairs.old.get(pair)
        if fits is None:
            first, second = pair >> 16, self.pieces[pair & 0xFFFF]
            fits = self._encodes_itself(second) if first == _NONE else self._encodes_itself(self.pieces[first], second)
        self.pairs.young[pair] = fits
        return fits

    def walks(self, chunks: Iterable[str]):
        """(chunk, token counts of its prefixes of 0, 1, 2, ... characters) of sorted chunks. The
        list of counts is reused for the next chunk."""
        endings, known_pairs, last, counts, before = self.endings.get, self.pairs.young.get, [_NONE], [0], ""
        for chunk in chunks:
            shared = 0
            for a, b in zip(chunk, before):
                if a != b:
                    break
                shared += 1
            del last[shared + 1:], counts[shared + 1:]
            for end in range(shared + 1, len(chunk) + 1):
                start = end - 1
                piece = endings(chunk[start: end])
                if piece is None or piece < 0:           # no piece: a token for each byte
                    last.append(_NONE)
                    counts.append(counts[start] + len(chunk[start].encode()))
                    continue
                starts, pieces = [start], [piece]
                while start:
                    start -= 1
                    piece = endings(chunk[start: end])
                    if piece is None:
                        break
                    if piece >= 0:
                        starts.append(start)
                        pieces.append(piece)
                while True:                              # exactly one fits, mostly the longest
                    start, piece = starts.pop(), pieces.pop()
                    pair = last[start] << 16 | piece
                    fits = known_pairs(pair)
                    if fits or fits is None and self._fits(pair):
                        break
                last.append(piece)
                counts.append(counts[start] + 1)
            yield chunk, counts
            before = chunk

    def chunks(self, texts: list[str]) -> tuple[list[list[str]], dict]:
        """The chunks of each text, and the prefix counts of every one of them (until the next call)."""
        for chunk in self.long:
            del self.known.young[chunk]
        self.long.clear()
        self.known.turn()
        self.pairs.turn()
        cut = [self.cut.findall(self.marked(t)) for t in texts]
        young, old, new = self.known.young, self.known.old, []
        for chunk in set(itertools.chain.from_iterable(cut)).difference(young):
            kept = old.get(chunk)
            if kept is None:
                new.append(chunk)
            else:
                young[chunk] = kept
        new.sort()
        for chunk, counts in self.walks(new):
            if len(chunk) > KEPT_LENGTH:                 # 48 characters have at most 192 tokens
                young[chunk] = counts[1:]
                self.long.append(chunk)
            else:
                young[chunk] = bytes(counts[1:])
        return cut, young

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        cut, known = self.chunks(texts)
        return [sum([known[c][-1] for c in chunks]) for chunks in cut]

    def prefixes(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the tokens of its prefixes of 0, 1, 2, ... code points."""
        cut, known = self.chunks(texts)
        out = []
        for chunks in cut:
            lists = [known[c] for c in chunks]
            ahead = np.cumsum([0] + [x[-1] for x in lists])
            flat = np.fromiter(itertools.chain.from_iterable(lists), np.int64) if lists else np.zeros(1, np.int64)
            flat = flat + np.repeat(ahead[:-1], [len(x) for x in lists]) if lists else flat
            flat[0] = 0                                  # the mark alone belongs to the empty prefix
            out.append(flat)
        return out

    def longest(self, chunks: list[str], known: dict, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens, from stored counts."""
        place = tokens = 0
        for c in chunks:
            counts = known[c]
            if tokens + counts[-1] > budget:             # from here on every prefix has more
                inside = max((k for k, n in enumerate(counts, 1) if tokens + n <= budget), default=0)
                return max(place + inside - 1, 0)
            place, tokens = place + len(c), tokens + counts[-1]
        return max(place - 1, 0)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter for each worker process and vocabulary."""
    return PrefixCounter(path)


_ARROW = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.ArrayType(T.LongType()): pa.list_(pa.int64()), T.StringType(): pa.string()}


def _mapped(docs: DataFrame, column: str, path: str | None, fields: list[T.StructField], compute) -> DataFrame:
    path = path or public_tokenizers.path(VOCABULARY)
    schema = with_fields(docs, *fields)
    kept = schema.names[: len(schema.names) - len(fields)]
    bound_arrow(docs.sparkSession)

    def run(batches):
        tool = counter(path)
        for batch in batches:
            for part in slices(batch, column, SLICE):
                new = compute(tool, [t or "" for t in part.column(column).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(v, _ARROW[f.dataType]) for f, v in zip(fields, new)], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)


def count(docs: DataFrame, limit: int, column: str = "text", path: str | None = None) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more tokens than ``limit``) and
    ``limit_chars``, the code points of the longest prefix within it."""
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
              T.StructField("over_limit", T.BooleanType()), T.StructField("limit_chars", T.LongType())]

    def compute(tool, texts):
        cut, known = tool.chunks(texts)
        totals = [sum([known[c][-1] for c in chunks]) for chunks in cut]
        fit = [len(t) if n <= limit else tool.longest(chunks, known, limit) for t, n, chunks in zip(texts, totals, cut)]
        return [len(t.encode()) for t in texts], totals, [n > limit for n in totals], fit

    return _mapped(docs, column, path, fields, compute)


def prefix_counts(docs: DataFrame, column: str = "text", path: str | None = None) -> DataFrame:
    """Add ``prefix_tokens``: tokens of the prefixes of 0, 1, ... code points of every text."""
    return _mapped(docs, column, path, [T.StructField("prefix_tokens", T.ArrayType(T.LongType()))], lambda tool, texts: [tool.prefixes(texts)])


def fitting(docs: DataFrame, budgets: list[int], column: str = "text", path: str | None = None) -> DataFrame:
    """Add ``fitting_chars``: for each budget the code points of the longest prefix within it."""
    def compute(tool, texts):
        cut, known = tool.chunks(texts)
        return [[[tool.longest(chunks, known, b) for b in budgets] for chunks in cut]]

    return _mapped(docs, column, path, [T.StructField("fitting_chars", T.ArrayType(T.LongType()))], compute)


def truncate(docs: DataFrame, budget: int, column: str = "text", path: str | None = None) -> DataFrame:
    """Add ``truncated``: the longest prefix of every text within ``budget`` tokens."""
    def compute(tool, texts):
        cut, known = tool.chunks(texts)
        return [[t[: tool.longest(chunks, known, budget)] for t, chunks in zip(texts, cut)]]

    return _mapped(docs, column, path, [T.StructField("truncated", T.StringType())], compute)
