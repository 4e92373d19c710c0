"""Toxicity behind disguises: noisy-channel restoration, then a score of the restored text.

*Language model.* Every task counts the letter 4-grams of all its words (letters folded to
a-z, one boundary sign); the counts of all documents are summed up by Spark. The table has at
most 27**4 entries, whatever the corpus.

*Channel.* A disguised word is a lattice: a sign may stand for the letters it looks like
(``LEET``), a repeated letter for one, a separator inside a word for nothing, and the blanks
between single letters for nothing or for a word boundary. Each reading has a cost. The
restored word is the Viterbi path under channel and language model (states: the last three
letters; all states of a position are kept up to ``BEAM``). Plain words are their own reading.

*Score.* Features are restored words and their beginnings and inner 4-grams. Candidates are
counted by Spark over a bounded sample of labelled rows; those with the strongest one-sided
evidence are fitted by a ridge logistic regression. A document's score is its probability.

Edge cases: null and empty texts have no features and get the score of the intercept; equal
texts get equal scores; without usable labels every score is 0; an empty table gives an empty
one. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from os.path import commonprefix

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlake.llm.arrowtext import slices, utf8
from airlake.llm.tables import TEXT_BATCH, TEXT_SLICE, bound_arrow, saved, tidy

#: Learning: labelled rows (chosen by a hash of the id), features, and the least number of
#: toxic rows and the least share of toxic rows among those that a feature occurs in.
SAMPLE_ROWS, FEATURES, SUPPORT, PURITY, RIDGE = 20_000, 256, 5, 0.6, 0.05
THRESHOLD, BEAM = 0.3, 48
#: Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
_SEPARATORS = ".-_*~'`^ /\\,"
_COST = {"leet": 1.0, "repeat": 0.7, "separator": 0.5, "boundary": 1.0}

_SIZE = 27                                                    # a-z and the boundary, 0
_OWN = {chr(96 + k): [(0.0, k)] for k in range(1, _SIZE)}


def _fold_table() -> np.ndarray:
    """Letter class (1-26, else 0) of every code point below 0x250, by its base letter."""
    table = np.zeros(0x250, dtype=np.uint8)
    for c in range(0x250):
        base = unicodedata.normalize("NFKD", "ss" if chr(c) == "ß" else chr(c)).lower()[:1]
        if "a" <= base <= "z":
            table[c] = ord(base) - 96
    return table


_FOLD = _fold_table()
_TO_PLAIN = {c: chr(96 + k) for c, k in enumerate(_FOLD) if k} | {ord("ß"): "ss"}
_TOKEN = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Three or more single signs with a blank or mark between: letters that are spaced out.
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][ .\-_*]{1,2}){2,}[^\W_](?![^\W_])")
#: What a folded token must hold to have more than one reading: a sign of the channel, or a doubled letter.
_ODD = re.compile("[" + re.escape("".join(LEET) + _SEPARATORS) + "]|([a-z])\\1")
_EDGE = ".,;:?\")[]{}<>#%&*~_-'=/\\"
#: The distinct tokens that a task keeps, their greatest length (of a whole word as a feature,
#: too), and the signs after which a reading's settled beginning is put aside.
CACHE, KEPT, SETTLE = 150_000, 40, 64


def plain(word: str) -> str:
    """Lower case, accents taken off."""
    return word.lower() if word.isascii() else word.lower().translate(_TO_PLAIN)


def letter_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Letter 4-gram counts over all documents, shape (27, 27, 27, 27)."""
    bound_arrow(docs.sparkSession, TEXT_BATCH)

    def run(batches):
        counts = np.zeros(_SIZE ** 4, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, text, TEXT_SLICE):
                data, _ = utf8(pa.array([" ".join(t for t in part.column(text).to_pylist() if t)], pa.string()))
                codes = np.frombuffer(bytes(data).decode().encode("utf-32-le"), dtype=np.uint32)
                x = np.zeros(len(codes) + 4, dtype=np.int64)
                x[3: 3 + len(codes)] = np.where(codes < len(_FOLD), _FOLD[np.minimum(codes, len(_FOLD) - 1)], 0)
                grams = ((x[:-3] * _SIZE + x[1:-2]) * _SIZE + x[2:-1]) * _SIZE + x[3:]
                counts += np.bincount(grams, minlength=len(counts))
        found = np.flatnonzero(counts)
        for at in range(0, len(found), 100_000):
            part = found[at: at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], names=["gram", "n"])

    rows = docs.select(text).mapInArrow(tidy(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_SIZE ** 4)
    counts[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return counts.reshape((_SIZE,) * 4)


def language_model(counts: np.ndarray) -> np.ndarray:
    """-log probability of a letter after three letters, backing off to two, one and none."""
    p = (counts.sum((0, 1, 2)) + 1) / (counts.sum() + _SIZE)
    for k in (2, 1, 0):
        c = counts.sum(tuple(range(k)))
        p = (c + 4 * p) / (c.sum(-1, keepdims=True) + 4)
    return -np.log(p).astype(np.float32)


class Decoder:
    """Viterbi reading of disguised words."""

    def __init__(self, model: np.ndarray):
        self.model, self.prices = model, model.ravel().tolist()

    def arcs(self, token: str) -> list[list[tuple[float, int | None]]]:
        """Readings of each sign: (cost, letter class, 0 for a boundary, or None for nothing)."""
        return list(self._signs(token))

    def _signs(self, token: str) -> Iterator[list[tuple[float, int | None]]]:
        before = ""
        for sign in plain(token):
            if "a" <= sign <= "z":
                here = _OWN[sign] if sign != before else _OWN[sign] + [(_COST["repeat"], None)]
            elif sign in LEET:
                here = [(_COST["leet"], ord(c) - 96) for c in LEET[sign]]
                if sign == before:
                    here.append((_COST["repeat"], None))
                if not sign.isdigit():
                    here.append((_COST["separator"] * 2, None))
            elif sign in _SEPARATORS:
                here = [(_COST["separator"], None), (_COST["boundary"], 0)]
            else:
                here = [(_COST["boundary"], 0)]
            yield here
            before = sign

    def read(self, token: str) -> str:
        """The cheapest reading: words joined by one blank. What all paths begin with is put
        aside from time to time, so the work is linear in the token's length."""
        prices, settled = self.prices, []
        # a state is its last three letters as one number to the base 27
        states: dict[int, tuple[float, str]] = {0: (0.0, "")}
        for at, here in enumerate(chain(self._signs(token), [[(0.0, 0)]]), 1):
            new: dict[int, tuple[float, str]] = {}
            for last, (cost, path) in states.items():
                for price, letter in here:
                    if letter is None:
                        state, total, written = last, cost + price, path
                    else:
                        gram = last * _SIZE + letter
                        total = cost + price + (prices[gram] if letter or last % _SIZE else 0.0)
                        state, written = gram % _SIZE ** 3, path + chr(96 + letter) if letter else path + " "
                    old = new.get(state)
                    if old is None or total < old[0]:
                        new[state] = (total, written)
            if len(new) > BEAM:
                new = dict(sorted(new.items(), key=lambda x: x[1][0])[:BEAM])
            if at % SETTLE == 0:
                begin = commonprefix([path for _, path in new.values()])
                settled.append(begin)
                new = {state: (cost, path[len(begin):]) for state, (cost, path) in new.items()}
            states = new
        return " ".join("".join([*settled, min(states.values())[1]]).split())


def _skeletons() -> dict[int, str | None]:
    """Letters that a sign may stand for alike become one; separators, which may be nothing, go."""
    alike = {c: c for c in map(chr, range(97, 123))}
    for letters in LEET.values():
        for c in letters[1:]:
            alike = {k: alike[letters[0]] if v == alike[c] else v for k, v in alike.items()}
    table: dict[int, str | None] = {ord(c): v for c, v in alike.items()}
    table.update({ord(sign): alike[letters[0]] for sign, letters in LEET.items()})
    return table | {ord(c): None for c in _SEPARATORS}


_SKELETON = _skeletons()
_RUN = re.compile(r"(.)\1+", re.DOTALL)
#: Signs that stand for a letter or for nothing.
_EITHER = re.compile("[" + re.escape("".join(c for c in LEET if not c.isdigit())) + "]")


def skeleton(text: str) -> str:
    """``text``, in plain letters and signs, with its separators gone, letters that a sign confuses
    made one, and runs of one letter shortened to it. The skeleton of any part of any reading of a
    token without ``_EITHER`` signs is a part of the token's skeleton: a path reads the letters in
    order and leaves out only separators and repeated signs."""
    return _RUN.sub(r"\1", text.translate(_SKELETON))


class Spelling:
    """Whether any reading of a token could hold one of the features: a necessary condition, by
    skeletons, so that what it rules out need not be decoded."""

    def __init__(self, names: Iterable[str]):
        self.parts = ahocorasick.Automaton()
        for name in names:
            part = skeleton(name.lstrip("=^"))
            self.parts.add_word(part, part)
        self.any = len(self.parts) > 0
        if self.any:
            self.parts.make_automaton()

    def __call__(self, token: str) -> bool:
        """``token``: in plain letters and signs."""
        return self.any and (_EITHER.search(token) is not None or next(self.parts.iter(skeleton(token)), None) is not None)


class Restorer:
    """Restored words of a text; readings of distinct tokens are kept."""

    def __init__(self, model: np.ndarray):
        self.decoder, self.known = Decoder(model), {}

    def token(self, token: str) -> tuple[str, ...]:
        words = tuple(plain(w) for w in _LETTERS.findall(token))
        core = token.lstrip(_EDGE).rstrip(_EDGE + "(")    # a bracket at the beginning may stand for c
        if _ODD.search(plain(core)):
            words += tuple(self.decoder.read(core).split())
        return words

    def words(self, text: str) -> set[str]:
        """All plain and restored words."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
        out: set[str] = set()
        for token in set(_TOKEN.findall(text)):
            words = known.get(token)
            if words is None:
                words = self.token(token)
                if len(token) <= KEPT:
                    known[token] = words
            out.update(words)
        for m in _SPACED.finditer(text):
            out.update(self.decoder.read(m.group()).split())
        return out


def features(word: str) -> list[str]:
    """The word, its beginnings of 4 and 5 letters, and its inner 4-grams. An unbroken run of
    more than ``KEPT`` letters is no single word and has only the others, over its whole length."""
    out = ["=" + word] if len(word) <= KEPT else []
    if len(word) > 4:
        out += ["^" + word[:4], "^" + word[:5]]
        out += [word[k: k + 4] for k in range(1, len(word) - 3)]
    return out


class Finder:
    """Numbers of the features that the plain and restored words of a text have: those of
    ``Restorer.words``, but only tokens that may have any are split and decoded."""

    def __init__(self, model: np.ndarray, place: dict[str, int]):
        self.decoder, self.place, self.spelling = Decoder(model), place, Spelling(place)
        self.written = ahocorasick.Automaton()                   # of features as they are written
        for name in place:
            self.written.add_word(name.lstrip("=^"), name)
        if place:
            self.written.make_automaton()
        self.young: dict[str, frozenset[int]] = {}               # distinct tokens, in two generations
        self.old: dict[str, frozenset[int]] = {}

    def of(self, words: Iterable[str]) -> frozenset[int]:
        found = [self.place[f] for w in words for f in features(w) if f in self.place]
        return frozenset(found) if found else _NOTHING

    def token(self, token: str) -> frozenset[int]:
        signs, words = plain(token), []
        if next(self.written.iter(signs), None) is not None:
            words = [plain(w) for w in _LETTERS.findall(token)]
        core = signs.lstrip(_EDGE).rstrip(_EDGE + "(")
        if _ODD.search(core) and self.spelling(core):
            words += self.decoder.read(core).split()
        return self.of(words) if words else _NOTHING

    def __call__(self, text: str) -> set[int]:
        at: set[int] = set()
        if not self.place:
            return at
        if len(self.young) > CACHE // 2:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        for token in set(_TOKEN.findall(text)):
            found = young.get(token)
            if found is None:
                found = old.get(token)
                if found is None:
                    found = self.token(token)
                if len(token) <= KEPT:
                    young[token] = found
            if found:
                at |= found
        for m in _SPACED.finditer(text):
            if self.spelling(plain(m.group())):
                at |= self.of(self.decoder.read(m.group()).split())
        return at


_NOTHING: frozenset[int] = frozenset()


def labelled_sample(labelled: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows, by a hash of the id: a bounded, repeatable sample."""
    return labelled.where(F.col(label).isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, label: str = "toxic", rows: int = SAMPLE_ROWS, size: int = FEATURES) -> tuple[list[str], np.ndarray]:
    """Features and weights (the last one: intercept) from a bounded sample of labelled rows.

    ``labels`` (doc_id, label) must hold only rows that may be learned from.
    """
    spark = docs.sparkSession
    bound_arrow(spark, TEXT_BATCH)
    sample = labelled_sample(labels.select("doc_id", label), label, rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", F.col(label).cast("int").alias("y"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        tool = Restorer(shared.value)
        for batch in batches:
            for part in slices(batch, "text", TEXT_SLICE):
                words = [sorted(tool.words(t or "")) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(words, pa.list_(pa.string()))], names=["y", "words"])

    # equal texts teach once
    rows_ = saved(texts.dropDuplicates(["text", "y"]).mapInArrow(tidy(run), T.StructType([T.StructField("y", T.IntegerType()), T.StructField("words", T.ArrayType(T.StringType()))])))
    totals = {r.y: r.n for r in rows_.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return [], np.array([-50.0 if not totals.get(1) else 50.0])

    def expand(batches):
        for batch in batches:
            for y, words in zip(batch.column("y").to_pylist(), batch.column("words").to_pylist()):
                found = sorted({f for w in words for f in features(w)})
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(found), pa.int32()), pa.array(found, pa.string())], names=["y", "feature"])

    counted = rows_.mapInArrow(tidy(expand), "y int, feature string").groupBy("feature").agg(
        F.sum("y").alias("toxic"), F.count("*").alias("n")).where(F.col("toxic") >= SUPPORT)
    # one-sided evidence: signed log-likelihood gain of rows with the feature over the base rate
    base = totals[1] / (totals[0] + totals[1])
    share = (F.col("toxic") + 0.5 * base) / (F.col("n") + 0.5)
    gain = F.when(share > F.greatest(F.lit(base), F.lit(PURITY)), F.col("toxic") * F.log(share / base) + (F.col("n") - F.col("toxic")) * F.log((1 - share + 1e-9) / (1 - base)))
    names = [r.feature for r in counted.withColumn("gain", gain).where("gain > 6").orderBy(F.desc("gain"), "feature").limit(size).collect()]
    place = {f: i for i, f in enumerate(names)}

    def rows_of(batches):
        for batch in batches:
            found = [sorted({place[f] for w in words for f in features(w) if f in place}) for words in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.int32()))], names=["y", "at"])

    table = rows_.mapInArrow(tidy(rows_of), "y int, at array<int>").groupBy("y", "at").agg(F.count("*").alias("n")).toArrow()
    x = np.zeros((table.num_rows, len(names) + 1))
    x[:, -1] = 1
    for i, at in enumerate(table.column("at").to_pylist()):
        x[i, at] = 1
    return names, logistic(x, table.column("y").to_numpy().astype(float), table.column("n").to_numpy().astype(float))


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the intercept."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (n * (p - y)) + penalty * w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, model: np.ndarray, names: list[str], weights: np.ndarray, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) to every row."""
    spark = docs.sparkSession
    bound_arrow(spark, TEXT_BATCH)
    shared = spark.sparkContext.broadcast((model, {f: i for i, f in enumerate(names)}, weights))
    fields = [f for f in docs.schema.fields if f.name.lower() != "score"]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        lm, place, w = shared.value
        find = Finder(lm, place)
        for batch in batches:
            for part in slices(batch, text, TEXT_SLICE):
                out = []
                for t in part.column(text).to_pylist():
                    at = find(t or "")
                    out.append(1 / (1 + np.exp(-np.clip(w[-1] + sum(w[k] for k in sorted(at)), -50, 50))))
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in fields] + [pa.array(out, pa.float64())], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``score``. ``labels``: (doc_id, toxic) rows that may be learned from;
    ``learn_from``: the documents that they label (default: ``docs``). The language model
    always comes from all of ``docs``."""
    model = language_model(letter_counts(docs))
    names, weights = learn(docs if learn_from is None else learn_from, labels, model)
    return score(docs, model, names, weights)
