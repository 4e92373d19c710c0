"""Personal data by bootstrapped contextual extraction (DataFrame operations only).

1. *Seeds.* Four base patterns (email, ip, card, phone) find entities with their spans.
2. *Patterns.* Every identifier-like token (one that holds a digit, ``@`` or a bracket between
   letters) is an occurrence. Its patterns are of three families: its shape (letter runs as
   ``a``, digits as ``9``) with the token before it and with the token after it; its coarse
   shape (runs of digits as one ``9``) with each of them; and, whatever its form, the token
   before it alone and the tokens before and after it together.
3. *Scores.* Occurrences make a graph of patterns and token values. A pattern's confidence for
   a kind is the mean score of the values it extracts, smoothed; a value's score in a family is
   1 - prod(1 - confidence) over its patterns, and its score is that of its best family (the
   families see the same evidence, so they are not multiplied). Seeds keep score 1. This is
   iterated; values that score at least ``threshold`` support patterns in the next round, so
   the rounds pass from one form to others.
4. *Discovery.* Occurrences outside all base spans, whose value scores at least ``threshold``
   by patterns that enough such values support, become further spans of that kind. Base spans
   stay.

Texts are never shuffled for scoring: only the few identifier-like tokens are. Edges are summed
up per (pattern, value) before they are joined, so a common context word stays a number of
partial sums. Regular expressions begin only at token or run starts (``\\G`` and look-behind)
and use possessive repeats, so they are linear in the text.

Edge cases: a null text counts as empty and has no spans; spans depend on the text alone, so
repeated rows and copies get equal spans whatever their ids; of overlapping spans each stays
listed and redaction replaces their union; an empty table gives an empty one. Input columns
named like an added column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm.tables import saved

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. The left guards only skip starts from which no leftmost match can begin.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_OCTETS = r"^(0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(\.|$)){4}$"
#: What makes a token identifier-like: a digit, ``@``, or a bracket between letters (``name[at]host``).
MARK = r"[0-9@]|(?<=\p{L})[\[({<](?=\p{L})"
TOKEN = rf"(?<!\S)(?=\S*?(?:{MARK}))\S++"
#: Rounds of scoring, the least score of a discovered value, the least number of distinct values
#: of at least that score behind a pattern, and the smoothing count of a pattern's confidence.
ROUNDS, THRESHOLD, SUPPORT, SMOOTHING = 3, 0.9, 5, 1.0
#: First letters of patterns: shape, coarse shape, context alone.
FAMILIES = ("s", "c", "x")
_BLOCK, _CHUNK = 256, 8192
#: A neighbouring token over this length stands in a pattern as its digest: whole, yet short.
_LONG = 32


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(items: Column, use) -> Column:
    """``use(block number, block)`` for every run of ``_BLOCK`` items: folds that append to an
    array then cost a block's square, not the whole text's."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / F.lit(_BLOCK)).cast("int")),
                       lambda b: _let(F.slice(items, b * _BLOCK + 1, F.lit(_BLOCK)), lambda block: use(b, block)))


def match_spans(text: Column, pattern: str, beside: bool = False) -> Column:
    """All leftmost non-overlapping matches: array of struct(start, end, value, left, right) in
    code points; with ``beside``, left and right are the whole tokens next to the match ('' if
    there is none before the next match or the text's end).

    The matches and the texts between them give the places as running sums of lengths.
    """
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string,left:string,right:string>>)")

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["value"])
        one = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"),
                       (F.regexp_extract(x["gap"], r"(?<!\S)(\S++)\s*+\z", 1) if beside else F.lit("")).alias("left"),
                       (F.regexp_extract(x["next"], r"\A\s*+(\S++)", 1) if beside else F.lit("")).alias("right"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def placed(items):
        return _let(_blocks(items, lambda _, block: F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("out")), step)), lambda parts: F.flatten(
            F.zip_with(parts, F.slice(F.aggregate(parts, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"]))), 1, F.size(parts)),
                       lambda part, ahead: F.transform(part["out"], lambda m: F.struct(
                           (m["start"] + ahead).alias("start"), (m["end"] + ahead).alias("end"), m["value"].alias("value"), m["left"].alias("left"), m["right"].alias("right"))))))

    def zipped(z):
        return F.arrays_zip(F.slice(z["gaps"], 1, F.size(z["found"])).alias("gap"), z["found"].alias("value"), F.slice(z["gaps"], 2, F.size(z["found"])).alias("next"))

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return _let(both, lambda z: F.when(F.size(z["found"]) == 0, none).otherwise(_let(zipped(z), placed)))


def _valid(kind: str):
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
    return {
        "email": lambda m: F.lit(True),
        "ip": lambda m: m["value"].rlike(_OCTETS),
        "card": lambda m: F.length(digits(m["value"])).between(16, 19) & F.call_function("luhn_check", digits(m["value"])),
        "phone": lambda m: F.length(digits(m["value"])).between(8, 15),
    }[kind]


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one kind: matches of its base pattern that are valid; failing ones are dropped."""
    spans = F.filter(match_spans(text, PATTERNS[kind]), _valid(kind))
    likely = text.rlike("[0-9]") if _NEEDS[kind] is None else text.contains(_NEEDS[kind])
    bare = F.transform(spans, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    return F.when(likely, bare).otherwise(F.expr("cast(array() as array<struct<start:int,end:int>>)"))


def _masked(token: Column) -> Column:
    masked = F.translate(F.lower(token), "0123456789", "9999999999")
    return F.when(F.length(masked) > _LONG, F.md5(masked)).otherwise(masked)


def shape(value: Column) -> Column:
    return F.translate(F.regexp_replace(value, r"\p{L}+", "a"), "012345678", "999999999")


def occurrences(docs: DataFrame) -> DataFrame:
    """Identifier-like tokens of every text: key (digest of the text), start, end, value,
    kind (of the base span that holds it, else null), patterns (each with its family's letter)."""
    base = F.concat(*[_base_of(k) for k in KINDS])

    def with_kind(part, spans):
        bounds = F.struct(F.element_at(part, 1)["start"].alias("first"), F.element_at(part, -1)["end"].alias("last"))
        close = _let(bounds, lambda b: F.filter(spans, lambda s: (s["start"] < b["last"]) & (b["first"] < s["end"])))
        return _let(close, lambda near: F.transform(part, lambda t: F.struct(
            t["start"].alias("start"), t["value"].alias("value"), t["left"].alias("left"), t["right"].alias("right"),
            F.get(F.filter(near, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])), F.lit(0))["kind"].alias("kind"))))

    both = F.struct(match_spans(F.col("body"), TOKEN, beside=True).alias("tokens"), base.alias("base"))
    tokens = _let(both, lambda z: F.when(F.size(z["tokens"]) > 0, F.flatten(_blocks(z["tokens"], lambda _, part: with_kind(part, z["base"])))))
    rows = docs.where(F.col("body").rlike(MARK)).select("key", F.explode(tokens).alias("m"))
    # punctuation around the token is not part of the value
    ahead = F.length("m.value") - F.length(F.regexp_replace("m.value", r"^[^\p{L}0-9+(]++", ""))
    core = F.regexp_replace(F.regexp_replace("m.value", r"^[^\p{L}0-9+(]++", ""), r"(?<=[\p{L}0-9)])[^\p{L}0-9)]++$", "")
    rows = rows.select("key", "m", core.alias("value"), (F.col("m.start") + ahead).alias("start"))
    rows = rows.withColumn("end", F.col("start") + F.length("value")).where(F.col("value").rlike(MARK))
    rows = rows.select("key", "start", "end", "value", F.col("m.kind").alias("kind"), shape(F.col("value")).alias("form"),
                       _masked(F.col("m.left")).alias("before"), _masked(F.col("m.right")).alias("after"))
    coarse, known = F.regexp_replace("form", "9+", "9"), F.col("before") != ""
    return rows.select("key", "start", "end", "value", "kind", F.array_compact(F.array(
        F.concat(F.lit("s"), "form", F.lit("<"), "before"), F.concat(F.lit("s"), "form", F.lit(">"), "after"),
        F.concat(F.lit("c"), coarse, F.lit("<"), "before"), F.concat(F.lit("c"), coarse, F.lit(">"), "after"),
        F.when(known, F.concat(F.lit("x<"), "before")),
        F.when(known & (F.col("after") != ""), F.concat(F.lit("x<"), "before", F.lit(" >"), "after")))).alias("patterns"))


def discover(found: DataFrame, rounds: int = ROUNDS, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """Values that high-confidence patterns extract and no base pattern finds: value, kind, score.

    ``found``: occurrences, saved.
    """
    edges = saved(found.select("value", F.explode("patterns").alias("pattern")).distinct())
    seeds = saved(found.where("kind IS NOT NULL").select("value", "kind").distinct())
    reach = edges.groupBy("pattern").agg(F.count("*").alias("values"))
    scores = seeds.withColumn("score", F.lit(1.0))
    for _ in range(rounds):
        held = edges.join(scores, "value").groupBy("pattern", "kind").agg(
            F.sum("score").alias("good"), F.sum(F.when(F.col("score") >= threshold, 1).otherwise(0)).alias("sure"))
        confident = held.join(reach, "pattern").where(F.col("sure") >= support).select(
            "pattern", "kind", (F.col("good") / (F.col("values") + SMOOTHING)).alias("confidence")).where("confidence > 0.1")
        doubt = F.log1p(-F.least("confidence", F.lit(0.999)))
        reached = edges.join(confident, "pattern").groupBy("value", "kind").agg(
            (1 - F.exp(F.least(*[F.sum(F.when(F.substring("pattern", 1, 1) == f, doubt).otherwise(0.0)) for f in FAMILIES]))).alias("score"))
        new = reached.join(seeds.select("value").distinct(), "value", "left_anti")
        scores = saved(seeds.withColumn("score", F.lit(1.0)).unionByName(new))
    return scores.where((F.col("score") < 1.0) & (F.col("score") >= threshold))


def prepared(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns), ``body``, ``key`` and the base spans of each kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body.alias("body"), F.md5(body).alias("key"))
    return rows.select("row", "body", "key", *[base_spans(F.col("body"), k).alias(k) for k in KINDS])


def detect(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``prepared`` rows with ``added``: discovered spans (array of struct(kind, start, end))."""
    rows = prepared(docs, text)
    found = saved(occurrences(rows))
    values = discover(found, rounds, threshold, support).groupBy("value").agg(F.max(F.struct("score", "kind"))["kind"].alias("kind"))
    spans = found.where("kind IS NULL").drop("kind").join(values, "value").groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("added"))
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    return rows.join(spans, "key", "left").withColumn("added", F.coalesce("added", none))


def _base_of(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _of_kind(kind: str) -> Column:
    return F.array_sort(F.concat(_base_of(kind), F.filter("added", lambda s: s["kind"] == kind)))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, base counts, digest of the base spans, all spans, number added."""
    base = F.concat(*[_base_of(k) for k in KINDS])
    return found.select(*[F.col(f"row.`{c}`") for c in keep], *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.concat(*[_of_kind(k) for k in KINDS])).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))


def redacted(found: DataFrame) -> Column:
    """The text with the union of all spans replaced: ``[EMAIL]``, ``[IP]``, ...

    Text between spans is cut from a chunk that moves along, so a text with many spans is not
    walked from its beginning for each of them.
    """
    spans = F.array_sort(F.transform(F.concat(*[_of_kind(k) for k in KINDS]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    body = F.col("body")
    chunk = lambda at: F.substring(body, at + 1, F.lit(_CHUNK))

    def step(acc, s):
        length = F.greatest(s["start"] - acc["at"], F.lit(0))
        near = acc["at"] + length - acc["base"] <= _CHUNK
        gap = F.when(near, F.substring(acc["chunk"], acc["at"] - acc["base"] + 1, length)).otherwise(F.substring(body, acc["at"] + 1, length))
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        at = F.greatest(acc["at"], s["end"])
        move = at - acc["base"] > _CHUNK // 2
        return F.struct(at.alias("at"), F.when(move, at).otherwise(acc["base"]).alias("base"), F.when(move, chunk(at)).otherwise(acc["chunk"]).alias("chunk"),
                        F.concat(acc["out"], F.array(gap, mark)).alias("out"))

    def block(items):
        def one(number, part):
            first = F.when(number == 0, F.lit(0)).otherwise(F.array_max(F.transform(F.slice(items, 1, F.greatest(number * _BLOCK, F.lit(1))), lambda s: s["end"])))
            zero = lambda at: F.struct(at.alias("at"), at.alias("base"), chunk(at).alias("chunk"), F.expr("cast(array() as array<string>)").alias("out"))
            return F.aggregate(part, zero(first), step, lambda acc: F.array_join(acc["out"], ""))
        rest = F.substring(body, F.array_max(F.transform(items, lambda s: s["end"])) + 1, F.length(body))
        return F.concat(F.array_join(_blocks(items, one), ""), rest)

    return _let(spans, lambda items: F.when(F.size(items) == 0, body).otherwise(block(items)))


def redact(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; rows without any are unchanged (also a
    null text)."""
    found = detect(docs, text, **options)
    fields = [F.when(F.col(f"row.`{c}`").isNull(), F.lit(None)).otherwise(redacted(found)).alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    return found.select(*fields)
