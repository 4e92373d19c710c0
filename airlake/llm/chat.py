"""Chat formatting into budgeted windows (DataFrame operations only).

Prefix sums of turn tokens choose turn-aligned spans: a turn belongs to the span in which its
first token falls, spans being ``span_tokens`` long. Every span becomes one window. A window
repeats the conversation's system turn (when the first turn is one) and up to ``history``
turns before the span; what is repeated is left out of the loss mask, so every assistant text
is under the mask exactly once. A turn is never cut: a window holds fewer than ``span_tokens``
tokens before its last new turn.

The template of one turn is ``### role``, a line feed, the text, ``</turn>`` and a line feed.
Inside roles and texts a backslash is put before every backslash, ``#`` and ``<``, and in roles
before line feeds, so no text can end a turn or begin one; ``unescape`` takes them out again.

Prefix sums and span numbers come from window functions, which spill, and only the turns of
one window are ever gathered. ``read_back`` restores turns and loss texts from the formatted
windows alone (text, mask, number of repeated turns).

Edge cases: a null text or role counts as empty; rows are ordered by turn (null last), then
role, then text; repeated rows are turns of their own; rows whose conversation id is null form
one conversation; a conversation without assistant turns has an empty mask; an empty table
gives an empty one. Extra input columns are not used and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Production parameters: new tokens per window, and repeated turns before them.
SPAN_TOKENS, HISTORY = 512, 2
TOKEN = r"[^\x20\x09-\x0D]+"
_TURN = r"(?s)### ((?:[^\\\n]++|\\.)*+)\n((?:[^\\<]++|\\.)*+)</turn>\n"


def escape(text: Column, role: bool = False) -> Column:
    return F.regexp_replace(text, r"([\\#<\n])" if role else r"([\\#<])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_spans(turns: DataFrame, span_tokens: int = SPAN_TOKENS) -> DataFrame:
    """One row per turn: conv_id, place (from 1), role, text, system (first turn, to be
    retained), span."""
    rows = turns.select(F.col("conv_id"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = rows.select("conv_id", "role", "text", F.row_number().over(order).alias("place"),
                       F.regexp_count("text", F.lit(TOKEN)).cast("long").alias("tokens"))
    up_to = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    system = (F.col("place") == 1) & (F.col("role") == "system")
    rows = rows.withColumn("system", system)
    counted = F.when(F.col("system"), 0).otherwise(F.col("tokens"))
    begin = F.coalesce(F.sum(counted).over(up_to), F.lit(0))
    return rows.withColumn("span", F.floor(begin / F.lit(span_tokens))).drop("tokens")


def windows(turns: DataFrame, span_tokens: int = SPAN_TOKENS, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, span, formatted, repeated (leading turns that repeat
    earlier ones), mask (array of struct(start, end): code points of ``formatted``, end
    exclusive, that the loss covers; one for each new assistant turn, in order)."""
    spans = turn_spans(turns, span_tokens)
    later = Window.partitionBy("conv_id").orderBy("place").rowsBetween(1, history) if history else None
    # the spans, other than its own, in which a turn is repeated as history; and every other span for the system turn
    ahead = F.array_distinct(F.collect_list("span").over(later)) if history else F.array().cast("array<bigint>")
    last = F.max("span").over(Window.partitionBy("conv_id"))
    rows = spans.withColumns({"ahead": ahead, "last": last})
    used = F.when(F.col("system"), F.sequence(F.col("span"), F.col("last"))).otherwise(F.array_union(F.array("span"), "ahead"))
    rows = rows.withColumn("used", used)
    piece = F.concat(F.lit("### "), escape(F.col("role"), role=True), F.lit("\n"), escape(F.col("text")), F.lit("</turn>\n"))
    rows = rows.select("conv_id", "place", F.col("span").alias("own"), "role", piece.alias("piece"), F.length(escape(F.col("text"))).alias("inner"), F.explode("used").alias("span"))
    # a span without a turn of its own never comes out of the history; a system turn alone may name one
    inside = Window.partitionBy("conv_id", "span")
    rows = rows.withColumn("new", F.col("span") == F.col("own")).withColumn("any_new", F.max("new").over(inside)).where("any_new")
    until = inside.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("piece")).over(until) - F.lit(len("</turn>\n"))
    rows = rows.withColumn("part", F.struct("place", "new", "piece", F.when(F.col("new") & (F.col("role") == "assistant"),
                                            F.struct((end - F.col("inner")).alias("start"), end.alias("end"))).alias("mask")))
    done = rows.groupBy("conv_id", "span").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return done.select("conv_id", "span", F.array_join(F.col("parts.piece"), "").alias("formatted"),
                       F.size(F.filter("parts", lambda p: ~p["new"])).alias("repeated"),
                       F.filter(F.col("parts.mask"), lambda m: m.isNotNull()).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the windows alone: n_turns, turns (role, line feed, text,
    line feed for each turn), loss (all text under the mask), formatted_chars."""
    found = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(0))
    new = F.slice(found, F.col("repeated") + 1, F.greatest(F.size(found) - F.col("repeated"), F.lit(0)))
    roles = F.transform(new, lambda t: F.concat(unescape(F.regexp_extract(t, _TURN, 1)), F.lit("\n"), unescape(F.regexp_extract(t, _TURN, 2)), F.lit("\n")))
    loss = F.transform("mask", lambda m: unescape(F.substring("formatted", m["start"].cast("int") + 1, (m["end"] - m["start"]).cast("int"))))
    rows = formatted.select("conv_id", F.struct(F.col("span"), F.array_join(roles, "").alias("turns"), F.array_join(loss, "").alias("loss")).alias("w"),
                            F.size(new).cast("long").alias("n"), F.length("formatted").cast("long").alias("chars"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    return whole.select("conv_id", "n_turns", F.array_join(F.col("w.turns"), "").alias("turns"), F.array_join(F.col("w.loss"), "").alias("loss"), "formatted_chars")


def digests(formatted: DataFrame) -> DataFrame:
    """``read_back`` with digests in place of the texts."""
    return read_back(formatted).select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


#: ``digests(windows(...))`` of ``conversations`` and one more conversation in DuckDB SQL.
ORACLE = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
placed as (select *, row_number() over (partition by conv_id order by turn nulls last, role, text) as place,
  len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as tokens from turns),
spanned as (select *, place = 1 and role = 'system' as retained,
  coalesce(sum(case when place = 1 and role = 'system' then 0 else tokens end)
    over (partition by conv_id order by place rows between unbounded preceding and 1 preceding), 0) // 512 as span,
  length('### ' || regexp_replace(role, '([\\#<' || chr(10) || '])', '\\\1', 'g') || ' ' || regexp_replace(text, '([\\#<])', '\\\1', 'g') || '</turn> ') as chars
  from placed),
used as (select *, case when retained then (select count(distinct s.span) from spanned s where s.conv_id is not distinct from x.conv_id)
  else 1 + coalesce(cast(lead(span, 1) over w <> span as int), 0)
    + coalesce(cast(lead(span, 2) over w <> span and lead(span, 2) over w <> lead(span, 1) over w as int), 0) end as uses
  from spanned x window w as (partition by conv_id order by place))
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars * uses) as bigint) as formatted_chars
from used group by conv_id
"""
