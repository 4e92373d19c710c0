"""Mixing sources to target weights by systematic sampling (DataFrame operations only).

Every document of a source is expected to be taken ``target / source_size`` times. The
expected copies are summed up along the documents of the source, one random offset per source
is added, and a document is emitted once for each integer boundary that its share crosses.
The documents of a source are walked in order of size, so that the words taken come near the
target although the draw is on documents.

The prefix sum never holds a source in one task. Documents are dealt to cells (source, leading
digits of the size, salt); the number of salts grows with the square root of the number of
rows, so that both the rows of a cell and the cells of a source stay small. A window numbers
the rows of each cell; a second one adds up the counts of the cells before it.

Edge cases: a null text has size 0; null sources form one source, the last in order; a source
without words has target 0 and is not emitted; documents without words elsewhere are drawn
like others; repeated rows are drawn as rows of their own; ties in size go by doc_id (null
last), then by digest, then by the other columns, so reruns agree. An empty table gives an empty one. Input columns named
like an added column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Targets of the sources, from one row (skey, source_size) per source.

    Weights repeat along the sources in key order. ``share`` of all words is dealt by weight; a
    target stops at ``cap`` times its source, and the excess is dealt again. Solved at once:
    by rising size per weight, a source is capped if its share of what the sources before it
    leave is above its cap.
    """
    everything = Window.partitionBy()
    array = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("w", F.element_at(array, (F.row_number().over(everything.orderBy("skey")) - 1) % len(weights) + 1))
    by_room = everything.orderBy(F.col("source_size") / F.col("w"), "skey")
    top = F.col("source_size") * F.lit(float(cap))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    before = F.coalesce(F.sum(top).over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by_room.rowsBetween(0, Window.unboundedFollowing))
    placed = ranked.withColumns({"total": total, "top": top, "full": (total - before) * F.col("w") > top * rest})
    full = F.sum(F.when(F.col("full"), F.col("top")).otherwise(0.0)).over(everything)
    open_w = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(everything)
    target = F.when(F.col("full"), F.col("top")).otherwise(F.col("w") * (F.col("total") - full) / open_w)
    return placed.withColumn("target", target).select("skey", "source_size", "target")


def _offset(key, seed: str):
    """A fixed random number in [0, 1) for each key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _others(docs: DataFrame, text: str) -> Column:
    """A hash of the columns beside the text, nulls included, that puts rows of one id and text in
    a fixed order; columns that cannot be hashed take no part."""
    cols = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != text and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(F.concat(F.lit(""), *[F.isnull(c).cast("string") for c in cols]), *cols)


def draw(docs: DataFrame, text: str = "text", source: str = "source", order: str = "doc_id", weights=(5, 2, 1),
         share: float = 1.5, cap: float = 2.0, seed: str = SEED, tie: Column | None = None) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` to every row of ``docs``."""
    added = ("size", "source_size", "target", "copies")
    kept = [c for c in docs.columns if c.lower() not in added]
    body = F.coalesce(F.col(text), F.lit(""))
    salts = F.ceil(F.sqrt(docs.agg(F.count("*")).scalar()) / 64)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.when(F.col(source).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source))).alias("skey"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        F.col(order).alias("place"),
        (_others(docs, text) if tie is None else tie).alias("tie"),
        F.md5(F.concat(F.coalesce(F.col(order).cast("string"), F.lit("")), F.lit("|"), body)).alias("digest"),
    )
    digits = F.col("size").cast("string")
    rows = rows.withColumns({
        "band": F.length(digits) * 10 + F.substring(digits, 1, 1).cast("int"),
        "salt": F.conv(F.substring("digest", 1, 7), 16, 10).cast("long") % salts,
    })
    cell = ["skey", "band", "salt"]
    cells = rows.groupBy(*cell).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    sources = source_targets(cells.groupBy("skey").agg(F.sum("words").alias("source_size")), weights, share, cap)
    before = Window.partitionBy("skey").orderBy("band", "salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).join(sources, "skey").drop("n", "words")
    inside = Window.partitionBy(*cell).orderBy("size", F.col("place").asc_nulls_last(), "digest", "tie")
    ranked = rows.withColumn("rank", F.row_number().over(inside)).join(cells, cell)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = lambda k: F.floor(k * ratio + _offset(F.col("skey"), seed))
    place = F.col("ahead") + F.col("rank")
    copies = F.least(crossed(place) - crossed(place - 1), F.ceil(ratio))
    return ranked.select("row.*", "size", "source_size", F.col("target"), copies.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: each row as often as it was drawn."""
    drawn = draw(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
                             *[F.col(options.get(k, k)).alias(f"{k}_") for k in ("text", "source")],
                             F.col(options.get("order", "doc_id")).alias("order_"), _others(docs, options.get("text", "text")).alias("tie_")),
                 text="text_", source="source_", order="order_", tie=F.col("tie_"), **{k: v for k, v in options.items() if k not in ("text", "source", "order")})
    return drawn.where("copies > 0").select("whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("whole.*")


#: The same draw in DuckDB SQL, over ``documents``.
ORACLE = """
with sized as (
  select doc_id, case when source is null then '1' else '0' || source end as skey,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
    md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')) as digest
  from documents),
dealt as (
  select *, length(cast(size as varchar)) * 10 + cast(left(cast(size as varchar), 1) as int) as band,
    cast('0x' || left(digest, 7) as bigint) % cast(ceil(sqrt((select count(*) from documents)) / 64) as bigint) as salt
  from sized),
ranked as (select *, row_number() over (partition by skey order by band, salt, size, doc_id nulls last, digest) as place from dealt),
sums as (select skey, cast(sum(size) as bigint) as source_size from dealt group by skey),
weighed as (select *, [5.0, 2.0, 1.0][(row_number() over (order by skey) - 1) % 3 + 1]::double as w,
  1.5::double * sum(source_size) over () as total, 2.0::double * source_size as top from sums),
placed as (select *, (total - coalesce(sum(top) over (order by source_size / w, skey rows between unbounded preceding and 1 preceding), 0)) * w
  > top * sum(w) over (order by source_size / w, skey rows between current row and unbounded following) as is_full from weighed),
targets as (select skey, source_size, case when is_full then top
  else w * (total - sum(case when is_full then top else 0 end) over ()) / sum(case when is_full then 0 else w end) over () end as target from placed),
drawn as (select doc_id, size, source_size, target, place,
  case when source_size > 0 then target / source_size else 0 end as ratio,
  cast('0x' || left(md5('mix-1:' || skey), 8) as bigint) / 4294967296.0::double as u from ranked join targets using (skey))
select doc_id, size, source_size, target,
  cast(least(floor(place * ratio + u) - floor((place - 1) * ratio + u), ceil(ratio)) * size as bigint) as taken from drawn
"""
