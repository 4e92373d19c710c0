"""Landing zone: JSON documents in dated folders -> raw documents, and the landing sink.

Layout: ``<landing>/<YYYY_MM_DD>/<name>.json[.gz]`` (a ``landing_day=`` prefix on the
folder is accepted too). Two framings are read:

* ``"file"``   one JSON document per file (pretty printed or not) - the feed's own files;
* ``"lines"``  one document per line (JSON Lines), as the Spark sink below writes them.

``.gz`` files are opened by extension. Reading is a plain file scan: every task reads
whole files, nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlake.functions import feed_ts, landing_stamp, to_ntz
from airlake.schemas import DOCUMENT, LANDING_DIR_FORMAT, LANDING_FILE_PREFIX, PAGE_LIMIT, RECORD_FIELDS
from airlake.session import FREED, settings

# the sink keeps each delivery in a folder of its own below the day
_DAY_IN_PATH = r"(\d{4}_\d{2}_\d{2})/(?:landing_name=[^/]+/)?[^/]+$"
_REL_PATH = r"([^/]+/(?:landing_name=[^/]+/)?[^/]+)$"
#: Cells that the records of an hour are numbered in.
CELLS = 256
#: A task that collects pages sorts its records, which spills, and holds the page it is at. The hash
#: aggregate would hold 128 pages of thousands of records, and their copies, in unmanaged memory.
PAGE_BY_PAGE = {"spark.sql.execution.useObjectHashAggregateExec": "false"}
#: Longer than any feed: a file is new however old it is.
NO_FILE_AGE = "36500d"


def _reader(spark: SparkSession, framing: str, stream: bool, max_files_per_trigger: int | None, archive: str | None = None):
    r = spark.readStream if stream else spark.read
    r = (r.format("text").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "*.json*"))
    if framing == "file":
        r = r.option("wholetext", "true")
    elif framing != "lines":
        raise ValueError("framing must be 'file' or 'lines'")
    if stream:
        # the default forgets files a week older than the newest one, and would never load them
        r = r.option("maxFileAge", NO_FILE_AGE)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        if archive:
            r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r


def read_landing(spark: SparkSession, path: str, framing: str = "file", stream: bool = False,
                 max_files_per_trigger: int | None = 1000, days=None, archive: str | None = None) -> DataFrame:
    """Landed documents with file metadata.

    A stream remembers every file it has loaded, whatever its age. ``archive``: a folder to
    which loaded files are moved, which keeps that memory and the listing small.

    Columns: ``doc`` (text), ``_stg_file_name`` (day folder/file), ``_stg_file_load_ts``
    (file modification time), ``landing_date`` (from the folder name). ``days`` (batch
    only) lists only the dated folders of those days - the other folders are not listed.
    """
    r = _reader(spark, framing, stream, max_files_per_trigger, archive)
    if days is not None and not stream:
        stamps = ",".join(d.strftime("%Y_%m_%d") if hasattr(d, "strftime") else str(d) for d in days)
        df = r.load(f"{path.rstrip('/')}/{{,landing_day=}}{{{stamps}}}")
    else:
        df = r.load(path)
    return with_file_metadata(df.withColumnRenamed("value", "doc"))


def read_documents_typed(spark: SparkSession, path: str, framing: str = "file") -> DataFrame:
    """Landed documents read with the declared document schema (no inference).

    The typed alternative to the VARIANT path: nested fields are pruned at the scan, so a
    query touching ``records.pollutant_avg`` parses only what it needs. Malformed JSON gives
    a row of NULLs (PERMISSIVE); the raw load keeps the strict VARIANT path.
    """
    r = (spark.read.schema(DOCUMENT).option("recursiveFileLookup", "true")
         .option("pathGlobFilter", "*.json*").option("multiLine", str(framing == "file").lower()))
    df = r.json(path)
    p = F.col("_metadata.file_path")
    return df.select("*", F.regexp_extract(p, _REL_PATH, 1).alias("_stg_file_name"),
                     to_ntz("_metadata.file_modification_time").alias("_stg_file_load_ts"))


def with_file_metadata(df: DataFrame) -> DataFrame:
    p = F.col("_metadata.file_path")
    return df.select(
        "doc",
        F.regexp_extract(p, _REL_PATH, 1).alias("_stg_file_name"),
        to_ntz("_metadata.file_modification_time").alias("_stg_file_load_ts"),
        F.to_date(F.regexp_extract(p, _DAY_IN_PATH, 1), LANDING_DIR_FORMAT).alias("landing_date"),
    )


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """Inventory of landed files (path, size, modification time) without reading them."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.json*").load(path)
            .select("path", "length", F.col("modificationTime").cast("timestamp_ntz").alias("modification_time")))


def _header(parsed: str = "json_data") -> tuple[Column, Column, Column]:
    """First record's time, number of records and version of a parsed document."""
    get = F.try_variant_get
    return (feed_ts(get(parsed, "$.records[0].last_update", "string")), get(parsed, "$.total", "int"),
            get(parsed, "$.version", "string"))


def rejected_documents(docs: DataFrame) -> DataFrame:
    """Landed documents that ``raw_documents(on_error="skip")`` leaves out, as they are, with the first
    thing wrong: ``malformed`` JSON, no readable ``time``, no ``total``, no ``version``. (A file of no
    bytes holds no document; ``list_landing`` shows it.)"""
    ts, total, version = _header()
    problem = (F.when(F.col("json_data").isNull(), "malformed").when(ts.isNull(), "time")
               .when(total.isNull(), "total").when(version.isNull(), "version"))
    marked = docs.select("*", F.try_parse_json("doc").alias("json_data")).withColumn("problem", problem)
    return marked.filter(F.col("problem").isNotNull()).select(
        "doc", "problem", "_stg_file_name", "_stg_file_load_ts", F.md5("doc").alias("_stg_file_md5"), "landing_date")


def raw_documents(docs: DataFrame, on_error: str = "abort", copy_ts: Column | None = None) -> DataFrame:
    """Landed documents -> raw rows (without ``id``).

    ``index_record_ts`` is the *first* record's ``last_update``, stamped on the whole
    document. ``on_error="abort"``: malformed JSON, an unparsable first timestamp, or a
    missing ``total`` / ``version`` fails the load (NOT NULL + abort). ``"skip"``: such
    documents are left out; ``rejected_documents`` gives them.
    """
    if on_error not in ("abort", "skip"):
        raise ValueError("on_error must be 'abort' or 'skip'")
    strict = on_error == "abort"
    v = F.parse_json("doc") if strict else F.try_parse_json("doc")
    get = F.try_variant_get
    d = docs.select("*", v.alias("json_data"))
    ts, total, version = _header()
    bad = F.col("json_data").isNull() | ts.isNull() | total.isNull() | version.isNull()
    if strict:
        ts = F.when(bad, F.raise_error(F.concat(F.lit("raw load aborted: bad document in "),
                                                F.col("_stg_file_name")))).otherwise(ts)
    else:
        d = d.filter(~bad)
    return d.select(
        ts.cast("timestamp_ntz").alias("index_record_ts"),
        "json_data",
        total.alias("record_count"),
        version.alias("json_version"),
        F.coalesce(get("json_data", "$.offset", "string"), F.lit("0")).alias("page_offset"),
        F.coalesce(get("json_data", "$.limit", "string"), F.lit("")).alias("page_limit"),
        get("json_data", "$.created", "long").alias("delivered"),
        "_stg_file_name", "_stg_file_load_ts",
        F.md5("doc").alias("_stg_file_md5"),
        (copy_ts if copy_ts is not None else F.current_timestamp()).cast("timestamp_ntz").alias("_copy_data_ts"),
        "landing_date",
    )


def documents_from_records(records: DataFrame, limit: int = PAGE_LIMIT,
                           delivered_at: Column | None = None) -> DataFrame:
    """Feed records -> JSON documents, one per (hour, page) with at most ``limit`` records.

    As in the feed's own header, ``total`` is the number of records of the whole hour,
    ``count`` the number in this document and ``offset`` where its page starts.

    ``records``: ``index_record_ts`` plus the eleven text fields of a record. Records are dealt
    to (hour, cell) by a hash of the whole record and numbered there; the cells of an hour
    follow each other, so a record's number in its hour is its number in the cell plus the
    sizes of the cells before it. A hot station or hour is thus numbered in many tasks, and no
    page holds more than ``limit`` records.
    """
    delivered_at = delivered_at if delivered_at is not None else F.current_timestamp()
    text = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in RECORD_FIELDS]
    rec = F.struct(*[F.col(f) for f in RECORD_FIELDS])
    dealt = records.select("index_record_ts", rec.alias("rec"), F.pmod(F.xxhash64(*text), F.lit(CELLS)).alias("__cell"))
    sizes = dealt.groupBy("index_record_ts", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    hour = Window.partitionBy("index_record_ts")                # at most CELLS rows each
    before = hour.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns({"__total": F.sum("__n").over(hour), "__ahead": F.coalesce(F.sum("__n").over(before), F.lit(0))})
    inside = Window.partitionBy("index_record_ts", "__cell").orderBy("rec")
    place = F.col("__ahead") + F.row_number().over(inside) - 1
    paged = (dealt.join(sizes, ["index_record_ts", "__cell"])
             .withColumn("__page", F.floor(place / F.lit(limit)).cast("int")))
    # to the document's task first: a partial collect_list before it would save no bytes
    grouped = (paged.repartition("index_record_ts", "__page")
               .groupBy("index_record_ts", "__page")
               .agg(F.sort_array(F.collect_list("rec")).alias("records"), F.count(F.lit(1)).cast("int").alias("count"),
                    F.max("__total").cast("int").alias("total")))
    epoch = F.unix_timestamp(delivered_at.cast("timestamp")).cast("long")
    iso = F.date_format(delivered_at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    doc = F.struct(
        epoch.alias("created"), epoch.alias("updated"), iso.alias("created_date"), iso.alias("updated_date"),
        F.lit(1).alias("active"), F.lit("air-quality").alias("index_name"), F.lit("Resource lists").alias("message"),
        F.lit("2.2.0").alias("version"), F.lit("ok").alias("status"),
        F.col("total"), F.col("count"), F.lit(str(limit)).alias("limit"),
        (F.col("__page") * F.lit(limit)).cast("string").alias("offset"),
        F.array(*[F.lit(f) for f in RECORD_FIELDS]).alias("field"),
        F.col("records"),
    )
    day = landing_stamp(delivered_at, fmt=LANDING_DIR_FORMAT)     # dated folder on the feed's clock
    name = F.concat(F.lit(LANDING_FILE_PREFIX), landing_stamp(delivered_at))
    return (grouped.select(day.alias("landing_day"), name.alias("landing_name"), doc.alias("d"))
            .select("landing_day", "landing_name", "d.*"))


def write_landing(documents: DataFrame, landing: str, compression: str = "gzip") -> None:
    """Write a delivery as JSON-Lines files (``*.json.gz``) into
    ``landing_day=YYYY_MM_DD/landing_name=air_quality_data_<stamp>``.

    The name is the delivery's, as in the feed, and writing it again replaces its files, so a
    repeated job does not land a delivery twice. Each row is one line; many documents share a
    file, each keeps its own md5.
    """
    with settings(documents.sparkSession, PAGE_BY_PAGE | FREED):
        (documents.hint("rebalance", "landing_day", "landing_name").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("landing_day", "landing_name")
         .option("compression", compression).json(landing))
