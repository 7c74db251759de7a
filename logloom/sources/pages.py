"""Paged JSON documents: landing, scanning, record-path explode.

The source pulls pages over HTTP and appends them one by one.  Here pages are
documents in a landing folder, so a whole pull is ONE multi-file read that
Spark spreads over tasks.  A file up to ``WHOLE_FILE`` bytes is read whole and
holds either one document, printed in any way, or one document per line; it is
taken for lines when its first line is a document by itself.  A larger file
holds a document per line and is split over tasks.  So is, with the same result,
a file over ``BY_LINE`` bytes of which each line is a document that tells its page
number: a task then holds one of its documents, not all.
Folder names such as ``workspace_id=W1/model_id=M3/kind=imports`` give the
page's context (P06); its number stands in the document (``page``) or in a
folder ``page=<n>``.

Nothing is lost without a sign: a document that isn't JSON, or that announces
records and lacks their array, ends a batch read with an error and goes to the
quarantine of a streaming ingest.  A page that announces none and has no array
is an empty page, as for the source.  Fields that the schema doesn't know are
kept in the map ``extra``, of events and of list records alike.

``land_pages`` writes such a folder from a DataFrame.  Page sizes are bounded,
so collecting the records of one page into its array is bounded too, and a task
collects one page at a time; pages never span two context groups.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom import schemas
from logloom.operators.identity import row_index
from logloom.session import sql_conf

#: Landed pages per file, at most, and how a file is compressed: JSON pages come to a tenth, as an API sends them.
PAGES_PER_FILE, LANDED_AS = 8, "gzip"

ENVELOPES = ("events", "meta", "scim")

#: Bytes up to which a landed file is read as one row; a page of 10,000 events has some 10 MB.
WHOLE_FILE = 64 * 1024 * 1024
#: Bytes from which a file of pages by line is read a line at a time, as compressed pages come to ten times its size.
BY_LINE = 1024 * 1024
#: Large files named in one read, at most: their paths pass through the driver.
MAX_LARGE = 10_000


def _paging_struct(envelope: str, page: Column, size: int, total: Column, n_in_page: Column,
                   last_page: Column, url: str) -> list[Column]:
    if envelope == "events":
        next_url = F.when(page < last_page,
                          F.concat(F.lit(f"{url}?page="), (page + 1).cast("string")))
        return [F.struct(F.struct(total.alias("totalSize"), next_url.alias("nextUrl")).alias("paging")).alias("meta")]
    if envelope == "meta":
        return [F.struct(F.struct(n_in_page.alias("currentPageSize"), (page * size).alias("offset"),
                                  total.alias("totalSize")).alias("paging")).alias("meta")]
    if envelope == "scim":
        return [F.lit(size).cast("bigint").alias("itemsPerPage"),
                (page * size + 1).alias("startIndex"), total.alias("totalResults")]
    raise ValueError(f"unknown envelope {envelope!r}")


def land_pages(records: DataFrame, out_dir: str, record_path: str, page_size: int,
               order_cols: list[str], envelope: str = "meta", group_cols: list[str] | None = None,
               url: str = "https://source.invalid/api", mode: str = "overwrite") -> None:
    """Write ``records`` as API-style pages under ``out_dir``.

    Rows are numbered once in ``group_cols + order_cols`` order
    (``row_index``: range partitions + offsets); a group's first index turns
    the global index into a position inside its group, so pages restart per
    group without any per-group window.  Each page becomes one JSON line,
    written under ``[group dirs/]page=<n>/``.
    """
    group_cols = group_cols or []
    rec_cols = [c for c in records.columns if c not in group_cols]
    numbered = row_index(records, group_cols + order_cols, out_col="__rn")
    if group_cols:
        starts = numbered.groupBy(*group_cols).agg(F.min("__rn").alias("__start"),
                                                   F.count(F.lit(1)).alias("__total"))
        numbered = numbered.join(starts, group_cols)
    else:
        # One group: its size is a single number, bound as a literal.
        n_rows = numbered.count()
        numbered = numbered.select("*", F.lit(0).cast("bigint").alias("__start"),
                                   F.lit(n_rows).cast("bigint").alias("__total"))
    local = F.col("__rn") - F.col("__start")
    numbered = numbered.select(
        *group_cols, "__total",
        F.call_function("div", local, F.lit(page_size)).alias("page"),
        F.struct(local.alias("pos"), F.struct(*[F.col(f"`{c}`") for c in rec_cols]).alias("rec")).alias("__item"),
    )
    # dealt by page and sorted, which spills: a hash aggregate would hold the arrays of up to 128 pages a task
    pages = numbered.repartition(*group_cols, "page").groupBy(*group_cols, "page", "__total").agg(
        F.sort_array(F.collect_list("__item")).alias("__items"))
    total = F.col("__total")
    last_page = F.call_function("div", total - 1, F.lit(page_size))
    body = F.struct(
        F.transform("__items", lambda x: x["rec"]).alias(record_path),
        *_paging_struct(envelope, F.col("page"), page_size, total, F.size("__items").cast("bigint"),
                        last_page, url),
        F.col("page"),
    )
    docs = pages.select(*group_cols, F.to_json(body).alias("value"))
    writer = docs.write.mode(mode).option("maxRecordsPerFile", PAGES_PER_FILE).option("compression", LANDED_AS)
    with sql_conf(records.sparkSession, {"spark.sql.execution.useObjectHashAggregateExec": "false"}):
        (writer.partitionBy(*group_cols) if group_cols else writer).text(out_dir)


def page_schema(record_path: str, record: T.StructType, envelope: str = "meta",
                context: list[str] | None = None) -> T.StructType:
    """Schema of one landed page: its record array first, then its paging facts, context and number."""
    records = T.StructField(record_path, T.ArrayType(record))
    if envelope == "events":
        fields = [records, schemas.EVENT_PAGE["meta"]]
    elif envelope == "scim":
        fields = [records] + [T.StructField(n, T.LongType()) for n in ("itemsPerPage", "startIndex", "totalResults")]
    else:
        fields = list(schemas.metadata_page(record_path, record).fields)
        fields[0] = records
    extra = [T.StructField(c, T.StringType(), True, {"context": True}) for c in (context or [])]
    return T.StructType(fields + extra + [T.StructField("page", T.LongType())])


def missing(err: AnalysisException) -> bool:
    """Is the error that a folder isn't there (or has no file yet)?"""
    return err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def file_sizes(reader, path: str) -> DataFrame:
    """path and length of landed files, by a batch or stream reader; contents are not read."""
    files = reader.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path"), F.col("length"))


def landed(spark: SparkSession, path: str | list[str], large: list[str] | None = None, whole_file: int = WHOLE_FILE,
           by_line: bool = False) -> DataFrame:
    """path, doc_no, doc: the documents of landed files, in one read for whole files and one for those read by line.

    ``large``: which of the files pass ``whole_file`` bytes, and ``by_line``: whether others pass
    ``BY_LINE`` and are looked at; found by a listing unless given.
    """
    if large is None:
        over = file_sizes(spark.read, path).where(F.col("length") > min(BY_LINE, whole_file))
        found = over.orderBy(F.desc("length")).limit(MAX_LARGE + 1).collect()
        large = [r["path"] for r in found if r["length"] > whole_file]
        if len(large) > MAX_LARGE:
            raise ValueError(f"more than {MAX_LARGE} files over {whole_file} bytes under {path}")
        by_line = len(found) > len(large)
    where, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    at_once, frames = size <= whole_file, []
    if by_line and (odd := _not_by_line(spark, path, whole_file)) is not None:
        frames.append(_lines(spark.read.text(path, recursiveFileLookup=True).where((size > BY_LINE) & at_once & ~where.isin(odd))))
        at_once = at_once & ((size <= BY_LINE) | where.isin(odd))
    frames.append(documents(whole.select(where.alias("path"), "value").where(at_once)))
    if large:
        frames.append(_lines(spark.read.text(large)))
    docs = frames[0]
    for f in frames[1:]:
        docs = docs.unionByName(f)
    return docs


def _lines(text: DataFrame) -> DataFrame:
    lines = text.where(F.trim("value") != "")
    return lines.select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("doc_no"), F.col("value").alias("doc"))


def _not_by_line(spark: SparkSession, path: str | list[str], whole_file: int) -> list[str] | None:
    """Files over ``BY_LINE`` bytes with a line that is no document with its page number; None for more than ``MAX_LARGE``.

    All other files of that size read the same by line, whatever the tasks that read them.
    """
    size = F.col("_metadata.file_size")
    lines = _lines(spark.read.text(path, recursiveFileLookup=True).where((size > BY_LINE) & (size <= whole_file)))
    numbered = F.coalesce(F.get_json_object("doc", "$.page").rlike("^-?[0-9]{1,18}$"), F.lit(False))
    odd = lines.where(~numbered).select("path").distinct().limit(MAX_LARGE + 1).collect()
    return [r["path"] for r in odd] if len(odd) <= MAX_LARGE else None


def documents(files: DataFrame) -> DataFrame:
    """path, doc_no, doc: the documents of files that were read whole (path, value)."""
    lines = F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")
    by_line = F.get_json_object(F.get(lines, F.lit(0)), "$").isNotNull()
    docs = F.when(by_line, lines).otherwise(F.filter(F.array("value"), lambda x: F.trim(x) != ""))
    return files.select("path", F.posexplode(docs).alias("doc_no", "doc")).withColumn("doc_no", F.col("doc_no").cast("bigint"))


def folder_value(name: str, path: str = "path") -> Column:
    """The value of ``<name>=<value>`` among a path's folders (names are escaped once by the writer, once in the path)."""
    found = F.regexp_extract(path, f"/{name}=([^/]*)/", 1)
    return F.nullif(F.url_decode(F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))), F.lit(""))


_BAD = "__unreadable"


def _announced(fields: dict[str, Column], schema: T.StructType) -> Column | None:
    """How many records a page says its list has, for page schemas that have a place for it."""
    if "totalResults" in fields:
        return fields["totalResults"]
    if "meta" in fields and isinstance(schema["meta"].dataType, T.StructType):
        return fields["meta"]["paging"]["totalSize"]
    return None


def parsed(docs: DataFrame, schema: T.StructType, keep: list[str] | None = None, names: list[str] | None = None) -> DataFrame:
    """The documents' fields, context and page number, and whether a document is unreadable.

    A document is unreadable if it isn't JSON as a whole, or lacks its first field (the record array, which may stand under one of
    ``names``) though it announces records.  An array that is absent where none are announced is empty.
    """
    context = [f.name for f in schema.fields if f.metadata.get("context")]
    records, *inner = [f for f in schema.fields if f.name not in context]
    arrays = [T.StructField(n, records.dataType) for n in names or [records.name]]
    shape = T.StructType([*arrays, *inner, T.StructField(_BAD, T.StringType())])
    rows = docs.select(*(keep or []), "path", "doc_no", F.from_json("doc", shape, {"columnNameOfCorruptRecord": _BAD}).alias("__d"))
    found = F.coalesce(*[F.col(f"__d.`{f.name}`") for f in arrays])
    fields = {f.name: F.col(f"__d.`{f.name}`") for f in inner} | {c: folder_value(c) for c in context}
    if "page" in fields:
        fields["page"] = F.coalesce(fields["page"], folder_value("page").cast("bigint"), F.col("doc_no").cast("bigint"))
    bad = F.col("__d").isNull() | F.col(f"__d.{_BAD}").isNotNull()
    announced = _announced(fields, schema)
    if announced is None:
        bad = bad | found.isNull()
    else:
        bad = bad | (found.isNull() & (F.coalesce(announced, F.lit(0)) > 0))
        found = F.when(~bad, F.coalesce(found, F.array().cast(records.dataType)))
    fields[records.name] = found
    return rows.select(*(keep or []), *[fields[f.name].alias(f.name) for f in schema.fields], bad.alias("unreadable"))


def read_pages(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False, names: list[str] | None = None) -> DataFrame:
    """All pages under ``path`` in one read (U01: union of pages, duplicates kept).

    An unreadable page fails the query.  ``missing_ok``: a folder nothing was
    landed in reads as no pages (an empty, typed table), as the source carries
    on when a list is empty.  ``names``: the names under one of which the record
    array stands, the schema's first field in the result.
    """
    try:
        docs = landed(spark, path)
    except AnalysisException as err:
        if not missing_ok or not missing(err):
            raise
        return spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
    # the first field stands for the check, so it is made whenever records are read
    rows, first = parsed(docs, schema, keep=["doc"], names=names), schema.fields[0]
    told = F.concat(F.lit("unreadable page: "), F.substring("doc", 1, 200))
    checked = F.when(F.col("unreadable"), F.raise_error(told).cast(first.dataType)).otherwise(F.col(f"`{first.name}`"))
    return rows.select(checked.alias(first.name), *[F.col(f"`{f.name}`") for f in schema.fields[1:]])


def explode_records(pages: DataFrame, record_path: str, keep: list[str] | None = None) -> DataFrame:
    """One row per element of the record array, with its page and position."""
    keep = keep or []
    rows = pages.select(*keep, "page", F.posexplode(record_path).alias("pos", "__r"))
    rec_type = pages.schema[record_path].dataType.elementType
    return rows.select(*keep, "page", "pos", *[F.col(f"__r.`{f.name}`").alias(f.name) for f in rec_type.fields])


# --- records kept as JSON text until their unknown fields are saved ---

#: New fields of a list that become columns of their own, at most; their names pass through the driver.
MAX_NEW_FIELDS = 200


def event_page_schema(context: list[str] | None = None) -> T.StructType:
    return page_schema("response", T.StringType(), "events", context)


def known_and_extra(raw: Column, record: T.StructType) -> tuple[Column, Column]:
    """A record's known fields as a struct, and all others as JSON text by dotted name (null if none).

    The names alone are looked at first; maps of the values are made only of
    records that have unknown ones.  The two stay apart until they are columns:
    fields taken out of the parsed struct in the same step would each be parsed anew.
    """
    texts = "map<string,string>"
    none = F.create_map().cast(texts)
    groups = [(raw, "", record)] + [(F.get_json_object(raw, f"$.{f.name}"), f"{f.name}.", f.dataType)
                                    for f in record.fields if isinstance(f.dataType, T.StructType)]
    odd, parts = F.lit(False), []
    for text, prefix, kind in groups:
        odd = odd | F.coalesce(F.size(F.array_except(F.json_object_keys(text), F.array(*map(F.lit, kind.names)))) > 0, F.lit(False))
        parts.append(_others(F.coalesce(F.from_json(text, texts), none), kind.names, prefix))
    return F.from_json(raw, record), F.when(odd, F.map_concat(*parts))


def _others(fields: Column, names: list[str], prefix: str) -> Column:
    left = F.map_filter(fields, lambda k, _: ~k.isin(names))
    return F.transform_keys(left, lambda k, _: F.concat(F.lit(prefix), k)) if prefix else left


def _records(rows: DataFrame, record: T.StructType, keep: list[str]) -> DataFrame:
    known, extra = known_and_extra(F.col("raw"), record)
    return rows.select(*keep, known.alias("known"), extra.alias("extra")).select(*keep, "known.*", "extra")


def list_records(pages: DataFrame, record_path: str, record: T.StructType) -> DataFrame:
    """P01 over pages whose records are JSON text: the record's fields and ``extra``."""
    return _records(pages.select(F.explode(record_path).alias("raw")), record, [])


def widened(records: DataFrame, max_new: int = MAX_NEW_FIELDS) -> DataFrame:
    """``extra`` as text columns, one per new field of any record, as the source's tables grow with what a list holds.

    Their names are a fact of the schema and come to the driver, ``max_new`` at
    most in name order; what is left over stays in one column ``extra``, as a JSON object.
    """
    known = [c for c in records.columns if c != "extra"]
    fields = records.where("extra IS NOT NULL").select(F.explode(F.map_keys("extra")).alias("k")).distinct()
    new = [r["k"] for r in fields.orderBy("k").limit(max_new + 1).collect()]
    named, taken, columns = new[:max_new], {c.lower() for c in [*known, "extra"]}, []
    for field in named:
        name = field
        while name.lower() in taken:  # differs from another column in case alone
            name += "_"
        taken.add(name.lower())
        columns.append(F.col("extra")[field].alias(name))
    if len(new) > max_new:
        left = F.map_filter("extra", lambda k, _: ~k.isin(named))
        columns.append(F.when(F.size(left) > 0, F.to_json(left)).alias("extra"))
    return records.select(*[F.col(f"`{c}`") for c in known], *columns)


def read_event_pages(spark: SparkSession, path: str) -> DataFrame:
    """Audit events of every landed page, nested attributes as a struct, unknown fields in ``extra``."""
    rows = read_pages(spark, path, event_page_schema()).select("page", F.posexplode("response").alias("pos", "raw"))
    return _records(rows, schemas.EVENT, ["page", "pos"])
