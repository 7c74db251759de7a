"""Chunked CSV export, sample export, one page, and the refresh log.

The source re-runs the whole query for every chunk with a growing
``LIMIT .. OFFSET`` (O(chunks x rows)).  Here rows are numbered once
(``identity.row_index``) and every chunk is written in the same pass: rows
are hash-partitioned by chunk number, so each chunk's rows meet in exactly
one task and become exactly one CSV file, sorted by their index.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom import schemas
from logloom.functions.text import eastern_time_stamp
from logloom.operators.identity import chunk_columns, row_index, row_page


def number_for_export(df: DataFrame, order_cols: list[str], chunk_size: int = schemas.EXPORT_CHUNK_SIZE,
                      acronym: str | None = None, strict: bool = False,
                      drop_cols: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` with ``chunk`` and (optionally) ``<ACRONYM>_CT``, in key order.

    The count of rows is that of ``df`` itself (the joined result), so no
    tail is lost when a join fans out (D-6).
    """
    numbered = row_index(df, order_cols, out_col="__rn")
    counter = f"{acronym}_CT" if acronym else None
    out = chunk_columns(numbered, "__rn", chunk_size, counter, strict)
    keep = [c for c in df.columns if c not in (drop_cols or [])]
    lead = ["chunk"] + ([counter] if counter else [])
    return out.select(*lead, *[F.col(f"`{c}`") for c in keep], "__rn")


def export_report(events: DataFrame, dims, *, batch_id: int, tenant_name: str,
                  chunk_size: int = schemas.EXPORT_CHUNK_SIZE, acronym: str | None = None,
                  last_run: int | None = None, strict: bool = False, index_col: str | None = None,
                  **report_kw) -> DataFrame:
    """The audit report numbered for export, in (eventDate, id) order (K08, D-6).

    Default: dimensions are unique, so the left joins keep exactly one row per
    event; the events themselves are numbered first (the range sampling and
    the checkpoint touch the events only) and the joins then run once,
    map-side, carrying the number.  ``index_col`` reuses a dense number the
    events already have (the batch's arrival index).  ``strict`` joins may
    fan out, so there the joined result is numbered instead.
    """
    from logloom.plans.report import audit_report, incremental_condition

    if strict:
        rep = audit_report(events, dims, batch_id=batch_id, tenant_name=tenant_name, last_run=last_run,
                           strict=True, order_key=True, **report_kw)
        return number_for_export(rep, ["__event_ms", "AUDIT_ID"], chunk_size, acronym, strict=True,
                                 drop_cols=["__event_ms"])
    if index_col is None:
        if last_run is not None:
            events = events.where(incremental_condition(last_run))
        events = row_index(events, ["eventDate", "id"], out_col="__rn")
    else:
        events = events.withColumn("__rn", F.col(index_col))
    rep = audit_report(events, dims, batch_id=batch_id, tenant_name=tenant_name, carry=["__rn"], **report_kw)
    counter = f"{acronym}_CT" if acronym else None
    out = chunk_columns(rep, "__rn", chunk_size, counter)
    lead = ["chunk"] + ([counter] if counter else [])
    return out.select(*lead, *[F.col(c) for c in schemas.REPORT_COLUMNS], "__rn")


def write_chunks(numbered: DataFrame, out_dir: str, header_first_only: bool = True) -> None:
    """Write one CSV file per chunk under ``out_dir/chunk=<n>/``, in ONE job.

    Rows are formatted with ``to_csv`` (the CSV writer's own quoting) and the
    header is one more line, ordered first (``__rn = -1``): in chunk 0 only,
    as the source does, or in every chunk.  Hashing by chunk (width left to
    AQE, whose coalescing merges whole partitions) puts each chunk in one
    task, hence one file, sorted by row number.  The folder is overwritten
    as a whole, so a retried export gives the same files.
    """
    spark = numbered.sparkSession
    cols = [c for c in numbered.columns if c not in ("chunk", "__rn")]
    buf = io.StringIO()
    csv.writer(buf, lineterminator="").writerow(cols)
    header_text = buf.getvalue()
    body = numbered.select(
        "chunk", "__rn",
        # RFC 4180 quoting (a quote inside a value is doubled), as the source's files.
        F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cols]), {"escape": '"'}).alias("value"))
    if header_first_only:
        heads = spark.createDataFrame([(0, -1, header_text)], "chunk bigint, __rn bigint, value string")
    else:
        heads = numbered.select("chunk").distinct().select(
            "chunk", F.lit(-1).cast("bigint").alias("__rn"), F.lit(header_text).alias("value"))
    laid = body.unionByName(heads).repartition("chunk").sortWithinPartitions("chunk", "__rn")
    laid.select("chunk", "value").write.mode("overwrite").partitionBy("chunk").text(out_dir)


def report_page(events: DataFrame, dims, page: int, *, batch_id: int, tenant_name: str,
                chunk_size: int = schemas.EXPORT_CHUNK_SIZE, **report_kw) -> DataFrame:
    """One page of the report (``LIMIT size OFFSET page*size`` in (eventDate, id) order).

    With unique dimensions each event is one row, so the page is found on the
    events and only its events are joined.
    """
    from logloom.plans.report import audit_report

    rows = row_page(events, ["eventDate", "id"], page * chunk_size, chunk_size, out_col="__rn")
    return audit_report(rows, dims, batch_id=batch_id, tenant_name=tenant_name, **report_kw)


def sample(df: DataFrame, order_cols: list[str], rows: int = schemas.SAMPLE_ROWS,
           chunk_size: int = schemas.EXPORT_CHUNK_SIZE, acronym: str | None = None) -> DataFrame:
    """The first ``min(rows, chunk_size)`` rows in key order.

    A top-k (each task keeps its best k, then one merge of k rows per task),
    never a global sort of the table.
    """
    k = min(rows, chunk_size)
    top = df.orderBy(*order_cols).limit(k)
    if not acronym:
        return top
    # At most k rows remain, so numbering them in one window is bounded.
    ct = F.row_number().over(Window.orderBy(*order_cols)).cast("bigint")
    return top.select(ct.alias(f"{acronym}_CT"), *[F.col(f"`{c}`") for c in df.columns])


def write_sample(sample_df: DataFrame, out_dir: str) -> None:
    sample_df.coalesce(1).write.mode("overwrite").option("header", True).csv(out_dir)


def refresh_log_row(spark, batch_id: int, audit_records: DataFrame) -> DataFrame:
    """The run's log row -- batch id, Eastern local time stamp, records loaded.

    ``audit_records`` is the one-row count of A02; the time stamp is derived
    from ``batch_id`` (epoch seconds of the run), never from the clock inside
    the plan, so a retried run writes the same row.
    """
    ts = F.timestamp_seconds(F.lit(int(batch_id)).cast("bigint"))
    return audit_records.select(
        F.lit(int(batch_id)).cast("bigint").alias("BATCH_ID"),
        eastern_time_stamp(ts).alias("TIME_STAMP"),
        F.col("audit_records").cast("bigint").alias("AUDIT_RECORDS_LOADED"),
    )
