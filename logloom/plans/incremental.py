"""Incremental bookkeeping: what is new, how many, and the next watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.plans.report import incremental_condition


def incremental_count(events: DataFrame, last_run: int, strict: bool = False) -> DataFrame:
    """Number of events after the watermark, as one row.

    Counted on ``events`` alone: with unique dimensions (R04) the left joins
    cannot change the row count, so the report's joins are not run for it.
    """
    return events.where(incremental_condition(last_run, strict)).agg(
        F.count(F.lit(1)).alias("audit_records"))


def next_watermark(events: DataFrame, last_run: int, strict: bool = False) -> DataFrame:
    """The watermark to save after this run, as one row.

    Default (D-2): the newest event time received, or the old watermark when
    nothing arrived; ``has_millis`` flags a value that is not whole seconds.
    A partial+final aggregate: no row leaves its task before being folded in.
    """
    new = events.where(incremental_condition(last_run, strict))
    agg = new.agg(F.max("eventDate").alias("__max"), F.count(F.lit(1)).alias("audit_records"))
    wm = F.coalesce(F.col("__max"), F.lit(int(last_run)).cast("bigint"))
    return agg.select(wm.alias("next_watermark"), (wm % 1000 != 0).alias("has_millis"), "audit_records")


def next_watermark_strict(events_with_pos: DataFrame, last_run: int) -> DataFrame:
    """D-2 strict: ``eventDate`` of the last row received (by page, position);
    with no rows the incremented watermark ``last_run + 1``."""
    last = events_with_pos.agg(F.max_by("eventDate", F.struct("page", "pos")).alias("__last"))
    return last.select(F.coalesce(F.col("__last"), F.lit(int(last_run) + 1).cast("bigint")).alias("next_watermark"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``count(*)`` of each table, one row per table (one job for all)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def received_and_announced(pages: DataFrame, entity: str, record_path: str, envelope: str, context: list[str] | None = None) -> DataFrame:
    """Entity, context (its folders, joined by "/"), records received and announced, and pages read.

    Records are never exploded just to be counted; a page that was landed twice counts once.
    """
    announced = F.col("totalResults") if envelope == "scim" else F.col("meta.paging.totalSize")
    keys = [F.concat_ws("/", *(context or [])).alias("context")]
    each = pages.select(*keys, "page", F.size(record_path).cast("bigint").alias("n"), announced.cast("bigint").alias("announced"))
    once = each.groupBy("context", "page").agg(F.max("n").alias("n"), F.max("announced").alias("announced"))
    return once.groupBy("context").agg(
        F.sum("n").alias("received"), F.max("announced").alias("announced"), F.count(F.lit(1)).alias("pages"),
    ).select(F.lit(entity).alias("entity"), "context", "received", "announced", "pages")


def page_reconciliation(sources: dict) -> DataFrame:
    """Records received, records announced, and pages read, per entity.

    ``sources`` maps entity -> (pages DataFrame, record path, envelope, context folders).
    """
    out = None
    for entity, (pages, record_path, envelope, *context) in sources.items():
        each = received_and_announced(pages, entity, record_path, envelope, context[0] if context else None)
        agg = each.groupBy("entity").agg(F.sum("received").alias("records_received"), F.sum("announced").alias("records_announced"),
                                         F.sum("pages").alias("pages_received"))
        out = agg if out is None else out.unionByName(agg)
    return out
