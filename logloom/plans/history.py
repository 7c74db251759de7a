"""Model-history merge and source discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom import schemas
from logloom.session import shared_dir
from logloom.sources import tables as TB
from logloom.streaming.ingest import read_if_there


PERIOD = "history_period"
#: Characters of a row's date text that tell its partition: year and month.
PERIOD_CHARS = 7
#: Months of an export that are named in the scan's partition filter, at most; a thousand years of them, some 100 KB.
MAX_PERIODS = 12_000


def _by_period(rows: DataFrame, date_col: str) -> DataFrame:
    """The table's layout: a partition per month; rows without a date share one."""
    return rows.withColumn(PERIOD, F.coalesce(F.substring(F.col(f"`{date_col}`"), 1, PERIOD_CHARS), F.lit("none")))


def create_history(rows: DataFrame, table_dir: str, date_col: str) -> None:
    _by_period(rows.dropDuplicates(), date_col).write.mode("overwrite").partitionBy(PERIOD).parquet(table_dir)


def touched_periods(stored: DataFrame, periods: DataFrame, max_periods: int = MAX_PERIODS) -> DataFrame:
    """The stored rows of the export's months.

    The months, short texts and bounded in number, are literals of the partition
    filter, so folders of other months are neither listed for the scan nor read,
    whatever the join thresholds are.  More of them than the bound (an export
    whose dates are no dates) go through a shuffle join.
    """
    own = F.col(PERIOD).cast("string")
    found = [r[PERIOD] for r in periods.limit(max_periods + 1).collect()]
    if len(found) <= max_periods:
        return stored.where(own.isin(found)).withColumn(PERIOD, own)
    return stored.withColumn(PERIOD, own).join(periods, PERIOD, "left_semi")


def merge_history(spark: SparkSession, table_dir: str, latest: DataFrame, date_col: str) -> DataFrame:
    """The stored table with the latest export merged in, whole-row duplicates removed.

    A row's date is part of it, so only months that the export holds can change:
    their partitions alone are read, united with the export and de-duplicated
    (a hash aggregate that folds repeats map-side).  The result is staged and
    then replaces just those partitions, so no folder is overwritten while it
    is read and a retried merge gives the same table.
    """
    dated = _by_period(latest, date_col)
    stored = read_if_there(spark, table_dir)
    both = dated
    if stored is not None:
        both = touched_periods(stored, dated.select(PERIOD).distinct()).unionByName(dated, allowMissingColumns=True)
    staging = shared_dir(spark, "history-staging")
    both.dropDuplicates().write.parquet(staging)
    merged = spark.read.schema(both.schema).parquet(staging)
    # files of a month are written together, a large month by several tasks
    (merged.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(table_dir))
    TB.delete_path(spark, staging)
    return spark.read.parquet(table_dir).drop(PERIOD)


def history_sources(assets: DataFrame, name: str = schemas.HISTORY_OBJECT_NAME) -> DataFrame:
    """exports and files with the history object's name, per (workspace, model)."""
    return assets.where(F.col("kind").isin("exports", "files") & (F.col("name") == name)).select(
        "workspace_id", "model_id", "kind", "id")
