"""Stored tables: read, replace, append, and catalog management.

Tables are Parquet.  A name without a path goes through the session catalog
(``saveAsTable``); a path is a plain Parquet folder, which is what jobs on a
shared file system use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, table: str, path: str | None = None) -> DataFrame:
    """``SELECT * FROM table``."""
    return spark.read.parquet(path) if path else spark.table(table)


def write_table(df: DataFrame, table: str | None = None, path: str | None = None,
                mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Replace (``overwrite``) or ``append``.

    Never overwrite the table being read in the same job: stage it first
    (see ``history.merge_history``).
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w.parquet(path)
    else:
        w.format("parquet").saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """A missing table is not an error."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def create_table(spark: SparkSession, table: str, columns: dict[str, str]) -> None:
    """An existing table is left as it is."""
    cols = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet")


def table_exists(spark: SparkSession, table: str) -> str | None:
    """The table's name when it exists, else None."""
    return table if spark.catalog.tableExists(table) else None


def truncate_table(spark: SparkSession, table: str) -> None:
    """Remove all rows, keep the table."""
    spark.sql(f"TRUNCATE TABLE {table}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system; a missing one is not an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder of the shared file system; none where it is missing."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    return [f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory()] if fs.exists(where) else []


def reset_if_full_refresh(spark: SparkSession, table: str, last_run: int, table_drop: bool = False) -> bool:
    """Drop the events table on a full refresh (``last_run == 0``) or on request."""
    if table_drop or last_run == 0:
        drop_table(spark, table)
        return True
    return False
