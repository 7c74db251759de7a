"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from logloom.session import shared_dir

#: The white space that the contracts name, as a Java, Python and RE2 pattern.
SPACE = r"[\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of Parquet files, never
    the work that made them, and each reader sees the same rows.  The shuffle
    files of that work go with the write; Spark else keeps them until the
    driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` staged in ranges of ``order``: with ``part``, the range's number, and ``pos``, the place in it.

    The ranges come from sampled bounds, so a hot key is split if ``order`` goes
    on to columns that tell its rows apart.
    """
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)
    return staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", part.alias("part"), place.alias("pos")), name)


def running_sum(laid: DataFrame, group: list[str], value: Column, out: str) -> DataFrame:
    """The rows of ``in_order``, sorted by ``group`` first, with the sum of ``value`` over the rows of the group before each.

    A range and group is summed on its own; the sums before it come from one row per range and group.
    """
    keys = [*group, "part"]
    sums = laid.groupBy(*keys).agg(F.sum(value).alias("own"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(k).alias(f"at_{k}") for k in keys], F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(k).eqNullSafe(F.col(f"at_{k}")) for k in keys]
    return (laid.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(starts, same).withColumn(out, F.col(out) + F.col("start")).drop("start", *[f"at_{k}" for k in keys]))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores behind it until no column is called so (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ddl(df: DataFrame, *more: str) -> str:
    """The schema of ``df`` with further columns, for mapInArrow."""
    return ", ".join([*(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields), *more])
