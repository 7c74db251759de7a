import glob
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from logloom.operators.identity import chunk_columns, key_ranges, row_index, row_page
from logloom.plans import export as EX


def test_row_index_equals_row_number(spark):
    d = spark.range(0, 5000).select(((F.col("id") * 7919) % 1000).alias("k"), F.col("id").cast("string").alias("t"))
    got = row_index(d, ["k", "t"], out_col="ix", num_partitions=7)
    want = d.select("k", "t", (F.row_number().over(Window.orderBy("k", "t")) - 1).alias("ix"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.agg(F.min("ix"), F.max("ix"), F.count_distinct("ix")).first() == (0, 4999, 5000)


def test_row_index_with_nulls_and_a_hot_date(spark):
    """A third of the rows share one date, some have none: cut by the id, the same numbers at any width."""
    d = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50).cast("long").alias("k"),
                                    F.when(F.col("id") < 5999, F.format_string("%05d", "id")).alias("t"), F.lit("wide").alias("v"))
    want = d.select("k", "t", "v", (F.row_number().over(Window.orderBy("k", "t")) - 1).cast("long").alias("ix"))
    ranges = key_ranges(d, ["k", "t"], 12)
    assert sum(ranges.counts) == 6000 and max(ranges.counts) < 1500 and len(ranges.bounds) > 8
    for n in (1, 12):
        got = row_index(d.repartition(n), ["k", "t"], out_col="ix", num_partitions=n)
        assert got.exceptAll(want).count() == 0 and got.count() == 6000
    assert row_index(d.where("false"), ["k", "t"]).collect() == []


def test_row_index_shuffles_the_rows_once_and_stages_nothing(spark):
    d = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), F.col("id").alias("t"), F.struct(F.lit("x").alias("a")).alias("nested"))
    plan = row_index(d, ["k", "t"], num_partitions=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "FileScan" not in plan and "SinglePartition" not in plan


def test_row_page_reads_only_the_ranges_that_hold_it(spark, tmp_dir):
    spark.range(0, 8000).select(F.col("id").alias("k"), F.format_string("v%d", "id").alias("v")).write.parquet(tmp_dir)
    d = spark.read.parquet(tmp_dir)
    page = row_page(d, ["k"], 4000, 100, out_col="ix")
    assert sorted((r.k, r.ix) for r in page.collect()) == [(i, i) for i in range(4000, 4100)]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k" in plan and "LessThanOrEqual(k" in plan      # pushed to the scan
    assert row_page(d, ["k"], 9000, 100).collect() == []


def test_chunk_counter_both_modes_d6(spark):
    d = spark.range(7).withColumnRenamed("id", "ix")
    default = [r.CT for r in chunk_columns(d, "ix", 3, "CT").orderBy("ix").collect()]
    strict = [(r.chunk, r.CT) for r in chunk_columns(d, "ix", 3, "CT", strict=True).orderBy("ix").collect()]
    assert default == [1, 2, 3, 4, 5, 6, 7]
    assert strict == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 1)]


def test_chunk_files_header_on_first_only(spark, tmp_dir):
    d = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("v"))
    numbered = EX.number_for_export(d, ["id"], chunk_size=3, acronym="USR")
    EX.write_chunks(numbered, tmp_dir, header_first_only=True)
    tmp_dir = tmp_dir.removeprefix("file:")
    dirs = sorted(glob.glob(os.path.join(tmp_dir, "chunk=*")))
    assert len(dirs) == 4
    for i, path in enumerate(sorted(dirs, key=lambda p: int(p.split("=")[1]))):
        files = glob.glob(os.path.join(path, "part-*"))
        assert len(files) == 1                                 # one file per chunk
        lines = open(files[0]).read().splitlines()
        assert (lines[0] == "USR_CT,id,v") == (i == 0)
    assert sum(1 for _ in open(glob.glob(os.path.join(tmp_dir, "chunk=0", "part-*"))[0])) == 4


def test_sample_top_rows(spark):
    d = spark.range(50).select(F.format_string("%03d", "id").alias("id"))
    s = EX.sample(d, ["id"], rows=5, acronym="USR").collect()
    assert [(r.USR_CT, r.id) for r in s] == [(i + 1, f"{i:03d}") for i in range(5)]


def test_chunk_files_round_trip_quoting(spark, tmp_dir):
    from logloom.sources.history import read_history_chunks
    rows = [(f"{i:02d}", 'a,"b"' if i % 3 == 0 else None if i % 3 == 1 else "plain") for i in range(7)]
    d = spark.createDataFrame(rows, "id string, v string")
    EX.write_chunks(EX.number_for_export(d, ["id"], chunk_size=3, acronym="USR"), tmp_dir)
    back = read_history_chunks(spark, tmp_dir, sep=",", sanitize=False)
    assert back.columns == ["USR_CT", "id", "v"]
    got = sorted((int(r.USR_CT), r.id, r.v) for r in back.collect())
    assert got == [(i + 1, rid, v) for i, (rid, v) in enumerate(rows)]
    first = open(glob.glob(os.path.join(tmp_dir.removeprefix("file:"), "chunk=0", "part-*"))[0]).read()
    assert '"a,""b"""' in first                               # RFC 4180: quotes doubled


def test_range_search_is_compiled(spark):
    """No lambda is interpreted row by row, in the counts or in the numbering, however many ranges there are."""
    d = spark.range(0, 20000).select((F.col("id") % 971).alias("k"), F.col("id").alias("t"))
    ranges = key_ranges(d, ["k", "t"], 200)
    assert len(ranges.bounds) > 150 and sum(ranges.counts) == 20000
    numbered = row_index(d, ["k", "t"], num_partitions=200)
    assert "lambda" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    want = d.select("k", "t", (F.row_number().over(Window.orderBy("k", "t")) - 1).cast("long").alias("index"))
    assert numbered.exceptAll(want).count() == 0 and numbered.count() == 20000
