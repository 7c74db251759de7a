import datetime as dt

import re

from pyspark.sql import functions as F

from logloom.functions import text as X


def test_history_table_name_is_unicode_aware_x07(spark):
    d = spark.createDataFrame([("Wörk space #1", "Plan (v2)/final"), (None, "m")], "ws string, m string")
    got = [r.t for r in d.select(X.history_table_name("ws", "m").alias("t")).collect()]
    assert got == ["mh_wörk_space_1_plan_v2_final", "mh_none_m"]


def test_id_shapes_d14(spark):
    refs = ["A" * 32, "a" * 32, "A" * 31, "Ab" * 16, "a" * 32 + "\n", "a" * 32 + "\r"]
    d = spark.createDataFrame([(r,) for r in refs], "ref string")
    got = [(r.m, r.w) for r in d.select(X.is_model_name("ref").alias("m"),
                                        X.is_workspace_name("ref").alias("w")).collect()]
    expect = [(re.match(X.MODEL_ID_PATTERN, r) is None, re.match(X.WORKSPACE_ID_PATTERN, r) is None) for r in refs]
    assert got == expect
    assert expect[0] == (False, True) and expect[1] == (True, False) and expect[4] == (True, False)


def test_sanitize_column_names_p07():
    assert X.sanitize_column_names(["Date/Time", "Line Item (Module)"]) == ["Date_Time", "Line_Item_Module"]


def test_eastern_time_stamp_x12(spark):
    d = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 7, 1, 0, 0),)],
                              "ts timestamp")
    got = [r.s for r in d.select(X.eastern_time_stamp("ts").alias("s")).collect()]
    assert got == ["31-12-2023 19:00:00 EST", "30-06-2024 20:00:00 EDT"]


def test_padded_keeps_wide_values_x03(spark):
    d = spark.range(1).select(X.padded(F.lit(1234567890123)).alias("p"), X.padded(F.lit(5)).alias("q"))
    r = d.first()
    assert (r.p, r.q) == ("1234567890123", "000000005")
