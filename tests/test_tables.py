"""Table management (K01, K02, K04-K07, K12) through the session catalog."""

from logloom.sources import tables as TB


def test_table_lifecycle(spark):
    name = "ll_users_test"
    TB.drop_table(spark, name)                                   # K04: missing table only warns
    assert TB.table_exists(spark, name) is None                  # K06
    TB.create_table(spark, name, {"id": "string", "userName": "string"})   # K05
    TB.create_table(spark, name, {"id": "string"})               # existing: left as it is
    assert TB.table_exists(spark, name) == name
    assert TB.read_table(spark, name).columns == ["id", "userName"]
    rows = spark.createDataFrame([("U1", "a"), ("U2", "b")], "id string, userName string")
    TB.write_table(rows, name, mode="append")                    # K02
    TB.write_table(rows, name, mode="append")
    assert TB.read_table(spark, name).count() == 4
    TB.write_table(rows.limit(1), name, mode="overwrite")        # K01
    assert TB.read_table(spark, name).count() == 1
    TB.truncate_table(spark, name)                               # K07
    assert TB.read_table(spark, name).count() == 0 and TB.table_exists(spark, name) == name
    assert TB.reset_if_full_refresh(spark, name, last_run=5) is False      # K12
    assert TB.table_exists(spark, name) == name
    assert TB.reset_if_full_refresh(spark, name, last_run=0) is True
    assert TB.table_exists(spark, name) is None
