"""Hot keys: one user holds a third of all events, a third of object ids are null."""

from pyspark.sql import functions as F

from logloom import catalog
from logloom import roles as R
from logloom.plans.report import audit_report

SF = "/root/testdata/sf0.001"


def test_hot_and_null_keys_shuffle_path_matches_broadcast(spark):
    ev = R.r_events(spark, SF)
    k = F.col("index") % 3
    skewed = ev.withColumn("userId", F.when(k == 0, F.lit("U1")).otherwise(F.col("userId"))) \
               .withColumn("objectId", F.when(k == 1, F.lit(None).cast("string")).otherwise(F.col("objectId")))
    dims = catalog.report_dims(spark, SF)
    fast = audit_report(skewed, dims, batch_id=1, tenant_name="t")
    slow = audit_report(skewed, dims, batch_id=1, tenant_name="t", broadcast_max_rows=0)
    assert fast.count() == slow.count() == ev.count()                   # nothing dropped or multiplied
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    hot = slow.where(F.col("USER_ID") == "U1")
    assert hot.count() >= ev.count() // 3
    assert hot.select("USER_NAME").distinct().count() == 1              # every hot row found its user
    assert slow.where(F.col("OBJECT_ID").isNull() & F.col("OBJECT_TYPE").isNotNull()).count() == 0


def test_hot_keys_are_found_and_spread_without_aqe(spark):
    """A user with a third of all events costs no task more than twice the median, AQE's skew split off."""
    from logloom.operators.joins import hot_keys, left_join

    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, "U1").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("V"), F.col("id").cast("string"))).alias("u"),
        F.when(F.col("id") % 4 == 0, "A").otherwise(F.col("id").cast("string")).alias("a"), F.lit('"m,').alias("m"))
    hot = hot_keys(rows, [("u",), ("a", "m")])
    assert hot[("u",)] == [("U1",)] and hot[("a", "m")] == [("A", '"m,')]
    users = spark.range(60_000).select(F.concat(F.lit("V"), F.col("id").cast("string")).alias("u_id"), F.col("id").alias("u_n")) \
        .unionAll(spark.createDataFrame([("U1", -1)], "u_id string, u_n long"))
    actions = spark.createDataFrame([("A", '"m,', 7), ("A", "x", 8), ("5", '"m,', 9)], "a_id string, a_m string, a_n long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = left_join(rows, users, [("u", "u_id")], broadcast=False, salt_col="id", hot=hot[("u",)])
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 60_000 and len(sizes) == 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        plain = left_join(rows, users, [("u", "u_id")], broadcast=False, salt_col="id")
        uneven = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
        assert uneven[-1] > sizes[-1]
        assert found.columns == plain.columns and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
        assert found.where("u = 'U1' AND u_n = -1").count() == 20_000 and found.where("u IS NULL AND u_id IS NOT NULL").isEmpty()
        pairs = [("a", "a_id"), ("m", "a_m")]
        by_two = left_join(rows, actions, pairs, broadcast=False, salt_col="id", hot=hot[("a", "m")])
        want = left_join(rows, F.broadcast(actions), pairs, broadcast=True)
        assert by_two.exceptAll(want).isEmpty() and want.exceptAll(by_two).isEmpty()
        assert hot_keys(rows.limit(0), [("u",)]) == {("u",): []}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
