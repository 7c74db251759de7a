"""Plan shape: what the optimizer must (and must not) produce for the report."""

import contextlib
import io

from logloom import catalog

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_report_is_broadcast_joins_without_python_or_single_partition(spark):
    p = plan_text(catalog.QUERIES["audit_report"](spark, SF))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "SinglePartition", "SortMergeJoin"):
        assert bad not in p, bad
    assert p.count("BroadcastHashJoin") >= 9


def test_incremental_bound_reaches_the_parquet_scan(spark):
    p = plan_text(catalog.QUERIES["incremental_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_dimension_over_bound_is_not_broadcast(spark):
    from logloom import roles as R
    from logloom.plans.report import audit_report
    df = audit_report(R.r_events(spark, SF), catalog.report_dims(spark, SF), batch_id=1, tenant_name="t",
                      broadcast_max_rows=10)
    p = plan_text(df)
    assert "SortMergeJoin" in p                 # users (150 rows > 10) are shuffle-joined
    assert "BroadcastHashJoin" in p             # the 4-row activity codes stay broadcast


def test_shuffle_join_fallback_gives_the_same_report(spark):
    """Every dimension over the bound: sort-merge joins (AQE on), same rows."""
    from logloom import roles as R
    from logloom.plans.report import audit_report
    ev, dims = R.r_events(spark, SF), catalog.report_dims(spark, SF)
    fast = audit_report(ev, dims, batch_id=1, tenant_name="t")
    slow = audit_report(ev, dims, batch_id=1, tenant_name="t", broadcast_max_rows=0)
    p = plan_text(slow)
    assert "SortMergeJoin" in p
    assert "CASE WHEN isnull(objectId" in p        # null keys salted before the shuffle
    assert fast.count() == slow.count()
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_no_estimate_based_broadcast(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"


def test_bound_parameters_leave_the_reports_plan(spark):
    p = plan_text(catalog.QUERIES["report_parameters"](spark, SF))
    assert "SortMergeJoin" not in p and p.count("BroadcastHashJoin") >= 9


def test_a_dimension_of_many_bytes_is_not_broadcast(spark):
    from logloom.operators.joins import bounded_broadcast_all
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) AS name")
    assert [ok for _, ok in bounded_broadcast_all([(wide, None), (wide.select("id"), None)], 100, max_bytes=5000)] == [False, True]
    assert [ok for _, ok in bounded_broadcast_all([(wide, None)], 9)] == [False]


def test_no_shared_folder_no_cluster():
    import pytest
    from types import SimpleNamespace
    from logloom.session import ensure_checkpoint_dir
    none = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=sc))
