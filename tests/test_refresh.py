"""End-to-end refresh over landed pages of the sf0.001 tables."""

from pyspark.sql import functions as F

from logloom import roles as R
from logloom import schemas
from logloom.plans.refresh import RefreshSettings, published, read_watermark, run_refresh
from logloom.sources import history as HS

SF = "/root/testdata/sf0.001"


def test_full_then_incremental_refresh(spark, tmp_dir):
    landing, warehouse = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    ev = R.r_events(spark, SF).drop("index")
    split = ev.select(F.percentile_approx("eventDate", 0.5).alias("m")).first()["m"]
    R.land_all(spark, SF, landing, run=1, events=ev.where(F.col("eventDate") <= split))
    s1 = run_refresh(spark, landing, warehouse, RefreshSettings(tenant_name="T", batch_id=1, chunk_size=200))
    n1 = ev.where(F.col("eventDate") <= split).count()
    assert s1["last_run"] == 0 and s1["audit_records"] == n1
    assert read_watermark(spark, warehouse) == split
    exported = HS.read_history_chunks(spark, published(spark, warehouse, "exports", "AUDIT_LOG.csv"), sep=",", sanitize=False)
    assert exported.columns == schemas.REPORT_COLUMNS and exported.count() == n1
    users = HS.read_history_chunks(spark, published(spark, warehouse, "exports", "USER_LIST.csv"), sep=",", sanitize=False)
    assert users.columns[0] == "USR_CT" and users.count() == R.r_users(spark, SF).count()

    # Second pull overlaps the first by its last page; only new events are reported.
    R.land_all(spark, SF, landing, run=2, events=ev.where(F.col("eventDate") >= split))
    s2 = run_refresh(spark, landing, warehouse, RefreshSettings(tenant_name="T", batch_id=2, chunk_size=200))
    assert s2["last_run"] == split
    assert s2["audit_records"] == ev.where(F.col("eventDate") > split).count()
    assert spark.read.parquet(f"{warehouse}/events").count() == ev.count()     # overlap stored once
    # Third run, nothing new: a log row only, watermark unchanged.
    s3 = run_refresh(spark, landing, warehouse, RefreshSettings(tenant_name="T", batch_id=3, chunk_size=200))
    assert s3["audit_records"] == 0 and read_watermark(spark, warehouse) == s2["next_watermark"]
    log = {r.BATCH_ID: r.AUDIT_RECORDS_LOADED for r in spark.read.parquet(f"{warehouse}/refresh_log").collect()}
    assert log == {1: n1, 2: s2["audit_records"], 3: 0}


def test_cli_scope_select_and_samples(spark, tmp_dir):
    from logloom.__main__ import main

    landing, warehouse = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    R.land_all(spark, SF, landing)
    models = {r.id: r.currentWorkspaceId for r in R.r_models(spark, SF).collect()}
    summary = main(["--landing", landing, "--warehouse", warehouse, "--tenant", "T", "--batch-id", "7",
                    "--scope", "select", "--combo", f"{models['M2']}:M2", "--target-model", "M3", "--sample", "users"])
    assert summary["audit_records"] == R.r_events(spark, SF).count()
    actions = spark.read.parquet(published(spark, warehouse, "actions"))
    assert {r.model_id for r in actions.select("model_id").distinct().collect()} <= {"M2", "M3"}
    sample = spark.read.option("header", True).csv(published(spark, warehouse, "samples", "USER_LIST.csv"))
    assert sample.columns[0] == "USR_CT" and sample.count() == R.r_users(spark, SF).count()


def test_refresh_with_missing_lists_and_no_events(spark, tmp_dir):
    landing, warehouse = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    # Nothing landed at all: only a log row, watermark stays 0.
    s0 = run_refresh(spark, landing, warehouse, RefreshSettings(tenant_name="T", batch_id=1))
    assert s0["audit_records"] == 0 and read_watermark(spark, warehouse) == 0
    # Events and users only: the other lists are empty tables, the report still has every event.
    from logloom.sources import pages as PG
    ev = R.r_events(spark, SF).drop("index")
    PG.land_pages(ev, f"{landing}/events/run=1", "response", 500, ["eventDate", "id"], envelope="events")
    PG.land_pages(R.r_users(spark, SF), f"{landing}/users", "Resources", 500, ["id"], envelope="scim")
    s1 = run_refresh(spark, landing, warehouse, RefreshSettings(tenant_name="T", batch_id=2, chunk_size=300))
    assert s1["audit_records"] == ev.count()
    out = HS.read_history_chunks(spark, published(spark, warehouse, "exports", "AUDIT_LOG.csv"), sep=",", sanitize=False)
    assert out.count() == ev.count() and out.where("WORKSPACE_NAME IS NOT NULL").count() == 0
    assert spark.read.parquet(published(spark, warehouse, "integrations")).count() == 0


def test_strict_watermark_is_last_row_received_d2(spark, tmp_dir):
    from logloom.sources import pages as PG
    ev = R.r_events(spark, SF).drop("index")
    # Pages ordered by checksum: the last row received is not the newest event.
    last = ev.orderBy(F.col("checksum").desc(), F.col("id").desc()).first()["eventDate"]
    newest = ev.agg(F.max("eventDate")).first()[0]
    assert last != newest
    for strict, expect in ((True, last), (False, newest)):
        root = f"{tmp_dir}/{'strict' if strict else 'default'}"
        PG.land_pages(ev, f"{root}/landing/events/run=1", "response", 300, ["checksum", "id"], envelope="events")
        s = run_refresh(spark, f"{root}/landing", f"{root}/warehouse",
                        RefreshSettings(tenant_name="T", batch_id=1, strict=strict, chunk_size=500))
        assert s["next_watermark"] == expect


def _land(spark, rows, landing, run):
    from helpers import events_df
    from logloom.sources import pages as PG
    PG.land_pages(events_df(spark, rows).drop("index"), f"{landing}/events/run={run}", "response", 3, ["eventDate", "id"], envelope="events")


def _run(spark, root, batch, **how):
    return run_refresh(spark, f"{root}/landing", f"{root}/warehouse", RefreshSettings(tenant_name="T", batch_id=batch, chunk_size=50, **how))


def test_state_log_and_held_pulls(spark, tmp_dir):
    import pytest
    from helpers import event
    from logloom.plans.refresh import read_state
    from logloom.sources import pages as PG

    base, landing, warehouse = 1_700_000_000_000, f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land(spark, [event(i, base + i) for i in range(4)], landing, 1)
    assert _run(spark, tmp_dir, 1)["audit_records"] == 4
    # A page of the second pull is cut off: stored what came, exported nothing, watermark unchanged.
    _land(spark, [event(i, base - i) for i in range(10, 16)], f"{tmp_dir}/second", 2)
    docs = [r["doc"] for r in PG.landed(spark, f"{tmp_dir}/second/events/run=2").orderBy("doc").collect()]
    for doc in (docs[0], docs[1][:-30]):
        spark.createDataFrame([(doc,)], "value string").write.mode("append").text(f"{landing}/events/run=2")
    held = _run(spark, tmp_dir, 2)
    assert held["audit_records"] == 0 and [h["unreadable"] for h in held["open"]["first"]] == [1]
    assert read_state(spark, warehouse).ingest_batch == 0 and spark.read.parquet(f"{warehouse}/events").count() == 7
    # It lands again: all six events are exported although they are older than the watermark.
    spark.createDataFrame([(docs[1],)], "value string").write.mode("append").text(f"{landing}/events/run=2")
    s = _run(spark, tmp_dir, 2)
    assert s["audit_records"] == 6 and "open" not in s and read_watermark(spark, warehouse) == base + 3
    # A run that is repeated writes its log row again, not a second one.
    _run(spark, tmp_dir, 2)
    log = {r.BATCH_ID: r.AUDIT_RECORDS_LOADED for r in spark.read.parquet(f"{warehouse}/refresh_log").collect()}
    assert log == {1: 4, 2: 0}
    # A full refresh starts anew.
    assert _run(spark, tmp_dir, 5, full_refresh=True)["audit_records"] == 10
    # A state that can't be read is an error, not a state of zero.
    spark.createDataFrame([("x",)], "value string").write.mode("overwrite").text(f"{warehouse}/_state/watermark")
    with pytest.raises(Exception):
        _run(spark, tmp_dir, 6)


def test_strict_run_without_events_saves_the_raised_watermark(spark, tmp_dir):
    s = _run(spark, tmp_dir, 1, strict=True)
    assert s["next_watermark"] == 1 and read_watermark(spark, f"{tmp_dir}/warehouse") == 1


def test_a_short_pull_waits_alone_and_can_be_accepted(spark, tmp_dir):
    from helpers import event
    from logloom.sources import pages as PG

    base, landing = 1_700_000_000_000, f"{tmp_dir}/landing"
    _land(spark, [event(i, base + i) for i in range(6)], f"{tmp_dir}/whole", 1)
    docs = [r["doc"] for r in PG.landed(spark, f"{tmp_dir}/whole/events/run=1").orderBy("doc").collect()]
    put = lambda doc: spark.createDataFrame([(doc,)], "value string").write.mode("append").text(f"{landing}/events/run=1")
    put(docs[0])
    s1 = _run(spark, tmp_dir, 1)
    assert s1["audit_records"] == 0 and s1["open"]["pulls"] == 1 and s1["open"]["first"][0]["received"] == 3
    _land(spark, [event(i, base - i) for i in range(10, 14)], landing, 2)
    s2 = _run(spark, tmp_dir, 2)                      # the later pull goes out, the short one waits
    assert s2["audit_records"] == 4 and s2["open"]["pulls"] == 1
    assert _run(spark, tmp_dir, 3)["audit_records"] == 0
    s4 = _run(spark, tmp_dir, 4, accept_pulls=("1",))
    assert s4["audit_records"] == 3 and "open" not in s4
    s5 = _run(spark, tmp_dir, 5)                      # it stays accepted
    assert s5["audit_records"] == 0 and "open" not in s5
    put(docs[1])                                      # its page comes after all: exported once
    assert _run(spark, tmp_dir, 6)["audit_records"] == 3
    log = {r.BATCH_ID: r.AUDIT_RECORDS_LOADED for r in spark.read.parquet(f"{tmp_dir}/warehouse/refresh_log").collect()}
    assert log == {1: 0, 2: 4, 3: 0, 4: 3, 5: 0, 6: 3}


def test_states_from_before_pulls_had_one(spark, tmp_dir):
    from helpers import event
    base, landing, warehouse = 1_700_000_000_000, f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land(spark, [event(i, base + i) for i in range(4)], landing, 1)
    _run(spark, tmp_dir, 1)
    spark.createDataFrame([(1, base + 3, 0)], "batch_id bigint, last_run bigint, ingest_batch bigint").coalesce(1).write.mode("overwrite").parquet(f"{warehouse}/_state/watermark")
    _land(spark, [event(i, base + i) for i in range(4, 6)], landing, 2)
    assert _run(spark, tmp_dir, 2)["audit_records"] == 2


def test_short_lists_hold_the_run_unless_accepted(spark, tmp_dir):
    from helpers import event
    landing = f"{tmp_dir}/landing"
    _land(spark, [event(1, 1_700_000_000_000)], landing, 1)
    models = '{"models": [{"id": "M1", "currentWorkspaceId": "W1"}], "meta": {"paging": {"totalSize": 5}}}'
    spark.createDataFrame([(models,)], "value string").write.text(f"{landing}/models")
    held = _run(spark, tmp_dir, 1)
    assert held["held"][0]["short"] == 1 and held["audit_records"] == 0
    assert [r.AUDIT_RECORDS_LOADED for r in spark.read.parquet(f"{tmp_dir}/warehouse/refresh_log").collect()] == [0]
    done = _run(spark, tmp_dir, 2, accept_short_lists=True)
    assert done["audit_records"] == 1 and done["missing_assets"]["lists"] == 5
    assert {(r["model_id"], r["kind"]) for r in done["missing_assets"]["first"]} == {("M1", k) for k in schemas.ASSET_KINDS}


def _set(spark, home):
    """What a published set holds: rows of each table and export, and who exported the report."""
    report = HS.read_history_chunks(spark, f"{home}/exports/AUDIT_LOG.csv", sep=",", sanitize=False)
    exports = {n: HS.read_history_chunks(spark, f"{home}/exports/{n}", sep=",", sanitize=False).count() for n in ("AUDIT_LOG.csv", "USER_LIST.csv")}
    tables = {n: spark.read.parquet(f"{home}/{n}").count() for n in ("users", "models", "act_codes")}
    return sorted(report.select("AUDIT_ID", "BATCH_ID").collect()), exports, tables


def test_a_run_killed_between_two_exports_leaves_the_old_set_whole(spark, tmp_dir, monkeypatch):
    import pytest
    from helpers import event
    from logloom.plans import export as EX
    from logloom.sources import tables as TB

    base, landing, warehouse = 1_700_000_000_000, f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    user = lambda n: '{"Resources": [%s], "totalResults": %d}' % (", ".join('{"id": "U%d"}' % i for i in range(n)), n)
    put = lambda text: spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(f"{landing}/users")
    _land(spark, [event(i, base + i) for i in range(4)], landing, 1)
    put(user(2))
    first = _run(spark, tmp_dir, 1)
    before = _set(spark, published(spark, warehouse))
    assert before[1] == {"AUDIT_LOG.csv": 4, "USER_LIST.csv": 2} and before[2]["users"] == 2

    _land(spark, [event(i, base + i) for i in range(4, 9)], landing, 2)
    put(user(3))
    write, calls = EX.write_chunks, []

    def dies(*a, **k):
        if len(calls) == 2:
            raise RuntimeError("killed")
        calls.append(a)
        write(*a, **k)

    monkeypatch.setattr(EX, "write_chunks", dies)
    with pytest.raises(RuntimeError):
        _run(spark, tmp_dir, 2)
    monkeypatch.setattr(EX, "write_chunks", write)
    assert _set(spark, published(spark, warehouse)) == before and read_watermark(spark, warehouse) == base + 3
    assert len(TB.folder_names(spark, f"{warehouse}/versions")) == 2      # the published one and the dead run's

    second = _run(spark, tmp_dir, 2)
    assert second["audit_records"] == 5
    rows, exports, tables = _set(spark, published(spark, warehouse))
    assert exports == {"AUDIT_LOG.csv": 5, "USER_LIST.csv": 3} and tables["users"] == 3 and {r.BATCH_ID for r in rows} == {"2"}
    assert _set(spark, f"{warehouse}/versions/{first['version']}") == before      # readers of the old set can end
    assert set(TB.folder_names(spark, f"{warehouse}/versions")) == {first["version"], second["version"]}

    # A full refresh that dies leaves the set too, and the next run takes all events.
    monkeypatch.setattr(EX, "write_chunks", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        _run(spark, tmp_dir, 3, full_refresh=True)
    monkeypatch.setattr(EX, "write_chunks", write)
    assert _set(spark, published(spark, warehouse))[1] == exports and read_watermark(spark, warehouse) == 0
    third = _run(spark, tmp_dir, 4, keep_versions=1)
    assert third["audit_records"] == 9 and TB.folder_names(spark, f"{warehouse}/versions") == [third["version"]]


def test_an_unpublished_run_changes_nothing(spark, tmp_dir):
    from helpers import event
    base, warehouse = 1_700_000_000_000, f"{tmp_dir}/warehouse"
    _land(spark, [event(i, base + i) for i in range(4)], f"{tmp_dir}/landing", 1)
    looked = _run(spark, tmp_dir, 1, publish=False)
    assert read_watermark(spark, warehouse) == 0 and _set(spark, looked["unpublished"])[1]["AUDIT_LOG.csv"] == 4
    assert _run(spark, tmp_dir, 2)["audit_records"] == 4
    assert {r.BATCH_ID for r in spark.read.parquet(f"{warehouse}/refresh_log").collect()} == {2}


def test_runs_over_compacted_events_and_retired_pages(spark, tmp_dir):
    """Every run compacts and archives; each event is exported once, and a full refresh finds all pages again."""
    from helpers import event
    from logloom.streaming import compact as CP

    how = {"compact_batches": 1, "retire_to": f"{tmp_dir}/done", "max_files": 1}
    base = 1_700_000_000_000
    for n in range(2):
        _land(spark, [event(i, base + i) for i in range(n * 4, n * 4 + 6)], f"{tmp_dir}/landing", n + 1)
        assert _run(spark, tmp_dir, n + 1, **how)["audit_records"] == (6 if n == 0 else 4)
    assert CP.segments(spark, f"{tmp_dir}/warehouse/events") and spark.read.option("recursiveFileLookup", True).text(f"{tmp_dir}/done").count()
    assert _run(spark, tmp_dir, 3, **how)["audit_records"] == 0
    assert _run(spark, tmp_dir, 4, full_refresh=True, **how)["audit_records"] == 10
