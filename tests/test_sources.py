import json
import os

from helpers import event, events_df
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom import schemas
from logloom.operators import flatten as FL
from logloom.operators import tasks as TK
from logloom.plans import history as HI
from logloom.plans import incremental as INC
from logloom.sources import codes as CO
from logloom.sources import history as HS
from logloom.sources import pages as PG


def local(p):
    return p.removeprefix("file:")


def test_event_pages_round_trip_and_reconciliation(spark, tmp_dir):
    evs = events_df(spark, [event(i, 1_700_000_000_000 + i, aa_modelId=f"M{i % 3}") for i in range(25)])
    PG.land_pages(evs.drop("index"), tmp_dir, "response", 10, ["eventDate", "id"], envelope="events")
    back = PG.read_event_pages(spark, tmp_dir)
    assert back.count() == 25
    assert sorted(r.page for r in back.select("page").distinct().collect()) == [0, 1, 2]
    flat = FL.align_template(FL.flatten_struct(back.drop("page", "pos", "extra")), schemas.TEMPLATE)
    assert flat.columns == schemas.TEMPLATE_COLUMNS
    assert flat.where(F.col("`additionalAttributes.modelId`") == "M1").count() == 8
    pages = PG.read_pages(spark, tmp_dir, PG.page_schema("response", schemas.EVENT, "events"))
    rec = INC.page_reconciliation({"events": (pages, "response", "events", [])}).first()
    assert (rec.records_received, rec.records_announced, rec.pages_received) == (25, 25, 3)
    last = pages.where(F.col("meta.paging.nextUrl").isNull()).select("page").collect()
    assert [r.page for r in last] == [2]


def test_landed_pages_are_compressed_and_read_by_batch_and_stream(spark, tmp_dir):
    from logloom.streaming import ingest as ST

    evs = events_df(spark, [event(i, 1_700_000_000_000 + i, aa_modelId=f"M{i % 3}") for i in range(400)])
    PG.land_pages(evs.drop("index"), f"{tmp_dir}/pages/run=1", "response", 10, ["eventDate", "id"], envelope="events")
    files = [os.path.join(d, f) for d, _, names in os.walk(local(f"{tmp_dir}/pages")) for f in names if f.startswith("part-")]
    text = sum(len(r.doc) for r in PG.landed(spark, f"{tmp_dir}/pages").collect())
    assert len(files) == 5 and sum(map(os.path.getsize, files)) * 4 < text
    # whole files and files read by line alike
    by_line = PG.landed(spark, files, large=files, whole_file=0)
    assert sorted(r.doc for r in by_line.collect()) == sorted(r.doc for r in PG.landed(spark, f"{tmp_dir}/pages").collect())
    ST.ingest_available(spark, f"{tmp_dir}/pages", f"{tmp_dir}/events", f"{tmp_dir}/ckpt", context="run")
    stored, scanned = spark.read.parquet(f"{tmp_dir}/events"), PG.read_event_pages(spark, f"{tmp_dir}/pages")
    for rows in (stored, scanned):
        assert rows.count() == 400 and rows.select("id").distinct().count() == 400


def test_multiline_pretty_page_and_drift(spark, tmp_dir):
    path = local(tmp_dir)
    os.makedirs(os.path.join(path, "page=0"))
    page = {"Resources": [{"id": "U1", "userName": "a", "displayName": "A", "x": 1},
                          {"id": "U1", "userName": "a", "displayName": "A"}],
            "itemsPerPage": 2, "startIndex": 1, "totalResults": 3}
    with open(os.path.join(path, "page=0", "p.json"), "w") as f:
        json.dump(page, f, indent=2)
    pages = PG.read_pages(spark, tmp_dir, PG.page_schema("Resources", schemas.USER, "scim"))
    users = PG.explode_records(pages, "Resources")
    assert users.count() == 2                                   # duplicates kept by the scan
    rec = INC.page_reconciliation({"users": (pages, "Resources", "scim", [])}).first()
    assert (rec.records_received, rec.records_announced) == (2, 3)  # shortfall is reported
    wide = spark.createDataFrame([("1", "z")], "id string, `additionalAttributes.x` string")
    assert FL.drift_columns(wide, schemas.TEMPLATE) == ["additionalAttributes.x"]
    aligned = FL.align_template(wide, schemas.TEMPLATE)
    assert aligned.columns == schemas.TEMPLATE_COLUMNS + ["additionalAttributes.x"]


def test_ragged_codes_d13(spark, tmp_dir):
    lines = spark.createDataFrame([("A,m,--",), ("B,m,N/A,--",), ("C,m,x,y",)], "value string")
    CO.land_csv_lines(lines, tmp_dir, ",".join(schemas.ACT_CODE_COLUMNS))
    got = {r[0]: tuple(r) for r in CO.read_activity_codes(spark, tmp_dir).collect()}
    assert got == {"A": ("A", "m", "--", None), "B": ("B", "m", None, "--"), "C": ("C", "m", "x", "y")}


def test_task_failures_with_empty_details(spark):
    tasks = spark.createDataFrame([{
        "taskId": "T1", "workspaceId": "W", "modelId": "M",
        "task": {"taskState": "COMPLETE", "result": {"nestedResults": [
            {"objectId": "A1", "failureDumpAvailable": True,
             "details": [{"localMessageText": schemas.MISSING_ITEM_MESSAGE, "values": ["e1", "e2"]},
                         {"localMessageText": "other", "values": ["z"]}]},
            {"objectId": "A2", "failureDumpAvailable": True, "details": []},
            {"objectId": "A3", "failureDumpAvailable": False, "details": []},
        ]}}}], schemas.TASK_PAGE)
    actions = spark.createDataFrame([("A1", "load", "W", "M")], "id string, name string, workspace_id string, model_id string")
    got = sorted((tuple(r) for r in TK.task_failures(tasks, actions).collect()), key=str)
    assert got == sorted([("T1", "W", "M", "A1", "load", "other", None),
                          ("T1", "W", "M", "A1", "load", schemas.MISSING_ITEM_MESSAGE, "e1,e2"),
                          ("T1", "W", "M", "A2", "-1", None, None)], key=str)


def test_named_items_last_match_wins(spark):
    docs = spark.createDataFrame([{"docId": "d", "items": [
        {"id": "1", "name": "Time Stamp", "moduleId": "a"},
        {"id": "2", "name": "Records", "moduleId": "a"},
        {"id": "3", "name": "Time Stamp", "moduleId": "b"}]}], schemas.NAMED_ITEMS_PAGE)
    got = {r.name: (r.id, r.moduleId) for r in TK.lookup_named_items(docs, "items", ["Time Stamp"]).collect()}
    assert got == {"Time Stamp": ("3", "b")}


def test_history_chunks_header_once_and_merge(spark, tmp_dir):
    rows = spark.createDataFrame([(f"2024-01-{i % 28 + 1:02d}", f"u{i}", str(i)) for i in range(23)],
                                 "`Date/Time` string, `User Name` string, `New Value (x)` string")
    HS.land_history_chunks(rows, tmp_dir, 5, ["`New Value (x)`", "`User Name`"])
    assert HS.read_history_header(spark, tmp_dir) == ["Date/Time", "User Name", "New Value (x)"]
    back = HS.read_history_chunks(spark, tmp_dir)
    assert back.columns == ["Date_Time", "User_Name", "New_Value_x"]
    assert back.count() == 23                        # no data row eaten as a header (D-11)
    HI.create_history(back.where("User_Name < 'u2'"), f"{tmp_dir}-table", "Date_Time")
    for _ in range(2):                               # a merge that runs twice changes nothing more
        merged = HI.merge_history(spark, f"{tmp_dir}-table", back, "Date_Time")
        assert merged.count() == 23 and merged.columns == back.columns


def test_history_merge_leaves_other_months_alone(spark, tmp_dir):
    cols = "Date_Time string, v string"
    HI.create_history(spark.createDataFrame([("2024-01-05", "a"), ("2024-02-01", "b"), (None, "c")], cols), tmp_dir, "Date_Time")
    before = {r.f for r in spark.read.parquet(tmp_dir).where("history_period = '2024-01'").select(F.input_file_name().alias("f")).collect()}
    latest = spark.createDataFrame([("2024-02-01", "b"), ("2024-02-03", "d"), (None, "c"), ("2024-03-01", "e")], cols)
    got = sorted(((r.Date_Time or "", r.v) for r in HI.merge_history(spark, tmp_dir, latest, "Date_Time").collect()))
    assert got == [("", "c"), ("2024-01-05", "a"), ("2024-02-01", "b"), ("2024-02-03", "d"), ("2024-03-01", "e")]
    assert before == {r.f for r in spark.read.parquet(tmp_dir).where("history_period = '2024-01'").select(F.input_file_name().alias("f")).collect()}


def test_history_values_with_line_breaks_and_separators(spark, tmp_dir):
    rows = spark.createDataFrame([("1", "two\nlines", 'say "x"\tand y'), ("2", "plain", None)], "`a\tb` string, `c` string, `d` string")
    HS.land_history_chunks(rows, tmp_dir, 1, ["`a\tb`"])
    assert HS.read_history_header(spark, tmp_dir) == ["a\tb", "c", "d"]
    assert sorted(tuple(r) for r in HS.read_history_chunks(spark, tmp_dir, sanitize=False).collect()) == [
        ("1", "two\nlines", 'say "x"\tand y'), ("2", "plain", None)]


def test_unknown_event_fields_are_kept(spark, tmp_dir):
    page = {"response": [{"id": "1", "eventDate": 5, "new": {"a": [1, 2]}, "additionalAttributes": {"modelId": "M", "x": "y"}},
                         {"id": "2", "additionalAttributes": None}, {"id": "3"}], "meta": {"paging": {"totalSize": 3}}}
    os.makedirs(local(tmp_dir))
    with open(os.path.join(local(tmp_dir), "p.json"), "w") as f:
        json.dump(page, f, indent=1)
    got = {r.id: r for r in PG.read_event_pages(spark, tmp_dir).collect()}
    assert got["1"].extra == {"new": '{"a":[1,2]}', "additionalAttributes.x": "y"} and got["1"].additionalAttributes.modelId == "M"
    assert got["2"].extra is None and got["3"].extra is None and len(got) == 3


def _files(path, **texts):
    os.makedirs(local(path), exist_ok=True)
    for name, text in texts.items():
        with open(os.path.join(local(path), f"{name}.json"), "w") as f:
            f.write(text)


def test_unreadable_list_page_fails_the_read(spark, tmp_dir):
    import pytest
    good = '{"Resources": [{"id": "U1"}], "totalResults": 1}'
    for n, bad in enumerate(('{"status": "FAILURE", "totalResults": 3}', good[:-9])):   # announces records without them; cut off
        _files(f"{tmp_dir}/{n}", a=good, b=bad)
        pages = PG.read_pages(spark, f"{tmp_dir}/{n}", PG.page_schema("Resources", schemas.USER, "scim"))
        with pytest.raises(Exception, match="unreadable page"):
            PG.explode_records(pages, "Resources").count()


def test_a_page_that_announces_nothing_is_empty(spark, tmp_dir):
    none = '{"meta": {"paging": {"totalSize": 0}}, "status": {"code": 200}}'
    _files(tmp_dir, a='{"models": [{"id": "M1"}], "meta": {"paging": {"totalSize": 1}}}', b=none, c='{"status": {"code": 200}}')
    pages = PG.read_pages(spark, tmp_dir, PG.page_schema("models", schemas.MODEL))
    assert [r.id for r in PG.explode_records(pages, "models").collect()] == ["M1"]
    _files(f"{tmp_dir}-events", a=none)
    assert PG.read_event_pages(spark, f"{tmp_dir}-events").collect() == []
    kinds = PG.read_pages(spark, f"{tmp_dir}-events", PG.page_schema("records", schemas.NAMED_ASSET), names=schemas.ASSET_KINDS)
    assert [r.records for r in kinds.collect()] == [[]]


def test_new_fields_of_lists_become_columns(spark, tmp_dir):
    rows = [{"integrationId": "C1", "name": "n", "latestRun": {"success": True, "host": "h"}, "zone": {"a": 1}}, {"integrationId": "C2", "NAME": "other"}]
    _files(tmp_dir, a=json.dumps({"integrations": rows, "meta": {"paging": {"totalSize": 2}}}))
    pages = PG.read_pages(spark, tmp_dir, PG.page_schema("integrations", T.StringType()))
    records = PG.list_records(pages, "integrations", schemas.INTEGRATION)
    wide = PG.widened(records)
    assert wide.columns == [*schemas.INTEGRATION.names, "NAME_", "latestRun.host", "zone"]
    got = {r["integrationId"]: r for r in wide.collect()}
    assert (got["C1"]["latestRun.host"], got["C1"]["zone"], got["C1"]["latestRun"]["success"]) == ("h", '{"a":1}', True)
    assert got["C2"]["NAME_"] == "other" and got["C2"]["zone"] is None
    few = PG.widened(records, max_new=1)
    assert few.columns[-2:] == ["NAME_", "extra"]
    assert {r["integrationId"]: r["extra"] for r in few.collect()} == {"C1": '{"zone":"{\\"a\\":1}","latestRun.host":"h"}', "C2": None}
    plain = PG.widened(records.withColumn("extra", F.lit(None).cast("map<string,string>")))
    assert plain.columns == schemas.INTEGRATION.names


def test_history_merge_reads_only_the_months_of_the_export(spark, tmp_dir):
    months = spark.range(72).select(F.format_string("%d-%02d-05", F.expr("2018 + id div 12"), F.col("id") % 12 + 1).alias("Date_Time"),
                                    F.col("id").cast("string").alias("v"))
    HI.create_history(months, tmp_dir, "Date_Time")
    latest = spark.createDataFrame([("2020-03-05", "26"), ("2020-03-09", "new")], "Date_Time string, v string")
    stored = spark.read.parquet(tmp_dir)
    periods = latest.select(F.substring("Date_Time", 1, 7).alias(HI.PERIOD)).distinct()
    touched = HI.touched_periods(stored, periods)
    assert touched.count() == 1
    scan = touched._jdf.queryExecution().executedPlan()
    touched._jdf.collectToPython()
    leaves = scan.collectLeaves()
    numbers = [leaves.apply(i).metrics().get("numPartitions").get().value() for i in range(leaves.size())]
    assert numbers == [1]                              # of 72
    assert HI.touched_periods(stored, periods, max_periods=0).count() == 1
    assert HI.merge_history(spark, tmp_dir, latest, "Date_Time").count() == 73
