"""A task holds one page, or one event, at a time, however many pages it lands, reads or stages."""

import json
import os

from helpers import event, events_df
from pyspark.sql import functions as F

from logloom.sources import pages as PG
from logloom.streaming import ingest as ST

BASE = 1_700_000_000_000
EMPTY = {"meta": {"paging": {"totalSize": 0}}, "page": 0}


def _page(n, events=3, **more):
    return {"response": [{"id": f"{n}-{i}", "eventDate": BASE} for i in range(events)], "meta": {"paging": {"totalSize": 3}}, "page": n} | more


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(lines))


def test_pages_are_landed_one_at_a_time(spark, tmp_dir):
    """A hash aggregate held the arrays of all pages of a range at once."""
    evs = events_df(spark, [event(i, BASE + i) for i in range(25)]).drop("index")
    PG.land_pages(evs, tmp_dir, "response", 10, ["eventDate", "id"], envelope="events")
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plan = runs.apply(runs.size() - 1).physicalPlanDescription()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan
    assert spark.conf.get("spark.sql.execution.useObjectHashAggregateExec") == "true"
    pages = sorted((json.loads(r.value) for r in spark.read.text(tmp_dir).collect()), key=lambda p: p["page"])
    assert [len(p["response"]) for p in pages] == [10, 10, 5]
    assert [e["id"] for p in pages for e in p["response"]] == [str(i) for i in range(25)]


def test_numbered_pages_by_line_are_read_a_line_at_a_time(spark, tmp_dir, monkeypatch):
    """A file of many pages was one value in memory, and its lines another."""
    path = tmp_dir.removeprefix("file:")
    _write(f"{path}/run=1", "lines.json", [json.dumps(_page(n)) for n in range(4)] + ["", "  "])
    _write(f"{path}/run=1", "pretty.json", [json.dumps(_page(4), indent=1)])
    _write(f"{path}/run=1", "no-number.json", [json.dumps({k: v for k, v in _page(0).items() if k != "page"}) for _ in range(2)])
    _write(f"{path}/run=1", "broken.json", [json.dumps(_page(5)), json.dumps(_page(6))[:-20]])
    _write(f"{path}/run=1", "small.json", ["{}"])
    at_once = sorted(map(tuple, PG.landed(spark, path, large=[]).select("path", "doc").collect()))
    by_place = sorted(map(tuple, PG.landed(spark, path, large=[]).where(~F.col("path").contains("lines.json")).collect()))
    monkeypatch.setattr(PG, "BY_LINE", 20)
    docs = PG.landed(spark, path)
    assert sorted(map(tuple, docs.select("path", "doc").collect())) == at_once
    assert sorted(map(tuple, docs.where(~F.col("path").contains("lines.json")).collect())) == by_place
    assert [os.path.basename(p) for p in sorted(PG._not_by_line(spark, path, PG.WHOLE_FILE))] == ["broken.json", "no-number.json", "pretty.json"]
    frames = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in frames
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    odd = PG._not_by_line(spark, path, PG.WHOLE_FILE)
    size, where = F.col("_metadata.file_size"), F.col("_metadata.file_path")
    assert whole.where((size <= 20) | where.isin(odd)).count() == 4


def test_a_micro_batch_is_staged_an_event_a_row(spark, tmp_dir):
    """A staged page was one row of parsed events, of which Parquet holds a hundred before it looks at their size."""
    path = tmp_dir.removeprefix("file:")
    bad = json.dumps(_page(2))[:-20]
    _write(f"{path}/landing/run=1", "a.json", [json.dumps(_page(0)), json.dumps(EMPTY | {"page": 1})])
    _write(f"{path}/landing/run=1", "b.json", [bad])
    _write(f"{path}/landing/run=1", "c.json", [json.dumps(_page(3, response=[None, {"id": "x", "new": 1}]))])
    files = PG.file_sizes(spark.read, f"{tmp_dir}/landing")
    staged = ST._stage(files, 0, f"{tmp_dir}/sink", "run")
    assert sorted(((r.page, r.pos) for r in staged.where("NOT unreadable").collect()), key=str) == [(0, 0), (0, 1), (0, 2), (1, None), (3, 0), (3, 1)]
    ST.ingest_available(spark, f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", context="run")
    pages = spark.read.parquet(f"{tmp_dir}/sink_pages").select("page", "received", "announced").collect()
    assert sorted(map(tuple, pages)) == [(0, 3, 3), (1, 0, 0), (3, 2, 3)]
    assert [r.doc for r in spark.read.parquet(f"{tmp_dir}/sink_quarantine").collect()] == [bad]
    stored = spark.read.parquet(f"{tmp_dir}/sink")
    assert sorted((r.id or "", r.arrival.page, r.arrival.pos, r.extra) for r in stored.collect()) == [
        ("", 3, 0, None), ("0-0", 0, 0, None), ("0-1", 0, 1, None), ("0-2", 0, 2, None), ("x", 3, 1, {"new": "1"})]


def test_the_events_of_one_document_are_parsed_by_many_tasks(spark, tmp_dir):
    """a micro-batch of one file with one page was parsed by one task."""
    path = tmp_dir.removeprefix("file:")
    _write(f"{path}/landing/run=1", "a.json", [json.dumps(_page(0, events=400))])
    staged = ST._stage(PG.file_sizes(spark.read, f"{tmp_dir}/landing"), 0, f"{tmp_dir}/sink", "run")
    assert staged.count() == 400 and staged.select(F.input_file_name()).distinct().count() > 1
