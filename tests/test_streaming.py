from helpers import event, events_df
from pyspark.sql import functions as F

from logloom.sources import pages as PG
from logloom.streaming import compact as CP
from logloom.streaming import ingest as ST


def test_repeated_event_kept_once_across_runs_st2(spark, tmp_dir):
    base = 1_700_000_000_000
    run1 = events_df(spark, [event(i, base + i * 1000) for i in range(0, 6)]).drop("index")
    run2 = events_df(spark, [event(i, base + i * 1000) for i in range(4, 10)]
                     + [event(9, base + 9000)]).drop("index")
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    PG.land_pages(run1, f"{landing}/run=1", "response", 4, ["eventDate", "id"], envelope="events")
    ST.ingest_available(spark, landing, sink, ckpt, context="run")
    assert spark.read.parquet(sink).count() == 6
    PG.land_pages(run2, f"{landing}/run=2", "response", 4, ["eventDate", "id"], envelope="events")
    ST.ingest_available(spark, landing, sink, ckpt, context="run")
    stored = spark.read.parquet(sink)
    assert sorted(int(r.id) for r in stored.collect()) == list(range(10))   # each id once
    # A third run with nothing new adds nothing.
    ST.ingest_available(spark, landing, sink, ckpt, context="run")
    assert spark.read.parquet(sink).count() == 10


def test_old_repeats_are_dropped_and_old_new_events_kept(spark, tmp_dir):
    """Exact de-duplication: nothing is lost for being older than a watermark."""
    base = 1_700_000_000_000
    day = 86_400_000
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    run1 = events_df(spark, [event(1, base), event(2, base + 30 * day)]).drop("index")
    PG.land_pages(run1, f"{landing}/run=1", "response", 10, ["eventDate", "id"], envelope="events")
    ST.ingest_available(spark, landing, sink, ckpt, context="run")
    # 30 days later the source returns event 1 again and a never-seen event 3 from day 0.
    run2 = events_df(spark, [event(1, base), event(3, base + 5)]).drop("index")
    PG.land_pages(run2, f"{landing}/run=2", "response", 10, ["eventDate", "id"], envelope="events")
    ST.ingest_available(spark, landing, sink, ckpt, context="run")
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == ["1", "2", "3"]


def test_strict_keeps_repeated_events_d3(spark, tmp_dir):
    base = 1_700_000_000_000
    evs = events_df(spark, [event(1, base), event(1, base), event(2, base + 1)]).drop("index")
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    PG.land_pages(evs, f"{landing}/run=1", "response", 2, ["eventDate", "id"], envelope="events")
    ST.ingest_available(spark, landing, sink, ckpt, exact=False, context="run")
    assert spark.read.parquet(sink).count() == 3


def test_same_id_with_another_date_or_none_is_stored_once(spark, tmp_dir):
    base = 1_700_000_000_000
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    pulls = [[event(1, base), event(2, None)], [event(1, base + 400 * 86_400_000), event(2, None), event(2, base), event(3, base)]]
    for n, rows in enumerate(pulls):
        PG.land_pages(events_df(spark, rows).drop("index"), f"{landing}/run={n}", "response", 10, ["id", "eventDate"], envelope="events")
        ST.ingest_available(spark, landing, sink, ckpt, context="run")
    assert sorted((r.id, r.eventDate) for r in spark.read.parquet(sink).collect()) == [("1", base), ("2", None), ("3", base)]


def test_damaged_page_goes_to_quarantine_and_shows_as_short(spark, tmp_dir):
    base = 1_700_000_000_000
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    evs = events_df(spark, [event(i, base + i) for i in range(8)]).drop("index")
    PG.land_pages(evs, f"{tmp_dir}/good", "response", 4, ["eventDate", "id"], envelope="events")
    first, second = [r["doc"] for r in PG.landed(spark, f"{tmp_dir}/good").orderBy("doc").collect()]
    for name, doc in (("a", first), ("b", second[:-40])):
        spark.createDataFrame([(doc,)], "value string").write.mode("append").text(f"{landing}/run=1")
    ST.ingest_available(spark, landing, sink, ckpt, context="run")
    assert spark.read.parquet(sink).count() == 4
    assert [r.doc.strip() for r in spark.read.parquet(f"{sink}_quarantine").collect()] == [second[:-40]]
    short = ST.short_pulls(spark, sink).collect()
    assert [(r.run, r.received, r.announced, r.unreadable) for r in short] == [("1", 4, 8, 1)]
    # The page lands again, whole: the pull is complete, whatever lies in the quarantine.
    spark.createDataFrame([(second,)], "value string").write.mode("append").text(f"{landing}/run=1")
    ST.ingest_available(spark, landing, sink, ckpt, context="run", max_files=1)
    assert spark.read.parquet(sink).count() == 8 and ST.short_pulls(spark, sink).count() == 0


def test_stored_ids_are_not_shuffled_and_survive_a_new_catalog(spark, tmp_dir):
    """ST2: the check's stored side is a bucketed scan; only the batch's ids go through an exchange."""
    base = 1_700_000_000_000
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    for n in range(3):
        PG.land_pages(events_df(spark, [event(i, base + i) for i in range(n * 5, n * 5 + 8)]).drop("index"), f"{landing}/run={n}", "response", 4,
                      ["eventDate", "id"], envelope="events")
        ST.ingest_available(spark, landing, sink, ckpt, context="run", max_files=1)
        name = ST.id_index(spark, sink)
        if n == 1:
            spark.sql(f"DROP TABLE {name}")        # another session: only the folder is left
    assert sorted(int(r.id) for r in spark.read.parquet(sink).collect()) == list(range(18))
    assert sorted(int(r.id) for r in spark.table(name).collect()) == list(range(18))
    ids = spark.createDataFrame([("3",), ("99",)], "id string")
    known = ST.known_ids(spark.table(name), ids, batch_id=99)
    plan = known._jdf.queryExecution().sparkPlan().toString() + known._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "ShuffledHashJoin" in plan and plan.count("Exchange") == 1 and "SortMergeJoin" not in plan
    assert [r.id for r in known.collect()] == ["3"]
    # An index is made from the stored events where there is none.
    from logloom.sources import tables as TB
    TB.delete_path(spark, f"{sink}_ids")
    assert spark.table(ST.id_index(spark, sink)).count() == 18


def test_a_large_line_file_is_read_by_many_tasks(spark, tmp_dir, monkeypatch):
    import json
    import os
    path = tmp_dir.removeprefix("file:")
    os.makedirs(f"{path}/landing/run=1")
    page = lambda p: json.dumps({"response": [{"id": f"{p}-{i}", "eventDate": 5, "x": "y" * 50} for i in range(10)], "meta": {"paging": {"totalSize": 2000}}, "page": p})
    with open(f"{path}/landing/run=1/all.json", "w") as f:
        f.write("\n".join(page(p) for p in range(200)))
    with open(f"{path}/landing/run=1/small.json", "w") as f:
        json.dump({"response": [{"id": "z"}], "meta": {"paging": {"totalSize": 2000}}, "page": 200}, f, indent=1)
    monkeypatch.setattr(PG, "WHOLE_FILE", 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = PG.landed(spark, f"{tmp_dir}/landing", whole_file=2000)
        assert lines.count() == 201 and lines.rdd.getNumPartitions() > 4
        ST.ingest_available(spark, f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", context="run")
        assert spark.read.parquet(f"{tmp_dir}/sink").count() == 2001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _files(path):
    import os
    root = path.removeprefix("file:")
    return [f"{d}/{f}" for d, _, names in os.walk(root) for f in names if not f.startswith((".", "_"))]


def test_compaction_keeps_the_events_and_few_files(spark, tmp_dir):
    """File counts stay flat over many micro-batches; nothing is lost, doubled or taken from an unfinished segment."""
    import os

    base, day = 1_700_000_000_000, 86_400_000
    sink = f"{tmp_dir}/sink"
    counts, want = [], []
    for n in range(24):
        rows = [event(n * 3 + k, (base + k * day) if k else None) for k in range(3)]
        want += [(str(n * 3 + k), n) for k in range(3)]
        batch = (events_df(spark, rows).drop("index").withColumn("ingest_batch", F.lit(n).cast("bigint"))
                 .withColumn("event_day", F.to_date(F.timestamp_millis("eventDate"))))
        batch.write.mode("append").partitionBy("event_day", "ingest_batch").parquet(sink)
        CP.compact(spark, sink, min_batches=4)
        counts.append(len(_files(sink)) + len(_files(f"{sink}_segments")))
    assert max(counts[8:]) <= 40 < 24 * 3 and len(CP.segments(spark, sink)) <= 4
    got = ST.read_events(spark, sink)
    assert sorted((r.id, r.ingest_batch) for r in got.collect()) == sorted(want)
    assert got.schema["event_day"].dataType.simpleString() == "date"
    # a segment without its marker is as if it weren't there
    os.makedirs(f"{sink.removeprefix('file:')}_segments/0-99")
    assert ST.read_events(spark, sink).count() == len(want)
    # later batches only: segments that end before are not opened
    last = CP.segments(spark, sink)[-1]
    late = ST.read_events(spark, sink, after=last[0] - 1).where(F.col("ingest_batch") >= last[0])
    assert sorted(r.ingest_batch for r in late.collect()) == sorted(n for _, n in want if n >= last[0])
    assert len(late.inputFiles()) < len(got.inputFiles()) or len(CP.segments(spark, sink)) == 1
    # a compaction that died half way is done anew over the same folder
    more = events_df(spark, [event(1000, base)]).drop("index").withColumns({"ingest_batch": F.lit(24).cast("bigint"), "event_day": F.lit("2023-11-14").cast("date")})
    more.write.mode("append").partitionBy("event_day", "ingest_batch").parquet(sink)
    assert CP.compact(spark, sink, min_batches=1)[1] == 24 and ST.read_events(spark, sink).count() == len(want) + 1
    CP.clean(spark, sink)
    assert ST.read_events(spark, sink).count() == len(want) + 1 and not _files(sink)
    assert CP.compact(spark, sink, min_batches=1) is None


def test_the_id_index_is_rewritten_to_a_file_a_bucket(spark, tmp_dir):
    base = 1_700_000_000_000
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    for n in range(3):
        PG.land_pages(events_df(spark, [event(i, base + i) for i in range(n * 5, n * 5 + 8)]).drop("index"), f"{landing}/run={n}", "response", 4,
                      ["eventDate", "id"], envelope="events")
        ST.ingest_available(spark, landing, sink, ckpt, context="run", max_files=1)
        ST.compact_ids(spark, sink)
        CP.compact(spark, sink, min_batches=1)
        buckets = ST._index_folder(spark, sink)[1]
        assert ST._index_folder(spark, sink)[2] == n + 1
        assert len([f for f in _files(ST._index_folder(spark, sink)[0])]) <= buckets
        spark.sql(f"DROP TABLE {ST.id_index(spark, sink)}")       # another session
    assert sorted(int(r.id) for r in ST.read_events(spark, sink).collect()) == list(range(18))
    name = ST.id_index(spark, sink)
    assert sorted(int(r.id) for r in spark.table(name).collect()) == list(range(18))
    plan = spark.table(name).groupBy("id").agg(F.min("ingest_batch"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_done_files_leave_the_listing_and_come_back(spark, tmp_dir):
    base = 1_700_000_000_000
    landing, sink, ckpt, done = (f"{tmp_dir}/{x}" for x in ("landing", "sink", "ckpt", "done"))
    for n in range(6):
        PG.land_pages(events_df(spark, [event(i, base + i) for i in range(n * 4, n * 4 + 4)]).drop("index"), f"{landing}/run={n}", "response", 4,
                      ["eventDate", "id"], envelope="events")
    landed = len(_files(landing))
    for _ in range(3):
        ST.ingest_available(spark, landing, sink, ckpt, context="run", max_files=1, retire_to=done)
    assert sorted(int(r.id) for r in ST.read_events(spark, sink).collect()) == list(range(24))
    assert len(_files(landing)) < landed and len(_files(landing)) + len(_files(done)) >= landed
    assert ST.restore_retired(spark, landing, done) > 0 and ST.restore_retired(spark, landing, done) == 0
    ST.ingest_available(spark, landing, f"{sink}2", f"{ckpt}2", context="run")
    assert sorted(int(r.id) for r in ST.read_events(spark, f"{sink}2").collect()) == list(range(24))
    assert sorted(r.run for r in ST.pull_states(spark, f"{sink}2").where("state = 'complete'").collect()) == [str(n) for n in range(6)]


def test_a_micro_batch_makes_few_files_however_many_came_before(spark, tmp_dir, monkeypatch):
    """the id index has few buckets and is rewritten as it goes; a batch reads back its own folders alone."""
    monkeypatch.setattr(ST, "INDEX_FILES", 2)
    base = 1_700_000_000_000
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        for n in range(7):
            rows = [event(i, base + i) for i in range(n * 20, n * 20 + 30)]
            PG.land_pages(events_df(spark, rows).drop("index"), f"{landing}/run={n}", "response", 100, ["eventDate", "id"], envelope="events")
        ST.ingest_available(spark, landing, sink, ckpt, context="run", max_files=1)
        folder, buckets, generation = ST._index_folder(spark, sink)
        assert buckets == ST.MAX_BUCKETS and generation >= 1 and len(_files(folder)) < 3 * buckets
        files = spark.read.parquet(sink).select("ingest_batch", F.input_file_name().alias("file")).distinct()
        each = [r["n"] for r in files.groupBy("ingest_batch").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(each) == 7 and max(each) <= 16
        assert sorted(int(r.id) for r in spark.read.parquet(sink).collect()) == list(range(150))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_the_documents_of_one_file_are_parsed_by_many_tasks(spark, tmp_dir):
    """F1: a micro-batch of one landed file is no single task."""
    evs = events_df(spark, [event(i, 1_700_000_000_000 + i) for i in range(40)]).drop("index")
    PG.land_pages(evs.coalesce(1), f"{tmp_dir}/landing", "response", 5, ["eventDate", "id"], envelope="events")
    files = PG.file_sizes(spark.read, f"{tmp_dir}/landing")
    docs = ST.read_files(files.limit(1))
    whole = {r.path: r.doc for r in docs.select("path", "doc").collect()}
    assert docs.rdd.getNumPartitions() > 1 and len(whole) == 1
    assert ST.read_files(files).count() == 8
