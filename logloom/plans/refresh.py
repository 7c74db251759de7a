"""The whole refresh as one Spark job: ingest -> dimensions -> report -> export -> log.

Landing folder (written by whatever pulls the source API)::

    <landing>/events/run=<n>/page=<p>/...         event pages   (record path ``response``)
    <landing>/users/page=<p>/...                  SCIM pages    (``Resources``)
    <landing>/workspaces/page=<p>/...             meta pages    (``workspaces``)
    <landing>/models/page=<p>/...                 meta pages    (``models``)
    <landing>/assets/workspace_id=<w>/model_id=<m>/kind=<k>/page=<p>/...
                                                  meta pages    (record path = the kind)
    <landing>/integrations/page=<p>/...           meta pages    (``integrations``)
    <landing>/act_codes/                          CSV with header

Warehouse folder (shared storage)::

    events/          Parquet by event_day/ingest_batch, appended by the streaming ingest (deduplicated)
    events_segments/ events of many micro-batches, compacted
    versions/<version>/   what one run has made, beside what the runs before it made:
        users/ workspaces/ models/ actions/ files/ integrations/ act_codes/
        exports/<file>/chunk=<n>/   one CSV per chunk
        samples/<file>/
    refresh_log/     one row per run, in run=<batch_id>/ (a retried run replaces its own)
    events_pages/ events_quarantine/   what each page announced and delivered; pages that can't be read
    _state/watermark one row appended per run, written LAST (a failed run is re-run from the one before)
    _checkpoints/    streaming checkpoints

The state row also names the run's version: it is the one pointer that publishes
tables, exports and watermark together.  ``published`` follows it.  A run that
dies before it leaves the set before readable whole; its own folder is removed,
like versions beyond ``keep_versions``, by the next run that ends.  A full
refresh opens a new epoch of the state, and what was published stays until its
own set stands.

New events are those of micro-batches that no run has exported yet, however old
their dates are.  Each pull has a state of its own: one that has delivered less
than it announces is open, its events wait and are named in the summary
(``open``), while those of complete pulls are exported; it is closed by the
missing page, or by an operator who accepts it as it is (``accept_pulls``).
A list that has delivered less than it announces holds the whole run, as the
report would lack its names (``held``), unless short lists are accepted.  Asset
folders that should have landed and have not are named (``missing_assets``).

Every step is a DataFrame or Structured Streaming job; the driver only reads
one-row results, counts and short pulls.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom import schemas
from logloom.operators import dimensions as D
from logloom.operators.identity import row_index
from logloom.operators.joins import bounded_broadcast
from logloom.plans import export as EX
from logloom.plans import incremental as INC
from logloom.plans.report import Dimensions, incremental_condition
from logloom.session import shared_dir
from logloom.sources import codes as CO
from logloom.sources import pages as PG
from logloom.sources import tables as TB
from logloom.streaming import compact as CP
from logloom.streaming import ingest as ST


@dataclass
class RefreshSettings:
    tenant_name: str
    batch_id: int                         # epoch seconds of this run (job parameter)
    last_run: int | None = None           # None: read the saved watermark
    chunk_size: int = schemas.EXPORT_CHUNK_SIZE
    scope_approach: str = "all"           # "skip", "select", anything else keeps all
    scope_combos: list[tuple[str, str]] = field(default_factory=list)
    target_model: str | None = None
    samples: tuple[str, ...] = ()         # targets written as a sample file ("all": every list)
    strict: bool = False
    full_refresh: bool = False            # drop events, stream checkpoint and state first (K12)
    max_files: int | None = None          # landed files per micro-batch
    accept_pulls: tuple[str, ...] = ()    # pulls that are short and taken as they are, from now on
    accept_short_lists: bool = False      # go on with lists that have delivered less than they announce
    publish: bool = True                  # False: write the set to look at, commit nothing; the next run takes the same events
    keep_versions: int = 2                # published sets kept, the newest included (readers may still be on the one before)
    retire_to: str | None = None          # folder outside the landing for event pages that are done; a full refresh puts them back
    compact_batches: int = CP.MIN_BATCHES  # stored micro-batches that are rewritten to larger files together; 0: never

    def is_sample(self, target: str) -> bool:
        return "all" in self.samples or target in self.samples


# --- fixed values: export file names and counter acronyms of the target lists ----
EXPORTS = {
    "users": ("USER_LIST.csv", "USR"),
    "workspaces": ("WORKSPACE_LIST.csv", "WS"),
    "models": ("MODEL_LIST.csv", "MOD"),
    "actions": ("ACTION_LIST.csv", "ACT"),
    "files": ("FILE_LIST.csv", "FILE"),
    "integrations": ("CLOUDWORKS_LIST.csv", "CW"),
    "act_codes": ("ACTIVITY_CODES.csv", None),
}
REPORT_EXPORT = "AUDIT_LOG.csv"
# --- end of fixed values --------------------------------------------------------

EXPORT_KEYS = {
    "users": ["id"], "workspaces": ["id"], "models": ["id"], "actions": ["id", "model_id"],
    "files": ["id", "model_id"], "integrations": ["integrationId"], "act_codes": ["Event Code"],
}


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


@dataclass(frozen=True)
class State:
    """What the last run that ended has exported and published."""
    last_run: int = 0
    ingest_batch: int = -1
    seq: int = 0                # number of the newest row
    epoch: int = 0              # full refreshes before it
    version: str | None = None  # the published set


#: A run's row: the watermark, the newest micro-batch, the pulls that it has exported, each up to a micro-batch, and the set it publishes.
STATE = ("batch_id bigint, last_run bigint, ingest_batch bigint, pulls array<struct<run:string,ingest_batch:bigint,accepted:boolean>>, "
         "seq bigint, epoch bigint, version string")


def _state_rows(spark: SparkSession, warehouse: str) -> DataFrame | None:
    """Rows from before there were versions are of epoch 0 and number 0."""
    path = _p(warehouse, "_state", "watermark")
    if ST.read_if_there(spark, path) is None:
        return None
    return spark.read.schema(STATE).parquet(path).withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("seq", "epoch")})


def read_state(spark: SparkSession, warehouse: str) -> State:
    """The newest saved row; only a state that was never written reads as none."""
    rows = _state_rows(spark, warehouse)
    if rows is None:
        return State()
    newest = rows.agg(F.max(F.struct("epoch", "ingest_batch", "last_run")).alias("s"), F.max("seq").alias("seq"),
                      F.max(F.when(F.col("version").isNotNull(), F.struct("seq", "version"))).alias("set")).first()
    s = newest["s"]
    if s is None or s["last_run"] is None:
        raise RuntimeError(f"no watermark can be read from {_p(warehouse, '_state', 'watermark')}")
    return State(int(s["last_run"]), int(s["ingest_batch"]), int(newest["seq"]), int(s["epoch"]), newest["set"] and newest["set"]["version"])


def read_watermark(spark: SparkSession, warehouse: str) -> int:
    return read_state(spark, warehouse).last_run


def version_folder(warehouse: str, version: str | None, *parts: str) -> str:
    """Sets from before there were versions lie in the warehouse folder itself."""
    return _p(warehouse, *(["versions", version] if version else []), *parts)


def published(spark: SparkSession, warehouse: str, *parts: str) -> str:
    """The folder of a list's table, an export or a sample in the published set; read all of them by one call's version."""
    return version_folder(warehouse, read_state(spark, warehouse).version, *parts)


def save_state(spark: SparkSession, warehouse: str, batch_id: int, state: State, pulls: DataFrame | None = None, version: str | None = None) -> None:
    """One row in one file, so watermark, pulls and published set are committed together; ``pulls``: (run, newest_batch, state), one small struct a pull."""
    row = spark.createDataFrame([(int(batch_id), state.last_run, state.ingest_batch, state.seq + 1, state.epoch, version)],
                                "batch_id bigint, last_run bigint, ingest_batch bigint, seq bigint, epoch bigint, version string")
    if pulls is None:
        done = spark.createDataFrame([([],)], "pulls array<struct<run:string,ingest_batch:bigint,accepted:boolean>>")
    else:
        done = pulls.agg(F.collect_list(F.struct("run", F.col("newest_batch").alias("ingest_batch"), (F.col("state") == ST.ACCEPTED).alias("accepted"))).alias("pulls"))
    row.join(F.broadcast(done)).coalesce(1).write.mode("append").parquet(_p(warehouse, "_state", "watermark"))


def retire_versions(spark: SparkSession, warehouse: str, keep: int) -> None:
    """Remove what runs that died have left, and published sets but the newest ``keep``."""
    rows = _state_rows(spark, warehouse).filter("version IS NOT NULL").orderBy(F.desc("seq"))
    kept = {r["version"] for r in rows.select("version").limit(max(1, keep)).collect()}
    for name in TB.folder_names(spark, _p(warehouse, "versions")):
        if name not in kept:
            TB.delete_path(spark, _p(warehouse, "versions", name))


def exported_pulls(spark: SparkSession, warehouse: str, epoch: int = 0) -> tuple[DataFrame | None, int]:
    """Per pull the newest micro-batch exported and whether it was accepted; and the batch up to which runs before pulls had states exported all."""
    rows = _state_rows(spark, warehouse)
    if rows is None:
        return None, -1
    rows = rows.filter(F.col("epoch") == epoch)
    each = rows.select(F.explode("pulls").alias("p")).groupBy(F.col("p.run").alias("done_run")).agg(
        F.max("p.ingest_batch").alias("done"), F.max("p.accepted").alias("was_accepted"))
    before = rows.filter("pulls IS NULL").agg(F.max("ingest_batch")).first()[0]
    return each, -1 if before is None else int(before)


def pulls_of_run(spark: SparkSession, warehouse: str, events_path: str, settings: "RefreshSettings", epoch: int = 0) -> DataFrame | None:
    """The pulls with their states, staged, and ``done``, the newest micro-batch of each that a run has exported."""
    exported, before = exported_pulls(spark, warehouse, epoch)
    pulls = ST.pull_states(spark, events_path, list(settings.accept_pulls))
    if pulls is None:
        return None
    if exported is None:
        pulls = pulls.withColumn("done", F.lit(before).cast("bigint"))
    else:
        # once accepted, a pull stays accepted
        state = F.when((F.col("state") == ST.OPEN) & F.coalesce("was_accepted", F.lit(False)), ST.ACCEPTED).otherwise(F.col("state"))
        pulls = (pulls.join(exported, F.col("run").eqNullSafe(F.col("done_run")), "left").withColumn("state", state)
                 .withColumn("done", F.coalesce("done", F.lit(before).cast("bigint"))).drop("done_run", "was_accepted"))
    path = shared_dir(spark, "pulls")
    pulls.write.parquet(path)
    return spark.read.schema(pulls.schema).parquet(path)


def events_to_export(events: DataFrame, pulls: DataFrame | None, floor: int | None) -> DataFrame:
    """Stored events of closed pulls that no run has exported, late ones too."""
    if floor is None:
        return events.where(F.lit(False))
    new = events.where(F.col("ingest_batch") > int(floor))
    if pulls is None:
        return new
    ready = _ready(pulls).select(F.col("run").alias("__run"), F.col("done").alias("__done"))
    return (new.join(bounded_broadcast(ready), F.col("arrival.run").eqNullSafe(F.col("__run")) & (F.col("ingest_batch") > F.col("__done")))
            .drop("__run", "__done"))


def _ready(pulls: DataFrame) -> DataFrame:
    return pulls.where((F.col("state") != ST.OPEN) & (F.col("newest_batch") > F.col("done")))


def export_floor(pulls: DataFrame | None, state: State) -> int | None:
    """A bound on the files read: the oldest micro-batch that a pull has new events in comes after it; None if there is none."""
    if pulls is None:
        return state.ingest_batch
    return _ready(pulls).agg(F.min(F.greatest("done", F.col("first_batch") - 1))).first()[0]


def reset(spark: SparkSession, warehouse: str, batch_id: int = 0) -> None:
    """A full refresh starts from no events, no stream checkpoint and a state of none.

    The state's new epoch is written first: a run that dies in between has
    forgotten nothing but what the next one reads again.  A state that can't be
    read is an error here too; with the folder ``_state`` removed, nothing is published.
    """
    if _state_rows(spark, warehouse) is not None:
        state = read_state(spark, warehouse)
        save_state(spark, warehouse, batch_id, State(seq=state.seq, epoch=state.epoch + 1))
    for name in ("events", "events_pages", "events_quarantine", "events_staging", "events_ids", "events_segments", "_checkpoints"):
        TB.delete_path(spark, _p(warehouse, name))


def write_log(spark: SparkSession, warehouse: str, settings: "RefreshSettings", counted: DataFrame) -> None:
    TB.write_table(EX.refresh_log_row(spark, settings.batch_id, counted),
                   path=_p(warehouse, "refresh_log", f"run={settings.batch_id}"), mode="overwrite")


def _codes_or_empty(spark: SparkSession, path: str) -> DataFrame:
    try:
        return CO.read_activity_codes(spark, path)
    except AnalysisException as err:
        if not PG.missing(err):
            raise
        return spark.createDataFrame([], schemas.ACT_CODES)


#: Lists whose new fields become columns of their tables: record path, known record.
GROWING = {"workspaces": schemas.WORKSPACE, "models": schemas.MODEL, "integrations": schemas.INTEGRATION}


def metadata_pages(spark: SparkSession, landing: str) -> dict[str, tuple[DataFrame, str, str, list[str]]]:
    """Each list's pages, record path, envelope and context folders; records of lists that may grow are JSON text."""
    def pages(folder, record_path, record, envelope="meta", context=None, names=None):
        schema = PG.page_schema(record_path, record, envelope, context=context)
        return PG.read_pages(spark, _p(landing, folder), schema, missing_ok=True, names=names), record_path, envelope, context or []

    found = {"users": pages("users", "Resources", schemas.USER, "scim")}
    found |= {name: pages(name, name, T.StringType()) for name in GROWING}
    # All five asset kinds in ONE read: each page has exactly one of the arrays.
    found["assets"] = pages("assets", "records", schemas.NAMED_ASSET, context=["workspace_id", "model_id", "kind"], names=schemas.ASSET_KINDS)
    return found


def short_lists(lists: dict) -> list[dict]:
    """Lists (assets: per workspace, model and kind) that have delivered fewer records than announced."""
    out = None
    for name, (pages, record_path, envelope, context) in lists.items():
        rows = INC.received_and_announced(pages, name, record_path, envelope, context)
        out = rows if out is None else out.unionByName(rows)
    short = out.filter("received < announced")
    # the number of short lists is reported; some of them by name
    n = short.count()
    return [{"short": n, "first": [r.asDict() for r in short.orderBy("entity", "context").limit(20).collect()]}] if n else []


def scoped_models(spark: SparkSession, models: DataFrame, settings: RefreshSettings) -> DataFrame:
    """Active models in scope, whatever the approach."""
    combos = spark.createDataFrame(settings.scope_combos, "WorkspaceId string, ModelId string")
    return D.apply_scope(D.active_models(models), settings.scope_approach, combos, settings.target_model)


def missing_assets(spark: SparkSession, lists: dict, settings: RefreshSettings) -> DataFrame:
    """(workspace, model, kind) of the worklist of which no page has landed; an empty page is a page."""
    models = D.dim_models(PG.list_records(lists["models"][0], "models", schemas.MODEL).drop("extra"))
    keys = ["workspace_id", "model_id", "kind"]
    expected = D.crawl_worklist(scoped_models(spark, models, settings), lists["assets"][0]).select(*keys)
    return expected.join(lists["assets"][0].select(*keys).distinct(), keys, "left_anti")


def load_dimensions(spark: SparkSession, landing: str, settings: RefreshSettings, lists: dict | None = None) -> dict[str, DataFrame]:
    """Entry 2: every dimension from all of its landed pages, one read each."""
    lists = lists or metadata_pages(spark, landing)
    users = PG.explode_records(lists["users"][0], "Resources")
    ws, models, cw = (PG.widened(PG.list_records(lists[n][0], n, record)) for n, record in GROWING.items())
    assets = lists["assets"][0].select("workspace_id", "model_id", "kind", F.explode("records").alias("r")) \
        .select("r.id", "r.name", "workspace_id", "model_id", "kind")
    unique = not settings.strict
    models_dim = D.dim_models(models, unique)
    # Only assets of active models in scope are taken.
    in_scope = scoped_models(spark, models_dim, settings)
    if lists["models"][0].isEmpty():        # no models list has landed: nothing to tell by
        in_scope = assets.select(F.col("model_id").alias("id"))
    assets = assets.join(in_scope.select(F.col("id").alias("model_id")).distinct(), "model_id", "left_semi")
    return {
        "users": D.dim_users(users, unique),
        "workspaces": D.unique_on(ws, ["id"]) if unique else ws,
        "models": models_dim,
        "actions": D.dim_assets(assets.where(F.col("kind") != "files"), unique),
        "files": D.dim_assets(assets.where(F.col("kind") == "files"), unique),
        "integrations": D.dim_integrations(cw, unique),
        "act_codes": _codes_or_empty(spark, _p(landing, "act_codes")),
    }


def run_refresh(spark: SparkSession, landing: str, warehouse: str, settings: RefreshSettings) -> dict:
    """Entries 1-3 of one run; returns a small summary (counts and watermark)."""
    if settings.full_refresh:
        reset(spark, warehouse, settings.batch_id)
        if settings.retire_to:
            ST.restore_retired(spark, _p(landing, "events"), settings.retire_to)
    state = read_state(spark, warehouse)
    last_run = settings.last_run if settings.last_run is not None else state.last_run
    events_path = _p(warehouse, "events")
    # Entry 1: ingest whatever pages arrived since the last committed batch.
    try:
        ST.ingest_available(spark, _p(landing, "events"), events_path, _p(warehouse, "_checkpoints", "events"),
                            exact=not settings.strict, context="run", max_files=settings.max_files, retire_to=settings.retire_to)
    except AnalysisException as err:        # no event page has ever landed
        if not PG.missing(err):
            raise
    pulls = pulls_of_run(spark, warehouse, events_path, settings, state.epoch)
    by_date = settings.strict or settings.last_run is not None
    floor = None if by_date else export_floor(pulls, state)
    events = ST.read_events(spark, events_path, -1 if floor is None else int(floor))
    if events is None:                      # nothing ever landed: an empty, typed table
        events = spark.createDataFrame([], schemas.EVENT).withColumn("ingest_batch", F.lit(None).cast("bigint"))
    if by_date:
        # By date: partition pruning lists and reads only day folders on or after the watermark's day.
        if "event_day" in events.columns:
            first_day = _dt.datetime.fromtimestamp(last_run / 1000, _dt.timezone.utc).date()
            events = events.where(F.col("event_day") >= F.lit(first_day))
        new_stored = events.where(incremental_condition(last_run, settings.strict))
        if pulls is not None and not settings.strict:      # strict goes on with short pulls, as the source does
            waiting = pulls.where(F.col("state") == ST.OPEN).select(F.col("run").alias("__run"))
            new_stored = new_stored.join(bounded_broadcast(waiting), F.col("arrival.run").eqNullSafe(F.col("__run")), "left_anti")
    else:
        # By arrival: whatever no run has exported of the pulls that are closed, late events too.
        new_stored = events_to_export(events, pulls, floor)
    mark = new_stored.agg(F.max("eventDate").alias("newest"), F.count(F.lit(1)).alias("n"), F.max("ingest_batch").alias("batch")).first()
    next_wm = max(last_run, int(mark["newest"] or 0))
    if settings.strict:
        # D-2 strict: the date of the last row received, by (run, page, position).
        arrived = new_stored.select("eventDate", *([F.struct("ingest_batch", "arrival.run", "arrival.page").alias("page"),
                                                    F.col("arrival.pos").alias("pos")] if "arrival" in events.columns
                                                   else [F.lit(0).alias("page"), F.lit(0).alias("pos")]))
        next_wm = int(INC.next_watermark_strict(arrived, last_run).first()["next_watermark"])
    summary = {"last_run": last_run, "next_watermark": next_wm, "audit_records": int(mark["n"])}
    done = replace(state, last_run=next_wm, ingest_batch=max(state.ingest_batch, int(mark["batch"] if mark["batch"] is not None else -1)))
    new = new_stored.drop(*[c for c in ST.META_COLUMNS if c in new_stored.columns])
    counted = new.agg(F.count(F.lit(1)).alias("audit_records"))

    lists = metadata_pages(spark, landing)
    closed = None
    if pulls is not None:
        waiting = pulls.where(F.col("state") == ST.OPEN)
        if n_open := waiting.count():
            summary["open"] = {"pulls": n_open, "first": [r.asDict() for r in waiting.orderBy("run").limit(20).collect()]}
        closed = pulls.where((F.col("state") != ST.OPEN) & (F.col("newest_batch") > F.col("done")))
    gaps = missing_assets(spark, lists, settings)
    if n_gaps := gaps.count():
        summary["missing_assets"] = {"lists": n_gaps, "first": [r.asDict() for r in gaps.orderBy(*gaps.columns).limit(20).collect()]}
    held = [] if settings.accept_short_lists or settings.strict else short_lists(lists)
    if held:
        write_log(spark, warehouse, settings, counted.select(F.lit(0).cast("bigint").alias("audit_records")))
        return summary | {"held": held, "audit_records": 0, "next_watermark": state.last_run}
    if mark["n"] == 0:
        write_log(spark, warehouse, settings, counted)
        if settings.strict:                 # D-2 strict: the raised watermark is saved as well
            save_state(spark, warehouse, settings.batch_id, done)
        return summary

    # Everything the run makes goes to a folder of its own, beside the published set.
    version = f"{settings.batch_id}-{uuid.uuid4().hex[:8]}"
    home = version_folder(warehouse, version)
    # Entry 2: dimensions, as whole tables.
    dims = load_dimensions(spark, landing, settings, lists)
    for name, df in dims.items():
        TB.write_table(df, path=_p(home, name), mode="overwrite")
    stored = {name: spark.read.parquet(_p(home, name)) for name in dims}

    # Entry 3: report over the new events, numbered in arrival order, exported in chunks.
    # The batch's arrival index (LOAD_ID) is also the export order: one numbering.
    indexed = row_index(new.drop("index") if "index" in new.columns else new, ["eventDate", "id"], out_col="index")
    dims_t = Dimensions(users=stored["users"], workspaces=stored["workspaces"], models=stored["models"],
                        integrations=stored["integrations"], act_codes=stored["act_codes"], actions=stored["actions"])
    numbered = EX.export_report(indexed, dims_t, batch_id=settings.batch_id, tenant_name=settings.tenant_name,
                                chunk_size=settings.chunk_size, strict=settings.strict,
                                index_col=None if settings.strict else "index")
    EX.write_chunks(numbered, _p(home, "exports", REPORT_EXPORT))
    for name, (file_name, acronym) in EXPORTS.items():
        table, key = stored[name], EXPORT_KEYS[name]
        if settings.is_sample(name):
            EX.write_sample(EX.sample(table, key, chunk_size=settings.chunk_size, acronym=acronym),
                            _p(home, "samples", file_name))
        else:
            EX.write_chunks(EX.number_for_export(table, key, settings.chunk_size, acronym, settings.strict),
                            _p(home, "exports", file_name))
    if not settings.publish:
        return summary | {"unpublished": home}
    write_log(spark, warehouse, settings, counted)
    save_state(spark, warehouse, settings.batch_id, done, closed, version)   # last: commit point
    retire_versions(spark, warehouse, settings.keep_versions)
    if settings.compact_batches and CP.compact(spark, events_path, done.ingest_batch, settings.compact_batches) and not settings.strict:
        ST.compact_ids(spark, events_path)
    return summary | {"version": version}
