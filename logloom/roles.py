"""Role views: the driver's tables seen as the audit system's tables.

The source system's tables (events, users, workspaces, models, integrations,
actions, files, activity codes) are not part of the test data, so each role is
a projection of one driver table.  Every role keeps all rows of its base table;
misses in the joins come from how ids are spelled, never from dropping rows.
The same mapping is written in DuckDB SQL in ``logloom.oracle_sql``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom import schemas


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The tables are read-only, so the resolved DataFrame
    (schema and file listing, no data) is kept per session and path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _txt(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _when(cond: Column, value) -> Column:
    return F.when(cond, value)


def event_ms() -> Column:
    """Epoch milliseconds of the driver's ``ts`` (TIMESTAMP_NTZ, read as UTC)."""
    return F.unix_millis(F.col("ts").cast("timestamp"))


def ms_lower_bound(last_ms: int) -> Column:
    """``ts`` predicate equal to ``event_ms() > last_ms``, on the raw column.

    It reaches the Parquet scan as a pushed filter (row-group skipping); the
    derived ``eventDate > last_ms`` cannot.
    """
    micros = (int(last_ms) + 1) * 1000
    bound = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=micros)
    return F.col("ts") >= F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")


def r_events(spark: SparkSession, sf_dir: str, since_ms: int | None = None) -> DataFrame:
    """``events`` role: 20 base fields, ``additionalAttributes`` struct, ``index``."""
    ev = table(spark, sf_dir, "events")
    if since_ms is not None:
        ev = ev.where(ms_lower_bound(since_ms))
    k = F.get_json_object("props", "$.k").cast("int")
    ev = ev.select("event_id", "ts", "user_id", "event_type", "value", "props", k.alias("k"))
    k = F.col("k")
    uid = F.col("user_id")
    ms = event_ms()
    attrs = F.struct(
        _when(k % 10 != 0, F.concat(F.lit("W"), _txt(k % 6))).alias("workspaceId"),
        F.when(k % 8 == 0, F.lit("-1"))
        .when(k % 8 == 4, _txt(F.col("event_id") % 100))
        .when(k % 8 == 3, F.lit("5")).alias("actionId"),
        _when(k % 5 == 0, F.col("event_type")).alias("name"),
        _when(k % 5 == 1, F.lit("type")).alias("type"),
        F.lit(None).cast("string").alias("auth_id"),
        F.lit(None).cast("string").alias("modelAccessLevel"),
        _when(k % 4 == 0, F.concat(F.lit("M"), _txt(k % 30))).alias("modelId"),
        _when(k % 3 == 0, F.lit("Reader")).alias("modelRoleName"),
        _when(k % 3 == 0, F.lit("R1")).alias("modelRoleId"),
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("active"),
        F.lit(None).cast("string").alias("actionName"),
        F.lit(None).cast("string").alias("nux_visible"),
        _when(k % 7 == 0, F.lit("R2")).alias("roleId"),
        _when(k % 7 == 0, F.lit("Admin")).alias("roleName"),
        F.lit(None).cast("string").alias("objectTypeId"),
        F.lit("T0").alias("objectTenantId"),
        _txt(k).alias("objectId"),
    )
    object_id = (
        F.when(k % 4 == 0, F.concat(F.lit("M"), _txt(k % 30)))
        .when(k % 4 == 1, F.concat(F.lit("C"), _txt(k)))
        .when(k % 4 == 2, F.concat(F.lit("U"), _txt(uid)))
        .otherwise(F.concat(F.lit("X"), _txt(k)))
    )
    return ev.select(
        _txt("event_id").alias("id"),
        F.col("event_type").alias("eventTypeId"),
        F.concat(F.lit("U"), _txt(uid)).alias("userId"),
        F.lit("T0").alias("tenantId"),
        object_id.alias("objectId"),
        F.concat(F.col("event_type"), F.lit(" by "), _txt(uid)).alias("message"),
        (F.col("value") < 50).alias("success"),
        _when(F.col("event_type") == "error", _txt(k)).alias("errorNumber"),
        F.concat(F.lit("10.0."), _txt(k), F.lit("."), _txt(uid % 256)).alias("ipAddress"),
        F.concat(F.lit("agent/"), _txt(k % 3)).alias("userAgent"),
        F.concat(F.lit("S"), _txt(uid % 7)).alias("sessionId"),
        F.lit(None).cast("string").alias("hostName"),
        F.lit("v1").alias("serviceVersion"),
        ms.alias("eventDate"),
        F.lit("UTC").alias("eventTimeZone"),
        (ms + 1000).alias("createdDate"),
        F.lit("UTC").alias("createdTimeZone"),
        F.md5(F.col("props")).alias("checksum"),
        _txt(k % 4).alias("objectTypeId"),
        F.lit("T0").alias("objectTenantId"),
        attrs.alias("additionalAttributes"),
        F.col("event_id").alias("index"),
    )


def r_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``users`` role over ``customer``; keys ending in 9 are spelled ``V..`` (misses)."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.concat(F.when(key % 10 == 9, F.lit("V")).otherwise(F.lit("U")), _txt(key)).alias("id"),
        F.col("c_name").alias("userName"),
        F.col("c_mktsegment").alias("displayName"),
    )


def r_workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(
        F.concat(F.lit("W"), _txt("r_regionkey")).alias("id"),
        F.col("r_name").alias("name"),
        (F.col("r_regionkey") % 2 == 0).alias("active"),
        (F.length("r_name").cast("bigint") * 1000000).alias("sizeAllowance"),
        (F.length("r_name").cast("bigint") * 1000).alias("currentSize"),
    )


def r_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return n.select(
        F.concat(F.lit("M"), _txt(key)).alias("id"),
        F.col("n_name").alias("name"),
        F.when(key % 7 == 0, F.lit("ARCHIVED")).when(key % 7 == 1, F.lit(None).cast("string"))
        .otherwise(F.lit("UNLOCKED")).alias("activeState"),
        F.concat(F.lit("W"), _txt("n_regionkey")).alias("currentWorkspaceId"),
        F.concat(F.lit("Workspace #"), _txt("n_regionkey")).alias("currentWorkspaceName"),
        F.array(F.col("n_name")).alias("categoryValues"),
    )


def r_integrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("C"), _txt("s_suppkey")).alias("integrationId"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("M"), _txt("s_nationkey")).alias("modelId"),
        F.concat(F.lit("W"), _txt(F.col("s_suppkey") % 5)).alias("workspaceId"),
        F.struct(
            F.lit("sched").alias("name"),
            F.array(F.lit("MON"), F.lit("FRI")).alias("daysOfWeek"),
        ).alias("schedule"),
    )


def r_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``actions`` role over ``part``: (``id``, ``model_id``) is unique."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        _txt(F.expr("p_partkey div 25")).alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("W"), _txt(key % 25 % 5)).alias("workspace_id"),
        F.concat(F.lit("M"), _txt(key % 25)).alias("model_id"),
    )


def r_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``files`` role over ``part``: names repeat, so lookups need a first match."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("F"), _txt(key)).alias("id"),
        F.col("p_brand").alias("name"),
        F.concat(F.lit("W"), _txt(key % 25 % 5)).alias("workspace_id"),
        F.concat(F.lit("M"), _txt(key % 25)).alias("model_id"),
    )


# --- fixed values: activity codes of the test mapping (event_type -> texts) ----
ACT_CODE_ROWS = [
    ("click", "Clicked", "The object", "--"),
    ("view", "Viewed", None, "--"),
    ("purchase", "Purchased", "--", None),
    ("error", "Errored", "N", "seen"),
]
# --- end of fixed values -------------------------------------------------------


def r_act_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ACT_CODE_ROWS, schemas.ACT_CODES)


def r_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed asset records with the page's kind: actions by kind, then files."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    kinds = schemas.ASSET_KINDS
    kind = (F.when(key % 4 == 0, F.lit(kinds[0])).when(key % 4 == 1, F.lit(kinds[1]))
            .when(key % 4 == 2, F.lit(kinds[2])).otherwise(F.lit(kinds[3])))
    actions = p.select(
        _txt(F.expr("p_partkey div 25")).alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("W"), _txt(key % 25 % 5)).alias("workspace_id"),
        F.concat(F.lit("M"), _txt(key % 25)).alias("model_id"),
        kind.alias("kind"),
    )
    files = r_files(spark, sf_dir).withColumn("kind", F.lit(kinds[4]))
    return actions.unionByName(files)


def land_all(spark: SparkSession, sf_dir: str, landing: str, run: int = 1,
             events: DataFrame | None = None) -> None:
    """Land every entity of the role views as API-style pages (test input for
    the end-to-end refresh): the same layout a puller of the source writes."""
    from logloom.sources import codes as CO
    from logloom.sources import pages as PG

    ev = events if events is not None else r_events(spark, sf_dir).drop("index")
    PG.land_pages(ev, f"{landing}/events/run={run}", "response", schemas.AUDIT_BATCH_SIZE,
                  ["eventDate", "id"], envelope="events")
    PG.land_pages(r_users(spark, sf_dir), f"{landing}/users", "Resources", 500, ["id"], envelope="scim")
    PG.land_pages(r_workspaces(spark, sf_dir), f"{landing}/workspaces", "workspaces", 100, ["id"])
    PG.land_pages(r_models(spark, sf_dir), f"{landing}/models", "models", 100, ["id"])
    PG.land_pages(r_integrations(spark, sf_dir), f"{landing}/integrations", "integrations", 100,
                  ["integrationId"])
    assets = r_assets(spark, sf_dir)
    for kind in schemas.ASSET_KINDS:
        PG.land_pages(assets.where(F.col("kind") == kind), f"{landing}/assets", kind, 100, ["id", "name"],
                      group_cols=["workspace_id", "model_id", "kind"], mode="append")
    codes = r_act_codes(spark).select(F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("N/A"))
                                                         for c in schemas.ACT_CODE_COLUMNS]).alias("value"))
    CO.land_csv_lines(codes, f"{landing}/act_codes", ",".join(schemas.ACT_CODE_COLUMNS))
