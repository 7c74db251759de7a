"""Conformed dimensions: shaping, key uniqueness, scope filters, crawl worklist."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom import schemas
from logloom.operators.joins import bounded_broadcast


def unique_on(df: DataFrame, keys: list[str], prefer: list[str] | None = None,
              keep_null_keys: bool = True) -> DataFrame:
    """One row per key.

    An aggregate, not a window: partial aggregation runs map-side, so a key
    repeated a billion times collapses before the shuffle.  The kept row is
    the greatest by ``prefer`` then the remaining columns, so the choice is
    deterministic.  Rows with a null key are kept as they are unless
    ``keep_null_keys`` is off (join dimensions: a null key never matches).
    """
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = (prefer or []) + [c for c in rest if c not in (prefer or [])]

    def q(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"

    # Built as SQL text: one expression instead of a JVM call per column.
    packed = F.expr("max(struct(" + ", ".join(f"{q(c)} AS {q(c)}" for c in order) + "))").alias("__row")
    non_null = " AND ".join(f"{q(k)} IS NOT NULL" for k in keys)
    out_cols = [q(c) if c in keys else f"__row.{q(c)} AS {q(c)}" for c in cols]
    keyed = df.where(non_null).groupBy(*[q(k) for k in keys]).agg(packed).selectExpr(*out_cols)
    if not keep_null_keys:
        return keyed
    return keyed.unionByName(df.where(f"NOT ({non_null})"))


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """``drop`` that tolerates an absent column (D-12: never fails the table)."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def dim_users(users: DataFrame, unique: bool = True) -> DataFrame:
    """Users list: ``id, userName, displayName`` (P04), one row per id (D-4)."""
    out = users.select("id", "userName", "displayName")
    return unique_on(out, ["id"]) if unique else out


def dim_models(models: DataFrame, unique: bool = True) -> DataFrame:
    """Models list without the ``categoryValues`` list."""
    out = drop_if_present(models, "categoryValues")
    return unique_on(out, ["id"]) if unique else out


def dim_integrations(integrations: DataFrame, unique: bool = True) -> DataFrame:
    """Integrations flattened to dotted columns (``latestRun.*``, ``schedule.*``, P02)
    without the ``schedule.daysOfWeek`` list (P05), one row per integration."""
    from logloom.operators.flatten import flatten_struct

    out = drop_if_present(flatten_struct(integrations), "schedule.daysOfWeek")
    return unique_on(out, ["integrationId"]) if unique else out


def dim_assets(assets: DataFrame, unique: bool = True) -> DataFrame:
    """Actions or files list: ``id, name, workspace_id, model_id``.

    ``assets`` carries the (workspace, model) of the page each record came
    from; the asset kind is dropped from the compatible view, as the source
    appends imports, exports, actions and processes into one table.
    """
    out = assets.select("id", "name", "workspace_id", "model_id")
    return unique_on(out, ["id", "model_id"]) if unique else out


def active_models(models: DataFrame) -> DataFrame:
    """Models whose state is not ``ARCHIVED``; a null state is kept (F03, D-10)."""
    return models.where(~F.col("activeState").eqNullSafe("ARCHIVED"))


def model_catalog(models: DataFrame) -> DataFrame:
    """Workspace/model id and name pairs of every stored model."""
    return models.select(
        F.col("currentWorkspaceId").alias("ws_id"),
        F.col("currentWorkspaceName").alias("ws_name"),
        F.col("id").alias("model_id"),
        F.col("name").alias("model_name"),
    )


def _pairs(combos: DataFrame) -> DataFrame:
    pairs = combos.select(
        F.col("WorkspaceId").alias("__ws"), F.col("ModelId").alias("__model")
    ).dropDuplicates()
    return bounded_broadcast(pairs)


def scope_skip(models: DataFrame, combos: DataFrame,
               ws_col: str = "currentWorkspaceId", model_col: str = "id") -> DataFrame:
    """Drop the (workspace, model) pairs listed in ``combos`` (F04): anti join."""
    pairs = _pairs(combos)
    cond = (F.col(ws_col) == F.col("__ws")) & (F.col(model_col) == F.col("__model"))
    return models.join(pairs, cond, "left_anti")


def scope_select(models: DataFrame, combos: DataFrame, target_model: str,
                 ws_col: str = "currentWorkspaceId", model_col: str = "id") -> DataFrame:
    """Keep listed pairs, plus the target model in any workspace.

    A left join against the de-duplicated pair list marks listed rows; no row
    is repeated and no ``NOT IN`` (null-aware nested loop) is planned.
    """
    pairs = _pairs(combos).withColumn("__listed", F.lit(True))
    cond = (F.col(ws_col) == F.col("__ws")) & (F.col(model_col) == F.col("__model"))
    marked = models.join(pairs, cond, "left")
    keep = F.col("__listed").isNotNull() | (F.col(model_col) == F.lit(target_model))
    return marked.where(keep).drop("__ws", "__model", "__listed")


def apply_scope(models: DataFrame, approach: str, combos: DataFrame | None,
                target_model: str | None = None) -> DataFrame:
    """Scope by the configured approach; any other value keeps all.

    An empty or missing list: "skip" skips nothing, "select" keeps the target model alone.
    """
    if combos is None:
        combos = models.sparkSession.createDataFrame([], "WorkspaceId string, ModelId string")
    if approach == "skip":
        return scope_skip(models, combos)
    if approach == "select":
        return scope_select(models, combos, target_model or "")
    return models


def crawl_worklist(models: DataFrame, received: DataFrame,
                   kinds: Iterable[str] = tuple(schemas.ASSET_KINDS)) -> DataFrame:
    """Every in-scope (workspace, model) x asset kind, with what was received.

    The source walks this as nested loops; here each model row is expanded by
    a generator over the fixed kind list (no join), then left-joined to the
    per-page counts of landed asset records.
    """
    expected = models.select(
        F.col("currentWorkspaceId").alias("workspace_id"),
        F.col("id").alias("model_id"),
        F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"),
    )
    got = received.groupBy("workspace_id", "model_id", "kind").agg(
        F.count(F.lit(1)).alias("n_received")
    )
    out = expected.join(got, ["workspace_id", "model_id", "kind"], "left")
    return out.select(
        "workspace_id", "model_id", "kind",
        F.coalesce(F.col("n_received"), F.lit(0).cast("bigint")).alias("n_received"),
    )
