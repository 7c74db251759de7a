"""Nested task results and named-item lookups.

Both read landed JSON documents and flatten their arrays with ``explode``;
nothing is looped over on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom import schemas
from logloom.operators.lookups import NOT_FOUND


def task_failures(tasks: DataFrame, actions: DataFrame) -> DataFrame:
    """One row per detail of every failed nested result, with its action name.

    * F08: only results with ``failureDumpAvailable`` true;
    * ``explode_outer`` keeps a failed result whose ``details`` is empty;
    * F09: the ``values`` list is exposed only for the missing-item message;
    * J13: the action name by (workspace, model, action id), ``-1`` if absent
      (the action list is reduced to one name per key first, so the join
      cannot multiply rows).
    """
    results = tasks.select(
        "taskId", "workspaceId", "modelId",
        F.explode("task.result.nestedResults").alias("r"),
    ).where(F.coalesce(F.col("r.failureDumpAvailable"), F.lit(False)))
    rows = results.select(
        "taskId", "workspaceId", "modelId",
        F.col("r.objectId").alias("objectId"),
        F.explode_outer("r.details").alias("d"),
    )
    names = actions.groupBy("workspace_id", "model_id", "id").agg(F.min("name").alias("__name"))
    j = rows.join(
        names,
        (F.col("workspaceId") == F.col("workspace_id")) & (F.col("modelId") == F.col("model_id"))
        & (F.col("objectId") == F.col("id")),
        "left",
    )
    message = F.col("d.localMessageText")
    missing = F.when(message == schemas.MISSING_ITEM_MESSAGE, F.concat_ws(",", F.col("d.values")))
    return j.select(
        "taskId", "workspaceId", "modelId", "objectId",
        F.when(F.col("id").isNotNull(), F.col("__name")).otherwise(F.lit(NOT_FOUND)).alias("action_name"),
        message.alias("message"),
        missing.alias("missing_values"),
    )


def lookup_named_items(docs: DataFrame, record_path: str, names: Iterable[str] | None = None,
                       doc_key: str = "docId") -> DataFrame:
    """Per document and name, the item that matches LAST in the array.

    ``posexplode`` keeps each item's position; ``max_by(.., pos)`` picks the
    last match.  Items of one document are bounded by that document.
    """
    items = docs.select(doc_key, F.posexplode(record_path).alias("pos", "it"))
    items = items.select(doc_key, "pos", "it.*")
    if names is not None:
        items = items.where(F.col("name").isin(list(names)))
    value_cols = [c for c in items.columns if c not in (doc_key, "pos", "name")]
    return items.groupBy(doc_key, "name").agg(*[F.max_by(c, "pos").alias(c) for c in value_cols])
