"""Name <-> id resolution against the dimensions.

The source answers one request at a time with ``SELECT .. WHERE name = '..'``
and ``fetchone``.  Here a whole table of requests is resolved at once: the
candidate side is first reduced to one row per lookup key (the first match,
made stable as the smallest id), so the left join can never multiply a
request, and a miss becomes ``'-1'``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_FOUND = "-1"

# lookup kind -> (candidate key columns matched against the request's columns)
ID_KEYS = {
    "workspace": ["name"],
    "model": ["workspace_id", "name"],
    "action": ["workspace_id", "model_id", "name"],
    "file": ["workspace_id", "model_id", "name"],
}
NAME_KEYS = {
    "workspace": ["id"],
    "model": ["id"],
    "action": ["workspace_id", "model_id", "id"],
}


def _first_match(cands: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One candidate per key: the value of the row with the smallest ``order``."""
    return cands.groupBy(*keys).agg(F.min_by(value, order).alias("__found"))


def _resolve(requests: DataFrame, candidates: dict[str, DataFrame], keys_by_kind: dict[str, list[str]],
             value: str, order: str, out_col: str) -> DataFrame:
    parts = []
    for kind, keys in keys_by_kind.items():
        if kind not in candidates:
            continue
        req = requests.where(F.col("kind") == kind)
        found = _first_match(candidates[kind], keys, value, order)
        # Candidate keys are renamed so the join condition is explicit and the
        # request's own columns stay unambiguous.
        found = found.select(*[F.col(k).alias(f"__cand_{k}") for k in keys], "__found")
        cond = None
        for k in keys:
            c = F.col(k) == F.col(f"__cand_{k}")
            cond = c if cond is None else cond & c
        j = req.join(found, cond, "left")
        # No candidate row -> '-1'; a candidate whose value is null stays null
        # (the source returns the row's value as it is).
        matched = F.col(f"__cand_{keys[0]}").isNotNull()
        parts.append(j.select(*requests.columns,
                              F.when(matched, F.col("__found")).otherwise(F.lit(NOT_FOUND)).alias(out_col)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def resolve_ids(requests: DataFrame, workspaces: DataFrame, models: DataFrame,
                actions: DataFrame, files: DataFrame) -> DataFrame:
    """Resolve ``(kind, workspace_id, model_id, name)`` requests to ids.

    workspace by name; model by (workspace, name); action and file by
    (workspace, model, name).  First match = smallest id; not found = ``-1``.
    """
    cands = {
        "workspace": workspaces.select("id", "name"),
        "model": models.select("id", F.col("currentWorkspaceId").alias("workspace_id"), "name"),
        "action": actions.select("id", "workspace_id", "model_id", "name"),
        "file": files.select("id", "workspace_id", "model_id", "name"),
    }
    return _resolve(requests, cands, ID_KEYS, value="id", order="id", out_col="resolved_id")


def resolve_names(requests: DataFrame, workspaces: DataFrame, models: DataFrame,
                  actions: DataFrame) -> DataFrame:
    """Resolve ``(kind, workspace_id, model_id, id)`` requests to names."""
    cands = {
        "workspace": workspaces.select("id", "name"),
        "model": models.select("id", "name"),
        "action": actions.select("id", "workspace_id", "model_id", "name"),
    }
    return _resolve(requests, cands, NAME_KEYS, value="name", order="name", out_col="resolved_name")
