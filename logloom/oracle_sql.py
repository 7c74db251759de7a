"""DuckDB SQL twins of the role views and of each registered query.

These texts are the independent oracle the driver runs on the same Parquet
tables.  They are written from the operator semantics, not generated from the
Spark plans, so a disagreement points at a real bug on one side.
"""

from __future__ import annotations

from logloom import schemas as S

ROLES: dict[str, str] = {}

ROLES["r_events"] = """
r_events AS (
  SELECT
    cast(event_id AS varchar) AS id,
    event_type AS eventTypeId,
    'U' || cast(user_id AS varchar) AS userId,
    'T0' AS tenantId,
    CASE WHEN k % 4 = 0 THEN 'M' || cast(k % 30 AS varchar)
         WHEN k % 4 = 1 THEN 'C' || cast(k AS varchar)
         WHEN k % 4 = 2 THEN 'U' || cast(user_id AS varchar)
         ELSE 'X' || cast(k AS varchar) END AS objectId,
    event_type || ' by ' || cast(user_id AS varchar) AS message,
    value < 50 AS success,
    CASE WHEN event_type = 'error' THEN cast(k AS varchar) END AS errorNumber,
    '10.0.' || cast(k AS varchar) || '.' || cast(user_id % 256 AS varchar) AS ipAddress,
    'agent/' || cast(k % 3 AS varchar) AS userAgent,
    'S' || cast(user_id % 7 AS varchar) AS sessionId,
    cast(NULL AS varchar) AS hostName,
    'v1' AS serviceVersion,
    ms AS eventDate,
    'UTC' AS eventTimeZone,
    ms + 1000 AS createdDate,
    'UTC' AS createdTimeZone,
    md5(props) AS checksum,
    cast(k % 4 AS varchar) AS objectTypeId,
    'T0' AS objectTenantId,
    CASE WHEN k % 10 <> 0 THEN 'W' || cast(k % 6 AS varchar) END AS aa_workspaceId,
    CASE WHEN k % 8 = 0 THEN '-1'
         WHEN k % 8 = 4 THEN cast(event_id % 100 AS varchar)
         WHEN k % 8 = 3 THEN '5' END AS aa_actionId,
    CASE WHEN k % 5 = 0 THEN event_type END AS aa_name,
    CASE WHEN k % 5 = 1 THEN 'type' END AS aa_type,
    cast(NULL AS varchar) AS aa_auth_id,
    cast(NULL AS varchar) AS aa_modelAccessLevel,
    CASE WHEN k % 4 = 0 THEN 'M' || cast(k % 30 AS varchar) END AS aa_modelId,
    CASE WHEN k % 3 = 0 THEN 'Reader' END AS aa_modelRoleName,
    CASE WHEN k % 3 = 0 THEN 'R1' END AS aa_modelRoleId,
    CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS aa_active,
    cast(NULL AS varchar) AS aa_actionName,
    cast(NULL AS varchar) AS aa_nux_visible,
    CASE WHEN k % 7 = 0 THEN 'R2' END AS aa_roleId,
    CASE WHEN k % 7 = 0 THEN 'Admin' END AS aa_roleName,
    cast(NULL AS varchar) AS aa_objectTypeId,
    'T0' AS aa_objectTenantId,
    cast(k AS varchar) AS aa_objectId,
    event_id AS idx
  FROM (SELECT *, cast(json_extract(props, '$.k') AS int) AS k,
               epoch_us(ts) // 1000 AS ms
        FROM events)
)"""

ROLES["r_users"] = """
r_users AS (
  SELECT CASE WHEN c_custkey % 10 = 9 THEN 'V' ELSE 'U' END || cast(c_custkey AS varchar) AS id,
         c_name AS userName, c_mktsegment AS displayName
  FROM customer
)"""

ROLES["r_workspaces"] = """
r_workspaces AS (
  SELECT 'W' || cast(r_regionkey AS varchar) AS id, r_name AS name,
         r_regionkey % 2 = 0 AS active,
         cast(length(r_name) AS bigint) * 1000000 AS sizeAllowance,
         cast(length(r_name) AS bigint) * 1000 AS currentSize
  FROM region
)"""

ROLES["r_models"] = """
r_models AS (
  SELECT 'M' || cast(n_nationkey AS varchar) AS id, n_name AS name,
         CASE WHEN n_nationkey % 7 = 0 THEN 'ARCHIVED'
              WHEN n_nationkey % 7 = 1 THEN NULL
              ELSE 'UNLOCKED' END AS activeState,
         'W' || cast(n_regionkey AS varchar) AS currentWorkspaceId,
         'Workspace #' || cast(n_regionkey AS varchar) AS currentWorkspaceName
  FROM nation
)"""

ROLES["r_integrations"] = """
r_integrations AS (
  SELECT 'C' || cast(s_suppkey AS varchar) AS integrationId, s_name AS name,
         'M' || cast(s_nationkey AS varchar) AS modelId,
         'W' || cast(s_suppkey % 5 AS varchar) AS workspaceId
  FROM supplier
)"""

ROLES["r_actions"] = """
r_actions AS (
  SELECT cast(p_partkey // 25 AS varchar) AS id, p_name AS name,
         'W' || cast(p_partkey % 25 % 5 AS varchar) AS workspace_id,
         'M' || cast(p_partkey % 25 AS varchar) AS model_id
  FROM part
)"""

ROLES["r_files"] = """
r_files AS (
  SELECT 'F' || cast(p_partkey AS varchar) AS id, p_brand AS name,
         'W' || cast(p_partkey % 25 % 5 AS varchar) AS workspace_id,
         'M' || cast(p_partkey % 25 AS varchar) AS model_id
  FROM part
)"""

ROLES["r_assets"] = """
r_assets AS (
  SELECT cast(p_partkey // 25 AS varchar) AS id, p_name AS name,
         'W' || cast(p_partkey % 25 % 5 AS varchar) AS workspace_id,
         'M' || cast(p_partkey % 25 AS varchar) AS model_id,
         CASE p_partkey % 4 WHEN 0 THEN 'imports' WHEN 1 THEN 'exports'
                            WHEN 2 THEN 'actions' ELSE 'processes' END AS kind
  FROM part
  UNION ALL
  SELECT 'F' || cast(p_partkey AS varchar), p_brand,
         'W' || cast(p_partkey % 25 % 5 AS varchar),
         'M' || cast(p_partkey % 25 AS varchar), 'files'
  FROM part
)"""

ROLES["r_act_codes"] = """
r_act_codes AS (
  SELECT * FROM (VALUES
    ('click', 'Clicked', 'The object', '--'),
    ('view', 'Viewed', NULL, '--'),
    ('purchase', 'Purchased', '--', NULL),
    ('error', 'Errored', 'N', 'seen')
  ) AS t(event_code, event_message, associated_object_id, notes)
)"""


def with_roles(body: str, *roles: str, extra: list[str] | None = None) -> str:
    ctes = [ROLES[r].strip() for r in roles] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()


# Everything an event's object can be, one row per id: the kind that ranks first
# names it; what an integration loads is kept whichever kind that is.
OBJECTS = f"""
objects AS (
  SELECT id, arg_min({{'kind': kind, 'name': name}}, rank) AS shown,
         max(CASE WHEN rank = 2 THEN model_id END) AS loads
  FROM (SELECT 1 AS rank, '{S.OBJECT_TYPE_MODEL}' AS kind, id, name, NULL AS model_id FROM r_models
        UNION ALL SELECT 2, '{S.OBJECT_TYPE_INTEGRATION}', integrationId, name, modelId FROM r_integrations
        UNION ALL SELECT 3, '{S.OBJECT_TYPE_USER}', id, userName, NULL FROM r_users)
  GROUP BY id
)"""

# --- fixed values: report columns that are an event's own fields ---
REPORT_FIELDS = {
    "AUDIT_ID": "id", "EVENT_TIMEZONE": "eventTimeZone", "CREATE_TIMEZONE": "createdTimeZone", "EVENT_ID": "eventTypeId",
    "USER_ID": "userId", "TENANT_ID": "tenantId", "WORKSPACE_ID": "aa_workspaceId", "OBJECT_ID": "objectId", "MESSAGE": "message",
    "ERROR_NUMBER": "errorNumber", "IP_ADDRESS": "ipAddress", "USER_AGENT": "userAgent", "SESSION_ID": "sessionId",
    "HOST_NAME": "hostName", "SERVICE_VERSION": "serviceVersion", "OBJECT_TYPE_ID": "objectTypeId",
    "OBJECT_TENANT_ID": "objectTenantId", "ACTION_ID": "aa_actionId", "ADDITIONAL_ATTRIBUTES_NAME": "aa_name",
    "ADDITIONAL_ATTRIBUTES_TYPE": "aa_type", "ADDITIONAL_ATTRIBUTES_AUTH_ID": "aa_auth_id", "MODEL_ROLE_NAME": "aa_modelRoleName",
    "MODEL_ROLE_ID": "aa_modelRoleId", "ADDITIONAL_ATTRIBUTES_OBJECT_TYPE_ID": "aa_objectTypeId",
    "ADDITIONAL_ATTRIBUTES_ROLE_ID": "aa_roleId", "ADDITIONAL_ATTRIBUTES_ROLE_NAME": "aa_roleName",
    "ADDITIONAL_ATTRIBUTES_OBJECT_TENANT_ID": "aa_objectTenantId", "ADDITIONAL_ATTRIBUTES_OBJECT_ID": "aa_objectId",
    "ADDITIONAL_ATTRIBUTES_ACTIVE": "aa_active", "CHECKSUM": "checksum",
}
# --- end of fixed values ---


def _looked_up(column: str, role: str, match: str) -> str:
    """A dimension's value by its key, as a scalar subquery (keys are unique in the roles)."""
    return f"(SELECT d.{column} FROM {role} d WHERE {match})"


def _seconds(column: str) -> str:
    return f"strftime(make_timestamp((e.{column} // 1000) * 1000000), '%Y-%m-%d %H:%M:%S')"


def _report_values(batch_id: int, tenant_name: str) -> dict[str, str]:
    code, model = "d.event_code = e.eventTypeId", "coalesce(e.aa_modelId, o.loads)"
    action = _looked_up("name", "r_actions", "d.id = e.aa_actionId AND d.model_id = e.objectId")
    return {name: f"e.{field}" for name, field in REPORT_FIELDS.items()} | {
        "LOAD_ID": "(coalesce(e.eventDate, 0) // 1000)::varchar || printf('%09d', coalesce(e.idx, 0))",
        "BATCH_ID": f"{int(batch_id)}::bigint",
        "TENANT_NAME": "'" + tenant_name.replace("'", "''") + "'",
        "EVENT_DATE": _seconds("eventDate"),
        "CREATED_DATE": _seconds("createdDate"),
        "EVENT_MESSAGE": _looked_up("event_message", "r_act_codes", code),
        "ASSOCIATED_OBJECT_ID": _looked_up("associated_object_id", "r_act_codes", code),
        "NOTES": _looked_up("notes", "r_act_codes", code),
        "USER_NAME": _looked_up("userName", "r_users", "d.id = e.userId"),
        "DISPLAY_NAME": _looked_up("displayName", "r_users", "d.id = e.userId"),
        "WORKSPACE_NAME": _looked_up("name", "r_workspaces", "d.id = e.aa_workspaceId"),
        "MODEL_ID": model,
        "MODEL_NAME": _looked_up("name", "r_models", f"d.id = {model}"),
        "OBJECT_TYPE": "o.shown.kind",
        "OBJECT_NAME": "o.shown.name",
        "SUCCESS": "e.success::integer",
        "ACTION_NAME": f"if(e.aa_actionId = '{S.ACTION_UNSAVED_ID}', '{S.ACTION_UNSAVED}', "
                       f"coalesce({action}, if(e.aa_actionId IS NOT NULL, '{S.ACTION_DELETED}', NULL)))",
    }


REPORT_ROLES = ("r_events", "r_users", "r_workspaces", "r_models", "r_integrations",
                "r_act_codes", "r_actions")


def report_body(batch_id: int, tenant_name: str, where: str = "", order_key: bool = False,
                events: str = "r_events") -> str:
    values = _report_values(batch_id, tenant_name)
    columns = [f"{values[c]} AS {c}" for c in S.REPORT_COLUMNS] + ["e.eventDate AS __event_ms"] * order_key
    return (f"WITH {OBJECTS.strip()}\nSELECT " + ",\n  ".join(columns)
            + f"\nFROM {events} e LEFT JOIN objects o ON o.id = e.objectId" + (f"\nWHERE {where}" if where else ""))


def report_sql(batch_id: int, tenant_name: str, where: str = "", order_key: bool = False) -> str:
    return with_roles("SELECT * FROM (" + report_body(batch_id, tenant_name, where, order_key) + ")", *REPORT_ROLES)


def report_cte(batch_id: int, tenant_name: str, where: str = "", order_key: bool = False,
               name: str = "rep") -> str:
    """The report as a CTE (``<name> AS (...)``) for queries built on top of it."""
    body = report_body(batch_id, tenant_name, where, order_key)
    return f"{name} AS ({body})"


# Flat 37-column template of an event, from the r_events role (dotted names).
_BASE = ["id", "eventTypeId", "userId", "tenantId", "objectId", "message", "success", "errorNumber",
         "ipAddress", "userAgent", "sessionId", "hostName", "serviceVersion", "eventDate",
         "eventTimeZone", "createdDate", "createdTimeZone", "checksum", "objectTypeId", "objectTenantId"]
_ATTRS = ["workspaceId", "actionId", "name", "type", "auth_id", "modelAccessLevel", "modelId",
          "modelRoleName", "modelRoleId", "active", "actionName", "nux_visible", "roleId", "roleName",
          "objectTypeId", "objectTenantId", "objectId"]
TEMPLATE_SELECT = ", ".join([f"e.{c}" for c in _BASE]
                            + [f'e.aa_{a} AS "additionalAttributes.{a}"' for a in _ATTRS])
