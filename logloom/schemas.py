"""Explicit schemas for every table the engine reads or writes.

Nothing is inferred at run time: JSON pages, CSV codes and landed tables are
all read with these ``StructType``s, so a page with a new field cannot change a
table's schema by accident (an event's unknown fields go to its map ``extra``).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
B = T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: names that must equal the source system's -----------------
# Base fields of an audit event, in source order.
EVENT_BASE_FIELDS = [
    ("id", S), ("eventTypeId", S), ("userId", S), ("tenantId", S), ("objectId", S),
    ("message", S), ("success", B), ("errorNumber", S), ("ipAddress", S),
    ("userAgent", S), ("sessionId", S), ("hostName", S), ("serviceVersion", S),
    ("eventDate", L), ("eventTimeZone", S), ("createdDate", L),
    ("createdTimeZone", S), ("checksum", S), ("objectTypeId", S),
    ("objectTenantId", S),
]
# Fields of the event's ``additionalAttributes`` object, in source order.
EVENT_ATTRIBUTE_FIELDS = [
    "workspaceId", "actionId", "name", "type", "auth_id", "modelAccessLevel",
    "modelId", "modelRoleName", "modelRoleId", "active", "actionName",
    "nux_visible", "roleId", "roleName", "objectTypeId", "objectTenantId",
    "objectId",
]
# Output columns of the audit report, in order.
REPORT_COLUMNS = [
    "LOAD_ID", "BATCH_ID", "AUDIT_ID", "EVENT_DATE", "EVENT_TIMEZONE",
    "CREATED_DATE", "CREATE_TIMEZONE", "EVENT_ID", "EVENT_MESSAGE",
    "ASSOCIATED_OBJECT_ID", "NOTES", "USER_ID", "USER_NAME", "DISPLAY_NAME",
    "TENANT_ID", "TENANT_NAME", "WORKSPACE_ID", "WORKSPACE_NAME", "MODEL_ID",
    "MODEL_NAME", "OBJECT_ID", "OBJECT_TYPE", "OBJECT_NAME", "MESSAGE",
    "SUCCESS", "ERROR_NUMBER", "IP_ADDRESS", "USER_AGENT", "SESSION_ID",
    "HOST_NAME", "SERVICE_VERSION", "OBJECT_TYPE_ID", "OBJECT_TENANT_ID",
    "ACTION_ID", "ACTION_NAME", "ADDITIONAL_ATTRIBUTES_NAME",
    "ADDITIONAL_ATTRIBUTES_TYPE", "ADDITIONAL_ATTRIBUTES_AUTH_ID",
    "MODEL_ROLE_NAME", "MODEL_ROLE_ID", "ADDITIONAL_ATTRIBUTES_OBJECT_TYPE_ID",
    "ADDITIONAL_ATTRIBUTES_ROLE_ID", "ADDITIONAL_ATTRIBUTES_ROLE_NAME",
    "ADDITIONAL_ATTRIBUTES_OBJECT_TENANT_ID", "ADDITIONAL_ATTRIBUTES_OBJECT_ID",
    "ADDITIONAL_ATTRIBUTES_ACTIVE", "CHECKSUM",
]
# Header of the activity-code reference file.
ACT_CODE_COLUMNS = ["Event Code", "Event Message", "Associated Object ID", "Notes"]
# Literal texts the report emits.
OBJECT_TYPE_MODEL = "Model"
OBJECT_TYPE_INTEGRATION = "CloudWorks Integration"
OBJECT_TYPE_USER = "User"
ACTION_UNSAVED_ID = "-1"
ACTION_UNSAVED = "Unsaved Action"
ACTION_DELETED = "<Object has been Deleted>"
MISSING_ITEM_MESSAGE = "Item not located in EVENT_ID list"
HISTORY_OBJECT_NAME = "MODEL_HISTORY_EXPORT"
ASSET_KINDS = ["imports", "exports", "actions", "processes", "files"]
# Operating constants.
AUDIT_BATCH_SIZE = 10000
EXPORT_CHUNK_SIZE = 15000
SAMPLE_ROWS = 2000
# --- end of fixed values -------------------------------------------------------

ATTRIBUTES = _struct(*[(n, S) for n in EVENT_ATTRIBUTE_FIELDS])

# One audit event as it arrives in a page (nested) ...
EVENT = T.StructType(
    [T.StructField(n, t, True) for n, t in EVENT_BASE_FIELDS]
    + [T.StructField("additionalAttributes", ATTRIBUTES, True)]
)
# ... and as it is stored: plus the 0-based arrival index of its batch.
EVENT_ROW = T.StructType(EVENT.fields + [T.StructField("index", L, True)])

# The 37-column flat template (20 base + 17 dotted attribute columns).
TEMPLATE_COLUMNS = [n for n, _ in EVENT_BASE_FIELDS] + [
    f"additionalAttributes.{n}" for n in EVENT_ATTRIBUTE_FIELDS
]
TEMPLATE = T.StructType(
    [T.StructField(n, t, True) for n, t in EVENT_BASE_FIELDS]
    + [T.StructField(f"additionalAttributes.{n}", S, True) for n in EVENT_ATTRIBUTE_FIELDS]
)

EVENT_PAGE = _struct(
    ("response", T.ArrayType(EVENT)),
    ("meta", _struct(("paging", _struct(("totalSize", L), ("nextUrl", S), ("currentPageSize", L), ("offset", L))))),
)

USER = _struct(("id", S), ("userName", S), ("displayName", S))

WORKSPACE = _struct(("id", S), ("name", S), ("active", B), ("sizeAllowance", L), ("currentSize", L))
MODEL = _struct(
    ("id", S), ("name", S), ("activeState", S), ("lastSavedSerialNumber", L),
    ("lastModifiedByUserGuid", S), ("memoryUsage", L), ("currentWorkspaceId", S),
    ("currentWorkspaceName", S), ("modelUrl", S), ("categoryValues", T.ArrayType(S)),
    ("isoCreationDate", S), ("lastModified", S),
)
NAMED_ASSET = _struct(("id", S), ("name", S))
LATEST_RUN = _struct(
    ("triggeredBy", S), ("startDate", S), ("endDate", S), ("success", B),
    ("message", S), ("executionErrorCode", S),
)
SCHEDULE = _struct(
    ("name", S), ("type", S), ("toTime", S), ("timezone", S), ("fromTime", S),
    ("startDate", S), ("repeatEvery", S), ("status", S), ("daysOfWeek", T.ArrayType(S)),
)
INTEGRATION = _struct(
    ("integrationId", S), ("name", S), ("integrationType", S), ("createdBy", S),
    ("creationDate", S), ("modificationDate", S), ("modifiedBy", S), ("modelId", S),
    ("workspaceId", S), ("nuxVisible", B), ("notificationId", S),
    ("latestRun", LATEST_RUN), ("processId", S), ("schedule", SCHEDULE),
)

PAGING = _struct(("currentPageSize", L), ("offset", L), ("totalSize", L))


def metadata_page(record_path: str, record: T.StructType) -> T.StructType:
    """Envelope of every non-user metadata page: records + ``meta.paging``."""
    return _struct((record_path, T.ArrayType(record)), ("meta", _struct(("paging", PAGING))))


ACT_CODES = _struct(*[(n, S) for n in ACT_CODE_COLUMNS])

TASK_DETAIL = _struct(("localMessageText", S), ("values", T.ArrayType(S)))
TASK_RESULT = _struct(
    ("objectId", S), ("failureDumpAvailable", B), ("details", T.ArrayType(TASK_DETAIL)),
)
TASK_PAGE = _struct(
    ("taskId", S), ("workspaceId", S), ("modelId", S),
    ("task", _struct(("taskState", S), ("result", _struct(("nestedResults", T.ArrayType(TASK_RESULT)))))),
)

NAMED_ITEM = _struct(("id", S), ("name", S), ("moduleId", S))
NAMED_ITEMS_PAGE = _struct(("docId", S), ("items", T.ArrayType(NAMED_ITEM)))
