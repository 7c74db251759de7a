"""Small inline fixtures: events and dimensions built from a few Python rows."""

from __future__ import annotations

from pyspark.sql import types as T

from logloom import schemas
from logloom.plans.report import Dimensions


def event(id, eventDate=1_700_000_000_000, index=0, **kw):
    attrs = {n: None for n in schemas.EVENT_ATTRIBUTE_FIELDS}
    for k in list(kw):
        if k.startswith("aa_"):
            attrs[k[3:]] = kw.pop(k)
    row = {n: None for n, _ in schemas.EVENT_BASE_FIELDS}
    row.update(id=str(id), eventDate=eventDate, createdDate=eventDate, eventTypeId="t", userId="U1",
               success=True)
    row.update(kw)
    row["additionalAttributes"] = attrs
    row["index"] = index
    return row


def events_df(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENT_ROW)


def df(spark, cols, rows):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    return spark.createDataFrame(rows, schema)


def dims(spark, users=(), workspaces=(), models=(), integrations=(), act_codes=(), actions=()):
    return Dimensions(
        users=df(spark, ["id", "userName", "displayName"], list(users)),
        workspaces=df(spark, ["id", "name"], list(workspaces)),
        models=df(spark, ["id", "name"], list(models)),
        integrations=df(spark, ["integrationId", "name", "modelId"], list(integrations)),
        act_codes=df(spark, schemas.ACT_CODE_COLUMNS, list(act_codes)),
        actions=df(spark, ["id", "name", "model_id"], list(actions)),
    )
