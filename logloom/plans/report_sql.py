"""The audit report asked for in SQL text with named parameters.

The text is fixed; run stamp, tenant name and watermark are bound as parameters
(``spark.sql(text, args=...)``), so no value is ever parsed as SQL.  What it
selects from is the report's own frame (``plans.report``), handed over as a
DataFrame: no session-wide view is made or replaced, and the plan is the
report's, with the watermark pushed below its joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from logloom import schemas
from logloom.plans.report import Dimensions, audit_report

REPORT_TEXT = """
SELECT * EXCEPT (BATCH_ID, TENANT_NAME, __event_ms),
       CAST(:batch_id AS BIGINT) AS BATCH_ID, :tenant_name AS TENANT_NAME
FROM {report}
WHERE __event_ms > :last_run
"""


def audit_report_sql(events: DataFrame, dims: Dimensions, *, batch_id: int, tenant_name: str, last_run: int = 0) -> DataFrame:
    """The report over events after ``last_run``, its run values bound by Spark."""
    frame = audit_report(events, dims, batch_id=0, tenant_name="", order_key=True)
    bound = {"batch_id": int(batch_id), "tenant_name": tenant_name, "last_run": int(last_run)}
    return events.sparkSession.sql(REPORT_TEXT, args=bound, report=frame).select(*schemas.REPORT_COLUMNS)
