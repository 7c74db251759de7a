"""logloom: audit-log analytics on Spark.

Incremental event ingest -> conformed dimensions -> enriched audit report ->
chunked export and run log.  Every step is a DataFrame, Spark SQL or
Structured Streaming job; no Python UDF sits on a hot path.
"""

from logloom.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
