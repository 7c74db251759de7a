"""Scalar expressions of the report and the naming helpers (all native Spark).

Each helper returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(c, d: int) -> Column:
    """Integer division truncating toward zero (SQL ``div``; -1500 div 1000 = -1)."""
    return F.call_function("div", _c(c), F.lit(d))


def epoch_seconds(ms) -> Column:
    return int_div(ms, 1000)


def epoch_text(ms) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of an epoch-ms value (session zone UTC)."""
    return F.from_unixtime(epoch_seconds(ms), "yyyy-MM-dd HH:mm:ss")


def padded(n, width: int = 9) -> Column:
    """Zero-padded integer text; wider values are kept whole (never cut like lpad)."""
    return F.format_string(f"%0{width}d", _c(n))


def load_id(ms, index) -> Column:
    """LOAD_ID: epoch seconds as text followed by the 9-digit batch row index.

    Null parts format as zero, as the source's ``printf`` does.
    """
    secs = F.coalesce(epoch_seconds(ms), F.lit(0).cast("bigint")).cast("string")
    return F.concat(secs, padded(F.coalesce(_c(index), F.lit(0).cast("bigint"))))


def sanitize_column_name(name: str) -> str:
    """Column-name cleanup of history exports: space and ``/`` become ``_``,
    parentheses are removed.  Runs on schema names only (driver metadata)."""
    return name.replace(" ", "_").replace("/", "_").replace("(", "").replace(")", "")


def sanitize_column_names(names: list[str]) -> list[str]:
    return [sanitize_column_name(n) for n in names]


def history_table_name(workspace_name, model_name) -> Column:
    """``MH_<workspace>_<model>``, non-word runs to ``_`` (Unicode aware), lower case."""
    def part(c):
        return F.coalesce(_c(c).cast("string"), F.lit("None"))

    combined = F.concat(F.lit("MH_"), part(workspace_name), F.lit("_"), part(model_name))
    return F.lower(F.regexp_replace(combined, r"(?U)\W+", "_"))


# --- fixed values: id shapes of models and workspaces -----------------------------
MODEL_ID_PATTERN = r"^[A-Z0-9]{32}$"
WORKSPACE_ID_PATTERN = r"^[a-z0-9]{32}$"
# --- end of fixed values -----------------------------------------------------------


def _anchored(pattern: str) -> str:
    # (?d): only '\n' ends a line, so '$' may match before one final '\n' and
    # nothing else, the same as Python's re.match.
    return "(?d)" + pattern


def is_model_name(ref) -> Column:
    """True when a model reference is a name, i.e. not a 32-char upper id."""
    return ~_c(ref).rlike(_anchored(MODEL_ID_PATTERN))


def is_workspace_name(ref) -> Column:
    """True when a workspace reference is a name, i.e. not a 32-char lower id."""
    return ~_c(ref).rlike(_anchored(WORKSPACE_ID_PATTERN))


def eastern_time_stamp(ts) -> Column:
    """``dd-MM-yyyy HH:mm:ss EST|EDT`` of a UTC timestamp, as the run log shows it."""
    local = F.from_utc_timestamp(_c(ts), "US/Eastern")
    offset_h = (F.unix_seconds(local) - F.unix_seconds(_c(ts))) / 3600
    zone = F.when(offset_h == -4, F.lit("EDT")).otherwise(F.lit("EST"))
    return F.concat(F.date_format(local, "dd-MM-yyyy HH:mm:ss"), F.lit(" "), zone)
