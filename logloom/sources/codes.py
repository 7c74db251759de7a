"""Activity-code reference file (S03, D-13).

A header CSV whose rows may be ragged: a row with fewer fields leaves the
trailing columns null (left-fill), and ``N/A`` reads as null.  Read with an
explicit schema in PERMISSIVE mode, so no row is dropped and no type is
guessed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from logloom import schemas

NULL_TEXT = "N/A"


def read_activity_codes(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(schemas.ACT_CODES)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("nullValue", NULL_TEXT)
            .csv(path))


def land_csv_lines(lines: DataFrame, out_dir: str, header: str) -> None:
    """Write pre-formatted CSV lines (column ``value``), each file headed by
    ``header`` -- the shape a hand-kept reference file has.  Ragged lines are
    written as they are, which the CSV writer itself cannot do."""

    def with_header(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [header]})
        yield from batches

    lines.select("value").mapInPandas(with_header, "value string").write.mode("overwrite").text(out_dir)
