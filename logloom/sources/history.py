"""Model-history exports: tab-separated chunk files (S04, P07, D-11).

The export arrives as numbered chunks; only chunk 0 carries the header.  The
header line is read once (it is metadata), its names are made SQL-friendly
(P07), and then every chunk is read in ONE scan with that explicit schema:
chunk 0 with ``header`` on, the others without, told apart by the
``chunk=<n>`` folder (partition pruning, no file is opened twice).
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.text import sanitize_column_names
from logloom.operators.identity import row_index


def land_history_chunks(rows: DataFrame, out_dir: str, chunk_rows: int, order_cols: list[str]) -> None:
    """Write ``rows`` (string columns) as TSV chunks ``chunk=<n>/``, header in chunk 0 only."""
    cols = rows.columns
    numbered = row_index(rows, order_cols, out_col="__rn")
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cols]), {"sep": "\t", "escape": '"'})
    data = numbered.select(F.call_function("div", F.col("__rn"), F.lit(chunk_rows)).alias("chunk"),
                           F.col("__rn").alias("__ord"), line.alias("value"))
    text = io.StringIO()
    csv.writer(text, delimiter="\t", lineterminator="").writerow(cols)
    header = rows.sparkSession.createDataFrame([(0, -1, text.getvalue())], "chunk long, __ord long, value string")
    (data.unionByName(header).repartition("chunk").sortWithinPartitions("chunk", "__ord")
     .select("chunk", "value").write.mode("overwrite").partitionBy("chunk").text(out_dir))


def read_history_header(spark: SparkSession, path: str, sep: str = "\t") -> list[str]:
    """Column names: the first record of chunk 0, by the same CSV rules as the data."""
    first = _csv(spark, sep).csv(f"{path.rstrip('/')}/chunk=0").first()
    return [c if c is not None else "" for c in first] if first else []


def _csv(spark: SparkSession, sep: str):
    """Quoted values may hold separators, doubled quotes and line breaks; chunk files are small, so each is read whole."""
    return spark.read.option("sep", sep).option("escape", '"').option("multiLine", True)


def read_history_chunks(spark: SparkSession, path: str, sep: str = "\t", sanitize: bool = True,
                        keep_chunk: bool = False) -> DataFrame:
    """S04 + P07: all chunks as one DataFrame with sanitized column names.

    Also reads the chunked CSV exports (``sep=','``, ``sanitize=False``).
    """
    names = read_history_header(spark, path, sep)
    names = sanitize_column_names(names) if sanitize else names
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names]
                          + [T.StructField("chunk", T.LongType())])
    # chunk 0's folder is listed alone; all folders are listed once, for the others
    first = _csv(spark, sep).schema(schema).option("header", True).option("basePath", path).csv(f"{path.rstrip('/')}/chunk=0")
    rest = _csv(spark, sep).schema(schema).option("header", False).csv(path).where(F.col("chunk") != 0)
    both = first.unionByName(rest)
    return both if keep_chunk else both.drop("chunk")
