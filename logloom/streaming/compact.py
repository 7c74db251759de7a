"""Compaction of the stored events (ST1): many small files of micro-batches become few large ones.

Each micro-batch leaves at least one file for each event day it holds, so a
table fed by small pulls is soon made of tiny files.  ``compact`` rewrites the
micro-batches that lie in ``event_day=*/ingest_batch=*`` since the last time into
one segment, ``<table>_segments/<low>-<high>/event_day=*``, in which
``ingest_batch`` is a column.  The last segments are taken along while they are no
larger than what is rewritten, so their number grows with the logarithm of the
batches, and an event is rewritten that often at most.

A segment counts once its ``_SUCCESS`` stands and no other covers it: that marker
publishes it.  ``read`` takes the live segments and, of the table's own folders,
the batches after them, so a compaction that dies leaves what was there before
whole, and is done anew.  What a segment has replaced is removed by the next
compaction only: readers that started before have until then.

Hot days are split and small ones put together by AQE (``REBALANCE``).  The
driver lists folder names and sizes; no rows pass through it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.sources import pages as PG
from logloom.sources import tables as TB

#: Micro-batches that make a compaction worth while.
MIN_BATCHES = 50


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _segments_dir(table_dir: str) -> str:
    return f"{table_dir}_segments"


def _finished(spark: SparkSession, table_dir: str) -> list[tuple[int, int]]:
    """(low, high) of each segment whose marker stands."""
    found = []
    for name in TB.folder_names(spark, _segments_dir(table_dir)):
        where, fs = _fs(spark, f"{_segments_dir(table_dir)}/{name}/_SUCCESS")
        if fs.exists(where):
            low, high = name.split("-")
            found.append((int(low), int(high)))
    return sorted(found)


def _live(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    covered = lambda s: any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in found)
    return [s for s in found if not covered(s)]


def segments(spark: SparkSession, table_dir: str) -> list[tuple[int, int]]:
    """First and last micro-batch of each segment that counts, in order."""
    return _live(_finished(spark, table_dir))


def _folder(table_dir: str, segment: tuple[int, int]) -> str:
    return f"{_segments_dir(table_dir)}/{segment[0]}-{segment[1]}"


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, or None where nothing has been written yet; other errors are errors."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if not PG.missing(err):
            raise
        return None


def _raw_batches(spark: SparkSession, table_dir: str) -> dict[int, list[str]]:
    """The folders of each micro-batch that lie in the table itself."""
    where, fs = _fs(spark, f"{table_dir}/event_day=*/ingest_batch=*")
    out: dict[int, list[str]] = {}
    for f in fs.globStatus(where) or []:
        out.setdefault(int(f.getPath().getName().split("=")[1]), []).append(f.getPath().toString())
    return out


def _size(spark: SparkSession, paths: list[str]) -> int:
    total = 0
    for path in paths:
        where, fs = _fs(spark, path)
        total += fs.getContentSummary(where).getLength()
    return total


def read(spark: SparkSession, table_dir: str, after: int = -1) -> DataFrame | None:
    """All stored events, or None where nothing has been written yet.

    ``after``: segments that end at or before this micro-batch may be left out, as the
    caller asks for later ones only.
    """
    live = segments(spark, table_dir)
    raw = read_if_there(spark, table_dir)
    frames = [spark.read.parquet(_folder(table_dir, s)) for s in live if s[1] > after]
    if raw is not None:
        frames.insert(0, raw.where(F.col("ingest_batch") > live[-1][1]) if live else raw)
    if not frames:      # all that there is lies before ``after``: no rows, but the columns
        frames = [spark.read.parquet(_folder(table_dir, live[-1])).limit(0)] if live else []
    if not live or not frames:
        return frames[0] if frames else None
    # A folder of null days, or of one batch, may be read with another type.
    typed = [f.withColumns({"event_day": F.col("event_day").cast("date"), "ingest_batch": F.col("ingest_batch").cast("bigint")}) for f in frames]
    out = typed[0]
    for f in typed[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def clean(spark: SparkSession, table_dir: str) -> None:
    """Remove what live segments have replaced, and segments that were never finished."""
    live = segments(spark, table_dir)
    names = {f"{low}-{high}" for low, high in live}
    for name in TB.folder_names(spark, _segments_dir(table_dir)):
        if name not in names:
            TB.delete_path(spark, f"{_segments_dir(table_dir)}/{name}")
    if live:
        for batch, folders in _raw_batches(spark, table_dir).items():
            if batch <= live[-1][1]:
                for folder in folders:
                    TB.delete_path(spark, folder)


def compact(spark: SparkSession, table_dir: str, upto: int | None = None, min_batches: int = MIN_BATCHES) -> tuple[int, int] | None:
    """Rewrite the micro-batches up to ``upto`` that no segment holds yet, if they are ``min_batches`` or more.

    ``upto`` has to be a batch that the stream has committed; None where it has ended well.  Gives the new segment.
    """
    live = segments(spark, table_dir)
    done = live[-1][1] if live else -1
    mine = {b: folders for b, folders in _raw_batches(spark, table_dir).items() if b > done and (upto is None or b <= upto)}
    if len(mine) < min_batches:
        return None
    clean(spark, table_dir)
    size = sum(_size(spark, folders) for folders in mine.values())
    low, along = min(mine), []
    while live and (more := _size(spark, [_folder(table_dir, live[-1])])) <= size:
        along.append(live.pop())
        low, size = along[-1][0], size + more
    segment = (low, max(mine))
    rows = read_if_there(spark, table_dir).where(F.col("ingest_batch").between(min(mine), max(mine)))
    for s in along:
        rows = rows.unionByName(spark.read.parquet(_folder(table_dir, s)).withColumn("event_day", F.col("event_day").cast("date")), allowMissingColumns=True)
    folder = _folder(table_dir, segment)
    rows = rows.withColumns({"event_day": F.col("event_day").cast("date"), "ingest_batch": F.col("ingest_batch").cast("bigint")})
    # by batch inside a file, so that a later read of new batches skips row groups
    rows = rows.hint("rebalance", "event_day").sortWithinPartitions("event_day", "ingest_batch")
    rows.write.mode("overwrite").partitionBy("event_day").parquet(folder)
    where, fs = _fs(spark, f"{folder}/_SUCCESS")
    if not fs.exists(where):            # the committer may be set not to write it
        fs.create(where, True).close()
    return segment
