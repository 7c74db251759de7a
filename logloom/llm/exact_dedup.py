"""Exact dedup by skew-safe combining, in DataFrame operations alone.

Three stages, each of which groups by digest *and* whole text, so texts are
compared in full and no digest collision can merge two of them:

1. local: the map-side half of a ``groupBy`` on (digest, salt, text) leaves one
   row per text and task before anything is shuffled;
2. salted: its reduce side merges those rows per (digest, salt).  The salt
   comes from the id, so a text that a third of all rows share is spread over
   ``salts`` reducers;
3. global: the salts' winners (at most ``salts`` rows a text, fewer after their
   own map-side half) are combined per (digest, text).

The way back from a class to its rows is a join on the narrow (id, digest)
table.  A digest that turns out to stand for several texts is joined on the
text as well.

Defined results: null text counts as empty; null ids count as larger than any
other (a class of null ids only has a null ``keep_id``); of rows that repeat
one id and one text, exactly one is kept; an empty table gives no rows; columns
besides id and text are ignored by ``classes`` and returned by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from logloom.llm.common import SPACE, free_name, staged, table, text_or_empty

SALTS = 32


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.regexp_replace(text_or_empty(text_col), SPACE, " ").alias("norm"))
    return rows.withColumn("digest", digest(F.col("norm")))


def combine(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """(id, norm, digest) rows -> one row per text: digest, norm, keep_id, group_size."""
    merged = (keyed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
              .groupBy("digest", "salt", "norm")
              .agg(F.min("id").alias("winner"), F.count(F.lit(1)).alias("n")))
    return (merged.groupBy("digest", "norm")
            .agg(F.min("winner").alias("keep_id"), F.sum("n").alias("group_size")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
            digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: id, digest, keep_id, group_size, kept."""
    keyed = _keyed(docs, id_col, text_col, digest)
    found = staged(combine(keyed, salts).drop("norm"), "exact-classes")
    shared = found.groupBy("digest").count().filter("count > 1").select("digest")
    if shared.isEmpty():
        rows = keyed.select("id", "digest").join(found, "digest")
    else:
        shared = staged(shared, "exact-collisions")
        single = found.join(shared, "digest", "left_anti")
        several = keyed.join(shared, "digest", "left_semi")
        rows = keyed.select("id", "digest").join(single, "digest").unionByName(
            several.join(combine(several, salts), ["digest", "norm"]).drop("norm"))
    same = Window.partitionBy("digest", "keep_id", "id").orderBy(F.lit(0))
    return (rows.withColumn("copy", F.row_number().over(same))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with."""
    own, kept_id, kept_digest = (free_name(docs.columns, n) for n in ("own_digest", "kept_id", "kept_digest"))
    kept = staged(classes(docs, id_col, text_col).filter("kept").select(
        F.col("id").alias(kept_id), F.col("digest").alias(kept_digest)), "exact-kept")
    marked = docs.withColumn(own, sha256(F.regexp_replace(text_or_empty(text_col), SPACE, " ")))
    rows = marked.join(kept, marked[id_col].eqNullSafe(kept[kept_id]) & (marked[own] == kept[kept_digest]), "left_semi")
    repeated = docs.groupBy(id_col).count().filter("count > 1")
    if not repeated.isEmpty():
        rows = rows.dropDuplicates([id_col, own])
    return rows.drop(own)


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    rows = classes(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
     g AS (SELECT *, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
                  count(*) OVER (PARTITION BY norm) AS group_size,
                  row_number() OVER (PARTITION BY norm, doc_id) AS copy FROM t)
SELECT doc_id, keep_id, group_size,
       (doc_id IS NOT DISTINCT FROM keep_id AND copy = 1) AS kept,
       sha256(norm) AS text_sha256
FROM g
"""
