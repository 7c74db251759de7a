"""Mixing sources to target weights by capped water-filling.

1. Sources get their weights; a source's target is its share of all words.  A
   source whose target would pass ``max_epochs`` times its words is clamped
   there, and what is too much goes to the others in proportion to their
   weights, until none is above: each round is one aggregate over the table of
   sources, in exact integers.
2. A target of e times a source's words takes every document floor(e) times.
   For the rest, documents are picked in the order of a seeded hash of their id
   as long as their words fit, and the gap is filled by at most one document of
   each size class (the leading three binary digits), the larger first.  The
   picked ones are taken once more; where the rest is over half of the source,
   the picked ones are those that are not.

Rows are ordered in sampled ranges over (source, hash, words, row), so a source
with a third of all rows is spread like the rest; per-source figures come to its
rows by way of its ranges.  Only a count and two sums reach the driver.

Defined results: null text has no words; a null source is a source, the last
one; a null id is hashed as the empty string; rows that repeat an id, source
and words may be taken unlike, any of them; documents without words take none;
an empty table gives no rows; further columns are ignored (``repeated`` returns
them).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from logloom.llm.common import free_name, in_order, quoted, running_sum, staged, table, text_or_empty

WEIGHTS, MAX_EPOCHS, SEED = (5, 2, 1), 3, 13
SPACES = r"[\x20\x09-\x0D]"
OTHERS = r"[^\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """One letter a word, then count the letters: no array of words is built."""
    marked = F.regexp_replace(text, f"{SPACES}*+{OTHERS}++", "x")
    return F.length(F.regexp_replace(marked, f"{SPACES}++", "")).cast("long")


def seeded(doc_id: Column, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(id, source, size, hash, at), staged."""
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(source_col)).alias("source"),
                       word_count(text_or_empty(quoted(text_col))).alias("size"))
    return staged(rows.withColumn("hash", seeded(F.col("id"), seed)).withColumn("at", F.monotonically_increasing_id()), "mix-rows")


def weighed(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight), staged: sources by code point, null last, weigh ``weights`` repeating."""
    sizes = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    laid = in_order(sizes, [F.col("source").asc_nulls_last()], "mix-source-order")
    numbered = running_sum(laid, [], F.lit(1).cast("long"), "n")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("n") % len(weights) + 1).cast("int"))
    return staged(numbered.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` with ``target``, in words."""
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cap = F.col("source_size") * max_epochs
    rest, shares = sources.agg(F.sum(big("source_size")), F.sum("weight")).first()
    total, level = rest, None
    while shares:
        level = (rest, shares)
        # Clamped where cap <= weight * rest / shares, without a division.
        clamped = big("source_size") * F.lit(max_epochs * shares).cast("decimal(38,0)") <= big("weight") * F.lit(Decimal(rest)).cast("decimal(38,0)")
        capped, shares = sources.agg(F.sum(F.when(clamped, big("source_size")).otherwise(0)) * max_epochs,
                                     F.sum(F.when(~clamped, F.col("weight")).otherwise(0))).first()
        rest = total - capped
        if (rest, shares) == level:
            break
    if not shares:  # nothing is below its cap: all stand there
        return sources.withColumn("target", cap.cast("double"))
    open_target = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(shares))
    return sources.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(open_target))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per document: id, source, size, source_size, target, repetitions."""
    rows = narrow(docs, id_col, text_col, source_col, seed)
    sources = water_fill(weighed(rows, weights), max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    sources = staged(sources.withColumn("whole", epochs.cast("long")).withColumn("most", rest * 2 > F.col("source_size"))
                     .withColumn("picks", F.when(F.col("most"), F.col("source_size") - rest).otherwise(rest)), "mix-targets")
    laid = in_order(rows, [F.col("source").asc_nulls_last(), F.col("hash"), F.col("size"), F.col("at")], "mix-order")
    before = _beside(running_sum(laid, ["source"], F.col("size"), "before"), laid, sources)
    filled = staged(before.withColumn("picked", F.col("before") + F.col("size") <= F.col("picks")), "mix-filled")
    gaps = filled.groupBy("source").agg((F.max("picks") - F.sum(F.when(F.col("picked"), F.col("size")).otherwise(0))).alias("gap"))
    digits = F.bin("size")
    size_class = F.length(digits) * 8 + F.conv(F.rpad(F.substring(digits, 1, 3), 3, "0"), 2, 10).cast("int")
    filler = (filled.filter(~F.col("picked") & (F.col("size") > 0)).groupBy("source", size_class.alias("class"))
              .agg(F.min(F.struct("hash", "size", "at")).alias("one"))
              .groupBy("source").agg(F.sort_array(F.collect_list(F.struct("class", "one")), asc=False).alias("fillers")))  # at most 252 a source
    filler = filler.join(gaps.withColumnRenamed("source", "key"), F.col("source").eqNullSafe(F.col("key")))
    chosen = filler.select(F.explode(_fitting(F.col("fillers"), F.col("gap"))).alias("last"))
    once = (F.col("picked") | F.col("last").isNotNull()) != F.col("most")
    return (filled.join(chosen, F.col("at") == F.col("last"), "left")
            .select("id", "source", "size", "source_size", "target", (F.col("whole") + once.cast("long")).alias("repetitions")))


def _fitting(fillers: Column, gap: Column) -> Column:
    """The rows of those fillers that fit, one by one from the largest, into what the ones before leave of the gap."""
    none = F.struct(gap.cast("double").alias("gap"), F.array().cast("array<bigint>").alias("at"))

    def step(state: Column, filler: Column) -> Column:
        fits = filler["one"]["size"] <= state["gap"]
        return F.struct(F.when(fits, state["gap"] - filler["one"]["size"]).otherwise(state["gap"]).alias("gap"),
                        F.when(fits, F.array_append(state["at"], filler["one"]["at"])).otherwise(state["at"]).alias("at"))

    return F.aggregate(fillers, none, step)["at"]


def _beside(rows: DataFrame, laid: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``per_source``, spread by (source, part) so that a hot source is many keys."""
    facts = (laid.select(F.col("source").alias("key"), F.col("part").alias("in_part")).distinct()
             .join(per_source, F.col("key").eqNullSafe(F.col("source"))).drop("source"))
    return rows.join(facts, F.col("source").eqNullSafe(F.col("key")) & (F.col("part") == F.col("in_part"))).drop("key", "in_part")


def repeated(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: each document as often as ``mixed`` says, with its own columns and the number of the copy, last.

    Rows that share id, source and words are dealt their repetitions in any order.
    """
    size, nth, copy = (free_name(docs.columns, n) for n in ("mix_size", "mix_nth", "repetition"))
    rows = docs.withColumn(size, word_count(text_or_empty(quoted(text_col))))
    alike = Window.partitionBy(quoted(id_col), quoted(source_col), size).orderBy(F.lit(0))
    rows = rows.withColumn(nth, F.row_number().over(alike))
    alike = Window.partitionBy("id", "source", "size").orderBy("repetitions")
    times = mixed.select(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "repetitions",
                         F.row_number().over(alike).alias("_nth")).filter("repetitions > 0")
    same = (rows[quoted(id_col)].eqNullSafe(times["_id"]) & rows[quoted(source_col)].eqNullSafe(times["_source"])
            & (rows[size] == times["_size"]) & (rows[nth] == times["_nth"]))
    return rows.join(times, same).select(*[rows[quoted(c)] for c in docs.columns], F.explode(F.sequence(F.lit(1), times["repetitions"].cast("int"))).alias(copy))


def op13_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("repetitions")).alias("taken"))


ORACLE = rf"""
WITH RECURSIVE docs AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                                  ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash,
                                  row_number() OVER () AS nr FROM documents),
     s AS MATERIALIZED (SELECT source, sum(size)::BIGINT AS source_size,
                               [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w
                        FROM docs GROUP BY source),
     total AS (SELECT sum(source_size)::BIGINT AS n FROM s),
     -- A source is clamped where its cap is at most what the sources with a lower cap a weight leave for its weight.
     caps AS (SELECT *, {MAX_EPOCHS} * source_size AS cap, {MAX_EPOCHS} * source_size / w AS level FROM s),
     steps AS (SELECT *, coalesce(sum(cap) OVER below, 0)::BIGINT AS capped, (sum(w) OVER () - coalesce(sum(w) OVER below, 0))::BIGINT AS shares FROM caps
               WINDOW below AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     marked AS (SELECT *, cap::HUGEINT * shares <= w::HUGEINT * ((SELECT n FROM total) - capped) AS clamped FROM steps),
     lvl AS (SELECT (SELECT n FROM total) - coalesce(sum(cap) FILTER (WHERE clamped), 0) AS remaining, sum(w) FILTER (WHERE NOT clamped) AS shares FROM marked),
     t AS MATERIALIZED (SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE w::DOUBLE * remaining::DOUBLE / lvl.shares::DOUBLE END AS target FROM marked, lvl),
     f AS MATERIALIZED (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
     p AS MATERIALIZED (SELECT *, (target - whole * source_size) * 2 > source_size AS most,
                               CASE WHEN (target - whole * source_size) * 2 > source_size THEN source_size - (target - whole * source_size)
                                    ELSE target - whole * source_size END AS picks FROM f),
     g AS MATERIALIZED (SELECT d.*, p.source_size, p.target, p.whole, p.most, p.picks,
                               sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash, d.size, d.nr) AS upto
                        FROM docs d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
     gaps AS (SELECT source, max(picks) - coalesce(sum(size) FILTER (WHERE upto <= picks), 0) AS gap FROM g GROUP BY source),
     fillers AS (SELECT source, arg_min(size, (hash, size, nr)) AS size, arg_min(nr, (hash, size, nr)) AS nr
                 FROM g WHERE size > 0 AND upto > picks GROUP BY source, length(bin(size)), rpad(substr(bin(size), 1, 3), 3, '0')),
     turns AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC) AS turn FROM fillers),
     fill AS (SELECT source, gap::DOUBLE AS gap, 0 AS turn, NULL::BIGINT AS nr FROM gaps
              UNION ALL
              SELECT fill.source, CASE WHEN t.size <= gap THEN gap - t.size ELSE gap END, fill.turn + 1, CASE WHEN t.size <= gap THEN t.nr END
              FROM fill JOIN turns t ON t.source IS NOT DISTINCT FROM fill.source AND t.turn = fill.turn + 1)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN (upto <= picks OR nr IN (SELECT nr FROM fill WHERE nr IS NOT NULL)) <> most THEN 1 ELSE 0 END))::BIGINT AS taken
FROM g
"""
