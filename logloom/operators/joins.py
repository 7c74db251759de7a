"""Join helpers: size-checked broadcast of dimension tables.

A dimension is broadcast only after its rows AND its bytes are checked against
a bound; reading stops one row past it.  Above the bound the join is a shuffle
join, where null keys are salted.  Keys that hold many rows (a hot ``userId``) are
found by a sketch first and probed in a broadcast of their own few dimension rows;
their rows take part in the shuffle under salted keys, spread over all tasks.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hot keys of a join that are told at most, and the share of all rows from which a key is hot.
HOT_KEYS, HOT_SHARE = 64, 0.001
#: Counters of the sketch; a key with more than a few ten-thousandths of the rows can't escape it.
HOT_COUNTERS = 10_000
# Per dimension; eight of them at once stay under half a gigabyte an executor.
DEFAULT_BROADCAST_MAX_ROWS = 500_000
DEFAULT_BROADCAST_MAX_BYTES = 48 * 1024 * 1024


def _sizes(frames: list[DataFrame], max_rows: int) -> list[tuple[int, int]]:
    """(rows, bytes of their values) of each frame, reading at most one row past the bound; one job for all."""
    union = None
    for i, df in enumerate(frames):
        width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
        probe = df.select(F.lit(i).alias("at"), width.cast("bigint").alias("width")).limit(max_rows + 1)
        union = probe if union is None else union.unionAll(probe)
    found = {r["at"]: (r["n"], r["b"]) for r in union.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.sum("width").alias("b")).collect()}
    return [found.get(i, (0, 0)) for i in range(len(frames))]


def bounded_broadcast_all(dims: list[tuple[DataFrame, DataFrame | None]], max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                          max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> list[tuple[DataFrame, bool]]:
    """Each dimension, with ``broadcast`` if it is within both bounds, and whether it is.

    An entry is ``(dim, bound_source)``: ``bound_source`` is a cheaper frame
    whose size bounds that of ``dim`` (the raw list before de-duplication).
    ``max_rows=None`` broadcasts nothing.
    """
    if max_rows is None or not dims:
        return [(d, False) for d, _ in dims]
    sizes = _sizes([src if src is not None else d for d, src in dims], max_rows)
    small = [rows <= max_rows and width <= max_bytes for rows, width in sizes]
    return [(F.broadcast(d) if ok else d, ok) for (d, _), ok in zip(dims, small)]


def bounded_broadcast(dim: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                      bound_source: DataFrame | None = None) -> DataFrame:
    """``bounded_broadcast_all`` of one dimension."""
    return bounded_broadcast_all([(dim, bound_source)], max_rows)[0][0]


def null_salted(key: Column, salt: Column) -> Column:
    """Join key for a shuffle join in which null keys spread out.

    A null key never matches in a left join, but hashes every such row to
    the same reducer.  Replacing it by a unique value that no dimension key
    can equal (a NUL character + the row's unique id) spreads those rows
    evenly over all tasks and leaves the result unchanged.
    """
    return F.when(key.isNull(), F.concat(F.lit("\u0000"), salt.cast("string"))).otherwise(key)


def hot_keys(fact: DataFrame, keys: list[tuple[str, ...]]) -> dict[tuple[str, ...], list[tuple]]:
    """Per key (one or more string columns) its values that hold ``HOT_SHARE`` of the rows or more.

    One job: a frequent-items sketch for each key, merged from partial sketches, reads
    the key columns alone.
    """
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, cols in enumerate(keys):
        names = ", ".join(f"`{c}`" for c in cols)
        known = " AND ".join(f"`{c}` IS NOT NULL" for c in cols)
        item = f"`{cols[0]}`" if len(cols) == 1 else f"to_json(array({names}))"
        counts.append(F.expr(f"approx_top_k({item}, {HOT_KEYS}, {HOT_COUNTERS}) FILTER (WHERE {known})").alias(f"k{i}"))
    found = fact.agg(*counts).first()
    out = {}
    for i, cols in enumerate(keys):
        items = [r["item"] for r in found[f"k{i}"] or [] if r["count"] >= HOT_SHARE * found["rows"]]
        out[cols] = [(x,) if len(cols) == 1 else tuple(json.loads(x)) for x in items]
    return out


def _is_one_of(cols: list[str], values: list[tuple]) -> Column:
    if len(cols) == 1:
        return F.col(cols[0]).isin([v[0] for v in values])
    return reduce(Column.__or__, [reduce(Column.__and__, [F.col(c) == F.lit(x) for c, x in zip(cols, v)]) for v in values])


def left_join(fact: DataFrame, dim: DataFrame, pairs: list[tuple[str, str]], broadcast: bool,
              salt_col: str | None = None, hot: list[tuple] | None = None) -> DataFrame:
    """Left equi-join on ``(fact_col, dim_col)`` pairs.

    A broadcast dimension is probed as is.  For a shuffle join, null fact
    keys are salted (``null_salted``) so a null-heavy key cannot pile up in
    one task.  ``hot``: values of the key, few, that hold many rows each, where
    ``dim`` has each key once.  Their dimension rows are broadcast, one a value at
    most; in the shuffle their rows have salted keys, which match nothing, so what
    the broadcast gave them stands.
    """
    if broadcast or salt_col is None or not hot:
        cond = reduce(Column.__and__, [(F.col(fc) if broadcast or salt_col is None else null_salted(F.col(fc), F.col(salt_col))) == F.col(dc)
                                       for fc, dc in pairs])
        return fact.join(dim, cond, "left")
    few = dim.filter(_is_one_of([dc for _, dc in pairs], hot))
    few = F.broadcast(few.select(*[F.col(c).alias(f"__hot_{c}") for c in dim.columns]))
    probed = fact.join(few, reduce(Column.__and__, [F.col(fc) == F.col(f"__hot_{dc}") for fc, dc in pairs]), "left")
    salt = F.concat(F.lit("\u0000"), F.col(salt_col).cast("string"))
    fact_cols = [fc for fc, _ in pairs]
    spread = [F.when(F.col(fc).isNull(), salt).when(_is_one_of(fact_cols, hot), salt).otherwise(F.col(fc)) for fc in fact_cols]
    joined = probed.join(dim, reduce(Column.__and__, [k == F.col(dc) for k, (_, dc) in zip(spread, pairs)]), "left")
    return joined.select(*[F.col(f"`{c}`") for c in fact.columns], *[F.coalesce(f"__hot_{c}", c).alias(c) for c in dim.columns])


def prefixed(df: DataFrame, prefix: str, cols: list[str] | None = None) -> DataFrame:
    """Select ``cols`` renamed with a prefix, so several dimensions can be joined."""
    cols = cols or df.columns
    return df.selectExpr(*[f"`{c}` AS `{prefix}{c}`" for c in cols])
