"""Row identity at scale: a dense 0-based index in key order.

``row_number() OVER (ORDER BY key)`` without a partition runs in ONE task.
Instead the key space is cut into ranges whose bounds are literals:

1. bounds: quantiles of a sample of the keys alone, taken by a hash of the key,
   so every run and every retried task sees the same ones;
2. counts: rows per range, from the key columns alone, give each range its
   first index; both lists are literals of the plan from there on;
3. index = first index of the row's range + its rank inside the range: one
   window over (range), hence one shuffle of the rows and no staged copy.

A row's range and rank follow from its key, so a lost executor recomputes the
same numbers.  Bounds are whole keys (all order columns), so a date that a third
of the events share is cut by the columns behind it.

The key must be a total order (add a unique tie-breaker such as the event id),
otherwise ties may be numbered either way.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: Rows a range holds, about; the fewest that are worth a range of their own.
RANGE_ROWS, LEAST_ROWS = 500_000, 1_000
#: The bounds and counts that pass through the driver, and sampled keys a bound.
MAX_RANGES, SAMPLE = 4_096, 32

_RANGE, _KEY = "__range", "__key"


def _col(name: str) -> Column:
    return F.col(name if name.startswith("`") else f"`{name}`")


def _key(order_cols: list[str]) -> Column:
    return F.struct(*[_col(c).alias(f"k{i}") for i, c in enumerate(order_cols)])


@dataclass
class Ranges:
    """Ranges of a key, in order: their bounds (a range begins at its bound) and their rows."""
    order_cols: list[str]
    types: list
    bounds: list[Row]
    counts: list[int]

    @property
    def starts(self) -> list[int]:
        return [0, *accumulate(self.counts)]

    def number(self) -> Column:
        """The row's range as one expression, for a filter: a binary search among the bounds."""
        return _search([self._literal(b) for b in self.bounds], _key(self.order_cols))

    def numbered(self, df: DataFrame) -> DataFrame:
        """``df`` with its rows' ranges.  Each step of the search is a column of its own, so all of it is compiled, at any number of ranges."""
        if not self.bounds:
            return df.withColumn(_RANGE, F.lit(0))
        every = F.array(*map(self._literal, self.bounds))
        out = df.withColumns({_KEY: _key(self.order_cols), _RANGE: F.lit(0)})
        for step in _steps(len(self.bounds)):
            out = out.withColumn(_RANGE, F.col(_RANGE) + F.when(F.get(every, F.col(_RANGE) + (step - 1)) <= F.col(_KEY), step).otherwise(0))
        return out.drop(_KEY)

    def start(self, number: Column) -> Column:
        return F.get(F.array(*[F.lit(s).cast("bigint") for s in self.starts]), number)

    def _literal(self, bound: Row) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(bound, self.types))])


def _steps(bounds: int) -> list[int]:
    return [1 << k for k in range(bounds.bit_length() - 1, -1, -1)]


def _search(bounds: list[Column], key: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``key``."""
    if not bounds:
        return F.lit(0)
    every = F.array(*bounds)
    return F.aggregate(F.array(*map(F.lit, _steps(len(bounds)))), F.lit(0),
                       lambda at, step: F.when(F.get(every, at + step - 1) <= key, at + step).otherwise(at))


def key_ranges(df: DataFrame, order_cols: list[str], num_ranges: int | None = None) -> Ranges:
    """Ranges of about equal numbers of rows, from the key columns alone."""
    keys = df.select(*map(_col, order_cols))
    types = [f.dataType for f in keys.schema.fields]
    rows = keys.count()
    if num_ranges is None:
        num_ranges = max(-(-rows // RANGE_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, rows // LEAST_ROWS), 1)
    num_ranges = min(num_ranges, MAX_RANGES)
    if num_ranges == 1 or not rows:
        return Ranges(order_cols, types, [], [rows])
    share = min(1.0, num_ranges * SAMPLE / rows)
    chosen = F.pmod(F.xxhash64(*map(_col, order_cols)), F.lit(1 << 20)) <= int(share * (1 << 20))
    sample = [r["k"] for r in keys.where(chosen).select(_key(order_cols).alias("k")).orderBy("k").collect()]   # num_ranges * SAMPLE, about
    bounds: list[Row] = []
    for n in range(1, num_ranges):
        if sample and (not bounds or sample[n * len(sample) // num_ranges] != bounds[-1]):
            bounds.append(sample[n * len(sample) // num_ranges])
    ranges = Ranges(order_cols, types, bounds, [])
    found = {r[_RANGE]: r["count"] for r in ranges.numbered(keys).groupBy(_RANGE).count().collect()}
    ranges.counts = [found.get(n, 0) for n in range(len(bounds) + 1)]
    return ranges


def _indexed(df: DataFrame, ranges: Ranges, out_col: str) -> DataFrame:
    inside = Window.partitionBy(_RANGE).orderBy(*map(_col, ranges.order_cols))
    rank = F.row_number().over(inside) - 1
    return ranges.numbered(df).select(*[F.col(f"`{c}`") for c in df.columns],
                                       (ranges.start(F.col(_RANGE)) + rank).alias(out_col))


def row_index(df: DataFrame, order_cols: list[str], out_col: str = "index",
              num_partitions: int | None = None) -> DataFrame:
    """Append ``out_col``: 0-based position of each row in ``order_cols`` order."""
    return _indexed(df, key_ranges(df, order_cols, num_partitions), out_col)


def row_page(df: DataFrame, order_cols: list[str], offset: int, limit: int, out_col: str = "index") -> DataFrame:
    """Rows ``offset`` to ``offset + limit - 1`` in ``order_cols`` order.

    The ranges' counts tell which of them hold the page; rows outside are
    dropped by their key before anything is shuffled.
    """
    ranges = key_ranges(df, order_cols)
    starts = ranges.starts
    holding = [n for n, rows in enumerate(ranges.counts) if rows and starts[n] < offset + limit and starts[n + 1] > offset]
    if not holding:
        return df.where(F.lit(False)).withColumn(out_col, F.lit(None).cast("bigint"))
    first, last, lead = holding[0], holding[-1], _col(order_cols[0])
    some = df
    # bounds of the leading column can be pushed to the scan
    if first > 0 and (low := ranges.bounds[first - 1][0]) is not None:
        some = some.where(lead >= F.lit(low).cast(ranges.types[0]))
    if last < len(ranges.bounds) and (high := ranges.bounds[last][0]) is not None:
        some = some.where(lead.isNull() | (lead <= F.lit(high).cast(ranges.types[0])))
    some = some.where(ranges.number().between(first, last))
    index = F.col(out_col)
    return _indexed(some, ranges, out_col).where((index >= offset) & (index < offset + limit))


def chunk_columns(df: DataFrame, index_col: str, chunk_size: int, counter_col: str | None = None,
                  strict: bool = False) -> DataFrame:
    """Chunk number and per-export counter from a dense index (R02, R03, D-6).

    ``chunk = index div size``.  The counter is ``index + 1`` (unique over the
    whole export); ``strict`` restarts it in every chunk as the source does.
    """
    idx = F.col(index_col)
    out = df.withColumn("chunk", F.call_function("div", idx, F.lit(chunk_size)))
    if counter_col:
        ct = (idx % chunk_size + 1) if strict else (idx + 1)
        out = out.withColumn(counter_col, ct.cast("bigint"))
    return out
