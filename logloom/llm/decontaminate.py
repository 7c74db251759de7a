"""Benchmark decontamination by q-gram lemma filtering.

Texts and items are lower-cased and every run of other characters than letters
and digits becomes one space.  An item of m characters may differ from a
passage in e edits, e being ``rate`` x m, but never so many that the lemma says
nothing (m - q + 1 - q e >= 1).

1. Each document's q-gram hashes are looked up in the items' q-grams.
2. A common q-gram at text position i and item position j lies on diagonal
   i - j.  An alignment with e edits stays within e + 1 neighbouring diagonals,
   so it lies whole in one of the overlapping bands of 2 (e + 1) diagonals, and
   shares at least m - q + 1 - q e q-grams with the item there.  Bands with
   fewer are dropped.
3. Bands that remain are verified by edit distance within the band, the passage
   beginning and ending anywhere in it.

The items are scanned against all documents in blocks of ``block_chars``
characters, each broadcast (a few times its characters in bytes); documents are
neither joined nor shuffled.  Null and empty items are left out and equal rows
are one with a count before blocks are dealt by hash, so a block has few rows
more than its share of the characters.

Defined results: null and empty texts match nothing; null or empty items match
nothing; an item of fewer than q characters matches a document that is that
item and nothing else; repeated rows, documents or items, are judged each by
themselves; empty tables on either side give no matches; all columns of the
documents are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logloom.llm.common import ddl, free_name, quoted, staged, table

Q, RATE = 8, 0.1
BLOCK_CHARS = 4_000_000
TABLE_BITS = 22

_OTHER = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")
_P = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of all q-grams (q a power of two)."""
    with np.errstate(over="ignore"):
        h, width, p = (chars + np.uint64(1)) * _P, 1, _P
        while width < q:
            h = h[:-width] * p + h[width:] if len(h) > width else h[:0]
            width, p = 2 * width, p * p + np.uint64(2)
        return h ^ (h >> np.uint64(29))


class Items:
    """The q-grams of a block of items, and the bounds that the lemma gives."""

    def __init__(self, rows: list[tuple], rate: float = RATE, q: int = Q):
        kept = [(i, t) for i, t in ((i, normal(t)) for i, t in rows) if t]
        self.short = {}
        for i, t in kept:
            if len(t) < q:
                self.short.setdefault(t, []).append(i)
        kept = [(i, t) for i, t in kept if len(t) >= q]
        self.q, self.ids, self.texts = q, [i for i, _ in kept], [t for _, t in kept]
        self.codes = [codes(t) for t in self.texts]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.minimum((rate * m).astype(np.int64), (m - q) // q)
        self.least = m - q + 1 - q * self.budget
        hashes = [grams(c, q) for c in self.codes]
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])[order]
        self.at = np.concatenate([np.arange(len(h)) for h in hashes])[order] if hashes else np.zeros(0, np.int64)
        self.hash, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.hash >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def bands(self, h: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) with enough common q-grams, for a text's hashes."""
        maybe = np.flatnonzero(self.table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        if not len(maybe):
            return []
        place = np.minimum(np.searchsorted(self.hash, h[maybe]), len(self.hash) - 1)
        same = self.hash[place] == h[maybe]
        maybe, place = maybe[same], place[same]
        times = self.first[place + 1] - self.first[place]
        if times.sum() < self.least.min():
            return []
        entry = np.repeat(self.first[place] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        item, diagonal = self.item[entry], np.repeat(maybe, times) - self.at[entry]
        enough = np.bincount(item, minlength=len(self.ids)) >= self.least
        some = enough[item]
        if not some.any():
            return []
        item, diagonal, at = item[some], diagonal[some], np.tile(self.at[entry][some], 2)
        low = diagonal // (self.budget[item] + 1)  # a diagonal lies in the band that begins in its step, and in the one before
        key = np.concatenate([low, low - 1]) + (np.concatenate([item, item]).astype(np.int64) << 40) + (1 << 39)
        key, of, n = np.unique(key, return_inverse=True, return_counts=True)
        item = key >> 40
        ok = n >= self.least[item]
        if not ok.any():
            return []
        # the lemma speaks of the item's q-grams: one that the text repeats in the band counts once
        some = ok[of]
        width = int(self.at.max()) + 1
        ok &= np.bincount(np.unique(of[some] * width + at[some]) // width, minlength=len(key)) >= self.least[item]
        return list(zip(item[ok].tolist(), ((key[ok] & ((1 << 40) - 1)) - (1 << 39)).tolist()))

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item index, edits, start, end) of the best passage of each item in a normalised text."""
        chars = codes(text)
        if len(chars) < self.q or not self.ids:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        for item, band in self.bands(grams(chars, self.q)):
            if best.get(item, (1,))[0] == 0:
                continue
            if (at := text.find(self.texts[item])) >= 0:
                best[item] = (0, at, at + len(self.texts[item]))
                continue
            step = int(self.budget[item]) + 1
            found = align(self.codes[item], chars, band * step, 2 * step, step - 1)
            if found[0] <= self.budget[item] and (item not in best or found < best[item]):
                best[item] = found
        return [(i, *x) for i, x in sorted(best.items())]


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, budget: int) -> tuple[int, int, int]:
    """Least edits, start and end of the item in the text, on diagonals low .. low + width - 1.

    Ends early, with what it has, once no alignment can stay within the budget.
    Costs carry the diagonal they began on in their low bits; the least cost wins, then the earliest start.
    """
    one = 1 << 32
    d = np.arange(width, dtype=np.int64)
    padded = np.full(len(item) + width, np.iinfo(np.uint64).max, np.uint64)
    a, b = max(0, low), min(len(text), low + len(padded))
    if a < b:
        padded[a - low:b - low] = text[a:b]
    far = np.int64(one) * (2 * len(item) + 2 * width)
    start = low + d
    cost = np.where((start >= 0) & (start <= len(text)), d, far)
    for j in range(len(item)):
        step = cost + one * (padded[j:j + width] != item[j])
        step[:-1] = np.minimum(step[:-1], cost[1:] + one)
        outside = (start + j + 1 > len(text)) | (start + j + 1 < 0)
        step[outside] = far
        cost = np.minimum.accumulate(step - one * d) + one * d
        cost[outside] = far
        if j % 8 == 7 and int(cost.min()) >> 32 > budget:
            break
    k = int(np.argmin(cost))
    return int(cost[k]) >> 32, low + (int(cost[k]) & (one - 1)), min(len(text), low + k + len(item))


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where positions of the normalised text lie in the text itself."""
    lowered = text.lower()
    words = [m.span() for m in _WORD.finditer(lowered)]
    at = np.cumsum([0, *(b - a + 1 for a, b in words)])
    def back(pos: int) -> int:
        k = min(len(words) - 1, int(np.searchsorted(at, pos, "right")) - 1)
        return min(words[k][1], words[k][0] + pos - int(at[k]))
    a, b = back(start), back(end - 1) + 1
    if len(lowered) != len(text):
        to = np.cumsum([len(c.lower()) for c in text])
        a, b = int(np.searchsorted(to, a, "right")), int(np.searchsorted(to, b - 1, "right")) + 1
    return a, b


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", item_col: str = "text", text_col: str = "text",
                  rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All columns of ``docs``, and last an array of (item_id, edits, start, end), empty for clean documents."""
    name = free_name(docs.columns, "passages")
    kind = benchmark.schema[id_col].dataType.simpleString()
    result = docs.withColumn(name, F.array().cast(f"array<struct<item_id:{kind},edits:int,start:int,end:int>>"))
    rows = benchmark.filter(F.char_length(item_col) > 0).groupBy(id_col, item_col).agg(F.count(F.lit(1)).alias("times"))
    rows = staged(rows.toDF("id", "item", "times"), "benchmark-items")
    chars = rows.agg(F.sum(F.char_length("item"))).first()[0] or 0
    n = -(-chars // block_chars)
    for k in range(n):
        mine = rows.filter(F.pmod(F.xxhash64("id", "item"), F.lit(n)) == k)
        # Items hands the ids on as they are: here an id and how often its row occurs
        items = docs.sparkSession.sparkContext.broadcast(Items([((r["id"], r["times"]), r["item"]) for r in mine.collect()], rate))
        result = _scan(result, items, name, text_col)
    return result


def _scan(docs: DataFrame, items, name: str, text_col: str) -> DataFrame:
    columns = docs.columns

    def run(batches):
        known = items.value
        for b in batches:
            out = []
            for had, text in zip(b.column(name).to_pylist(), b.column(text_col).to_pylist()):
                plain = normal(text)
                found = [{"item_id": i, "edits": 0, "start": 0, "end": len(text)} for i, times in known.short.get(plain, ()) for _ in range(times)]
                for k, edits, start, end in known.matches(plain):
                    a, z = original_span(text, start, end)
                    i, times = known.ids[k]
                    found += [{"item_id": i, "edits": edits, "start": a, "end": z}] * times
                out.append((had or []) + found)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, b.schema.field(name).type)], columns)

    return docs.mapInArrow(run, ddl(docs))


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents that hold no passage of the benchmark, with their columns."""
    found = find_passages(docs, benchmark, **how)
    return found.filter(F.size(found.columns[-1]) == 0).select(*map(quoted, docs.columns))


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """One row per document and item that it holds a passage of."""
    found = find_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("passages").alias("p")).select("doc_id", "p.*")
