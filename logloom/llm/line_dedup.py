"""Fuzzy line dedup by MinHash: of each class of near-equal lines, the first stays.

Lines are compared in lower case with (Unicode) white space collapsed and trimmed.  Lines
are linked when the sets of their 8-character shingles (a shorter line is its
own shingle) have a Jaccard similarity of 0.8 or more.

1. Each task signs a line once: 80 minima in 16 bands of 5, which finds a pair
   at 0.8 with probability 0.998 and almost none below 0.2.  Equal lines have
   one 64-bit number; a second hash proves that no two lines share it, else the
   numbers are drawn anew.
2. In each band bucket all lines are held against the bucket's least one, by
   their exact sets.  That links a bucket of near copies without its pairs.
3. Buckets where that failed for a line, and that still hold several
   components, are looked at again with their lines side by side, in blocks of
   ``BLOCK`` that all lines of the bucket meet.  There every line is held
   against every other by their exact sets, as bits over the block's shingles,
   and what links components goes on: a forest, not the pairs.
4. Distributed connected components over the links; the first line of each, by
   document id, then text, then position, stays and the others are removed.

Defined results: null text counts as empty; blank lines always stay and take no
part; ids that are null come last; rows that repeat an id and a text get the
same result; an empty table gives no rows; all columns of the documents are kept.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from logloom.llm.common import discard, free_name, quoted, staged, table, text_or_empty
from logloom.llm.components import components
from logloom.llm.decontaminate import codes, grams

Q, LEAST = 8, 0.8
BANDS, ROWS = 16, 5
#: Lines of which a task remembers that it has signed them.
SEEN = 1_000_000
#: Most line numbers (8 bytes each) that are broadcast to pick out their texts; beyond, they are joined.
BROADCAST_LINES = 1_000_000
#: Lines of a bucket that a task holds at a time, and the characters of which bit sets share one vocabulary.
BLOCK, PART_CHARS = 512, 300_000
_CHUNK = 60_000

_random = np.random.default_rng(2024)
_FACTORS = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_MIX = _random.integers(0, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)


def minima(lines: list[str]) -> np.ndarray:
    """[k, line]: the least of each line's shingle hashes under the k-th hash function."""
    out = np.zeros((BANDS * ROWS, len(lines)), np.uint32)
    lo = 0
    while lo < len(lines):
        hi, size = lo, 0
        while hi < len(lines) and (hi == lo or size + len(lines[hi]) <= _CHUNK):
            size += len(lines[hi]) + Q
            hi += 1
        part = [x if len(x) >= Q else x.ljust(Q, "\0") for x in lines[lo:hi]]
        n = np.array([len(x) for x in part]) - Q + 1
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        valid = np.arange(n.sum()) + np.repeat(np.arange(len(part)) * (Q - 1), n)
        h = (grams(codes("".join(part)), Q)[valid] >> np.uint64(17)).astype(np.uint32)
        for k in range(BANDS * ROWS):
            out[k, lo:hi] = np.minimum.reduceat(h * _FACTORS[k], starts)
        lo = hi
    return out


def signatures(lines: list[str]) -> np.ndarray:
    """Band hashes, one row per line."""
    banded = minima(lines).astype(np.uint64).reshape(BANDS, ROWS, -1)
    with np.errstate(over="ignore"):
        h = (banded * _MIX[None, :, None]).sum(axis=1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64)[:, None]
        h ^= h >> np.uint64(31)
        return np.ascontiguousarray((h * np.uint64(0xBF58476D1CE4E5B9)).T).view(np.int64)


def shingles(line: str) -> set[str]:
    return {line[i:i + Q] for i in range(len(line) - Q + 1)} or {line}


@lru_cache(1024)
def packed(line: str) -> np.ndarray | None:
    """The line's distinct shingles, sorted, the eight characters of each as one number; None where they don't fit in 8 bits each."""
    try:
        data = line.encode("latin-1")
    except UnicodeEncodeError:
        return None
    if len(data) < Q:
        return None
    x = np.sort(np.ndarray(len(data) - Q + 1, "<u8", data, 0, (1,)))
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


def jaccard(a: str, b: str) -> float:
    x, y = packed(a), packed(b)
    if x is None or y is None:
        x, y = shingles(a), shingles(b)
        both = len(x & y)
    else:
        z = np.sort(np.concatenate([x, y]))
        both = int(np.count_nonzero(z[1:] == z[:-1]))
    return both / (len(x) + len(y) - both)


def normal(line: str) -> str:
    return " ".join(line.split()).lower()


def _sign(batches, seed: int):
    """A row per line that isn't blank; bands and text where the task sees it for the first time."""
    xx, seen = xxhash.xxh64_intdigest, set()
    for b in batches:
        ids, rows, new = b.column(0), [], []
        for i, text in enumerate(b.column(1).to_pylist()):
            data = text or ""
            own = xx(data, 42)  # as Spark's xxhash64
            for k, line in enumerate(data.split("\n")):
                if norm := normal(line):
                    n = xx(norm, seed)
                    rows.append((i, own, k, n, xx(norm, seed + 1_000_003), n not in seen))
                    if rows[-1][-1]:
                        seen.add(n)
                        new.append(norm)
        if len(seen) > SEEN:
            seen.clear()
        if rows:
            at, own, line, n, proof, first = zip(*rows)
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            first = np.array(first)
            offsets = pa.array(np.concatenate([[0], np.cumsum(first * BANDS)]).astype(np.int32))
            bands = pa.ListArray.from_arrays(offsets, pa.array(signatures(new).ravel()), mask=pa.array(~first))
            texts = iter(new)
            norms = pa.array([next(texts) if f else None for f in first.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), signed(own), pa.array(line, pa.int32()), signed(n), signed(proof), bands, norms],
                                             ["id", "own", "line", "n", "proof", "bands", "norm"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, near) for pairs of line numbers."""
    def run(batches):
        for b in batches:
            near = [jaccard(x, y) >= LEAST for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near, pa.bool_())], ["a", "b", "near"])

    left = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
    return left.mapInArrow(run, "a long, b long, near boolean")


class _Part:
    """Lines as sets of bits over their shingles.

    Among themselves only the shingles that several of them hold are needed;
    over all of them the bits are laid out once lines of elsewhere come.
    """

    def __init__(self, rows: list[tuple], component: list[int]):
        self.n, _, texts = zip(*rows)
        self.component = np.array(component, np.int64)
        sets = [packed(x) for x in texts]
        self.fits = all(x is not None for x in sets)
        if self.fits:
            self.known, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        else:
            self.known = {}
            sets = [[self.known.setdefault(x, len(self.known)) for x in shingles(line)] for line in texts]
            number = np.concatenate([np.array(x, np.int64) for x in sets])
            times = np.bincount(number)
        self.size = np.array([len(x) for x in sets])
        self.sets = np.split(number, np.cumsum(self.size)[:-1])
        several = times > 1
        place = np.cumsum(several) - 1
        self.own = _bits([place[x[several[x]]] for x in self.sets], int(several.sum()))
        self.bits = None

    def _numbers(self, line: str) -> tuple[list[int] | np.ndarray, int]:
        """The numbers of the line's shingles that these lines hold, and how many it has."""
        if not self.fits:
            line = shingles(line)
            return [k for x in line if (k := self.known.get(x)) is not None], len(line)
        if (x := packed(line)) is None:
            own = shingles(line)
            size = len(own)  # a line that doesn't fit may hold shingles that do
            x = np.array([int.from_bytes(b, "little") for y in own if len(y) == Q and (b := y.encode("latin-1", "ignore")) and len(b) == Q], np.uint64)
        else:
            size = len(x)
        at = np.minimum(np.searchsorted(self.known, x), len(self.known) - 1)
        return at[self.known[at] == x], size

    def _near(self, bits: np.ndarray, own: np.ndarray, size: int, at: np.ndarray) -> list[int]:
        both = np.bitwise_count(bits[at] & own).sum(1, dtype=np.int64)
        return at[both >= LEAST * (self.size[at] + size - both)].tolist()

    def near_before(self, i: int, component: int) -> list[int]:
        """The lines before ``i``, of other components, whose exact similarity to it is LEAST or more."""
        at = np.flatnonzero(self.component[:i] != component)
        return self._near(self.own, self.own[i], self.size[i], at) if len(at) else []

    def near(self, line: str, component: int) -> list[int]:
        """The same for a line of elsewhere."""
        at = np.flatnonzero(self.component != component)
        if not len(at):
            return []
        if self.bits is None:
            self.bits = _bits(self.sets, len(self.known))
        numbers, size = self._numbers(line)
        return self._near(self.bits, _bits([numbers], len(self.known))[0], size, at)


def _bits(sets: list, count: int) -> np.ndarray:
    out = np.zeros((len(sets), count // 64 + 1), np.uint64)
    row = np.zeros(out.shape[1] * 64, bool)
    for k, x in enumerate(sets):
        row[x] = True
        out[k] = np.packbits(row).view(np.uint64)
        row[x] = False
    return out


class _Bucket:
    """A block of a bucket's lines; others meet it one after the other.  Gives links between components only."""

    def __init__(self, rows: list[tuple]):
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []
        self.parts: list[_Part] = []
        at = 0
        while at < len(rows):
            upto, chars = at, 0
            while upto < len(rows) and (upto == at or upto - at < BLOCK and chars + len(rows[upto][2]) <= PART_CHARS):
                chars += len(rows[upto][2])
                upto += 1
            own, before = rows[at:upto], list(self.parts)
            part = _Part(own, [self._find(root) for _, root, _ in own])
            self.parts.append(part)
            for i, (n, root, text) in enumerate(own):
                for other in before:
                    self._link(n, root, other, other.near(text, self._find(root)))
                self._link(n, root, part, part.near_before(i, self._find(root)))
            at = upto

    def _find(self, x: int) -> int:
        while (u := self.up.get(x, x)) != x:
            x = u
        return x

    def _link(self, n: int, root: int, part: _Part, near: list[int]) -> None:
        for j in near:
            a, b = self._find(root), int(part.component[j])
            if a != b:
                self.up[max(a, b)] = min(a, b)
                self.links.append((n, part.n[j]))
                for x in self.parts:
                    x.component[x.component == max(a, b)] = min(a, b)

    def meet(self, rows: list[tuple]) -> None:
        for n, root, text in rows:
            for part in self.parts:
                self._link(n, root, part, part.near(text, self._find(root)))


def _look_again(batches):
    """Rows (h, block, mine, n, root, norm), sorted by bucket and block, a block's own lines first."""
    key, own, bucket = None, [], None

    def out(b: _Bucket):
        a, z = zip(*b.links)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], ["a", "b"])

    def done():
        b = bucket or (_Bucket(own) if len(own) > 1 else None)
        return b if b and b.links else None

    for batch in batches:
        others: list[tuple] = []
        for h, block, mine, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (h, block):
                if others:
                    bucket = bucket or _Bucket(own)
                    bucket.meet(others)
                if b := done():
                    yield out(b)
                key, own, bucket, others = (h, block), [], None, []
            (own if mine else others).append(tuple(row))
        if others and own:
            bucket = bucket or _Bucket(own)
            bucket.meet(others)
    if b := done():
        yield out(b)


def _across(members: DataFrame, failed: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components that meet in a bucket whose least line is not near to all of it."""
    found = components(links).toDF("n", "root")
    classes = staged(found, "line-components")
    discard(found)
    # the least line has been held against all of its bucket; what is open are pairs of others
    again = members.join(members.join(failed, ["n", "least"]).select("h").distinct(), "h", "left_semi").filter("n <> least")
    again = again.join(classes, "n", "left").select("h", "n", F.coalesce("root", "n").alias("root"))
    several = (again.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("size"))
               .filter("x <> y").select("h", F.ceil(F.col("size") / F.lit(BLOCK // 2)).cast("int").alias("blocks")))
    rows = again.join(several, "h").join(texts, "n")
    one = F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks"))  # up to BLOCK lines are one block
    rows = rows.withColumn("blocks", one).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine = F.pmod(F.xxhash64("n"), F.col("blocks")) == F.col("block")
    dealt = (rows.select("h", "block", mine.alias("mine"), "n", "root", "norm").repartition("h", "block")
             .sortWithinPartitions("h", "block", F.desc("mine")))
    return dealt.mapInArrow(_look_again, "a long, b long").distinct()


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line that isn't blank: id, own (the text's hash), line, root (its class); staged."""
    kind, seed = docs.schema[id_col].dataType.simpleString(), 0
    while True:
        signed = staged(docs.select(id_col, text_col).mapInArrow(
            lambda bs, seed=seed: _sign(bs, seed), f"id {kind}, own long, line int, n long, proof long, bands array<long>, norm string"), "lines", compression="zstd")
        if signed.groupBy("n").agg(F.min("proof").alias("a"), F.max("proof").alias("b")).filter("a <> b").isEmpty():
            break
        discard(signed)
        seed += 1
    bucket = Window.partitionBy("h")
    members = staged(signed.filter("bands is not null").select("n", F.explode("bands").alias("h"))
                     .withColumn("least", F.min("n").over(bucket)).withColumn("most", F.max("n").over(bucket))
                     .filter("least <> most").select("h", "n", "least").distinct(), "buckets")
    asked = members.select("n").distinct()
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_LINES else asked
    texts = staged(signed.filter("norm is not null").select("n", "norm").join(asked, "n", "left_semi").dropDuplicates(["n"]), "line-texts")
    held = staged(_verified(members.filter("n <> least").select(F.col("n").alias("a"), F.col("least").alias("b")).distinct(), texts), "line-links")
    links = held.filter("near").select("a", "b")
    failed = held.filter("not near").select(F.col("a").alias("n"), F.col("b").alias("least"))
    if not failed.isEmpty():
        links = links.union(_across(members, failed, links, texts))
    classes = components(links).toDF("n", "root")
    rows = signed.select("id", "own", "line", "n").join(classes, "n", "left").select("id", "own", "line", F.coalesce("root", "n").alias("root"))
    rows = staged(rows, "line-classes")
    for used in (signed, members, texts, held, classes):
        discard(used)
    return rows


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, the text without its removed lines, and last the removed lines' positions."""
    rows = line_classes(docs, id_col, text_col)
    place = F.struct(F.col("id").isNull().alias("last"), "id", "own", "line")
    first = rows.groupBy("root").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    gone = (rows.join(first, "root").filter(place != F.col("first"))
            .groupBy("id", "own").agg(F.sort_array(F.collect_set("line")).alias("gone")))
    name = free_name(docs.columns, "removed_lines")
    of_id, of_text = free_name(docs.columns, "removed_from_id"), free_name(docs.columns, "removed_from_text")
    gone = gone.toDF(of_id, of_text, name)
    text = text_or_empty(text_col)
    joined = docs.join(gone, docs[id_col].eqNullSafe(F.col(of_id)) & (F.xxhash64(text) == F.col(of_text)), "left")
    # a column of its own, else the text would be split again for each line taken
    lines = free_name(joined.columns, "removed_from_lines")
    joined = joined.withColumn(lines, F.when(F.col(name).isNotNull(), F.split(text, "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(name))
    kept = F.when(F.col(name).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return joined.select(*(kept.alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns),
                         F.coalesce(name, F.array().cast("array<int>")).alias(name))


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split(text_or_empty("text"), "\n", -1)).alias("n_lines"))
    return dedup_lines(docs)
