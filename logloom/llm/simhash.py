"""SimHash near-dedup by generalised pigeonhole search.

Fingerprints that differ in at most ``distance`` bits are linked; a document's
class is its connected component.

1. Equal fingerprints are one node with its least id, so copies cost one row.
2. ``plan``: over all nodes, one 64x64 table of common bits gives each bit's
   share of ones and all correlations.  Correlated bits are grouped into m
   partitions; thresholds t_i >= -1 with sum(t_i + 1) = distance + 1 are dealt
   out by dynamic programming on the estimated number of candidates and probes
   (a partition at -1 is not searched).  The m that costs least is taken: more
   nodes lead to wider partitions, so that buckets stay small.
   If two fingerprints differed in more than t_i bits in every partition, they
   would differ in more than ``distance`` bits in all, so no link is missed.
3. ``links``: each node stands in the bucket of its own bits in every searched
   partition and probes all buckets within t_i bits.  A bucket with more than
   ``BLOCK`` members is cut into blocks, each met by all that probe it, so a
   task holds one block and one batch.  Candidates are verified on all 64 bits.
   Of a bucket's links a spanning forest goes on, at most one link a member and
   component, not all pairs.
4. Distributed connected components over the links.

Defined results: null text counts as empty; texts without words have
fingerprint zero and are linked like others; null ids are no component's
smallest unless all are null; repeated rows stay; an empty table gives no rows.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from logloom.llm.common import free_name, staged, table
from logloom.llm.components import components

BITS, SEED = 64, 42
SHINGLE, DISTANCE = 4, 4
#: Most members of a bucket that one task holds at a time.
BLOCK = 1024
#: Estimated nanoseconds of a probe row (shuffle and sort) and of a comparison.
PROBE_NS, VERIFY_NS = 2000.0, 3.0


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """bytes.lower() and bytes.split() work on A-Z and on the six ASCII spaces alone."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined, ends, at = b" ".join(tokens), [], -1
    for t in tokens:
        at += len(t) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    xx, n = xxhash.xxh64_intdigest, max(1, len(tokens) - words + 1)
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, n, 65_536):
        hi = min(n, lo + 65_536)
        h = np.array([xx(joined[a:b], SEED) for a, b in zip(starts[lo:hi], ends[lo + words - 1:hi + words - 1] or ends[-1:])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(ones * 2 > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """id and fp, the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp long")


# --- the search plan -------------------------------------------------------

def common_bits(nodes: DataFrame) -> np.ndarray:
    """[i, j]: how many nodes have bits i and j; each task sends one 64x64 table."""
    def run(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False)
            x = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += (x.T @ x).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS), pa.int32()), pa.array(total.ravel())], ["at", "n"])

    out = np.zeros(BITS * BITS)
    for at, n in nodes.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out.reshape(BITS, BITS)


def group_bits(common: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m partitions of nearly equal width; each takes the bits that go best with those it has."""
    p = np.diag(common) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    together = np.abs((common / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(together, 0)
    left, groups = set(range(BITS)), []
    for g in range(m):
        width = BITS // m + (g < BITS % m)
        rest = sorted(left)
        group = [max(rest, key=lambda i: together[i, rest].sum())]
        while len(group) < width:
            group.append(max(sorted(left - set(group)), key=lambda i: together[i, group].sum()))
        groups.append(sorted(group))
        left -= set(group)
    return groups


def deal_thresholds(common: np.ndarray, n: int, groups: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Least estimated cost, and each partition's threshold, by dynamic programming."""
    p = np.diag(common) / n
    costs = []
    for bits in groups:
        at = np.zeros(distance + 1)  # at[k]: two nodes differ in k of these bits
        at[0] = 1
        for q in 2 * p[bits] * (1 - p[bits]):
            at = at * (1 - q) + np.concatenate([[0], at[:-1]]) * q
        near = np.cumsum(at)
        probes = np.cumsum([math.comb(len(bits), k) for k in range(distance + 1)])
        costs.append([0.0] + [float(n * probes[t] * PROBE_NS + n * n * near[t] * VERIFY_NS) for t in range(distance + 1)])
    best = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, ts) in best.items():
            for t in range(-1, distance + 1 - spent):
                got = (cost + own[t + 1], [*ts, t])
                if spent + t + 1 not in step or got < step[spent + t + 1]:
                    step[spent + t + 1] = got
        best = step
    return best[distance + 1]


def plan(nodes: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is searched."""
    n = nodes.count()
    if n < 2:
        return []
    common = common_bits(nodes)
    found = []
    for m in range(2, distance + 2):
        groups = group_bits(common, n, m)
        cost, ts = deal_thresholds(common, n, groups, distance)
        found.append((cost, [(g, t) for g, t in zip(groups, ts) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


# --- probe and verify ------------------------------------------------------

def _entries(batches, searched):
    """part, bucket, fp, own: a node's own bucket, and the others that it probes."""
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False)
        x = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for part, (bits, t) in enumerate(searched):
            weights = 1 << np.arange(len(bits), dtype=np.int64)
            key = x[:, bits].astype(np.int64) @ weights
            for k in range(t + 1):
                for flips in combinations(range(len(bits)), k):
                    mask = int(sum(weights[list(flips)]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(fps), part, np.int32)), pa.array(key ^ mask), b.column(0), pa.array(np.full(len(fps), k == 0))],
                        ["part", "bucket", "fp", "own"])


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    d = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :])  # of signed numbers it counts abs()
    return (d <= distance) & (d > 0)


class _Block:
    """Up to BLOCK members of a bucket; gives a forest of their links, then that of each batch that meets them."""

    def __init__(self, members: np.ndarray, distance: int):
        self.members, self.distance = members, distance
        self.label = np.full(len(members), -1)
        self.edges: list[tuple[int, int]] = []
        near = _near(members, members, distance)
        for root in range(len(members)):
            if self.label[root] < 0:
                self.label[root], todo = root, [root]
                while todo:
                    i = todo.pop()
                    new = np.flatnonzero(near[i] & (self.label < 0))
                    self.label[new] = root
                    todo.extend(new.tolist())
                    self.edges.extend((int(members[i]), int(members[j])) for j in new)

    def meet(self, others: np.ndarray) -> None:
        for lo in range(0, len(others), 4096):
            some = others[lo:lo + 4096]
            i, j = np.nonzero(_near(some, self.members, self.distance))
            # of each tree that one of the others is near to, any near member will do
            _, first = np.unique(i * len(self.members) + self.label[j], return_index=True)
            self.edges.extend(zip(some[i[first]].tolist(), self.members[j[first]].tolist()))


def _verify(batches, distance):
    """Rows come sorted by part, bucket, block, own members first."""
    key, members, block = None, [], None

    def out(edges):
        a, b = zip(*edges)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        parts, buckets, blocks, fps, own = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        change = (np.diff(parts) != 0) | (np.diff(buckets) != 0) | (np.diff(blocks) != 0)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(fps)]
        edges = []
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if key != (now := (parts[lo], buckets[lo], blocks[lo])):
                if block is None and len(members) and sum(map(len, members)) > 1:
                    block = _Block(np.concatenate(members), distance)
                if block is not None:
                    edges.extend(block.edges)
                key, members, block = now, [], None
            mine = own[lo:hi]
            members.append(fps[lo:hi][mine])
            others = fps[lo:hi][~mine]
            if len(others) and any(map(len, members)):
                if block is None:
                    block = _Block(np.concatenate(members), distance)
                block.meet(others)
        if edges:
            yield out(edges)
    if block is None and sum(map(len, members)) > 1:
        block = _Block(np.concatenate(members), distance)
    if block is not None and block.edges:
        yield out(block.edges)


def links(nodes: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect what all pairs within ``distance`` bits would."""
    searched = plan(nodes, distance)
    if not searched:
        return nodes.sparkSession.createDataFrame([], "a long, b long")
    rows = nodes.select("fp").mapInArrow(lambda bs: _entries(bs, searched), "part int, bucket long, fp long, own boolean")
    large = (rows.filter("own").groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
             .select("part", "bucket", F.ceil(F.col("n") / (block // 2)).cast("int").alias("blocks")))
    met = rows.join(large, ["part", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    home = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = met.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("mine", F.col("own") & (F.col("block") == home))
    return (dealt.select("part", "bucket", "block", "fp", "mine").repartition("part", "bucket", "block")
            .sortWithinPartitions("part", "bucket", "block", F.desc("mine"))
            .mapInArrow(lambda bs: _verify(bs, distance), "a long, b long").distinct())


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int, distance: int) -> DataFrame:
    """One row per input row: id, fp, root, component_id; ``root`` is the class's least fingerprint, which no other class has."""
    prints = staged(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    found = components(links(nodes, distance))
    classes = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(classes.select("fp", "root").join(least, "root"), "fp").select("id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per input row: id, fp, component_id."""
    return _classes(docs, id_col, text_col, words, distance).drop("root")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each class, that of the smallest id, with the columns it came with.

    Classes are told apart by their root: ids that are null or repeat may be the least of several.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "fp")).alias("first")
    kept = staged(_classes(docs, id_col, text_col, words, distance).groupBy("root").agg(first).select("first.id", "first.fp"), "simhash-kept")
    name, print_, marked_print = (free_name(docs.columns, n) for n in ("kept_id", "kept_print", "own_print"))
    if docs.groupBy(id_col).count().filter("count > 1").isEmpty():
        chosen = kept.select(F.col("id").alias(name))
        return docs.join(chosen, docs[id_col].eqNullSafe(chosen[name]), "left_semi")
    # ids that repeat don't tell rows apart; the text's fingerprint and, behind it, one row of each pair do
    own = F.udf(lambda t: fingerprint(t, words) - ((fingerprint(t, words) >> 63) << 64), "long")
    chosen = kept.select(F.col("id").alias(name), F.col("fp").alias(print_))
    marked = docs.withColumn(marked_print, own(text_col))
    found = marked.join(chosen, marked[id_col].eqNullSafe(chosen[name]) & (F.col(marked_print) == F.col(print_)), "left_semi")
    return found.dropDuplicates([id_col, marked_print]).drop(marked_print)


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
