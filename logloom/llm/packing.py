"""Best-fit packing after Martello-Toth dominance reduction.

Pieces of one length are interchangeable, so the packing is decided on counts
per length (at most ``size`` rows, whatever the corpus):

1. ``reduce_by_dominance`` goes down from the longest length left and fixes sets
   that dominate every other set with that piece: alone, where not even the
   shortest fits; with the longest partner that fits, where no two others fit
   or that partner fills the sequence; with the best pair, where the pair
   reaches at least what any partner or pair could and no three fit.
   Dominated choices can be left out without needing more sequences.
2. ``best_fit`` puts what remains, longest first, into the open sequence with
   the least room that is enough, all pieces of a length at once.

The plan is a table of slots: for each length, ranges of ranks and the
sequences that take them.  Pieces are ranked per length in salted buckets, so
neither a common length nor the corpus meets in one task, and find their slot
by a join on the length and the range of ranks.

Tokens come from the byte-level BPE's merge ranks, word by word with a bounded
cache; a test holds them against the tokenizer file's own ids.  A document is
its ids and then id 0; only documents over ``size`` are cut, from the end, so
that the first piece alone is shorter.

Defined results: null text counts as empty (one piece: id 0 alone); repeated
rows and null ids are packed like others; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logloom.llm.common import staged, table

SIZE = 2048
END_ID = 0
SALTS = 64
#: Words that a Python worker keeps the ids of.
CACHE = 500_000

PIECES = "id {kind}, piece int, start long, length int, ids_crc32 long"


# --- pieces ----------------------------------------------------------------

class Encoder:
    """Ids of whole texts as little-endian 32-bit words.

    A cut before a space that a non-space follows is no place where a
    pre-token, and so a merge, can go across: the pattern takes all but the
    last of a run of white space apart from the word behind it.
    """

    _loaded: dict[tuple[str, str], "Encoder"] = {}

    def __init__(self, ranks_path: str, special: str):
        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={special: len(ranks)})
        self.cache: dict[str, bytes] = {}

    @classmethod
    def get(cls, ranks_path: str, special: str) -> "Encoder":
        if (ranks_path, special) not in cls._loaded:
            cls._loaded[ranks_path, special] = cls(ranks_path, special)
        return cls._loaded[ranks_path, special]

    def _raw(self, text: str) -> bytes:
        import numpy as np
        return np.array(self.coding.encode(text, allowed_special="all"), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        words = text.split(" ")
        first, rest = words[0], words[1:]
        cache = self.cache
        found = list(map(cache.get, rest))
        if None in found:
            if "" in rest or any(w[0].isspace() for w, ids in zip(rest, found) if ids is None):
                first, *rest = _CUT.split(text)
                found = list(map(cache.get, rest))
            if len(cache) > CACHE:
                cache.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    w = rest[i]
                    if (ids := cache.get(w)) is None:
                        ids = self._raw(" " + w)
                        if len(w) <= 64:
                            cache[w] = ids
                    found[i] = ids
        return (self._raw(first) if first else b"") + b"".join(found)


_CUT = re.compile(r" (?=\S)")


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), "<|endoftext|>"


def cut_pieces(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document of n ids; only the first piece may be shorter."""
    if n <= size:
        return [(0, n)]
    head = n % size
    starts = ([0] if head else []) + list(range(head, n, size))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    files = tokenizer_files()

    def run(batches):
        encoder = Encoder.get(*files)
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = encoder.encode(text or "") + end
                for k, (start, length) in enumerate(cut_pieces(len(data) // 4, size)):
                    rows.append((doc, k, start, length, zlib.crc32(data[4 * start:4 * (start + length)])))
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(id_col, text_col).mapInArrow(run, PIECES.format(kind=docs.schema[id_col].dataType.simpleString()))


# --- the plan, on counts per length ------------------------------------------

#: A sequence's content as (length, times), and how many sequences have it.
Pattern = tuple[tuple[tuple[int, int], ...], int]


class _Counts:
    """How many pieces are left of each length, with the nearest length that has any."""

    def __init__(self, counts: dict[int, int], size: int):
        self.n = [0] * (size + 1)
        for length, k in counts.items():
            self.n[length] = k

    def down(self, length: int) -> int:
        while length > 0 and not self.n[length]:
            length -= 1
        return length

    def shortest(self) -> int:
        return next((i for i, k in enumerate(self.n) if k), 0)

    def take(self, lengths: tuple[int, ...]) -> int:
        """How many such sets there are, taking all of them."""
        times = defaultdict(int)
        for x in lengths:
            times[x] += 1
        sets = min(self.n[x] // t for x, t in times.items())
        for x, t in times.items():
            self.n[x] -= t * sets
        return sets


def _best_pair(left: _Counts, room: int) -> tuple[int, int] | None:
    """The two pieces that fill ``room`` most."""
    best = None
    a = left.down(room)
    while a > 0 and (best is None or 2 * a > sum(best)):
        b = left.down(min(a - (left.n[a] < 2), room - a))
        if b and (best is None or a + b > sum(best)):
            best = (a, b)
            if a + b == room:
                break
        a = left.down(a - 1)
    return best


def _fewest(left: _Counts, without: int, k: int, above: int = 0) -> list[int]:
    """The k shortest pieces longer than ``above``, besides one of length ``without``."""
    out: list[int] = []
    for i in range(above + 1, len(left.n)):
        out.extend([i] * min(k, left.n[i] - (i == without)))
        if len(out) >= k:
            break
    return out[:k]


def dominating_set(left: _Counts, longest: int, size: int) -> tuple[int, ...] | None:
    """A set with a piece of length ``longest`` that dominates all others with it, if there is one of up to three.

    A set dominates another if its pieces, besides the common one, can each
    stand where one or more of the other's stand.
    """
    room = size - longest
    few = _fewest(left, longest, 3)
    if not few or few[0] > room:
        return (longest,)
    left.n[longest] -= 1
    try:
        partner = left.down(room)
        if partner == room:
            return (longest, partner)
        pair = _best_pair(left, room)
        if pair is None:
            return (longest, partner)
        if len(few) == 3 and sum(few) <= room:
            return None
        if sum(pair) <= partner:
            return (longest, partner)
        # any other pair has its longer piece within the partner's length; its shorter one must be within the second's
        beyond = _fewest(left, 0, 2, above=pair[1])
        if pair[0] == partner and (len(beyond) < 2 or sum(beyond) > room):
            return (longest, *pair)
        return None
    finally:
        left.n[longest] += 1


def reduce_by_dominance(left: _Counts, size: int) -> list[Pattern]:
    """Fixes dominating sets, longest piece first; ``left`` keeps the rest.

    A set that dominates does so again after it has been taken away, so all
    copies of it are fixed at once.
    """
    fixed: list[Pattern] = []
    longest = left.down(size)
    while longest:
        while left.n[longest] and (chosen := dominating_set(left, longest, size)):
            fixed.append((_runs(chosen), left.take(chosen)))
        longest = left.down(longest - 1)
    return fixed


def _runs(lengths: Iterable[int]) -> tuple[tuple[int, int], ...]:
    out: list[list[int]] = []
    for x in sorted(lengths, reverse=True):
        if out and out[-1][0] == x:
            out[-1][1] += 1
        else:
            out.append([x, 1])
    return tuple((a, b) for a, b in out)


def best_fit(left: _Counts, size: int) -> list[Pattern]:
    """All pieces left, longest first, each length at once."""
    rooms: list[list[list]] = [[] for _ in range(size + 1)]  # by room: [content, sequences]
    for length in range(size, 0, -1):
        n, left.n[length] = left.n[length], 0
        room = length
        while n and room <= size:
            if not rooms[room]:
                room += 1
                continue
            content, k = rooms[room].pop()
            fits = min(room // length, n)
            if fits * k <= n:
                rooms[room - fits * length].append([_more(content, length, fits), k])
                n -= fits * k
            else:
                full, rest = divmod(n, fits)
                if full:
                    rooms[room - fits * length].append([_more(content, length, fits), full])
                if rest:
                    rooms[room - rest * length].append([_more(content, length, rest), 1])
                if k > full + bool(rest):
                    rooms[room].append([content, k - full - bool(rest)])
                n = 0
        if n:
            each = size // length
            full, rest = divmod(n, each)
            if full:
                rooms[size - each * length].append([((length, each),), full])
            if rest:
                rooms[size - rest * length].append([((length, rest),), 1])
    return [(tuple(content), k) for room in rooms for content, k in room]


def _more(content: tuple, length: int, times: int) -> tuple:
    return (*content, (length, times))


def plan(counts: dict[int, int], size: int = SIZE) -> list[Pattern]:
    left = _Counts(counts, size)
    return reduce_by_dominance(left, size) + best_fit(left, size)


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from rank, to rank, first sequence, pieces a sequence, offset) rows."""
    rank: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for content, k in patterns:
        offset = 0
        for length, times in content:
            out.append((length, rank[length], rank[length] + times * k, sequence, times, offset))
            rank[length] += times * k
            offset += times * length
        sequence += k
    return out


# --- the whole operator ------------------------------------------------------

def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = staged(pieces(docs, id_col, text_col, size), "pieces")
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "start"), F.lit(SALTS)).cast("int"))
    counts = staged(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    per_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table_ = spark.createDataFrame(slots(plan(per_length, size)), "length int, lo long, hi long, first long, times long, at long")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("own", F.row_number().over(within) - 1)
              .join(F.broadcast(starts), ["length", "salt"])  # at most size x SALTS rows
              .withColumn("rank", F.col("before") + F.col("own")))
    # at most a few slots a length, each of the plan's patterns having under 64 lengths
    placed = ranked.join(F.broadcast(table_), "length").filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    nth = F.col("rank") - F.col("lo")
    return placed.select("id", "piece", "start", "length", "ids_crc32",
                         (F.col("first") + F.floor(nth / F.col("times"))).alias("sequence_id"),
                         (F.col("at") + nth % F.col("times") * F.col("length")).cast("long").alias("offset"))


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    rows = pack(table(spark, sf_dir, "documents"))
    return rows.withColumnRenamed("id", "doc_id").withColumn("length", F.col("length").cast("long"))
