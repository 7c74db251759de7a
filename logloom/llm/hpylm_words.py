"""Hierarchical Pitman-Yor language model with the previous word as context (op3).

Tokens are those of ``hpylm``.  Each is drawn in the restaurant of the word
before it (at the start of a text, of the end token); all of these share one
parent, the restaurant of all words, whose own parent is the base: the known
types and one unknown type, which gets the share n1 / (n1 + V).  A context that
was never seen leaves all to the parent.

Texts are cut into chunks of some tokens, staged as numbers of the chunk's own
words.  What chunks know of the same pair or word meets in its bucket, a range of
hashes: a chunk sends each bucket its distinct pairs once, as one row of packed
numbers, and is answered in the same order.  So no row is made per token or pair,
a hot word or pair comes once a chunk at most, and buckets are as many as the
tokens ask for.

Learning: the buckets add up (previous, word) pairs and name for each one of the
chunks that have it.  A pair seen once has one table, so that chunk draws only
pairs seen twice or more: in a sweep it gets its words' tables, draws those of its
pairs as ``hpylm.draw_tables`` does and sends back their sums; the words' buckets
add these up and draw the parent's tables.  A context's followers are never
gathered.  Sweeps are staged, and a sweep's tables deleted once the next ones stand.

Scoring: a chunk is answered with the counts of its distinct pairs and words, and
adds up its documents.  Buckets answer in ``SLICES`` turns, each of which shuffles
a part of the pairs and frees its disk before the next.

Words go by their 64-bit hash: among 200 million types, two share one with a
probability of 0.1 %.  Pairs go by 80 bits of both.

Defined results: null text counts as empty (its end token alone is scored);
texts with a null id are learnt from and not held out; repeated rows stay; with
nothing to learn from, every token is unknown; an empty table gives no rows.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from logloom.llm.common import discard, staged, table
from logloom.llm.hpylm import BURN, END, KEPT, STRENGTH, Shape, _discount, draw_tables, held_out, log_stirling, tokens

#: Tokens of a chunk, tokens a bucket is made for, and turns in which the buckets answer.
CHUNK, BUCKET, SLICES = 2_000_000, 500_000, 2

#: Rows between chunks and buckets: to whom, what, from whom, packed numbers.
ROW = "key long, kind int, origin long, data binary"
PAIRS, SEATS, ASKED, ANSWER, WORDS, LINK, NAMES, PART, SUMS, COUNTS, WORD_ANSWER, STATS = range(12)


def word_id(word: str) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (h >> 63 << 64)


# --- packed numbers ----------------------------------------------------------

def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length, of numbers from 0 up, byte by byte, compressed; uint64 columns ascend and are stored by their steps."""
    out = [struct.pack("<q", len(columns[0]))]
    for c in columns:
        steps, base = c.dtype == np.uint64, 0
        if steps:
            base, c = int(c[0]) if len(c) else 0, np.diff(c, prepend=c[:1])
        width = (int(c.max(initial=0)).bit_length() + 7) // 8
        out += [struct.pack("<QBB", base, width, steps), c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    out = b"".join(out)
    return struct.pack("<q", len(out)) + pa.compress(out, "zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    data = pa.decompress(memoryview(data)[8:], struct.unpack_from("<q", data)[0], "zstd", asbytes=True)
    (n,), at, out = struct.unpack_from("<q", data), 8, []
    while at < len(data):
        base, width, steps = struct.unpack_from("<QBB", data, at)
        c = np.zeros((n, 8), np.uint8)
        c[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 10).reshape(width, n).T
        c, at = c.view("<u8")[:, 0], at + 10 + n * width
        out.append(np.uint64(base) + np.cumsum(c, dtype=np.uint64) if steps else c.view(np.int64))
    return out


def _joined(blobs: list[bytes], most: int = 0) -> list[np.ndarray]:
    """The columns of all blobs, one below the other; ``most`` empty ones of none."""
    if not blobs:
        return [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * (most - 1)]
    return [np.concatenate(c) for c in zip(*map(unpacked, blobs))]


def _dealt(keys: np.ndarray, buckets: int, *columns: np.ndarray):
    """(bucket, columns packed) for ascending keys: buckets are ranges of them."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(bucket)) + 1 if len(keys) else []
    for lo, hi in zip([0, *edges], [*edges, len(keys)] if len(keys) else []):
        yield int(bucket[lo]), packed(*(c[lo:hi] for c in columns))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair_keys(u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 16 bits of the words' hashes."""
    with np.errstate(over="ignore"):
        key = _mixed(_mixed(u + np.uint64(0x9E3779B97F4A7C15)) + w)
        return key, (_mixed(u * np.uint64(0xD6E8FEB86659FD93) ^ w) >> np.uint64(48)).astype(np.int64)


def _order(key: np.ndarray, check: np.ndarray, kind: str | None = None) -> np.ndarray:
    order = np.argsort(key, kind=kind)
    k, c = key[order], check[order]
    return np.lexsort((check, key)) if np.any((k[1:] == k[:-1]) & (c[1:] < c[:-1])) else order


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where the runs of equal rows begin."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _find(keys: np.ndarray, checks: np.ndarray, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``key`` are among the ordered ``keys``, and where."""
    if not len(keys):
        return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
    at = np.searchsorted(keys, key)
    while True:
        i = np.minimum(at, len(keys) - 1)
        same = (at < len(keys)) & (keys[i] == key)
        other = same & (checks[i] != check)
        if not other.any():
            return same, i
        at = at + other


# --- rows --------------------------------------------------------------------

def _batch(rows: list[tuple]) -> pa.RecordBatch:
    key, kind, origin, data = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(kind, pa.int32()), pa.array(origin, pa.int64()), pa.array(data, pa.binary())],
                                      ["key", "kind", "origin", "data"])


def _mapped(df: DataFrame, of) -> DataFrame:
    """The rows that ``of`` makes of each row, given by column name."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                yield _batch(list(of({c: b.column(c)[i].as_py() for c in b.schema.names})))

    return df.mapInArrow(run, ROW)


def _by_key(rows: DataFrame, of) -> DataFrame:
    """The rows that ``of`` makes of a key and its blobs: by kind, (origin, data) ascending."""
    def run(t):
        got: dict[int, list] = {}
        for kind, origin, data in sorted(zip(*(t.column(c).to_pylist() for c in ("kind", "origin", "data"))), key=lambda x: x[:2]):
            got.setdefault(kind, []).append((origin, data))
        return pa.Table.from_batches([_batch(list(of(t.column("key")[0].as_py(), got)))])

    return rows.groupBy("key").applyInArrow(run, ROW)


def _of(rows: DataFrame, *kinds: int) -> DataFrame:
    return rows.filter(F.col("kind").isin(*kinds))


def _stats(rows: DataFrame) -> dict[int, int]:
    return {r["key"]: r["n"] for r in _of(rows, STATS).groupBy("key").agg(F.sum("origin").alias("n")).collect()}


def _blobs(got: dict[int, list], kind: int) -> list[bytes]:
    return [data for _, data in got.get(kind, [])]


# --- chunks ------------------------------------------------------------------

class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def _chunks(docs: DataFrame) -> DataFrame:
    """(id, held_out, text) -> a row per chunk: its documents, and their tokens as numbers of its words (ascending hashes)."""
    kind = docs.schema[0].dataType.simpleString()

    def run(batches):
        number, (ids, held, lengths, tokens_, numbers, size) = TaskContext.get().partitionId() << 32, new()
        for b in batches:
            lo = 0
            for hi, text in enumerate(b.column(2).to_pylist(), 1):
                words = tokens(text)
                of = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                tokens_.append(of)
                lengths.append(len(of))
                size += len(of)
                if size >= CHUNK or hi == b.num_rows:
                    ids.append(b.column(0).slice(lo, hi - lo))
                    held.append(b.column(1).slice(lo, hi - lo))
                    lo = hi
                if size >= CHUNK:
                    yield out(number, ids, held, lengths, tokens_, numbers, size)
                    number, (ids, held, lengths, tokens_, numbers, size) = number + 1, new()
        if size:
            yield out(number, ids, held, lengths, tokens_, numbers, size)

    def new():
        return [], [], [], [], _Numbers(), 0

    def out(number, ids, held, lengths, tokens_, numbers, size):
        words, place = np.unique(np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers)), return_inverse=True)
        many = pa.array([0, len(lengths)], pa.int32())
        one = lambda x, t: pa.array([x], t)
        return pa.RecordBatch.from_arrays(
            [one(number, pa.int64()), one(size, pa.int64()), one(len(words), pa.int64()), pa.ListArray.from_arrays(many, pa.concat_arrays(ids)),
             pa.ListArray.from_arrays(many, pa.concat_arrays(held)), one(packed(np.array(lengths)), pa.binary()), one(packed(words), pa.binary()),
             one(packed(place[np.concatenate(tokens_)]), pa.binary())], ["chunk", "size", "types", "ids", "held", "lengths", "words", "tokens"])

    return docs.mapInArrow(run, f"chunk long, size long, types long, ids array<{kind}>, held array<boolean>, lengths binary, words binary, tokens binary")


@dataclass
class Pairs:
    """A chunk's distinct pairs in the order of their keys: u and w number its words, n counts; ``of``: the pair of each token."""

    words: np.ndarray
    w_of: np.ndarray
    u: np.ndarray
    w: np.ndarray
    n: np.ndarray
    key: np.ndarray
    check: np.ndarray
    of: np.ndarray


def _distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes, the place of each code among them, and how often each occurs."""
    bits = len(code).bit_length()
    if int(code.max(initial=0)).bit_length() + bits > 63:
        return np.unique(code, return_inverse=True, return_counts=True)
    both = np.sort(code << bits | np.arange(len(code)))  # several times as fast as argsort
    code, at, of = both >> bits, both & (1 << bits) - 1, np.empty(len(code), np.int64)
    first = _starts(code)
    n = np.diff(first, append=len(code))
    of[at] = np.repeat(np.arange(len(first)), n)
    return code[first], of, n


def _learnt(chunk) -> tuple[np.ndarray, np.ndarray]:
    """The words and the tokens of the documents that are not held out."""
    (words,), (tokens_,), (lengths,) = (unpacked(chunk[c]) for c in ("words", "tokens", "lengths"))
    tokens_ = tokens_[np.repeat(~np.array(chunk["held"], bool), lengths)]
    used = np.bincount(tokens_, minlength=len(words)) > 0
    return words[used], (np.cumsum(used) - 1)[tokens_]


def _asked(chunk) -> tuple[np.ndarray, ...]:
    return unpacked(chunk["words"])[0], *unpacked(chunk["tokens"])


def _pairs(words: np.ndarray, w_of: np.ndarray, u_of: np.ndarray | None = None) -> Pairs:
    if u_of is None:  # texts end with END
        u_of = np.concatenate([[np.searchsorted(words, np.uint64(xxhash.xxh64_intdigest(END)))], w_of[:-1]])[:len(w_of)]
    code, of, n = _distinct(u_of * len(words) + w_of)
    u, w = np.divmod(code, max(1, len(words)))
    key, check = _pair_keys(words[u], words[w])
    order = _order(key, check)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return Pairs(words, w_of, u[order], w[order], n[order], key[order], check[order], rank[of])


def _sizes(chunks: DataFrame) -> tuple[int, int]:
    """Tokens, and words of each chunk added up."""
    size, types = chunks.agg(F.sum("size"), F.sum("types")).first()
    return size or 0, types or 0


def _buckets(entries: int) -> int:
    return max(1, math.ceil(entries / BUCKET))


# --- learning ----------------------------------------------------------------

@dataclass
class Model:
    """Rows of packed numbers: ``pairs`` (key, check, n), ``seats`` (key, check, tables by kept sweep, added up; of pairs seen twice or more),
    ``words`` (hash, c, ..., by kept sweep: tables as context, as word, and in the parent), and what all share."""

    pairs: DataFrame
    seats: DataFrame
    words: DataFrame
    shape: Shape
    sizes: tuple[int, int]
    top: list[tuple[float, float]]  # by kept sweep: tables and customers of the parent


def _count(bucket: int, got):
    """The pairs of a bucket, added up; each chunk's are answered with their count and whether the pair is left to it."""
    origins, columns = [o for o, _ in got[ASKED]], [unpacked(d) for _, d in got[ASKED]]
    key, check, n = map(np.concatenate, zip(*columns))
    order = _order(key, check, "stable")  # merges the chunks' runs
    key, check = key[order], check[order]
    first = _starts(key, check)
    total, size = np.add.reduceat(n[order], first), np.diff(first, append=len(order))
    yield bucket, PAIRS, 0, packed(key[first], check[first], total)
    for times in (1, 2):
        yield times, STATS, int((total == times).sum()), None
    answer, owner = np.empty_like(n), np.zeros_like(n)
    answer[order] = np.repeat(total, size)
    owner[order[first + (key[first] % size.astype(np.uint64)).astype(np.int64)]] = 1
    at = 0
    for origin, c in zip(origins, columns):
        yield origin, ANSWER, bucket, packed(answer[at:at + len(c[0])], owner[at:at + len(c[0])])
        at += len(c[0])


def _shared_out(chunk, answers, buckets: int):
    """What a chunk knows of its words, and the pairs seen twice or more whose tables it is to draw."""
    number = chunk["chunk"]
    p = _pairs(*_learnt(chunk))
    if not answers:
        return
    n, mine = _joined([a["data"] for a in sorted(answers, key=lambda a: a["origin"])])
    mine = mine > 0
    once, many = mine & (n == 1), mine & (n > 1)
    times = lambda x: np.bincount(x, minlength=len(p.words))
    for b, data in _dealt(p.words, buckets, p.words, times(p.w_of), times(p.u[once]), times(p.w[once]), times(p.u[mine]), times(p.w[mine])):
        yield b, COUNTS, number, data
    used, at = np.unique(np.concatenate([p.u[many], p.w[many]]), return_inverse=True)
    if len(used):
        names, half = p.words[used], len(at) // 2
        for b, data in _dealt(names, buckets, names):
            yield b, LINK, number, data
        yield number, NAMES, 0, packed(names)
        yield number, PART, 0, packed(at[:half], at[half:], n[many], np.ones(half, np.int64), np.zeros(half, np.int64))


def _first_words(bucket: int, got):
    key, *columns = _joined(_blobs(got, COUNTS))
    order = np.argsort(key, kind="stable")
    first = _starts(key[order])
    key, (c, once_u, once_w, u, w) = key[order][first], (np.add.reduceat(x[order], first) for x in columns)
    for k, n in enumerate((c.sum(), len(c), (c == 1).sum(), (w == 1).sum(), (w == 2).sum(), w.sum())):
        yield k, STATS, int(n), None
    yield from _told(bucket, got, [key, c, once_u, once_w, u, w, np.ones_like(c)])


def _told(bucket: int, got, state: list[np.ndarray]):
    """The words' new state, and what the chunks need of it."""
    yield bucket, WORDS, 0, packed(*state)
    for origin, data in got.get(LINK, []):
        at = np.searchsorted(state[0], unpacked(data)[0])
        yield origin, ANSWER, bucket, packed(*(c[at] for c in state[4:7]))


def learn(docs: DataFrame, text_col: str = "text") -> Model:
    chunks = staged(_chunks(docs.select(F.lit(0).alias("id"), F.lit(False).alias("h"), text_col)), "lm-chunks", "zstd")
    model = _learn(chunks)
    discard(chunks)
    return model


def _learn(chunks: DataFrame) -> Model:
    """From the documents of the chunks that are not held out."""
    size, entries = sizes = _sizes(chunks)
    chunks = chunks.select("chunk", "held", "lengths", "words", "tokens")
    pair_buckets, buckets = _buckets(size), _buckets(entries)

    def asked(chunk):
        p = _pairs(*_learnt(chunk))
        for b, data in _dealt(p.key, pair_buckets, p.key, p.check, p.n):
            yield b, ASKED, chunk["chunk"], data

    pairs = staged(_by_key(_mapped(chunks, asked), _count), "lm-pairs", "zstd")

    def share(chunk, answers):
        return pa.Table.from_batches([_batch(list(_shared_out(chunk.to_pylist()[0], answers.to_pylist(), buckets)))])

    shared = staged(chunks.groupBy("chunk").cogroup(_of(pairs, ANSWER).groupBy("key")).applyInArrow(share, ROW), "lm-shares", "zstd")
    words = staged(_by_key(_of(shared, COUNTS, LINK), _first_words), "lm-words", "zstd")
    n, v, once, top_once, top_twice, types = (_stats(words).get(k, 0) for k in range(6))
    seen = _stats(pairs)
    shape = Shape(n, v, once / (once + v) if once else 1 / (v + 1), _discount(seen.get(1, 0), seen.get(2, 0)), _discount(top_once, top_twice))
    d, top_d, known = shape.d, shape.top_d, shape.known
    stirling, top_stirling = log_stirling(d), log_stirling(top_d)
    top_tables, top_customers = float(v), float(types)
    parts, top = shared, []

    for sweep in range(BURN + KEPT):
        def seat(number, got, sweep=sweep, tables=top_tables, customers=top_customers):
            (u, w, n, t, seated), (names,) = unpacked(got[PART][0][1]), unpacked(got[NAMES][0][1])
            of_u, of_w, of_top = _joined(_blobs(got, ANSWER))
            with np.errstate(over="ignore"):
                keys = names[w] ^ ((names[u] | np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
            t = draw_tables(n, np.maximum(0, of_u[u] - t), _in_parent(of_w, of_top, shape, tables, customers)[w], d, stirling, keys, 2 * sweep)
            seated = seated + t * (sweep >= BURN)
            sums = [np.bincount(x, t, len(names)).astype(np.int64) for x in (u, w)]
            for b, data in _dealt(names, buckets, *sums):
                yield b, SUMS, number, data
            if sweep < BURN + KEPT - 1:
                yield number, PART, 0, packed(u, w, n, t, seated)
            else:
                key, check = _pair_keys(names[u], names[w])
                order = _order(key, check)
                yield number, SEATS, 0, packed(key[order], check[order], seated[order])

        def add_up(bucket, got, sweep=sweep, all_=top_tables):
            key, c, once_u, once_w, _, tables, top_, *kept = unpacked(got[WORDS][0][1])
            u, w = once_u.copy(), once_w.copy()
            for (_, link), (_, sums) in zip(got.get(LINK, []), got.get(SUMS, [])):
                at = np.searchsorted(key, unpacked(link)[0])
                for x, more in zip((u, w), unpacked(sums)):
                    x[at] += more
            top_ = draw_tables(w, np.maximum(0, all_ - top_), np.full(len(w), known), top_d, top_stirling, key, 2 * sweep + 1)
            for k, total in enumerate((top_.sum(), w.sum())):
                yield k, STATS, int(total), None
            yield from _told(bucket, got, [key, c, once_u, once_w, u, w, top_, *kept, *([u, w, top_] if sweep >= BURN else [])])

        old = [words, *([parts] if sweep else [])]
        parts = staged(_by_key(_of(shared, NAMES).union(_of(parts, PART)).union(_of(words, ANSWER)), seat), "lm-seating", "zstd")
        words = staged(_by_key(_of(words, WORDS).union(_of(shared, LINK)).union(_of(parts, SUMS)), add_up), "lm-words", "zstd")
        top_tables, top_customers = (float(_stats(words).get(k, 0)) for k in range(2))
        if sweep >= BURN:
            top.append((top_tables, top_customers))
        for x in old:
            discard(x)
    discard(shared)
    return Model(_of(pairs, PAIRS), _of(parts, SEATS), _of(words, WORDS), shape, sizes, top)


def _in_parent(tables: np.ndarray, top: np.ndarray, shape: Shape, top_tables: float, top_customers: float) -> np.ndarray:
    return (tables - shape.top_d * top + (STRENGTH + shape.top_d * top_tables) * shape.known) / (STRENGTH + top_customers)


# --- scoring -----------------------------------------------------------------

def _answer(bucket: int, got):
    """What the model knows of the pairs (word buckets, below zero: of the words) that chunks ask for."""
    if bucket < 0:
        key, c, *rest = _joined(_blobs(got, WORDS), 7 + 3 * KEPT)
        order = np.argsort(key, kind="stable")
        key, known = key[order], [x[order] for x in (c, *rest[5:])]
        for origin, data in got.get(ASKED, []):
            (asked,) = unpacked(data)
            found, at = _find(key, np.zeros_like(known[0]), asked, np.zeros(len(asked), np.int64))
            yield origin, WORD_ANSWER, -1 - bucket, packed(*(np.where(found, x[at], 0) if len(key) else np.zeros(len(asked), np.int64) for x in known))
        return
    key, check, n = _joined(_blobs(got, PAIRS), 3)
    order = _order(key, check, "stable")
    key, check, n = key[order], check[order], n[order]
    seated = np.where(n == 1, KEPT, 0)
    key2, check2, seated2 = _joined(_blobs(got, SEATS), 3)
    _, at = _find(key, check, key2, check2)
    seated[at] = seated2
    for origin, data in got.get(ASKED, []):
        asked, check_ = unpacked(data)
        found, at = _find(key, check, asked, check_)
        yield origin, ANSWER, bucket, packed(*(np.where(found, x[at], 0) if len(key) else np.zeros(len(asked), np.int64) for x in (n, seated)))


def _answers(chunks: DataFrame, model: Model) -> DataFrame:
    pair_buckets, buckets = (_buckets(a + b) for a, b in zip(_sizes(chunks), model.sizes))
    out = None
    for turn in range(SLICES):
        def asked(chunk, turn=turn):
            p = _pairs(*_asked(chunk))
            for b, data in _dealt(p.key, pair_buckets, p.key, p.check):
                if b % SLICES == turn:
                    yield b, ASKED, chunk["chunk"], data
            for b, data in _dealt(p.words, buckets, p.words):
                if b % SLICES == turn:
                    yield -1 - b, ASKED, chunk["chunk"], data

        def known(row, turn=turn):
            columns, words = unpacked(row["data"]), row["kind"] == WORDS
            for b, data in _dealt(columns[0], buckets if words else pair_buckets, *columns):
                if b % SLICES == turn:
                    yield -1 - b if words else b, row["kind"], row["key"], data

        rows = _mapped(chunks.select("chunk", "words", "tokens"), asked)
        for t in (model.pairs, model.seats, model.words):
            rows = rows.union(_mapped(t, known))
        part = staged(_by_key(rows, _answer), "lm-answers", "zstd")
        out = part if out is None else out.union(part)
    return out


def _log_p(p: Pairs, answers: list[dict], shared: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Count of each word of the chunk (0 if unknown), and the log probability of each of its pairs (base 10)."""
    shape, tops = shared
    answers = sorted(answers, key=lambda a: a["origin"])
    n, seated = _joined([a["data"] for a in answers if a["kind"] == ANSWER])
    c, *kept = _joined([a["data"] for a in answers if a["kind"] == WORD_ANSWER])
    total = np.where(n > 0, (n - shape.d * seated / KEPT) / (STRENGTH + c[p.u]), 0.0)
    for k, (top_tables, top_customers) in enumerate(tops):
        u, w, top = kept[3 * k:3 * k + 3]
        left = np.where(c > 0, (STRENGTH + shape.d * u) / (STRENGTH + c), 1.0)
        unknown = (STRENGTH + shape.top_d * top_tables) * shape.unknown / (STRENGTH + top_customers)
        parent = np.where(c > 0, _in_parent(w, top, shape, top_tables, top_customers), unknown)
        total = total + left[p.u] * parent[p.w] / KEPT
    return c, np.log10(total)


def _finished(chunks: DataFrame, model: Model, of, schema: str) -> DataFrame:
    """What ``of`` makes of each chunk's row, its pairs, its words' counts and its pairs' log probabilities."""
    shared = model.shape, model.top

    def run(chunk, answers):
        p = _pairs(*_asked({c: chunk.column(c)[0].as_py() for c in ("words", "tokens")}))
        return pa.table(of(chunk, p, *_log_p(p, answers.to_pylist(), shared)))

    return chunks.groupBy("chunk").cogroup(_answers(chunks, model).groupBy("key")).applyInArrow(run, schema)


def log_probabilities(wanted: DataFrame, model: Model) -> DataFrame:
    """Distinct pairs (u, w) -> u, w, c (of the word, 0 if unknown), log_p (base 10)."""
    def run(batches):
        for i, b in enumerate(batches):
            u, w = (b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("u", "w"))
            words, at = np.unique(np.concatenate([u, w]), return_inverse=True)
            if len(words):
                yield pa.RecordBatch.from_pydict({"chunk": [(TaskContext.get().partitionId() << 32) + i], "size": [len(u)], "types": [len(words)],
                                                  "words": [packed(words)], "tokens": [packed(at[len(u):], at[:len(u)])]})

    def out(_, p, c, log_p):
        return {"u": p.words[p.u].view(np.int64), "w": p.words[p.w].view(np.int64), "c": c[p.w], "log_p": log_p}

    chunks = staged(wanted.select("u", "w").mapInArrow(run, "chunk long, size long, types long, words binary, tokens binary"), "lm-wanted")
    return _finished(chunks, model, out, "u long, w long, c long, log_p double")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    return _score(staged(_chunked(docs, id_col, text_col), "lm-chunks", "zstd"), model)


def _chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _chunks(docs.select(id_col, held_out(id_col).alias("h"), text_col))


def _score(chunks: DataFrame, model: Model) -> DataFrame:
    n, v = model.shape.tokens, model.shape.types

    def out(chunk, p, c, log_p):
        (lengths,) = unpacked(chunk.column("lengths")[0].as_py())
        add = lambda x: np.add.reduceat(x, np.cumsum(lengths) - lengths)
        return {"id": chunk.column("ids")[0].values, "held_out": chunk.column("held")[0].values, "n_tokens": lengths, "n_known": add((c[p.w_of] > 0).astype(np.int64)),
                "train_tokens": np.full(len(lengths), n), "base_score": add(np.log10(c + 1.0)[p.w_of]) - lengths * float(np.log10(n + v + 1)), "score": add(log_p[p.of])}

    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    return _finished(chunks, model, out, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_hpylm(spark, sf_dir: str) -> DataFrame:
    chunks = staged(_chunked(table(spark, sf_dir, "documents"), "doc_id", "text"), "lm-chunks", "zstd")
    model = _learn(chunks)
    out = _score(chunks, model).withColumnRenamed("id", "doc_id")
    for t in (model.pairs, model.seats, model.words):  # the answers are staged
        discard(t)
    return out
