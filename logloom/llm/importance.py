"""Target-distribution importance resampling over hashed n-grams, from prefix CRCs.

A text is brought to words with one separator before each and scanned once: the
running CRC-32 after every word is stored.  CRC-32 is linear over GF(2), so the
CRC of the words i..j is the running one after j, with the running one before i
shifted over as many bytes cancelled out of it; no n-gram is ever built or
hashed itself.  Shifting by a number of bytes is a linear map, looked up byte by
byte (short lengths) or composed from maps for powers of two (any length).

1. Every task adds up its buckets; a bucket's sums over all documents and over
   the whole target follow one shuffle of ``buckets`` rows a task.
2. A bucket's gain is the scaled log ratio of its smoothed shares; a document's
   weight is the mean of its features' gains, its score that plus Gumbel noise
   seeded by its id, so the highest scores are a sample without replacement
   in proportion to exp(weight).
3. Scores have few distinct values, bounded by the formula: their histogram
   gives the lowest score drawn, and only rows from there up are ordered, in
   sampled ranges.

Defined results: null text has no words, so weight 0; a null id is hashed as the
empty string and is the largest among ties; rows that repeat an id share its
noise, and fall in any order where all else is equal; an empty table gives no
rows, an empty target leaves all smoothed gains to the documents' counts; further columns
are ignored.  The driver holds ``buckets`` counts and the histogram of scores.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logloom.llm.common import in_order, quoted, running_sum, staged, table

MAX_N, BUCKETS, SEED = 2, 10_000, 7
MIN_WORDS, PERCENT, GAIN_SCALE = 20, 25, 1000
#: Lengths up to this have a table of their own.
SHORT = 64
#: A task looks at so many words at once, or at one longer text.
AT_ONCE = 400_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
#: Lower-cases A-Z and makes every byte outside words a space.
NORMAL = bytes(c if c in _KEPT else 0x20 for c in _LOWER)
PIECE = re.compile(rb" [^ ]+")


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    """The linear part of one more byte: a running CRC over a zero byte, without its constants."""
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (crc & np.uint32(1)))
    return crc


def _lookup(columns: np.ndarray) -> np.ndarray:
    """Four tables of 256 for the linear map with these images of the 32 bits."""
    out = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        hit = (np.arange(256) >> (bit % 8) & 1).astype(bool)
        out[bit // 8, hit] ^= columns[bit]
    return out


def _mapped(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & np.uint32(255)]
    for k in (1, 2, 3):
        out ^= tables[k][crc >> np.uint32(8 * k) & np.uint32(255)]
    return out


class Shifts:
    """Running CRCs shifted over any number of bytes."""

    def __init__(self) -> None:
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        self.powers = [_lookup(_zero_byte(bits))]  # over 2**k bytes
        for _ in range(31):
            tables = self.powers[-1]
            self.powers.append(_lookup(_mapped(tables, _mapped(tables, bits))))
        short = [bits]
        for _ in range(SHORT - 1):
            short.append(_zero_byte(short[-1]))
        self.short = np.stack([_lookup(c) for c in short], 1).reshape(4, -1)  # by byte: length * 256 + value

    def over(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        long = length >= SHORT
        row = np.where(long, 0, length).astype(np.int64) << 8
        out = self.short[0][row + (crc & np.uint32(255))]
        for k in (1, 2, 3):
            out ^= self.short[k][row + (crc >> np.uint32(8 * k) & np.uint32(255))]
        if long.any():
            c, n = crc[long], length[long].astype(np.int64)
            for k, tables in enumerate(self.powers):
                if (hit := (n >> k & 1).astype(bool)).any():
                    c[hit] = _mapped(tables, c[hit])
            out[long] = c
        return out


def running_crcs(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """After each word the CRC of all the text so far, and the words' lengths in bytes."""
    pieces = PIECE.findall(b" " + (text or "").encode().translate(NORMAL))
    crcs = np.fromiter(accumulate(pieces, lambda crc, piece: zlib.crc32(piece, crc), initial=0), np.uint32, len(pieces) + 1)
    return crcs[1:], np.fromiter(map(len, pieces), np.uint32, len(pieces)) - np.uint32(1)


def ngram_crcs(crcs: np.ndarray, lengths: np.ndarray, words: np.ndarray, max_n: int, shifts: Shifts) -> tuple[np.ndarray, np.ndarray]:
    """CRCs of all n-grams of texts laid end to end, and the number of the text each belongs to.

    ``words``: how many of the running CRCs belong to each text.
    """
    text = np.repeat(np.arange(len(words)), words)
    begins = np.zeros(len(crcs), bool)
    begins[(np.cumsum(words) - words)[words > 0]] = True
    before = np.zeros(len(crcs), np.uint32)
    before[1:] = crcs[:-1]
    before[begins] = 0
    # The running CRC after the separator before each word.
    before = _mapped(shifts.powers[0], before) ^ np.uint32(zlib.crc32(b" "))
    ends = np.cumsum(lengths.astype(np.int64) + 1)
    starts = ends - lengths
    found, owner = [], []
    for n in range(1, max_n + 1):
        last = len(crcs) - n + 1
        if last <= 0:
            break
        whole = text[:last] == text[n - 1:]
        i = np.flatnonzero(whole)
        j = i + n - 1
        found.append(crcs[j] ^ shifts.over(before[i], ends[j] - starts[i]))
        owner.append(text[i])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owner)


def scanned(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """(id, at, words, crcs, lengths), staged: each text scanned once.  ``at`` numbers the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [running_crcs(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(c) for c, _ in got], pa.int64()), pa.array([c.tobytes() for c, _ in got], pa.binary()),
                 pa.array([n.tobytes() for _, n in got], pa.binary())], ["id", "words", "crcs", "lengths"])

    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    made = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, words long, crcs binary, lengths binary")
    return staged(made.withColumn("at", F.monotonically_increasing_id()), name, "zstd")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``AT_ONCE`` words."""
    for b in batches:
        upto = np.cumsum(np.asarray(b.column("words")))
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + AT_ONCE, "right")))
            yield b.slice(at, end - at)
            at = end


def _features(b: pa.RecordBatch, max_n: int, buckets: int, shifts: Shifts) -> tuple[np.ndarray, np.ndarray]:
    crcs, lengths = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32) for c in ("crcs", "lengths"))
    found, owner = ngram_crcs(crcs, lengths, np.asarray(b.column("words")), max_n, shifts)
    return (found % np.uint32(buckets)).astype(np.int64), owner


def bucket_counts(scan: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many features, repeats counted, of all texts fall in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, total = Shifts(), np.zeros(buckets, np.int64)
        for b in _slices(batches):
            total += np.bincount(_features(b, max_n, buckets, shifts)[0], minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(total[full])], ["bucket", "n"])

    rows = scan.select("words", "crcs", "lengths").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(all_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
    buckets, all_n, target_n = len(all_counts), int(all_counts.sum()), int(target_counts.sum())
    return np.array([math.floor(GAIN_SCALE * math.log(float(t + 1) * float(all_n + buckets) / (float(s + 1) * float(target_n + buckets))))
                     for s, t in zip(all_counts.tolist(), target_counts.tolist())], np.int64)


def noise(doc_id: object, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-GAIN_SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(scan: DataFrame, gain: np.ndarray, max_n: int = MAX_N, seed: int = SEED) -> DataFrame:
    """(id, at, words, n_features, weight, score) per document."""
    known = scan.sparkSession.sparkContext.broadcast(gain)  # 8 bytes a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, gain = Shifts(), known.value
        for b in _slices(batches):
            found, owner = _features(b, max_n, len(gain), shifts)
            n = np.bincount(owner, minlength=b.num_rows)
            total = np.zeros(b.num_rows, np.int64)
            np.add.at(total, owner, gain[found])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            score = weight + np.array([noise(i, seed) for i in b.column("shown").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("at"), b.column("words"), pa.array(n, pa.int64()), pa.array(weight), pa.array(score)],
                                             ["id", "at", "words", "n_features", "weight", "score"])

    kind = scan.schema["id"].dataType.simpleString()
    return scan.select("id", "at", "words", "crcs", "lengths", F.col("id").cast("string").alias("shown")).mapInArrow(
        run, f"id {kind}, at long, words long, n_features long, weight long, score long")


def drawn(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored``, staged, with ``rank``: 1, 2, ... among the highest scores that are drawn, else null."""
    fit = F.col("words") >= min_words
    histogram = sorted(((r["score"], r["n"]) for r in scored.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    left = percent * sum(n for _, n in histogram) // 100
    draws, least = left, None
    for score, n in histogram:
        if left <= 0:
            break
        least, left = score, left - n
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    among = fit & (F.col("score") >= least)
    laid = in_order(scored.filter(among), [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("at")], "resample-order")
    rank = running_sum(laid, [], F.lit(1).cast("long"), "rank").withColumn("rank", F.col("rank") + 1)
    ranked = rank.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank"))).drop("part", "pos")
    return ranked.unionByName(scored.filter(~among).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             max_n: int = MAX_N, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: id, words, n_features, weight, score, rank."""
    scan = scanned(docs, id_col, text_col, "resample-scan")
    aim = scanned(target.select(F.lit(0).alias("id"), target_text_col), "id", target_text_col, "resample-target")
    gain = gains(bucket_counts(scan, max_n, buckets), bucket_counts(aim, max_n, buckets))
    return drawn(staged(weighted(scan, gain, max_n, seed), "resample-scored"), percent, min_words).drop("at")


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
