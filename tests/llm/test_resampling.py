"""Centroids, importance resampling and source mixing: brute force, exact identities, the cases the docstrings define."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import centroids, importance, mixing

SF = "/root/testdata/sf0.001"
SHIFTS = importance.Shifts()


# --- centroids ---------------------------------------------------------------

def plain_clusters(rows, k, rounds, seed=centroids.SEED):
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    at = [list(v) for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for left in range(rounds, -1, -1):
        own = [min(range(len(at)), key=lambda j: (far(v, at[j]), j)) for _, v in rows]
        if left:
            for j in range(len(at)):
                if mine := [v for (_, v), o in zip(rows, own) if o == j]:
                    at[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return Counter((i, o, far(v, at[o])) for (i, v), o in zip(rows, own)), at


@pytest.mark.parametrize("n,k,rounds", [(60, 4, 3), (5, 8, 10), (40, 3, 0), (1, 8, 2)])
def test_clusters_match_a_plain_loop(spark, n, k, rounds):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(n)] + [(0, [0.5, -0.25, 0.0])] * 2
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    found, at = centroids.cluster(df, "id", "v", dims=3, k=k, rounds=rounds)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want, centres = plain_clusters(whole, k, rounds)
    assert Counter(tuple(r) for r in found.select("id", "cluster", "distance").collect()) == want
    assert at.tolist() == centres


def test_vectors_that_count(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, None]), (3, [1.0, float("nan")]), (4, [1.0, float("inf")]), (5, None), (6, [1.0]), (7, []), (None, [0.0, 0.0]), (1, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "id int, v array<float>").withColumn("cluster", F.lit("x")).withColumn("sums", F.lit(None).cast("string"))
    found, at = centroids.cluster(df, "id", "v", dims=2, k=2)
    assert sorted(map(tuple, found.collect()), key=str) == [(1, 1, 0), (1, 1, 0), (None, 0, 0)]
    assert at.tolist() == [[0, 0], [1024, 2048]]
    empty, at = centroids.cluster(df.filter("id > 9"), "id", "v", dims=2)
    assert empty.collect() == [] and at.shape == (0, 2)


def test_too_large_a_component_is_refused(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], "id long, v array<double>"), "id", "v", dims=2)


def test_only_moved_components_are_added():
    rng = np.random.default_rng(1)
    v, old = rng.integers(-900, 900, (50, 16)), rng.integers(-900, 900, (4, 16))
    new = old.copy()
    new[1, [2, 7]] += 5
    assert (centroids.update(v @ old.T, v, new - old) == v @ new.T).all()


# --- importance resampling ---------------------------------------------------

def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_features(text, max_n=2):
    w = plain_words(text)
    return [" ".join(w[i:i + n]).encode() for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


TEXTS = ["", None, "One", "A b-C\tÄÖ 日本語 x", "w" * 5000 + " " + "é" * 70 + " end", "same same same", "\x00\x7f..", "1 2 3 " * 400, " lead trail "]


@pytest.mark.parametrize("max_n", [1, 2, 3, 5])
def test_ngram_crcs_equal_those_of_the_ngrams(max_n):
    got = [importance.running_crcs(t) for t in TEXTS]
    words = np.array([len(c) for c, _ in got])
    crcs, owner = importance.ngram_crcs(np.concatenate([c for c, _ in got]), np.concatenate([n for _, n in got]), words, max_n, SHIFTS)
    for k, t in enumerate(TEXTS):
        assert sorted(crcs[owner == k].tolist()) == sorted(zlib.crc32(f) for f in plain_features(t, max_n))


def test_shift_cancels_any_prefix():
    a, b = b"prefix of any kind", b"x" * 100_003
    whole = np.array([zlib.crc32(a + b)], np.uint32)
    assert (whole ^ SHIFTS.over(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)], np.uint32)))[0] == zlib.crc32(b)


def plain_resample(docs, target, percent=25, min_words=20, buckets=10_000, seed=7):
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            counts.update(zlib.crc32(f) % buckets for f in plain_features(x))
    big_s, big_t, out = sum(s.values()), sum(t.values()), []
    for i, text in docs:
        f = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in (zlib.crc32(x) % buckets for x in plain_features(text))]
        weight = sum(f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(text))])
    among = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(among[:percent * len(among) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


def test_resampling_matches_brute_force(spark):
    got = importance.op12_importance_resampling(spark, SF)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    assert Counter(tuple(r) for r in got.collect()) == plain_resample(docs, target)


def test_resampling_edges(spark):
    rows = [(k if k % 5 else None, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3])] * 2 + [(20 + k, f"word {k} " * 15) for k in range(9)] + [(20, "word 0 " * 15)] * 3
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    target = spark.createDataFrame([("word 3 word 3",), (None,)], "text string")
    wide = docs.withColumn("score", F.lit("x")).withColumn("at", F.lit(0)).withColumn("words", F.lit(None).cast("string"))
    for some in (target, target.filter("false")):
        got = importance.resample(wide.repartition(4), some).select("id", "n_features", "weight", "score", "rank")
        assert Counter(tuple(r) for r in got.collect()) == plain_resample(rows, [r[0] for r in some.collect()])
    assert importance.resample(docs.filter("false"), target).collect() == []
    few = importance.resample(docs.filter("doc_id = 2"), target)
    assert [r["rank"] for r in few.collect()] == [None]


# --- mixing ------------------------------------------------------------------

def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, clamped = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in clamped)
        shares = sum(w[s] for s in sizes if s not in clamped)
        target = {s: cap * sizes[s] if s in clamped else w[s] * rest / shares for s in sizes}
        above = {s for s in sizes if s not in clamped and target[s] > cap * sizes[s]}
        if not above:
            return target
        clamped |= above


def mixed_rows(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("own")).withColumn("part", F.lit(1))
    return df, mixing.mix(df.repartition(5), **more)


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken_words(spark, seed):
    rng = np.random.default_rng(seed)
    names = ["a", "b", "B", "é", "z", None, "", "q"]
    share = rng.dirichlet(np.ones(len(names)) * 0.5)
    rows = [(i, "w " * int(rng.integers(1, 60)), names[rng.choice(len(names), p=share)]) for i in range(400)]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    target = plain_targets(sizes)
    got = mixed_rows(spark, rows)[1].collect()
    assert sorted(r["id"] for r in got) == list(range(400))
    taken, most, own = Counter(), defaultdict(int), {i: (len(t.split()), s) for i, t, s in rows}
    for r in got:
        assert (r["size"], r["source"]) == own[r["id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["repetitions"] <= 3
        assert r["repetitions"] in (math.floor(r["target"] / r["source_size"]), math.floor(r["target"] / r["source_size"]) + 1)
        taken[r["source"]] += r["size"] * r["repetitions"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= most[s]


def test_reruns_agree_however_rows_are_dealt(spark):
    rows = [(i, "w " * (i % 37 + 1), "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [Counter(tuple(r) for r in mixing.mix(df.repartition(n)).collect()) for n in (1, 7)]
    assert runs[0] == runs[1]


def test_mixing_edges(spark):
    rows = [(None, "a b", "x"), (None, "a b", "x"), (1, None, None), (2, "", "y"), (3, " \t", "y"), (4, "long " * 200_000, "z"), (5, "a", None), (5, "a", None)]
    df, got = mixed_rows(spark, rows)
    assert Counter((r["id"], r["source"], r["size"]) for r in got.collect()) == Counter(
        [(None, "x", 2)] * 2 + [(1, None, 0), (2, "y", 0), (3, "y", 0), (4, "z", 200_000)] + [(5, None, 1)] * 2)
    whole = mixing.repeated(df, got)
    assert whole.columns == [*df.columns, "repetition"]
    want = Counter()
    for r in got.collect():
        want[(r["id"], r["source"])] += r["repetitions"]
    assert Counter((r["doc_id"], r["source"]) for r in whole.collect()) == +want
    assert mixing.mix(df.filter("false")).collect() == []
    nothing = mixing.mix(df.filter("doc_id in (2, 3)")).collect()
    assert [(r["target"], r["source_size"]) for r in nothing] == [(0.0, 0)] * 2


def test_word_count_is_that_of_the_contract(spark):
    texts = ["", " ", "a", " a", "a ", "a\x1cb c", "a b\tc\n\nd ", "\x0b\x0cx\r"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(F.col("t"))).collect()
    assert [r[0] for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
