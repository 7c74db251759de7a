"""Quality classifier by positive-unlabelled learning.

A text becomes shares of byte classes, of byte-class pairs and of how its words
repeat; a linear scorer g is fitted by minimising the non-negative unbiased
risk  prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))  with the logistic
loss, over trusted positives (labelled 1) and unlabelled web text: all documents
of the learning folds.  The class prior is the positives' share of the labelled
rows of the learning folds, with one of each added.

The features of the learning folds are staged once.  Their means, spreads and,
at each step, the unlabelled part of the risk, its gradient and its curvature
are sums over all of them: one small vector a task, added up in groups before
the driver adds the groups.  With the logistic loss the unbiased risk is convex,
so damped Newton steps take a dozen passes.  Where the bracket is negative, the
step goes against it, as the method asks; the scorer of the lowest non-negative
risk seen is kept.

``max_positives`` bounds the labelled rows that are fitted to: that many, the
first by hash, so the sample is the same at every run.  Scores are sigmoid(g),
for every document and its whole text.

Defined results: null text counts as empty; texts without words are scored like
others; rows with a null id are scored, not learnt from, and not held out; null
labels are no labels; without any labelled positive the score is sigmoid(0); an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from logloom.llm.common import ddl, discard, free_name, quoted, staged, table

FOLDS, HELD_OUT = 5, 0
KEEP_FROM = 0.3
MAX_POSITIVES = 8_000
ROUNDS, WEIGHT_DECAY = 8, 2e-2
#: Standardised features are cut to this.
FAR = 8.0
#: Tasks' sums are added up in so many groups on the way to the driver.
GROUPS = 32

_CLASSES = 11


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 10, np.uint8)  # controls
    kind[128:] = 0  # letters beyond ASCII, in UTF-8
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", ".,;:'\"-()", "!?", "|<>{}[]\\/_=", "#$%&*+@^`~")):
        kind[[ord(c) for c in chars]] = k + (k > 0)
    return kind


KIND = _byte_classes()
N_FEATURES = _CLASSES + _CLASSES * _CLASSES + 8


def features(text: str | None) -> np.ndarray:
    data = (text or "").encode()
    kind = KIND[np.frombuffer(data, np.uint8)]
    n = max(1, len(kind))
    single = np.bincount(kind, minlength=_CLASSES) / n
    pair = np.bincount(kind[:-1] * _CLASSES + kind[1:], minlength=_CLASSES * _CLASSES) / n if len(kind) else np.zeros(_CLASSES * _CLASSES)
    words = data.lower().split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = data.split(b"\n")
    again = sum(a == b for a, b in zip(words, words[1:]))
    shape = [
        len(counts) / m, again / m, max(counts.values(), default=0) / m,
        sum(map(len, words)) / m / 10, len(set(lines)) / len(lines),
        np.log1p(m) / 10, np.log1p(n / m) / 3, float(not words),
    ]
    return np.concatenate([np.sqrt(single), np.sqrt(pair), shape]).astype(np.float32)


def fold(id_col: str, folds: int = FOLDS) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def staged_features(docs: DataFrame, text_col: str) -> DataFrame:
    """x: the features of each text as 32-bit floats; fixed in size, whatever the text."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(t).tobytes() for t in b.column(0).to_pylist()], pa.binary())], ["x"])

    return staged(docs.select(quoted(text_col)).mapInArrow(run, "x binary"), "quality-features", "zstd")


def _rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, N_FEATURES).astype(np.float64)


def summed(table: DataFrame, part_of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``part_of(rows)``, a vector of ``size``, over all rows of a staged feature table."""
    def each(batches):
        total = np.zeros(size)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                total += part_of(_rows(b.column("x").slice(at, 4096)))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part % GROUPS], pa.int32()), pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["group", "part", "v"])

    def together(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        total = sum(np.frombuffer(v, np.float64) for v in t.column("v").to_pylist())
        return pa.table({"group": t.column("group")[:1], "v": pa.array([total.tobytes()], pa.binary())})

    sums = table.mapInArrow(each, "group int, part int, v binary").groupBy("group").applyInArrow(together, "group int, v binary")
    return sum((np.frombuffer(r["v"], np.float64) for r in sorted(sums.collect(), key=lambda r: r["group"])), np.zeros(size))  # GROUPS rows


def moments(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])


def standardised(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.hstack([np.clip((x - mean) / scale, -FAR, FAR), np.ones((len(x), 1))])


def negative_part(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over rows of the loss of calling them negative, of its gradient and of its curvature, in one vector."""
    g = x @ w
    p = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
    return np.concatenate([[np.logaddexp(0, g).sum()], x.T @ p, ((x * (p * (1 - p))[:, None]).T @ x).ravel()])


def _step(risk_p: tuple[float, np.ndarray], part_p: np.ndarray, part_u: np.ndarray, prior: float, w: np.ndarray) -> tuple[float, np.ndarray]:
    """The non-negative risk at w, and the step from there.  ``part_p``, ``part_u``: means of ``negative_part``; ``risk_p``: R_p(+) and its gradient."""
    k = len(w)
    bracket = part_u[0] - prior * part_p[0]
    slope = part_u[1:1 + k] - prior * part_p[1:1 + k]
    curve = part_u[1 + k:].reshape(k, k) + WEIGHT_DECAY * np.eye(k)
    risk = prior * risk_p[0] + max(0.0, bracket) + WEIGHT_DECAY / 2 * w @ w
    if bracket >= 0:
        return risk, -np.linalg.solve(curve, prior * risk_p[1] + slope + WEIGHT_DECAY * w)
    up = np.linalg.solve(curve, slope)
    return risk, -bracket / max(slope @ up, 1e-9) * up  # to where the bracket is zero, to first order


def fit(positives: np.ndarray, sums: Callable[[Callable[[np.ndarray], np.ndarray], int], np.ndarray], prior: float,
        rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias on raw features; ``sums(part_of, size)`` adds up a vector over all unlabelled rows."""
    d = positives.shape[1]
    total = sums(moments, 1 + 2 * d)
    n = total[0]
    mean = total[1:1 + d] / n
    scale = np.sqrt(np.maximum(total[1 + d:] / n - mean * mean, 0))
    scale[scale < 1e-4] = 1e9  # says nothing
    p = standardised(positives, mean, scale)
    k = d + 1
    w, best, pace = np.zeros(k), (np.inf, np.zeros(k), np.zeros(k)), 1.0
    for _ in range(rounds):
        part_u = sums(lambda x, w=w: negative_part(standardised(x, mean, scale), w), 1 + k + k * k) / n
        part_p = negative_part(p, w) / len(p)
        g = p @ w
        risk_p = np.logaddexp(0, -g).mean(), -p.T @ (1 / (1 + np.exp(np.clip(g, -40, 40)))) / len(p)
        risk, step = _step(risk_p, part_p, part_u, prior, w)
        if risk < best[0]:
            best = (risk, w, step)
            pace = min(1.0, 2 * pace)
        else:  # too far: half way back to the best
            pace /= 2
        if pace < 1 / 16 or np.abs(pace * best[2]).max() < 1e-4:
            break
        w = best[1] + pace * best[2]
    weights = best[1][:-1] / scale
    return weights, float(best[1][-1] - mean @ weights)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_positives: int = MAX_POSITIVES) -> tuple[np.ndarray, float]:
    learnt = docs.filter(fold(id_col) != HELD_OUT).select(id_col, text_col)
    known = labels.filter((fold(id_col) != HELD_OUT) & F.col(label_col).isNotNull()).select(id_col, label_col)
    n_known, n_positive = known.agg(F.count(F.lit(1)), F.sum((F.col(label_col) == 1).cast("int"))).first()
    if not n_positive:
        return np.zeros(N_FEATURES), 0.0
    prior = (n_positive + 1) / (n_known + 2)
    order = F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(1_000_000))
    picked = staged(known.filter(F.col(label_col) == 1).select(id_col).distinct().orderBy(order, id_col).limit(max_positives), "positives")
    chosen = staged_features(learnt.join(F.broadcast(picked), id_col), text_col)  # max_positives short ids
    positives = _rows(chosen.limit(2 * max_positives).toArrow().column("x"))
    if not len(positives):
        return np.zeros(N_FEATURES), 0.0
    unlabelled = staged_features(learnt, text_col)
    model = fit(positives, partial(summed, unlabelled), prior)
    discard(unlabelled)
    return model


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and last the score (``quality_score``, or the next free name)."""
    weights, bias = model
    columns = docs.columns
    name = free_name(columns, "quality_score")

    def run(batches):
        for b in batches:
            g = np.array([features(t) @ weights for t in b.column(text_col).to_pylist()], np.float64) + bias
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(g, -40, 40))))], [*columns, name])

    return docs.mapInArrow(run, ddl(docs, f"{name} double"))


def op7_pu_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
                         F.col("quality_score").alias("score"), (F.col("quality_score") >= KEEP_FROM).cast("int").alias("predicted"))
