"""The quality classifier and the language model: held-out quality, brute force, edges."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from logloom.llm import hpylm, hpylm_words, pu_quality, queries
from logloom.llm.common import table

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOC = "doc_id long, text string"


def test_quality_of_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op7_pu_quality"](spark, LARGER).collect()}
    assert len(rows) == table(spark, LARGER, "documents").count()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, LARGER, "labels").collect()}
    good = [rows[i]["score"] for i, q in labels.items() if q == 1 and rows[i]["held_out"]]
    bad = [rows[i]["score"] for i, q in labels.items() if q == 0 and rows[i]["held_out"]]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.97 and np.mean([b < 0.3 for b in bad]) > 0.7


def test_risk_ignores_labels_of_unlabelled_rows():
    """Two normal classes, positives and a mix: the boundary lies between them, and the risk stays non-negative."""
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (4000, 3)), rng.normal(-1.5, 1, (4000, 3))
    mix = np.concatenate([good[:1200], bad[:2800]])
    weights, bias = pu_quality.fit(good[2000:3500], lambda part_of, size: part_of(mix), 0.3)
    test = lambda x: (x @ weights + bias > 0).mean()
    assert test(good[3500:]) > 0.9 and test(bad[2800:]) < 0.1


def test_risk_gradient_and_curvature_against_a_plain_loop():
    rng = np.random.default_rng(3)
    x, w = pu_quality.standardised(rng.normal(size=(40, 4)), np.zeros(4), np.ones(4)), rng.normal(size=5)
    loss, grad, curve = 0.0, [0.0] * 5, [[0.0] * 5 for _ in range(5)]
    for row in x.tolist():
        g = sum(a * b for a, b in zip(row, w))
        p = 1 / (1 + math.exp(-g))
        loss += math.log(1 + math.exp(g))
        for i in range(5):
            grad[i] += p * row[i]
            for j in range(5):
                curve[i][j] += p * (1 - p) * row[i] * row[j]
    assert np.allclose(pu_quality.negative_part(x, w), [loss, *grad, *sum(curve, [])])
    # The step's direction is downhill for the non-negative risk where the bracket is positive, uphill for the bracket where it isn't.
    u = pu_quality.standardised(rng.normal(size=(60, 4)), np.zeros(4), np.ones(4))

    def risks(w, prior):
        mean = lambda f: sum(f(sum(a * b for a, b in zip(r, w))) for r in x.tolist()) / len(x)
        bracket = sum(math.log(1 + math.exp(sum(a * b for a, b in zip(r, w)))) for r in u.tolist()) / len(u) - prior * mean(lambda g: math.log(1 + math.exp(g)))
        return prior * mean(lambda g: math.log(1 + math.exp(-g))) + max(0, bracket) + pu_quality.WEIGHT_DECAY / 2 * sum(v * v for v in w), bracket

    signs = set()
    for prior, at in ((0.3, np.zeros(5)), (0.3, w), (0.9, 4 * w), (0.95, -4 * w)):
        g = x @ at
        risk_p = np.logaddexp(0, -g).mean(), -x.T @ (1 / (1 + np.exp(g))) / len(x)
        risk, step = pu_quality._step(risk_p, pu_quality.negative_part(x, at) / len(x), pu_quality.negative_part(u, at) / len(u), prior, at)
        before, after = risks(at, prior), risks(at + 1e-4 * step, prior)
        assert math.isclose(risk, before[0], rel_tol=1e-9)
        signs.add(before[1] >= 0)
        assert after[0] < before[0] if before[1] >= 0 else after[1] > before[1]
    assert signs == {True, False}


def test_sums_cover_all_unlabelled_rows(spark):
    docs = spark.createDataFrame([(f"word {i} " * (i % 7),) for i in range(300)], "text string").repartition(50)
    rows = pu_quality.staged_features(docs, "text")
    x = np.array([pu_quality.features(r["text"]) for r in docs.collect()], np.float64)
    assert np.allclose(pu_quality.summed(rows, pu_quality.moments, 1 + 2 * pu_quality.N_FEATURES), pu_quality.moments(x))


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "Good words here, and more.", 0.5), (2, "Good words there, and more.", 0.5), (3, None, 0.5), (None, "", 0.5), (4, "x " * 50_000, 0.5), (4, "x " * 50_000, 0.5)],
                                 "doc_id long, text string, quality_score double")
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, None), (None, 1), (4, 0)], "doc_id long, quality int")
    model = pu_quality.learn(docs, labels)
    out = pu_quality.score(docs, model)
    assert out.columns == [*docs.columns, "quality_score_"]
    rows = out.collect()
    assert len(rows) == 6 and all(0 <= r["quality_score_"] <= 1 for r in rows)
    nothing = pu_quality.learn(docs, labels.limit(0))
    assert {r["quality_score_"] for r in pu_quality.score(docs, nothing).collect()} == {0.5}
    assert pu_quality.score(docs.limit(0), pu_quality.learn(docs.limit(0), labels)).count() == 0


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w] + ["\n"]


def test_language_model_query(spark):
    docs = table(spark, LARGER, "documents").collect()
    rows = {r["doc_id"]: r for r in queries.QUERIES["op3_hpylm"](spark, LARGER).collect()}
    out = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in docs}
    c = Counter(w for d in docs if not out[d["doc_id"]] for w in words_of(d["text"]))
    n, v = sum(c.values()), len(c)
    ours = base = 0
    for d in docs:
        r, words = rows[d["doc_id"]], words_of(d["text"])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[d["doc_id"]], len(words), sum(c[w] > 0 for w in words), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
        if r["held_out"]:
            ours, base = ours + r["score"], base + r["base_score"]
    assert ours > base


def test_tables_follow_the_conditional():
    """The blocked draw's frequencies against the conditional worked out by enumeration."""
    d, parent, others, n = 0.6, 0.05, 7.0, 4
    s = np.exp(hpylm.log_stirling(d))
    weight = np.array([s[n, t] * np.prod([1 + d * (others + i) for i in range(t)]) * parent ** t for t in range(1, n + 1)])
    keys = np.arange(40_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    drawn = hpylm.draw_tables(np.full(40_000, n), np.full(40_000, others), np.full(40_000, parent), d, hpylm.log_stirling(d), keys, 1)
    got = np.bincount(drawn, minlength=n + 1)[1:] / 40_000
    assert np.abs(got - weight / weight.sum()).max() < 0.01
    many = hpylm.draw_tables(np.full(2000, 100_000), np.full(2000, 50.0), np.full(2000, 0.01), d, hpylm.log_stirling(d), keys[:2000], 1)
    assert 1 <= many.min() and many.max() <= 100_000 and 1 < many.mean() < 1000


def test_the_previous_word_is_the_context(spark):
    """Probabilities sum to one in every context, and contexts that end alike differ."""
    texts = [(k, t) for k, t in enumerate(["the cat sat on the mat", "one dog sat", "The cat, the dog. the cat", None, "a " * 400 + "b", "it is the cat " * 30])]
    docs = spark.createDataFrame(texts, DOC)
    model = hpylm_words.learn(docs)
    c = Counter(w for _, t in texts for w in words_of(t))
    names = [*c, "never seen"]
    ids = [hpylm_words.word_id(w) for w in names]
    wanted = spark.createDataFrame([(u, w) for u in ids for w in ids], "u long, w long")
    log_p = {(r["u"], r["w"]): r["log_p"] for r in hpylm_words.log_probabilities(wanted, model).collect()}
    log_p = {(a, b): log_p[i, j] for a, i in zip(names, ids) for b, j in zip(names, ids)}
    for u in names:
        assert math.isclose(sum(10 ** log_p[u, w] for w in names), 1, rel_tol=1e-9)
    assert log_p["the", "cat"] > log_p["one", "cat"] + 0.5 and log_p["one", "dog"] > log_p["the", "dog"]
    asked = [*texts, (90, "a new word, the cat"), (None, "the cat"), (None, "the cat"), (91, "x" * 100_000)]
    want = []
    for i, t in asked:
        ws = [w if w in c else "never seen" for w in words_of(t)]
        want.append((i, len(ws), sum(w in c for w in ws), round(sum(log_p[u, w] for u, w in zip(["\n", *ws], ws)), 6)))
    got = hpylm_words.score(spark.createDataFrame(asked, DOC), model).collect()
    assert sorted(((r["id"], r["n_tokens"], r["n_known"], round(r["score"], 6)) for r in got), key=str) == sorted(want, key=str)
    empty = hpylm_words.learn(docs.limit(0))
    assert [(r["score"], r["base_score"]) for r in hpylm_words.score(spark.createDataFrame([(1, "a b")], DOC), empty).collect()] == [(0, 0)]
    assert hpylm_words.score(docs.limit(0), model).count() == 0


def test_held_out_text_gains_from_the_previous_word(spark):
    """The last character alone gives some -3.2 a token (log10)."""
    rows = [r for r in queries.QUERIES["op3_hpylm"](spark, LARGER).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) / sum(r["n_tokens"] for r in rows) > -3.0


def some_texts():
    rng = np.random.default_rng(3)
    return [(int(k), " ".join(f"w{x}" for x in rng.zipf(1.3, 400) % 3000)) for k in range(100)] + [(None, None), (5, "w1 w2"), (5, "w1 w2"), (200, "new words")]


def test_chunks_and_buckets_do_not_matter(spark, monkeypatch):
    docs = spark.createDataFrame(some_texts(), DOC).repartition(3)
    got = []
    for chunk, bucket, turns in ((2_000_000, 500_000, 2), (900, 700, 3)):
        for name, value in (("CHUNK", chunk), ("BUCKET", bucket), ("SLICES", turns)):
            monkeypatch.setattr(hpylm_words, name, value)
        out = hpylm_words.score(docs, hpylm_words.learn(docs.filter("doc_id % 7 < 5 or doc_id is null")))
        got.append(sorted(([str(r["id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)] for r in out.collect())))
    assert got[0] == got[1] and len(got[0]) == 104


def test_no_row_for_each_pair_of_a_document(spark, monkeypatch):
    """Rows are made by chunk and bucket; a row per pair and document took over four times the input of disk."""
    docs = spark.createDataFrame(some_texts(), DOC).repartition(2)
    tables = []
    monkeypatch.setattr(hpylm_words, "discard", lambda df: None)
    monkeypatch.setattr(hpylm_words, "staged", lambda *a, before=hpylm_words.staged: tables.append(before(*a)) or tables[-1])
    out = hpylm_words.score(docs, hpylm_words.learn(docs))
    assert sum(r["n_tokens"] for r in out.collect()) == 100 * 401 + 1 + 3 + 3 + 3
    assert len(tables) > 3 and max(t.count() for t in tables) < 200
