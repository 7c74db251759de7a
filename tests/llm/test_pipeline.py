"""Each stage of the pipeline against brute force over what the stage before kept."""

import re

import corpus_pipeline
from logloom.llm import decontaminate, packing, pu_quality
from logloom.llm.common import staged, table

from test_similarity import slow_components, slow_fingerprint  # noqa: I001
from test_text_operators import check_packing

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    was = {d["doc_id"]: d for d in docs.collect()}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = frames[name] = staged(stage(spark, docs, SF), "test-stage")
        if name != "best-fit packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(was[d["doc_id"]] == d for d in docs.collect())
    ids = {n: sorted(r["doc_id"] for r in f.select("doc_id").distinct().collect()) for n, f in frames.items()}

    model = pu_quality.learn(table(spark, SF, "documents"), table(spark, SF, "labels"))
    scores = pu_quality.score(table(spark, SF, "documents").select("doc_id", "text"), model).collect()
    left = sorted(r["doc_id"] for r in scores if r["quality_score"] >= pu_quality.KEEP_FROM)
    assert ids["quality classifier"] == left and 0 < len(left) < len(was)

    first = {}
    for i in left:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", was[i]["text"]), i)
    left = sorted(first.values())
    assert ids["exact dedup"] == left

    prints = [(i, slow_fingerprint(was[i]["text"])) for i in left]
    left = sorted({c for c in slow_components(prints)})
    assert ids["SimHash near-dedup"] == left

    items = decontaminate.Items([(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()])
    left = [i for i in left if not items.matches(decontaminate.normal(was[i]["text"]))]
    assert ids["benchmark decontamination"] == left

    rows = frames["best-fit packing"].withColumnRenamed("doc_id", "id").collect()
    check_packing(rows, [(i, was[i]["text"]) for i in left], packing.SIZE)
