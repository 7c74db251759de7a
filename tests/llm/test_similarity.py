"""SimHash, components and line dedup against brute force."""

import pathlib
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logloom.llm import common, line_dedup, queries, simhash
from logloom.llm.common import table
from logloom.llm.components import components
from logloom.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def slow_fingerprint(text, k=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))


def slow_components(prints, distance=4):
    """{row: least id} of (row, id, fp)."""
    u = Union()
    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= distance:
                u.join(i, j)
    least = {}
    for i, (d, _) in enumerate(prints):
        r = u.find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [least[u.find(i)] for i in range(len(prints))]


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (500, 501), (501, 500), (500, 501), (-5, 500)]
    edges += [(rng.randint(1000, 1080), rng.randint(1000, 1080)) for _ in range(60)]
    u = Union()
    for a, b in edges:
        u.join(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {n: u.find(n) for e in edges for n in e if n not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "A B c d", "a  b\tc\x0bd e", "x\xa0y z\x85w É", "w " * 500])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_simhash_query(spark):
    docs = table(spark, SF, "documents").orderBy("doc_id").collect()
    prints = [(d["doc_id"], slow_fingerprint(d["text"])) for d in docs]
    want = dict(zip((d for d, _ in prints), slow_components(prints)))
    rows = queries.QUERIES["op9_simhash"](spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {d: (f"{p:016x}", want[d]) for d, p in prints}


@pytest.mark.parametrize("block", [4, 1024])
def test_links_of_planted_fingerprints(spark, block):
    """Near copies, chains and a bucket beyond the block size; every component is found."""
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(150)]
    centre = rng.getrandbits(64)
    prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(120)]
    at = rng.getrandbits(64)
    for k in range(10):
        prints.append(at)
        at ^= sum(1 << b for b in rng.sample(range(64), 4))
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.links(nodes, 4, block)).collect()}
    want = slow_components(list(zip(signed, prints)))
    assert [got.get(x, x) for x in signed] == want
    for a, b in simhash.links(nodes, 4, block).toDF("x", "y").collect():
        assert ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 4


def test_thresholds_meet_the_general_pigeonhole(spark):
    rng = np.random.default_rng(1)
    bits = rng.random((3000, 64)) < np.where(np.arange(64) < 20, 0.05, 0.5)
    bits[:, 40] = bits[:, 41]
    common = (bits.astype(float).T @ bits)
    for n in (3000, 10 ** 9):
        for m in range(2, 6):
            groups = simhash.group_bits(common * n / 3000, n, m)
            assert sorted(b for g in groups for b in g) == list(range(64))
            assert any(40 in g and 41 in g for g in groups)
            cost, ts = simhash.deal_thresholds(common * n / 3000, n, groups, 4)
            assert sum(t + 1 for t in ts) == 5 and cost > 0


def test_simhash_edges(spark):
    rows = [(4, None), (3, ""), (None, " "), (9, "a b c d e"), (9, "a b c d e"), (None, "q r s t"), (8, "A b C d\te")]
    got = sorted(((r["id"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()), key=str)
    assert got == sorted([(4, 3), (3, 3), (None, 3), (9, 8), (9, 8), (8, 8), (None, None)], key=str)
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, fp int")
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 8]
    assert sorted(r["doc_id"] for r in simhash.dedup(docs.filter("doc_id in (3, 4, 8)")).collect()) == [3, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_keeps_every_class_whatever_its_ids(spark):
    """Unlinked texts under null ids, and under one repeated id, are classes of their own."""
    far = ["a b c d e", "q r s t u", "k l m n o"]
    rows = [(None, far[0]), (None, far[1]), (None, far[1]), (5, far[2]), (5, "v w x y z"), (6, "v w x y z")]
    prints = {slow_fingerprint(t) for _, t in rows}
    assert all(a == b or (a ^ b).bit_count() > simhash.DISTANCE for a in prints for b in prints)
    kept = simhash.dedup(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(
        [(None, far[0]), (None, far[1]), (5, far[2]), (5, "v w x y z")], key=str)


def slow_lines(docs):
    """{(row): removed positions}, for rows in order of id."""
    seen, kept_by = [], []
    u, lines = Union(), {}
    for i, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            n = " ".join(line.split()).lower()
            if n:
                lines.setdefault(n, []).append((i, k))
    every = list(lines)
    sets = [line_dedup.shingles(n) for n in every]
    for a in range(len(every)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
                u.join(a, b)
    groups = {}
    for a, n in enumerate(every):
        groups.setdefault(u.find(a), []).extend(lines[n])
    gone = {i: [] for i, _ in docs}
    for places in groups.values():
        for i, k in sorted(places)[1:]:
            gone[i].append(k)
    return {i: sorted(g) for i, g in gone.items()}


def test_line_dedup_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in table(spark, SF, "documents").orderBy("doc_id").collect()]
    want = slow_lines(docs)
    rows = {r["doc_id"]: r for r in queries.QUERIES["op8_line_dedup"](spark, SF).collect()}
    assert {i: r["removed_lines"] for i, r in rows.items()} == want
    for i, text in docs:
        assert rows[i]["text"] == "\n".join(line for k, line in enumerate(text.split("\n")) if k not in want[i])


@pytest.mark.parametrize("block", [3, 512])
def test_a_bucket_gives_its_links_whatever_the_block(block, monkeypatch):
    """Lines of several families in one bucket, met block by block: the components of all pairs."""
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng, lines = random.Random(9), []
    for f in range(4):
        words = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(30)]
        for k in range(8):
            lines.append(" ".join(words))
            words[rng.randrange(30)] = f"edit{f}{k}"
    rng.shuffle(lines)
    lines = list(dict.fromkeys(lines))
    rows = [(i, i, t) for i, t in enumerate(lines)]
    found = []
    for lo in range(0, len(rows), block):
        bucket = line_dedup._Bucket(rows[lo:lo + block])
        bucket.meet(rows[:lo] + rows[lo + block:])
        found += bucket.links
    want, got = Union(), Union()
    for i, a in enumerate(lines):
        for j in range(i):
            if line_dedup.jaccard(a, lines[j]) >= 0.8:
                want.join(i, j)
    for a, b in found:
        got.join(a, b)
        assert line_dedup.jaccard(lines[a], lines[b]) >= 0.8
    assert [got.find(i) for i in range(len(lines))] == [want.find(i) for i in range(len(lines))]


def test_line_dedup_links_beyond_a_buckets_least_line(spark):
    """A family of near lines where the ends of a chain are far apart, and short, blank and null ones."""
    rng = random.Random(2)
    base = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40))
    chain, lines = base.split(), []
    for k in range(14):
        lines.append(" ".join(chain))
        chain[3 * k % 40] = "new" + str(k)
    rng.shuffle(lines)
    docs = [(10 + k, f"{line}\n\n tiny \n{k}") for k, line in enumerate(lines)] + [(40, None), (41, ""), (42, "\n \n"), (43, "TINY"), (44, base.upper() + "  \r")]
    given = spark.createDataFrame([(i, t, i) for i, t in docs], "doc_id long, text string, removed_lines long")
    out = line_dedup.dedup_lines(given)
    assert out.columns == [*given.columns, "removed_lines_"]
    assert {r["doc_id"]: r["removed_lines_"] for r in out.collect()} == slow_lines(docs)
    twice = line_dedup.dedup_lines(spark.createDataFrame([(1, "a line\na line"), (1, "a line\na line"), (None, "a line")], DOC)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in twice) == [(0, ""), (1, "a line"), (1, "a line")]
    assert line_dedup.dedup_lines(given.limit(0)).count() == 0


def test_packed_shingles_give_the_similarity_of_their_sets():
    """Lines of 8-bit characters, beyond them, short ones and ones with zeros: the packed form is the exact set."""
    rng = random.Random(5)
    lines = ["abc", "abcdefgh", "\0abcdefgh", "äöüß" * 5]
    for k in range(40):
        line = rng.choices("abäö\0" + "Ω日" * (k % 3 == 0), k=rng.randrange(4, 60))
        lines += ["".join(line), "".join(line[:-1]) + "x"]
    near = {}
    for i, a in enumerate(lines):
        for j, b in enumerate(lines):
            x, y = line_dedup.shingles(a), line_dedup.shingles(b)
            near[i, j] = len(x & y) >= 0.8 * len(x | y)
            assert line_dedup.jaccard(a, b) == len(x & y) / len(x | y)
    for some in ([k for k, x in enumerate(lines) if line_dedup.packed(x) is not None], range(len(lines))):
        part = line_dedup._Part([(k, k, lines[k]) for k in some], list(some))
        for i in range(len(lines)):
            assert [part.n[j] for j in part.near(lines[i], -1)] == [j for j in some if near[i, j]]
        for place, i in enumerate(some):
            assert [part.n[j] for j in part.near_before(place, -1)] == [j for j in some if j < i and near[i, j]]


def test_a_texts_lines_are_split_once(spark):
    """The text is split in a column of its own, not again for each line that stays."""
    out = line_dedup.dedup_lines(spark.createDataFrame([(1, "a\nb\na"), (2, "b\nc")], DOC))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and "lambda" in plan
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, "a\nb"), (2, "c")]


def test_line_dedup_leaves_only_its_rows_on_disk(spark):
    """Staged tables go once the rows of lines stand, and shuffle files with the write that used them."""
    base = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "logloom"
    had = set(base.iterdir()) if base.exists() else set()
    docs = spark.createDataFrame([(k, f"a line of text that comes again and again {k % 3}\nb{k}") for k in range(30)], DOC)
    rows = line_dedup.line_classes(docs)
    left = [p.name.rsplit("-", 1)[0] for p in base.iterdir() if p not in had and any(p.rglob("*.parquet"))]
    assert left == ["line-classes"] and rows.count() == 60


def test_staging_clears_its_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {p for d in folders for p in pathlib.Path(d.getPath()).rglob("shuffle_*.data")}
    before = files()
    made = common.staged(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count(), "some")
    assert made.count() == 7 and spark.conf.get(common.CLEANUP, "false") == "false"
    deadline = time.time() + 20
    while len(files() - before) > 2 and time.time() < deadline:  # made.count() has one shuffle of its own
        time.sleep(0.2)
    assert len(files() - before) <= 2
