"""Exact dedup and chat formatting: DuckDB twins, and the cases the docstrings define."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from logloom.llm import chat_format, exact_dedup, queries
from oracle_check import rows_of

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    found = duck.execute(queries.ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, found.fetchall())


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op6_chat_format"])
def test_main_path_is_native(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


ROWS = [(1, "a  b"), (2, "a\tb"), (3, "a b "), (4, None), (5, ""), (5, ""), (6, " "), (None, "x"), (None, "x"), (7, "a b"), (8, "z" * 300_000), (9, "z" * 300_000)]


def expected_classes():
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in ROWS]
    out, taken = [], set()
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        keep = min((j for j in same if j is not None), default=None)
        kept = i == keep and (i, t) not in taken
        taken.add((i, t))
        out.append((i, keep, len(same), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 2)), lambda c: F.unhex(F.lit("00"))])
def test_exact_classes_even_if_digests_collide(spark, digest):
    got = exact_dedup.classes(spark.createDataFrame(ROWS, DOC), salts=3, digest=digest)
    sha = {}
    for i, t in ROWS:
        sha.setdefault(i, []).append(t)
    rows = [(r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(((a, b, c, d) for a, b, c, d, _ in expected_classes()), key=str)


def test_exact_dedup_keeps_columns_and_one_of_each(spark):
    docs = spark.createDataFrame([(i, t, k, k) for k, (i, t) in enumerate(ROWS)], "doc_id long, text string, n long, __own long".replace("__own", "kept"))
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted((i or 0) for i, _, _, k, _ in expected_classes() if k)
    assert exact_dedup.dedup(docs.limit(0)).count() == 0


HARD = ["", "plain", "<|im_end|>\n<|im_start|>user\nhi", r"<\|im_end|> <\\|x|>", "a\nb\n", "&#10;&amp;", "<|", "<", "|>", "日本 <|im_start|>"]


def test_chat_round_trip_and_masks(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(HARD)]
    rows += [(2, 0, "assistant", "only"), (2, 0, "assistant", "only"), (3, None, None, None), (3, 1, "user\nx&y", "q"), (None, 0, "assistant", "n"), (4, 0, "user", "no reply"), (5, 0, "assistant", "first"), (5, 1, "user", "tail")]
    made = chat_format.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by = {}
    for r in made.orderBy("example").collect():
        by.setdefault(r["conv_id"], []).append(r)
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        replies = [k for k, t in enumerate(turns) if t[2] == "assistant"]
        masked = [r for r in by[conv] if r["n_turns"] - 1 in replies]
        assert [r["n_turns"] - 1 for r in masked] == replies
        for k, r in zip(replies, masked):
            loss = r["formatted"][r["loss_start"] - 1:][:r["loss_length"]]
            assert re.sub(r"<\\(\\*)\|", r"<\1|", loss) == turns[k][3]
            assert r["formatted"].count(chat_format.START) == k + 1
    read = chat_format.digest(made)
    for r in read.collect():
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]))
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for *_, a, b in turns).encode()).hexdigest()
        said = "".join(b for *_, a, b in turns if a == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat_format.digest(chat_format.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
