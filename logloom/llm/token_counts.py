"""Token counts without token ids: count the pieces of each distinct pre-token once.

A pre-token is a run of separators (space, newline, U+2581) with the text up to
the next run, of the text with one space in front.  No piece of the vocabulary
goes on from a non-separator to a separator, and none holds a newline
(``check_cuts`` refuses a model where that fails), so no merge crosses a cut
and the counts of a text's pre-tokens add up to that of the text.

1. Each task counts its pre-tokens; the sums per distinct pre-token follow one
   shuffle of those, and each distinct pre-token is encoded once.
2. The ``head`` most frequent pre-tokens of at most 64 bytes are broadcast with
   their counts (at most 64 B x ``head``); per document, their part of the sum
   is taken on the spot.  All other per-document frequencies are joined to the
   table of counts and summed.

Defined results: null text counts as empty (0 tokens); repeated rows and null
ids stay rows of their own; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from logloom.llm.common import staged, table

LIMIT = 4096
HEAD, HEAD_BYTES = 262_144, 64
#: A task hands on its counts when it holds so many pre-tokens.
FLUSH = 400_000
CUT = re.compile("[ \n▁]+[^ \n▁]*")


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_cuts(model) -> None:
    for i in range(model.get_piece_size()):
        if re.search("[^▁]▁|\n", model.id_to_piece(i)):
            raise ValueError(f"a piece crosses a cut: {model.id_to_piece(i)!r}")


def pretokens(text: str) -> list[str]:
    return CUT.findall(" " + text) if text else []


def piece_counts(model, segments: list[str]) -> list[int]:
    """Pieces of each pre-token where it stands in a text.

    The library puts a space in front of what it encodes, unless that is empty:
    it stands for the pre-token's own, or is kept apart by a newline and taken
    off again.
    """
    own = [len(s) > 1 and s[0] == " " for s in segments]
    asked = [s[1:] if o else "\n" + s for s, o in zip(segments, own)]
    return [len(ids) - (0 if o else 2) for o, ids in zip(own, model.encode(asked, num_threads=1))]


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["seg", "n"])
        seen.clear()
        return made

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                seen.update(pretokens(text))
            if len(seen) >= FLUSH:
                yield out()
    if seen:
        yield out()


def count_pieces(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """seg, n, pieces: one row per distinct pre-token of all documents."""
    def encode(batches):
        model = load(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(piece_counts(model, b.column(0).to_pylist()), pa.int32())], ["seg", "n", "pieces"])

    seen = docs.select(text_col).mapInArrow(_vocabulary, "seg string, n long")
    return seen.groupBy("seg").agg(F.sum("n").alias("n")).mapInArrow(encode, "seg string, n long, pieces int")


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens."""
    check_cuts(load(path))
    spark = docs.sparkSession
    pieces = staged(count_pieces(docs, path, text_col), "pieces")
    top = (pieces.filter(F.octet_length("seg") <= HEAD_BYTES).orderBy(F.desc("n"), "seg").limit(head)
           .select("seg", "pieces").toArrow())
    known = spark.sparkContext.broadcast(dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist())))

    def frequencies(batches):
        """A row per document, with what the head covers; its segment begins with
        no separator, so it meets none.  A row per other pre-token of it."""
        get, at = known.value.get, TaskContext.get().partitionId() << 40
        for b in batches:
            kind = b.schema.field(0).type
            keys, ids, sizes, sums, segs, times = [], [], [], [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own, at, total = at, at + 1, 0
                for seg, k in Counter(pretokens(text or "")).items():
                    if (p := get(seg)) is None:
                        keys.append(own), ids.append(None), sizes.append(None), sums.append(0), segs.append(seg), times.append(k)
                    else:
                        total += p * k
                keys.append(own), ids.append(doc), sizes.append(len((text or "").encode())), sums.append(total)
                segs.append(str(own & 0xFFF)), times.append(0)
                if len(keys) > 200_000:
                    yield made(kind, keys, ids, sizes, sums, segs, times)
                    keys, ids, sizes, sums, segs, times = [], [], [], [], [], []
            yield made(kind, keys, ids, sizes, sums, segs, times)

    id_type = docs.schema[id_col].dataType

    def made(kind, keys, ids, sizes, sums, segs, times):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(ids, kind), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
             pa.array(segs, pa.string()), pa.array(times, pa.int32())], ["key", "id", "n_bytes", "sum", "seg", "k"])

    rows = docs.select(id_col, text_col).mapInArrow(
        frequencies, f"key long, id {id_type.simpleString()}, n_bytes long, sum long, seg string, k int")
    own = F.col("sum") + F.col("k") * F.coalesce("pieces", F.lit(0))
    return (rows.join(pieces.select("seg", "pieces"), "seg", "left").groupBy("key")
            .agg(F.max("id").alias("id"), F.max("n_bytes").alias("n_bytes"), F.sum(own).alias("n_tokens")).drop("key"))


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), model_path())
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
