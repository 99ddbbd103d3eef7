"""Token counts: a scan for end-of-document identifiers in flat token files.

A flat file is a sequence of 2- or 4-byte little-endian identifiers; each document ends with one end identifier; there is no
index. The scan deals out blocks of files (any block may begin and end inside a document), searches each for ends with one
vectorised comparison, and returns the ends, and the tokens before the first and after the last, per block. A prefix sum over
the blocks of a file, in order, stitches them: how many documents ended before a block, and how many tokens of an open
document it continues. Tokens after a file's last end are a last document if there are any.

`write_tokens` makes such files from documents with a public tokenizer, a file a task, and returns the order of documents in
each, which the files themselves don't have. Files are written under names of their own attempt; the returned order, written to
the shared folder, is what commits them.

Long runs of white space, on which the tokenizer's own pattern search fails, are cut out and encoded as the pieces that the pattern
makes of them, so tokens are the same. Identifiers that don't fit `width` bytes, or an end identifier that a token has, are refused.

Null and empty texts have no tokens. Rows that repeat a doc_id are documents of their own; a null doc_id is passed on. Other
columns are ignored. Without documents there are no files.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.llm.common import arrow_map, cut, filesystem, new_folder

#: How the byte-level BPE of the vocabulary splits a text, as published with it (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: White space as that pattern understands it (a fixed value).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@dataclass(frozen=True)
class Params:
    """vocabulary: a file of ranks (base64 token, rank). end: the identifier that ends a document, free in the vocabulary. width: bytes of an
    identifier. block: bytes read at once. run: characters of white space in a row that are encoded apart."""

    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    end: int = 50256
    width: int = 2
    block: int = 8 << 20
    run: int = 1000


@lru_cache(1)
def ranks(vocabulary: str) -> dict[bytes, int]:
    with open(vocabulary, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(2)
def encoding(vocabulary: str, pattern: str = PATTERN):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(vocabulary), special_tokens={})


@lru_cache(1)
def checked(p: Params) -> None:
    most = max(ranks(p.vocabulary).values())
    if max(most, p.end) >= 256**p.width:
        raise ValueError(f"identifiers up to {max(most, p.end)} don't fit {p.width} bytes")
    if p.end in ranks(p.vocabulary).values():
        raise ValueError(f"{p.end} is a token's identifier, so it can't end documents")


def encoded(text: str, p: Params) -> list[int]:
    """The identifiers of a text."""
    checked(p)
    enc, out, at = encoding(p.vocabulary), [], 0
    for m in re.finditer(f"[{SPACE}]{{{p.run},}}", text) if len(text) >= p.run else ():
        # the pattern takes a run but for its last character if something follows, which then is for the next piece
        end = m.end() if m.end() == len(text) else m.end() - 1
        out += enc.encode_ordinary(text[at : m.start()]) + encoding(p.vocabulary, r"[\s\S]+").encode_ordinary(text[m.start() : end])
        at = end
    return out + enc.encode_ordinary(text[at:])


def kind(p: Params) -> np.dtype:
    return np.dtype({2: "<u2", 4: "<u4"}[p.width])


def write_tokens(docs: DataFrame, folder: str, p: Params = Params()) -> DataFrame:
    """Write the texts of docs(doc_id, text) as flat files below folder. Returns file, bytes, and doc_ids in their order there (packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        name, out, size, ids = f"tokens-{uuid.uuid4().hex}.bin", None, 0, []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}")
                tokens = np.array([*encoded(text or "", p), p.end]).astype(kind(p)).tobytes()
                out.write(tokens)
                size += len(tokens)
                ids.append(doc)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64()))], names=["file", "bytes", "doc_ids"])

    return cut(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "file string, bytes bigint, doc_ids array<bigint>"))


def scan(spark: SparkSession, folder: str, files: DataFrame, p: Params = Params()) -> DataFrame:
    """file, ordinal (of a document in its file, from 0), n_tokens (without the end identifier), for files(file, bytes) below folder."""
    blocks = files.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("bytes") / p.block) - 1, F.lit(0)))).alias("block"))
    blocks = blocks.repartition(max(1, spark.sparkContext.defaultParallelism, int(files.agg(F.sum(F.ceil(F.col("bytes") / p.block))).first()[0] or 0) // 4), "file", "block")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        fs, base = filesystem(folder)
        for file, total, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
            with fs.open_input_file(f"{base}/{file}") as f:
                ids = np.frombuffer(f.read_at(min(p.block, total - block * p.block), block * p.block), kind(p))
            ends = np.flatnonzero(ids == p.end)
            counts = np.diff(ends, prepend=-1) - 1
            yield {"file": pa.array([file]), "block": pa.array([block], pa.int64()), "counts": pa.array([counts], pa.list_(pa.int64())), "tail": pa.array([len(ids) - 1 - (ends[-1] if len(ends) else -1)], pa.int64())}

    parts = cut(arrow_map(blocks, run, "file string, block bigint, counts array<bigint>, tail bigint"))
    # the prefix scan: blocks of a file in order; few and narrow without their counts
    ends = F.size("counts")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    head = parts.select("file", "block", ends.alias("ends"), "tail")
    head = head.withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    # tokens of the document open at a block's start: tails of the blocks since the last one with an end, that one's included
    head = head.withColumn("mark", F.max(F.when(F.col("ends") > 0, F.col("block"))).over(before))
    since = F.sum("tail").over(Window.partitionBy("file", F.coalesce("mark", F.lit(-1))).orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    lead = F.max(F.when(F.col("ends") > 0, F.struct("block", "tail"))).over(before)
    head = head.withColumn("open", F.coalesce(lead["tail"], F.lit(0)) + F.coalesce(since, F.lit(0)))
    whole = parts.join(head.select("file", "block", "first", "open"), ["file", "block"]).where(ends > 0)
    docs = whole.select("file", "first", "open", F.posexplode("counts").alias("i", "n")).select("file", (F.col("first") + F.col("i")).alias("ordinal"), (F.col("n") + F.when(F.col("i") == 0, F.col("open")).otherwise(0)).alias("n_tokens"))
    last = head.groupBy("file").agg(F.max(F.struct("block", "first", "ends", "open", "tail")).alias("z")).select("file", (F.col("z.first") + F.col("z.ends")).alias("ordinal"), (F.col("z.tail") + F.when(F.col("z.ends") == 0, F.col("z.open")).otherwise(0)).alias("n_tokens")).where("n_tokens > 0")
    return docs.unionByName(last)


def token_counts(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_tokens for each row of docs(doc_id, text): written as flat files, then scanned."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    files = write_tokens(docs, folder, p)
    order = files.select("file", F.posexplode("doc_ids").alias("ordinal", "doc_id"))
    return order.join(scan(spark, folder, files.select("file", "bytes"), p), ["file", "ordinal"], "left").select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"))
