"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Texts are cut into pre-tokens by the tokenizer's pattern, with positions.
Every distinct pre-token of the corpus is encoded once; its ids are joined
back to the blocks that hold it and documents are put together by position.
The ids of a whole document are then decoded by the token-byte table.
Positions and words travel packed, per block of documents
(:mod:`word_blocks`), so the shuffle has each distinct word of a block once
instead of one row per occurrence, and a word that fills a third of the
corpus does not make a hot key.

The rank file is a parameter; its token-byte table has one row per rank
(50,256 for the default file), the proven bound for the copy in every task.

Null and empty texts have no ids and decode to no bytes; repeated rows are
encoded alike; ids travel as text, a null doc_id passes through; an empty
table gives an empty result.
"""

from __future__ import annotations

import array
import base64
import functools
import hashlib

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.llm import word_blocks
from chainscope.llm.common import keyed_text
from chainscope.operators.lineage import Scratch

RANK_FILE = "byte_bpe_50k.tiktoken"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def token_bytes(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, bytes): the token-byte table of a rank file."""
    ranks = read_ranks(path or public_tokenizers.path(RANK_FILE))
    return spark.createDataFrame([(i, bytearray(b)) for b, i in ranks.items()], "id int, bytes binary")


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path),
                             special_tokens={})


@functools.lru_cache(maxsize=2)
def _bytes_of(path: str) -> dict[int, bytes]:
    """The token-byte table as a task's side of the decoding join."""
    return {i: b for b, i in read_ranks(path).items()}


def word_encoder(path: str):
    """Function from a request's words to their ids, packed as lengths and
    ids. Each distinct word is encoded once."""
    one, known = _encoder(path)._encode_single_piece, {}

    def run(words: list[bytes]) -> bytes:
        for w in words:
            if w not in known:
                known[w] = array.array("I", one(w))
        got = [known[w] for w in words]
        flat = np.frombuffer(b"".join(got), dtype=np.uint32)
        return word_blocks.pack_numbers(np.concatenate([[len(got)], [len(g) for g in got], flat]))
    return run


def decode(spark: SparkSession, ids: DataFrame, path: str | None = None) -> DataFrame:
    """(key, token_ids) -> (key, decoded binary) for any id sequences; one
    row per input row, an empty sequence decodes to empty bytes."""
    table = F.broadcast(token_bytes(spark, path))
    pieces = ids.select("key", F.posexplode("token_ids").alias("pos", "id")).join(table, "id")
    got = pieces.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pos", "bytes"))).alias("p"))
    joined = F.aggregate("p.bytes", F.lit(b""), lambda acc, x: F.concat(acc, x))
    return ids.select("key").join(got, "key", "left").select("key", F.coalesce(joined, F.lit(b"")).alias("decoded"))


def _per_document(spark: SparkSession, docs: DataFrame, emit, schema: str, path: str | None,
                  block_chars: int) -> DataFrame:
    """``emit(ids, decoded bytes)`` of every document; ``schema`` names its
    columns. A document's ids are put together by position, then decoded."""
    path = path or public_tokenizers.path(RANK_FILE)
    pattern = public_tokenizers.PATTERN
    names = ["key", *[part.split()[0] for part in schema.split(", ")]]

    def frame(keys, codes, replies, place):
        sizes, ids = [], []
        for x in map(word_blocks.unpack_numbers, replies):
            n = int(x[0])
            sizes.append(x[1:n + 1])
            ids.append(x[n + 1:])
        size = np.concatenate(sizes).astype(np.int64) if sizes else np.zeros(0, dtype=np.int64)
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")
        start = (np.cumsum(size) - size)[place]
        size, table = size[place], _bytes_of(path)
        rows = []
        for key, code in zip(keys, codes):
            n = size[code]
            # Position of every id: its word's start, then one by one.
            at = np.arange(n.sum()) + np.repeat(start[code] - (np.cumsum(n) - n), n)
            got = flat[at].astype("<u4")
            rows.append((key, *emit(got, b"".join(map(table.__getitem__, got.tolist())))))
        return pd.DataFrame(rows, columns=names)

    blocks = word_blocks.build(keyed_text(docs), Scratch(spark, "bpe"), lambda text: regex.findall(pattern, text),
                               block_chars)
    buckets = word_blocks.bucket_count(blocks)
    replies = word_blocks.ask(blocks, buckets, lambda: word_encoder(path))
    out = word_blocks.assemble(blocks, replies, buckets, frame, "key string, " + schema)
    return out.select(F.col("key").cast("long").alias("doc_id"), *names[1:])


def encode(spark: SparkSession, docs: DataFrame, path: str | None = None,
           block_chars: int = word_blocks.BLOCK_CHARS) -> DataFrame:
    """(doc_id, token_ids array<int>, decoded binary) of every document."""
    return _per_document(spark, docs, lambda ids, raw: (ids.tolist(), raw),
                         "token_ids array<int>, decoded binary", path, block_chars)


def digests(spark: SparkSession, docs: DataFrame, path: str | None = None,
            block_chars: int = word_blocks.BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return _per_document(spark, docs, lambda ids, raw: (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                                                        hashlib.sha256(raw).hexdigest()),
                         "n_tokens long, ids_sha256 string, decoded_sha256 string", path, block_chars)
