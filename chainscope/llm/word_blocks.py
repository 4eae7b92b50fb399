"""Blocks of documents with their distinct words, and one trip of the words.

A block is a run of documents read by one task, closed once it holds
``block_chars`` code points (a longer text is a block of its own). It keeps
its distinct words once, and every document as a sequence of indices into
that list. A word that fills a third of the corpus is therefore sent once per
block, not once per occurrence.

:func:`ask` deals the words of every block to buckets by a hash of the word,
packed into one row per block and bucket; a bucket's task meets each distinct
word of the corpus, and only those of its bucket. Its answers go back to the
blocks, packed likewise, where :func:`assemble` puts them in order.

The table is written to the checkpoint folder before anything joins on it:
block ids are random, so only the committed rows may be used.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from chainscope.operators.lineage import Scratch

BLOCK_CHARS = 20_000_000
SCHEMA = "block long, keys array<string>, sizes array<long>, codes binary, words binary"


def pack_numbers(x: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2^32 - 1 as seven bits a byte, lowest first,
    a set eighth bit saying that more follow; first bytes, second bytes, ...
    are each compressed on their own."""
    x, planes = np.asarray(x, dtype=np.int64), []
    while len(x):
        more = x >> 7
        planes.append(zlib.compress(((x & 127) | np.where(more > 0, 128, 0)).astype(np.uint8).tobytes(), 6))
        x = more[more > 0]
    return struct.pack(f"<{1 + len(planes)}I", len(planes), *map(len, planes)) + b"".join(planes)


def unpack_numbers(raw: bytes) -> np.ndarray:
    n, = struct.unpack_from("<I", raw)
    sizes = struct.unpack_from(f"<{n}I", raw, 4)
    ends = np.cumsum([4 + 4 * n, *sizes])
    high = np.zeros(0, dtype=np.int64)
    for a, b in reversed(list(zip(ends[:-1], ends[1:]))):
        plane = np.frombuffer(zlib.decompress(raw[a:b]), dtype=np.uint8).astype(np.int64)
        low = plane & 127
        low[plane > 127] |= high << 7
        high = low
    return high


def pack_words(words: list[bytes]) -> bytes:
    """Byte strings after their lengths."""
    head = pack_numbers(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
    return struct.pack("<I", len(head)) + head + zlib.compress(b"".join(words), 6)


def unpack_words(raw: bytes) -> list[bytes]:
    n, = struct.unpack_from("<I", raw)
    sizes, body = unpack_numbers(raw[4:4 + n]), zlib.decompress(raw[4 + n:])
    ends = np.cumsum(sizes)
    return [body[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]


def build(docs: DataFrame, scratch: Scratch, split: Callable[[str], list[str]],
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of (key string, text); ``split`` gives the words of a text."""
    def run(batches):
        def close(index, keys, codes):
            # The commonest words get the smallest, shortest numbers.
            flat, words = np.concatenate(codes), list(index)
            order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), dtype=np.int64)
            rank[order] = np.arange(len(words))
            return pd.DataFrame({
                "block": [uuid.uuid4().int >> 65], "keys": [keys], "sizes": [[len(c) for c in codes]],
                "codes": [pack_numbers(rank[flat])],
                "words": [pack_words([words[i].encode("utf-8", "replace") for i in order])]})

        index, keys, codes, chars = {}, [], [], 0
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                keys.append(key)
                codes.append(np.array([index.setdefault(w, len(index)) for w in split(text)], dtype="<u4"))
                chars += len(text) + 64
                if chars >= block_chars:
                    yield close(index, keys, codes)
                    index, keys, codes, chars = {}, [], [], 0
        if keys:
            yield close(index, keys, codes)
    return scratch.save(docs.mapInPandas(run, SCHEMA), "blocks")


def bucket_of(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % buckets


def bucket_count(blocks: DataFrame) -> int:
    """Distinct words grow slower than the text, so the buckets do too: a
    bucket's words stay about as many, however many blocks there are."""
    return max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), round(blocks.count() ** 0.75), 1)


def ask(blocks: DataFrame, buckets: int, answer: Callable[[], Callable[[list[bytes]], bytes]]) -> DataFrame:
    """(block, bucket, reply): ``answer()`` is called once per bucket and
    gives the function from a request's words to its packed reply."""
    def deal(batches):
        for b in batches:
            for block, raw in zip(b["block"], b["words"]):
                words = unpack_words(raw)
                of = bucket_of(words, buckets)
                order = np.argsort(of, kind="stable")
                cuts = np.searchsorted(of[order], np.arange(buckets + 1))
                found = np.flatnonzero(np.diff(cuts))
                yield pd.DataFrame({
                    "block": block, "bucket": found,
                    "words": [pack_words([words[i] for i in order[cuts[k]:cuts[k + 1]]]) for k in found]})

    def reply(batches):
        current, fn = None, None
        for b in batches:
            out = []
            for bucket, raw in zip(b["bucket"], b["words"]):
                if bucket != current:
                    current, fn = bucket, answer()
                out.append(fn(unpack_words(raw)))
            yield pd.DataFrame({"block": b["block"], "bucket": b["bucket"], "reply": out})

    asked = blocks.select("block", "words").mapInPandas(deal, "block long, bucket long, words binary")
    return asked.repartition(buckets, "bucket").sortWithinPartitions("bucket") \
        .mapInPandas(reply, "block long, bucket long, reply binary")


def assemble(blocks: DataFrame, replies: DataFrame, buckets: int, emit: Callable, schema: str) -> DataFrame:
    """``emit(keys, codes per document, replies in the order of the buckets,
    position of each word's answer in them)`` for every block, as a frame."""
    def slim(batches):
        for b in batches:
            b["words"] = [pack_numbers(bucket_of(unpack_words(w), buckets)) for w in b["words"]]
            yield b.rename(columns={"words": "dealt"})

    def run(block, got):
        row = block.iloc[0]
        dealt = unpack_numbers(row.dealt)
        place = np.empty(len(dealt), dtype=np.int64)
        place[np.argsort(dealt, kind="stable")] = np.arange(len(dealt))
        codes = np.split(unpack_numbers(row.codes), np.cumsum(np.asarray(row["sizes"], dtype=np.int64))[:-1])
        return emit(list(row["keys"]), codes, got.sort_values("bucket")["reply"].tolist(), place)
    sent = blocks.mapInPandas(slim, SCHEMA.replace("words", "dealt"))
    return sent.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(run, schema)
