"""Probabilistic suffix tree over words.

Symbols are the words of a text (A-Z lowered), one start and one end. A
context of preceding symbols, of any length, is a state when it was seen at
least ``MIN_COUNT`` times and passes the divergence test: the gain, in nats,
of its smoothed next-symbol distribution over its longest proper suffix's,
summed over its training occurrences with each one left out of the counts
that predict it, is at least ``MIN_GAIN``. The empty context is always a
state and has the base distribution (0.1 added to every count). The others
are smoothed by ``STRENGTH`` pseudo-symbols of their suffix's distribution.
The tree grows a level at a time, and ends with the first level whose states
together gain less than ``LEVEL_GAIN`` nats a training token.
Scoring uses the longest suffix that is a state at every symbol; no text is
cut, and the score is over the same tokens as the base score. The number of
states grows with the corpus.

How it runs. Tasks pack documents into blocks of about ``BLOCK_CHARS`` code
points (a longer text is a block of its own): per block its distinct words'
hashes once and every text as indices into them. The blocks are written once,
as a table bucketed by block, so that the rounds read them in place and only
replies move. One *exchange* per level sends each block's distinct keys with
their partial sums to ``bucket``, a range of the key, where equal keys of all
blocks are added up and the sums return to the blocks that asked. A word, or a
passage, that fills a third of the corpus is one key per block, so no bucket
is hot; buckets grow in number with the blocks. Round k asks for the gains of
the contexts of k symbols and for the counts of the next level. From round
``KEEP`` on a round writes, in one row a block, the positions that are open and
what is known of them; the next one goes on from there with the newest replies
alone, and what came before is deleted. Nothing is gathered but a few totals.

Not asked about is what follows from earlier answers: counts below an end that
was never seen, or seen once, here, and that no text held out has (answers tell
that too); counts below a symbol that always follows its context; contexts that
were counted as sequences one position before; and gains of contexts that no
text held out has and that were seen twice or always before the same symbol,
which each block judges alike by itself (and sends its part of the total).

Only contexts that can still become states are asked about: those seen
``MIN_COUNT`` times, none of whose suffixes is *closed*. A context is closed
when no extension of it can reach ``MIN_GAIN``: an extension followed m times
by a symbol, m at most the context's own y, gains over each of these at most
ln((y - 1 + STRENGTH p) / ((y - 1 + STRENGTH) p)), and the sum of these terms
is below it. So nothing is lost. In a passage that its copies foretell alike
this ends a branch after few words; it goes on where texts part.

Keys are 64-bit hashes: n distinct keys have n^2 / 2^65 colliding pairs to be
expected (below 0.001 for 100 million).

A null or empty text is its end symbol alone. Repeated rows are scored alike
and each counts in training when it falls there; a null doc_id is trained on
like crc32 of the empty text; with no training rows the counts are zero and
both scores are the base formula's; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.llm.common import byte_words, id_text
from chainscope.operators.lineage import Scratch, large

MIN_COUNT = 2
MIN_GAIN = 3.0
LEVEL_GAIN = 0.001
STRENGTH = 5.0
ADD = 0.1
BLOCK_CHARS = 8_000_000
# Bounds of closed contexts travel in sixteenths of a nat, rounded up.
OPEN = int(MIN_GAIN * 16)
# From this level on the blocks' open positions are kept from round to round.
# Earlier most are open, and walking to them again is as cheap.
KEEP = 3
MANY = 1 << 21
# Separators can't be part of a word, so these collide with none.
START, END = xxhash.xxh64_intdigest(b" "), xxhash.xxh64_intdigest(b"\n")

BLOCK_SCHEMA = "block string, ids array<long>, no_id array<boolean>, sizes array<long>, train array<boolean>, codes binary, hashes binary"
KEY_SCHEMA = "kind string, bucket long, block string, keys binary, sums binary, bounds binary, state array<binary>"
REPLY_SCHEMA = "block string, kind string, bucket long, sums binary, seen long, gained double"


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def build_blocks(docs: DataFrame, scratch: Scratch, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of (doc_id, text). Their ids are random, so only the rows of the
    committed table may be used."""
    def numbered():
        index = defaultdict()
        index.default_factory = index.__len__
        return index

    def run(batches):
        def close(index, ids, codes):
            flat = np.concatenate(codes)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, index), dtype="<u8", count=len(index))
            return pd.DataFrame({
                "block": [uuid.uuid4().hex], "ids": [[i or 0 for i in ids]], "no_id": [[i is None for i in ids]], "sizes": [[len(c) for c in codes]],
                "train": [[not held_out(i) for i in ids]], "codes": [_flat(flat)],
                "hashes": [hashes.tobytes()]})

        index, ids, codes, chars = numbered(), [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                words = byte_words(text)
                codes.append(np.fromiter(map(index.__getitem__, words), dtype="<u4", count=len(words)))
                chars += len(text) + 64
                if chars >= block_chars:
                    yield close(index, ids, codes)
                    index, ids, codes, chars = numbered(), [], [], 0
        if ids:
            yield close(index, ids, codes)
    return by_block(docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, BLOCK_SCHEMA), scratch)


def by_block(df: DataFrame, scratch: Scratch) -> DataFrame:
    """Written as a table bucketed by block."""
    spark, name = df.sparkSession, f"pst_{uuid.uuid4().hex}"
    with sparing(spark):
        df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").format("parquet").option(
            "path", f"{scratch.base}/{name}").saveAsTable(name)
    return spark.table(name)


@contextmanager
def sparing(spark: SparkSession):
    """Each statement's shuffle files go when it ends, not when the driver
    happens to collect its garbage: what a round has written is all that the
    next one reads. Blocks go to Python few at a time."""
    conf = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
    was = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of a sequence from its prefix's key and its last symbol."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b
    y = x >> np.uint64(30)
    x ^= y
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=y)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=y)
    return x


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique(keys, return_inverse=True)``, sorted by the upper bits with
    the place in the lower ones, which is faster; keys that differ in lower
    bits alone are seldom, and left to ``np.unique``."""
    bits = np.uint64((1 << max(len(keys) - 1, 1).bit_length()) - 1)
    order = (np.sort((keys & ~bits) | np.arange(len(keys), dtype=np.uint64)) & bits).astype(np.int64)
    found = keys[order]
    if (found[1:] < found[:-1]).any():
        found, ids = np.unique(keys, return_inverse=True)
        return found, ids.astype(np.int32)
    first = np.ones(len(keys), dtype=bool)
    np.not_equal(found[1:], found[:-1], out=first[1:])
    ids = np.empty(len(keys), dtype=np.int32)
    ids[order] = np.cumsum(first, dtype=np.int32) - 1
    return found[first], ids


def _most(y: np.ndarray, p: np.ndarray) -> np.ndarray:
    """What an extension's gain at a position can be at most."""
    return np.maximum(np.log((np.maximum(y - 1, 0) + STRENGTH * p) / ((np.maximum(y - 1, 0) + STRENGTH) * p)), 0)


class Positions:
    """The symbols of a block that are open at level ``k``, those whose
    context of k symbols can still become a state; ``done`` has the log10
    probabilities of the others, summed by text.

    ``replies`` maps a kind ("count1", "gain1", ...) to the sums over all
    blocks, in the order of the keys that were asked about. ``row.state`` is
    what :meth:`state` gave at level ``k``; 0 begins with the first.
    """

    def __init__(self, row, replies: dict[str, np.ndarray], totals: dict | None = None, k: int = 0):
        n = np.asarray(row.sizes, dtype=np.int64) + 2
        self.first = np.cumsum(n) - n
        self.hashes = np.concatenate([np.frombuffer(row.hashes, dtype="<u8"), np.array([START, END], dtype=np.uint64)])
        self.index = np.full(int(n.sum()), -1, dtype=np.int32)
        self.index[self.first], self.index[self.first + n - 1] = len(self.hashes) - 2, len(self.hashes) - 1
        self.index[self.index < 0] = _unflat(row.codes)
        self.sym = self.hashes[self.index]
        self.text = np.repeat(np.arange(len(n), dtype=np.int32), n)
        self.offset = np.arange(len(self.sym), dtype=np.int32) - self.first.astype(np.int32)[self.text]
        self.train = np.repeat(np.asarray(row.train, dtype=bool), n)
        self.replies, self.totals, self.asked, self.gained, self.k = replies, totals, {}, 0.0, k
        if self._resume(row.state) if k else self._start():
            self._walk()

    def _keys(self, at: np.ndarray, k: int) -> np.ndarray:
        """Keys of the k symbols before each position."""
        key = self.sym[at - k]
        for j in range(k - 1, 0, -1):
            key = _mix(key, self.sym[at - j])
        return key

    def _count(self, kind: str, keys: np.ndarray, at: np.ndarray) -> np.ndarray | None:
        """Answers to ``keys`` at positions ``at``, or None, and the question
        is kept. Questions and answers are twice the training count over all
        blocks, and 1 more if a text that is held out has the key."""
        if kind in self.replies:
            return self.replies[kind][_distinct(keys)[1]]
        self._ask(kind, *_distinct(keys), at)
        return None

    def _ask(self, kind: str, found: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        train = self.train[at]
        met = np.bincount(ids[~train], minlength=len(found)) > 0
        self.asked[kind] = found, 2 * np.bincount(ids[train], minlength=len(found)) + met, None

    def _bounds(self, y: np.ndarray, p: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        """What extensions of each context can gain at most, in sixteenths."""
        return np.minimum(np.ceil(np.bincount(slot, weights=_most(y, p), minlength=n) * 16 + 1e-6), OPEN)

    def _judge(self, alone: np.ndarray) -> tuple[np.ndarray, float]:
        """The verdict of contexts that each block judges alone, at these
        open positions, and what their states gain at them."""
        p, n, x = self.p[alone], (self.n[alone] >> 1).astype(np.float64), (self.x[alone] >> 1).astype(np.float64)
        gain = np.log((n - 1 + STRENGTH * p) / (x - 1 + STRENGTH) / p)
        state = (n == x) & (x * gain >= MIN_GAIN)
        most = _most(n, np.where(state, (n + STRENGTH * p) / (x + STRENGTH), p))
        return state + 2 * (np.ceil(x * most * 16 + 1e-6) >= OPEN).astype(np.uint8), float(gain[state].sum())

    def _base(self) -> np.ndarray:
        """Base probability of each word of the block."""
        t = self.totals
        return ((self.words >> 1).astype(np.float64) + ADD) / max(t["n"] + ADD * (t["v"] + 1), 1e-9)

    def _close(self, at: np.ndarray, p: np.ndarray) -> None:
        """These positions have their last probabilities."""
        self.done = self.done + np.bincount(self.text[at], weights=np.log10(p), minlength=len(self.first))

    def _start(self) -> bool:
        """Level 1, once the words and the pairs are counted."""
        found, rank = _distinct(self.hashes)
        at = np.flatnonzero(self.offset >= 1).astype(np.int32)
        if "count1" not in self.replies:
            self._ask("count1", found, rank[self.index], slice(None))
        n = self._count("count2", _mix(self.sym[at - 1], self.sym[at]), at)
        if n is None:
            return False
        # ``words``: the answer to each word; ``heads``: its count as a
        # context, 0 if it is no state. ``n``, ``x``: answers to the sequence
        # of context and symbol and to the context, by open position. ``y``:
        # the last ones to sequences, by position of the block.
        self.words, self.past, self.done, self.y = self.replies["count1"][rank], [], np.zeros(len(self.first)), np.zeros(len(self.sym), dtype=n.dtype)
        self.y[at] = n
        p, x = self._base()[self.index[at]], self.words[self.index[at - 1]]
        kept = x >> 1 >= MIN_COUNT
        self._close(at[~kept], p[~kept])
        self.at, self.p, self.n, self.x, self.k = at[kept], p[kept], n[kept], x[kept], 1
        self.after = None
        return True

    def _resume(self, state: list[bytes]) -> bool:
        at, self.n, self.x, self.after, self.words, self.heads, self.done, *past = map(_unflat, state)
        self.at = np.cumsum(at, dtype=np.int32)
        # Level 1's states are in ``heads``, the others by position.
        self.past = [(past[0], self.heads[self.index[self.at - 1]]), *zip(past[1::2], past[2::2])]
        self.p = self._base()[self.index[self.at]]
        for n, x in self.past:
            self.p = np.where(x > 0, (n.astype(np.float64) + STRENGTH * self.p) / (x.astype(np.float64) + STRENGTH), self.p)
        return True

    def state(self) -> list[bytes]:
        """What is known at this level, by open position or by word."""
        (n, _), *rest = self.past
        return [_flat(v) for v in (np.diff(self.at, prepend=np.zeros(1, dtype=np.int32)), self.n, self.x, self.after, self.words,
                                   self.heads, self.done, n, *(v for pair in rest for v in pair))]

    def _next_contexts(self) -> np.ndarray:
        """Answers to the contexts of k + 1 symbols, by open position, as the
        sequences up to the symbol before; 1: has to be asked, 0: seen too
        seldom, or none. Whether they are known depends on these symbols
        alone, so that all blocks ask about the same ones."""
        y = self.y[self.at - 1]
        after = np.where(y >> 1 >= MIN_COUNT, y, 0)
        if self.k >= 3:
            after[~self.known[self.at - 1]] = 1
        after[self.offset[self.at] <= self.k] = 0
        return after

    def _walk(self) -> None:
        """Counts and states level by level, as far as the replies reach."""
        last = self.totals.get("depth", 0)
        while True:
            at, k, train, p = self.at, self.k, self.train[self.at], self.p
            verdict = self.replies.get(f"gain{k}")
            # A context that no text held out has, seen twice or always before
            # the same symbol, is judged by each block alone.
            rest = np.ones(len(at), dtype=bool)
            if k > 1:
                rest = (self.x & 1 > 0) | ((self.x >> 1 != self.n >> 1) & (self.x >> 1 != 2))
                contexts, slot = _distinct(self._keys(at[rest], k))
                own, gained = self._judge(~rest)
            else:
                used, word = np.zeros(len(self.hashes), dtype=bool), self.index[at - 1]
                used[word] = True
                rank = np.argsort(self.hashes[used])
                contexts, slot, gained = self.hashes[used][rank], np.empty(len(self.hashes), dtype=np.int32), 0.0
                slot[np.flatnonzero(used)[rank]] = np.arange(len(rank))
                slot = slot[word]
            if verdict is None:
                q, n, x, m = p[rest], (self.n[rest] >> 1).astype(np.float64), (self.x[rest] >> 1).astype(np.float64), len(contexts)
                gain = np.where(train[rest], np.log((np.maximum(n - 1, 0) + STRENGTH * q) / (x - 1 + STRENGTH) / q), 0.0)
                sums = np.bincount(slot, weights=gain, minlength=m)
                # What was seen once promises nothing to extensions.
                twice = np.flatnonzero(train[rest] & (n > 1))
                q, n, x, at_slot = q[twice], n[twice], x[twice], slot[twice]
                self.asked[f"gain{k}"] = (contexts, sums, np.concatenate(
                    [self._bounds(n, r, at_slot, m) for r in (q, (n + STRENGTH * q) / (x + STRENGTH))]))
                self.gained = gained
                del q, n, x, gain, sums, twice, at_slot
            else:
                told = verdict[slot]
                if k > 1:
                    told, some = np.empty(len(at), dtype=np.uint8), told
                    told[rest], told[~rest] = some, own
                state = np.flatnonzero(told & 1)
                n, x, q = (self.n[state] >> 1).astype(np.float64), (self.x[state] >> 1).astype(np.float64), p[state]
                p = p.copy()
                p[state] = (n + STRENGTH * q) / (x + STRENGTH)
                if k == last:
                    self._close(at, p)
                    return
                heads = np.zeros(len(at), dtype=self.x.dtype)
                heads[state] = self.x[state] >> 1
                if k == 1:
                    self.heads = np.zeros(len(self.words), dtype=self.words.dtype)
                    self.heads[word] = heads
                del n, x, q, state
            del contexts, slot, rest
            # The next level, from what was open before this one's verdict:
            # counts of longer contexts are those of the sequences before,
            # where these were asked about.
            if self.after is None:
                self.after = self._next_contexts()
            grows = self.after > 0
            grown, x = at[grows], self.after[grows]
            key, unknown = self._keys(grown, k + 1), x == 1
            if k >= 3:
                seen = self._count(f"seen{k + 1}", key[unknown], grown[unknown])
            # A sequence whose end was never seen in training is never seen;
            # one whose end was seen once, here, and is in no text held out,
            # is like it. A symbol that always follows a context always
            # follows its extensions.
            n = self.n[grows]
            always = n >> 1 == self.x[grows] >> 1
            open_count = (n > 2) & ~always
            counted = self._count(f"count{k + 2}", _mix(key[open_count], self.sym[grown[open_count]]), grown[open_count])
            if verdict is None:
                return
            if k >= 3:
                x = x.astype(np.promote_types(x.dtype, seen.dtype))
                x[unknown] = seen
            n = np.where(open_count, 0, n & ~np.ones(1, dtype=n.dtype)).astype(np.result_type(n.dtype, x.dtype, counted.dtype))
            n[open_count], n[always] = counted, x[always]
            self.y, self.known = np.zeros(len(self.sym), dtype=n.dtype), np.zeros(len(self.sym), dtype=bool)
            self.y[grown], self.known[grown] = n, True
            kept = (told[grows] & 2 > 0) & (x >> 1 >= MIN_COUNT)
            stays = np.zeros(len(at), dtype=bool)
            stays[np.flatnonzero(grows)[kept]] = True
            self._close(at[~stays], p[~stays])
            # The states so far with their counts, by position; 0: no state.
            self.past = [(a[stays], b[stays]) for a, b in [*self.past, (self.n >> 1, heads)]]
            self.at, self.p, self.n, self.x = at[stays], p[stays], n[kept], x[kept]
            self.after, self.k = None, k + 1

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the symbols after each text's start."""
        values = np.where(self.offset > 0, values, 0)
        return np.add.reduceat(values, self.first)


def _squeeze(values: np.ndarray) -> bytes:
    return values.nbytes.to_bytes(8, "little") + pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _stretch(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def _pack(values: np.ndarray, whole: bool) -> bytes:
    """Counts in the fewest bytes that hold them, others as 32-bit floats."""
    kind = np.min_scalar_type(int(values.max(initial=0))) if whole else np.dtype("<f4")
    return kind.str.encode() + _squeeze(values.astype(kind))


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(_stretch(raw[3:]), dtype=raw[:3].decode())


def _planes(values: np.ndarray) -> np.ndarray:
    """The bytes of each value, all lowest ones first."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)


def _unplanes(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _flat(values: np.ndarray) -> bytes:
    """Planes of the values, those of counts in the fewest bytes."""
    kind = values.dtype if values.dtype.kind == "f" else np.min_scalar_type(int(values.max(initial=0)))
    return kind.str.encode() + _squeeze(_planes(values.astype(kind)))


def _unflat(raw: bytes) -> np.ndarray:
    return _unplanes(_stretch(raw[3:]), raw[:3].decode())


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as the first one and the steps, whose five lower bytes
    are as good as random."""
    steps = _planes(np.diff(keys))
    return keys[:1].tobytes() + np.uint64(len(keys) - 1).tobytes() + steps[:5].tobytes() + _squeeze(steps[5:])


def _unpack_keys(raw: bytes) -> np.ndarray:
    first, n = np.frombuffer(raw[:16], dtype="<u8")
    cut = 16 + 5 * int(n)
    steps = np.frombuffer(raw[16:cut] + _stretch(raw[cut:]), dtype=np.uint8).reshape(8, int(n))
    return np.cumsum(np.concatenate([[first], np.ascontiguousarray(steps.T).view("<u8").ravel()]), dtype=np.uint64)


def _replies(row) -> dict[str, np.ndarray]:
    """Sums by kind: buckets are ranges of the sorted keys, so their sums
    follow each other in the order of the keys."""
    parts: dict[str, list] = {}
    for r in sorted(row.replies if row.replies is not None else [], key=lambda r: (r["kind"], r["bucket"])):
        parts.setdefault(r["kind"], []).append(_unpack(r["sums"]))
    out = {k: np.concatenate(v) for k, v in parts.items()}
    # A block with nothing to ask at a level has an empty reply to it.
    return {**{k: np.empty(0, dtype=np.uint8) for k in row.kinds}, **out}


def with_replies(blocks: DataFrame, state: DataFrame | None, replies: list[DataFrame], kinds: list[str]) -> DataFrame:
    """Blocks with their open positions, if kept, and the replies since (a
    block's keys are bounded by its code points, and so are its replies)."""
    if state is not None:
        blocks = blocks.join(large(state), "block")
    if not replies:
        return blocks.withColumn("replies", F.lit(None).cast("array<struct<kind:string,bucket:long,sums:binary>>")) \
            .withColumn("kinds", F.array().cast("array<string>"))
    every = replies[0]
    for r in replies[1:]:
        every = every.unionByName(r)
    got = every.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "sums")).alias("replies"))
    return blocks.join(large(got), "block", "left").withColumn("kinds", F.array(*[F.lit(k) for k in kinds]))


def ask(asking: DataFrame, buckets: int, totals: dict, k: int, keep: bool) -> DataFrame:
    """The blocks' next questions, and what is open if it is to be kept. The
    blocks come with their open positions at level ``k``, or with none (0)."""
    def run(batches):
        for b in batches:
            for row in b.itertuples(index=False):
                at = Positions(row, _replies(row), totals, k)
                level, gained, asked, state = at.k, at.gained, at.asked, at.state() if keep else None
                del at
                while asked:
                    kind, (keys, sums, bounds) = asked.popitem()
                    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                    cut = np.flatnonzero(np.diff(bucket, prepend=bucket[:1])) if len(keys) else []
                    edges = [0, *cut, len(keys)] if len(keys) else [0]
                    chunks = list(zip(edges[:-1], edges[1:]))
                    open_to = None if bounds is None else np.split(bounds, 2)
                    yield pd.DataFrame({
                        "kind": kind, "bucket": [int(bucket[a]) for a, _ in chunks], "block": row.block,
                        "keys": [_pack_keys(keys[a:z]) for a, z in chunks],
                        "sums": [_pack(sums[a:z], bounds is None) for a, z in chunks],
                        "bounds": [open_to and _pack(np.concatenate([o[a:z] for o in open_to]), True) for a, z in chunks],
                        "state": None})
                if gained:
                    yield pd.DataFrame({"kind": f"alone{level}", "bucket": [zlib.crc32(row.block.encode()) % buckets], "block": row.block,
                                        "keys": None, "sums": [_pack(np.array([gained]), False)], "bounds": None, "state": None})
                if keep:
                    yield pd.DataFrame({"kind": "state", "bucket": -1, "block": [row.block], "keys": None, "sums": None, "bounds": None,
                                        "state": [state]})

    return asking.mapInPandas(run, KEY_SCHEMA)


def exchange(asked: DataFrame) -> DataFrame:
    """The blocks' questions, added up and answered. Gains are answered by
    the verdict: 1 for a state, and 2 more unless closed."""
    def add(group: pd.DataFrame) -> pd.DataFrame:
        if group["kind"].iloc[0].startswith("alone"):
            gained = float(np.concatenate([_unpack(s) for s in group["sums"]]).sum())
            return pd.DataFrame({"block": group["block"].iloc[:1], "kind": group["kind"].iloc[:1], "bucket": group["bucket"].iloc[:1],
                                 "sums": [_pack(np.zeros(0), True)], "seen": 0, "gained": gained})
        keys = [_unpack_keys(k) for k in group["keys"]]
        found, inverse = _distinct(np.concatenate(keys))
        total = lambda parts: np.bincount(inverse, weights=np.concatenate(parts), minlength=len(found))
        parts, gained, news = [_unpack(s) for s in group["sums"]], 0.0, 0
        if not group["kind"].iloc[0].startswith("gain"):
            # Both at once: the blocks that have it in a text held out are
            # fewer than MANY, and the products exact.
            both = total([(s >> 1) * float(MANY) + (s & 1) for s in parts]).astype(np.int64)
            news, sums = int((both >= MANY).sum()), both // MANY * 2 + (both % MANY > 0)
        else:
            sums = total(parts)
            state = sums >= MIN_GAIN
            gained = float(sums[state].sum())
            plain, after = zip(*(np.split(_unpack(b), 2) for b in group["bounds"]))
            sums = state + 2.0 * (np.where(state, total(after), total(plain)) >= OPEN)
        answers = np.split(sums[inverse], np.cumsum([len(k) for k in keys])[:-1])
        return pd.DataFrame({"block": group["block"], "kind": group["kind"], "bucket": group["bucket"],
                             "sums": [_pack(a, True) for a in answers],
                             "seen": [news, *[0] * (len(group) - 1)],
                             "gained": [gained, *[0.0] * (len(group) - 1)]})

    return asked.filter(F.col("kind") != "state").drop("state").groupBy("kind", "bucket").applyInPandas(add, REPLY_SCHEMA)


def grow(spark: SparkSession, blocks: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict]:
    """The tree, as every block's part of it, and the corpus totals."""
    n_blocks, n_docs, n_words = blocks.select(F.count(F.lit(1)), *[F.coalesce(F.sum(F.aggregate(
        F.arrays_zip("train", "sizes"), F.lit(0).cast("long"),
        lambda a, x: a + F.when(x["train"], one(x)).otherwise(0))), F.lit(0)) for one in (
            lambda x: F.lit(1).cast("long"), lambda x: x["sizes"])]).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks // 4, 1)
    totals = {"n": n_docs + n_words, "docs": n_docs, "v": 0}  # one end per training text
    replies, kinds, kept, k = [], [], None, 0
    with sparing(spark):
        while True:
            # A round's questions follow from the replies to the earlier
            # ones, or from what was open in the last one and its replies.
            asking = with_replies(blocks, kept and _state(kept), replies, kinds)
            asked = ask(asking, buckets, totals, k - 1 if kept else 0, k >= KEEP)
            if k >= KEEP:
                old, kept = [*replies, *([kept] if kept else [])], by_block(asked, scratch)
                replies, kinds, asked = [], [], kept
                for table in old:
                    scratch.drop(table)
            replies.append(scratch.save(exchange(asked), f"replies{k}"))
            kinds = kinds + (["count1", "count2"] if k == 0 else [f"gain{k}", f"count{k + 2}"] + [f"seen{k + 1}"] * (k >= 3))
            news, gained = replies[-1].filter(F.col("kind").isin("count1" if k == 0 else f"gain{k}", f"alone{k}")).select(
                F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("gained"), F.lit(0.0))).first()
            if k == 0:
                totals["v"] = news - (1 if n_docs else 0)  # the start is no token
            elif gained <= LEVEL_GAIN * totals["n"]:
                totals["depth"] = k
                return with_replies(blocks, kept and _state(kept), replies, kinds), totals
            k += 1


def _state(kept: DataFrame) -> DataFrame:
    return kept.filter(F.col("kind") == "state").select("block", "state")


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    scratch = Scratch(spark, "pst")
    tree, totals = grow(spark, build_blocks(id_text(docs), scratch), scratch)

    def run(batches):
        for b in batches:
            for row in b.itertuples(index=False):
                at = Positions(row, _replies(row), totals, totals["depth"] if totals["depth"] >= KEEP else 0)
                df = pd.DataFrame({
                    "doc_id": pd.Series(row.ids, dtype="Int64").mask(row.no_id), "held_out": ~np.asarray(row.train, dtype=bool),
                    "n_tokens": np.asarray(row.sizes, dtype=np.int64) + 1, "n_known": at.per_text((at.words > 1)[at.index].astype(np.int64)),
                    "train_tokens": totals["n"], "base_score": at.per_text(np.log10(at._base())[at.index]),
                    "score": at.done})
                for i in range(0, len(df), 10_000):
                    yield df.iloc[i:i + 10_000]
    return tree.mapInPandas(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                 "base_score double, score double")
