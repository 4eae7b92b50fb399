"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes; offsets where tokens of both end cut them
into groups, and the two tokens that end there are linked. Documents are read
in blocks. A block keeps, per pair of linked ids, a compressed bitmap of its
documents and one further bitmap (plane) per binary digit of the pair's
number of links in a document. The planes OR-merged and popcounted give the
pair's documents, their popcounts times the powers of two its links. These
two numbers are all that is shuffled by pair: blocks hold different documents,
so they add up. Each pair's corpus-wide score goes back to the blocks whose
postings hold the pair, and the planes deal it out to the documents.

A pair is one row per block at most, however often it occurs, so no pair makes
a hot key. The blocks are written to the checkpoint folder before anything is
joined to them, since their ids are random.

Null and empty texts, and those whose token bytes are not a space and the
text, have no tokens: zeros and an empty digest. Texts are processed whole;
repeated rows count each time; a null doc_id passes through; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
import zlib
from functools import lru_cache
from itertools import chain, compress, islice

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainscope.llm.common import keyed_text
from chainscope.operators.lineage import Scratch

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
BLOCK_CHARS, BLOCK_DOCS = 8_000_000, 1 << 16
# Units of text kept per worker (about 500 bytes each), and the longest kept.
CACHE_UNITS, CACHE_CHARS = 300_000, 48
BLOCK_SCHEMA = ("block string, keys array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, "
                "shas array<string>, pairs array<long>, pair_docs array<long>, pair_links array<long>, planes binary")
RESULT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_lone"]

# --- bitmaps ------------------------------------------------------------

class PairBitmaps:
    """Bitmaps of documents 0..n_docs-1 for pairs 0..n_pairs-1: a pair held by
    more than a sixteenth of the documents as one bit a document, any other
    as sorted 16-bit positions, whichever is smaller."""

    def __init__(self, n_pairs: int, n_docs: int, dense: np.ndarray, bits: np.ndarray, sparse: np.ndarray,
                 at: np.ndarray):
        # dense: pairs as rows of ``bits``; sparse/at: pair and document of each further entry, sorted
        self.n_pairs, self.n_docs, self.dense, self.bits, self.sparse, self.at = n_pairs, n_docs, dense, bits, sparse, at

    @classmethod
    def of(cls, pair: np.ndarray, doc: np.ndarray, n_pairs: int, n_docs: int, dense: np.ndarray) -> PairBitmaps:
        """From distinct (pair, doc) entries in order; ``dense`` are the pairs
        to keep as bits."""
        row = np.full(n_pairs, -1, dtype=np.int64)
        row[dense] = np.arange(len(dense))
        wide = row[pair] >= 0
        full = np.zeros((len(dense), n_docs), dtype=bool)
        full[row[pair[wide]], doc[wide]] = True
        return cls(n_pairs, n_docs, dense, np.packbits(full, axis=1), pair[~wide], doc[~wide].astype(np.uint16))

    def popcount(self) -> np.ndarray:
        """Documents per pair."""
        out = np.bincount(self.sparse, minlength=self.n_pairs).astype(np.int64)
        out[self.dense] += np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        return out

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(pair, doc) of every set bit."""
        row, doc = np.nonzero(np.unpackbits(self.bits, axis=1, count=self.n_docs)) if len(self.dense) else (
            np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
        return np.concatenate([self.dense[row], self.sparse]), np.concatenate([doc, self.at.astype(np.int64)])

    def merge(self, other: PairBitmaps) -> PairBitmaps:
        """The union; both keep the same pairs as bits."""
        key = np.union1d(self.sparse * self.n_docs + self.at, other.sparse * self.n_docs + other.at)
        return PairBitmaps(self.n_pairs, self.n_docs, self.dense, self.bits | other.bits,
                           key // self.n_docs, (key % self.n_docs).astype(np.uint16))

    def pack(self) -> bytes:
        sizes = np.bincount(self.sparse, minlength=self.n_pairs).astype(np.uint32)
        return b"".join((self.bits.tobytes(), sizes.tobytes(), self.at.tobytes()))

    @classmethod
    def unpack(cls, raw: memoryview, n_pairs: int, n_docs: int, dense: np.ndarray) -> tuple[PairBitmaps, memoryview]:
        """The first bitmaps of ``raw``, and what follows them."""
        width = (n_docs + 7) // 8
        cut = len(dense) * width
        bits = np.frombuffer(raw[:cut], dtype=np.uint8).reshape(len(dense), width)
        sizes = np.frombuffer(raw[cut:cut + 4 * n_pairs], dtype=np.uint32)
        cut += 4 * n_pairs
        end = cut + 2 * int(sizes.sum())
        at = np.frombuffer(raw[cut:end], dtype=np.uint16)
        return cls(n_pairs, n_docs, dense, bits, np.repeat(np.arange(n_pairs), sizes), at), raw[end:]


def planes_of(pair: np.ndarray, doc: np.ndarray, links: np.ndarray, n_pairs: int, n_docs: int) -> list[PairBitmaps]:
    """Bitmaps per binary digit of ``links`` for distinct sorted (pair, doc)."""
    dense = np.flatnonzero(np.bincount(pair, minlength=n_pairs) * 16 > n_docs)
    digits = int(links.max()).bit_length() if len(links) else 0
    return [PairBitmaps.of(pair[on], doc[on], n_pairs, n_docs, dense)
            for on in ((links >> k & 1).astype(bool) for k in range(digits))]


def pack_planes(planes: list[PairBitmaps]) -> bytes:
    if not planes:
        return b""
    dense = planes[0].dense
    head = np.array([len(planes), planes[0].n_pairs, planes[0].n_docs, len(dense)], dtype=np.int64).tobytes()
    return zlib.compress(head + dense.astype(np.int64).tobytes() + b"".join(p.pack() for p in planes), 1)


def unpack_planes(packed: bytes) -> list[PairBitmaps]:
    if not packed:
        return []
    raw = memoryview(zlib.decompress(packed))
    n, n_pairs, n_docs, wide = np.frombuffer(raw[:32], dtype=np.int64).tolist()
    dense, raw = np.frombuffer(raw[32:32 + 8 * wide], dtype=np.int64), raw[32 + 8 * wide:]
    out = []
    for _ in range(n):
        plane, raw = PairBitmaps.unpack(raw, n_pairs, n_docs, dense)
        out.append(plane)
    return out


def pair_totals(planes: list[PairBitmaps], n_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, links) per pair by popcounts."""
    if not planes:
        return np.zeros(n_pairs, dtype=np.int64), np.zeros(n_pairs, dtype=np.int64)
    held = planes[0]
    for p in planes[1:]:
        held = held.merge(p)
    return held.popcount(), sum(p.popcount() << k for k, p in enumerate(planes))


# --- tokens of a text -----------------------------------------------------

def _byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the
    other bytes in order for the characters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Unit:
    """Alignment of one unit of text: whether the bytes of both sides are the
    unit's, tokens and groups, the groups' text, and the linked pairs (packed
    64-bit numbers)."""
    __slots__ = ("exact", "n_a", "n_b", "n_groups", "groups", "pairs")


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        byte = _byte_of_symbol()
        self.bytes_a = {i: bytes(byte[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        # Bytes of each id, and its decimals with what may follow in a group.
        top = max(self.bytes_a) + 1
        self.size_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(top)])
        self.size_b = np.array([len(t) for t in self.bytes_b])
        self.marks = [f"{i}{m}" for i in range(top) for m in ",|"] + [f"{i}{m}" for i in range(len(self.bytes_b)) for m in ",;"]
        self.mark_size = np.array([len(m) for m in self.marks])
        self.cut = re.compile(self._cuts())
        self.space = self.b.piece_to_id(SPACE)
        self.units: dict[str, Unit] = {}
        self.older: dict[str, Unit] = {}

    def _cuts(self) -> str:
        """Where no token of either side crosses. The first side never goes
        from what is not white space to white space, nor from a letter to
        what is no letter (its pattern); for the second the pieces decide:
        cuts are left out where some piece holds both characters in a row."""
        joined = [p for p in (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()) if not (
            self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))) if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in joined) or any("\n" in p for p in joined):
            raise ValueError("a piece holds a line end, or a space symbol after another character")
        held = {c for p in joined for c in p}
        letters = {c for c in held if c.isalpha()}
        after = {b for p in joined for a, b in zip(p, p[1:]) if a in letters}
        white = " " + "".join(c for c in "\t\n\v\f\r" if c not in held)
        marks = "".join(re.escape(chr(c)) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in after)
        ends = rf"(?<=\S)(?=[{white}])"
        return rf"{ends}|(?<=[{re.escape(''.join(sorted(letters)))}])(?=[{marks}])" if marks and letters else ends

    def align(self, units: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[Unit]:
        """The units' alignments, taken in one run over all their tokens."""
        out = [Unit() for _ in units]
        raw = [u.encode("utf-8", "replace") for u in units]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        n_a = np.fromiter(map(len, ids_a), dtype=np.int64, count=len(raw))
        n_b = np.fromiter(map(len, ids_b), dtype=np.int64, count=len(raw))
        a = np.fromiter(chain.from_iterable(ids_a), dtype=np.int64, count=int(n_a.sum()))
        b = np.fromiter(chain.from_iterable(ids_b), dtype=np.int64, count=int(n_b.sum()))
        # Of the units as long as their tokens on both sides, those with the same bytes.
        of = np.arange(len(raw))
        exact = (np.bincount(np.repeat(of, n_a), self.size_a[a], len(raw)) == size) \
            & (np.bincount(np.repeat(of, n_b), self.size_b[b], len(raw)) == size)
        long_, held = b"".join(compress(raw, exact)), np.repeat(of[exact], size[exact])
        for n, ids, parts in ((n_a, a, self.bytes_a), (n_b, b, self.bytes_b)):
            got = b"".join(map(parts.__getitem__, ids[np.repeat(exact, n)].tolist()))
            if got != long_:
                exact[held[np.frombuffer(got, dtype=np.uint8) != np.frombuffer(long_, dtype=np.uint8)]] = False
                long_, held = b"".join(compress(raw, exact)), np.repeat(of[exact], size[exact])
        for u, e, x, y in zip(out, exact.tolist(), n_a.tolist(), n_b.tolist()):
            u.exact, u.n_a, u.n_b, u.n_groups, u.groups, u.pairs = e, x, y, 0, "", b""
        if not exact.any():
            return out
        a, b, n_a, n_b = a[np.repeat(exact, n_a)], b[np.repeat(exact, n_b)], n_a[exact], n_b[exact]
        # A unit has as many bytes on both sides, so its offsets agree.
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at_b = np.searchsorted(end_b, end_a)
        ends = end_b[at_b] == end_a
        last_a, last_b = np.flatnonzero(ends), at_b[ends]
        pairs = a[last_a] << 32 | b[last_b]
        # The groups' text: the tokens of the first side stand after those of
        # the second in the groups before theirs.
        place = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[np.cumsum(ends) - ends]
        closes = np.zeros(len(b), dtype=np.int64)
        closes[last_b] = 1
        marks, rest = np.empty(len(a) + len(b), dtype=np.int64), np.ones(len(a) + len(b), dtype=bool)
        marks[place], rest[place] = 2 * a + ends, False
        marks[rest] = 2 * (len(self.size_a) + b) + closes
        text = "".join(map(self.marks.__getitem__, marks.tolist()))
        z_a, z_b = np.cumsum(n_a), np.cumsum(n_b)
        to = np.cumsum(self.mark_size[marks])[z_a + z_b - 1].tolist()
        till = np.searchsorted(last_a, z_a).tolist()
        for u, x, y, g, h in zip(compress(out, exact), [0, *to], to, [0, *till], till):
            u.n_groups, u.groups, u.pairs = h - g, text[x:y - 1], pairs[g:h].tobytes()
        return out

    def split(self, text: str) -> list[str]:
        """A space and the text, in units that both sides encode alone."""
        return self.cut.split(" " + text) if text else []

    def _ids_b(self, new: list[str]) -> list[list[int]]:
        """Pieces of units within a text: the space that starts a unit is
        left for the model to add; others follow a line end, which joins no
        piece, and lose what it adds."""
        ids = self.b.encode([u[1:] if u[0] == " " else "\n" + u for u in new], num_threads=1)
        return [(i or [self.space]) if u[0] == " " else i[2:] for u, i in zip(new, ids)]

    def units_of(self, texts: list[list[str]]) -> dict[str, Unit]:
        """Alignments of the distinct units; new ones are encoded together."""
        got: dict[str, Unit] = {}
        new, fresh = [], []
        for u in set().union(*texts):
            unit = self.units.get(u)
            if unit is None:
                unit = self.older.get(u)
                (new if unit is None else fresh).append(u)
            got[u] = unit
        if new:
            ids_a = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
            got.update(zip(new, self.align(new, ids_a, self._ids_b(new))))
        # Beyond half the bound the newer half becomes the older one.
        self.units.update((u, got[u]) for u in chain(new, fresh) if len(u) <= CACHE_CHARS)
        if len(self.units) > CACHE_UNITS // 2:
            self.units, self.older = {}, self.units
        return got


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and pair of files."""
    return Aligner(path_a, path_b)


class _Codes(dict):
    """Units numbered as they are first asked for."""

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        return n


class _Block:
    """Documents of one block, and its distinct units."""

    def __init__(self):
        self.index = _Codes()
        self.units: list[Unit] = []
        self.groups: list[str] = []
        self.keys, self.shas, self.codes, self.chars = [], [], [], 0

    def add(self, key, text: str, cut: list[str], known: dict[str, Unit], inexact: set[str]) -> None:
        if not inexact.isdisjoint(cut):
            cut = []
        code = list(map(self.index.__getitem__, cut))
        new = [known[u] for u in islice(reversed(self.index), len(self.index) - len(self.units))][::-1]
        self.units += new
        self.groups += [u.groups for u in new]
        self.keys.append(key)
        self.codes.append(np.array(code, dtype=np.uint32))
        self.shas.append(hashlib.sha256(";".join(map(self.groups.__getitem__, code)).encode()).hexdigest() if cut else "")
        self.chars += len(text)

    def close(self) -> pd.DataFrame:
        n_docs = len(self.keys)
        sizes = np.array([u.n_groups for u in self.units], dtype=np.int64)
        flat = np.frombuffer(b"".join(u.pairs for u in self.units), dtype=np.int64)
        pairs, slot = np.unique(flat, return_inverse=True)
        # Distinct (document, unit) with their numbers, then their pairs.
        code = np.concatenate(self.codes).astype(np.int64)
        words = np.array([len(c) for c in self.codes])
        doc, till = np.repeat(np.arange(n_docs), words), np.cumsum(words)
        rows = []
        for each in ([u.n_a for u in self.units], [u.n_b for u in self.units], sizes):
            upto = np.concatenate([[0], np.cumsum(np.asarray(each, dtype=np.int64)[code])])
            rows.append((upto[till] - upto[till - words]).tolist())
        key, times = np.unique(code * n_docs + doc, return_counts=True)
        code, doc = key // n_docs, key % n_docs
        n = sizes[code]
        start = np.concatenate([[0], np.cumsum(sizes)])[:-1][code] if len(sizes) else n
        at = np.repeat(start - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(int(n.sum()))
        key, back = np.unique(slot[at] * n_docs + np.repeat(doc, n), return_inverse=True)
        # Sums of doubles are exact up to 2^53 links.
        links = np.bincount(back, weights=np.repeat(times, n), minlength=len(key)).astype(np.int64)
        planes = planes_of(key // n_docs, key % n_docs, links, len(pairs), n_docs)
        docs, total = pair_totals(planes, len(pairs))
        return pd.DataFrame({
            "block": [uuid.uuid4().hex], "keys": [self.keys], "n_a": [rows[0]], "n_b": [rows[1]], "n_groups": [rows[2]],
            "shas": [self.shas],
            "pairs": [pairs.tolist()], "pair_docs": [docs.tolist()], "pair_links": [total.tolist()],
            "planes": [pack_planes(planes)]})


def postings(docs: DataFrame, scratch: Scratch, path_a: str | None = None, path_b: str | None = None,
             block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of documents with their groups and inverted pair bitmaps."""
    path_a = path_a or public_tokenizers.path(FILE_A)
    path_b = path_b or public_tokenizers.path(FILE_B)

    def run(batches):
        tool, block = aligner(path_a, path_b), _Block()
        for b in batches:
            keys, texts, at = b["key"].tolist(), b["text"].tolist(), 0
            while at < len(texts):
                # A few documents at a time: their new units are encoded together.
                end, chars = at, 0
                while end < len(texts) and chars < 1_000_000:
                    chars += len(texts[end])
                    end += 1
                cuts = [tool.split(t) for t in texts[at:end]]
                known = tool.units_of(cuts)
                inexact = {u for u, unit in known.items() if not unit.exact}
                for key, text, cut in zip(keys[at:end], texts[at:end], cuts):
                    block.add(key, text, cut, known, inexact)
                    if block.chars >= block_chars or len(block.keys) >= BLOCK_DOCS:
                        yield block.close()
                        block = _Block()
                at = end
        if block.keys:
            yield block.close()

    return scratch.save(keyed_text(docs).mapInPandas(run, BLOCK_SCHEMA), "postings")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, pair, n_docs, n_links, best): every pair of ids that is linked
    somewhere; ``best`` if no pair of the same second id has more links."""
    z = F.explode(F.arrays_zip("pairs", "pair_docs", "pair_links")).alias("z")
    sums = blocks.select(z).groupBy(F.col("z.pairs").alias("pair")).agg(
        F.sum("z.pair_docs").alias("n_docs"), F.sum("z.pair_links").alias("n_links"))
    sums = sums.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    # An id's pairs number at most the first tokenizer's ids.
    top = F.max("n_links").over(Window.partitionBy("b"))
    return sums.select(F.shiftright("pair", 32).alias("a"), "b", "pair", "n_docs", "n_links",
                       (F.col("n_links") == top).alias("best"))


def align(spark: SparkSession, docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, n_lone) of every document; ``n_lone`` are the links whose
    pair no other document holds."""
    blocks = postings(docs, Scratch(spark, "alignment"), path_a, path_b, block_chars)
    scores = pair_counts(blocks).select("pair", F.col("n_links").alias("count"), "best",
                                        (F.col("n_docs") == 1).alias("lone"))
    got = (blocks.select("block", F.posexplode("pairs").alias("i", "pair")).join(scores, "pair")
           .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("i", "count", "best", "lone"))).alias("s")))
    full = (blocks.select("block", "keys", "n_a", "n_b", "n_groups", "shas", "planes").join(got, "block", "left")
            .select("keys", "n_a", "n_b", "n_groups", "shas", "planes", F.col("s.count").alias("counts"),
                    F.col("s.best").alias("bests"), F.col("s.lone").alias("lones")))

    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                n = len(row.keys)
                sums = {c: np.zeros(n, dtype=np.int64) for c in RESULT[3:]}
                if row.counts is not None:
                    count = np.asarray(row.counts, dtype=np.int64)
                    best, lone = np.asarray(row.bests, dtype=np.int64), np.asarray(row.lones, dtype=np.int64)
                    for k, plane in enumerate(unpack_planes(row.planes)):
                        pair, doc = plane.entries()
                        for name, each in (("n_links", None), ("n_best", best), ("count_sum", count), ("n_lone", lone)):
                            np.add.at(sums[name], doc, 1 << k if each is None else each[pair] << k)
                yield pd.DataFrame({"key": row.keys, "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups,
                                    **sums, "groups_sha256": row.shas})

    schema = "key string, " + ", ".join(f"{c} long" for c in RESULT) + ", groups_sha256 string"
    return full.mapInPandas(run, schema).select(
        F.col("key").cast("long").alias("doc_id"), *RESULT[:-1], "groups_sha256", "n_lone")
