"""SentencePiece BPE encoding and decoding by backtracking.

A merge-type encoding is fixed by its neighbours: a row of pieces is the one
that merging gives exactly when every piece, and every two adjacent pieces
merged anew on their own, come out unchanged. So a text is encoded left to
right: Aho-Corasick finds the longest piece at every position, a piece is
taken if it is compatible with the one before it (checked once per pair by
re-merging), else its next shorter prefix is tried, else the last piece is
given back. A bitfield of failed positions keeps the walk linear.

Texts are first cut where no piece can cross: before a space symbol that
follows another character (the vocabulary is searched for a counterexample),
around characters that no piece of two or more characters holds, and between
a letter and a mark that no piece holds side by side.
Pieces of equal score are merged leftmost first, which neighbours alone do not
fix; all such pieces must be runs of the space symbol, and a segment that
starts with a run is merged as a whole.

Each row is encoded where it is read: no shuffle, and a bounded memory of
segments per worker. Texts are processed whole. Null and empty texts have the
end id only and decode to the empty text; repeated rows are encoded alike; a
null doc_id passes through; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.llm.common import keyed_text

MODEL_FILE = "piece_bpe_32k.model"
SPACE = "▁"
# Entries a worker's memory of segments and of pairs of pieces holds (about
# 250 bytes each), and the longest segment that is kept.
CACHE_SEGMENTS, CACHE_PAIRS, CACHE_CHARS = 600_000, 300_000, 48


class Memo(dict):
    """Values by key, computed once while remembered. Beyond half its bound
    the newer half becomes the older one; what is met again moves up."""

    def __init__(self, make, bound: int):
        super().__init__()
        self.make, self.half, self.older = make, bound // 2, {}

    def __missing__(self, key):
        got = self.older.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        if not isinstance(key, str) or len(key) <= CACHE_CHARS:
            self[key] = got
        return got


def merge(text: str, score: dict[str, float]) -> list[str]:
    """Pieces of ``text`` by merging: the best-scored adjacent pair first,
    the leftmost of equals."""
    if len(text) <= 32:
        return _merge_short(text, score)
    part: list[str | None] = list(text)
    right = list(range(1, len(part) + 1))
    left = list(range(-1, len(part) - 1))
    queue = [(-score[a + b], i, a + b) for i, (a, b) in enumerate(zip(text, text[1:])) if a + b in score]
    heapq.heapify(queue)
    while queue:
        _, i, got = heapq.heappop(queue)
        j = right[i] if part[i] is not None else len(part)
        if j >= len(part) or part[i] + part[j] != got:
            continue
        part[i], part[j] = got, None
        right[i] = right[j]
        if right[i] < len(part):
            left[right[i]] = i
            if (new := got + part[right[i]]) in score:
                heapq.heappush(queue, (-score[new], i, new))
        if left[i] >= 0 and (new := part[left[i]] + got) in score:
            heapq.heappush(queue, (-score[new], left[i], new))
    return [p for p in part if p is not None]


def _merge_short(text: str, score: dict[str, float]) -> list[str]:
    none = float("-inf")
    part = list(text)
    gain = [score.get(a + b, none) for a, b in zip(text, text[1:])]
    while gain and (best := max(gain)) > none:
        i = gain.index(best)
        got = part[i] + part[i + 1]
        part[i:i + 2] = [got]
        del gain[i]
        if i:
            gain[i - 1] = score.get(part[i - 1] + got, none)
        if i < len(gain):
            gain[i] = score.get(got + part[i + 1], none)
    return part


class PieceEncoder:
    """Encoder of one model file; pieces of any text by backtracking."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        plain = [i for i in range(m.get_piece_size())
                 if not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i))]
        self.id = {m.id_to_piece(i): i for i in plain}
        self.score = {m.id_to_piece(i): m.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece holds a space symbol after another character")
        by_score: dict[float, list[str]] = {}
        for p, s in self.score.items():
            if len(p) > 1:
                by_score.setdefault(s, []).append(p)
        if any(p.strip(SPACE) for same in by_score.values() if len(same) > 1 for p in same):
            raise ValueError("pieces of equal score that are not runs of the space symbol")
        self.bytes = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end = m.eos_id()
        # Pieces that merging never leaves standing are not matched.
        reachable = [p for p in self.id if len(p) == 1 or merge(p, self.score) == [p]]
        self.words = ahocorasick.Automaton()
        for p in reachable:
            self.words.add_word(p, len(p))
        self.words.make_automaton()
        known = set(reachable)
        # The longest proper prefix that is a piece or one character.
        self.shorter = {p: next(p[:n] for n in range(len(p) - 1, 0, -1) if n == 1 or p[:n] in known)
                        for p in known if len(p) > 1}
        joining = {c for p in self.id if len(p) > 1 for c in p} - {SPACE}
        letters = {c for c in joining if c.isalpha()}
        after_letter = {b for p in self.id for a, b in zip(p, p[1:]) if a in letters}
        joins, letter, mark, rest = ("".join(map(re.escape, sorted(x))) for x in (
            joining, letters, joining - after_letter, joining & after_letter))
        run = f"(?:[{rest}]+|(?<![{letter}])[{mark}]+)*" if mark else f"[{rest}]*"
        self._cut = re.compile(f"{SPACE}*[{joins}]{run}|{SPACE}+|[^{SPACE}{joins}]+")
        #: Whether re-merging two pieces leaves them as they are.
        self.fits = Memo(lambda ab: ab[0] + ab[1] not in known and merge(ab[0] + ab[1], self.score) == [*ab],
                         CACHE_PAIRS)
        #: Ids of a segment.
        self.segment_ids = Memo(self._segment_ids, CACHE_SEGMENTS)

    def backtrack(self, s: str) -> list[str] | None:
        longest = [1] * len(s)
        for end, n in self.words.iter(s):
            longest[end - n + 1] = n
        fits, shorter, n = self.fits, self.shorter, len(s)
        failed, any_failed = bytearray(n // 8 + 1), False
        out: list[str] = []
        pos, piece = 0, s[:longest[0]]
        while pos < n:
            end = pos + len(piece)
            if (not any_failed or not failed[end >> 3] >> (end & 7) & 1) and (not out or fits[out[-1], piece]):
                out.append(piece)
                pos = end
                if pos < n:
                    piece = s[pos:pos + longest[pos]]
            elif (short := shorter.get(piece)) is not None:
                piece = short
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                any_failed = True
                if not out:
                    return None
                piece = out.pop()
                pos -= len(piece)
        return out

    def pieces(self, segment: str) -> list[str]:
        if segment.startswith(SPACE * 2):
            return merge(segment, self.score)
        got = self.backtrack(segment)
        if got is None:
            raise ValueError("no compatible row of pieces")
        return got

    def _segment_ids(self, segment: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(
            (self.id[p],) if p in self.id else (self.bytes[b] for b in p.encode("utf-8", "replace"))
            for p in self.pieces(segment)))

    def segments(self, text: str) -> list[str]:
        return self._cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without the end id."""
        return list(chain.from_iterable(map(self.segment_ids.__getitem__, self.segments(text))))

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and model file."""
    return PieceEncoder(path)


def _map(docs: DataFrame, path: str | None, row, fields: dict[str, str]) -> DataFrame:
    path = path or public_tokenizers.path(MODEL_FILE)

    def run(batches):
        enc = encoder(path)
        for b in batches:
            rows = [row(enc, t) for t in b["text"]]
            yield pd.DataFrame({"key": b["key"], **{n: [r[i] for r in rows] for i, n in enumerate(fields)}})

    got = keyed_text(docs).mapInPandas(run, "key string, " + ", ".join(f"{n} {t}" for n, t in fields.items()))
    return got.select(F.col("key").cast("long").alias("doc_id"), *fields)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, token_ids array<int>) of every document, the end id last."""
    return _map(docs, path, lambda enc, t: (enc.encode(t) + [enc.end],), {"token_ids": "array<int>"})


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, token_ids) -> (doc_id, text)."""
    path = path or public_tokenizers.path(MODEL_FILE)

    def run(batches):
        enc = encoder(path)
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "text": [
                "" if ids is None else enc.decode([int(i) for i in ids]) for ids in b["token_ids"]]})

    got = encoded.select(F.col("doc_id").cast("string").alias("key"), "token_ids").mapInPandas(
        run, "key string, text string")
    return got.select(F.col("key").cast("long").alias("doc_id"), "text")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document: the
    ids are encoded, then decoded, in the task that read the text."""
    def row(enc: PieceEncoder, text: str):
        ids = enc.encode(text) + [enc.end]
        return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(enc.decode(ids).encode("utf-8", "replace")).hexdigest())

    return _map(docs, path, row, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})
