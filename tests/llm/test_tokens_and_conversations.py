"""Piece encoding, token alignment and conversation repair against the
libraries and brute force, edge rows included."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from chainscope.llm import conversation_repair as cr, piece_bpe, token_alignment as ta

SF = "/root/testdata/sf0.001"
BIG = 9007199254740993
SCHEMA = "doc_id long, text string, key string, block string, pairs string, n_a long"
ALPHABET = list("aaaeeinorstt hello  ▁\n\t.,1230é中🎉́<s></s>\x00\x1c\x85　'%") + ["</s>", "<|endoftext|>", "<0x41>", " the", "ing"]
LONG = " ".join(f"word{i % 700} filler." for i in range(6000))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    texts = [None, "", " ", "  ", "▁", "a ▁ b", LONG, LONG, "x" * 5000, " " * 333, "one two", "one two",
             "日本語 👍\n\n x", *("".join(rnd.choices(ALPHABET, k=rnd.randint(1, 60))) for _ in range(300))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(BIG, "big id"), (BIG, "big id again"), (None, "no id")]
    extra = spark.createDataFrame([(i, t, "k", "b", "p", 7) for i, t in rows], SCHEMA)
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return extra.unionByName(real, allowMissingColumns=True).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def as_bag(got):
    return Counter(tuple(r) for r in got)


def sha(b):
    return hashlib.sha256(b).hexdigest()


# --- pieces ---------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_match_the_library(docs, rows, library):
    def brute(t):
        ids = library.encode(t, add_eos=True)
        return len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode(ids).encode())
    assert as_bag(piece_bpe.digests(docs).collect()) == Counter((i, *brute(t)) for i, t in rows)


def test_pieces_round_trip(docs, rows):
    got = piece_bpe.decode(piece_bpe.encode(docs)).collect()
    assert as_bag(got) == Counter((i, t.replace("▁", " ")) for i, t in rows)


def test_backtracking_gives_back_pieces(library):
    """Whole strings of letters, uncut: greedy longest pieces are often wrong."""
    enc = piece_bpe.encoder(public_tokenizers.path("piece_bpe_32k.model"))
    rnd = random.Random(5)
    greedy_differs = 0
    for _ in range(500):
        s = "▁" + "".join(rnd.choices("abcdeinorst", k=rnd.randint(2, 40)))
        got = enc.backtrack(s)
        assert [enc.id[p] for p in got] == library.encode(s[1:])
        greedy, at = [], 0
        while at < len(s):
            n = next(n for n in range(len(s) - at, 0, -1) if s[at:at + n] in enc.id)
            greedy.append(s[at:at + n])
            at += n
        greedy_differs += greedy != got
    assert greedy_differs > 50


def test_runs_of_spaces(library):
    enc = piece_bpe.encoder(public_tokenizers.path("piece_bpe_32k.model"))
    for n in range(200):
        for tail in ("", "the", ". x"):
            assert enc.encode(" " * n + tail) == library.encode(" " * n + tail)


def test_long_merge_equals_short():
    score = {"ab": 3.0, "bc": 2.0, "abc": 1.0, "aa": 0.0, "bb": 0.0}
    for k in range(1, 8):
        for t in itertools.product("abc", repeat=k):
            text = "".join(t)
            padded = "x" * 40 + text
            assert piece_bpe.merge(padded, score)[40:] == piece_bpe.merge(text, score)


def test_memo_is_bounded():
    made = []
    memo = piece_bpe.Memo(lambda k: made.append(k) or k, 10)
    for k in [*range(50), 49]:
        assert memo[k] == k
    assert len(memo) + len(memo.older) <= 10 and made.count(49) == 1


# --- alignment --------------------------------------------------------------

def brute_alignment(rows):
    a_tool = Tokenizer.from_file(public_tokenizers.path(ta.FILE_A))
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(ta.FILE_B))
    byte = ta._byte_of_symbol()

    def bytes_b(i):
        p = b_tool.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for key, t in rows:
        enc = a_tool.encode(" " + t, add_special_tokens=False) if t else None
        a, b = (enc.ids, b_tool.encode(t)) if t else ([], [])
        cut_a = [bytes(byte[c] for c in s) for s in enc.tokens] if t else []
        cut_b = [bytes_b(i) for i in b]
        if not t or not b"".join(cut_a) == b"".join(cut_b) == (" " + t).encode():
            docs.append((key, [], [], [], []))
            continue
        ends_a = {e: i for i, e in enumerate(itertools.accumulate(map(len, cut_a)))}
        ends_b = {e: i for i, e in enumerate(itertools.accumulate(map(len, cut_b)))}
        groups, links, i, j = [], [], 0, 0
        for e in sorted(ends_a.keys() & ends_b.keys()):
            x, y = ends_a[e] + 1, ends_b[e] + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        docs.append((key, a, b, groups, links))
    count = Counter(p for d in docs for p in d[4])
    held = Counter(p for d in docs for p in set(d[4]))
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return Counter((k, len(a), len(b), len(g), len(p), sum(count[x] == top[x[1]] for x in p), sum(count[x] for x in p),
                    sha(";".join(g).encode()) if g else "", sum(held[x] == 1 for x in p)) for k, a, b, g, p in docs)


@pytest.mark.parametrize("block_chars", [500, ta.BLOCK_CHARS])
def test_alignment_matches_brute_force(spark, docs, rows, block_chars):
    got = ta.align(spark, docs, block_chars=block_chars)
    assert got.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert as_bag(got.collect()) == brute_alignment(rows)


def test_units_are_aligned_together():
    """One run over the tokens of many units gives what each gives alone,
    those whose bytes differ on one side among them."""
    tool = ta.Aligner(public_tokenizers.path(ta.FILE_A), public_tokenizers.path(ta.FILE_B))
    units = [" the", " naïve\u200b", " \u3000x", " 中文", "<|endoftext|>", " tokenizers", " \ufb01t", " Z"]
    ids_a = [e.ids for e in tool.a.encode_batch_fast(units, add_special_tokens=False)]
    ids_b = tool._ids_b(units)
    ids_a[3], ids_b[5] = ids_a[0], [*ids_b[5][:-1], ids_b[0][-1]]
    ids_b[7] = tool._ids_b([" Q"])[0]  # as long, with other bytes
    fields = ("exact", "n_a", "n_b", "n_groups", "groups", "pairs")
    together = [[getattr(u, f) for f in fields] for u in tool.align(units, ids_a, ids_b)]
    alone = [[getattr(tool.align([u], [a], [b])[0], f) for f in fields] for u, a, b in zip(units, ids_a, ids_b)]
    assert together == alone
    exact = [b"".join(tool.bytes_a[i] for i in a) == u.encode() == b"".join(tool.bytes_b[i] for i in b)
             for u, a, b in zip(units, ids_a, ids_b)]
    assert [t[0] for t in together] == exact and exact[0] and not (exact[3] or exact[5] or exact[7])
    assert [t[3] for t in together] == [t[4].count("|") for t in together] == [len(t[5]) // 8 for t in together]


def test_bitmaps_round_trip_and_count():
    import numpy as np
    rnd = np.random.default_rng(1)
    n_pairs, n_docs = 40, 333
    # Pair 0 in nearly every document, most in a few, pair 39 in none.
    full = rnd.random((n_pairs, n_docs)) < np.concatenate([[0.9, 0.3], np.full(37, 0.02), [0]])[:, None]
    times = full * rnd.integers(1, 12, full.shape)
    pair, doc = np.nonzero(full)
    planes = ta.unpack_planes(ta.pack_planes(ta.planes_of(pair, doc, times[pair, doc], n_pairs, n_docs)))
    docs, links = ta.pair_totals(planes, n_pairs)
    assert docs.tolist() == full.sum(axis=1).tolist() and links.tolist() == times.sum(axis=1).tolist()
    back = np.zeros_like(times)
    for k, p in enumerate(planes):
        back[p.entries()] += 1 << k
    assert (back == times).all() and len(planes[0].dense) == 2


# --- conversations ------------------------------------------------------------

TALK = "conv_id long, turn long, role string, text string, audit string, dropped boolean"


def brute_damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind != 0:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            for _ in range(2 if kind == 3 else 1):
                yield conv, turn, "user" if kind == 4 else role, text


def brute_repair(talk):
    """(counts, cheapest audit, repaired text) with whole edit strings."""
    talk = sorted(talk, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = {r[1] for r in talk} - {None}
    faults, seen, plan = Counter(), set(), []
    for _, _, role, text in talk:
        shown = text.rstrip(" \t\n\v\f\r")
        kind = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[kind] += 1
        plan.append((role, text, kind))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(talk, talk[1:]))

    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(4):
            for state, (cost, audit, out) in list(best.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in step:
                        new, to = (cost + 3, audit + "I", out + (role + ":",)), step[state, role[0]]
                        if to not in best or new[:2] < best[to][:2]:
                            best[to] = new
        return best

    for role, text, kind in plan:
        nxt = {}
        for state, (cost, audit, out) in insert(best).items():
            tries = [(state, cost + 4, audit + "D", out)]
            if kind not in ("blank", "duplicate"):
                extra = 3 if kind == "truncated" else 0
                if (state, role[:1]) in step:
                    tries.append((step[state, role[:1]], cost + extra, audit + "K", out + (f"{role}:{text}",)))
                for r in ("user", "assistant"):
                    if (state, r[0]) in step:
                        tries.append((step[state, r[0]], cost + extra + 3, audit + "R", out + (f"{r}:{text}",)))
            for to, *new in tries:
                if to not in nxt or tuple(new[:2]) < nxt[to][:2]:
                    nxt[to] = tuple(new)
        best = nxt
    cost, audit, out = min((b[:3] for s, b in insert(best).items() if s in ("", "a")), key=lambda b: b[:2])
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"],
            faults["truncated"], illegal, cost, audit, sha("\n".join(out).encode()))


def brute_all(rows):
    talks = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        talks[r[0]].append(r)
    return Counter((conv, *brute_repair(t)) for conv, t in talks.items())


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(11)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No?", "Why not", "", " \t", None, "A longer answer. With two sentences.", "cut off,", "x!\n", "é。"]
    rows = []
    for conv in [*range(150), BIG, BIG + 2, None]:
        for turn in range(rnd.randint(1, 14)):
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 5, None]), rnd.choice(roles), rnd.choice(texts)))
    return rows + [(700, i, "user" if i % 2 else "assistant", f"turn {i}.") for i in range(3000)]


def test_repair_matches_brute_force(spark, talks):
    rows = [(*r, "x", False) for r in talks]
    got = cr.repair(cr.damage(spark.createDataFrame(rows, TALK).repartition(4)))
    assert as_bag(got.collect()) == brute_all(talks)


def test_repair_of_the_given_table(spark):
    talks = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    assert as_bag(cr.repair(cr.damage(talks)).collect()) == brute_all(rows)


def test_repair_of_empty_and_wholly_dropped(spark):
    empty = spark.createDataFrame([], TALK)
    assert cr.repair(cr.damage(empty)).count() == 0
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = cr.repair(cr.damage(spark.createDataFrame([(*r, "x", False) for r in gone], TALK))).collect()
    assert as_bag(got) == Counter((r[0], 0, 0, 0, 0, 0, 0, "", sha(b"")) for r in gone) and gone


def test_spilled_state_gives_the_same(talks):
    rows = [r for r in brute_damage(talks) if r[0] == 700]
    want = brute_repair(rows)
    one = cr.Conversation(cr.Steps(), seen_bound=50, steps_bound=64)
    for _, turn, role, text in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        one.add(str(turn), role, text)
    assert one.chosen.file is not None and one.seen.far is not None
    assert tuple(one.result().values()) == want


def test_every_edit_string_of_short_talks():
    """The search against all edit strings, grammar as a pattern."""
    rnd = random.Random(2)
    for _ in range(60):
        talk = [(0, i, rnd.choice(["system", "user", "assistant", "tool"]), rnd.choice(["a.", "b", "c!", "", "a."]))
                for i in range(rnd.randint(0, 3))]
        seen, must = set(), []
        for _, _, role, text in talk:
            must.append((not text, (role, text) in seen))
            seen.add((role, text))
        found = []
        gaps = ["", "u", "a", "ua", "au", "uu", "aa"]
        for adds in itertools.product(gaps, repeat=len(talk) + 1):
            for edits in itertools.product(*[["D"] if any(m) else ["D", "K", "Ru", "Ra"] for m in must]):
                roles, cost, audit = adds[0], 3 * len(adds[0]), "I" * len(adds[0])
                for (_, _, role, text), e, add in zip(talk, edits, adds[1:]):
                    if e != "D":
                        roles += role[0] if e == "K" else e[1]
                        cost += (0 if e == "K" else 3) + (0 if text[-1] in ".!?" else 3)
                    else:
                        cost += 4
                    roles, cost, audit = roles + add, cost + 3 * len(add), audit + e[0] + "I" * len(add)
                if re.fullmatch("(s?(ua)+)?", roles):
                    found.append((cost, audit))
        assert brute_repair(talk)[5:7] == min(found)
