"""Offset-preserving deobfuscation and detection of personal data.

Base detectors run on the source text. Then transducers rewrite disguises
(homoglyphs and full-width forms, spelled digits, at/dot words) into plain
characters while keeping, for every output character, the source span it came
from; the same detectors run on the rewritten text and their spans are mapped
back. A found span is added unless it equals or lies within a base span of its
kind, so an identifier of which the base detectors see a part is listed whole
as well; base spans always stay, and redaction merges overlaps.

What counts as a disguise: after a bracketed at any dot, and after a plain @ or
a bare " at " a bracketed dot, may lead to any last label of two or more
letters; only where prose could read the same (bare " at " with plain or bare
dots, @ with a bare " dot ") must it be one of ``TLDS``. A bare " at " before
a plainly dotted host counts only if the name holds a digit or a dot: "jane at
gmail.com" reads like "look at example.com" and is left. A dot disguise
between digits is a dot. Runs of four or more digit words, and shorter ones
beside digits, are digits, so a number word right after a phone number joins
its span.

Every detector and transducer is linear in the text length. Null and empty
texts have no spans; repeated rows get equal results; a null doc_id passes
through; an empty table gives an empty result. All work is per row.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.llm.common import id_text, map_keyed

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run's first digit is the only start worth trying, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            low = m.end()
        else:
            low = at + 1
        at = text.find("@", low)
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def _card_ok(s: str) -> bool:
    d = _NON_DIGIT.sub("", s)
    return 13 <= len(d) <= 19 and _luhn(d)


def _phone_ok(s: str) -> bool:
    return 9 <= len(_NON_DIGIT.sub("", s)) <= 15


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans (start, end) in code points of each kind, end exclusive."""
    return {
        "email": _emails(text) if "@" in text else [],
        "ip": [m.span() for m in _IP.finditer(text) if _ip_ok(m.group())],
        "card": [m.span() for m in _CARD.finditer(text) if _card_ok(m.group())],
        "phone": [m.span() for m in _PHONE.finditer(text) if _phone_ok(m.group())] if "+" in text else [],
    }


# Characters that look like a plain one.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "Α": "A", "Β": "B", "Ε": "E", "Ο": "O",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", " ": " ", " ": " ", " ": " ",
    "​": "", "‌": "", "‍": "", "⁠": "", "﻿": "", "­": "",
}
# Full-width ASCII by rule, and the Arabic-Indic digits.
HOMOGLYPHS |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
HOMOGLYPHS |= {chr(0x0660 + d): str(d) for d in range(10)} | {chr(0x06F0 + d): str(d) for d in range(10)}

# Digit words, and the top-level domains taken for one in
# forms that could be prose.
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
               "seven": "7", "eight": "8", "nine": "9"}
TLDS = "com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|us|example|test"

_GLYPH = re.compile("[" + re.escape("".join(HOMOGLYPHS)) + "]")
_D = "(?:" + "|".join(DIGIT_WORDS) + ")"
_AT = r"[\x20]{0,3}[\[({<][\x20]?(?:at|@)[\x20]?[\])}>][\x20]{0,3}"
_DOT = r"[\x20]{0,3}[\[({<][\x20]?(?:dot|\.)[\x20]?[\])}>][\x20]{0,3}"
_WORD_DOT = rf"(?:{_DOT}|[\x20]dot[\x20])"
_DIGIT_DOT = rf"(?:{_DOT}|[\x20-](?:dot|point)[\x20-])"
# Runs of digit words, "plus" before and "point"/"dot" allowed inside: taken
# as digits when of four or more words, or beside digits.
_SPELLED = re.compile(rf"(?i)\b(?:plus[\x20-])?{_D}(?:(?:{_DIGIT_DOT}|[\x20-]){_D})*\b")
_SPELLED_TOKEN = re.compile(r"(?i)[a-z]+|[^a-z]")
_DIGITS_BEFORE = re.compile(rf"(?i)[0-9](?:[\x20().-]{{1,3}}|{_DIGIT_DOT})\Z")
_DIGITS_AFTER = re.compile(rf"(?i)(?:[\x20().-]{{1,3}}|{_DIGIT_DOT})[0-9]")
_DOT_IN_DIGITS = re.compile(rf"(?i)[0-9]({_DIGIT_DOT})(?=[0-9])")
_LABEL = r"[A-Za-z0-9-]{1,63}"
_SEP = rf"(?:\.|{_WORD_DOT})"
_TOP = r"(?:xn--[A-Za-z0-9-]{1,59}|[A-Za-z]{2,63})"
# "x [at] y [dot] it", "x at y dot com", "x [at] y.it", "x@y dot com".
_DISGUISE = re.compile(
    rf"(?i)(?<![A-Za-z0-9])(?P<local>[A-Za-z0-9_%+-]{{1,64}}(?:{_SEP}[A-Za-z0-9_%+-]{{1,64}}){{0,4}})"
    rf"(?P<at>(?P<marked>{_AT})|(?P<sign>@)|[\x20]at[\x20])(?P<domain>{_LABEL}(?:{_SEP}{_LABEL}){{0,4}}"
    rf"(?:{_DOT}{_TOP}|(?(marked){_SEP}{_TOP}|(?(sign)(?:\.{_TOP}|[\x20]dot[\x20](?:{TLDS}))|{_SEP}(?:{TLDS})))))"
    rf"(?![A-Za-z0-9])")
_DOT_WORD = re.compile(_WORD_DOT, re.I)
_AT_HINT = re.compile(rf"(?i){_AT}|[\x20]at[\x20]{_LABEL}(?:\.|{_WORD_DOT})|@{_LABEL}(?:\.{_LABEL})*{_WORD_DOT}"
                      rf"|{_WORD_DOT}[A-Za-z0-9._%+-]{{1,64}}@")


class Mapped:
    """A rewritten text with the source span of every character."""

    def __init__(self, text: str):
        self.text = text
        self.start = range(len(text))
        self.end = range(1, len(text) + 1)

    def rewrite(self, subs: list[tuple[int, int, str]]) -> None:
        """Replace the given ascending, disjoint spans of the current text."""
        if not subs:
            return
        parts, start, end, at = [], [], [], 0
        for a, b, new in subs:
            parts += [self.text[at:a], new]
            start += self.start[at:a]
            end += self.end[at:a]
            start += [self.start[a]] * len(new)
            end += [self.end[b - 1]] * len(new)
            at = b
        parts.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        self.text, self.start, self.end = "".join(parts), start, end


def _spelled(text: str, found: re.Match) -> list[tuple[int, int, str]]:
    run, at = found.group(), found.start()
    words = [w for w in _SPELLED_TOKEN.findall(run) if w.lower() in DIGIT_WORDS]
    if len(words) < 4 and not (_DIGITS_BEFORE.search(text[max(0, at - 20):at])
                               or _DIGITS_AFTER.match(text, found.end())):
        return []
    subs = []
    for m in _SPELLED_TOKEN.finditer(run):
        word = m.group().lower()
        new = {"plus": "+", "dot": ".", "point": ".", ".": "."}.get(word) or DIGIT_WORDS.get(word, "")
        subs.append((at + m.start(), at + m.end(), new))
    return subs


def normalise(text: str) -> Mapped | None:
    """The rewritten text, or None when no transducer has anything to do."""
    m = Mapped(text)
    if not text.isascii():
        m.rewrite([(g.start(), g.end(), HOMOGLYPHS[g.group()]) for g in _GLYPH.finditer(m.text)])
    m.rewrite([s for run in _SPELLED.finditer(m.text) for s in _spelled(m.text, run)])
    m.rewrite([(*g.span(1), ".") for g in _DOT_IN_DIGITS.finditer(m.text)])
    subs, last = [], 0
    for hint in _AT_HINT.finditer(m.text):
        # A disguised address starts within its local part, at most a few
        # labels before the hint.
        for g in _DISGUISE.finditer(m.text, max(last, hint.start() - 400), min(len(m.text), hint.end() + 400)):
            if g.start() < last:
                continue
            bare = g["at"].lower() == " at " and not _DOT_WORD.search(g["domain"])
            if bare and "." not in g["local"] and not any(ch.isdigit() for ch in g["local"]):
                continue  # "look at example.com" is prose
            for part in ("local", "domain"):
                subs += [(g.start(part) + d.start(), g.start(part) + d.end(), ".") for d in _DOT_WORD.finditer(g[part])]
            subs.append((g.start("at"), g.end("at"), "@"))
            last = g.end()
    m.rewrite(sorted(subs))
    return None if isinstance(m.start, range) else m


def find(text: str) -> tuple[dict, dict]:
    """(base spans, all spans) by kind, in source code points."""
    base = detect(text)
    every = {k: list(v) for k, v in base.items()}
    m = normalise(text)
    if m is not None:
        for kind, spans in detect(m.text).items():
            # Base spans ascend and are disjoint: only the last one that
            # starts no later can hold the found one.
            have = base[kind]
            starts = [x for x, _ in have]
            for a, b in spans:
                s, e = m.start[a], max(m.end[a:b])
                i = bisect.bisect_right(starts, s) - 1
                if i < 0 or e > have[i][1]:
                    every[kind].append((s, e))
            every[kind] = sorted(set(every[kind]))
    return base, every


def _listing(spans: dict) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def spans(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their digest, and the listing of all spans."""
    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                base, every = find(text)
                rows.append((doc_id, *(len(base[k]) for k in KINDS),
                             hashlib.sha256(_listing(base).encode()).hexdigest(), _listing(every),
                             sum(len(every[k]) - len(base[k]) for k in KINDS)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                                              "spans", "n_added"])
    return map_keyed(id_text(docs), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                         "base_sha256 string, spans string, n_added long")


def redact_text(text: str) -> str:
    """``text`` with every span replaced by ``[EMAIL]``, ``[IP]``, ...;
    overlapping spans are merged under the first one's kind."""
    _, every = find(text)
    found = sorted((a, b, k) for k in KINDS for a, b in every[k])
    out, at = [], 0
    for a, b, kind in found:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """Every document with its spans redacted, columns of ``docs`` (a null
    text stays null; ``n_chars`` follows the text)."""
    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        return texts.map(redact_text, na_action="ignore")

    # Only the text goes through Python; the other columns stay as they are.
    out = docs.withColumn("text", redacted("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out
