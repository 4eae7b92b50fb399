"""Line-first cleaning (native: DataFrame functions only).

Each line is judged on its own by three rules and removed when one fails:

* punctuation: a line of fewer than ``min_line_words`` words must hold some
  sentence punctuation, and symbols must not exceed ``max_symbol_share`` of
  its word characters;
* navigation: a line of two or more separators (``|``, ``»``, ``›``) with at
  most two words between them on average, or one made of menu words only;
* boilerplate: known phrases make up at least ``phrase_share`` of the line's
  word characters (a long line that only mentions one stays).

A document is rejected when the removed lines held more than
``max_lost_share`` of its word characters. Blank lines are never removed.

Null and empty texts have no words: every count is 0, the base check fails
and the document is not kept. Repeated rows are judged alike, an empty table
gives an empty result, null ids pass through. The whole work is per row: no
shuffle, so a hot source or group of copies has no effect.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainscope.llm.common import filter_computed

# Fixed values of the rules.
BOILERPLATE = ["all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
               "we use cookies", "accept cookies", "enable javascript", "lorem ipsum", "sign up for our newsletter",
               "click here to", "subscribe now", "powered by", "skip to content"]
MENU_WORDS = ["home", "menu", "login", "logout", "search", "contact", "about", "next", "previous", "share", "print",
              "help", "sitemap", "register", "subscribe"]
SYMBOLS = "#*$%&|<>"
BARS = "|»›"
SPACES = " \t\n\x0b\f\r"


def _without(col: Column, chars: str) -> Column:
    for c in chars:
        col = F.replace(col, F.lit(c), F.lit(""))
    return col


def _count_of(col: Column, chars: str) -> Column:
    """How many characters of ``col`` are among ``chars``."""
    return F.length(col) - F.length(_without(col, chars))


def _word_chars(col: Column) -> Column:
    return F.length(_without(col, SPACES))


def _line_ok(line: Column, min_line_words: int, max_symbol_share: float, phrase_share: float | None) -> Column:
    """Verdict on a line; ``phrase_share`` None leaves the phrases out. Terms
    are written so that most lines need only the cheap ones."""
    words = F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    enough = line.rlike(r"^[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){%d}[^\x20\x09-\x0D]"
                        % (min_line_words - 1))
    symbols, bars = _count_of(line, SYMBOLS), _count_of(line, BARS)
    ok = (enough | line.rlike(r"""[.!?:;,…。！？"')»”]""")) \
        & ((symbols == 0) | (symbols <= max_symbol_share * _word_chars(line))) \
        & ~((bars >= 2) & (words <= 3 * (bars + 1))) \
        & ~line.rlike(r"(?i)^[\x20\x09-\x0D]*(?:(?:" + "|".join(MENU_WORDS) + r")[\x20\x09-\x0D]*)+$")
    if phrase_share is not None:
        rest = F.regexp_replace(line, "(?i)(?:" + "|".join(BOILERPLATE) + ")", "")
        ok = ok & ~(line.rlike("(?i)" + "|".join(BOILERPLATE))
                    & (_word_chars(line) - _word_chars(rest) >= phrase_share * _word_chars(line)))
    return ~line.rlike(r"[^\x20\x09-\x0D]") | ok


def annotate(docs: DataFrame, *, min_words: int = 50, max_repeat_pct: int = 50, min_line_words: int = 6,
             max_symbol_share: float = 0.3, max_lost_share: float = 0.5, phrase_share: float = 0.3,
             prefix: str = "") -> DataFrame:
    """``docs`` with the counts, the cleaned text and the verdict, as columns
    whose names start with ``prefix`` (choose one that ``docs`` lacks)."""
    p = "_q9_"
    c = lambda n: F.col(p + n)
    df = docs.withColumn(p + "t", F.coalesce(F.col("text"), F.lit("")))
    df = df.withColumns({
        p + "w": F.filter(F.split(c("t"), r"[\x20\x09-\x0D]+"), lambda x: x != ""),
        p + "l": F.split(c("t"), "\n"), p + "low": F.lower(c("t"))})
    # Hashes of the 3-word windows (33 bits) before their positions (31 bits),
    # sorted, so that windows that may be equal are neighbours.
    df = df.withColumns({
        p + "h": F.expr(f"""CASE WHEN size({p}w) >= 3 THEN sort_array(transform(sequence(0, size({p}w) - 3),
            i -> shiftleft(xxhash64({p}w[i], {p}w[i+1], {p}w[i+2]), 31) | CAST(i AS BIGINT)))
            ELSE CAST(array() AS array<bigint>) END"""),
        p + "phrase": functools.reduce(Column.__or__, [F.contains(c("low"), F.lit(x)) for x in BOILERPLATE])})
    # Windows of equal hash, as exact text, sorted likewise.
    df = df.withColumns({
        p + "g": F.expr(f"""sort_array(transform(filter({p}h, (x, j) ->
            (j > 0 AND shiftright(get({p}h, j - 1), 31) = shiftright(x, 31))
            OR (j + 1 < size({p}h) AND shiftright(get({p}h, j + 1), 31) = shiftright(x, 31))),
            x -> named_struct('g', concat_ws(' ', {p}w[CAST(x & 2147483647 AS INT)],
                {p}w[CAST(x & 2147483647 AS INT) + 1], {p}w[CAST(x & 2147483647 AS INT) + 2]),
                'i', CAST(x & 2147483647 AS INT))))"""),
        p + "lw": F.filter(c("l"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        # Lines are searched for phrases only in texts that hold one.
        p + "kept": F.when(c("phrase"), F.filter(
            c("l"), lambda x: _line_ok(x, min_line_words, max_symbol_share, phrase_share))).otherwise(
            F.filter(c("l"), lambda x: _line_ok(x, min_line_words, max_symbol_share, None)))})
    df = df.withColumn(p + "r", F.expr(f"""filter({p}g, (x, j) ->
        (j > 0 AND get({p}g, j - 1).g = x.g) OR (j + 1 < size({p}g) AND get({p}g, j + 1).g = x.g)).i"""))
    df = df.withColumns({
        prefix + "n_words": F.size(c("w")).cast("long"),
        prefix + "word_chars": _word_chars(c("t")).cast("long"),
        prefix + "n_symbols": _count_of(c("t"), SYMBOLS).cast("long"),
        prefix + "n_dup_lines": (F.size(c("lw")) - F.size(F.array_distinct(c("lw")))).cast("long"),
        prefix + "n_repeat_words": F.expr(
            f"CAST(size(array_distinct(flatten(transform({p}r, i -> array(i, i+1, i+2))))) AS BIGINT)"),
        prefix + "clean_text": F.array_join(c("kept"), "\n"),
        prefix + "n_lines_removed": (F.size(c("l")) - F.size(c("kept"))).cast("long")})
    n = lambda x: F.col(prefix + x)
    df = df.withColumn(prefix + "lost_chars", F.when(n("n_lines_removed") == 0, F.lit(0).cast("long")).otherwise(
        n("word_chars") - _word_chars(n("clean_text"))))
    df = df.withColumn(prefix + "base_failed", (n("n_words") < min_words)
                       | (100 * n("n_repeat_words") > max_repeat_pct * n("n_words")))
    df = df.withColumn(prefix + "kept",
                       ~n("base_failed") & (n("lost_chars") <= max_lost_share * n("word_chars")))
    return df.drop(*[p + x for x in ("t", "w", "l", "low", "h", "phrase", "g", "lw", "kept", "r")])


def clean(docs: DataFrame, **params) -> DataFrame:
    """The kept documents with failing lines removed, columns of ``docs``."""
    q = "_q9out_"
    df = filter_computed(annotate(docs, prefix=q, **params), F.col(q + "kept"))
    out = []
    for name in docs.columns:
        if name == "text":
            out.append(F.col(q + "clean_text").alias("text"))
        elif name == "n_chars":
            out.append(F.length(q + "clean_text").cast(docs.schema[name].dataType).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
