"""Language of web pages by Bayesian evidence fusion.

For each page the log posterior of every language sums
* the text likelihood: hashed byte trigrams of the whole visible text under
  per-language distributions counted over all documents, tempered by
  ``TEMPER`` because trigrams overlap;
* the likelihood of the declared markup language and of the address suffix,
  each a smoothed table of (language, value) counts weighted by the text
  posteriors of all pages;
* the host's prior: posterior counts summed per host, smoothed towards the
  registered domain's, that towards the suffix's, that towards the whole
  (``STRENGTH`` pseudo-pages each).

All tables come from grouped aggregation. Hosts holding more than one page in
``HOT`` (at most ``HOT`` of them) are joined by broadcast, the rest by a
shuffle, so a host with a third of the pages makes no hot task.

A null or empty page, url or declaration gives no evidence of its kind; with
no evidence the prior decides and ties go to the first language in order.
Repeated rows get equal answers, a null id passes through, an empty page
table gives an empty result; without labelled documents the language is null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.llm.common import map_keyed
from chainscope.llm.hashing import posteriors
from chainscope.operators.lineage import Scratch

SLOTS = 1 << 14
TEMPER = 0.05
STRENGTH = 4.0
HOT = 1000


def trigrams(text: str) -> np.ndarray:
    """Hashed byte-trigram slots of the lower-cased text."""
    d = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    if len(d) < 3:
        return np.empty(0, dtype=np.int64)
    h = (d[:-2] * np.uint32(0x9E3779B1)) ^ (d[1:-1] * np.uint32(0x85EBCA6B)) ^ (d[2:] * np.uint32(0xC2B2AE35))
    return (h >> np.uint32(18)).astype(np.int64)


def slot_counts(docs: DataFrame) -> DataFrame:
    """(lang, slot, n) over all labelled documents; at most SLOTS rows per
    language and task before the grouped sum."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                acc = total.setdefault(lang, np.zeros(SLOTS, dtype=np.int64))
                acc += np.bincount(trigrams(text), minlength=SLOTS)
        for lang, acc in total.items():
            at = np.flatnonzero(acc)
            yield pd.DataFrame({"lang": lang, "slot": at, "n": acc[at]})
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return rows.mapInPandas(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, suffix, domain, host) of every page."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    body = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(body, r"&[A-Za-z0-9#]{1,10};|\s+", " ").alias("text"),
        F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]{0,1000}?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1)).alias("declared"),
        F.substring_index(host, ".", -1).alias("suffix"), F.substring_index(host, ".", -2).alias("domain"),
        host.alias("host"))


def identify(spark: SparkSession, docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, lang, posterior, text_lang, declared, host) per page."""
    scratch = Scratch(spark, "langid")
    counts = scratch.save(slot_counts(docs), "slots")
    langs = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]  # one row per language
    ev = page_evidence(pages)
    if not langs:
        return ev.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("posterior"),
                         F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    pdf = counts.toPandas()  # at most SLOTS rows per language
    table = np.full((len(langs), SLOTS), 0.5)
    table[[langs.index(x) for x in pdf["lang"]], pdf["slot"]] += pdf["n"].to_numpy()
    shared = spark.sparkContext.broadcast(np.log(table / table.sum(axis=1, keepdims=True)))
    k = len(langs)
    ll = [f"l{i}" for i in range(k)]
    post = [f"w{i}" for i in range(k)]

    def run(batches):
        for b in batches:
            logs = np.array([shared.value[:, trigrams(t)].sum(axis=1) for t in b["text"]]).reshape(len(b), k) * TEMPER
            out = b.drop(columns=["text"])
            p = posteriors(logs) if len(b) else logs
            for i in range(k):
                out[ll[i]], out[post[i]] = logs[:, i], p[:, i]
            yield out
    schema = "page_id long, declared string, suffix string, domain string, host string, " + \
        ", ".join(f"{a} double, {b} double" for a, b in zip(ll, post))
    scored = scratch.save(map_keyed(ev, run, schema, "page_id"), "text")

    def sums(key: str) -> DataFrame:
        return scored.groupBy(key).agg(*[F.sum(w).alias(w) for w in post], F.count(F.lit(1)).alias("n"))

    whole = scored.agg(*[F.coalesce(F.sum(w), F.lit(0.0)) for w in post], F.count(F.lit(1))).first()
    total, n_pages = np.array(whole[:k]), whole[k]
    base = (total + 1.0) / (n_pages + k)

    # Likelihood of a value given the language, one row per value.
    def likelihood(key: str) -> DataFrame:
        got = sums(key)
        width = got.count() + 1
        return got.select(key, *[
            F.when(F.col(key) == "", 0.0).otherwise(F.log((F.col(w) + 0.5) / F.lit(float(t) + 0.5 * width)))
            .alias(f"{key}_{i}") for i, (w, t) in enumerate(zip(post, total))])

    # Host prior, smoothed along host -> domain -> suffix -> whole.
    def smoothed(level: DataFrame, prior: list) -> list:
        return [(F.col(w) + STRENGTH * p) / (F.col("n") + STRENGTH) for w, p in zip(post, prior)]

    suffix = sums("suffix")
    suffix = suffix.select("suffix", *[c.alias(f"s{i}") for i, c in enumerate(smoothed(suffix, [F.lit(float(x)) for x in base]))])
    domain = sums("domain").withColumn("suffix", F.substring_index("domain", ".", -1)).join(suffix, "suffix")
    domain = domain.select("domain", *[c.alias(f"d{i}") for i, c in enumerate(smoothed(domain, [F.col(f"s{i}") for i in range(k)]))])
    host = sums("host").withColumn("domain", F.substring_index("host", ".", -2)).join(domain, "domain")
    host = host.select("host", "n", *[F.log(c).alias(f"h{i}") for i, c in enumerate(smoothed(host, [F.col(f"d{i}") for i in range(k)]))])

    host = scratch.save(host, "hosts")
    hot = host.filter(F.col("n") * HOT > n_pages).drop("n")  # at most HOT rows
    flagged = scored.join(F.broadcast(hot.select("host", *[F.col(f"h{i}").alias(f"x{i}") for i in range(k)])), "host", "left")
    names = [f"h{i}" for i in range(k)]
    hot_rows = flagged.filter("x0 IS NOT NULL").select("*", *[F.col(f"x{i}").alias(f"h{i}") for i in range(k)])
    cold = flagged.filter("x0 IS NULL").join(host.filter(F.col("n") * HOT <= n_pages).drop("n"), "host")
    rows = hot_rows.select(*scored.columns, *names).unionByName(cold.select(*scored.columns, *names))
    # Declared values are two- or three-letter codes (at most 18,252 + 1) and
    # suffix likelihoods go through the same hot split by being few; a suffix
    # table beyond the broadcast bound is left to the planner.
    rows = rows.join(F.broadcast(likelihood("declared")), "declared").join(likelihood("suffix"), "suffix")
    logit = [F.col(f"l{i}") + F.col(f"declared_{i}") + F.col(f"suffix_{i}") + F.col(f"h{i}") for i in range(k)]
    rows = rows.select("page_id", "declared", "host", F.array(*logit).alias("z"), F.array(*ll).alias("t"))
    names_ = F.array(*[F.lit(x) for x in langs])
    best = F.array_max("z")
    return rows.select(
        "page_id", F.element_at(names_, F.array_position("z", best).cast("int")).alias("lang"),
        (F.lit(1.0) / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - best))).alias("posterior"),
        F.element_at(names_, F.array_position("t", F.array_max("t")).cast("int")).alias("text_lang"),
        "declared", "host")
