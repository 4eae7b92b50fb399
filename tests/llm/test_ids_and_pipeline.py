"""Ids of any size through every operator, and the pipeline's stages in a row."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from chainscope.llm import (byte_bpe, language_id, pii, quality_rules, quartile_digest, simhash, soft_mixing,
                            suffix_tree, weak_quality)

BIG = [9007199254740993, 9007199254740995, -9007199254740997, 9223372036854775807, None]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def big(spark):
    rows = [(i, f"text number {n} of a few words, long enough to be told apart. " * 3, "en", 9007199254740993 if n % 2 else None)
            for n, i in enumerate(BIG)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").coalesce(1).cache()


@pytest.mark.parametrize("run", [
    lambda s, d, lb: soft_mixing.rates(s, d, lb), lambda s, d, lb: quartile_digest.compare(s, d),
    lambda s, d, lb: suffix_tree.score(s, d), lambda s, d, lb: weak_quality.score(s, d),
    lambda s, d, lb: simhash.near_duplicates(s, d), lambda s, d, lb: pii.spans(d), lambda s, d, lb: pii.redact(d),
    lambda s, d, lb: quality_rules.annotate(d), lambda s, d, lb: byte_bpe.digests(s, d),
    lambda s, d, lb: language_id.identify(s, d, d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"),
                                                         F.lit("http://a.example").alias("url"))).withColumnRenamed("page_id", "doc_id"),
], ids=["op1", "op2", "op3", "op4", "op7", "op8", "redact", "op9", "op10", "op5"])
def test_ids_stay_exact_beside_a_null(spark, big, run):
    labels = spark.createDataFrame([(BIG[0], 1, 0), (BIG[1], 0, 0)], "doc_id long, quality int, toxic int")
    assert Counter(r.doc_id for r in run(spark, big, labels).collect()) == Counter(BIG)


def test_redact_leaves_other_columns(spark):
    rows = [(1, "mail joe@example.com now", 5, 9007199254740993), (2, None, 7, None), (3, "", None, 1)]
    got = pii.redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars int, other long")).collect()
    assert [tuple(r) for r in got] == [(1, "mail [EMAIL] now", 16, 9007199254740993), (2, None, 7, None), (3, "", 0, 1)]


def test_short_texts_have_digests_of_their_own():
    texts = ["", "a", "b", "ab", "abc", "xyz", "abcd"]
    assert len({quartile_digest.digest(t) for t in texts}) == len(texts)


def test_weak_verdict_is_the_scorers(spark, big):
    assert all(r.kept == (r.score >= 0.5) for r in weak_quality.score(spark, big).collect())


def test_pipeline_stages_in_a_row(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, steps[-1], SF).write.parquet(out)
        steps.append(spark.read.parquet(out))
    for step in steps[1:-1]:
        assert step.columns == docs.columns
    judged = {r.doc_id: r for r in quality_rules.annotate(docs).collect()}
    one = {r.doc_id: r.text for r in steps[1].collect()}
    assert one == {i: judged[i].clean_text for i in texts if judged[i].kept} and 0 < len(one) < len(texts)
    # Near duplicates by all pairs of fingerprints; the smallest id stays.
    fp = {r.doc_id: int(r.fingerprint, 16) for r in simhash.near_duplicates(spark, steps[1]).collect()}
    comp = {i: i for i in fp}
    for _ in fp:
        low = {i: min(comp[j] for j in fp if (fp[i] ^ fp[j]).bit_count() <= 3) for i in fp}
        if low == comp:
            break
        comp = low
    two = {r.doc_id: r.text for r in steps[2].collect()}
    assert two == {i: one[i] for i in one if comp[i] == i}
    three = {r.doc_id: (r.text, r.n_chars) for r in steps[3].collect()}
    assert three == {i: (pii.redact_text(t), len(pii.redact_text(t))) for i, t in two.items()}
    rates = soft_mixing.rates(spark, steps[3], spark.read.parquet(f"{SF}/labels.parquet"))
    copies = {r.doc_id: r.n for r in rates.select("doc_id", soft_mixing.copies(F.col("rate"), F.col("doc_id")).alias("n")).collect()}
    four = Counter((r.doc_id, r.text) for r in steps[4].collect())
    assert four == +Counter({(i, three[i][0]): copies[i] for i in three})
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANK_FILE)))
    want = Counter()
    for (i, t), n in four.items():
        ids = enc.encode_ordinary(t)
        want[(i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
              hashlib.sha256(t.encode()).hexdigest())] += n
    assert Counter(tuple(r) for r in steps[5].select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want
