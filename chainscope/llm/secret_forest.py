"""Secret scan with a random forest (native: DataFrame functions only).

Candidates are all whole runs of 16 or more token characters, digits among
them, in the whole text, several of a word included; each comes with up to two
words before its word and one after. In a word of several runs each is judged
with the text that touches it up to the next separator. Features:
length, character-class transitions, share of digits, of capitals and of
distinct characters, share covered by dictionary words, path and address
marks, and whether a neighbouring word is a key word.

Labelled findings train the forest: a candidate of a published key format or
directly assigned to a key word is a secret, one that is a path, address or
dictionary-covered is not; others are unlabelled. At most ``SAMPLE`` labelled findings by a hash
(a documented parameter) fit the forest; every candidate is scored and those
below ``KEEP_AT`` are removed as false positives.

Dictionary coverage is the share of the candidate in pronounceable letter
runs (four or more letters, a fifth of them vowels): the texts come in several
languages and no word list is given.

Null and empty texts have no candidates; a repeated row repeats its findings;
a null doc_id passes through; without findings, or with one class only, the
rules decide (score 1 for the secret formats, else 0).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.llm.common import filter_computed, id_text
from chainscope.operators.lineage import Scratch

SAMPLE = 20_000
KEEP_AT = 0.5
# Published key formats and key words.
FORMATS = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|" \
          r"AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*)$"
KEY_WORDS = r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|credential|private[_-]?key|auth)"
# A whole run of token characters that holds a digit.
RUN = r"(?<![A-Za-z0-9_+/=.-])(?=[A-Za-z_+/=.-]*+[0-9])[A-Za-z0-9_+/=.-]{16,}"
# What touches a run before and after it, in a word of several.
LEAD = r"(?<![^,;&{}\[\]])[^,;&{}\[\]]*+$"
TAIL = r'''^[^,;&{}\[\]"']*'''
FEATURES = ["length", "transitions", "digits", "capitals", "distinct", "coverage", "path", "near_key", "assigned"]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, run, word, raw, near_key, key_before): pos is the index
    of the word, run that of the candidate in it; raw is the candidate with
    the text around it."""
    words = id_text(docs).withColumn("w", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    hit = F.expr(f"""filter(sequence(0, size(w)), i -> i < size(w) AND length(get(w, i)) >= 16
                     AND get(w, i) rlike '{RUN}')""")
    rows = words.withColumn("i", hit)
    rows = rows.withColumn("f", F.expr("""transform(i, i -> struct(CAST(i AS BIGINT) AS pos, get(w, i) AS raw,
        concat_ws(' ', get(w, i - 2), get(w, i - 1)) AS before, coalesce(get(w, i + 1), '') AS after))"""))
    rows = filter_computed(rows.select("doc_id", "f"), F.size("f") > 0)
    rows = rows.select("doc_id", F.explode("f").alias("f")).select("doc_id", "f.*")
    # Neighbours are judged once a word, so that no run carries them along.
    rows = rows.select(
        "doc_id", "pos", "raw", (F.col("before").rlike(KEY_WORDS) | F.col("after").rlike(KEY_WORDS)).alias("near_key"),
        F.col("before").rlike(KEY_WORDS + r"""["']?\s*[:=]\s*["']?$""").alias("key_before"),
        F.regexp_extract_all("raw", F.lit(RUN), 0).alias("runs"), F.split("raw", RUN).alias("gaps"))
    found = F.transform("runs", lambda x, i: F.struct(
        i.cast("long").alias("run"), x.alias("word"),
        F.concat(F.regexp_extract(F.get("gaps", i), LEAD, 0), x,
                 F.regexp_extract(F.get("gaps", i + 1), TAIL, 0)).alias("around")))
    # Every row has a run, so outer adds none; the plain form would filter by
    # computing the array again.
    rows = rows.withColumn("n", F.size("runs")).withColumn("found", found)
    rows = rows.withColumn("raw", F.when(F.col("n") == 1, F.col("raw"))).drop("runs", "gaps")
    return rows.withColumn("c", F.explode_outer("found")).select(
        "doc_id", "pos", "c.run", "c.word", F.coalesce("raw", "c.around").alias("raw"), "near_key",
        (F.col("key_before") & (F.col("c.run") == 0)).alias("key_before"))


def _count(col, pattern: str):
    return F.length(col) - F.length(F.regexp_replace(col, pattern, ""))


def featurise(found: DataFrame) -> DataFrame:
    w, n = F.col("word"), F.length("word")
    # A mark is put wherever the character class changes.
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(w, "[a-z]+", "\u0001"), "[A-Z]+", "\u0002"), "[0-9]+", "\u0003")
    lower = F.regexp_replace(F.lower(w), "[^a-z]+", "")
    vowels = F.length(F.regexp_replace(lower, "[^aeiou]", ""))
    runs = F.regexp_extract_all(F.lower(w), F.lit("([a-z]{4,})"), 1)
    covered = F.aggregate(runs, F.lit(0), lambda a, x: a + F.length(x))
    return found.withColumns({
        "length": n.cast("double"), "transitions": (F.length(kinds) - 1) / n, "digits": _count(w, "[0-9]") / n,
        "capitals": _count(w, "[A-Z]") / n, "distinct": F.size(F.array_distinct(F.split(w, ""))) / n,
        "coverage": covered / n * F.when(vowels >= 0.2 * F.length(lower), 1.0).otherwise(0.3),
        "path": (w.rlike(r"/.*/|\.[a-z]{2,4}$") | F.col("raw").rlike(r"://|@|\.(?:com|org|net)")).cast("double"),
        "near_key": F.col("near_key").cast("double"),
        "assigned": (F.col("key_before") | F.col("raw").rlike(KEY_WORDS + r"""["']?[:=]""")).cast("double"),
    })


def label(rows: DataFrame) -> DataFrame:
    secret = F.col("word").rlike(FORMATS) | ((F.col("assigned") == 1) & (F.col("path") == 0))
    benign = (F.col("path") == 1) | (F.col("coverage") > 0.6) | (F.col("distinct") < 0.2) | (F.col("digits") > 0.9)
    return rows.withColumn("label", F.when(secret, 1.0).when(benign, 0.0))


def scan(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE, keep_at: float = KEEP_AT,
         trees: int = 20) -> DataFrame:
    """(doc_id, pos, run, finding, features..., score, kept) per candidate."""
    scratch = Scratch(spark, "secrets")
    rows = scratch.save(label(featurise(candidates(docs))), "findings")
    order = F.xxhash64("doc_id", "pos", "word")
    seen = rows.filter("label IS NOT NULL").orderBy(order, "doc_id", "pos", "run").limit(sample)
    seen = scratch.save(seen, "labelled")
    classes = {r[0] for r in seen.select("label").distinct().collect()}  # at most two
    if len(classes) < 2:
        scored = rows.withColumn("score", F.when(F.col("label") == 1, 1.0).otherwise(0.0))
    else:
        # "assigned" made part of the labels, so the forest learns from the rest.
        pack = VectorAssembler(inputCols=[f for f in FEATURES if f != "assigned"], outputCol="x")
        forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=6, seed=7)
        model = forest.fit(pack.transform(seen))
        scored = model.transform(pack.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "pos", "run", F.col("word").alias("finding"), *FEATURES, "label", "score",
                         (F.col("score") >= keep_at).alias("kept"))
