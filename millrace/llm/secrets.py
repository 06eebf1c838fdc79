"""Secret scans (operator 8): a random forest removes false positives from candidate findings.

Candidates are long runs of letters, digits and ``_ + / -`` in every whole
text.  Each gets numbers for its length, its character transitions (changes of
character class, changes between vowel and consonant, share of digits and
capitals, distinct characters), its dictionary coverage (share of its
characters inside words that are among the ``DICTIONARY`` most frequent of the
corpus, found by joining its substrings with the dictionary), its path, and the
words around it.  The forest is fitted on labelled findings, at most
``MOST_LABELLED`` of them (by hash order), and scores every candidate.

``labelled`` marks the findings whose truth their form settles (a fixed-format
key id or a hexadecimal value assigned to a secret-like name: true; plain lower
case words: false); other labels can be passed to ``fit`` instead.  Everything is
DataFrame functions and the JVM's own forest.

Defined cases: null and empty texts have no candidates; where the labels do not
hold both classes there is no forest and the score is the label itself (0.5
where unknown); null ids and paths are kept (a null path counts as empty);
repeated rows give repeated findings; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.pii import found

CANDIDATE = r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}={0,2}"
SECRET_NAME = r"(?i)(token|secret|passw(or)?d|passwd|pwd|api.?key|access.?key|auth|credential|private)"
CONTEXT = 32
DICTIONARY = 5000  # words; bounds what is broadcast
WORD_MIN, WORD_MAX = 3, 12
MOST_LABELLED = 50_000
TREES, DEPTH, SEED = 24, 6, 17
FEATURES = ["length", "class_changes", "vowel_changes", "digits", "capitals", "distinct", "coverage",
            "path_depth", "path_length", "path_test", "named", "assigned", "quoted"]


def _share(v: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(v, pattern, "")) / F.length(v)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """finding, doc_id, start, end, value and the form, path and context numbers of every candidate."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    spans = F.when(text.rlike("[A-Za-z0-9_+/-]{16}"), found(text, CANDIDATE))
    rows = docs.select("doc_id", text.alias("text"), where.alias("path"), spans.alias("spans")) \
        .select("doc_id", "text", "path", F.explode("spans").alias("x")).select("doc_id", "text", "path", "x.*")
    left = F.substring("text", F.greatest(F.col("start") + 1 - CONTEXT, F.lit(1)), F.least("start", F.lit(CONTEXT)))
    rows = rows.withColumn("left", left).withColumn("right", F.substring("text", F.col("end") + 1, F.lit(2)))
    v = F.col("value")
    classes = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[_+/=-])(?=[^_+/=-])"
    vowels = r"(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])"
    return rows.select(
        F.monotonically_increasing_id().alias("finding"), "doc_id", "start", "end", "value", "left",
        F.length(v).cast("double").alias("length"),
        (F.regexp_count(v, F.lit(classes)) / F.length(v)).alias("class_changes"),
        (F.regexp_count(v, F.lit(vowels)) / F.length(v)).alias("vowel_changes"),
        _share(v, "[^0-9]").alias("digits"), _share(v, "[^A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split(v, ""))) / F.length(v)).alias("distinct"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("path_depth"), F.length("path").cast("double").alias("path_length"),
        F.col("path").rlike("(?i)test|example|sample|doc|fixture").cast("double").alias("path_test"),
        F.col("left").rlike(SECRET_NAME).cast("double").alias("named"),
        F.col("left").rlike(r"[=:]\s*[\"'`]?$").cast("double").alias("assigned"),
        (F.col("left").rlike("[\"'`]$") & F.col("right").rlike("^[\"'`]")).cast("double").alias("quoted"))


def dictionary(docs: DataFrame) -> DataFrame:
    """The most frequent words of all documents."""
    words = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), r"[^\p{L}]+")
    return docs.select(F.explode(words).alias("word")).where(F.length("word").between(WORD_MIN, WORD_MAX)) \
        .groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word")


def coverage(found_: DataFrame, words: DataFrame) -> DataFrame:
    """finding, coverage: the share of its characters inside dictionary words."""
    at = found_.select("finding", F.lower("value").alias("v"), F.length("value").alias("len")) \
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("len") - WORD_MIN + 1)))
    parts = at.withColumn("w", F.explode(F.sequence(F.lit(WORD_MIN), F.least(F.lit(WORD_MAX), F.col("len") - F.col("i") + 1)))) \
        .select("finding", "len", "i", "w", F.expr("substring(v, i, w)").alias("word"))
    hit = parts.join(F.broadcast(words), "word").groupBy("finding", "len", "i").agg(F.max("w").alias("w"))
    covered = hit.select("finding", "len", F.explode(F.sequence(F.col("i"), F.col("i") + F.col("w") - 1)).alias("c")).distinct()
    return covered.groupBy("finding").agg((F.count("*") / F.first("len")).alias("coverage"))


def labelled(findings: DataFrame) -> DataFrame:
    """``findings`` with ``label``: 1.0 or 0.0 where the form settles it, else null."""
    key_id = F.col("value").rlike("^A[KS]IA[A-Z0-9]{16}$")
    assigned_hex = F.col("value").rlike("^[0-9a-f]{16,}$") & (F.col("named") == 1) & (F.col("assigned") == 1)
    plain = F.col("value").rlike("^[A-Z]?[a-z]+$") | F.col("value").rlike("^[A-Z]+$")
    return findings.withColumn("label", F.when(key_id | assigned_hex, 1.0).when(plain, 0.0))


def fit(findings: DataFrame):
    """Forest fitted on the labelled rows of ``findings`` (FEATURES and label), or None if a class is missing."""
    known = findings.where("label is not null")
    sample = stored(known.orderBy(F.xxhash64("value", "finding"), "finding").limit(MOST_LABELLED).select(*FEATURES, "label"), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)]).fit(sample)


def findings(docs: DataFrame, path: str = "source") -> DataFrame:
    """Every candidate of ``docs`` with its features and label."""
    rows = stored(candidates(docs, path), "candidates")
    words = stored(dictionary(docs), "dictionary")
    rows = rows.join(coverage(rows, words), "finding", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))
    return stored(labelled(rows), "labelled")


def secret_scan(docs: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, start, end, length, score, label, secret: one row a candidate finding."""
    rows = findings(docs, path)
    model = fit(rows)
    if model is None:
        scored = rows.withColumn("score", F.coalesce("label", F.lit(0.5)))
    else:
        scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "end", F.col("length").cast("long").alias("length"), F.round("score", 6).alias("score"), "label",
                         (F.col("score") >= 0.5).alias("secret"))
