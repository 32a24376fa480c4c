"""Secret scans: candidates by form, then a random forest that removes false positives.

A candidate is a run of 16 or more letters, digits or ``+/_-`` with a digit inside a word; a word may hold several.  Its
features are length, counts of character classes, changes between classes, distinct characters,
the share of its letters in dictionary words, what its path looks like, and the words next to it.
The forest is trained on labelled findings.  Everything is DataFrame operations and Spark ML on the
JVM.

The dictionary holds the lower-cased runs of letters that occur ``min_count`` times or more in the
whole corpus.  Fit bound: at most ``train_rows`` labelled findings of either class (those with the
smallest hash) train the forest.

Cases: a null or empty text has no candidates.  Equal candidates at different places of a text are
findings of their own.  Repeated rows give repeated findings.  A null doc_id or path is kept; a null
path has no path features.  Findings whose label is null are not trained on.  Without labels of both
classes every candidate keeps a null score and counts as found.  Extra columns are ignored.  Empty
tables give no rows.  The secret itself is never returned, only its hash, place and length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.plans.durable import durable

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}"
#: Words next to a candidate that speak for or against a secret.
FOR = r"(?i)(token|secret|passw|pwd|api|auth|key|credential|bearer)"
AGAINST = r"(?i)(example|sample|test|dummy|sha|commit|digest|checksum|uuid|isbn|card|phone)"


@dataclass(frozen=True)
class SecretConfig:
    min_count: int = 50
    train_rows: int = 3000
    trees: int = 40
    depth: int = 6
    threshold: float = 0.5
    seed: int = 5


FEATURES = (
    "length", "digits", "lower", "upper", "marks", "changes", "kinds", "hex", "covered",
    "path_test", "path_code", "near_for", "near_against", "assigned", "quoted",
)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, path, word, part, candidate, before, after, text_word).

    ``word`` is the place among the words of the text, ``part`` the place among the runs of the word.
    """
    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    split = docs.select("doc_id", F.col(path).cast("string").alias("path"), words.alias("w2"))
    # Four shifted copies of the words: two before, the word itself, one after.
    pad = F.array(F.lit(""), F.lit(""))
    shifted = split.select(
        "doc_id", "path", F.concat(pad, "w2").alias("b2"), F.concat(F.array(F.lit("")), "w2").alias("b1"), F.col("w2").alias("w"),
        F.slice("w2", 2, F.size("w2")).alias("a1"),
    )
    zipped = shifted.select("doc_id", "path", F.posexplode(F.arrays_zip("b2", "b1", "w", "a1")).alias("word", "z"))
    long = zipped.filter((F.length("z.w") >= 16) & F.col("z.w").rlike("[0-9]"))
    return long.select(
        "doc_id",
        "path",
        "word",
        F.posexplode(F.regexp_extract_all("z.w", F.lit(CANDIDATE), F.lit(0))).alias("part", "candidate"),
        F.concat_ws(" ", "z.b2", "z.b1").alias("before"),
        F.coalesce("z.a1", F.lit("")).alias("after"),
        F.col("z.w").alias("text_word"),
    ).filter(F.col("candidate").rlike("[0-9]"))


def dictionary(docs: DataFrame, min_count: int) -> DataFrame:
    """Lower-cased words of letters that occur often in the corpus."""
    word = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^a-z]+"))
    return (
        docs.select(word.alias("run"))
        .filter(F.length("run") >= 3)
        .groupBy("run")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_count)
        .select("run")
    )


def _count(pattern: str) -> Column:
    return F.regexp_count(F.col("candidate"), F.lit(pattern)).cast("double")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with their features; equal candidates are looked up in the dictionary once."""
    distinct = found.select("candidate").distinct()
    runs = distinct.select("candidate", F.explode(F.regexp_extract_all("candidate", F.lit("([A-Za-z]{3,})"), 1)).alias("run"))
    covered = (
        runs.withColumn("run", F.lower("run"))
        .join(words, "run")
        .groupBy("candidate")
        .agg(F.sum(F.length("run")).alias("letters"))
    )
    chars = F.split("candidate", "")
    path = F.coalesce("path", F.lit(""))
    near = F.concat_ws(" ", "before", "after")
    return found.join(covered, "candidate", "left").select(
        *found.columns,
        F.length("candidate").cast("double").alias("length"),
        _count("[0-9]").alias("digits"),
        _count("[a-z]").alias("lower"),
        _count("[A-Z]").alias("upper"),
        _count(r"[+/_\-]").alias("marks"),
        _count("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])").alias("changes"),
        F.size(F.array_distinct(chars)).cast("double").alias("kinds"),
        F.col("candidate").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex"),
        F.coalesce(F.col("letters") / F.length("candidate"), F.lit(0.0)).alias("covered"),
        path.rlike("(?i)(test|example|doc|sample)").cast("double").alias("path_test"),
        path.rlike(r"(?i)(\.env|config|src|code|\.py|\.js|\.ya?ml)").cast("double").alias("path_code"),
        near.rlike(FOR).cast("double").alias("near_for"),
        near.rlike(AGAINST).cast("double").alias("near_against"),
        (F.col("before").rlike(r"[=:]\s*$") | F.col("text_word").rlike("[=:]")).cast("double").alias("assigned"),
        F.col("text_word").rlike("[\"'`]").cast("double").alias("quoted"),
    )


def scan(docs: DataFrame, labelled: DataFrame | None, config: SecretConfig = SecretConfig(), path: str = "source") -> DataFrame:
    """Findings (doc_id, word, part, length, sha256, score, found).

    ``labelled`` rows are (doc_id, word, part, label): the finding at that place is a secret (1) or
    not (0).  Without the column ``part`` a label holds for all findings of the word.
    """
    known = durable(with_features(candidates(docs, path), dictionary(docs, config.min_count)))
    result = [
        "doc_id",
        "word",
        "part",
        F.col("length").cast("int").alias("length"),
        F.sha2("candidate", 256).alias("sha256"),
    ]
    model = None
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    if labelled is not None:
        place = ["doc_id", "word", *(["part"] if "part" in labelled.columns else [])]
        label = labelled.filter(F.col("label").isin(0, 1)).groupBy(*place).agg(F.max("label").cast("double").alias("label"))
        rows = known.join(label, place).select(*FEATURES, "label", F.xxhash64("doc_id", "word", "part", "candidate").alias("h"))
        parts = [rows.filter(F.col("label") == c).orderBy("h").limit(config.train_rows) for c in (0, 1)]
        train = durable(parts[0].union(parts[1]))
        if len(train.select("label").distinct().collect()) == 2:
            forest = RandomForestClassifier(numTrees=config.trees, maxDepth=config.depth, seed=config.seed)
            model = forest.fit(assembler.transform(train.orderBy("h").select(*FEATURES, "label")))
    if model is None:
        return known.select(*result, F.lit(None).cast("double").alias("score"), F.lit(True).alias("found"))
    scored = model.transform(assembler.transform(known))
    score = F.round(vector_to_array("probability")[1], 9)
    return scored.select(*result, score.alias("score"), (score >= config.threshold).alias("found"))


def rule_labels(docs: DataFrame, path: str = "source") -> DataFrame:
    """Labelled findings (doc_id, word, part, label) by a plain rule, where nobody has labelled any.

    Assigned after a telling word, quoted, 32 or more characters with letters and digits: a secret.
    Digits only, or neither assigned nor quoted: none.  Others stay unlabelled.
    """
    found = candidates(docs, path)
    assigned = F.col("before").rlike(r"[=:]\s*$") | F.col("text_word").rlike("[=:]")
    secret = assigned & F.col("before").rlike(FOR) & (F.length("candidate") >= 32) & F.col("candidate").rlike("[A-Za-z]")
    other = F.col("candidate").rlike("^[0-9]+$") | ~(assigned | F.col("text_word").rlike("[\"'`]"))
    return found.select("doc_id", "word", "part", F.when(secret, 1).when(other, 0).alias("label"))
