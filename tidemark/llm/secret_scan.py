"""Secret scan: candidates by shape, a random forest to drop the false positives.

A candidate is a run of at least ``MIN_LENGTH`` key characters that has a digit, the shape of an issued key, or
``TURNS`` changes between small letters and capitals; and, at any length and of any characters, the value of a
name of a credential. Its features are length,
character transitions and classes, the share of its letter runs that the corpus uses as words (at least
``DICTIONARY_SHARE`` times a document, counted over all), the parts of its path, and how many neighbouring words
name a credential, a digest or an example. The forest learns from labelled findings, of which at most
``MAX_LABELLED`` are taken, in hash order; copies of a finding count once. A NULL path has no parts.
Everything runs as DataFrame operations and Spark's own forest.

No expression goes back over a word: the time of one grows with its length, so a text that is a single word of a
megabyte is scanned like any other.

Defined cases: NULL and empty texts have no candidates. Repeated rows are scanned one by one. With
fewer than two classes among the labelled findings there is no forest: a candidate scores the share
of positive labels, or 0.5 without labels.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as t

MIN_LENGTH = 16
MAX_LABELLED = 20_000
DICTIONARY_SHARE = 0.0005
TREES, DEPTH, SEED = 40, 6, 17
# Words that name a credential, prefixes and shapes of issued keys.
CREDENTIAL = r"(?i)(token|password|passwd|secret|api.?key|access.?key|auth|credential|bearer)"
ISSUED = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,})$"
# Words around a candidate, parts of paths and kinds of files that speak for or against a secret.
DIGEST = r"(?i)(sha\d*|md5|crc|checksum|digest|integrity|commit|revision|uuid|guid|etag|fingerprint)"
PLACEHOLDER = r"(?i)(example|dummy|sample|placeholder|change.?me|your|fake|redacted|x{6,})"
SAMPLE_PART = r"(?i)(^|[/_.-])(tests?|spec|fixtures?|examples?|samples?|mocks?|docs?)([/_.-]|$)"
SETTINGS_FILE = r"(?i)\.(env|cfg|ini|conf|ya?ml|json|toml|properties|tf|sh)$"
TURNS = 3
OPENING, CLOSING = "\"'`([{", "\"'`)]},;."
NUMBERS = r"^[0-9+\-/=_]+$"

FEATURES = (
    "f_length",
    "f_transitions",
    "f_digits",
    "f_upper",
    "f_lower",
    "f_distinct",
    "f_vowels",
    "f_dictionary",
    "f_assigned",
    "f_named",
    "f_quoted",
    "f_after_named",
    "f_near_credential",
    "f_near_digest",
    "f_near_placeholder",
    "f_path_depth",
    "f_path_sample",
    "f_path_settings",
)


def _head(word: Column) -> Column:
    """What stands before the first ``=`` or ``:``; empty without one."""
    return F.regexp_extract(word, r"^([^=:]*+)[=:]", 1)


def _last_name(word: Column) -> Column:
    """The last name of a word that ends with ``=`` or ``:``; empty for others."""
    names = F.translate(word, ":", "=")
    return F.when(names.endswith("="), F.substring_index(names.substr(F.lit(1), F.length(names) - 1), "=", -1)).otherwise("")


def candidates(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str = "source") -> DataFrame:
    """(doc_id, path, position, candidate, name, quoted, before, before_2, after), one row for each candidate of a word."""
    split = docs.select(F.col(key).alias("doc_id"), F.col(path).alias("path"), t.words(F.col(text)).alias("w"))
    shape = rf"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}"
    # Words with a run, and words that may be the value of a name: the name is in them, or in one of the two before.
    wanted = F.filter(
        F.transform("w", lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
        lambda s: s["x"].rlike(shape)
        | _head(s["x"]).rlike(CREDENTIAL)
        | F.coalesce(F.get("w", s["i"] - 1).rlike(r"[=:][\"']?$"), F.lit(False)),
    )
    each = split.withColumn("s", F.explode(wanted)).withColumn("i", F.col("s.i"))
    near = {name: F.coalesce(F.get("w", F.col("i") + k), F.lit("")) for name, k in (("before", -1), ("before_2", -2), ("after", 1))}
    each = each.withColumns(near)
    runs = F.filter(
        F.regexp_extract_all("s.x", F.lit(f"({shape})"), 1),
        lambda c: c.rlike("[0-9]") | c.rlike(ISSUED) | c.rlike(rf"(([a-z](?=[A-Z])|[A-Z](?=[a-z])).*){{{TURNS}}}"),
    )
    named = F.when(_head(F.col("s.x")).rlike(CREDENTIAL), F.regexp_extract("s.x", r"(?s)^[^=:]*+(?::[=:]|[=:])(.*)$", 1)).otherwise("")
    after_name = (F.col("before").isin("=", ":", ":=") & F.col("before_2").rlike(CREDENTIAL)) | _last_name(F.col("before")).rlike(CREDENTIAL)
    value = F.when(named != "", named).when(after_name & ~F.col("s.x").isin("=", ":", ":="), F.col("s.x")).otherwise("")
    value = F.rtrim(F.ltrim(value, F.lit(OPENING)), F.lit(CLOSING))
    both = F.array_union(runs, F.filter(F.array(value), lambda v: v != ""))
    return each.withColumn("candidate", F.explode(both)).select(
        "doc_id",
        "path",
        F.col("i").alias("position"),
        "candidate",
        F.regexp_extract(F.col("s.x"), r"^([A-Za-z_.-]+)[=:]", 1).alias("name"),
        F.col("s.x").rlike("[\"']").alias("quoted"),
        "before",
        "before_2",
        "after",
    )


def dictionary(docs: DataFrame, text: str = "text", share: float = DICTIONARY_SHARE) -> DataFrame:
    """(run): lower-case words of 3 letters or more that the whole corpus uses ``share`` times a document, or more often."""
    used = F.filter(t.words(F.col(text)), lambda w: w.rlike("^[a-z]{3,16}$"))
    counted = docs.select(F.explode(used).alias("run")).groupBy("run").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= share * docs.count()).select("run")


def with_features(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with the features; ``known`` is the dictionary."""
    runs = F.regexp_extract_all(F.lower("candidate"), F.lit("([a-z]{3,})"), 1)
    letters = found.select("candidate").distinct().select("candidate", F.explode(runs).alias("run"))
    covered = (
        letters.join(known.withColumn("hit", F.lit(1)), "run", "left")
        .groupBy("candidate")
        .agg((F.sum(F.col("hit") * F.length("run")) / F.sum(F.length("run"))).alias("f_dictionary"))
    )
    length = F.length("candidate")
    turn = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[+/_-])(?=[^+/_-])"

    def share(pattern: str) -> Column:
        return F.regexp_count("candidate", F.lit(pattern)) / length

    def yes(test: Column) -> Column:
        return F.coalesce(test, F.lit(False)).cast("double")

    around = F.array("name", "before_2", "before", "after")

    def near(pattern: str, *more: Column) -> Column:
        return F.size(F.filter(F.concat(around, F.array(*more)) if more else around, lambda w: w.rlike(pattern))).cast("double")

    folders = F.coalesce(F.col("path").cast("string"), F.lit(""))
    assigned = (F.col("name") != "") | F.col("before").isin("=", ":", ":=")
    return found.join(covered, "candidate", "left").withColumns(
        {
            "f_length": length.cast("double"),
            "f_transitions": share(turn),
            "f_digits": share("[0-9]"),
            "f_upper": share("[A-Z]"),
            "f_lower": share("[a-z]"),
            "f_distinct": F.size(F.array_distinct(F.split("candidate", ""))) / length,
            "f_vowels": share("[aeiouAEIOU]"),
            "f_dictionary": F.coalesce("f_dictionary", F.lit(0.0)),
            "f_assigned": yes(assigned),
            "f_named": yes(F.col("name").rlike(CREDENTIAL)),
            "f_quoted": yes(F.col("quoted")),
            "f_after_named": yes(F.concat_ws(" ", "before_2", "before").rlike(CREDENTIAL)),
            "f_near_credential": near(CREDENTIAL),
            "f_near_digest": near(DIGEST),
            "f_near_placeholder": near(PLACEHOLDER, F.col("candidate")),
            "f_path_depth": F.regexp_count(folders, F.lit("/")).cast("double"),
            "f_path_sample": yes(folders.rlike(SAMPLE_PART)),
            "f_path_settings": yes(folders.rlike(SETTINGS_FILE)),
        }
    )


def fit_forest(labelled: DataFrame, limit: int = MAX_LABELLED):
    """The forest of ``labelled`` (features, label), or None without two classes."""
    once = labelled.select("candidate", *FEATURES, F.col("label").cast("double").alias("label")).dropDuplicates(["candidate", "label"])
    # A bounded sample in one partition: bagging then draws the same trees in every run.
    sample = t.materialise(once.orderBy(F.xxhash64("candidate"), "candidate", "label").limit(limit).coalesce(1))
    classes = sample.select("label").distinct().count()
    if classes < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features").fit(rows)


def secret_scan(docs: DataFrame, label: Column, text: str = "text", key: str = "doc_id", path: str = "source") -> DataFrame:
    """(doc_id, path, position, candidate, score, is_secret), a row for each candidate.

    ``label`` judges a candidate as 1 or 0, or NULL where there is no finding on it: an expression
    over the candidates' columns, or the label column of findings joined to the documents.
    """
    found = t.materialise(candidates(docs, text, key, path))
    ready = t.materialise(with_features(found, dictionary(docs, text)).withColumn("label", label))
    labelled = ready.filter(F.col("label").isNotNull())
    forest = fit_forest(labelled)
    if forest is None:
        share = labelled.agg(F.coalesce(F.avg("label"), F.lit(0.5)).alias("s")).first()["s"]
        scored = ready.withColumn("score", F.lit(float(share)))
    else:
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(ready)
        scored = forest.transform(rows).withColumn("score", F.round(F.get(vector_to_array("probability"), F.lit(1)), 6))
    return scored.select("doc_id", "path", "position", "candidate", "score", (F.col("score") >= 0.5).alias("is_secret"))


def rule_label() -> Column:
    """The query's labelled findings: issued shapes and named credentials are true, plain numbers false, others open."""
    assigned = F.col("name").rlike(CREDENTIAL) | (F.col("before").isin("=", ":", ":=") & F.col("before_2").rlike(CREDENTIAL))
    # A value of letters only may be a word of the text, after a name that is one too: open.
    keyed = F.col("candidate").rlike("[a-z]") & F.col("candidate").rlike("[^a-z.]")
    return F.when(F.col("candidate").rlike(ISSUED) | (assigned & keyed), 1).when(F.col("candidate").rlike(NUMBERS), 0)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secret_scan(docs, rule_label()).select(
        "doc_id", "position", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret"
    )
