"""Secret scans with a random forest against false positives (DataFrame functions only).

Candidates are runs of token characters with a digit, dotted tokens, passwords
in URLs, and whatever is assigned to a credential word (any length and
characters but white space; of a quoted value the part to the first space).  Features: length, class
transitions between characters, dictionary coverage, the document's path and
the words beside the candidate.  A random forest, trained on labelled
findings, tells secrets from card numbers, digests, identifiers and the like.

Defined results:

* null or empty text: no candidates; null path: no path words;
* a candidate that occurs twice in one text is one finding per place (a
  finding carries its offset) and all places are masked; a secret shorter than
  ``LONG`` characters or without a digit is masked where it was found only;
* trailing punctuation is not part of a value without quotes;
* repeated rows: each row has its own findings;
* no labelled findings, or labels of one kind only: that kind is the verdict
  (none at all: no candidate is a secret);
* a probability of exactly one half counts as a secret.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, pack

#: Candidate forms, words that name a credential, words of sample paths.
RUN = "[A-Za-z0-9+/_-]"
CREDENTIAL_WORDS = ("password passwd passphrase pwd secret token api[_-]?key access[_-]?key private[_-]?key authorization auth "
                    "credential bearer")
#: Names are looked at once, as whole runs: each loop takes all it can and gives nothing back, and a name starts where its
#: run starts, so that the time to match a text grows with its length only.
_WORD = "[A-Za-z0-9_-]"
#: A credential word with its suffix, at the end of a name or before a - or _.
_CREDENTIAL = "(?i:" + "|".join(CREDENTIAL_WORDS.split()) + ")(?:[0-9]++|(?i:s))?+(?![A-Za-z0-9])"
_OPERATOR = r"[\"']?\s*+(?:=>|:=|==?|:)\s*+"
#: The name of a credential and what stands between it and its value.
_ASSIGN = rf"(?={_WORD}*?{_CREDENTIAL}){_WORD}++{_OPERATOR}"
_SCHEME = r"(?:(?i:bearer|basic|token)\s++)?+"
_VALUE = r"(?:\"[^\s\"]++|'[^\s']++|[^\s\"']\S*(?<![,;.)\]}>\"']))"
#: What stands before a value inside its match; the rest is the candidate.
PREFIX = rf"^(?:{_ASSIGN}{_SCHEME}[\"']?|(?i:bearer)[ \t]+|://[^\s/:@]*:)"
#: No repeated group: Java's would recurse once a part.
DOTTED = r"[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{6,}[A-Za-z0-9_.-]*(?<!\.)"
CANDIDATE = "|".join([
    rf"(?<!{_WORD})(?={_WORD}++[\"']?\s*+[:=]){_ASSIGN}{_SCHEME}{_VALUE}",
    rf"(?i:bearer)[ \t]++(?=[^\s0-9]*+[0-9]){RUN}[A-Za-z0-9+/_.=~-]*+",
    r"://[^\s/:@]*+:[^\s\"'<>/]+(?=@)",
    rf"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z._-]*+[0-9]){DOTTED}",
    rf"(?<!{RUN})(?=[A-Za-z+/_-]*+[0-9])(?!(?={RUN}++[\"']?\s*+[:=])(?={RUN}*?{_CREDENTIAL})){RUN}{{12,}}+"])
#: Where a run of token characters begins or ends.
BORDER = rf"(?<={RUN})(?!{RUN})|(?<!{RUN})(?={RUN})"
SAMPLE_WORDS = "test tests example examples sample mock fixture fixtures docs dummy"
KEY_FORM = (r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}|"
            r"sk-[A-Za-z0-9]{20,}|[sr]k_(live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|xox[abp]-[A-Za-z0-9-]{10,}|"
            r"eyJ[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_.-]{6,})$")
#: Values that only stand for a secret.
REFERENCE = r"(?i)^(true|false|null|none|undefined|required|optional|[$%]?[{<(].*)$"
#: Characters from which a secret with a digit is masked at all its places in a text.
LONG = 8
#: Characters of context kept on each side of a candidate.
CONTEXT = 48
#: Bounds of what is trained on (labelled findings of each kind) and of the dictionary.
LABELLED_PER_KIND = 2000
DICTIONARY_WORDS = 4000
TREES, DEPTH, SEED = 40, 7, 42

FEATURES = ["size", "digit_share", "upper_share", "letter_digit", "case_changes", "consonant_runs", "hex_only",
            "digits_only", "covered", "path_depth", "path_sample", "credential_before", "assigned", "quoted",
            "word_before", "word_after"]


def _cut(body: Column) -> Column:
    """A text cut at its candidates: ``parts``, one more than ``found``."""
    return F.struct(F.split(body, CANDIDATE).alias("parts"),
                    F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)).alias("found"))


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` plus a column that is worked out once a row, wherever it is used (also inside a function of an array)."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def candidates(df: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate place: ``key``, ``path``, ``row``, ``place``, ``offset``, ``candidate``, ``before``, ``after``.

    ``df`` has a column ``key``; ``row`` and ``place`` number rows and a row's
    places.  A text is cut at every candidate, so each piece knows its
    neighbours; whole texts are read, never prefixes.  The table is staged.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    some = df.select("key", F.col(path).alias("path"), body.alias("body")).filter(F.col("body").rlike(CANDIDATE))
    cut = _once(some, _cut(F.col("body")), "cut").select(
        "key", "path", F.monotonically_increasing_id().alias("row"), "cut.parts", "cut.found")
    before = lambda i: F.concat(F.when(i > 0, F.get("found", i - 1)).otherwise(""), F.get("parts", i))
    places = F.transform("found", lambda m, i: F.struct(
        m.alias("match"), F.char_length(F.regexp_extract(m, PREFIX, 0)).alias("skip"),
        F.substring(before(i), -CONTEXT, CONTEXT).alias("before"),
        F.substring(F.concat(F.get("parts", i + 1), F.coalesce(F.get("found", i + 1), F.lit(""))), 1, CONTEXT).alias("after"),
        (F.char_length(F.get("parts", i)) + F.char_length(m)).alias("chars")))
    each = materialize(cut.select("key", "path", "row", F.posexplode(places).alias("place", "x")), "places")
    end = F.sum("x.chars").over(Window.partitionBy("row").orderBy("place"))
    return each.select(
        "key", "path", "row", "place", (end - F.char_length("x.match") + F.col("x.skip")).cast("int").alias("offset"),
        F.substr("x.match", F.col("x.skip") + 1).alias("candidate"),
        F.substring(F.concat("x.before", F.substr("x.match", F.lit(1), F.col("x.skip"))), -CONTEXT, CONTEXT).alias("before"),
        F.col("x.after").alias("after"))


def frequent_words(df: DataFrame, text: str = "text", size: int = DICTIONARY_WORDS) -> DataFrame:
    """Dictionary: the ``size`` most frequent words of four to eight letters of all texts (ties by word)."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"\b([a-z]{4,8})\b"), 1)
    counted = df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "word").limit(size).select("word")


#: A credential word, assigned or a scheme, right before; or the user of a URL.
NAMED = rf"((?<!{_WORD}){_ASSIGN}{_SCHEME}[\"']?|(?i:bearer)\s+|://[^\s/:@]*:)$"


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.char_length("candidate")


def with_features(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add the feature columns; ``dictionary`` is a bounded table of words, small enough to broadcast."""
    runs = F.filter(F.split(F.lower("candidate"), "[^a-z]+"), lambda r: F.char_length(r) >= 4)
    digest = F.sha2(F.col("candidate").cast("binary"), 256)  # a word beside a long candidate must not carry it along
    distinct = found.select("candidate").distinct().select(digest.alias("candidate_digest"), runs.alias("runs"))
    covered = distinct.select("candidate_digest", F.explode("runs").alias("word")).join(
        F.broadcast(dictionary), "word").groupBy("candidate_digest").agg(F.sum(F.char_length("word")).alias("chars"))
    any_of = lambda words: "(?i)(" + "|".join(words.split()) + ")"
    before_words = F.regexp_extract("before", r"([\p{L}]+)[^\p{L}]*$", 1)
    after_words = F.regexp_extract("after", r"^[^\p{L}]*([\p{L}]+)", 1)
    path = F.coalesce("path", F.lit(""))
    return found.join(covered, digest == F.col("candidate_digest"), "left").select(
        *found.columns,
        F.char_length("candidate").cast("double").alias("size"),
        _share("[0-9]").alias("digit_share"), _share("[A-Z]").alias("upper_share"),
        _share("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]").alias("letter_digit"),
        _share("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]").alias("case_changes"),
        _share("(?i)[bcdfghjklmnpqrstvwxz]{3,}").alias("consonant_runs"),
        F.col("candidate").rlike("^[0-9a-fA-F]+$").cast("double").alias("hex_only"),
        F.col("candidate").rlike("^[0-9]+$").cast("double").alias("digits_only"),
        (F.coalesce("chars", F.lit(0)) / F.char_length("candidate")).alias("covered"),
        F.regexp_count(path, F.lit("/")).cast("double").alias("path_depth"),
        path.rlike(any_of(SAMPLE_WORDS)).cast("double").alias("path_sample"),
        F.col("before").rlike(NAMED).cast("double").alias("credential_before"),
        F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        F.col("before").rlike("[\"']$").cast("double").alias("quoted"),
        F.char_length(before_words).cast("double").alias("word_before"),
        F.char_length(after_words).cast("double").alias("word_after"))


def weak_labels(found: DataFrame) -> DataFrame:
    """Label findings whose kind is beyond doubt, all others null: published key forms and assignments of long
    values with a digit to credential words are secrets; digits only, references to a secret kept elsewhere, and
    candidates without any assignment, quote or credential word, are not."""
    c, named = F.col("candidate"), F.col("before").rlike(NAMED)
    digits = c.rlike("^[0-9]+$")
    secret = named & ~digits & c.rlike("[0-9]") & (F.char_length(c) >= LONG) & ~c.rlike(REFERENCE)
    beside = F.col("before").rlike(r"[=:\"'][ \t]*$") | F.col("after").rlike("^[\"']")
    other = (digits & ~named) | (named & c.rlike(REFERENCE)) | ~(named | beside | F.col("before").rlike(rf"{_CREDENTIAL}{_WORD}*\W*$"))
    return found.withColumn("label", F.when(c.rlike(KEY_FORM) | secret, 1.0).when(other, 0.0))


def labelled_sample(labelled: DataFrame, per_kind: int = LABELLED_PER_KIND) -> DataFrame:
    """At most ``per_kind`` different findings of each label, drawn by the hash of the finding: the same at every run."""
    finding = ["candidate", "before", "after"]
    once = labelled.filter("label IS NOT NULL").groupBy("label", *finding).agg(F.min(F.struct(*FEATURES)).alias("least"))
    once = once.select("label", *finding, "least.*")
    kinds = [once.filter(F.col("label") == k).orderBy(F.xxhash64(*finding), *finding).limit(per_kind) for k in (0.0, 1.0)]
    return kinds[0].union(kinds[1])


class SecretForest:
    """Random forest on labelled findings, or the only label there is."""

    def __init__(self, labelled: DataFrame):
        counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
        self.only = None if len(counts) == 2 else next(iter(counts), 0.0)
        self.model = None
        if self.only is None:
            forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird")
            self.model = forest.fit(self._assemble(labelled.repartition(1).sortWithinPartitions(*FEATURES, "label")))

    @staticmethod
    def _assemble(df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` of being a secret, and ``is_secret``."""
        if self.model is None:
            scored = df.withColumn("probability", F.lit(float(self.only)))
        else:
            scored = self.model.setProbabilityCol("chances").setRawPredictionCol("votes").setPredictionCol("guess").transform(
                self._assemble(df)).withColumn("probability", vector_to_array("chances")[1]).drop(
                "features", "chances", "votes", "guess")
        return scored.withColumn("is_secret", F.col("probability") >= 0.5)


def scan(df: DataFrame, text: str = "text", path: str = "source", labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of ``df`` (which has ``key``) with features, ``probability`` and ``is_secret``.

    ``labelled`` has the columns of ``candidates`` and ``label``; without it
    the findings label themselves by ``weak_labels``.
    """
    dictionary = materialize(frequent_words(df, text), "dictionary")
    found = materialize(with_features(materialize(candidates(df, text, path), "candidates"), dictionary), "features")
    known = weak_labels(found) if labelled is None else with_features(
        labelled.drop("label"), dictionary).join(
            labelled.select("key", "candidate", "offset", "label"), ["key", "candidate", "offset"])
    sample = materialize(labelled_sample(known), "labelled")
    return SecretForest(sample).score(found)


def mask_secrets(df: DataFrame, text: str = "text", path: str = "source", mask: str = "[SECRET]",
                 labelled: DataFrame | None = None) -> DataFrame:
    """All columns of ``df`` as they are, secrets in ``text`` replaced by ``mask``.

    Verdicts join back on a hash of text and path, so equal rows share
    theirs and no row is lost or repeated; only texts with secrets are touched.
    A text is put together again from its candidates and what lies between.
    """
    packed = pack(df, key=F.xxhash64(F.col(text), F.col(path)), text=F.col(text), path=F.col(path))
    scored = scan(packed.select("key", "text", "path"), "text", "path", labelled)
    # of a text the verdicts in order of its places, and the runs that are masked wherever they stand
    long = F.col("is_secret") & (F.char_length("candidate") >= LONG) & F.col("candidate").rlike("[0-9]")
    verdicts = scored.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("place", "is_secret"))).alias("places"),
        F.collect_set(F.when(long, F.col("candidate"))).alias("long"), F.max("is_secret").alias("any"))
    verdicts = verdicts.filter("any").select("key", "long", F.transform("places", lambda p: p["is_secret"]).alias("flags"))
    joined = packed.join(verdicts, "key", "left")
    at = _once(joined, F.when(F.col("flags").isNotNull(), _cut(F.col("text"))), "cut").select(
        "row", "text", "long", "flags", "cut.parts", "cut.found")
    runs = lambda s: F.split(s, BORDER)
    after = lambda m: F.substr(m, F.char_length(F.regexp_extract(m, PREFIX, 0)) + 1)
    # long secrets found again outside the places that are masked anyway
    rest = F.flatten(F.concat(F.transform("parts", runs), F.transform("found", lambda m, i: F.when(
        F.get("flags", i), F.array().cast("array<string>")).otherwise(F.concat(F.array(after(m)), runs(m))))))
    again = _once(at, F.when(F.col("flags").isNotNull(), F.array_intersect(rest, "long")), "again")
    clean = lambda s: F.when(F.size("again") == 0, s).otherwise(F.array_join(F.transform(
        runs(s), lambda r: F.when(F.array_contains("again", r), F.lit(mask)).otherwise(r)), ""))
    lead = lambda m: F.regexp_extract(m, PREFIX, 0)
    hidden = lambda m, i: F.get("flags", i) | F.array_contains("again", after(m))
    masked = F.array_join(F.transform("parts", lambda p, i: F.concat(clean(p), F.coalesce(F.when(
        hidden(F.get("found", i), i), F.concat(lead(F.get("found", i)), F.lit(mask))).otherwise(
            clean(F.get("found", i))), F.lit("")))), "")
    out = again.withColumn("text", F.when(F.col("flags").isNotNull(), masked).otherwise(F.col("text")))
    return out.select(*[(F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in df.columns])
