"""Host-level quality rules with an empirical beta prior (DataFrame functions only).

Every document gets rule counts; failures are summed by host, host failure
rates are shrunk towards a beta prior fitted to all hosts, and the verdict on
each host goes back to its documents.

Defined results:

* null or empty text: no words, so ``base_failed`` (below ``min_words``);
* null host: belongs to no host, only its own rules decide;
* repeated rows: each is judged and counted on its own;
* no hosts at all (empty table): empty result;
* a host whose shrunk rate equals the limit is kept;
* a column called like ``out`` is replaced, all others are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, pack, words_of

#: Fixed values of the rules.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 50
MAX_DUP_LINE_PERCENT = 50
MAX_HOST_RATE = 0.5
#: Hosts (of 256 bytes at most) whose verdicts are broadcast.
BROADCAST_HOSTS = 100_000


def _repeat_windows(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in a window found twice or more in the same text.

    Works inside each row: window hashes, and only where two are equal a sort
    of (hash, position).  Neighbours of equal hash are compared word by word.
    """
    n = F.size("words")
    hashes = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])))
    df = df.withColumn("hashes", hashes)
    ordered = F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(
        F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    df = df.withColumn("ordered", ordered).drop("hashes")

    def same(a: Column, b: Column) -> Column:
        return (a.h == b.h) & (F.slice("words", a.p + 1, WINDOW) == F.slice("words", b.p + 1, WINDOW))

    found = F.filter(F.transform("ordered", lambda x, i: F.when(
        same(x, F.get("ordered", i - 1)) | same(x, F.get("ordered", i + 1)), x.p)), lambda p: p.isNotNull())
    df = df.withColumn("starts", F.sort_array(found)).drop("ordered")
    steps = F.transform("starts", lambda p, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get("starts", i + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("starts")


def document_rules(df: DataFrame, text: str = "text", host: str = "source",
                   keep: list[str] | None = None) -> DataFrame:
    """``row``, ``host`` and the rule counts of every document; one narrow pass."""
    body = F.coalesce(F.col(text), F.lit(""))
    packed = pack(df, keep, host=F.col(host), body=body, words=words_of(F.col(text)))
    packed = _repeat_windows(packed)
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_repeat_words")
    # one row per row: a generator's output is not replaced by its expression, so
    # that a filter on a count, moved down by the optimizer, does not count again
    return packed.withColumn("lines", lines).select("row", "host", F.inline(F.array(counts))).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    ).withColumn(
        "rule_failed", F.col("base_failed")
        | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
        | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")))


def host_rates(rules: DataFrame) -> DataFrame:
    """One row per host: documents, failures and the failure rate shrunk by the prior.

    The beta prior's mean and strength are the moments of the hosts' raw
    rates; only those three sums reach the driver.
    """
    hosts = rules.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("rule_failed").cast("long")).alias("failed"))
    rate = F.col("failed") / F.col("n")
    hosts = materialize(hosts, "host-sums")
    m = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("var")).first()
    mean, var = m["mean"] or 0.0, m["var"] or 0.0
    # hosts that all agree leave no variance: then the prior is as strong as allowed
    strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1000.0) if var > 1e-12 else 1000.0
    return hosts.withColumn("host_rate", (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))


def judge_hosts(df: DataFrame, text: str = "text", host: str = "source", out: str = "quality",
                max_host_rate: float = MAX_HOST_RATE, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``df`` (or those in ``keep``) plus the struct ``out``: rule counts, ``host_rate``, ``kept``.

    Hosts are summed with partial aggregation.  With ``keep`` the rules run
    once, into a staged table of those columns; with whole documents they run
    a second time, which costs less than writing every text again.  Up to
    ``BROADCAST_HOSTS`` verdicts (they are counted) are broadcast; more are
    joined by a shuffle, where Spark splits hot hosts.
    """
    narrow = keep is not None
    keep = [c for c in keep or df.columns if c.lower() != out.lower()]
    rules = document_rules(df, text, host, keep)
    if narrow:
        rules = materialize(rules, "rules")
    verdicts = materialize(host_rates(rules).select("host", "host_rate"), "hosts")
    small = verdicts.filter(F.octet_length("host") <= 256).count() == verdicts.count() <= BROADCAST_HOSTS
    joined = rules.join(F.broadcast(verdicts) if small else verdicts, "host", "left").withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("host_rate"), F.lit(0.0)) <= max_host_rate))
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in keep],
        F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "base_failed", "rule_failed", "host_rate", "kept").alias(out))
